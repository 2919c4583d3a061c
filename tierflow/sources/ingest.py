"""Bronze ingestion: land raw snapshots, scan them permissively, stamp metadata.

Raw records always arrive as files (never as driver-side lists): a snapshot is
a directory ``<root>/<entity>/snapshot=<ts>/`` of JSON-lines files, so
partition discovery exposes ``snapshot`` as a column and later runs never
overwrite earlier evidence.
"""

from __future__ import annotations

import datetime as _dt
import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tierflow.schemas import CORRUPT_COLUMN, with_corrupt_column

SNAPSHOT_COLUMN = "snapshot"
# Lines of a compressed raw file, at most.
PACKED_LINES = 2_000_000


def snapshot_id(now: _dt.datetime | None = None) -> str:
    return (now or _dt.datetime.now(_dt.timezone.utc)).strftime("%Y%m%d_%H%M%S")


def land_snapshot(df: DataFrame, root: str, entity: str, snapshot: str | None = None, compression: str | None = None) -> str:
    """SRC-1/SNK-4: write records as an immutable JSON-lines snapshot; return its path.

    ``errorifexists`` keeps a snapshot immutable: landing the same id twice fails
    instead of silently replacing raw evidence. A compressed file is read by one task, so
    it has ``PACKED_LINES`` lines at most.
    """
    path = f"{root.rstrip('/')}/{entity}/{SNAPSHOT_COLUMN}={snapshot or snapshot_id()}"
    writer = df.write.mode("errorifexists")
    if compression:
        writer = writer.option("compression", compression).option("maxRecordsPerFile", PACKED_LINES)
    writer.json(path)
    return path


def snapshots(scanned: DataFrame) -> set[str | None]:
    """The snapshots that a scan's files belong to, by their paths; no job runs."""
    found = (re.search(f"/{SNAPSHOT_COLUMN}=([^/]+)/", path) for path in scanned.inputFiles())
    return {hit and hit.group(1) for hit in found}


def land_json_lines(text: DataFrame, root: str, entity: str, snapshot: str | None = None, column: str = "value") -> str:
    """Land a column of already-serialised JSON lines (may include malformed ones)."""
    path = f"{root.rstrip('/')}/{entity}/{SNAPSHOT_COLUMN}={snapshot or snapshot_id()}"
    text.select(F.col(column).alias("value")).write.mode("errorifexists").text(path)
    return path


def to_json_lines(df: DataFrame, column: str = "value") -> DataFrame:
    """FN-18: one JSON document per row (``to_json(struct(*))``)."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias(column))


def parse_json_records(df: DataFrame, column: str, schema: StructType) -> DataFrame:
    """SRC-2/FN-19: parse a JSON string column with an explicit schema, permissively.

    Malformed documents keep their text in ``_corrupt_record``; nothing is
    parsed on the driver.
    """
    full = with_corrupt_column(schema)
    parsed = F.from_json(
        F.col(column), full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}
    )
    others = [c for c in df.columns if c != column]
    return df.select(*others, parsed.alias("_tf_parsed")).select(*others, "_tf_parsed.*")


def scan_json_permissive(
    spark: SparkSession, path: str, schema: StructType, recursive: bool = False
) -> DataFrame:
    """SRC-3/SRC-4: permissive JSON scan with a declared schema (no inference pass).

    With ``recursive=False`` the ``snapshot=...`` directories are discovered as a
    partition column; ``recursive=True`` (the reference's option) disables
    discovery, so the snapshot id is recovered from the file path instead.
    """
    reader = (
        spark.read.schema(with_corrupt_column(schema))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .option("multiLine", "false")
    )
    if recursive:
        df = reader.option("recursiveFileLookup", "true").json(path)
        return df.withColumn(
            SNAPSHOT_COLUMN, F.regexp_extract(F.col("_metadata.file_path"), f"{SNAPSHOT_COLUMN}=([^/]+)", 1)
        )
    return reader.json(path)


def with_ingest_metadata(df: DataFrame, source: str) -> DataFrame:
    """SRC-6: ingestion timestamp, source tag and source file (``_metadata.file_path``)."""
    return df.withColumns(
        {
            "_ingestion_timestamp": F.current_timestamp(),
            "_source": F.lit(source),
            "_source_file": F.col("_metadata.file_path"),
        }
    )


def corrupt_records(df: DataFrame) -> DataFrame:
    """SRC-5: rows whose line did not parse (all columns kept, see module note)."""
    return df.filter(F.col(CORRUPT_COLUMN).isNotNull())


def with_parent_key(df: DataFrame, key: str, dtype: str = "bigint", path_col: Column | None = None) -> DataFrame:
    """SRC-7: stamp the parent key encoded in the file path (``.../<key>=<value>/...``)."""
    path = path_col if path_col is not None else F.col("_metadata.file_path")
    return df.withColumn(key, F.regexp_extract(path, f"{key}=([^/]+)", 1).try_cast(dtype))


def limit_parents(parents: DataFrame, children: DataFrame, key: str, n: int, order_by: str | None = None) -> DataFrame:
    """SRC-8: children of the first ``n`` parents (ordered), via a LEFT SEMI join.

    The limit is the feature (a demo slice); the ordered ``limit`` is a
    TakeOrderedAndProject of at most ``n`` keys, so the semi-join side is
    bounded by ``n`` and is broadcast.
    """
    first = parents.select(key).orderBy(order_by or key).limit(n)
    return children.join(F.broadcast(first), key, "left_semi")


# Ingestion metadata differs between copies of the same record (fixed values).
METADATA_COLUMNS = ("_ingestion_timestamp", "_source", "_source_file")


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_cols: Sequence[str],
    ignore_cols: Sequence[str] = METADATA_COLUMNS,
) -> DataFrame:
    """T-1: keep the newest version of each key across accumulated snapshots.

    All rows of a key's newest snapshot are kept (rows sharing a key *within*
    one snapshot are distinct records, e.g. two credits of one person in one
    show). A row with a NULL key part (a corrupt line, T-14) is versioned by
    its content instead -- every column except the order and ``ignore_cols``
    -- so re-landing a snapshot never duplicates it.

    The newest order value per identity is one map-side-combined aggregate (an
    identity present in many snapshots costs one buffer per task); rows are
    matched to it with a join. No predicate on the key reaches a JSON scan (the
    JSON reader evaluates a pushed ``key IS NULL`` on a partially parsed line
    and would skip a corrupt line that starts with a valid key).
    """
    keys = list(keys)
    skip = set(order_cols) | set(ignore_cols) | set(keys)
    content = [c for c in df.columns if c not in skip]
    keyed = F.lit(True)
    for k in keys:
        keyed = keyed & F.col(k).isNotNull()
    order = F.struct(*[F.col(c) for c in order_cols])
    ident = df.withColumns(
        {
            "_tf_by_key": F.when(keyed, F.struct(*[F.col(k) for k in keys])),
            "_tf_by_content": F.when(~keyed, F.struct(*[F.col(c) for c in keys + content])),
        }
    )
    newest = ident.groupBy("_tf_by_key", "_tf_by_content").agg(F.max(order).alias("_tf_newest")).select(
        F.col("_tf_by_key").alias("_tf_nk"), F.col("_tf_by_content").alias("_tf_nc"), "_tf_newest"
    )
    on = (
        ident["_tf_by_key"].eqNullSafe(newest["_tf_nk"])
        & ident["_tf_by_content"].eqNullSafe(newest["_tf_nc"])
        & (order == newest["_tf_newest"])
    )
    return ident.join(newest, on, "left_semi").select(*df.columns)


def evolve_union(frames: Sequence[DataFrame]) -> DataFrame:
    """Schema evolution: union by column name; columns missing in a frame are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
