"""Incremental processing: file-stream ingestion, keyed upserts and fact refresh by a stored mark.

STR-1 ``ingest_incremental`` appends raw files to a Parquet table, ``ingest_upsert`` keeps
the newest snapshot of each key in a versioned table. Both are Structured Streaming over
the raw snapshot folder with ``trigger(availableNow=True)``: each run processes only files
the checkpoint has not seen, at most ``max_files_per_trigger`` a batch, then stops. The
checkpoint lives in the shared folder, so a restarted driver resumes where it left off.

STR-2 ``refresh_fact`` recomputes the fact rows of the shows that changed since the mark
its table keeps, and publishes the partitions they touch, with the new mark, as the next
version. A partition is replaced as a whole, so the unchanged rows of a touched partition
are written again; what a reader holds is never overwritten.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tierflow.operators.silver import build_fact
from tierflow.schemas import CORRUPT_COLUMN, with_corrupt_column
from tierflow.session import ensure_checkpoint_dir
from tierflow.sinks.tables import observed_rows, session_settings
from tierflow.sinks.versions import Version, VersionedTable
from tierflow.sources.ingest import METADATA_COLUMNS, SNAPSHOT_COLUMN, evolve_union, latest_per_key, with_ingest_metadata

BUCKET = "_key_bucket"
MAX_PARTS = 16
# Rows a task of a merge reads or sorts: their number, not a fixed number of tasks, sets how many tasks it has.
MERGE_ROWS = 500_000
# Changed keys, 8 bytes each, up to which the fact is filtered by a broadcast of them.
BROADCAST_KEYS = 2_000_000


def _raw_stream(spark: SparkSession, source_dir: str, schema: StructType, source: str, max_files: int) -> DataFrame:
    full = StructType(with_corrupt_column(schema).fields + [StructField(SNAPSHOT_COLUMN, StringType(), True)])
    raw = (
        spark.readStream.schema(full)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .option("maxFilesPerTrigger", max_files)
        .json(source_dir)
    )
    return with_ingest_metadata(raw, source)


def _stream_id(spark: SparkSession) -> str:
    """Inside foreachBatch: the id of the stream, which its checkpoint keeps across runs."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId")


def ingest_incremental(
    spark: SparkSession,
    source_dir: str,
    schema: StructType,
    target_path: str,
    checkpoint_path: str,
    source: str = "files",
    max_files_per_trigger: int = 10_000,
) -> int:
    """Append new raw files to a Parquet Bronze table; return the rows appended this run.

    The file sink commits a batch once, whatever is replayed; rows are counted by a
    metric observed in the stream itself, batch by batch.
    """
    counted = _raw_stream(spark, source_dir, schema, source, max_files_per_trigger).observe("ingested", F.count(F.lit(1)).alias("rows"))
    query = (
        counted.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start(target_path)
    )
    query.awaitTermination()
    seen = {p["batchId"]: p["observedMetrics"]["ingested"]["rows"] for p in query.recentProgress if "ingested" in p["observedMetrics"]}
    return int(sum(seen.values()))


def key_bucket(df: DataFrame, keys: Mapping[str, str], buckets: int) -> Column:
    """The bucket of a row by its key or, where a part of the key is NULL, by its content."""
    parts = [F.col(path) for path in keys.values()]
    keyed = reduce(lambda a, b: a & b, [p.isNotNull() for p in parts])
    content = [c for c in df.columns if c not in METADATA_COLUMNS and c not in (SNAPSHOT_COLUMN, BUCKET)]
    return F.pmod(F.when(keyed, F.xxhash64(*parts)).otherwise(F.xxhash64(*content)), F.lit(buckets)).cast("int")


def merge_tasks(spark: SparkSession, rows: int) -> dict[str, int | str]:
    """Settings under which ``rows`` rows are scanned and shuffled by a task for each ``MERGE_ROWS`` of them, at least one a core."""
    tasks = max(math.ceil(rows / MERGE_ROWS), spark.sparkContext.defaultParallelism)
    return {
        "spark.sql.files.minPartitionNum": tasks,
        "spark.sql.shuffle.partitions": tasks,
        # The number fits the rows already; joined up to AQE's size, tasks would sort several times as many.
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }


def upsert_batch(table: VersionedTable, batch: DataFrame, keys: Mapping[str, str], marks: Mapping[str, str], buckets: int) -> int:
    """Publish the table with a batch merged in: of each key the rows of its newest snapshot; return the batch's rows.

    Rows the table has from a file that the batch holds again go first, so a file read
    twice counts once. Only the buckets of the batch's keys are written again, by tasks
    of about ``MERGE_ROWS`` rows however large the table gets.
    """
    ensure_checkpoint_dir(batch.sparkSession)
    seen = Observation()
    counted = batch.observe(seen, F.count(F.lit(1)).alias("rows"))
    # Read once: the batch feeds the list of buckets, the files it holds and the merge.
    rows = counted.withColumn(BUCKET, key_bucket(batch, keys, buckets)).checkpoint(eager=True)
    touched = sorted(r[0] for r in rows.select(BUCKET).distinct().collect())  # at most ``buckets`` numbers
    if not touched:
        if table.current() is not None:
            table.mark(marks)
        return 0
    before = table.current()
    merged, rows_gone = rows, 0
    if before is not None:
        old = table.read().filter(F.col(BUCKET).isin(touched))
        rows_gone = old.count()
        # As many names as the batch has files: sent around, so that the table's rows are not shuffled by them.
        old = old.join(F.broadcast(rows.select("_source_file").distinct()), "_source_file", "left_anti")
        merged = evolve_union([old, rows])
    named = merged.withColumns({k: F.col(path) for k, path in keys.items() if k != path})
    latest = latest_per_key(named, list(keys), [SNAPSHOT_COLUMN], (*METADATA_COLUMNS, BUCKET)).select(*merged.columns)
    read = observed_rows(seen)
    with session_settings(latest.sparkSession, merge_tasks(latest.sparkSession, read + rows_gone)):
        if before is None:
            done = table.publish(latest, partition_by=[BUCKET], unsorted=True, marks=marks)
        else:
            done = table.replace_partitions(latest, [str(b) for b in touched], rows_gone=rows_gone, unsorted=True, marks=marks)
    if len(done.parts) > MAX_PARTS:
        table.compact()
    return read


def ingest_upsert(
    spark: SparkSession,
    source_dir: str,
    schema: StructType,
    table: VersionedTable,
    checkpoint_path: str,
    keys: Mapping[str, str],
    source: str = "files",
    max_files_per_trigger: int = 10_000,
    buckets: int = 64,
) -> int:
    """Keep the newest snapshot of each key (T-1) of all raw files in ``table``; return the rows read this run.

    ``keys``: column name -> path of each part of the key. The table's commit holds the
    stream's id and batch id, so a batch that is replayed after a failure adds nothing; a
    stream that starts anew, with a new checkpoint, reads all files again and leaves the
    same rows.
    """
    read: list[int] = []

    def merge(batch: DataFrame, batch_id: int) -> None:
        mark = f"stream:{_stream_id(batch.sparkSession)}"
        if int(table.marks().get(mark, -1)) < batch_id:
            read.append(upsert_batch(table, batch, keys, {mark: str(batch_id)}, buckets))

    query = (
        _raw_stream(spark, source_dir, schema, source, max_files_per_trigger)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sum(read)


def _micros(c: str) -> Column:
    return F.unix_micros(F.col(c).cast("timestamp"))


def changed_keys(df: DataFrame, key: str, ts_col: str, since: int | None, until: int) -> DataFrame:
    """Keys with records newer than the mark ``since`` (None: all), up to ``until``; both in microseconds."""
    late = _micros(ts_col) <= until
    return df.filter(late if since is None else late & (_micros(ts_col) > since)).select(key).distinct()


def held_rows(current: DataFrame, keys: DataFrame, key: str) -> dict[str | None, tuple[int, int]]:
    """Of each ``value`` (partition) of a table: its rows, and those with one of the keys.

    The table is read once, its rows are counted by key where they are read, and only
    those counts meet the keys, however many these are.
    """
    counts = current.groupBy(key, "value").agg(F.count(F.lit(1)).alias("rows"))
    marked = counts.join(keys.select(key, F.lit(True).alias("_changed")), key, "left")
    sums = marked.groupBy("value").agg(F.sum("rows"), F.sum(F.when(F.col("_changed"), F.col("rows")).otherwise(0)))
    return {value: (rows, changed) for value, rows, changed in sums.collect()}


def refresh_fact(
    table: VersionedTable,
    episodes: DataFrame,
    shows: DataFrame,
    genres: DataFrame,
    cast: DataFrame,
    stamps: Mapping[str, str],
    partition_col: str = "language",
    key: str = "show_id",
    mark: str = "high_water",
) -> Version | None:
    """STR-2: bring the fact up to date with its inputs; None, and nothing written, if nothing is new.

    ``stamps`` names the stamp column of each input that has one (``episodes``, ``shows``,
    ``genres``, ``cast``); records with a stamp above the table's mark are new, those
    without a stamp never are. The new mark is the largest stamp found before anything
    is computed, so what arrives meanwhile is new to the next run. Without a version
    the whole fact is built. Affected keys may leave a partition (their ``language``
    changed): the old and the new partitions are replaced, NULL like any other.
    """
    inputs = {"episodes": episodes, "shows": shows, "genres": genres, "cast": cast}
    tops = [inputs[name].agg(F.max(_micros(c)).alias("top")) for name, c in stamps.items()]
    until = reduce(DataFrame.union, tops).agg(F.max("top")).first()[0]
    before = table.current()
    since = int(before.marks[mark]) if before is not None and mark in before.marks else None
    if before is None:
        fact = build_fact(episodes, shows, genres, cast, timestamps=False, dealt=True, packed=True)
        marks = {} if until is None else {mark: str(until)}
        return table.publish(fact.rows(), partition_by=[partition_col], unsorted=True, marks=marks, product=fact)
    if until is None or (since is not None and until <= since):
        return None
    ensure_checkpoint_dir(table.spark)
    found = [changed_keys(inputs[name], key, c, since, until) for name, c in stamps.items()]
    keys = reduce(DataFrame.union, found).distinct().checkpoint(eager=True)
    # Rows of the fact are many times the keys': as long as the keys fit, only they are sent around.
    listed = F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys

    def only(df: DataFrame) -> DataFrame:
        return df.join(listed, key, "left_semi")

    fresh = build_fact(only(episodes), only(shows), only(genres), only(cast), timestamps=False, dealt=True, packed=True)
    current = table.read()
    value = F.col(partition_col).cast("string").alias("value")
    held = held_rows(current.select(key, value), keys, key)
    # Values of the partition column, few by choice of the column.
    touched = sorted({v for v, (_, changed) in held.items() if changed} | {r[0] for r in only(shows).select(value).distinct().collect()}, key=lambda v: (v is None, v or ""))
    gone = [held[v] for v in touched if v in held]
    here = F.coalesce(F.col(partition_col).cast("string").isin([v for v in touched if v is not None]), F.lit(False))
    if None in touched:
        here = here | F.col(partition_col).isNull()
    staged, old = fresh.rows().select(*current.columns), None
    if any(rows > changed for rows, changed in gone):  # else no row of a touched partition stays, and none is read
        old = current.filter(here).join(listed, key, "left_anti").select(*current.columns)
        staged = old.unionByName(staged)
    rows_gone = sum(rows for rows, _ in gone)
    return table.replace_partitions(staged, touched, rows_gone=rows_gone, unsorted=True, marks={mark: str(until)}, product=fresh, rest=old)
