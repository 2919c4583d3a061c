"""Table management: writes, views, listings, counts and clustered layout.

Tables are Parquet (no Delta jar on OSS Spark). A path-backed table is
registered in the session catalog when a name is given, so SQL can address it.
Row counts of a write are observed *during* the write (``Observation``)
instead of re-running the lineage with ``count()`` afterwards.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import AbstractContextManager, contextmanager
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tierflow.functions.columns import hash_salt, interleave_bits, order_preserving_double
from tierflow.sinks.products import Product, write_product

WRITE_SALTS = 8
# Files a task may have open, and the size of the part of each that it holds in memory.
OPEN_FILES, OPEN_FILE_BYTES = 8, 32 * 1024 * 1024


def ensure_schema(spark: SparkSession, schema: str) -> None:
    """SNK-6: CREATE SCHEMA IF NOT EXISTS (catalog level is cluster configuration)."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")


def write_table(
    df: DataFrame,
    path: str,
    *,
    name: str | None = None,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    rebalance: bool = False,
    unsorted: bool = False,
    dynamic_overwrite: bool = False,
    metrics: Mapping[str, Column] | None = None,
    measured: dict[str, object] | None = None,
    product: Product | None = None,
    rest: DataFrame | None = None,
) -> int:
    """SNK-1/2/3: write Parquet (optionally partitioned); return the rows written.

    ``metrics`` (name -> aggregate) are observed during the write and put into ``measured``.

    ``rebalance`` shuffles rows by the partition columns and a salt of ``WRITE_SALTS`` and
    lets AQE split large parts and join small ones: a value has at most as many files as
    salts until its parts outgrow AQE's size, and few values still keep all cores busy
    (shuffled bytes say little about the work of encoding repeated strings).
    ``unsorted`` is for rows that come in runs of few partition values a task: up to
    ``OPEN_FILES`` files stay open in a task, and only rows of further values are sorted.
    ``dynamic_overwrite`` replaces only the partitions present in ``df``.
    ``product`` says what packed rows ``df`` is made of, all but its rows ``rest``; the
    files are then written from those (see ``write_product``), where that can be done.
    """
    if product is not None and not (name or rebalance or dynamic_overwrite or metrics):
        made = write_product(product, path, partition_by, mode)
        if made is not None:
            more = 0 if rest is None else write_table(rest, path, mode="append", partition_by=partition_by, unsorted=unsorted)
            return made + more
    obs = Observation("tierflow_write")
    more = [m.alias(n) for n, m in (metrics or {}).items()]
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"), *more)
    if partition_by and rebalance:
        salted = observed.withColumn("_tf_salt", hash_salt(df.columns, WRITE_SALTS))
        observed = salted.hint("rebalance", *partition_by, "_tf_salt").drop("_tf_salt")
    writer = observed.write.mode(mode).format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if dynamic_overwrite:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    with _open_files(df.sparkSession, OPEN_FILES if partition_by and unsorted else 0) as several:
        if several:
            writer = writer.option("parquet.block.size", OPEN_FILE_BYTES)
        if name:
            writer.option("path", path).saveAsTable(name)
        else:
            writer.save(path)
    rows = observed_rows(obs)
    if measured is not None:
        measured.update({n: obs.get[n] if rows else None for n in metrics or {}})
    return rows


@contextmanager
def session_settings(spark: SparkSession, settings: Mapping[str, int | str]) -> Iterator[None]:
    """The session has these settings in here, and its own again after."""
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def brief_shuffles(spark: SparkSession) -> AbstractContextManager[None]:
    """In here the shuffle files of a query are removed when it ends, not only when the driver next collects garbage."""
    return session_settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


@contextmanager
def _open_files(spark: SparkSession, files: int) -> Iterator[int]:
    """Writes in here keep up to ``files`` files open in a task instead of sorting its rows (0: as the session has it)."""
    with session_settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": files} if files else {}):
        yield files


def observed_rows(obs: Observation) -> int:
    """The observed count ``rows`` of an action that ran.

    Of a plan that Spark knows to be empty it drops the metrics too; reading them then
    fails an assertion in the JVM.
    """
    try:
        return int(obs.get.get("rows", 0))
    except Py4JJavaError as none:
        if "AssertionError" not in str(none.java_exception.getClass()):
            raise
        return 0


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def publish_view(spark: SparkSession, view: str, source: str | DataFrame, temporary: bool = True) -> DataFrame:
    """SNK-5: CREATE OR REPLACE VIEW over a table (or a temp view over a DataFrame)."""
    if isinstance(source, DataFrame):
        source.createOrReplaceTempView(view)
    else:
        kind = "TEMPORARY VIEW" if temporary else "VIEW"
        spark.sql(f"CREATE OR REPLACE {kind} {view} AS SELECT * FROM {source}")
    return spark.table(view)


def list_tables(spark: SparkSession, schema: str | None = None) -> DataFrame:
    """SNK-7: SHOW TABLES as a DataFrame."""
    return spark.sql(f"SHOW TABLES IN {schema}" if schema else "SHOW TABLES")


def describe_table(spark: SparkSession, name: str) -> DataFrame:
    """SNK-11: DESCRIBE EXTENDED."""
    return spark.sql(f"DESCRIBE EXTENDED {name}")


def layer_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """SNK-9/AGG-18: row count per table as one DataFrame (one job, one row per table)."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count") for n, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def _cut_points(df: DataFrame, columns: Sequence[str], levels: int) -> dict[str, list[float]]:
    """Approximate quantiles of all orderable columns in one aggregate: ``levels - 1`` numbers a column at most."""
    kinds = dict(df.dtypes)
    numbers = {c: x for c in columns if (x := order_preserving_double(kinds[c], c)) is not None}
    if not numbers:
        return {}
    grid = [i / levels for i in range(1, levels)]
    found = df.agg(*[F.percentile_approx(x, grid, 10000).alias(f"c{i}") for i, x in enumerate(numbers.values())]).first()
    return {c: sorted({float(x) for x in found[i] or [] if x is not None and math.isfinite(x)}) for i, c in enumerate(numbers)}


def z_order_key(df: DataFrame, columns: Sequence[str], bits: int = 10, key: str = "_tf_z") -> DataFrame:
    """Morton key over rank-bucketed columns (no UDF; Bucketizer is JVM-side).

    Types without an order as numbers get a hash code, which still puts equal values together.
    The buckets of a column of few values are spread over all codes, so its highest bits
    count as much as any other column's.
    """
    bits = min(bits, 62 // max(1, len(columns)))
    cuts = _cut_points(df, columns, 2 ** bits)
    out = df
    codes: list[Column] = []
    for i, c in enumerate(columns):
        code_col = f"_tf_code{i}"
        spread = 1
        if c not in cuts:
            out = out.withColumn(code_col, F.pmod(F.xxhash64(F.col(c)), F.lit(2 ** bits)))
        else:
            tmp = f"_tf_num{i}"
            number = order_preserving_double(dict(df.dtypes)[c], c)
            out = out.withColumn(tmp, F.coalesce(number, F.lit(-math.inf)))
            out = Bucketizer(
                splits=[-math.inf] + cuts[c] + [math.inf], inputCol=tmp, outputCol=code_col, handleInvalid="keep"
            ).transform(out).drop(tmp)
            spread = max(1, 2 ** bits // (len(cuts[c]) + 1))
        codes.append(F.least(F.col(code_col).cast("long") * spread, F.lit(2 ** bits - 1)))
    out = out.withColumn(key, interleave_bits(codes, bits))
    return out.drop(*[f"_tf_code{i}" for i in range(len(columns))])


def file_sizes(df: DataFrame) -> DataFrame:
    """(file, bytes) of the files of a table just read, one row a file."""
    return df.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")).distinct()


def compact_table(spark: SparkSession, path: str, target: str, target_bytes: int = 256 * 1024 * 1024) -> int:
    """Rewrite a table of many small files into files of about ``target_bytes``; return the rows.

    The number of files follows the table's size; whole input splits are put together
    without a shuffle. Write to a new path, as ``cluster_table``.
    """
    df = spark.read.parquet(path)
    total = file_sizes(df).agg(F.sum("bytes")).first()[0] or 0
    return write_table(df.coalesce(max(1, math.ceil(total / target_bytes))), target)


def cluster_table(
    df: DataFrame,
    columns: Sequence[str],
    path: str,
    files: int | None = None,
    bits: int = 10,
    name: str | None = None,
    partition_by: Sequence[str] = (),
    unpack: Callable[[DataFrame], DataFrame | Product] | None = None,
) -> int:
    """SNK-8: OPTIMIZE ... ZORDER BY re-aimed as a clustered rewrite.

    Rows are range-partitioned on (partition columns, Morton key of the
    clustering columns) and sorted within each file, so Parquet row-group
    min/max statistics become selective for filters on any of the columns
    (and, for a partitioned table, each partition value gets its own runs of
    files). Returns rows written. Write to a new path: never read and
    overwrite the same path in one job.

    ``unpack`` makes the table's rows (or says as a ``Product`` how they are made), in
    order, from those of ``df``, which stand for many rows of equal partition and
    clustering columns each: only ``df`` is shuffled.
    """
    keyed = z_order_key(df, columns, bits)
    order = [*partition_by, "_tf_z"]
    if unpack is not None and files is None:  # a fixed number: packed bytes say little of the rows, AQE would join them
        files = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    count = [] if files is None else [files]  # by default as many as the session's shuffle partitions
    laid_out = keyed.repartitionByRange(*count, *order).sortWithinPartitions(*order).drop("_tf_z")
    rows = unpack(laid_out) if unpack else laid_out
    product = rows if isinstance(rows, Product) else None
    return write_table(product.rows() if product else rows, path, name=name, partition_by=partition_by, unsorted=unpack is not None, product=product)
