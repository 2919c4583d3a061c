"""Window analytics: ranks, running aggregates, offsets, and global ranks that scale.

A window with no PARTITION BY (the reference's global ``dense_rank`` and
``percent_rank`` over a whole table) makes Spark move every row into one task.
``keyed_rank`` computes the same numbers without that single task:

1. aggregate the rows to their *distinct (key, value) pairs* with row counts (map-side
   partial aggregation, so a hot value costs one row), checkpointed in
   ``spark.checkpoint.dir`` so that all readers share one computation;
2. a segmented scan over these pairs gives each value's running number (``dense_rank``)
   and the rows up to it (``rank``). Keys with many distinct values are cut by row
   count with Spark's range partitioning, which compares whole values: any orderable
   type is divided, long common prefixes and structs included, into as many parts as its
   rows need;
3. join the ranks back to the rows on (key, value), null-safe.

Ranks are 64-bit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierflow.operators.scans import ROWS_PER_CHUNK, join_back, ordered, segmented_scan, split_hot
from tierflow.session import ensure_checkpoint_dir


def global_rank(
    df: DataFrame,
    metric: str,
    *,
    descending: bool = True,
    dense_rank_col: str | None = None,
    rank_col: str | None = None,
    percent_rank_col: str | None = None,
    rows_per_chunk: int = ROWS_PER_CHUNK,
    materialize_input: bool = False,
) -> DataFrame:
    """Whole-table ``dense_rank`` / ``rank`` / ``percent_rank`` over ``metric``.

    Equal to the single-partition window functions (ties share a rank, NULLs
    tie with each other and sort last when descending, first when ascending).
    """
    return keyed_rank(
        df,
        metric,
        (),
        descending=descending,
        dense_rank_col=dense_rank_col,
        rank_col=rank_col,
        percent_rank_col=percent_rank_col,
        rows_per_chunk=rows_per_chunk,
        materialize_input=materialize_input,
    )


def keyed_rank(
    df: DataFrame,
    metric: str,
    partition_cols: Sequence[str] = (),
    *,
    descending: bool = True,
    dense_rank_col: str | None = None,
    rank_col: str | None = None,
    percent_rank_col: str | None = None,
    rows_per_chunk: int = ROWS_PER_CHUNK,
    materialize_input: bool = False,
) -> DataFrame:
    """``dense_rank``/``rank``/``percent_rank`` OVER (PARTITION BY keys ORDER BY metric).

    No task sorts more than about ``rows_per_chunk`` distinct values, however many a
    key has. With no keys this is ``global_rank``.

    ``materialize_input=True`` checkpoints ``df`` itself (worth it when ``df``
    is an expensive aggregate that would otherwise be computed twice: once for
    the ranks and once for the rows they are joined back to).
    """
    keys = list(partition_cols)
    ensure_checkpoint_dir(df.sparkSession)
    if materialize_input:
        df = df.checkpoint(eager=True)
    vals = df.groupBy(*keys, metric).agg(F.count(F.lit(1)).alias("_tf_rows"))
    if not materialize_input:
        vals = vals.checkpoint(eager=True)
    scanned = segmented_scan(
        vals,
        keys,
        [ordered(metric, descending)],
        sums={"_tf_upto": F.col("_tf_rows")},
        counts={"_tf_dense": F.lit(1)},
        per_key=[{"_tf_total": F.sum("_tf_rows")}] if percent_rank_col else [],
        rows_per_chunk=rows_per_chunk,
    )
    rank = F.col("_tf_upto") - F.col("_tf_rows") + 1
    outputs: dict[str, Column] = {}
    if dense_rank_col:
        outputs[dense_rank_col] = F.col("_tf_dense")
    if rank_col:
        outputs[rank_col] = rank
    if percent_rank_col:
        share = (rank - 1) / (F.col("_tf_total") - 1)
        outputs[percent_rank_col] = F.when(F.col("_tf_total") > 1, share).otherwise(F.lit(0.0))
    ranks = scanned.select(*keys, metric, *[c.alias(n) for n, c in outputs.items()])
    return join_back(df, ranks, [*keys, metric])


def share_of_total(df: DataFrame, value_col: str, out_col: str, scale: float = 100.0, digits: int | None = 1) -> DataFrame:
    """WIN-5: ``value / sum(value) over () * scale`` without a window or a join.

    The grand total is an uncorrelated scalar subquery (``DataFrame.scalar()``):
    one partially aggregated job whose single value is inlined into the
    projection, instead of an empty-partition window over the whole table.
    """
    total = df.agg(F.sum(value_col)).scalar()
    share = F.col(value_col) / total * F.lit(scale)
    if digits is not None:
        share = F.round(share, digits)
    return df.withColumn(out_col, share)


def rank_family(
    df: DataFrame,
    partition_cols: Sequence[str],
    metric: str,
    tiebreak: Sequence[str],
    *,
    descending: bool = True,
    prefix: str = "rating",
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """WIN-6..8: rank, dense_rank and row_number; ties are numbered by ``tiebreak``, unique within a value.

    Keys of at most ``rows_per_chunk`` rows take the window functions over one shuffle.
    For hot keys the ranks come from the distinct (key, value) pairs and row_number from
    a segmented scan.
    """
    keys = list(partition_cols)
    names = [f"{prefix}_rank", f"{prefix}_dense_rank", f"{prefix}_row_num"]
    by_value = ordered(metric, descending)
    parts = split_hot(df, keys, rows_per_chunk)
    done = []
    if parts.cold is not None:
        ties = Window.partitionBy(*keys).orderBy(by_value)
        unique = Window.partitionBy(*keys).orderBy(by_value, *[ordered(c) for c in tiebreak])
        windows = [F.rank().over(ties), F.dense_rank().over(ties), F.row_number().over(unique)]
        done.append(parts.cold.withColumns({n: w.cast("long") for n, w in zip(names, windows, strict=True)}))
    if parts.hot is not None:
        ranked = keyed_rank(parts.hot, metric, keys, descending=descending, rank_col=names[0], dense_rank_col=names[1], rows_per_chunk=rows_per_chunk)
        done.append(segmented_scan(ranked, keys, [by_value, *tiebreak], counts={names[2]: F.lit(1)}, rows_per_chunk=rows_per_chunk, sized_by=parts.hot))
    out = [d.select(*df.columns, *names) for d in done]
    return out[0] if len(out) == 1 else out[0].unionByName(out[1])


def first_last_by(
    df: DataFrame, partition_cols: Sequence[str], order_cols: Sequence[str], value: str, first_col: str, last_col: str
) -> DataFrame:
    """WIN-14/15 as an aggregate: FIRST_VALUE/LAST_VALUE over the full frame.

    ``min_by``/``max_by`` on the struct of the order columns (NULL fields sort
    first, as ASC NULLS FIRST) combine map-side, then join back on the key.
    """
    keys = list(partition_cols)
    order = F.struct(*[F.col(c) for c in order_cols])
    bounds = df.groupBy(*keys).agg(F.min_by(F.col(value), order).alias(first_col), F.max_by(F.col(value), order).alias(last_col))
    return join_back(df, bounds, keys)


def running_aggregate(
    df: DataFrame, partition_cols: Sequence[str], order: Sequence[Column], value: str, out_col: str, fn=F.avg
) -> DataFrame:
    """WIN-2/WIN-9: ``fn(value)`` over ROWS UNBOUNDED PRECEDING .. CURRENT ROW (plain window: for small groups)."""
    w = Window.partitionBy(*partition_cols).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(out_col, fn(value).over(w))


def top_per_group(df: DataFrame, partition_cols: Sequence[str], metric: str, descending: bool = True) -> DataFrame:
    """WIN-16: the rows ranked first in their group, ties kept (``rank() = 1``), in two phases.

    The leading value of a group is an aggregate (partial in each task), then the rows
    that hold it are picked by an equi-join; a group of any size, all of it tied
    even, is sorted nowhere. NULL leads only where the order puts it first.
    """
    keys = list(partition_cols)
    value = F.struct(F.col(metric))  # in a struct NULL is a value, the smallest
    best = F.max(value) if descending else F.min(value)
    leaders = df.groupBy(*keys).agg(best.alias("_tf_best")).select(*keys, F.col("_tf_best")[metric].alias(metric))
    return join_back(df, leaders, [*keys, metric], "left_semi")
