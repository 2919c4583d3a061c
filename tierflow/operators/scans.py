"""Segmented scans: running values and neighbours of window groups of any size.

A window function sorts each group in one task. Here a group of at most
``rows_per_chunk`` rows still does (one shuffle, as the plain window), but the rows of
larger groups are dealt by *row count*:

1. one aggregate counts the rows of each key; keys above the limit are hot. There are at
   most rows / rows_per_chunk of them, and they are broadcast only while that is a small
   number;
2. rows of hot keys are range-partitioned on (keys, order columns), so Spark's sampled
   bounds cut a group wherever its rows are many: sparse and dense order values, ties and
   NULLs alike, because a bound is a value of the whole tuple. Each partition is sorted,
   numbered and checkpointed, so that every reader and every retry sees the same chunks.
   Small chunks share partitions: tasks, and the samples that the driver takes for bounds,
   are bounded by the session's shuffle partitions and ``ROWS_PER_CHUNK``;
3. windows run inside (key, chunk), and a summary of one row for each key and chunk
   (sums, counts, first and last value) carries what lies before and after into them.

Rows that are equal in all keys and order columns stay in one partition; order columns that are
unique within a group, which a scan needs anyway to be reproducible, leave none.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierflow.session import ensure_checkpoint_dir

ROWS_PER_CHUNK = 1_000_000
# Sides of more rows than this are joined without a broadcast hint.
BROADCAST_ROWS = 100_000
_POS = "_tf_pos"
_CHUNK = "_tf_chunk"
# monotonically_increasing_id: the partition stands above this bit, the row in it below.
_CHUNK_BITS = 33


def ordered(c: str | Column, descending: bool = False) -> Column:
    """A sort column with Spark's defaults: ASC NULLS FIRST, DESC NULLS LAST."""
    col = F.col(c) if isinstance(c, str) else c
    return col.desc_nulls_last() if descending else col.asc_nulls_first()


def _prefixed(df: DataFrame, cols: Sequence[str], prefix: str) -> DataFrame:
    return df.withColumnsRenamed({c: f"{prefix}{c}" for c in cols})


def _same(cols: Sequence[str], prefix: str) -> Column:
    """Null-safe equality of columns and their prefixed namesakes."""
    on = F.lit(True)
    for c in cols:
        on = on & F.col(c).eqNullSafe(F.col(f"{prefix}{c}"))
    return on


def join_back(df: DataFrame, side: DataFrame, cols: Sequence[str], how: str = "inner", rows: int | None = None) -> DataFrame:
    """Join on null-safe equal ``cols``; the side, of ``rows`` rows if known, is broadcast only if that is small."""
    right = _prefixed(side, cols, "_tf_k_")
    if rows is not None and rows <= BROADCAST_ROWS:
        right = F.broadcast(right)
    joined = df.join(right, _same(cols, "_tf_k_"), how)
    return joined.drop(*[f"_tf_k_{c}" for c in cols])


@dataclass
class Split:
    """Rows of keys within the limit and of hot keys (None: none), with the counts behind it."""

    cold: DataFrame | None
    hot: DataFrame | None
    hot_rows: int = 0
    hot_keys: int = 0


def split_hot(df: DataFrame, keys: Sequence[str], limit: int, sized_by: DataFrame | None = None) -> Split:
    """Divide df into the rows of keys of at most ``limit`` rows and those of larger keys.

    ``sized_by`` is a cheaper frame with the keys and at least as many rows of each (the
    input before a join or filter); only its key columns are read.
    """
    sizes = (df if sized_by is None else sized_by).groupBy(*keys).agg(F.count(F.lit(1)).alias("_tf_n")).where(F.col("_tf_n") > limit)
    # One job, map-side combined, is all that data without a hot key pays.
    n, rows = sizes.agg(F.count(F.lit(1)), F.sum("_tf_n")).first()
    if not n:
        return Split(df, None)
    ensure_checkpoint_dir(df.sparkSession)
    if not keys:
        return Split(None, df, rows, 1)
    hot = sizes.drop("_tf_n").checkpoint(eager=True)
    return Split(join_back(df, hot, keys, "left_anti", n), join_back(df, hot, keys, "left_semi", n), rows, n)


def chunked(df: DataFrame, keys: Sequence[str], order: Sequence[Column], chunks: int, rows: int | None = None) -> DataFrame:
    """df with ``_tf_pos`` (its place in the order of keys and ``order``) and ``_tf_chunk``, checkpointed.

    Chunks are parts of about equal row counts, in order: range partitions or, where
    ``rows`` of df are known and make more chunks than partitions are due, equal pieces of
    one. A chunk's number is a place, too.
    """
    parts = max(1, chunks)
    if rows is not None:
        parts = min(parts, max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / ROWS_PER_CHUNK)))
    sort = [*[ordered(k) for k in keys], *order]
    dealt = df.repartitionByRange(parts, *sort).sortWithinPartitions(*sort)
    placed = dealt.withColumn(_POS, F.monotonically_increasing_id()).checkpoint(eager=True)
    first = F.shiftleft(F.shiftright(_POS, _CHUNK_BITS), _CHUNK_BITS)
    if parts >= chunks:
        return placed.withColumn(_CHUNK, first)
    return placed.withColumn(_CHUNK, F.col(_POS) - F.pmod(F.col(_POS) - first, F.lit(math.ceil(rows / chunks))))


def _running(window_keys: Sequence[str], order: Sequence[Column], sums, counts, neighbours) -> dict[str, Column]:
    """The plain window forms of the outputs."""
    w = Window.partitionBy(*window_keys).orderBy(*order)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = {name: F.sum(x).over(run) for name, x in sums.items()}
    out |= {name: F.count(x).over(run) for name, x in counts.items()}
    for value, (before, after) in neighbours.items():
        out[before], out[after] = F.lag(value, 1).over(w), F.lead(value, 1).over(w)
    return out


def _scan_hot(rows: DataFrame, keys: list[str], sums, counts, neighbours, summary_rows: int) -> DataFrame:
    """The outputs over chunked rows, stitched from a summary of each (key, chunk)."""
    mine = [*keys, _CHUNK]
    pos = F.col(_POS)
    aggs = [F.sum(x).alias(f"_tf_s{i}") for i, x in enumerate(sums.values())]
    aggs += [F.count(x).alias(f"_tf_c{i}") for i, x in enumerate(counts.values())]
    # A struct keeps a NULL value apart from no value: the neighbour chunk's row counts either way.
    for i, value in enumerate(neighbours):
        aggs += [F.max_by(F.struct(value), pos).alias(f"_tf_z{i}"), F.min_by(F.struct(value), pos).alias(f"_tf_a{i}")]
    per_chunk = Window.partitionBy(*keys).orderBy(_CHUNK)
    before = per_chunk.rowsBetween(Window.unboundedPreceding, -1)
    carried = [F.sum(f"_tf_s{i}").over(before).alias(f"_tf_sb{i}") for i in range(len(sums))]
    carried += [F.coalesce(F.sum(f"_tf_c{i}").over(before), F.lit(0).cast("long")).alias(f"_tf_cb{i}") for i in range(len(counts))]
    for i in range(len(neighbours)):
        carried += [F.lag(f"_tf_z{i}", 1).over(per_chunk).alias(f"_tf_zb{i}"), F.lead(f"_tf_a{i}", 1).over(per_chunk).alias(f"_tf_an{i}")]
    summary = rows.groupBy(*mine).agg(*aggs).select(*mine, *carried)

    w = Window.partitionBy(*mine).orderBy(_POS)
    local = _running(mine, [F.col(_POS)], {f"_tf_ls{i}": x for i, x in enumerate(sums.values())}, {f"_tf_lc{i}": x for i, x in enumerate(counts.values())}, {})
    for i, value in enumerate(neighbours):
        local |= {f"_tf_lp{i}": F.lag(F.struct(value), 1).over(w), f"_tf_ln{i}": F.lead(F.struct(value), 1).over(w)}
    stitched = join_back(rows.withColumns(local), summary, mine, "inner", summary_rows)
    out: dict[str, Column] = {}
    for i, name in enumerate(sums):
        prior, here = F.col(f"_tf_sb{i}"), F.col(f"_tf_ls{i}")
        out[name] = F.when(prior.isNull(), here).when(here.isNull(), prior).otherwise(prior + here)
    for i, name in enumerate(counts):
        out[name] = F.col(f"_tf_cb{i}") + F.col(f"_tf_lc{i}")
    for i, (value, (lag_name, lead_name)) in enumerate(neighbours.items()):
        out[lag_name] = F.coalesce(f"_tf_lp{i}", f"_tf_zb{i}")[value]
        out[lead_name] = F.coalesce(f"_tf_ln{i}", f"_tf_an{i}")[value]
    return stitched.withColumns(out)


def segmented_scan(
    df: DataFrame,
    partition_cols: Sequence[str],
    order_cols: Sequence[str | Column],
    *,
    sums: Mapping[str, Column] | None = None,
    counts: Mapping[str, Column] | None = None,
    neighbours: Mapping[str, tuple[str, str]] | None = None,
    per_key: Sequence[Mapping[str, Column]] = (),
    rows_per_chunk: int = ROWS_PER_CHUNK,
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """Running SUM / COUNT and LAG / LEAD over (PARTITION BY keys ORDER BY order_cols).

    ``sums``/``counts``: output name -> expression, ROWS UNBOUNDED PRECEDING .. CURRENT
    ROW. ``neighbours``: value column -> (lag output, lead output). ``per_key``: steps of
    output name -> aggregate over the whole group; later steps and all other expressions
    may read the outputs of earlier ones. Order columns that are names sort ascending,
    NULLs first; sort columns are taken as they are. ``sized_by``: see ``split_hot``.
    The result has the columns of df and the outputs.
    """
    keys, sums, counts, neighbours = list(partition_cols), dict(sums or {}), dict(counts or {}), dict(neighbours or {})
    order = [ordered(c) if isinstance(c, str) else c for c in order_cols]
    names = [*[n for step in per_key for n in step], *sums, *counts, *[n for pair in neighbours.values() for n in pair]]
    parts = split_hot(df, keys, rows_per_chunk, sized_by)
    done = []
    if parts.cold is not None:
        rows = parts.cold
        for step in per_key:
            rows = rows.withColumns({n: x.over(Window.partitionBy(*keys)) for n, x in step.items()})
        done.append(rows.withColumns(_running(keys, order, sums, counts, neighbours)))
    if parts.hot is not None:
        chunks = math.ceil(parts.hot_rows / rows_per_chunk)
        rows = chunked(parts.hot, keys, order, chunks, parts.hot_rows)
        for step in per_key:
            if keys:
                whole = rows.groupBy(*keys).agg(*[x.alias(n) for n, x in step.items()])
                rows = join_back(rows, whole, keys, "inner", parts.hot_keys)
            else:
                rows = rows.withColumns({n: rows.agg(x).scalar() for n, x in step.items()})
        # A chunk holds parts of at most two hot keys that go on elsewhere, and keys begin and
        # end; each partition, of which there are no more than chunks, may end in a short one.
        done.append(_scan_hot(rows, keys, sums, counts, neighbours, 2 * chunks + parts.hot_keys))
    out = [d.select(*df.columns, *names) for d in done]
    return out[0] if len(out) == 1 else out[0].unionByName(out[1])
