"""Join strategies: enrichment, salted skew join, anti join, scalar-threshold join.

Broadcast policy: a side is broadcast only when its size is bounded.
``broadcast="always"`` is for dimensions whose size does not grow with the
data (nation, region); ``"checked"`` broadcasts only when the
optimizer's size bound of the side is within ``max_bytes``;
``"auto"`` adds no hint and lets AQE decide from the runtime size of the
shuffled side (``spark.sql.adaptive.autoBroadcastJoinThreshold``).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.functions.columns import hash_salt, salt_range

BROADCAST_BYTE_LIMIT = 64 * 1024 * 1024
# A key with this share of the rows is hot; frequent-items sketches track so many keys.
HOT_SHARE = 0.01
TRACKED_KEYS = 10_000


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTE_LIMIT) -> bool:
    """Whether the optimizer's size bound of ``df`` is within ``max_bytes``; runs no job.

    The bound comes from file sizes and grows with joins, so a side whose size
    Spark cannot bound is never broadcast here and is left to AQE.
    """
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= max_bytes


def enrich(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str] | Column,
    how: str = "inner",
    broadcast: str = "auto",
    max_bytes: int = BROADCAST_BYTE_LIMIT,
) -> DataFrame:
    """J-1/J-2/J-3: equi-join a fact to a dimension with an explicit broadcast policy."""
    if broadcast not in {"auto", "always", "checked"}:
        raise ValueError(f"unknown broadcast policy {broadcast}")
    if broadcast == "always" or (broadcast == "checked" and fits_broadcast(right, max_bytes)):
        right = F.broadcast(right)
    return left.join(right, on, how)


def replicate(df: DataFrame, copies: int, col: str = "salt") -> DataFrame:
    """J-5: one copy of each row per salt value in ``[0, copies)``.

    ``explode(sequence(...))`` is a narrow generator; it replaces the
    reference's cross join with a broadcast ``range``.
    """
    return df.withColumn(col, F.explode(salt_range(copies)))


def heavy_hitters(df: DataFrame, key: str | Sequence[str], share: float = HOT_SHARE, tracked: int = TRACKED_KEYS) -> list[int]:
    """Hashes of the keys that hold about ``share`` of the rows or more.

    One aggregate of frequent-items sketches, which track at most ``tracked`` keys a task and
    err by a few times rows / tracked, far below ``share``; at most 1 / share hashes reach
    the driver. A hash, not the key, is what ``key_hash`` compares, so keys of any type do.
    """
    most = math.ceil(1 / share)
    found = df.select(key_hash(key).alias("h")).agg(F.expr(f"approx_top_k(h, {most}, {tracked})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    return [t["item"] for t in found["top"] or [] if t["count"] >= share * found["n"]]


def key_hash(key: str | Sequence[str]) -> Column:
    return F.xxhash64(*([key] if isinstance(key, str) else key))


def replicate_hot(small: DataFrame, key: str | Sequence[str], hot: Sequence[int], buckets: int, salt_name: str) -> DataFrame:
    """The small side with a salt: rows of hot keys once for each salt, all others once with salt 0."""
    salts = F.when(key_hash(key).isin(list(hot)), salt_range(buckets)).otherwise(F.array(F.lit(0)))
    return small.withColumn(salt_name, F.explode(salts))


def salted_join(
    big: DataFrame,
    small: DataFrame,
    key: str | Sequence[str],
    buckets: int = 8,
    how: str = "inner",
    salt_cols: Sequence[str] | None = None,
    salt_name: str = "_tf_salt",
    share: float = HOT_SHARE,
) -> DataFrame:
    """J-4: skew-tolerant equi-join that salts hot keys only.

    ``heavy_hitters`` finds the keys that hold ``share`` of the big side or more. Their
    rows get a salt derived from a hash of ``salt_cols`` (default: all columns of
    the big side), so a hot key is spread over ``buckets`` partitions, and their rows
    of the small side are replicated once per salt; all other rows have salt 0 and are not
    copied. Which keys are hot changes the cost, never the result. Hash salts
    are stable under task retries (a ``rand()`` salt is not), and joining on
    the composite key keeps a single copy of the key column in the output.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if how not in {"inner", "left", "left_outer", "left_semi", "left_anti"}:
        raise ValueError("salting replicates the right side: only inner/left joins preserve semantics")
    hot = heavy_hitters(big, keys, share)
    if not hot:
        return big.join(small, keys, how)
    cols = list(salt_cols) if salt_cols else big.columns
    salt = F.when(key_hash(keys).isin(hot), hash_salt(cols, buckets)).otherwise(F.lit(0))
    salted_small = replicate_hot(small, keys, hot, buckets, salt_name)
    return big.withColumn(salt_name, salt).join(salted_small, keys + [salt_name], how).drop(salt_name)


def orphans(child: DataFrame, parent: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """J-16: child rows whose key has no parent (LEFT ANTI JOIN)."""
    keys = [key] if isinstance(key, str) else list(key)
    return child.join(parent.select(*keys), keys, "left_anti")


def above_scalar(df: DataFrame, value_col: str, scalar: DataFrame, scalar_col: str) -> DataFrame:
    """J-6/FLT-9: keep rows whose value exceeds a one-row aggregate.

    The aggregate is an uncorrelated scalar subquery (``DataFrame.scalar()``),
    computed once and inlined into the filter: no cross or nested-loop join.
    The threshold is kept as a column, like the reference's CROSS JOIN output.
    """
    threshold = scalar.select(scalar_col).scalar()
    return df.filter(F.col(value_col) > threshold).withColumn(scalar_col, threshold)
