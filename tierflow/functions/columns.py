"""Column-level helpers built only from JVM-side Spark expressions.

Nothing here is a UDF: every helper returns a ``Column`` that stays inside
whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_cast(c: ColumnOrName, dtype: str) -> Column:
    """ANSI-safe cast: malformed input becomes NULL instead of failing the job."""
    return _c(c).try_cast(dtype)


def safe_date(c: ColumnOrName, fmt: str = "yyyy-MM-dd") -> Column:
    """``to_date`` that yields NULL for '', 'bad' or off-pattern strings."""
    return F.try_to_date(_c(c), fmt)


def default(c: ColumnOrName, *fallbacks) -> Column:
    """``coalesce`` chain; plain Python values become literals."""
    parts = [_c(c)] + [f if isinstance(f, Column) else F.lit(f) for f in fallbacks]
    return F.coalesce(*parts)


# Values below this size are summed exactly to ten places; the rest are added as doubles.
EXACT_BELOW = 1e18
# Below this size ten places of a value fit a 64-bit integer.
LONG_BELOW = 9e8


def _countable(col: Column) -> Column:
    """Whether a double is finite and below EXACT_BELOW in size (NULL stays NULL)."""
    return F.abs(col) < EXACT_BELOW


def exact(c: ColumnOrName) -> Column:
    """A fractional value to ten places as a decimal, so that sums do not depend on their order; NULL if it is not countable."""
    col = _c(c).cast("double")
    return F.when(_countable(col), col.cast("decimal(28,10)"))


def beyond_exact(c: ColumnOrName) -> Column:
    """The values ``exact`` leaves out, as doubles: NaN, infinities and those of 1e18 and more in size."""
    col = _c(c).cast("double")
    return F.when(~_countable(col) | F.isnan(col), col)


def exact_total(c: ColumnOrName) -> tuple[Column, Column]:
    """Aggregates: the exact sum to ten places of the countable values of ``c``, and the double sum of the others (NULL: none).

    A sum of decimals adds 38-digit numbers row by row. Here values below ``LONG_BELOW`` are
    integers of 1e-10, summed in three limbs of 22 bits, which 2**41 rows cannot overflow, and
    put together once a group; only larger ones are decimals.
    """
    col = _c(c).cast("double")
    short = F.abs(col) < LONG_BELOW
    units = F.when(short, F.round(col * 1e10).cast("long"))
    mask = F.lit((1 << 22) - 1)
    limbs = [F.sum(F.shiftright(units, 44)), F.sum(F.shiftright(units, 22).bitwiseAND(mask)), F.sum(units.bitwiseAND(mask))]
    high, middle, low = [F.coalesce(x, F.lit(0).cast("long")).cast("decimal(19,0)") for x in limbs]
    step = F.lit(1 << 22).cast("decimal(7,0)")
    total = (((high * step + middle).cast("decimal(29,0)") * step + low).cast("decimal(37,0)") * F.lit("0.0000000001").cast("decimal(10,10)")).cast("decimal(38,10)")
    long = F.coalesce(F.sum(F.when(~short & _countable(col), col.cast("decimal(28,10)"))), F.lit(0).cast("decimal(38,10)"))
    return (total + long).cast("decimal(38,10)"), F.sum(beyond_exact(c))


def exact_avg(c: ColumnOrName) -> Column:
    """Aggregate: the average as a double that does not depend on the order of the rows (see ``rounded_avg``)."""
    total, others = exact_total(c)
    n = F.count(_c(c)).cast("double")
    return F.try_divide(total.cast("double") + F.coalesce(others, F.lit(0.0)), n)


def rounded_avg(c: ColumnOrName, digits: int, fractional: bool = False) -> Column:
    """Aggregate: ``round(avg(c), digits)`` that is reproducible at any partitioning.

    A double ``avg`` sums in shuffle-arrival order, so its last bits (and thus
    a HALF_UP rounding at an exact .5 boundary) change with the number of
    tasks. Here whole numbers are summed as 64-bit integers and ``fractional``
    values exactly to ten places; the quotient is rounded HALF_UP, so it has
    the same bits on one task or a thousand. NULLs are ignored as in ``avg``. Values of
    1e18 and more in size, infinities and NaN are added as doubles, as ``avg`` does: NaN
    and infinities give what ``avg`` gives, and only for such large values does the last
    bit depend on the order.
    """
    if fractional:
        total, others = exact_total(c)
        quotient = F.try_divide(total, F.count(_c(c)).cast("decimal(19,0)"))
        return F.when(others.isNull(), F.round(quotient, digits).cast("double")).otherwise(F.round(exact_avg(c), digits))
    num = F.sum(_c(c).cast("long")) * F.lit(10 ** digits)
    quotient = F.try_divide(num.cast("double"), F.count(_c(c)).cast("double"))
    return F.round(quotient, 0) / F.lit(float(10 ** digits))


def sorted_list_string(c: ColumnOrName, sep: str = ", ", distinct: bool = False) -> Column:
    """Aggregate: deterministic ``concat_ws`` of a collected list (or set).

    ``collect_list`` alone depends on shuffle arrival order; sorting makes the
    value reproducible across runs and engines.
    """
    collected = F.collect_set(_c(c)) if distinct else F.collect_list(_c(c))
    return F.concat_ws(sep, F.array_sort(collected))


def repeated_list_string(value: ColumnOrName, count: ColumnOrName, sep: str = ", ") -> Column:
    """Aggregate over pre-counted (value, count) rows.

    Produces the same string as ``sorted_list_string`` over the raw rows, but
    the aggregation buffer holds one entry per distinct value instead of one
    per row, so a hot group does not materialise its rows in one task.
    """
    pairs = F.array_sort(F.collect_list(F.struct(_c(value).alias("v"), _c(count).alias("n"))))
    expanded = F.flatten(F.transform(pairs, lambda p: F.array_repeat(p["v"], p["n"].cast("int"))))
    return F.concat_ws(sep, expanded)


def order_preserving_double(dtype: str, c: ColumnOrName) -> Column | None:
    """A double that sorts like ``c`` (for quantile cut points), or None.

    Numbers cast to double (monotone; ties may merge, which only coarsens
    buckets), dates map to days and timestamps to microseconds since the epoch.
    Strings and structs have none.
    """
    col = _c(c)
    if dtype in {"tinyint", "smallint", "int", "bigint", "float", "double"} or dtype.startswith("decimal"):
        return col.cast("double")
    if dtype == "date":
        return F.unix_date(col).cast("double")
    if dtype in {"timestamp", "timestamp_ntz"}:
        return F.unix_micros(col.cast("timestamp")).cast("double")
    return None


def hash_salt(cols: Iterable[ColumnOrName], buckets: int) -> Column:
    """Deterministic salt in [0, buckets): stable under task retries.

    A ``rand()`` salt is re-drawn when a lost task is recomputed, so a retried
    partition can route rows to different join partners.
    """
    return F.pmod(F.xxhash64(*[_c(c) for c in cols]), F.lit(buckets)).cast("int")


def salt_range(buckets: int) -> Column:
    """Array column ``[0, buckets)`` to replicate the small side of a salted join."""
    return F.sequence(F.lit(0), F.lit(buckets - 1))


def interleave_bits(codes: list[Column], bits: int) -> Column:
    """Morton (Z-order) key from non-negative integer codes of ``bits`` bits each.

    Built from ``shiftleft``/``bitwise_or``/``&``; no UDF. ``len(codes) * bits``
    must stay below 63.
    """
    if len(codes) * bits > 62:
        raise ValueError("Z-key would overflow a signed 64-bit long")
    key = F.lit(0).cast("long")
    n = len(codes)
    for bit in range(bits):
        for i, code in enumerate(codes):
            b = F.shiftright(code.cast("long"), bit).bitwiseAND(F.lit(1))
            key = key.bitwiseOR(F.shiftleft(b, bit * n + i))
    return key
