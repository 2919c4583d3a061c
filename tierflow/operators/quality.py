"""Data-quality report: every check is one row of a DataFrame.

Columns: ``check, layer, table_name, violations, total, passed``. The checks can be
made one by one; ``silver_report`` makes all of DQ-1 to DQ-6 in one pass that reads each
table once: every table contributes its keys and its rows' violations, and one
aggregate by key settles uniqueness and references on the way. Only ``require``
collects anything: the failed report rows, at most one per check. Schema checks
read only DataFrame schemas.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

REPORT_SCHEMA = StructType(
    [
        StructField("check", StringType(), False),
        StructField("layer", StringType(), False),
        StructField("table_name", StringType(), False),
        StructField("violations", LongType(), True),
        StructField("total", LongType(), True),
        StructField("passed", StringType(), True),
    ]
)


def _finish(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("check"),
        F.col("layer"),
        F.col("table_name"),
        F.col("violations").cast("long").alias("violations"),
        F.col("total").cast("long").alias("total"),
        F.when(F.col("violations") == 0, F.lit("pass")).otherwise(F.lit("fail")).alias("passed"),
    )


def row_checks(df: DataFrame, table: str, layer: str, checks: Mapping[str, Column]) -> DataFrame:
    """Row predicates that flag violations (DQ-1, DQ-3, DQ-4, FLT-4), one aggregate pass."""
    names = list(checks)
    agg = df.agg(
        F.count(F.lit(1)).alias("_total"),
        *[F.sum(F.when(checks[n], 1).otherwise(0)).alias(f"_v{i}") for i, n in enumerate(names)],
    )
    rows = F.explode(
        F.array(
            *[
                F.struct(F.lit(n).alias("check"), F.coalesce(F.col(f"_v{i}"), F.lit(0)).alias("violations"))
                for i, n in enumerate(names)
            ]
        )
    ).alias("_r")
    out = agg.select(F.col("_total").alias("total"), rows).select(
        "_r.check", F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), "_r.violations", "total"
    )
    return _finish(out)


def not_null(df: DataFrame, table: str, layer: str, columns: Iterable[str]) -> DataFrame:
    """DQ-1: key columns must not be NULL."""
    return row_checks(df, table, layer, {f"not_null:{c}": F.col(c).isNull() for c in columns})


def unique_key(df: DataFrame, table: str, layer: str, key: str) -> DataFrame:
    """DQ-2: total rows minus distinct keys (duplicates beyond the first)."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    out = per_key.agg(
        F.sum("_n").alias("total"),
        F.sum(F.col("_n") - 1).alias("violations"),
    ).select(
        F.lit(f"unique:{key}").alias("check"),
        F.lit(layer).alias("layer"),
        F.lit(table).alias("table_name"),
        F.coalesce("violations", F.lit(0)).alias("violations"),
        F.coalesce("total", F.lit(0)).alias("total"),
    )
    return _finish(out)


def referential(child: DataFrame, parent: DataFrame, key: str, table: str, layer: str, parent_name: str) -> DataFrame:
    """DQ-5/DQ-6: child rows whose key has no parent (left-anti semantics)."""
    keys = parent.select(F.col(key).alias("_tf_pk")).distinct().withColumn("_tf_hit", F.lit(True))
    joined = child.select(key).join(keys, F.col(key) == F.col("_tf_pk"), "left")
    out = joined.agg(
        F.count(F.lit(1)).alias("total"),
        F.sum(F.when(F.col("_tf_hit").isNull(), 1).otherwise(0)).alias("violations"),
    ).select(
        F.lit(f"references:{parent_name}.{key}").alias("check"),
        F.lit(layer).alias("layer"),
        F.lit(table).alias("table_name"),
        F.coalesce("violations", F.lit(0)).alias("violations"),
        "total",
    )
    return _finish(out)


def _type_ok(dtype, allowed: tuple) -> bool:
    return isinstance(dtype, allowed)


def schema_checks(
    spark: SparkSession,
    frames: Mapping[str, tuple[str, DataFrame]],
    required: Mapping[str, Iterable[str]],
    types: Mapping[str, Mapping[str, tuple]] | None = None,
    scalar_columns: Mapping[str, Iterable[str]] | None = None,
) -> DataFrame:
    """DQ-8..DQ-13: readable, required columns present, column types, scalar columns.

    Computed from schemas only (no job); the result has one row per check.
    """
    rows = []
    for table, (layer, df) in frames.items():
        fields = {f.name: f.dataType for f in df.schema.fields}
        rows.append(("readable", layer, table, 0 if fields else 1, 1))
        if table in required:
            need = set(required[table])
            rows.append(("required_columns", layer, table, len(need - set(fields)), len(need)))
        for col, allowed in (types or {}).get(table, {}).items():
            ok = col in fields and _type_ok(fields[col], allowed)
            rows.append((f"type:{col}", layer, table, 0 if ok else 1, 1))
        for col in (scalar_columns or {}).get(table, []):
            ok = col in fields and fields[col].typeName() not in {"array", "map", "struct"}
            rows.append((f"scalar:{col}", layer, table, 0 if ok else 1, 1))
    base = spark.createDataFrame(
        rows,
        "check string, layer string, table_name string, violations long, total long",
    )
    return _finish(base)


SILVER_TYPES = {
    "silver_shows": {
        "show_id": (IntegerType, LongType),
        "rating_average": (DoubleType,),
        "runtime": (IntegerType, LongType),
    }
}


SHOW_CHECKS = {
    "not_null:show_id": "show_id IS NULL",
    "rating_range_0_10": "rating_average < 0 OR rating_average > 10",
    "runtime_positive": "runtime <= 0",
}
EPISODE_CHECKS = {"not_null:episode_id": "episode_id IS NULL"}
CAST_CHECKS = {"not_null:person_id": "person_id IS NULL"}


def keyed_report(
    tables: Mapping[str, tuple[DataFrame, Mapping[str, str]]], key: str, parent: str, layer: str
) -> DataFrame:
    """Row checks of several tables, uniqueness of ``key`` in ``parent`` and references of the others to it.

    ``tables``: name -> (frame, check -> SQL predicate of a violation). Each frame is read
    once, its key and predicate columns only. Rows are counted by key (combined in the
    tasks, so a hot key is one row a task): a parent's rows beyond the first of a key
    are duplicates, rows of a key without a parent row, and of no key, are orphans.
    """
    names = list(tables)
    flags = [(t, c) for t in names for c in tables[t][1]]
    zero = F.lit(0).cast("long")

    def rows(t: str) -> DataFrame:
        df, checks = tables[t]
        hit = {c: F.when(F.expr(p), 1).otherwise(0).cast("long") for c, p in checks.items()}
        here = [F.lit(1 if t == other else 0).cast("long").alias(f"_n{i}") for i, other in enumerate(names)]
        return df.select(F.col(key), *here, *[(hit[c] if u == t else zero).alias(f"_v{i}") for i, (u, c) in enumerate(flags)])

    counted = [f"_n{i}" for i in range(len(names))] + [f"_v{i}" for i in range(len(flags))]
    by_key = reduce(DataFrame.unionAll, [rows(t) for t in names]).groupBy(key).agg(*[F.sum(c).alias(c) for c in counted])
    own = F.col(f"_n{names.index(parent)}")
    lost = F.col(key).isNull() | (own == 0)
    totals = by_key.agg(
        *[F.coalesce(F.sum(c), zero).alias(c) for c in counted],
        F.coalesce(F.sum(F.greatest(own - 1, zero)), zero).alias("_repeats"),
        *[F.coalesce(F.sum(F.when(lost, F.col(f"_n{i}"))), zero).alias(f"_lost{i}") for i in range(len(names))],
    )
    checks = [(c, t, f"_v{i}") for i, (t, c) in enumerate(flags)]
    checks.append((f"unique:{key}", parent, "_repeats"))
    checks += [(f"references:{parent}.{key}", t, f"_lost{i}") for i, t in enumerate(names) if t != parent]
    report = F.array(
        *[
            F.struct(F.lit(c).alias("check"), F.lit(layer).alias("layer"), F.lit(t).alias("table_name"), F.col(v).alias("violations"), F.col(f"_n{names.index(t)}").alias("total"))
            for c, t, v in checks
        ]
    )
    return _finish(totals.select(F.inline(report)))


def silver_report(shows: DataFrame, episodes: DataFrame, cast: DataFrame) -> DataFrame:
    """DQ-1..DQ-6 over the Silver tables as one report, each table read once."""
    tables = {"silver_shows": (shows, SHOW_CHECKS), "silver_episodes": (episodes, EPISODE_CHECKS), "silver_cast": (cast, CAST_CHECKS)}
    return keyed_report(tables, "show_id", "silver_shows", "silver")


def corrupt_report(spark: SparkSession, counts: Mapping[str, tuple[int, int]], layer: str = "bronze") -> DataFrame:
    """T-14: corrupt lines of each table, from (corrupt, rows) observed while the tables were written."""
    rows = [("corrupt_lines", layer, table, corrupt, total) for table, (corrupt, total) in counts.items()]
    return _finish(spark.createDataFrame(rows, "check string, layer string, table_name string, violations long, total long"))


def summary(report: DataFrame) -> DataFrame:
    """DQ-14: pass/fail counts."""
    return report.groupBy("passed").agg(F.count(F.lit(1)).alias("checks"))


def inject_nulls(df: DataFrame, column: str, when: Column) -> DataFrame:
    """DQ-7: failure injection -- NULL out ``column`` where ``when`` holds."""
    return df.withColumn(column, F.when(when, F.lit(None)).otherwise(F.col(column)))


class QualityError(AssertionError):
    """Raised by ``require`` when checks fail."""


def require(report: DataFrame, allow: Iterable[str] = ()) -> None:
    """Fail the job when a check fails (the reference's pytest asserts as a gate).

    The report holds one row per check, so collecting its failures is bounded
    by the number of checks, not by the data.
    """
    allowed = set(allow)
    failed = [r for r in report.filter(F.col("passed") == "fail").collect() if r["check"] not in allowed]
    if failed:
        detail = "; ".join(f"{r['table_name']}.{r['check']}: {r['violations']} of {r['total']}" for r in failed)
        raise QualityError(f"{len(failed)} data-quality check(s) failed: {detail}")
