"""Property-based checks: distributed window operators equal plain windows on random data."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tierflow.operators import scans, windows
from tierflow.sources import ingest

ROWS = st.lists(
    st.tuples(
        st.sampled_from([0, 0, 0, 1, 2, None]),  # key 0 is hot; NULL keys included
        st.one_of(st.none(), st.integers(-3, 3).map(float)),  # heavy ties and NULL values
    ),
    min_size=1,
    max_size=40,
)

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _frame(spark, rows):
    data = [(i, k, v) for i, (k, v) in enumerate(rows)]
    return spark.createDataFrame(data, "id long, k int, v double")


@SETTINGS
@given(rows=ROWS, descending=st.booleans(), per_bucket=st.sampled_from([1, 3, 1000]))
def test_keyed_rank_property(spark, rows, descending, per_bucket):
    df = _frame(spark, rows)
    fast = windows.keyed_rank(
        df, "v", ["k"], descending=descending, dense_rank_col="d", rank_col="r", percent_rank_col="p",
        rows_per_chunk=per_bucket,
    )
    o = F.col("v").desc_nulls_last() if descending else F.col("v").asc_nulls_first()
    w = Window.partitionBy("k").orderBy(o)
    slow = df.select("*", F.dense_rank().over(w).alias("d"), F.rank().over(w).alias("r"), F.percent_rank().over(w).alias("p"))
    got = sorted(tuple(r) for r in fast.select("id", "d", "r", "p").collect())
    want = sorted(tuple(r) for r in slow.select("id", "d", "r", "p").collect())
    assert got == want


@SETTINGS
@given(rows=ROWS, width=st.sampled_from([1, 2, 5, 100]))
def test_segmented_scan_property(spark, rows, width):
    df = _frame(spark, rows).withColumn("num", F.when(F.col("id") % 4 == 0, F.lit(None)).otherwise(F.col("id")))
    fast = scans.segmented_scan(
        df, ["k"], ["num", "id"], rows_per_chunk=width,
        sums={"s": F.col("v")}, counts={"c": F.col("v")}, neighbours={"v": ("pv", "nv")},
    )
    w = Window.partitionBy("k").orderBy(F.col("num").asc_nulls_first(), "id")
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    slow = df.select(
        "*", F.sum("v").over(run).alias("s"), F.count("v").over(run).alias("c"),
        F.lag("v").over(w).alias("pv"), F.lead("v").over(w).alias("nv"),
    )
    cols = ["id", "s", "c", "pv", "nv"]
    got = sorted(tuple(r) for r in fast.select(*cols).collect())
    want = sorted(tuple(r) for r in slow.select(*cols).collect())
    assert got == want


def test_reingesting_a_snapshot_is_idempotent(spark, raw_root):
    """Landing identical content under a second snapshot id changes nothing after latest_per_key."""
    from tierflow.schemas import BRONZE_EPISODES
    from tierflow.session import shared_path

    root = shared_path(spark, "raw")
    src = spark.read.schema(BRONZE_EPISODES).json(f"{raw_root}/episodes")
    cols = BRONZE_EPISODES.fieldNames()

    def latest_rows():
        scanned = ingest.scan_json_permissive(spark, f"{root}/episodes", BRONZE_EPISODES)
        # collected now: a lazy frame over the same path would be re-listed later
        return sorted(map(repr, ingest.latest_per_key(scanned, ["id"], ["snapshot"]).select(*cols).collect()))

    ingest.land_snapshot(src, root, "episodes", snapshot="20240101_000000")
    once = latest_rows()
    ingest.land_snapshot(src, root, "episodes", snapshot="20240102_000000")
    twice = latest_rows()
    assert len(once) == src.count() and twice == once
