"""Window and join operators: distributed forms equal their naive formulations."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from conftest import rows
from pyspark.sql import Window
from tierflow.operators import joins, scans, windows


def plain_ranks(df, metric, keys=(), *, descending=True, dense_rank_col=None, rank_col=None, percent_rank_col=None):
    """Window functions over whole groups."""
    w = Window.partitionBy(*keys).orderBy(scans.ordered(metric, descending))
    forms = {dense_rank_col: F.dense_rank(), rank_col: F.rank(), percent_rank_col: F.percent_rank()}
    return df.withColumns({n: f.over(w) for n, f in forms.items() if n})


def equal_rows(a, b):
    """Same rows, repeated ones included."""
    a = a.select(*b.columns)
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0


def _metric_frame(spark):
    data = [(i, v) for i, v in enumerate([5.0, 3.0, 3.0, None, 9.5, -1.0, 3.0, None, 0.0, 9.5, 7.25, -1.0])]
    return spark.createDataFrame(data, "id long, m double")


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("rows_per_chunk", [1, 2, 1_000_000])
def test_global_rank_equals_single_partition_window(spark, descending, rows_per_chunk):
    df = _metric_frame(spark)
    kw = dict(dense_rank_col="d", rank_col="r", percent_rank_col="p")
    fast = windows.global_rank(df, "m", descending=descending, rows_per_chunk=rows_per_chunk, **kw)
    slow = plain_ranks(df, "m", descending=descending, **kw)
    a = {r["id"]: (r["d"], r["r"], round(r["p"], 12)) for r in fast.collect()}
    b = {r["id"]: (r["d"], r["r"], round(r["p"], 12)) for r in slow.collect()}
    assert a == b


def test_global_rank_on_driver_table(spark):
    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet").select("event_id", F.floor("value").alias("v"))
    kw = dict(dense_rank_col="d", rank_col="r", percent_rank_col="p")
    fast = windows.global_rank(ev, "v", rows_per_chunk=40, **kw)
    slow = plain_ranks(ev, "v", **kw)
    assert fast.exceptAll(slow.select(*fast.columns)).count() == 0


def test_global_rank_single_row(spark):
    df = spark.createDataFrame([(1, 2.0)], "id long, m double")
    r = windows.global_rank(df, "m", dense_rank_col="d", percent_rank_col="p").first()
    assert r["d"] == 1 and r["p"] == 0.0


def test_share_of_total(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3)], "k string, n long")
    got = {r["k"]: r["s"] for r in windows.share_of_total(df, "n", "s").collect()}
    assert got == {"a": 25.0, "b": 75.0}


def test_top_per_group_keeps_ties(spark):
    df = spark.createDataFrame([(1, 1, 9.0), (1, 2, 9.0), (1, 3, 1.0), (2, 4, 3.0)], "g int, id int, v double")
    out = windows.top_per_group(df, ["g"], "v")
    assert sorted(r["id"] for r in out.collect()) == [1, 2, 4]
    more = spark.createDataFrame([(None, 1, None), (None, 2, None), (3, 3, None), (3, 4, 1.0), (3, 5, float("nan")), (3, 6, float("nan"))], "g int, id int, v double")
    for descending, expected in ((True, [1, 2, 5, 6]), (False, [1, 2, 3])):
        w = Window.partitionBy("g").orderBy(scans.ordered("v", descending))
        slow = more.withColumn("r", F.rank().over(w)).filter("r = 1")
        got = sorted(r["id"] for r in windows.top_per_group(more, ["g"], "v", descending).collect())
        assert got == sorted(r["id"] for r in slow.collect()) == expected


def _skewed(spark):
    # key 7 holds a third of the rows, NULL a twentieth, the others two hundredths each at most
    k = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 20 == 1, F.lit(None)).otherwise(F.col("id") % 50)
    return spark.range(0, 5000).select(F.col("id").alias("row"), k.alias("k"))


def test_salted_join_equals_plain_join(spark):
    big, small = _skewed(spark), spark.range(0, 60).select(F.col("id").alias("k"), (F.col("id") * 10).alias("payload"))
    for how in ("inner", "left", "left_semi", "left_anti"):
        for side in (small, small.filter("k < 10"), small.union(small)):
            plain = big.join(side, "k", how)
            for share in (0.03, 0.5):  # two hot keys, or none
                salted = joins.salted_join(big, side, "k", buckets=8, how=how, salt_cols=["row"], share=share)
                assert sorted(salted.columns) == sorted(plain.columns)
                equal_rows(salted, plain)


def test_only_heavy_hitters_are_replicated(spark):
    big, small = _skewed(spark), spark.range(0, 60).select(F.col("id").alias("k"), (F.col("id") * 10).alias("payload"))
    hot = joins.heavy_hitters(big, "k", 0.03)
    exact = big.groupBy("k").count().filter("count >= 150").select(joins.key_hash("k").alias("h"))
    assert sorted(hot) == sorted(r["h"] for r in exact.collect()) and len(hot) == 2
    copies = joins.replicate_hot(small, "k", hot, 8, "salt")
    assert copies.count() == 60 + 7 and {r["k"] for r in copies.filter("salt > 0").collect()} == {7}
    assert joins.heavy_hitters(big, ["k", "row"], 0.01) == [] and joins.heavy_hitters(big.limit(0), "k") == []
    # The salted big side: no (key, salt) holds much more than a share of the hot key.
    salt = F.when(joins.key_hash("k").isin(hot), joins.hash_salt(["row"], 8)).otherwise(F.lit(0))
    assert big.groupBy("k", salt).count().agg(F.max("count")).first()[0] < 1700 / 8 * 1.3


def test_distinct_counts_without_expand(spark):
    from tierflow.operators.reports import distinct_counts

    df = _events_with_hot_key(spark).withColumn("k", F.when(F.col("k") == 5, F.lit(None)).otherwise(F.col("k")))
    names = {"dn": "num", "dv": "v", "di": "id"}
    fast = distinct_counts(df, ["k"], names, [F.count(F.lit(1)).alias("n")])
    equal_rows(fast, df.groupBy("k").agg(F.count(F.lit(1)).alias("n"), *[F.count_distinct(c).alias(n) for n, c in names.items()]))
    assert "Expand" not in fast._jdf.queryExecution().executedPlan().toString()


def test_salted_join_rejects_right_outer(spark):
    df = spark.range(3)
    with pytest.raises(ValueError):
        joins.salted_join(df, df, "id", how="right")


def test_enrich_policies(spark):
    fact = spark.range(0, 100).select((F.col("id") % 10).alias("k"), F.col("id"))
    dim = spark.range(0, 10).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for policy in ("auto", "always", "checked"):
        assert joins.enrich(fact, dim, "k", "inner", broadcast=policy).count() == 100
    assert joins.fits_broadcast(dim, 1000) and not joins.fits_broadcast(dim, 50)  # 10 rows of two longs
    plan = joins.enrich(fact, dim, "k", broadcast="always")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_orphans(silver_layer):
    out = joins.orphans(silver_layer["episodes"], silver_layer["shows"], "show_id")
    assert rows(out, "episode_id") == [(901,)]


def test_above_scalar(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 5.0), (3, 9.0)], "id int, v double")
    avg = df.agg(F.avg("v").alias("a"))
    assert sorted(r["id"] for r in joins.above_scalar(df, "v", avg, "a").collect()) == [3]


def test_rounded_avg_is_exact_half_up(spark):
    from tierflow.functions.columns import rounded_avg

    df = spark.createDataFrame([(1, 1.01), (1, 1.02), (2, 0.15), (2, 0.15), (3, -2.5), (3, -2.5)], "g int, x double")
    got = {r["g"]: r["a"] for r in df.groupBy("g").agg(rounded_avg("x", 2, fractional=True).alias("a")).collect()}
    assert got[1] == 1.02  # 1.015 -> HALF_UP
    got1 = {r["g"]: r["a"] for r in df.groupBy("g").agg(rounded_avg("x", 1, fractional=True).alias("a")).collect()}
    assert got1[2] == 0.2 and got1[3] == -2.5
    got0 = {r["g"]: r["a"] for r in df.groupBy("g").agg(rounded_avg("x", 0, fractional=True).alias("a")).collect()}
    assert got0[3] == -3.0 and not math.isnan(got0[1])
    fine = spark.createDataFrame([(8.125,), (8.126,), (None,)], "x double")
    assert fine.agg(rounded_avg("x", 3, fractional=True)).first()[0] == 8.126  # 8.1255, not 8.13
    assert fine.agg(rounded_avg("x", 2, fractional=True)).first()[0] == 8.13
    assert fine.limit(0).agg(rounded_avg("x", 2, fractional=True)).first()[0] is None


def _events_with_hot_key(spark):
    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    # key 0 holds every third row (a third of the table); NULL values and NULL order keys included
    return ev.select(
        F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id") % 7 + 1).alias("k"),
        F.when(F.col("event_id") % 11 == 0, F.lit(None)).otherwise(F.col("event_id")).alias("num"),
        F.col("event_id").alias("id"),
        F.when(F.col("value") < 1, F.lit(None)).otherwise(F.floor("value")).alias("v"),
    )


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("rows_per_chunk", [30, 1_000_000])
def test_keyed_rank_equals_partitioned_window(spark, descending, rows_per_chunk):
    df = _events_with_hot_key(spark)
    kw = dict(descending=descending, dense_rank_col="d", rank_col="r", percent_rank_col="p")
    equal_rows(windows.keyed_rank(df, "v", ["k"], rows_per_chunk=rows_per_chunk, **kw), plain_ranks(df, "v", ["k"], **kw))


# First order columns as SQL; the second is the id.
ORDERS = {
    "sparse": "id * 1000003",
    "dense": "id % 50",
    "tied": "1",
    "null": "cast(null as long)",
    "mixed": "if(id % 11 = 0, null, id % 700)",
    "text": "concat('a long common prefix ', id)",
    "struct": "named_struct('a', 7, 'b', -id)",
}


def _scan_args(order):
    return dict(
        order_cols=order,
        sums={"rs": F.col("v")},
        counts={"rc": F.col("v"), "top": F.when(F.col("v") == F.col("best"), 1)},
        neighbours={"v": ("prev_v", "next_v")},
        per_key=[{"best": F.max("v"), "n": F.count(F.lit(1))}, {"n_best": F.count(F.when(F.col("v") == F.col("best"), 1))}],
    )


def _plain_scan(df, keys, order):
    whole, w = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy(*[scans.ordered(c) if isinstance(c, str) else c for c in order])
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = df.withColumns({"best": F.max("v").over(whole), "n": F.count(F.lit(1)).over(whole)})
    is_best = F.when(F.col("v") == F.col("best"), 1)
    return out.withColumns(
        {
            "n_best": F.count(is_best).over(whole),
            "rs": F.sum("v").over(run),
            "rc": F.count("v").over(run),
            "top": F.count(is_best).over(run),
            "prev_v": F.lag("v", 1).over(w),
            "next_v": F.lead("v", 1).over(w),
        }
    )


@pytest.mark.parametrize("kind", list(ORDERS))
def test_segmented_scan_equals_window(spark, kind):
    """Hot and small keys, a NULL key, chunks of several keys; and no chunk has much more than its share."""
    k = F.when(F.col("k") == 5, F.lit(None)).otherwise(F.col("k"))
    df = _events_with_hot_key(spark).select(k.alias("k"), "id", "v", F.expr(ORDERS[kind]).alias("o1"), F.col("id").alias("o2"))
    fast = scans.segmented_scan(df, ["k"], rows_per_chunk=400, **_scan_args(["o1", "o2"]))
    equal_rows(fast, _plain_scan(df, ["k"], ["o1", "o2"]))
    hot = scans.split_hot(df, ["k"], 400)
    chunks = scans.chunked(hot.hot, ["k"], [scans.ordered("o1"), scans.ordered("o2")], math.ceil(hot.hot_rows / 400))
    sizes = [r[1] for r in chunks.groupBy("_tf_chunk").count().collect()]
    assert max(sizes) <= 2 * 400 and len(sizes) >= hot.hot_rows / 800


def test_segmented_scan_descending_whole_table_and_empty(spark):
    df = _events_with_hot_key(spark)
    order = [F.col("num").desc_nulls_last(), F.col("id").asc()]
    for limit in (300, 10**6):
        equal_rows(scans.segmented_scan(df, ["k"], rows_per_chunk=limit, **_scan_args(order)), _plain_scan(df, ["k"], order))
        equal_rows(scans.segmented_scan(df, [], rows_per_chunk=limit, **_scan_args(["num", "id"])), _plain_scan(df, [], ["num", "id"]))
    assert scans.segmented_scan(df.filter("id < 0"), ["k"], rows_per_chunk=1, **_scan_args(["num", "id"])).count() == 0


def test_small_groups_cost_one_shuffle(spark):
    df = _events_with_hot_key(spark)
    plan = scans.segmented_scan(df, ["k"], **_scan_args(["num", "id"]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


@pytest.mark.parametrize("rows_per_chunk", [200, 1_000_000])
def test_rank_family_equals_windows(spark, rows_per_chunk):
    df = _events_with_hot_key(spark)
    fast = windows.rank_family(df, ["k"], "v", ["id"], rows_per_chunk=rows_per_chunk)
    slow = plain_ranks(df, "v", ["k"], rank_col="rating_rank", dense_rank_col="rating_dense_rank")
    w = Window.partitionBy("k").orderBy(F.col("v").desc_nulls_last(), F.col("id"))
    equal_rows(fast, slow.withColumn("rating_row_num", F.row_number().over(w)))


def test_first_last_by_equals_windows(spark):
    df = _events_with_hot_key(spark)
    w = Window.partitionBy("k").orderBy(F.col("num").asc_nulls_first(), F.col("id")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    slow = df.withColumns({"f": F.first("v").over(w), "l": F.last("v").over(w)})
    equal_rows(windows.first_last_by(df, ["k"], ["num", "id"], "v", "f", "l"), slow)


def test_global_rank_on_dates_strings_and_structs(spark):
    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet").select(
        "event_id", F.to_date("ts").alias("day"), F.col("event_type").alias("kind"), F.struct("event_type", "user_id").alias("both")
    )
    for metric in ("day", "kind", "both"):
        kw = dict(dense_rank_col="d", rank_col="r", percent_rank_col="p")
        equal_rows(windows.global_rank(ev, metric, rows_per_chunk=3 if metric != "both" else 100, **kw), plain_ranks(ev, metric, **kw))


@pytest.mark.parametrize("descending", [True, False])
def test_global_rank_splits_strings(spark, descending):
    names = [f"show#{i:05d}" for i in range(60)] + ["show#", "show#é", "show#\U0001f600", "show#00007", None, None]
    df = spark.createDataFrame(list(enumerate(names)), "id long, m string")
    kw = dict(descending=descending, dense_rank_col="d", rank_col="r")
    equal_rows(windows.global_rank(df, "m", rows_per_chunk=5, **kw), plain_ranks(df, "m", **kw))
    for odd in ([(0, None)], [(0, "")], []):
        few = spark.createDataFrame(odd, "id long, m string")
        assert windows.global_rank(few, "m", rows_per_chunk=1, **kw).count() == len(odd)


def test_best_episode_of_a_hot_season(spark):
    """R-4 with a season cut into chunks equals the same report over whole seasons."""
    from tierflow.operators import reports
    from tierflow.plans import adapters as A

    eps = A.episodes(spark, "/root/testdata/sf0.01").withColumn("show_id", F.when(F.col("episode_id") % 3 == 0, F.lit(1).cast("long")).otherwise(F.col("show_id")))
    eps = eps.withColumn("season", F.when(F.col("show_id") == 1, F.lit(1)).otherwise(F.col("season")))
    # A third of all rows in one season, most of them tied at the top.
    eps = eps.withColumn("episode_rating", F.when((F.col("show_id") == 1) & (F.col("episode_id") % 5 > 0), F.lit(1e9)).otherwise(F.col("episode_rating")))
    shows = A.shows(spark, "/root/testdata/sf0.01")
    cut = reports.best_episode_per_season(eps, shows, rows_per_chunk=150)
    equal_rows(cut, reports.best_episode_per_season(eps, shows))
    assert cut.filter("rating_row_num > 2000").count() > 0


def test_averages_of_odd_values(spark):
    from tierflow.functions.columns import beyond_exact, exact, exact_avg, rounded_avg

    inf, nan = float("inf"), float("nan")
    data = {
        "plain": ([1.005, 2.0, None, -3.5], -0.17),
        "negative": ([-1.25, -1.26], -1.26),
        "nan": ([1.0, nan, 2e18, 3.0], nan),
        "inf": ([1.0, inf], inf),
        "both": ([inf, -inf], nan),
        "large": ([2e18, 4e18, 1.0], 2e18),
        "tenth": ([0.1] * 10, 0.1),
        "decimals": ([9007199254740991.0, -9007199254740991.0, 0.5], 0.17),
        "limbs": ([899999999.25, -899999999.5, 0.25, -0.75], -0.19),
        "none": ([None], None),
    }
    rows_ = [(k, v) for k, (vs, _) in data.items() for v in vs]
    got = spark.createDataFrame(rows_, "k string, x double").groupBy("k").agg(rounded_avg("x", 2, fractional=True).alias("a"), exact_avg("x").alias("e")).collect()
    for r in got:
        want = data[r["k"]][1]
        if want is None or math.isnan(want):
            assert (r["a"] is None and r["e"] is None) if want is None else (math.isnan(r["a"]) and math.isnan(r["e"]))
        else:
            assert r["a"] == want and (r["e"] == want or abs(r["e"] - want) <= 0.0051 * max(1, abs(want)))
    parts = spark.createDataFrame([(1.5,), (nan,), (inf,), (1e16,), (None,)], "x double").select(exact("x").alias("e"), beyond_exact("x").alias("b")).collect()
    assert [(p["e"] is not None, p["b"] is not None) for p in parts] == [(True, False), (False, True), (False, True), (True, False), (False, False)]
