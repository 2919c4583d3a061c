"""Gold tables and analytic reports on the fixture layer, with hand-computed values."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import rows
from tierflow.operators import gold, reports


def test_episodes_per_season(silver_layer):
    out = gold.episodes_per_season(silver_layer["episodes"], silver_layer["shows"], timestamps=False)
    r = {(x["show_id"], x["season"]): x for x in out.collect()}
    s11 = r[(1, 1)]
    assert s11["episode_count"] == 4 and s11["avg_episode_runtime"] == 59.3  # (60+60+55+62)/4 = 59.25 -> 59.3
    assert s11["avg_season_rating"] == 8.38  # 33.5/4 = 8.375 -> 8.38 (HALF_UP)
    assert s11["season_rank_by_episodes"] == 1 and s11["cumulative_episodes"] == 4
    assert r[(1, 2)]["cumulative_episodes"] == 6 and r[(1, 2)]["season_rank_by_episodes"] == 2
    assert (99, 1) not in r  # orphan show dropped by the inner join


def test_avg_runtime_excludes_zero_runtime(silver_layer):
    out = gold.avg_runtime_per_show(silver_layer["episodes"], silver_layer["shows"], timestamps=False)
    r = {x["show_id"]: x for x in out.collect()}
    assert r[1]["total_episodes"] == 5 and r[1]["min_runtime_minutes"] == 55  # episode 106 (runtime 0) excluded
    assert r[1]["runtime_rank"] == 1 and r[1]["runtime_percentile"] == 0.0  # 59.4 is the longest
    assert r[4]["runtime_rank"] == 3 and r[4]["runtime_percentile"] == 100.0


def test_top_cast_members(silver_layer):
    out = gold.top_cast_members(silver_layer["cast"], timestamps=False)
    r = {x["person_id"]: x for x in out.collect()}
    assert r[1000]["show_count"] == 3 and r[1000]["characters_list"] == "Guest, Hero, Twin"
    assert r[1000]["cast_rank"] == 1 and r[1000]["cast_percentile"] == 0.0
    assert r[1001]["cast_rank"] == 2 and r[1001]["cast_percentile"] == 33.3
    assert r[1000]["image_url"] == "p1"
    distinct = {x["person_id"]: x["show_count"] for x in gold.top_cast_members(silver_layer["cast"], False, True).collect()}
    assert distinct[1000] == 2  # T-5: two characters in show 1 count once


def test_genre_statistics(silver_layer):
    out = gold.genre_statistics(silver_layer["genres"], silver_layer["shows"], timestamps=False)
    r = {x["genre"]: x for x in out.collect()}
    assert r["Unclassified"]["show_count"] == 3 and r["Unclassified"]["genre_rank"] == 1
    assert r["Unclassified"]["genre_share_pct"] == 37.5  # 3 of 8 bridge rows
    assert r["Unclassified"]["avg_genre_rating"] == 4.83  # (0.0 + 6.0 + 8.5) / 3
    assert r["Drama"]["genre_rank"] == 2


def test_show_dashboard_zero_defaults(silver_layer):
    s = silver_layer
    out = gold.show_dashboard(s["shows"], s["episodes"], s["cast"], s["genres"], timestamps=False)
    r = {x["show_id"]: x for x in out.collect()}
    assert r[3]["total_episodes"] == 0 and r[3]["cast_size"] == 0 and r[3]["avg_episode_rating"] == 0
    assert r[1]["total_episodes"] == 6 and r[1]["total_seasons"] == 2 and r[1]["cast_size"] == 3
    assert r[1]["genre_list"] == "Comedy, Drama"
    assert r[5]["overall_rank"] == 1 and r[1]["overall_rank"] == 2 and r[4]["overall_rank"] == 2


def test_best_episode_per_season(silver_layer):
    out = reports.best_episode_per_season(silver_layer["episodes"], silver_layer["shows"])
    r = {(x["show_name"], x["season"], x["episode_number"]): x for x in out.collect()}
    a = r[("Alpha", 1, 2)]
    b = r[("Alpha", 1, 3)]
    assert a["rating_rank"] == b["rating_rank"] == 1 and a["rating_dense_rank"] == 1
    assert (a["rating_row_num"], b["rating_row_num"]) == (1, 2)
    assert a["running_avg_rating"] == 8.5 and abs(b["running_avg_rating"] - 26.0 / 3) < 1e-12
    assert a["prev_episode_rating"] == 8.0 and a["next_episode_rating"] == 9.0 and a["rating_change"] == 1.0
    assert abs(a["rating_percentile"] - 2 / 3) < 1e-12
    single = r[("Beta", 1, 1)]
    assert single["prev_episode_rating"] is None and single["rating_percentile"] == 0.0


def test_season_trajectory_matches_window_form(spark, silver_layer):
    out = reports.season_trajectory(silver_layer["episodes"], silver_layer["shows"])
    got = {(x["show_name"], x["season"]): x["season_trajectory"] for x in out.collect()}
    assert got[("Alpha", 1)] == "Declined"  # 8.0 -> 7.5
    assert got[("Alpha", 2)] == "Declined"  # single rated episode: equal is 'Declined' (T-8)
    assert got[("Delta", 1)] == "Improved"
    window_form = spark.sql(
        """
        SELECT DISTINCT e.show_id, s.show_name, e.season,
          FIRST_VALUE(e.episode_rating) OVER w AS season_premiere_rating,
          LAST_VALUE(e.episode_rating) OVER w AS season_finale_rating
        FROM {e} e JOIN {s} s ON e.show_id = s.show_id WHERE e.episode_rating > 0
        WINDOW w AS (PARTITION BY e.show_id, e.season ORDER BY e.episode_number, e.episode_id
                     ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
        """,
        e=silver_layer["episodes"],
        s=silver_layer["shows"],
    )
    assert rows(out, "show_name", "season", "season_premiere_rating", "season_finale_rating") == rows(
        window_form, "show_name", "season", "season_premiere_rating", "season_finale_rating"
    )


def test_show_report_pre_aggregated_equals_literal(spark, silver_layer):
    s = silver_layer
    fast = reports.show_report(s["shows"], s["episodes"], s["cast"], s["genres"], top_n=None)
    wide = s["shows"].join(s["episodes"].drop("show_name"), "show_id").join(s["cast"].select("show_id", "person_id"), "show_id", "left")
    wide = wide.join(s["genres"].select("show_id", "genre"), "show_id", "left")
    literal = wide.groupBy("show_id", "show_name").agg(
        F.count_distinct("episode_id").alias("total_episodes"),
        F.count_distinct("season").alias("total_seasons"),
        F.min("airdate").alias("first_aired"),
        F.max("airdate").alias("last_aired"),
        F.count_distinct("person_id").alias("cast_size"),
        F.concat_ws(", ", F.array_sort(F.collect_set("genre"))).alias("genres"),
    )
    cols = ["show_name", "total_episodes", "total_seasons", "first_aired", "last_aired", "cast_size", "genres"]
    assert rows(fast, *cols) == rows(literal, *cols)
    assert fast.filter(F.col("show_name") == "Alpha").first()["avg_runtime_min"] == 49.5  # 297 / 6: zero runtimes count (T-4)


def test_network_comparison(silver_layer):
    s = silver_layer
    out = reports.network_comparison(s["shows"], s["episodes"], s["cast"], min_shows=1)
    r = {x["network"]: x for x in out.collect()}
    assert r["NetA"]["total_shows"] == 2 and r["NetA"]["total_episodes_produced"] == 8
    assert r["StreamX"]["total_shows"] == 1  # COALESCE(network, web channel)
    assert r["Unknown"]["total_episodes_produced"] is None  # show 3 has no episodes (T-16)
    assert "NetA" not in {x["network"] for x in reports.network_comparison(s["shows"], s["episodes"], s["cast"], 3).collect()}


def test_above_average_forms(spark, silver_layer):
    s = silver_layer
    correlated = {x["show_name"]: x for x in reports.above_average_all(s["shows"], s["episodes"], s["cast"]).collect()}
    cte = {x["show_name"]: x for x in reports.above_average_cte(s["shows"], s["episodes"], s["cast"]).collect()}
    # all-shows average = (8.5+0+6+8.5+12.5)/5 = 7.1; rated-only = 35.5/4 = 8.875 (T-6)
    assert set(correlated) == {"Alpha", "Delta", "Epsilon"}
    assert set(cte) == {"Epsilon"}
    assert correlated["Epsilon"]["ep_count"] == 0 and correlated["Epsilon"]["avg_rt"] is None
    assert cte["Epsilon"]["episode_count"] == 0 and cte["Epsilon"]["avg_runtime"] == 0.0
    assert correlated["Alpha"]["cast_sz"] == 2


def test_reports_come_sorted(silver_layer):
    s = silver_layer
    for out, names in (
        (reports.best_episode_per_season(s["episodes"], s["shows"]), ("show_name", "season", "rating_row_num")),
        (reports.season_trajectory(s["episodes"], s["shows"]), ("show_name", "season")),
    ):
        got = [tuple(r[n] for n in names) for r in out.collect()]
        assert got == sorted(got)
    for out, value, name in (
        (reports.network_comparison(s["shows"], s["episodes"], s["cast"], 1), "avg_show_rating", "network"),
        (reports.above_average_all(s["shows"], s["episodes"], s["cast"]), "rating_average", "show_name"),
        (reports.above_average_cte(s["shows"], s["episodes"], s["cast"]), "rating_average", "show_name"),
    ):
        got = [(-r[value], r[name]) for r in out.collect()]
        assert got == sorted(got)


def test_character_pages_of_a_person_of_millions_of_credits(spark):
    """One person with three million credits, most of one character; pages hold the list in order."""
    name = F.when(F.col("id") % 3 > 0, F.lit("Host")).when(F.col("id") % 9 == 0, F.lit(None)).otherwise(F.concat(F.lit("Guest "), (F.col("id") % 5000).cast("string")))
    hot = spark.range(3_000_000).select(F.lit(1).cast("long").alias("person_id"), name.alias("character_name"))
    few = spark.createDataFrame([(2, "b"), (2, "a"), (2, "a"), (2, None), (3, None)], "person_id long, character_name string")
    pages = gold.character_pages(hot.union(few), page_items=1000, rows_per_chunk=500).cache()
    shape = pages.filter("person_id = 1").agg(F.count("*"), F.min("items"), F.max("items"), F.sum("items"), F.max("page")).first()
    named = hot.filter("character_name is not null").count()
    assert tuple(shape) == (-(-named // 1000), named % 1000 or 1000, 1000, named, (named - 1) // 1000)
    assert [tuple(r) for r in pages.filter("person_id > 1").collect()] == [(2, 0, 3, "a, a, b")]
    # The pages in order are the sorted list.
    texts = [r[0] for r in pages.filter("person_id = 1").orderBy("page").select("characters").collect()]
    names = [n for t in texts for n in t.split(", ")]
    assert len(names) == named and names == sorted(names)
