"""Operator-level queries: joins (J-*), aggregates (AGG-*), windows (WIN-*), sort/limit."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tierflow.functions.columns import exact, rounded_avg, sorted_list_string
from tierflow.operators import joins, windows
from tierflow.operators.reports import distinct_counts
from tierflow.operators.scans import segmented_scan
from tierflow.plans import adapters as A
from tierflow.plans.oracle_base import oracle, ravg
from tierflow.plans.registry import register

# ---------------------------------------------------------------- joins


@register(
    "join_broadcast_inner",
    oracle(
        """
SELECT e.*, s.show_name, s.language, s.runtime
FROM episodes e JOIN shows s ON e.show_id = s.show_id
"""
    ),
)
def q_join_broadcast_inner(spark, sf):
    """J-1: episodes x shows, shows broadcast after a bounded size check."""
    shows = A.shows(spark, sf).select("show_id", "show_name", "language", "runtime")
    return joins.enrich(A.episodes(spark, sf), shows, "show_id", "inner", broadcast="checked")


@register(
    "join_broadcast_left",
    oracle(
        """
SELECT e.episode_id, e.show_id, e.season, g.genre
FROM episodes e LEFT JOIN genres g ON e.show_id = g.show_id
"""
    ),
)
def q_join_broadcast_left(spark, sf):
    """J-2: 1 -> n fan-out left join to the genre bridge (checked broadcast)."""
    ep = A.episodes(spark, sf).select("episode_id", "show_id", "season")
    ge = A.genres(spark, sf).select("show_id", "genre")
    return joins.enrich(ep, ge, "show_id", "left", broadcast="checked")


@register(
    "join_left_fanout",
    oracle(
        """
SELECT s.show_id, s.show_name, c.person_id, c.character_name
FROM shows s LEFT JOIN credits c ON s.show_id = c.show_id
"""
    ),
)
def q_join_left_fanout(spark, sf):
    """J-3: un-hinted n -> m left join; AQE chooses the strategy at runtime."""
    sh = A.shows(spark, sf).select("show_id", "show_name")
    ca = A.cast(spark, sf).select("show_id", "person_id", "character_name")
    return joins.enrich(sh, ca, "show_id", "left", broadcast="auto")


@register(
    "join_salted",
    oracle(
        """
SELECT e.episode_id, e.show_id, e.season, e.episode_rating, s.show_name, s.language
FROM episodes e JOIN shows s ON e.show_id = s.show_id
"""
    ),
)
def q_join_salted(spark, sf):
    """J-4/J-5: join that salts the heavy hitters on (show_id, salt); equals the plain join as a multiset."""
    ep = A.episodes(spark, sf).select("episode_id", "show_id", "season", "episode_rating")
    sh = A.shows(spark, sf).select("show_id", "show_name", "language")
    return joins.salted_join(ep, sh, "show_id", buckets=4, salt_cols=["episode_id"], share=0.007)


@register(
    "join_cross_scalar",
    oracle(
        """
SELECT s.show_id, s.show_name, s.rating_average, a.overall_avg
FROM shows s CROSS JOIN (SELECT AVG(rating_average) AS overall_avg FROM shows WHERE rating_average > 0) a
WHERE s.rating_average > a.overall_avg
"""
    ),
)
def q_join_cross_scalar(spark, sf):
    """J-6/FLT-9: theta join against a one-row aggregate."""
    sh = A.shows(spark, sf).select("show_id", "show_name", "rating_average")
    overall = sh.filter(F.col("rating_average") > 0).agg(F.avg("rating_average").alias("overall_avg"))
    return joins.above_scalar(sh, "rating_average", overall, "overall_avg")


@register(
    "join_left_anti",
    oracle("SELECT s.show_id, s.show_name FROM shows s WHERE NOT EXISTS (SELECT 1 FROM episodes e WHERE e.show_id = s.show_id)"),
)
def q_join_left_anti(spark, sf):
    """J-16: shows without any episode (LEFT ANTI JOIN)."""
    return joins.orphans(A.shows(spark, sf).select("show_id", "show_name"), A.episodes(spark, sf), "show_id")


@register(
    "join_pre_aggregates",
    oracle(
        """
SELECT s.show_id, s.show_name,
       COALESCE(e.n, 0) AS episode_rows, COALESCE(c.n, 0) AS cast_rows, COALESCE(g.n, 0) AS genre_rows
FROM shows s
LEFT JOIN (SELECT show_id, count(*) AS n FROM episodes GROUP BY show_id) e ON s.show_id = e.show_id
LEFT JOIN (SELECT show_id, count(*) AS n FROM credits GROUP BY show_id) c ON s.show_id = c.show_id
LEFT JOIN (SELECT show_id, count(*) AS n FROM genres GROUP BY show_id) g ON s.show_id = g.show_id
"""
    ),
)
def q_join_pre_aggregates(spark, sf):
    """J-7/J-10/J-13/J-14: left joins of per-key pre-aggregates (no fan-out)."""
    def per_show(df, name):
        return df.groupBy("show_id").agg(F.count(F.lit(1)).alias(name))

    out = (
        A.shows(spark, sf).select("show_id", "show_name")
        .join(per_show(A.episodes(spark, sf), "episode_rows"), "show_id", "left")
        .join(per_show(A.cast(spark, sf), "cast_rows"), "show_id", "left")
        .join(per_show(A.genres(spark, sf), "genre_rows"), "show_id", "left")
    )
    return out.fillna(0, subset=["episode_rows", "cast_rows", "genre_rows"])


@register(
    "correlated_scalar",
    oracle(
        """
SELECT s.show_id,
       (SELECT max(e.episode_rating) FROM episodes e WHERE e.show_id = s.show_id) AS best_rating,
       (SELECT count(*) FROM credits c WHERE c.show_id = s.show_id) AS credit_rows
FROM shows s
WHERE s.rating_average > (SELECT avg(rating_average) FROM shows)
"""
    ),
)
def q_correlated_scalar(spark, sf):
    """J-15: correlated scalar subqueries, decorrelated by Catalyst into left joins."""
    return spark.sql(
        """
        SELECT s.show_id,
               (SELECT max(e.episode_rating) FROM {e} e WHERE e.show_id = s.show_id) AS best_rating,
               (SELECT count(*) FROM {c} c WHERE c.show_id = s.show_id) AS credit_rows
        FROM {s} s
        WHERE s.rating_average > (SELECT avg(rating_average) FROM {s})
        """,
        s=A.shows(spark, sf),
        e=A.episodes(spark, sf),
        c=A.cast(spark, sf),
    )


# ----------------------------------------------------------- aggregates


@register(
    "agg_by_key",
    oracle(
        f"""
SELECT show_id, count(episode_id) AS episodes, count(*) AS row_count,
       {ravg("episode_rating", 2)} AS avg_rating, CAST(sum(episode_runtime) AS BIGINT) AS total_runtime,
       min(airdate) AS first_aired, max(airdate) AS last_aired, min(episode_runtime) AS min_runtime,
       max(episode_runtime) AS max_runtime
FROM episodes GROUP BY show_id
"""
    ),
)
def q_agg_by_key(spark, sf):
    """AGG-1/4/5/7/9/10: one-key aggregate with partial (map-side) aggregation."""
    return A.episodes(spark, sf).groupBy("show_id").agg(
        F.count("episode_id").alias("episodes"),
        F.count(F.lit(1)).alias("row_count"),
        rounded_avg("episode_rating", 2, fractional=True).alias("avg_rating"),
        F.sum("episode_runtime").alias("total_runtime"),
        F.min("airdate").alias("first_aired"),
        F.max("airdate").alias("last_aired"),
        F.min("episode_runtime").alias("min_runtime"),
        F.max("episode_runtime").alias("max_runtime"),
    )


@register(
    "agg_composite",
    oracle(
        f"""
SELECT show_id, season, count(*) AS episodes, {ravg("episode_runtime", 1)} AS avg_runtime,
       {ravg("episode_rating", 0)} AS avg_rating_0dp
FROM episodes GROUP BY show_id, season
"""
    ),
)
def q_agg_composite(spark, sf):
    """AGG-2/AGG-7: composite-key aggregate with averages rounded to 1 and 0 decimals."""
    return A.episodes(spark, sf).groupBy("show_id", "season").agg(
        F.count(F.lit(1)).alias("episodes"),
        rounded_avg("episode_runtime", 1).alias("avg_runtime"),
        rounded_avg("episode_rating", 0, fractional=True).alias("avg_rating_0dp"),
    )


@register(
    "agg_multi_distinct",
    oracle(
        """
SELECT show_id, count(DISTINCT episode_id) AS distinct_episodes, count(DISTINCT season) AS distinct_seasons,
       count(DISTINCT episode_type) AS distinct_types
FROM episodes GROUP BY show_id
"""
    ),
)
def q_agg_multi_distinct(spark, sf):
    """AGG-6: three COUNT(DISTINCT) over different columns, a two-level aggregate each (no Expand)."""
    columns = {"distinct_episodes": "episode_id", "distinct_seasons": "season", "distinct_types": "episode_type"}
    return distinct_counts(A.episodes(spark, sf), ["show_id"], columns)


@register(
    "agg_collect_list",
    oracle(
        """
SELECT show_id, COALESCE(string_agg(genre, ', ' ORDER BY genre), '') AS genre_list
FROM genres GROUP BY show_id
"""
    ),
)
def q_agg_collect_list(spark, sf):
    """AGG-12/FN-12: sorted ``concat_ws`` of ``collect_list`` per key."""
    return A.genres(spark, sf).groupBy("show_id").agg(sorted_list_string("genre").alias("genre_list"))


@register(
    "agg_collect_set",
    oracle(
        """
SELECT show_id, season, COALESCE(string_agg(DISTINCT episode_type, ', ' ORDER BY episode_type), '') AS types
FROM episodes GROUP BY show_id, season
"""
    ),
)
def q_agg_collect_set(spark, sf):
    """AGG-13: sorted ``concat_ws`` of ``collect_set`` per key (bounded by distinct values)."""
    return A.episodes(spark, sf).groupBy("show_id", "season").agg(
        sorted_list_string("episode_type", distinct=True).alias("types")
    )


@register(
    "agg_global",
    oracle(
        f"""
SELECT count(*) AS shows, count(*) FILTER (WHERE rating_average > 0) AS rated_shows,
       {ravg("CASE WHEN rating_average > 0 THEN rating_average END", 2)} AS avg_rated,
       min(rating_average) AS min_rating, max(rating_average) AS max_rating
FROM shows
"""
    ),
)
def q_agg_global(spark, sf):
    """AGG-15: one-row global aggregate."""
    rated = F.when(F.col("rating_average") > 0, F.col("rating_average"))
    return A.shows(spark, sf).agg(
        F.count(F.lit(1)).alias("shows"),
        F.count(rated).alias("rated_shows"),
        rounded_avg(rated, 2, fractional=True).alias("avg_rated"),
        F.min("rating_average").alias("min_rating"),
        F.max("rating_average").alias("max_rating"),
    )


@register("distinct_rows", oracle("SELECT DISTINCT show_id, season FROM episodes"))
def q_distinct_rows(spark, sf):
    """AGG-16: SELECT DISTINCT."""
    return A.episodes(spark, sf).select("show_id", "season").distinct()


@register("drop_duplicates", oracle("SELECT DISTINCT show_id, cast_name, character_name FROM credits"))
def q_drop_duplicates(spark, sf):
    """AGG-17: dropDuplicates over all columns of a projection."""
    return A.cast(spark, sf).select("show_id", "cast_name", "character_name").dropDuplicates()


# -------------------------------------------------------------- windows

W_SEASON = "PARTITION BY show_id, season"
W_NUM = f"{W_SEASON} ORDER BY episode_number ASC NULLS FIRST, episode_id"


@register(
    "win_dense_rank",
    oracle(
        """
SELECT show_id, season, episodes,
       CAST(dense_rank() OVER (PARTITION BY show_id ORDER BY episodes DESC) AS INTEGER) AS season_rank
FROM (SELECT show_id, season, count(*) AS episodes FROM episodes GROUP BY show_id, season)
"""
    ),
)
def q_win_dense_rank(spark, sf):
    """WIN-1: dense_rank within a partition."""
    per = A.episodes(spark, sf).groupBy("show_id", "season").agg(F.count(F.lit(1)).alias("episodes"))
    return per.withColumn("season_rank", F.dense_rank().over(Window.partitionBy("show_id").orderBy(F.desc("episodes"))))


@register(
    "win_cumulative_sum",
    oracle(
        """
SELECT show_id, season, episodes,
       CAST(sum(episodes) OVER (PARTITION BY show_id ORDER BY season
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulative_episodes
FROM (SELECT show_id, season, count(*) AS episodes FROM episodes GROUP BY show_id, season)
"""
    ),
)
def q_win_cumulative_sum(spark, sf):
    """WIN-2: running sum, ROWS UNBOUNDED PRECEDING .. CURRENT ROW."""
    per = A.episodes(spark, sf).groupBy("show_id", "season").agg(F.count(F.lit(1)).alias("episodes"))
    return windows.running_aggregate(per, ["show_id"], [F.col("season")], "episodes", "cumulative_episodes", fn=F.sum)


@register(
    "win_global_rank",
    oracle(
        """
SELECT show_id, rating_average,
       dense_rank() OVER (ORDER BY rating_average DESC NULLS LAST) AS dense_rank,
       rank() OVER (ORDER BY rating_average DESC NULLS LAST) AS rank,
       percent_rank() OVER (ORDER BY rating_average DESC NULLS LAST) AS percent_rank
FROM shows
"""
    ),
)
def q_win_global_rank(spark, sf):
    """WIN-3/WIN-4: whole-table ranks without a single-partition window."""
    return windows.global_rank(
        A.shows(spark, sf).select("show_id", "rating_average"),
        "rating_average",
        dense_rank_col="dense_rank",
        rank_col="rank",
        percent_rank_col="percent_rank",
        rows_per_chunk=100,
    )


@register(
    "win_global_rank_runtime",
    oracle(
        """
SELECT episode_id, episode_runtime,
       dense_rank() OVER (ORDER BY episode_runtime ASC NULLS FIRST) AS dense_rank,
       rank() OVER (ORDER BY episode_runtime ASC NULLS FIRST) AS rank,
       percent_rank() OVER (ORDER BY episode_runtime ASC NULLS FIRST) AS percent_rank
FROM episodes
"""
    ),
)
def q_win_global_rank_runtime(spark, sf):
    """WIN-3/WIN-4 ascending, heavy ties (few distinct runtimes across all episodes)."""
    return windows.global_rank(
        A.episodes(spark, sf).select("episode_id", "episode_runtime"),
        "episode_runtime",
        descending=False,
        dense_rank_col="dense_rank",
        rank_col="rank",
        percent_rank_col="percent_rank",
        rows_per_chunk=50,
    )


@register(
    "win_global_rank_text",
    oracle(
        """
SELECT show_id, show_name,
       dense_rank() OVER (ORDER BY show_name ASC NULLS FIRST) AS dense_rank,
       rank() OVER (ORDER BY show_name ASC NULLS FIRST) AS rank
FROM shows
"""
    ),
)
def q_win_global_rank_text(spark, sf):
    """WIN-3/WIN-4 over a string metric: names that share a long prefix."""
    return windows.global_rank(
        A.shows(spark, sf).select("show_id", "show_name"),
        "show_name",
        descending=False,
        dense_rank_col="dense_rank",
        rank_col="rank",
        rows_per_chunk=100,
    )


@register(
    "win_share_of_total",
    oracle(
        """
SELECT language, shows, round(shows / (SELECT count(*) FROM shows) * 100, 1) AS share_pct
FROM (SELECT language, count(*) AS shows FROM shows GROUP BY language)
"""
    ),
)
def q_win_share(spark, sf):
    """WIN-5: share of the grand total via a one-row broadcast total."""
    per = A.shows(spark, sf).groupBy("language").agg(F.count(F.lit(1)).alias("shows"))
    return windows.share_of_total(per, "shows", "share_pct", digits=1)


@register(
    "win_rank_family",
    oracle(
        f"""
SELECT episode_id, show_id, season, episode_rating,
       rank() OVER (PARTITION BY show_id, season ORDER BY episode_rating DESC) AS rating_rank,
       dense_rank() OVER (PARTITION BY show_id, season ORDER BY episode_rating DESC) AS rating_dense_rank,
       row_number() OVER (PARTITION BY show_id, season ORDER BY episode_rating DESC, episode_id) AS rating_row_num
FROM episodes
"""
    ),
)
def q_win_rank_family(spark, sf):
    """WIN-6..8: rank / dense_rank / row_number (row_number tie-broken by id), no per-key window."""
    e = A.episodes(spark, sf).select("episode_id", "show_id", "season", "episode_rating")
    return windows.rank_family(e, ["show_id", "season"], "episode_rating", ["episode_id"])


@register(
    "win_running_avg",
    oracle(
        f"""
SELECT episode_id, show_id, season, episode_rating,
       CAST(sum(CAST(episode_rating AS DECIMAL(28,10))) OVER w AS DOUBLE) / count(episode_rating) OVER w
           AS running_avg_rating,
       CAST(sum(episode_runtime) OVER w AS BIGINT) AS running_runtime
FROM episodes
WINDOW w AS ({W_NUM} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
"""
    ),
)
def q_win_running_avg(spark, sf):
    """WIN-9: running average (exact running sum / count) and running sum, as a segmented scan."""
    e = A.episodes(spark, sf).select("episode_id", "show_id", "season", "episode_rating", "episode_runtime", "episode_number")
    scanned = segmented_scan(
        e,
        ["show_id", "season"],
        ["episode_number", "episode_id"],
        sums={"_total": exact("episode_rating"), "running_runtime": F.col("episode_runtime")},
        counts={"_rated": F.col("episode_rating")},
    )
    return scanned.select(
        "episode_id", "show_id", "season", "episode_rating",
        (F.col("_total").cast("double") / F.col("_rated")).alias("running_avg_rating"),
        "running_runtime",
    )


@register(
    "win_lag_lead_delta",
    oracle(
        f"""
SELECT episode_id, show_id, season, episode_rating,
       lag(episode_rating, 1) OVER w AS prev_rating,
       lead(episode_rating, 1) OVER w AS next_rating,
       episode_rating - lag(episode_rating, 1) OVER w AS rating_change
FROM episodes
WINDOW w AS ({W_NUM})
"""
    ),
)
def q_win_lag_lead(spark, sf):
    """WIN-10..12: LAG, LEAD and the delta to the previous row, as a segmented scan."""
    e = A.episodes(spark, sf).select("episode_id", "show_id", "season", "episode_rating", "episode_number")
    out = segmented_scan(
        e,
        ["show_id", "season"],
        ["episode_number", "episode_id"],
        neighbours={"episode_rating": ("prev_rating", "next_rating")},
    )
    return out.withColumn("rating_change", F.col("episode_rating") - F.col("prev_rating")).drop("episode_number")


@register(
    "win_scan_large_groups",
    oracle(
        """
SELECT episode_id, language, episode_runtime,
       CAST(sum(episode_runtime) OVER r AS BIGINT) AS running_runtime,
       count(airtime) OVER r AS aired_so_far,
       lag(episode_rating, 1) OVER o AS prev_rating,
       lead(episode_rating, 1) OVER o AS next_rating,
       rank() OVER (PARTITION BY language ORDER BY episode_runtime DESC) AS runtime_rank,
       dense_rank() OVER (PARTITION BY language ORDER BY episode_runtime DESC) AS runtime_dense_rank,
       row_number() OVER (PARTITION BY language ORDER BY episode_runtime DESC, episode_id) AS runtime_row_num
FROM (SELECT e.episode_id, s.language, e.episode_runtime, e.episode_rating, e.airtime, nullif(e.season, 3) AS part
      FROM episodes e JOIN shows s USING (show_id))
WINDOW o AS (PARTITION BY language ORDER BY part NULLS FIRST, episode_id),
       r AS (PARTITION BY language ORDER BY part NULLS FIRST, episode_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
"""
    ),
)
def q_win_scan_large_groups(spark, sf):
    """WIN-6..12 over few large groups that are cut by row count: the order column has ties and NULLs."""
    e = A.episodes(spark, sf).select("episode_id", "show_id", "episode_runtime", "episode_rating", "airtime", F.nullif("season", F.lit(3)).alias("part"))
    rows = e.join(A.shows(spark, sf).select("show_id", "language"), "show_id").drop("show_id")
    scanned = segmented_scan(
        rows,
        ["language"],
        ["part", "episode_id"],
        sums={"running_runtime": F.col("episode_runtime")},
        counts={"aired_so_far": F.col("airtime")},
        neighbours={"episode_rating": ("prev_rating", "next_rating")},
        rows_per_chunk=1000,
    )
    ranked = windows.rank_family(scanned, ["language"], "episode_runtime", ["episode_id"], prefix="runtime", rows_per_chunk=1000)
    return ranked.drop("episode_rating", "airtime", "part")


@register(
    "win_global_rank_struct",
    oracle(
        """
SELECT show_id, dense_rank() OVER (ORDER BY network_country DESC NULLS LAST, show_name DESC) AS dense_rank,
       rank() OVER (ORDER BY network_country DESC NULLS LAST, show_name DESC) AS rank
FROM shows
"""
    ),
)
def q_win_global_rank_struct(spark, sf):
    """WIN-3/WIN-4 over a struct metric: a country and a name."""
    shows = A.shows(spark, sf).select("show_id", F.struct("network_country", "show_name").alias("place"))
    return windows.global_rank(shows, "place", dense_rank_col="dense_rank", rank_col="rank", rows_per_chunk=100).drop("place")


@register(
    "win_percent_rank",
    oracle(
        """
SELECT episode_id, show_id, season, episode_rating,
       percent_rank() OVER (PARTITION BY show_id, season ORDER BY episode_rating ASC) AS rating_percentile
FROM episodes
"""
    ),
)
def q_win_percent_rank(spark, sf):
    """WIN-13: percent_rank ascending within a partition (distinct-value ranks, no per-key window)."""
    e = A.episodes(spark, sf).select("episode_id", "show_id", "season", "episode_rating")
    return windows.keyed_rank(e, "episode_rating", ["show_id", "season"], descending=False, percent_rank_col="rating_percentile")


@register(
    "win_first_last",
    oracle(
        f"""
SELECT episode_id, show_id, season,
       first_value(episode_rating) OVER w AS first_rating,
       last_value(episode_rating) OVER w AS last_rating
FROM episodes
WINDOW w AS ({W_NUM} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
"""
    ),
)
def q_win_first_last(spark, sf):
    """WIN-14/15: FIRST_VALUE / LAST_VALUE over the full frame, as a min_by/max_by aggregate."""
    e = A.episodes(spark, sf).select("episode_id", "show_id", "season", "episode_rating", "episode_number")
    out = windows.first_last_by(
        e, ["show_id", "season"], ["episode_number", "episode_id"], "episode_rating", "first_rating", "last_rating"
    )
    return out.drop("episode_rating", "episode_number")


@register(
    "win_top1_ties",
    oracle(
        """
SELECT show_id, season, episode_id, episode_runtime FROM (
    SELECT show_id, season, episode_id, episode_runtime,
           rank() OVER (PARTITION BY show_id, season ORDER BY episode_runtime DESC) AS r
    FROM episodes) WHERE r = 1
"""
    ),
)
def q_win_top1(spark, sf):
    """WIN-16/FLT-5: top-1 per group keeping ties (rank = 1)."""
    e = A.episodes(spark, sf).select("show_id", "season", "episode_id", "episode_runtime")
    return windows.top_per_group(e, ["show_id", "season"], "episode_runtime")


# ------------------------------------------------------- sorts / limits


@register(
    "top_n",
    oracle(
        """
SELECT show_id, count(*) AS episodes FROM episodes GROUP BY show_id
ORDER BY episodes DESC, show_id LIMIT 10
"""
    ),
)
def q_top_n(spark, sf):
    """LIM-1/SRT-3: ORDER BY metric DESC + LIMIT with a unique tie-breaker (TakeOrderedAndProject)."""
    per = A.episodes(spark, sf).groupBy("show_id").agg(F.count(F.lit(1)).alias("episodes"))
    return per.orderBy(F.desc("episodes"), "show_id").limit(10)


@register(
    "sort_multi",
    oracle(
        """
SELECT show_id, season, count(*) AS episodes FROM episodes GROUP BY show_id, season
HAVING count(*) > 0 ORDER BY show_id, season
"""
    ),
)
def q_sort_multi(spark, sf):
    """SRT-1/SRT-2/FLT-7: multi-key ascending sort after an aggregate with a HAVING filter."""
    per = A.episodes(spark, sf).groupBy("show_id", "season").agg(F.count(F.lit(1)).alias("episodes"))
    return per.filter(F.col("episodes") > 0).orderBy("show_id", "season")
