"""Volume variant: suppliers as shows, line items as episodes (season = ship year).

The largest driver table (600 k rows at sf0.1) through the Gold and report
operators; episode order is (l_orderkey, l_linenumber, l_partkey).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tierflow.operators import gold, reports
from tierflow.plans import adapters as A
from tierflow.plans.oracle_base import ravg
from tierflow.plans.registry import register
from tierflow.plans.report_queries import best_episode_sql, trajectory_sql

V_CTES = """
WITH vshows AS (
    SELECT s.s_suppkey AS show_id, s.s_name AS show_name, n.n_name AS language, s.s_acctbal AS rating_average
    FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
),
veps AS (
    SELECT l_suppkey AS show_id, CAST(year(l_shipdate) AS INTEGER) AS season, l_orderkey AS episode_number,
           CAST(l_linenumber AS BIGINT) AS episode_id, l_partkey, CAST(l_quantity AS INTEGER) AS episode_runtime,
           l_discount AS episode_rating, CAST(l_shipdate AS DATE) AS airdate, l_returnflag AS episode_name
    FROM lineitem
)
"""


@register(
    "volume_episodes_per_season",
    V_CTES
    + f"""
SELECT e.show_id, e.season, e.episode_count, e.avg_episode_runtime, e.season_start_date, e.season_end_date,
       e.avg_season_rating, s.show_name,
       CAST(dense_rank() OVER (PARTITION BY e.show_id ORDER BY e.episode_count DESC) AS INTEGER) AS season_rank_by_episodes,
       CAST(sum(e.episode_count) OVER (PARTITION BY e.show_id ORDER BY e.season
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulative_episodes
FROM (
    SELECT show_id, season, count(episode_id) AS episode_count, {ravg("episode_runtime", 1)} AS avg_episode_runtime,
           min(airdate) AS season_start_date, max(airdate) AS season_end_date,
           {ravg("episode_rating", 2)} AS avg_season_rating
    FROM veps GROUP BY show_id, season
) e JOIN vshows s ON e.show_id = s.show_id
""",
)
def q_volume_eps(spark, sf):
    """D-7 over line items per supplier and ship year."""
    return gold.episodes_per_season(A.volume_episodes(spark, sf), A.volume_shows(spark, sf), timestamps=False)


@register(
    "volume_avg_runtime",
    V_CTES
    + f"""
SELECT a.*, s.show_name, s.language, s.rating_average,
       dense_rank() OVER (ORDER BY a.avg_runtime_minutes DESC NULLS LAST) AS runtime_rank,
       round(percent_rank() OVER (ORDER BY a.avg_runtime_minutes DESC NULLS LAST) * 100, 1) AS runtime_percentile
FROM (
    SELECT show_id, {ravg("episode_runtime", 1)} AS avg_runtime_minutes,
           min(episode_runtime) AS min_runtime_minutes, max(episode_runtime) AS max_runtime_minutes,
           count(episode_id) AS total_episodes, {ravg("episode_rating", 2)} AS avg_episode_rating
    FROM veps WHERE episode_runtime > 0 GROUP BY show_id
) a JOIN vshows s ON a.show_id = s.show_id
""",
)
def q_volume_runtime(spark, sf):
    """D-8 over line items: global runtime rank of suppliers."""
    shows = A.volume_shows(spark, sf).withColumn("status", F.lit(None).cast("string"))
    out = gold.avg_runtime_per_show(A.volume_episodes(spark, sf), shows, timestamps=False)
    return out.drop("status")


VOLUME_SQL = {"episodes": "veps", "shows": "vshows", "order": "e.episode_number, e.episode_id, e.l_partkey"}


@register("volume_best_episode", V_CTES + best_episode_sql(**VOLUME_SQL))
def q_volume_best(spark, sf):
    """R-4 over line items (season = ship year)."""
    return reports.best_episode_per_season(
        A.volume_episodes(spark, sf), A.volume_shows(spark, sf), order_cols=A.VOLUME_ORDER
    )


@register("volume_trajectory", V_CTES + trajectory_sql(**VOLUME_SQL))
def q_volume_trajectory(spark, sf):
    """R-5 over line items."""
    return reports.season_trajectory(A.volume_episodes(spark, sf), A.volume_shows(spark, sf), order_cols=A.VOLUME_ORDER)
