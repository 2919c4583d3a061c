"""Silver products and Gold KPI tables on the adapter tables (D-2..D-5, D-7..D-11, R-1..R-3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierflow.operators import gold, silver
from tierflow.plans import adapters as A
from tierflow.plans.oracle_base import oracle, ravg
from tierflow.plans.registry import register

SHOW_COLS = (
    "show_id, show_name, show_type, language, genres, status, runtime, average_runtime, premiered_date, "
    "ended_date, official_site, schedule_time, schedule_days, rating_average, network_id, network_name, "
    "network_country, network_country_code, web_channel_id, web_channel_name, imdb_id, thetvdb_id, image_url, weight"
)


@register("silver_shows", oracle(f"SELECT {SHOW_COLS} FROM shows"))
def q_silver_shows(spark, sf):
    return A.shows(spark, sf)


@register("silver_episodes", oracle("SELECT * FROM episodes"))
def q_silver_episodes(spark, sf):
    return A.episodes(spark, sf)


@register("silver_cast", oracle("SELECT * FROM credits"))
def q_silver_cast(spark, sf):
    return A.cast(spark, sf)


@register("bridge_explode_outer", oracle("SELECT show_id, show_name, genre FROM genres"))
def q_bridge(spark, sf):
    return silver.bridge_explode(A.shows(spark, sf))


@register(
    "gold_episodes_per_season",
    oracle(
        f"""
SELECT e.show_id, e.season, e.episode_count, e.avg_episode_runtime, e.season_start_date, e.season_end_date,
       e.avg_season_rating, s.show_name,
       CAST(dense_rank() OVER (PARTITION BY e.show_id ORDER BY e.episode_count DESC) AS INTEGER) AS season_rank_by_episodes,
       CAST(sum(e.episode_count) OVER (PARTITION BY e.show_id ORDER BY e.season
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulative_episodes
FROM (
    SELECT show_id, season, count(episode_id) AS episode_count,
           {ravg("episode_runtime", 1)} AS avg_episode_runtime,
           min(airdate) AS season_start_date, max(airdate) AS season_end_date,
           {ravg("episode_rating", 2)} AS avg_season_rating
    FROM episodes GROUP BY show_id, season
) e JOIN shows s ON e.show_id = s.show_id
"""
    ),
)
def q_gold_eps(spark, sf):
    return gold.episodes_per_season(A.episodes(spark, sf), A.shows(spark, sf), timestamps=False)


GOLD_AVG_RUNTIME_SQL = f"""
SELECT a.*, s.show_name, s.language, s.status, s.rating_average,
       dense_rank() OVER (ORDER BY a.avg_runtime_minutes DESC NULLS LAST) AS runtime_rank,
       round(percent_rank() OVER (ORDER BY a.avg_runtime_minutes DESC NULLS LAST) * 100, 1) AS runtime_percentile
FROM (
    SELECT show_id, {ravg("episode_runtime", 1)} AS avg_runtime_minutes,
           min(episode_runtime) AS min_runtime_minutes, max(episode_runtime) AS max_runtime_minutes,
           count(episode_id) AS total_episodes, {ravg("episode_rating", 2)} AS avg_episode_rating
    FROM episodes WHERE episode_runtime > 0 GROUP BY show_id
) a JOIN shows s ON a.show_id = s.show_id
"""


@register("gold_avg_runtime", oracle(GOLD_AVG_RUNTIME_SQL))
def q_gold_runtime(spark, sf):
    return gold.avg_runtime_per_show(A.episodes(spark, sf), A.shows(spark, sf), timestamps=False)


GOLD_TOP_CAST_CTE = """
top_cast AS (
    SELECT p.*,
           dense_rank() OVER (ORDER BY show_count DESC NULLS LAST) AS cast_rank,
           round(percent_rank() OVER (ORDER BY show_count DESC NULLS LAST) * 100, 1) AS cast_percentile
    FROM (
        SELECT person_id, cast_name, person_country, person_gender, count(show_id) AS show_count,
               min(person_image_url) AS image_url,
               COALESCE(string_agg(character_name, ', ' ORDER BY character_name), '') AS characters_list
        FROM credits GROUP BY person_id, cast_name, person_country, person_gender
    ) p
)
"""


@register("gold_top_cast", oracle("SELECT * FROM top_cast", GOLD_TOP_CAST_CTE))
def q_gold_top_cast(spark, sf):
    return gold.top_cast_members(A.cast(spark, sf), timestamps=False)


@register(
    "cast_character_pages",
    oracle(
        """
SELECT person_id, page, count(*) AS items, string_agg(character_name, ', ' ORDER BY character_name) AS characters
FROM (SELECT person_id, character_name, (row_number() OVER (PARTITION BY person_id ORDER BY character_name) - 1) // 100 AS page FROM credits)
GROUP BY person_id, page
"""
    ),
)
def q_character_pages(spark, sf):
    """AGG-12/D-9: the character lists of all persons in pages of 100 entries."""
    return gold.character_pages(A.cast(spark, sf), page_items=100, rows_per_chunk=2)


GOLD_GENRE_CTE = f"""
genre_stats AS (
    SELECT x.*,
           dense_rank() OVER (ORDER BY show_count DESC NULLS LAST) AS genre_rank,
           round(show_count / (SELECT sum(show_count) FROM (
               SELECT count(show_id) AS show_count FROM genres GROUP BY genre)) * 100, 1) AS genre_share_pct
    FROM (
        SELECT g.genre, count(g.show_id) AS show_count, {ravg("s.rating_average", 2)} AS avg_genre_rating
        FROM genres g LEFT JOIN shows s ON g.show_id = s.show_id
        GROUP BY g.genre
    ) x
)
"""


@register("gold_genre_statistics", oracle("SELECT * FROM genre_stats", GOLD_GENRE_CTE))
def q_gold_genre(spark, sf):
    return gold.genre_statistics(A.genres(spark, sf), A.shows(spark, sf), timestamps=False)


GOLD_DASHBOARD_CTE = f"""
dashboard AS (
    SELECT d.*, dense_rank() OVER (ORDER BY rating_average DESC NULLS LAST) AS overall_rank
    FROM (
        SELECT s.show_id, s.show_name, s.language, s.status, s.rating_average, s.premiered_date, s.ended_date,
               s.network_name, gl.genre_list,
               COALESCE(ep.total_episodes, 0) AS total_episodes,
               COALESCE(ep.total_seasons, 0) AS total_seasons,
               COALESCE(ep.avg_episode_runtime, 0) AS avg_episode_runtime,
               COALESCE(ep.avg_episode_rating, 0) AS avg_episode_rating,
               COALESCE(ca.cast_size, 0) AS cast_size
        FROM shows s
        LEFT JOIN (
            SELECT show_id, count(*) AS total_episodes, max(season) AS total_seasons,
                   {ravg("episode_runtime", 1)} AS avg_episode_runtime,
                   {ravg("episode_rating", 2)} AS avg_episode_rating
            FROM episodes GROUP BY show_id) ep ON s.show_id = ep.show_id
        LEFT JOIN (SELECT show_id, count(person_id) AS cast_size FROM credits GROUP BY show_id) ca
            ON s.show_id = ca.show_id
        LEFT JOIN (SELECT show_id, COALESCE(string_agg(genre, ', ' ORDER BY genre), '') AS genre_list
                   FROM genres GROUP BY show_id) gl ON s.show_id = gl.show_id
    ) d
)
"""


@register("gold_show_dashboard", oracle("SELECT * FROM dashboard", GOLD_DASHBOARD_CTE))
def q_gold_dashboard(spark, sf):
    return gold.show_dashboard(
        A.shows(spark, sf), A.episodes(spark, sf), A.cast(spark, sf), A.genres(spark, sf), timestamps=False
    )


# R-1..R-3: consumer reports over the Gold tables.
@register(
    "report_top_shows",
    oracle(
        """
SELECT show_name, rating_average, total_episodes, total_seasons, cast_size, genre_list, overall_rank
FROM dashboard WHERE total_episodes > 0
ORDER BY overall_rank, show_id LIMIT 10
""",
        GOLD_DASHBOARD_CTE,
    ),
)
def q_report_top_shows(spark, sf):
    d = q_gold_dashboard(spark, sf)
    return (
        d.filter(F.col("total_episodes") > 0)
        .orderBy("overall_rank", "show_id")
        .limit(10)
        .select("show_name", "rating_average", "total_episodes", "total_seasons", "cast_size", "genre_list", "overall_rank")
    )


@register(
    "report_genres",
    oracle("SELECT genre, show_count, avg_genre_rating, genre_share_pct FROM genre_stats ORDER BY genre_rank", GOLD_GENRE_CTE),
)
def q_report_genres(spark, sf):
    g = q_gold_genre(spark, sf)
    return g.orderBy("genre_rank", "genre").select("genre", "show_count", "avg_genre_rating", "genre_share_pct")


@register(
    "report_prolific",
    oracle(
        """
SELECT cast_name, show_count, person_gender, person_country, characters_list
FROM top_cast WHERE cast_rank <= 15 ORDER BY cast_rank
""",
        GOLD_TOP_CAST_CTE,
    ),
)
def q_report_prolific(spark, sf):
    c = q_gold_top_cast(spark, sf)
    return (
        c.filter(F.col("cast_rank") <= 15)
        .orderBy("cast_rank", "person_id")
        .select("cast_name", "show_count", "person_gender", "person_country", "characters_list")
    )
