"""DuckDB formulations of the adapters (see ``adapters.py``) for oracle SQL.

Written independently of the Spark code: the oracle re-derives Silver rows
straight from the driver's tables, so a mistake in a Spark flattening step
shows up as a mismatch.

Oracle conventions: ranks cast to INTEGER (Spark's type), BIGINT sums cast
back from HUGEINT, explicit NULLS FIRST/LAST, sorted string aggregates, and no
``current_timestamp`` columns.
"""

from __future__ import annotations

BASE_CTES = """
show_genre_sets AS (
    SELECT user_id AS show_id, list_sort(list_distinct(list(event_type))) AS genres
    FROM events GROUP BY user_id
),
shows AS (
    SELECT
        c.c_custkey AS show_id,
        COALESCE(c.c_name, 'Unknown') AS show_name,
        n.n_name AS show_type,
        COALESCE(c.c_mktsegment, 'Unknown') AS language,
        gs.genres AS genres,
        COALESCE(r.r_name, 'Unknown') AS status,
        CAST(COALESCE(CASE WHEN c.c_nationkey <> 0 THEN c.c_nationkey * 5 END,
                      CASE WHEN n.n_regionkey <> 0 THEN n.n_regionkey * 10 END, 0) AS INTEGER) AS runtime,
        CAST(CASE WHEN n.n_regionkey <> 0 THEN n.n_regionkey * 10 END AS INTEGER) AS average_runtime,
        CASE WHEN c.c_acctbal < 0 THEN NULL
             ELSE make_date(2020, CAST(c.c_nationkey % 12 + 1 AS INTEGER), CAST(c.c_custkey % 28 + 1 AS INTEGER)) END
            AS premiered_date,
        CASE WHEN r.r_name = 'EUROPE' THEN DATE '2023-12-31' END AS ended_date,
        CAST(NULL AS VARCHAR) AS official_site,
        '20:00' AS schedule_time,
        ['Monday'] AS schedule_days,
        COALESCE(c.c_acctbal, 0.0) AS rating_average,
        CAST(n.n_nationkey AS BIGINT) AS network_id,
        n.n_name AS network_name,
        r.r_name AS network_country,
        substr(r.r_name, 1, 2) AS network_country_code,
        CAST(r.r_regionkey AS BIGINT) AS web_channel_id,
        r.r_name AS web_channel_name,
        'tt' || CAST(c.c_custkey AS VARCHAR) AS imdb_id,
        c.c_custkey AS thetvdb_id,
        CAST(NULL AS VARCHAR) AS image_url,
        CAST(c.c_nationkey AS INTEGER) AS weight
    FROM customer c
    LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
    LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
    LEFT JOIN show_genre_sets gs ON gs.show_id = c.c_custkey
    WHERE c.c_custkey IS NOT NULL
),
episodes AS (
    SELECT
        event_id AS episode_id,
        user_id AS show_id,
        COALESCE(event_type, 'Untitled') AS episode_name,
        CAST(floor((day(ts) - 1) / 7) + 1 AS INTEGER) AS season,
        event_id AS episode_number,
        event_type AS episode_type,
        CAST(ts AS DATE) AS airdate,
        strftime(ts, '%H:%M') AS airtime,
        CAST(COALESCE(floor(value), 0) AS INTEGER) AS episode_runtime,
        COALESCE(value, 0.0) AS episode_rating,
        CAST(NULL AS VARCHAR) AS episode_image_url
    FROM events
    WHERE event_id IS NOT NULL AND user_id IS NOT NULL
),
credits AS (
    SELECT
        o.o_custkey AS show_id,
        l.l_suppkey AS person_id,
        'Supplier#' || CASE WHEN length(CAST(l.l_suppkey AS VARCHAR)) >= 9 THEN CAST(l.l_suppkey AS VARCHAR)
                            ELSE lpad(CAST(l.l_suppkey AS VARCHAR), 9, '0') END AS cast_name,
        'Unknown' AS person_country,
        CAST(NULL AS VARCHAR) AS person_birthday,
        CASE WHEN l.l_suppkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS person_gender,
        CAST(NULL AS VARCHAR) AS person_image_url,
        l.l_partkey AS character_id,
        COALESCE(l.l_returnflag, 'Unknown') AS character_name,
        CAST(NULL AS VARCHAR) AS character_image_url,
        l.l_linestatus = 'F' AS is_self,
        false AS is_voice
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
    WHERE o.o_custkey IS NOT NULL AND l.l_suppkey IS NOT NULL
),
genres AS (
    SELECT show_id, show_name, trim(COALESCE(genre, 'Unclassified')) AS genre
    FROM (
        SELECT show_id, show_name,
               unnest(CASE WHEN genres IS NULL OR len(genres) = 0 THEN [NULL::VARCHAR] ELSE genres END) AS genre
        FROM shows
    )
)
"""


def oracle(body: str, extra_ctes: str = "") -> str:
    """Prefix ``body`` with the adapter CTEs (plus optional extra CTEs)."""
    ctes = BASE_CTES.strip()
    if extra_ctes.strip():
        ctes = ctes + ",\n" + extra_ctes.strip()
    return f"WITH {ctes}\n{body.strip()}"


def ravg(expr: str, digits: int) -> str:
    """The average of the raw values, rounded half away from zero by whole-number division."""
    total = f"sum(CAST(round(CAST({expr} AS DOUBLE) * 1e10) AS HUGEINT))"
    rows = f"(CAST(count({expr}) AS HUGEINT) * 10000000000)"
    rounded = f"((abs({total}) * {2 * 10 ** digits} + {rows}) // NULLIF(2 * {rows}, 0))"
    return f"(sign({total}) * CAST({rounded} AS DOUBLE) / {10 ** digits})"
