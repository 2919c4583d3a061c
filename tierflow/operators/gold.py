"""Gold KPI products (D-7 .. D-11).

All global ranks use ``global_rank`` (no single-task window); its input here
is always a per-key aggregate, so it is checkpointed once and both the ranks
and the returned rows read the checkpoint. Aggregates are
computed before joining to the show dimension, so joins see one row per key.
The reference sorts each table before writing it; that range shuffle buys
readers nothing, so ordering is left to the queries that read the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierflow.functions.columns import repeated_list_string, rounded_avg, sorted_list_string
from tierflow.operators.scans import ROWS_PER_CHUNK, segmented_scan
from tierflow.operators.windows import global_rank, share_of_total

GOLD_TS = "_gold_timestamp"


def _stamp(df: DataFrame, timestamps: bool) -> DataFrame:
    return df.withColumn(GOLD_TS, F.current_timestamp()) if timestamps else df


def episodes_per_season(episodes: DataFrame, shows: DataFrame, timestamps: bool = True) -> DataFrame:
    """D-7: per (show, season) counts/averages, season rank and running total.

    Both windows are partitioned by show over the *aggregated* seasons, so a
    show with a huge number of episodes still contributes only one row per
    season to the window.
    """
    per_season = episodes.groupBy("show_id", "season").agg(
        F.count("episode_id").alias("episode_count"),
        rounded_avg("episode_runtime", 1).alias("avg_episode_runtime"),
        F.min("airdate").alias("season_start_date"),
        F.max("airdate").alias("season_end_date"),
        rounded_avg("episode_rating", 2, fractional=True).alias("avg_season_rating"),
    )
    joined = per_season.join(shows.select("show_id", "show_name"), "show_id", "inner")
    by_show = Window.partitionBy("show_id")
    out = joined.withColumns(
        {
            "season_rank_by_episodes": F.dense_rank().over(by_show.orderBy(F.desc("episode_count"))),
            "cumulative_episodes": F.sum("episode_count").over(
                by_show.orderBy("season").rowsBetween(Window.unboundedPreceding, Window.currentRow)
            ),
        }
    )
    return _stamp(out, timestamps)


def avg_runtime_per_show(episodes: DataFrame, shows: DataFrame, timestamps: bool = True) -> DataFrame:
    """D-8: runtime statistics of positive-runtime episodes, global runtime rank."""
    per_show = (
        episodes.filter(F.col("episode_runtime") > 0)
        .groupBy("show_id")
        .agg(
            rounded_avg("episode_runtime", 1).alias("avg_runtime_minutes"),
            F.min("episode_runtime").alias("min_runtime_minutes"),
            F.max("episode_runtime").alias("max_runtime_minutes"),
            F.count("episode_id").alias("total_episodes"),
            rounded_avg("episode_rating", 2, fractional=True).alias("avg_episode_rating"),
        )
    )
    joined = per_show.join(
        shows.select("show_id", "show_name", "language", "status", "rating_average"), "show_id", "inner"
    )
    ranked = global_rank(
        joined, "avg_runtime_minutes", dense_rank_col="runtime_rank", percent_rank_col="_pr", materialize_input=True
    )
    out = ranked.withColumn("runtime_percentile", F.round(F.col("_pr") * 100, 1)).drop("_pr")
    return _stamp(out, timestamps)


def top_cast_members(cast: DataFrame, timestamps: bool = True, distinct_shows: bool = False) -> DataFrame:
    """D-9: credits per person, global rank and the list of characters played.

    ``show_count`` counts cast *rows* like the reference (two characters in one
    show count twice); ``distinct_shows=True`` counts distinct shows instead.
    The character list is built from (person, character, n) pre-aggregates, so
    the shuffle and the aggregation buffer hold one entry per distinct
    character, not one per credit.
    """
    person = ["person_id", "cast_name", "person_country", "person_gender"]
    # Raw-level aggregate: only key columns and counts, so it stays a hash
    # aggregate (a string min/first buffer would force a sort aggregate).
    per_char = cast.groupBy(*person, "character_name", "person_image_url").agg(
        F.count("show_id").alias("_credits"),
        F.count("character_name").alias("_named"),
    )
    per_person = per_char.groupBy(*person).agg(
        F.sum("_credits").alias("show_count"),
        repeated_list_string("character_name", "_named").alias("characters_list"),
        F.min("person_image_url").alias("image_url"),
    )
    if distinct_shows:
        counts = cast.groupBy(*person).agg(F.count_distinct("show_id").alias("show_count"))
        per_person = per_person.drop("show_count").join(counts, person, "inner")
    ranked = global_rank(
        per_person, "show_count", dense_rank_col="cast_rank", percent_rank_col="_pr", materialize_input=True
    )
    out = ranked.select(
        *person,
        "show_count",
        "image_url",
        "cast_rank",
        F.round(F.col("_pr") * 100, 1).alias("cast_percentile"),
        "characters_list",
    )
    return _stamp(out, timestamps)


def character_pages(cast: DataFrame, page_items: int = 10_000, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """AGG-12: the sorted character list of each person in pages: person_id, page (from 0), items, characters.

    ``top_cast_members`` gives the list as one string, which grows with a person's
    credits; a page holds ``page_items`` entries at most, the pages of a person in order
    are that list, and each page is a group of its own. A character's place in the list
    is a running sum of counts (a segmented scan), so a person of any number of
    credits or characters is spread over tasks.
    """
    counts = cast.filter(F.col("character_name").isNotNull()).groupBy("person_id", "character_name").agg(F.count(F.lit(1)).alias("n"))
    placed = segmented_scan(counts, ["person_id"], ["character_name"], sums={"upto": F.col("n")}, rows_per_chunk=rows_per_chunk)
    size, before = F.lit(page_items).cast("long"), F.col("upto") - F.col("n")
    pages = F.sequence(F.floor(before / size), F.floor((F.col("upto") - 1) / size))
    spread = placed.withColumn("page", F.explode(pages))
    here = F.least("upto", (F.col("page") + 1) * size) - F.greatest(before, F.col("page") * size)
    return (
        spread.withColumn("items", here)
        .groupBy("person_id", "page")
        .agg(F.sum("items").alias("items"), repeated_list_string("character_name", "items").alias("characters"))
    )


def genre_statistics(genres: DataFrame, shows: DataFrame, timestamps: bool = True) -> DataFrame:
    """D-10: shows per genre, average show rating, rank and share of all rows.

    The reference aggregates the bridge twice (counts, and ratings through an
    inner join) and joins the two results; one aggregate over bridge LEFT JOIN
    shows yields both, since ``avg`` ignores the NULLs of unmatched rows.
    """
    stats = (
        genres.select("genre", "show_id")
        .join(shows.select(F.col("show_id").alias("_sid"), "rating_average"), F.col("show_id") == F.col("_sid"), "left")
        .groupBy("genre")
        .agg(
            F.count("show_id").alias("show_count"),
            rounded_avg("rating_average", 2, fractional=True).alias("avg_genre_rating"),
        )
    )
    ranked = global_rank(stats, "show_count", dense_rank_col="genre_rank", materialize_input=True)
    out = share_of_total(ranked, "show_count", "genre_share_pct", digits=1)
    return _stamp(out, timestamps)


def show_dashboard(
    shows: DataFrame, episodes: DataFrame, cast: DataFrame, genres: DataFrame, timestamps: bool = True
) -> DataFrame:
    """D-11: one KPI row per show from three pre-aggregates, zero defaults."""
    ep = episodes.groupBy("show_id").agg(
        F.count(F.lit(1)).alias("total_episodes"),
        F.max("season").alias("total_seasons"),
        rounded_avg("episode_runtime", 1).alias("avg_episode_runtime"),
        rounded_avg("episode_rating", 2, fractional=True).alias("avg_episode_rating"),
    )
    ca = cast.groupBy("show_id").agg(F.count("person_id").alias("cast_size"))
    ge = genres.groupBy("show_id").agg(sorted_list_string("genre").alias("genre_list"))
    joined = shows.join(ep, "show_id", "left").join(ca, "show_id", "left").join(ge, "show_id", "left")
    flat = joined.select(
        "show_id", "show_name", "language", "status", "rating_average", "premiered_date", "ended_date",
        "network_name", "genre_list",
        F.coalesce("total_episodes", F.lit(0)).alias("total_episodes"),
        F.coalesce("total_seasons", F.lit(0)).alias("total_seasons"),
        F.coalesce("avg_episode_runtime", F.lit(0)).alias("avg_episode_runtime"),
        F.coalesce("avg_episode_rating", F.lit(0)).alias("avg_episode_rating"),
        F.coalesce("cast_size", F.lit(0)).alias("cast_size"),
    )
    out = global_rank(flat, "rating_average", dense_rank_col="overall_rank", materialize_input=True)
    return _stamp(out, timestamps)
