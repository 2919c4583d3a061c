"""Analytic reports R-4 .. R-9 over the Silver tables.

Every report that the reference writes as a fan-out join followed by
COUNT(DISTINCT) is computed from per-show pre-aggregates instead: the cost is
the size of each input, not the product of episodes x cast x genres.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.functions.columns import beyond_exact, exact, exact_avg, rounded_avg
from tierflow.operators.scans import ROWS_PER_CHUNK, join_back, segmented_scan


ORDER_COLS = ("episode_number", "episode_id")


def distinct_counts(df: DataFrame, keys: Sequence[str], columns: Mapping[str, str], others: Sequence[Column] = ()) -> DataFrame:
    """AGG-6: keys, ``others`` (aggregates) and COUNT(DISTINCT column) for each output name -> column.

    Spark plans several distinct counts in one aggregate as an Expand, which copies every
    row once for each of them before the shuffle. Here each is an aggregate of its own over
    its two columns, (key, value) pairs made distinct in the tasks first and then
    counted by key; the results, one row a key, meet in joins on the key, for which the
    counts are already partitioned.
    """
    keys = list(keys)
    out = df.groupBy(*keys).agg(*others) if others else df.select(*keys).distinct()
    for name, column in columns.items():
        pairs = df.select(*keys, F.col(column).alias("_tf_value")).distinct()
        out = join_back(out, pairs.groupBy(*keys).agg(F.count("_tf_value").alias(name)), keys)
    return out


def best_episode_per_season(
    episodes: DataFrame, shows: DataFrame, order_cols: Sequence[str] = ORDER_COLS, rows_per_chunk: int = ROWS_PER_CHUNK
) -> DataFrame:
    """R-4 (1A): rank family, running average, neighbours, percentile; rank-1 rows.

    Only rows of the season's best rating are returned, so their ranks are 1 and no
    window sorts by rating: row_number is the running number of best rows, percent_rank
    (ascending) the share of the other rows that lie below. Best rating, rows and best
    rows are aggregates of the season, the rest is one scan along the episode order. A
    season of at most ``rows_per_chunk`` episodes is one window group (one shuffle in
    all); larger ones are cut by row count (``segmented_scan``). ``order_cols`` is the
    episode order and must be unique within a season.

    ``rating_row_num`` breaks rating ties by episode number and id so that the
    numbering is reproducible (the reference leaves it to arrival order). The
    running average is an exact running sum over one division.
    """
    rated = episodes.filter(F.col("episode_rating") > 0)
    e = rated.join(shows.select("show_id", "show_name"), "show_id", "inner")
    rating = F.col("episode_rating")
    scanned = segmented_scan(
        e,
        ["show_id", "season"],
        order_cols,
        per_key=[{"best": F.max(rating), "n": F.count(F.lit(1))}, {"n_best": F.count(F.when(rating == F.col("best"), 1))}],
        sums={"total": exact("episode_rating"), "others": beyond_exact("episode_rating")},
        counts={"rated": rating, "best_so_far": F.when(rating == F.col("best"), 1)},
        neighbours={"episode_rating": ("prev_episode_rating", "next_episode_rating")},
        rows_per_chunk=rows_per_chunk,
        sized_by=rated,
    )
    total = F.coalesce(F.col("total").cast("double"), F.lit(0.0)) + F.coalesce("others", F.lit(0.0))
    one = F.lit(1).cast("long")
    return (
        scanned.filter(rating == F.col("best"))
        .select(
            "show_name", "season", "episode_number", "episode_name", "episode_rating", "episode_runtime", "airdate",
            one.alias("rating_rank"),
            one.alias("rating_dense_rank"),
            F.col("best_so_far").alias("rating_row_num"),
            (total / F.col("rated")).alias("running_avg_rating"),
            "prev_episode_rating",
            "next_episode_rating",
            F.when(F.col("n") > 1, (F.col("n") - F.col("n_best")) / (F.col("n") - 1)).otherwise(F.lit(0.0)).alias("rating_percentile"),
            (rating - F.col("prev_episode_rating")).alias("rating_change"),
        )
        .orderBy("show_name", "season", "rating_row_num")
    )


def season_trajectory(episodes: DataFrame, shows: DataFrame, order_cols: Sequence[str] = ORDER_COLS) -> DataFrame:
    """R-5 (1B): premiere vs finale rating per season.

    FIRST_VALUE/LAST_VALUE over a full frame followed by DISTINCT equals
    ``min_by``/``max_by`` on the window's order key; as an aggregate it gets
    map-side partial aggregation, so a season with millions of episodes never
    sits in one window buffer. The key is the struct (episode_number,
    episode_id): NULL numbers sort first like ASC NULLS FIRST, and the id
    breaks ties deterministically.
    """
    e = episodes.filter(F.col("episode_rating") > 0).join(
        shows.select("show_id", "show_name"), "show_id", "inner"
    )
    order_key = F.struct(*[F.col(c) for c in order_cols])
    bounds = e.groupBy("show_id", "show_name", "season").agg(
        F.min_by("episode_rating", order_key).alias("season_premiere_rating"),
        F.max_by("episode_rating", order_key).alias("season_finale_rating"),
    )
    return bounds.select(
        "show_name",
        "season",
        "season_premiere_rating",
        "season_finale_rating",
        F.when(F.col("season_finale_rating") > F.col("season_premiere_rating"), F.lit("Improved"))
        .otherwise(F.lit("Declined"))
        .alias("season_trajectory"),
    ).orderBy("show_name", "season")


def show_report(
    shows: DataFrame, episodes: DataFrame, cast: DataFrame, genres: DataFrame, top_n: int | None = 25
) -> DataFrame:
    """R-6 (2A): the 4-way LEFT JOIN report, from per-show pre-aggregates.

    The reference's fan-out is uniform per show (every episode row is repeated
    cast x genre times), so AVG/MIN/MAX and COUNT(DISTINCT) over the product
    equal the same aggregates over each side alone.
    """
    ep = distinct_counts(
        episodes,
        ["show_id"],
        {"total_episodes": "episode_id", "total_seasons": "season"},
        [
            rounded_avg("episode_runtime", 1).alias("avg_runtime_min"),
            rounded_avg("episode_rating", 2, fractional=True).alias("avg_episode_rating"),
            F.min("airdate").alias("first_aired"),
            F.max("airdate").alias("last_aired"),
        ],
    )
    ca = cast.groupBy("show_id").agg(F.count_distinct("person_id").alias("cast_size"))
    ge = genres.groupBy("show_id").agg(F.concat_ws(", ", F.array_sort(F.collect_set("genre"))).alias("genres"))
    out = (
        shows.select("show_id", "show_name", "language", "status", "network_name", F.col("rating_average").alias("show_rating"))
        .join(ep, "show_id", "inner")  # HAVING COUNT(DISTINCT episode_id) > 0
        .join(ca, "show_id", "left")
        .join(ge, "show_id", "left")
        .withColumns(
            {
                "cast_size": F.coalesce("cast_size", F.lit(0)),
                "genres": F.coalesce("genres", F.lit("")),
            }
        )
    )
    if top_n is not None:
        out = out.orderBy(F.desc_nulls_last("show_rating"), "show_id").limit(top_n)
    return out.drop("show_id")


def network_comparison(shows: DataFrame, episodes: DataFrame, cast: DataFrame, min_shows: int = 3) -> DataFrame:
    """R-7 (2B): per-network totals from per-show pre-aggregates, HAVING on show count.

    ``avg_episode_runtime`` is the show-weighted average of per-show averages
    (reference semantics); ``total_episodes_produced`` is NULL for a network
    whose shows have no episodes.
    """
    ep = episodes.groupBy("show_id").agg(
        F.count(F.lit(1)).alias("total_episodes"), F.avg("episode_runtime").alias("avg_runtime")
    )
    ca = cast.groupBy("show_id").agg(F.count_distinct("person_id").alias("cast_size"))
    network = F.coalesce(F.col("network_name"), F.col("web_channel_name"), F.lit("Unknown")).alias("network")
    joined = shows.select(network, "show_id", "rating_average").join(ep, "show_id", "left").join(ca, "show_id", "left")
    per_network = joined.groupBy("network").agg(
        F.count_distinct("show_id").alias("total_shows"),
        rounded_avg("rating_average", 2, fractional=True).alias("avg_show_rating"),
        F.sum("total_episodes").alias("total_episodes_produced"),
        rounded_avg("avg_runtime", 1, fractional=True).alias("avg_episode_runtime"),
        rounded_avg("cast_size", 0).alias("avg_cast_size"),
    )
    return per_network.filter(F.col("total_shows") >= min_shows).orderBy(F.desc_nulls_last("avg_show_rating"), "network")


def above_average_all(shows: DataFrame, episodes: DataFrame, cast: DataFrame) -> DataFrame:
    """R-8 (3A): shows above the average over *all* shows, with per-show counts.

    Counts of shows without rows are 0, their average runtime is NULL. Both
    sides are aggregated per show before they meet the shows that qualify.
    """
    bar = shows.agg(exact_avg("rating_average")).scalar()
    eps = episodes.groupBy("show_id").agg(F.count(F.lit(1)).alias("n"), F.avg("episode_runtime").alias("avg_rt"))
    people = cast.groupBy("show_id").agg(F.count_distinct("person_id").alias("m"))
    chosen = shows.filter(F.col("rating_average") > bar).select("show_id", "show_name", "rating_average")
    zero = F.lit(0).cast("long")
    return (
        chosen.join(eps, "show_id", "left")
        .join(people, "show_id", "left")
        .select("show_name", "rating_average", F.coalesce("n", zero).alias("ep_count"), "avg_rt", F.coalesce("m", zero).alias("cast_sz"))
        .orderBy(F.desc("rating_average"), "show_name")
    )


def above_average_cte(shows: DataFrame, episodes: DataFrame, cast: DataFrame) -> DataFrame:
    """R-9 (3B): pre-aggregated form; the average is over *rated* shows only.

    The overall average is an uncorrelated scalar subquery, computed once and
    inlined into the filter (the reference's CROSS JOIN with a one-row CTE).
    """
    overall = shows.filter(F.col("rating_average") > 0).agg(exact_avg("rating_average")).scalar()
    es = episodes.groupBy("show_id").agg(
        F.count(F.lit(1)).alias("episode_count"), rounded_avg("episode_runtime", 1).alias("avg_runtime")
    )
    cs = cast.groupBy("show_id").agg(F.count_distinct("person_id").alias("cast_size"))
    return (
        shows.select("show_id", "show_name", "rating_average")
        .filter(F.col("rating_average") > overall)
        .join(es, "show_id", "left")
        .join(cs, "show_id", "left")
        .select(
            "show_name",
            "rating_average",
            F.coalesce("episode_count", F.lit(0)).alias("episode_count"),
            F.coalesce("avg_runtime", F.lit(0.0)).alias("avg_runtime"),
            F.coalesce("cast_size", F.lit(0)).alias("cast_size"),
        )
        .orderBy(F.desc("rating_average"), "show_name")
    )
