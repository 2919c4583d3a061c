"""Adapters: the driver's star-schema tables in the roles of the show domain.

show    = customer + nation + region   (show_id = c_custkey)
episode = events                        (show_id = user_id, season = week of month)
cast    = orders x lineitem             (show_id = o_custkey, person = supplier)
genres  = sorted distinct event types per customer (NULL when it has no events)
volume  = supplier as show, lineitem as episode (season = ship year)

The adapters build *Bronze-shaped* nested records with ``struct`` so that the
real Silver flattening runs on them. Nation and region are fixed-size
dimensions (25 and 5 rows at every scale factor), so broadcasting them is
safe; every other join is left to AQE's runtime size check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.operators import silver


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _null(dtype: str):
    return F.lit(None).cast(dtype)


def _padded_name(prefix: str, key: str, width: int = 9):
    """``prefix`` + zero-padded key (``%09d``) without per-row String.format.

    ``lpad`` alone would truncate keys longer than ``width`` digits.
    """
    digits = F.col(key).cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(digits) >= width, digits).otherwise(F.lpad(digits, width, "0")))


def bronze_shows(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    ev = table(spark, sf_dir, "events")
    genres = ev.groupBy(F.col("user_id").alias("c_custkey")).agg(
        F.array_sort(F.collect_set("event_type")).alias("genres")
    )
    base = (
        c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey, "left")
        .join(F.broadcast(r), F.col("n_regionkey") == r.r_regionkey, "left")
        .join(genres, "c_custkey", "left")
    )
    premiered = F.when(F.col("c_acctbal") < 0, F.lit("unknown")).otherwise(
        F.format_string(
            "2020-%02d-%02d",
            (F.col("c_nationkey") % 12 + 1).cast("int"),
            (F.col("c_custkey") % 28 + 1).cast("int"),
        )
    )
    return base.select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("n_name").alias("type"),
        F.col("c_mktsegment").alias("language"),
        F.col("genres"),
        F.col("r_name").alias("status"),
        F.when(F.col("c_nationkey") != 0, F.col("c_nationkey") * 5).cast("bigint").alias("runtime"),
        F.when(F.col("n_regionkey") != 0, F.col("n_regionkey") * 10).cast("bigint").alias("averageRuntime"),
        premiered.alias("premiered"),
        F.when(F.col("r_name") == "EUROPE", F.lit("2023-12-31")).alias("ended"),
        _null("string").alias("officialSite"),
        F.struct(F.lit("20:00").alias("time"), F.array(F.lit("Monday")).alias("days")).alias("schedule"),
        F.struct(F.col("c_acctbal").alias("average")).alias("rating"),
        F.struct(
            F.col("n_nationkey").cast("bigint").alias("id"),
            F.col("n_name").alias("name"),
            F.struct(F.col("r_name").alias("name"), F.substring("r_name", 1, 2).alias("code")).alias("country"),
        ).alias("network"),
        F.struct(F.col("r_regionkey").cast("bigint").alias("id"), F.col("r_name").alias("name")).alias("webChannel"),
        F.struct(
            F.concat(F.lit("tt"), F.col("c_custkey").cast("string")).alias("imdb"),
            F.col("c_custkey").alias("thetvdb"),
        ).alias("externals"),
        F.struct(_null("string").alias("medium")).alias("image"),
        F.col("c_nationkey").cast("bigint").alias("weight"),
    )


def bronze_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("show_id"),
        F.col("event_type").alias("name"),
        (F.floor((F.dayofmonth("ts") - 1) / 7) + 1).cast("bigint").alias("season"),
        F.col("event_id").alias("number"),
        F.col("event_type").alias("type"),
        F.date_format("ts", "yyyy-MM-dd").alias("airdate"),
        F.date_format("ts", "HH:mm").alias("airtime"),
        F.floor("value").cast("bigint").alias("runtime"),
        F.struct(F.col("value").alias("average")).alias("rating"),
        F.struct(_null("string").alias("medium")).alias("image"),
    )


def bronze_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_partkey", "l_returnflag", "l_linestatus"
    )
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    return j.select(
        F.col("o_custkey").alias("show_id"),
        F.struct(
            F.col("l_suppkey").alias("id"),
            _padded_name("Supplier#", "l_suppkey").alias("name"),
            F.struct(_null("string").alias("name")).alias("country"),
            _null("string").alias("birthday"),
            F.when(F.col("l_suppkey") % 2 == 0, F.lit("Female")).otherwise(F.lit("Male")).alias("gender"),
            F.struct(_null("string").alias("medium")).alias("image"),
        ).alias("person"),
        F.struct(
            F.col("l_partkey").alias("id"),
            F.col("l_returnflag").alias("name"),
            F.struct(_null("string").alias("medium")).alias("image"),
        ).alias("character"),
        (F.col("l_linestatus") == "F").alias("self"),
        F.lit(False).alias("voice"),
    )


def shows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_shows(bronze_shows(spark, sf_dir), timestamps=False)


def episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_episodes(bronze_episodes(spark, sf_dir), timestamps=False)


def cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_cast(bronze_cast(spark, sf_dir), timestamps=False)


def genres(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.bridge_explode(shows(spark, sf_dir))


def volume_shows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Volume variant: suppliers as shows."""
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    return s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey, "left").select(
        F.col("s_suppkey").alias("show_id"),
        F.col("s_name").alias("show_name"),
        F.col("n_name").alias("language"),
        F.col("s_acctbal").alias("rating_average"),
    )


def volume_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Volume variant: line items as episodes of their supplier, season = ship year.

    (l_orderkey, l_linenumber) is not unique in this data; the episode order is
    (episode_number = l_orderkey, episode_id = l_linenumber, l_partkey).
    """
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_suppkey").alias("show_id"),
        F.year("l_shipdate").alias("season"),
        F.col("l_orderkey").alias("episode_number"),
        F.col("l_linenumber").cast("bigint").alias("episode_id"),
        F.col("l_partkey"),
        F.col("l_quantity").cast("int").alias("episode_runtime"),
        F.col("l_discount").alias("episode_rating"),
        F.to_date("l_shipdate").alias("airdate"),
        F.col("l_returnflag").alias("episode_name"),
    )


VOLUME_ORDER = ("episode_number", "episode_id", "l_partkey")
