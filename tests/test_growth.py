"""What a query shuffles, sorts and opens follows its input, not its output (round 3 findings)."""

from __future__ import annotations

import re

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from tierflow.operators import scans, silver
from tierflow.plans import layer_queries
from tierflow.session import shared_path
from tierflow.sinks import tables, versions
from tierflow.sinks.versions import VersionedTable
from tierflow.streaming import incremental


def _large_show(spark):
    """Show 1 has 40 episodes and 30 cast entries, each twice; 2 no cast; 3 no genre; 4 no episode; 5 two languages."""
    shows = spark.createDataFrame([(1, "a", "x"), (2, "b", None), (3, "c", "y"), (4, "d", "y"), (5, "e", "x"), (5, "e", "y")], "show_id long, show_name string, language string")
    genres = spark.createDataFrame([(1, "g"), (1, "h"), (2, "g"), (2, "g"), (5, None)], "show_id long, genre string")
    few = F.explode(F.expr("CASE WHEN id % 2 = 0 THEN array(1) ELSE array(2, 3, 5) END"))
    eps = spark.range(80).select(F.lit(1).alias("show_id"), (F.col("id") % 5).cast("int").alias("season"), F.nullif((F.col("id") % 40).cast("string"), F.lit("7")).alias("episode_name"))
    eps = eps.unionByName(spark.range(2).select(few.alias("show_id"), F.lit(1).alias("season"), F.lit("p").alias("episode_name")))
    eps = eps.withColumns({"show_id": F.col("show_id").cast("long"), "airdate": F.lit("2024-01-01").cast("date"), "episode_runtime": F.lit(3)})
    cast = spark.range(60).select(F.lit(1).cast("long").alias("show_id"), (F.col("id") % 30).cast("string").alias("cast_name"), F.nullif(F.lit("m"), (F.col("id") % 3).cast("string")).alias("character_name"))
    return eps, shows, genres, cast.unionByName(spark.createDataFrame([(3, "q", None), (5, None, None)], cast.schema))


def _product(eps, shows, genres, cast):
    joined = eps.withColumnRenamed("episode_runtime", "runtime").join(shows, "show_id").join(genres, "show_id", "left").join(cast, "show_id", "left")
    return joined.select(*silver.FACT_COLUMNS).distinct()


def test_packed_fact_equals_the_product(spark):
    sides = _large_show(spark)
    for pack in (1, 3, 1000):
        packs = silver.fact_packs(*sides, pack=pack)
        assert rows(silver.unpack_fact(silver.dealt_packs(packs))) == rows(_product(*sides))
    assert silver.fact_packs(*sides, pack=3).agg(F.max(F.size("_episodes"))).first()[0] < 20  # a large show is divided


def test_fact_is_written_without_a_shuffle_or_sort_of_its_product(spark):
    sides = _large_show(spark)
    fact = silver.build_fact(*sides, timestamps=False, dealt=True)
    plan = fact._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert not any(x in plan[: plan.index("Generate explode(_cast")] for x in ("Exchange", "Sort "))
    path, before = shared_path(spark, "t", "fact"), spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    written = tables.write_table(fact, path, partition_by=["language"], unsorted=True)
    assert written == _product(*sides).count() and spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    assert rows(spark.read.parquet(path).select(*silver.FACT_COLUMNS)) == rows(_product(*sides))


def test_clustered_fact_is_unpacked_after_its_layout(spark):
    sides = _large_show(spark)
    path = shared_path(spark, "t", "clustered")
    packs = silver.fact_packs(*sides, pack=4)
    written = tables.cluster_table(packs, ["show_id", "genre"], path, partition_by=["language"], unpack=silver.unpack_fact)
    assert written == _product(*sides).count()
    assert rows(spark.read.parquet(path).select(*silver.FACT_COLUMNS)) == rows(_product(*sides))


def test_refresh_moves_only_keys_and_packs(spark, monkeypatch):
    """The plan of what a refresh writes: the table's rows meet a broadcast of keys, and are neither shuffled nor sorted."""
    eps, shows, genres, cast = _large_show(spark)
    late = F.when(F.col("show_id") == 1, F.lit("2024-02-01")).otherwise(F.lit("2024-01-01")).cast("date")
    eps = eps.withColumn("airdate", F.when(F.col("season") == 4, late).otherwise(F.lit("2024-01-01").cast("date")))
    table = VersionedTable(spark, shared_path(spark, "t", "refresh"))
    plans = []

    def kept(df, *args, write=tables.write_table, **kw):
        plans.append(df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1])
        return write(df, *args, **kw)

    monkeypatch.setattr(versions, "write_table", kept)
    for now in (eps.filter("airdate < '2024-02-01'"), eps, eps):
        incremental.refresh_fact(table, now, shows, genres, cast, {"episodes": "airdate"})
        assert rows(table.read().select(*silver.FACT_COLUMNS)) == rows(_product(now, shows, genres, cast))
    assert len(plans) == 2 and "BroadcastHashJoin" in plans[1]
    for plan in plans:
        assert not any(x in plan[: plan.index("Generate explode(_cast")] for x in (" Exchange", "Sort "))


def test_children_of_many_parents_land_in_few_files(spark, tmp_path, monkeypatch):
    sf = str(tmp_path / "sf")
    events = spark.range(3000).select(
        F.col("id").alias("event_id"), F.col("id").alias("user_id"), F.lit("a").alias("event_type"),
        F.timestamp_seconds(F.col("id") * 1000).alias("ts"), F.lit(1.5).alias("value"), F.lit("{}").alias("props"),
    )
    events.write.parquet(f"{sf}/events.parquet")
    root = str(tmp_path / "raw")
    monkeypatch.setattr(layer_queries, "shared_path", lambda *_: root)
    out = layer_queries.q_with_parent_key(spark, sf)
    assert rows(out, "episode_id", "show_id") == rows(events, "event_id", "user_id")
    tasks = spark.read.parquet(f"{sf}/events.parquet").rdd.getNumPartitions()
    assert spark.read.text(root).select("_metadata.file_path").distinct().count() <= layer_queries.PARENT_FOLDERS * tasks


def test_small_chunks_share_partitions(spark):
    df = spark.range(4000).select((F.col("id") % 400).alias("k"), F.col("id").alias("o"))
    chunks = scans.chunked(df, ["k"], [scans.ordered("o")], 2000, 4000)
    assert chunks.rdd.getNumPartitions() <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    sizes = [r[1] for r in chunks.groupBy("_tf_chunk").count().collect()]
    assert max(sizes) == 2 and sum(sizes) == 4000
    scanned = scans.segmented_scan(df, ["k"], ["o"], sums={"s": F.col("o")}, neighbours={"o": ("p", "n")}, rows_per_chunk=3)
    w = Window.partitionBy("k").orderBy("o")
    assert rows(scanned) == rows(df.withColumns({"s": F.sum("o").over(w), "p": F.lag("o").over(w), "n": F.lead("o").over(w)}))


def test_upsert_merges_a_fixed_number_of_rows_a_task(spark, monkeypatch):
    monkeypatch.setattr(incremental, "MERGE_ROWS", 50, raising=False)
    write, plans = versions.write_table, []

    def seen(df, *a, **k):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, *a, **k)

    monkeypatch.setattr(versions, "write_table", seen)
    names = ("spark.sql.shuffle.partitions", "spark.sql.files.minPartitionNum", "spark.sql.adaptive.coalescePartitions.enabled")
    before = [spark.conf.get(n, None) for n in names]
    t = VersionedTable(spark, shared_path(spark, "t", "merge"))
    large = {"spark.sql.autoBroadcastJoinThreshold": "-1"}  # as for keys too many to send around
    for snapshot, first in (("a", 0), ("b", 600)):
        batch = spark.range(first, 1000).select("id", F.lit(snapshot).alias("snapshot"), F.lit(snapshot).alias("_source_file"))
        with tables.session_settings(spark, large):
            assert incremental.upsert_batch(t, batch, {"id": "id"}, {"m": snapshot}, 2) == 1000 - first
        files = t.read().select("id", F.regexp_extract(F.input_file_name(), r"/data/(\w+)/.*/part-(\d+)", 2).alias("task"))
        assert files.groupBy("task").count().agg(F.max("count")).first()[0] <= 100
        assert [spark.conf.get(n, None) for n in names] == before
    assert rows(t.read(), "id", "snapshot") == rows(spark.range(1000).select("id", F.when(F.col("id") < 600, "a").otherwise("b").alias("snapshot")))
    by_file = r"SortMergeJoin \[_source_file#\d+\], \[_source_file#\d+\], LeftAnti"
    assert len(plans) == 2 and "LeftAnti" in plans[1] and not re.search(by_file, plans[1])
