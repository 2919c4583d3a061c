"""Data-quality report, table layout operators and incremental processing."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from tierflow.operators import quality, silver
from tierflow.schemas import BRONZE_EPISODES, REQUIRED_SILVER_SHOW_COLUMNS
from tierflow.session import local_fs_path, shared_path
from tierflow.sinks import tables
from tierflow.sources import ingest
from tierflow.streaming import incremental


def _report_dict(df):
    return {(r["check"], r["table_name"]): (r["violations"], r["total"], r["passed"]) for r in df.collect()}


def test_silver_report_on_fixtures(silver_layer):
    s = silver_layer
    rep = _report_dict(quality.silver_report(s["shows"], s["episodes"], s["cast"]))
    assert rep[("not_null:show_id", "silver_shows")] == (0, 5, "pass")
    assert rep[("unique:show_id", "silver_shows")] == (0, 5, "pass")
    assert rep[("rating_range_0_10", "silver_shows")] == (1, 5, "fail")  # 12.5
    assert rep[("runtime_positive", "silver_shows")] == (1, 5, "fail")  # T-2: defaulted 0
    assert rep[("references:silver_shows.show_id", "silver_episodes")] == (1, 10, "fail")  # show 99
    assert rep[("references:silver_shows.show_id", "silver_cast")] == (1, 6, "fail")  # show 77
    summary = {r["passed"]: r["checks"] for r in quality.summary(quality.silver_report(s["shows"], s["episodes"], s["cast"])).collect()}
    assert summary == {"pass": 4, "fail": 4}


def test_each_check_detects_injected_failure(spark, silver_layer):
    s = silver_layer["shows"]
    bad_nulls = quality.inject_nulls(s, "show_id", F.col("show_id") == 1)
    assert quality.not_null(bad_nulls, "t", "silver", ["show_id"]).first()["violations"] == 1
    dup = s.unionByName(s.filter(F.col("show_id") == 2))
    assert quality.unique_key(dup, "t", "silver", "show_id").first()["violations"] == 1
    neg = s.withColumn("rating_average", F.lit(-1.0))
    checks = {"rating_range_0_10": F.col("rating_average").isNotNull() & ((F.col("rating_average") < 0) | (F.col("rating_average") > 10))}
    assert quality.row_checks(neg, "t", "silver", checks).first()["violations"] == 5
    e = silver_layer["episodes"].withColumn("show_id", F.lit(12345).cast("bigint"))
    assert quality.referential(e, s, "show_id", "t", "silver", "shows").first()["violations"] == 10
    # DQ-7: the reference's own injected row, with an explicit schema
    bad = spark.createDataFrame([(None, "Bad Show", 5.0)], "show_id int, show_name string, rating_average double")
    assert quality.not_null(bad, "bad", "silver", ["show_id"]).first()["passed"] == "fail"


def test_schema_checks(spark, bronze, silver_layer):
    good = quality.schema_checks(
        spark,
        {"silver_shows": ("silver", silver_layer["shows"]), "silver_show_genres": ("silver", silver_layer["genres"])},
        required={"silver_shows": REQUIRED_SILVER_SHOW_COLUMNS - {"_silver_timestamp"}},
        types=quality.SILVER_TYPES,
        scalar_columns={"silver_show_genres": ["genre"]},
    )
    assert all(r["passed"] == "pass" for r in good.collect())
    broken = quality.schema_checks(
        spark,
        {"silver_shows": ("silver", silver_layer["shows"].drop("network_name")), "silver_show_genres": ("silver", silver_layer["shows"])},
        required={"silver_shows": REQUIRED_SILVER_SHOW_COLUMNS},
        types={"silver_shows": {"rating_average": (type(None),)}},
        scalar_columns={"silver_show_genres": ["genres"]},
    )
    failed = {r["check"] for r in broken.collect() if r["passed"] == "fail"}
    assert failed == {"required_columns", "type:rating_average", "scalar:genres"}


def test_write_table_partitioned_and_pruned(spark, silver_layer):
    path = shared_path(spark, "t", "episodes_by_season")
    n = tables.write_table(silver_layer["episodes"], path, partition_by=["season"], rebalance=True)
    assert n == 10
    read = spark.read.parquet(path).filter(F.col("season") == 2)
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(season" in plan and "(season#" in plan
    assert read.count() == 2


def test_cluster_table_keeps_rows(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/events.parquet").select("event_id", "user_id", "value")
    path = shared_path(spark, "t", "events_z")
    assert tables.cluster_table(df, ["user_id", "value"], path, files=4, bits=6) == df.count()
    back = spark.read.parquet(path)
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0


def test_layer_counts_views_listing(spark, silver_layer):
    counts = {r["table_name"]: r["row_count"] for r in tables.layer_counts({"a": silver_layer["shows"], "b": silver_layer["cast"]}).collect()}
    assert counts == {"a": 5, "b": 6}
    tables.publish_view(spark, "fixture_shows_v", silver_layer["shows"])
    assert "fixture_shows_v" in {r["tableName"] for r in tables.list_tables(spark).collect()}
    assert tables.describe_table(spark, "fixture_shows_v").count() > 0


def test_land_snapshot_is_immutable(spark, silver_layer):
    root = shared_path(spark, "raw")
    ingest.land_snapshot(silver_layer["shows"].select("show_id"), root, "shows", snapshot="x")
    try:
        ingest.land_snapshot(silver_layer["shows"].select("show_id"), root, "shows", snapshot="x")
        raised = False
    except Exception:
        raised = True
    assert raised


def test_ingest_incremental_available_now(spark, bronze):
    raw = shared_path(spark, "raw")
    target = shared_path(spark, "t", "stream_target")
    ckpt = shared_path(spark, "ckpt", "stream")
    eps = bronze["episodes"].select(*BRONZE_EPISODES.fieldNames())
    ingest.land_snapshot(eps.filter(F.col("season") == 1), raw, "episodes", snapshot="a")
    first = incremental.ingest_incremental(spark, f"{raw}/episodes", BRONZE_EPISODES, target, ckpt)
    ingest.land_snapshot(eps.filter(F.col("season") != 1), raw, "episodes", snapshot="b")
    second = incremental.ingest_incremental(spark, f"{raw}/episodes", BRONZE_EPISODES, target, ckpt)
    third = incremental.ingest_incremental(spark, f"{raw}/episodes", BRONZE_EPISODES, target, ckpt)
    assert (first, second, third) == (9, 2, 0)
    assert spark.read.parquet(target).count() == 11


def test_run_medallion_end_to_end(spark, raw_root):
    from tierflow.plans.medallion import MedallionConfig, run_medallion

    out = shared_path(spark, "medallion")
    res = run_medallion(spark, MedallionConfig(raw_root=raw_root, out_root=out))
    rows_ = res.rows
    assert rows_["bronze_shows"] == 7  # 5 ids (newest snapshot wins) + NULL id + corrupt line
    assert rows_["silver_shows"] == 5 and rows_["silver_episodes"] == 10 and rows_["silver_cast"] == 6
    assert rows_["silver_show_genres"] == 8 and rows_["gold_show_dashboard"] == 5
    dash = {r["show_id"]: r for r in spark.read.parquet(res.paths["gold_show_dashboard"]).collect()}
    assert dash[1]["show_name"] == "Alpha Renamed" and dash[1]["total_episodes"] == 6
    dq = {(r["check"], r["table_name"]): r["violations"] for r in spark.read.parquet(res.paths["dq_report"]).collect()}
    assert dq[("unique:show_id", "silver_shows")] == 0  # T-1 handled before Silver
    fact = spark.read.parquet(res.paths["fact_show_data"])
    assert "language" in fact.columns and fact.filter(F.col("show_id") == 4).count() == 3


def test_require_gate(silver_layer):
    import pytest

    s = silver_layer
    report = quality.silver_report(s["shows"], s["episodes"], s["cast"]).cache()
    with pytest.raises(quality.QualityError, match="rating_range_0_10"):
        quality.require(report)
    quality.require(
        report, allow=["rating_range_0_10", "runtime_positive", "references:silver_shows.show_id"]
    )


def test_named_table_and_persistent_view(spark, silver_layer):
    tables.ensure_schema(spark, "tierflow_t")
    path = shared_path(spark, "t", "named_shows")
    n = tables.write_table(silver_layer["shows"].select("show_id", "show_name"), path, name="tierflow_t.shows_tbl")
    assert n == 5 and spark.table("tierflow_t.shows_tbl").count() == 5
    view = tables.publish_view(spark, "tierflow_t.tv_shows", "tierflow_t.shows_tbl", temporary=False)
    assert view.count() == 5
    assert "shows_tbl" in {r["tableName"] for r in tables.list_tables(spark, "tierflow_t").collect()}


def test_medallion_clustering_keeps_rows(spark, raw_root):
    from tierflow.plans.medallion import CLUSTER_BY, MedallionConfig, run_medallion

    res = run_medallion(spark, MedallionConfig(raw_root=raw_root, out_root=shared_path(spark, "medallion_c"), cluster_files=2))
    for table in CLUSTER_BY:
        assert res.paths[table].endswith("_clustered")
        assert res.rows[f"{table}_clustered"] == res.rows[table]
    fact = spark.read.parquet(res.paths["fact_show_data"])
    assert "language" in fact.columns and fact.count() == res.rows["fact_show_data"]


def test_report_reads_each_table_once(spark):
    """Duplicates, orphans, NULL keys and values against single checks; one scan a table."""
    paths = {n: shared_path(spark, "t", n) for n in ("shows", "episodes", "cast")}
    spark.createDataFrame([(1, 5.0, 30), (1, 11.0, 0), (2, None, None), (None, -1.0, 5), (None, 1.0, 5)], "show_id long, rating_average double, runtime int").write.parquet(paths["shows"])
    spark.createDataFrame([(1, 1), (None, 1), (2, 9), (3, None)], "episode_id long, show_id long").write.parquet(paths["episodes"])
    spark.createDataFrame([], "person_id long, show_id long").write.parquet(paths["cast"])
    s, e, c = (spark.read.parquet(paths[n]) for n in ("shows", "episodes", "cast"))
    report = quality.silver_report(s, e, c)
    single = [
        quality.row_checks(s, "silver_shows", "silver", {n: F.expr(p) for n, p in quality.SHOW_CHECKS.items()}),
        quality.unique_key(s, "silver_shows", "silver", "show_id"),
        quality.not_null(e, "silver_episodes", "silver", ["episode_id"]),
        quality.referential(e, s, "show_id", "silver_episodes", "silver", "silver_shows"),
        quality.not_null(c, "silver_cast", "silver", ["person_id"]),
        quality.referential(c, s, "show_id", "silver_cast", "silver", "silver_shows"),
    ]
    want = {}
    for part in single:
        want |= _report_dict(part)
    assert _report_dict(report) == want
    assert want[("unique:show_id", "silver_shows")][0] == 2 and want[("references:silver_shows.show_id", "silver_episodes")][0] == 2
    plan = quality.silver_report(s, e, c)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 3


def test_corrupt_lines_are_observed_while_bronze_is_written(spark, raw_root):
    from tierflow.plans.medallion import MedallionConfig, run_medallion

    res = run_medallion(spark, MedallionConfig(raw_root=raw_root, out_root=shared_path(spark, "medallion_d"), cluster=False))
    dq = {r["table_name"]: (r["violations"], r["total"]) for r in spark.read.parquet(res.paths["dq_report"]).filter("check = 'corrupt_lines'").collect()}
    bronze = {n: spark.read.parquet(res.paths[n]) for n in ("bronze_shows", "bronze_episodes", "bronze_cast")}
    assert dq == {n: (df.filter("_corrupt_record is not null").count(), df.count()) for n, df in bronze.items()}
    assert dq["bronze_shows"][0] == 1


def test_compaction_follows_the_bytes(spark):
    many, few = shared_path(spark, "t", "many"), shared_path(spark, "t", "few")
    tables.write_table(spark.range(20_000).repartition(12), many)
    total = sum(r["bytes"] for r in tables.file_sizes(spark.read.parquet(many)).collect())
    assert tables.compact_table(spark, many, few, target_bytes=total // 3 + 1) == 20_000
    out = spark.read.parquet(few)
    assert tables.file_sizes(out).count() == 3 and out.select("id").distinct().count() == 20_000
    empty = shared_path(spark, "t", "empty")
    tables.write_table(spark.range(0), empty)
    assert tables.compact_table(spark, empty, shared_path(spark, "t", "empty2")) == 0
