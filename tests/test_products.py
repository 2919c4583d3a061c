"""Files that Arrow writes from packed rows hold what Spark's rows of them would (round 4 findings)."""

from __future__ import annotations

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import rows
from test_growth import _large_show, _product
from tierflow.operators import silver
from tierflow.plans import adapters as A
from tierflow.plans import layer_queries, medallion
from tierflow.schemas import BRONZE_CAST
from tierflow.session import shared_path
from tierflow.sinks import products, tables
from tierflow.sinks.versions import VersionedTable
from tierflow.sources import ingest
from tierflow.streaming import incremental

STAMP = "_fact_created_at"


def _odd(spark):
    """The large show, with partition values whose folder names are escaped or missing, and a stamp."""
    eps, shows, genres, cast = _large_show(spark)
    shows = shows.unionByName(spark.createDataFrame([(5, "e", 'a/b:c%#"?'), (5, "e", ""), (3, None, "größe }{")], shows.schema))
    return silver.fact_packs(eps, shows, genres, cast, pack=7).withColumn(STAMP, F.timestamp_micros(F.lit(1700000000123456)))


@pytest.mark.parametrize("group_rows", [1, 50, 1 << 20])
def test_written_rows_are_the_rows(spark, monkeypatch, group_rows):
    monkeypatch.setattr(products, "GROUP_ROWS", group_rows)
    monkeypatch.setattr(products, "BATCH_PACKS", 3)
    monkeypatch.setattr(products, "OPEN_FILES", 2)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    product = silver.fact_product(_odd(spark).repartition(3), keep=[STAMP])
    paths = [shared_path(spark, "t", n) for n in ("spark", "arrow")]
    written = [tables.write_table(product.rows(), paths[0], partition_by=["language"]), products.write_product(product, paths[1], ["language"])]
    plain, packed = (spark.read.parquet(p) for p in paths)
    assert written == [plain.count()] * 2 and packed.dtypes == plain.dtypes
    assert rows(packed) == rows(plain)
    assert packed.filter("language = 'größe }{' AND show_name IS NULL").count() > 0 and packed.filter("cast_name IS NULL").count() > 0
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_append_overwrite_and_what_cannot_be_written(spark):
    packs = _odd(spark)
    product, path = silver.fact_product(packs), shared_path(spark, "t", "twice")
    once = products.write_product(product, path)
    assert products.write_product(product, path, mode="append") == once and spark.read.parquet(path).count() == 2 * once
    assert products.write_product(product, path) == once and spark.read.parquet(path).count() == once
    assert products.write_product(product, path, ["language", "genre"]) is None
    assert products.write_product(product, path, ["season"]) is None  # no column of the packs
    assert products.write_product(silver.fact_product(packs.limit(0)), path) is None
    assert products.write_product(product, "no-such-scheme://a/b") is None
    with tables.session_settings(spark, {"spark.sql.parquet.compression.codec": "lz4"}):
        assert tables.write_table(product.rows(), shared_path(spark, "t", "lz4"), partition_by=["language"], product=product) == once
    assert spark.read.parquet(path).count() == once
    assert not [f for f in os.listdir(os.path.dirname(path.removeprefix("file:"))) if f.startswith("_staging")]


def test_a_failed_write_leaves_the_table_as_it_was(spark):
    packs = _odd(spark)
    path = shared_path(spark, "t", "failing")
    once = products.write_product(silver.fact_product(packs), path, ["language"])
    bad = packs.withColumn("show_name", F.when(F.col("show_id") == 5, F.raise_error(F.lit("no"))).otherwise(F.col("show_name")))
    with pytest.raises(Exception, match="no"):
        products.write_product(silver.fact_product(bad), path, ["language"])
    assert spark.read.parquet(path).count() == once
    assert not [f for f in os.listdir(os.path.dirname(path.removeprefix("file:"))) if f.startswith("_staging")]


def test_fact_queries_make_no_row_objects(spark, monkeypatch):
    """fact_table's files come from packed rows: Spark's row writer is never asked."""
    calls = []
    monkeypatch.setattr(tables, "Observation", lambda *_: calls.append(1))
    out = layer_queries.q_fact_table(spark, "/root/testdata/sf0.001")
    assert not calls and out.columns == silver.FACT_COLUMNS and out.count() > 0


def test_packed_fact_is_the_fact(spark):
    sides = _large_show(spark)
    fact = silver.build_fact(*sides, timestamps=False, dealt=True, packed=True)
    path = shared_path(spark, "t", "fact")
    assert tables.write_table(fact.rows(), path, partition_by=["language"], unsorted=True, product=fact) == _product(*sides).count()
    assert rows(spark.read.parquet(path).select(*silver.FACT_COLUMNS)) == rows(_product(*sides))


def test_a_run_holds_less_than_its_raw_text(spark, tmp_path):
    """medallion_dashboard: raw lines land compressed, one snapshot is not shuffled to be compared, shuffles go with their jobs."""
    sf = "/root/testdata/sf0.01"
    lines, packed = str(tmp_path / "lines"), str(tmp_path / "packed")
    for root, codec in ((lines, None), (packed, "gzip")):
        ingest.land_snapshot(A.bronze_cast(spark, sf), root, "cast", snapshot="s1", compression=codec)
    size = lambda root: sum(f.stat().st_size for f in Path(root).rglob("part-*"))
    assert size(packed) < size(lines) / 5
    scans = [ingest.scan_json_permissive(spark, f"{root}/cast", BRONZE_CAST) for root in (lines, packed)]
    assert rows(scans[0]) == rows(scans[1])
    assert "Exchange" not in medallion._latest(scans[1], "cast")._jdf.queryExecution().executedPlan().toString()
    ingest.land_snapshot(A.bronze_cast(spark, sf).limit(10), packed, "cast", snapshot="s2", compression="gzip")
    again = ingest.scan_json_permissive(spark, f"{packed}/cast", BRONZE_CAST)
    assert ingest.snapshots(again) == {"s1", "s2"}
    assert "Exchange" in medallion._latest(again, "cast")._jdf.queryExecution().executedPlan().toString()


def test_compressed_snapshots_are_divided(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ingest, "PACKED_LINES", 10)
    path = ingest.land_snapshot(spark.range(95).coalesce(1), str(tmp_path), "n", snapshot="a", compression="gzip")
    assert len(list(Path(path).glob("part-*.json.gz"))) == 10 and spark.read.json(path).count() == 95


def test_brief_shuffles_leave_the_setting_as_it_was(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    with tables.brief_shuffles(spark):
        assert spark.conf.get(name) == "true" and spark.range(100).repartition(3).groupBy().count().first()[0] == 100
    assert spark.conf.get(name, None) == before


def test_refreshed_rows_come_from_packs_and_kept_rows_from_the_table(spark, monkeypatch):
    eps, shows, genres, cast = _large_show(spark)
    made, write = [], tables.write_product
    monkeypatch.setattr(tables, "write_product", lambda *a: made.append(write(*a)) or made[-1])
    day = lambda d, hit: F.when(hit, F.lit(d)).otherwise(F.lit("2024-01-01")).cast("date")
    first = eps.withColumn("airdate", day("2024-01-02", F.lit(False)))
    some = eps.withColumn("airdate", day("2024-01-02", (F.col("show_id") == 1) & (F.col("season") == 4)))
    every = eps.withColumn("airdate", day("2024-01-03", F.lit(True)))
    table = VersionedTable(spark, shared_path(spark, "t", "refreshed"))
    for now, changed in ((first, None), (some, 1), (every, None)):
        done = incremental.refresh_fact(table, now, shows, genres, cast, {"episodes": "airdate"})
        want = _product(now, shows, genres, cast)
        assert rows(table.read().select(*silver.FACT_COLUMNS)) == rows(want) and done.rows == want.count()
        assert made[-1] == (want if changed is None else want.filter(F.col("show_id") == changed)).count()
    keys = spark.createDataFrame([(1,), (9,)], "show_id long")
    held = incremental.held_rows(table.read().withColumn("value", F.col("language")), keys, "show_id")
    counted = {r[0]: (r[1], r[2]) for r in table.read().groupBy("language").agg(F.count(F.lit(1)), F.count_if(F.col("show_id") == 1)).collect()}
    assert held == counted and None in held
