"""Versioned tables, refresh by a stored mark and keyed upserts from a stream."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tierflow.operators import silver
from tierflow.schemas import BRONZE_EPISODES
from tierflow.session import shared_path
from tierflow.sinks.versions import SchemaChange, VersionedTable
from tierflow.sources import ingest
from tierflow.streaming import incremental


def table(spark):
    return VersionedTable(spark, shared_path(spark, "t", "versions"))


def same(got, want):
    got = got.select(*want.columns)
    return got.count() == want.count() and got.exceptAll(want).count() == 0


def values(t, *cols):
    return sorted((tuple(r) for r in t.read().select(*cols).collect()), key=str)


# ------------------------------------------------------------------ schemas


def test_merged_schema_adds_drops_and_widens(spark):
    t = table(spark)
    assert t.current() is None
    t.publish(spark.createDataFrame([(1, 1.5, "a", (7,), [(1,)])], "id int, x float, gone string, s struct<a:int>, l array<struct<a:int>>"))
    later = spark.createDataFrame([(2**40, 0.1, "t", ("b", 2**40), [("z", 2)])], "id long, x double, tier string, s struct<b:string,a:long>, l array<struct<b:string,a:int>>")
    with pytest.raises(SchemaChange):
        t.publish(later, mode="append")
    done = t.publish(later, mode="append", schema="merge")
    assert (done.version, done.rows) == (2, 2)
    assert t.read().schema.simpleString() == "struct<id:bigint,x:double,gone:string,s:struct<a:bigint,b:string>,l:array<struct<a:int,b:string>>,tier:string>"
    rows = {r.id: r for r in t.read().collect()}
    assert (rows[1].x, rows[1].gone, rows[1].s.a, rows[1].s.b, rows[1].l[0].b, rows[1].tier) == (1.5, "a", 7, None, None, None)
    assert (rows[2**40].x, rows[2**40].gone, rows[2**40].s.a, rows[2**40].l[0].b, rows[2**40].tier) == (0.1, None, 2**40, "z", "t")
    # A full refresh that merges keeps the columns that stay away, as NULL.
    t.publish(spark.createDataFrame([(3,)], "id int"), schema="merge")
    assert values(t, "id", "gone", "tier") == [(3, None, None)] and t.read().columns == ["id", "x", "gone", "s", "l", "tier"]
    with pytest.raises(SchemaChange, match="id"):
        t.publish(spark.createDataFrame([("x",)], "id string"), schema="merge")
    assert t.current().version == 3


def test_schema_replaced_and_order_of_columns(spark):
    t = table(spark)
    t.publish(spark.createDataFrame([(1, "a")], "id int, name string"))
    t.publish(spark.createDataFrame([("b", 2)], "name string, id int"), mode="append")
    assert values(t, "id", "name") == [(1, "a"), (2, "b")]
    t.publish(spark.createDataFrame([("x", 1.0)], "id string, y double"), schema="replace")
    assert t.read().columns == ["id", "y"] and values(t, "id", "y") == [("x", 1.0)]
    with pytest.raises(ValueError):
        t.publish(spark.createDataFrame([(1,)], "z int"), mode="append", schema="replace")
    assert t.publish(spark.createDataFrame([], "id string, y double")).rows == 0 and t.read().count() == 0


@pytest.mark.parametrize("dies", ["_write", "_commit"])
def test_killed_write_leaves_the_old_version(spark, monkeypatch, dies):
    t = table(spark)
    t.publish(spark.createDataFrame([(1, "a")], "id int, p string"), partition_by=["p"], marks={"m": "1"})
    held = t.read()

    def die(*_, **__):
        raise OSError("killed")

    for write in (
        lambda: t.publish(spark.createDataFrame([(2, "b", 0)], "id int, p string, more int"), schema="merge", partition_by=["p"], marks={"m": "2"}),
        lambda: t.replace_partitions(spark.createDataFrame([(3, "a")], "id int, p string"), ["a"], rows_gone=1, marks={"m": "2"}),
    ):
        with monkeypatch.context() as patch:
            patch.setattr(VersionedTable, dies, die)
            with pytest.raises(OSError):
                write()
        assert values(t, "id", "p") == [(1, "a")] and t.marks() == {"m": "1"} and t.current().version == 1
    t.replace_partitions(spark.createDataFrame([(3, "a")], "id int, p string"), ["a"], rows_gone=1)
    assert values(t, "id", "p") == [(3, "a")] and t.marks() == {"m": "1"}
    assert [tuple(r) for r in held.collect()] == [(1, "a")]  # a reader of the old version still has its files
    assert t.vacuum() == (2 if dies == "_commit" else 0) and values(t, "id", "p") == [(3, "a")]


def test_replaced_partitions_are_pruned_and_forgotten(spark):
    t = table(spark)
    rows = [(i, p) for i, p in enumerate(["a", "b", None, "x:y", "a"])]
    t.publish(spark.createDataFrame(rows, "id int, p string"), partition_by=["p"])
    t.replace_partitions(spark.createDataFrame([(10, "x:y"), (11, None)], "id int, p string"), [None, "x:y"], rows_gone=2)
    done = t.replace_partitions(spark.createDataFrame([(20, "x:y")], "id int, p string"), [None, "x:y"], rows_gone=2)
    assert values(t, "id", "p") == [(0, "a"), (1, "b"), (20, "x:y"), (4, "a")] and done.rows == 4
    assert len(done.parts) == 2  # the first replacement is hidden as a whole
    plan = t.read()._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [NOT " in plan or "PartitionFilters: [(NOT " in plan
    assert t.compact().rows == 4 and len(t.current().parts) == 1 and values(t, "id") == [(0,), (1,), (20,), (4,)]


# ------------------------------------------------------------------ refresh


def stamped(df, when):
    return df.withColumn("stamp", F.lit(when).cast("timestamp"))


def built(s, e, g, c):
    return silver.build_fact(e, s, g, c, timestamps=False).select(*silver.FACT_COLUMNS)


def test_refresh_by_mark_equals_full_rebuild(spark, silver_layer, monkeypatch):
    s, e, g, c = (silver_layer[k] for k in ("shows", "episodes", "genres", "cast"))
    # shows 1 and 5 without a language, show 2 in a partition whose folder name is escaped
    odd = F.when(F.col("show_id").isin(1, 5), F.lit(None)).when(F.col("show_id") == 2, F.lit("x:y")).otherwise(F.col("language"))
    s1 = stamped(s.withColumn("language", odd.cast("string")), "2024-01-01")
    e1 = stamped(e.filter(F.col("season") == 1), "2024-01-01")
    t, by = table(spark), {"episodes": "stamp", "shows": "stamp"}
    incremental.refresh_fact(t, e1, s1, g, c, by)
    assert same(t.read(), built(s1, e1, g, c))
    # show 2 leaves x:y for en, show 1 gains its season 2
    moved = F.col("show_id") == 2
    s2 = s1.withColumns({"language": F.when(moved, F.lit("en")).otherwise(F.col("language")), "stamp": F.when(moved, F.lit("2024-01-02").cast("timestamp")).otherwise(F.col("stamp"))})
    e2 = e1.unionByName(stamped(e.filter(F.col("season") != 1), "2024-01-03"))

    def die(*_):
        raise OSError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(VersionedTable, "_commit", die)
        with pytest.raises(OSError):
            incremental.refresh_fact(t, e2, s2, g, c, by)
    assert same(t.read(), built(s1, e1, g, c))
    assert incremental.refresh_fact(t, e2, s2, g, c, by).version == 2
    want = built(s2, e2, g, c)
    assert same(t.read(), want) and t.read().filter("language = 'x:y'").count() == 0
    assert t.current().rows == want.count()
    # Nothing new: no version, no file.
    before = t.current()
    assert incremental.refresh_fact(t, e2, s2, g, c, by) is None and t.current() == before
    assert t.vacuum() == 1  # what the killed run had written


def test_refresh_of_rows_without_stamps_and_empty_inputs(spark, silver_layer):
    s, e, g, c = (silver_layer[k] for k in ("shows", "episodes", "genres", "cast"))
    bare = e.withColumn("stamp", F.lit(None).cast("timestamp"))
    t = table(spark)
    assert incremental.refresh_fact(t, bare.limit(0), s, g, c, {"episodes": "stamp"}).rows == 0
    assert incremental.refresh_fact(t, bare, s, g, c, {"episodes": "stamp"}) is None  # never new
    assert incremental.refresh_fact(t, stamped(e, "2024-01-01"), s, g, c, {"episodes": "stamp"}) is not None
    assert same(t.read(), built(s, e, g, c))


# ------------------------------------------------------------------ streams


def test_stream_counts_every_batch(spark, bronze):
    raw, target, ckpt = (shared_path(spark, "t", n) for n in ("raw", "target", "ckpt"))
    eps = bronze["episodes"].select(*BRONZE_EPISODES.fieldNames())
    for i in range(4):
        ingest.land_snapshot(eps.coalesce(1), raw, "episodes", snapshot=f"s{i}")
    n = incremental.ingest_incremental(spark, f"{raw}/episodes", BRONZE_EPISODES, target, ckpt, max_files_per_trigger=1)
    assert n == 44 == spark.read.parquet(target).count()
    assert incremental.ingest_incremental(spark, f"{raw}/episodes", BRONZE_EPISODES, target, ckpt) == 0


def test_upsert_keeps_the_newest_snapshot_of_each_key(spark, bronze):
    raw, t = shared_path(spark, "t", "raw"), table(spark)
    eps = bronze["episodes"].select(*BRONZE_EPISODES.fieldNames(), "_corrupt_record")
    run = lambda name, files=1: incremental.ingest_upsert(spark, f"{raw}/episodes", BRONZE_EPISODES, t, f"{t.root}/{name}", {"id": "id"}, max_files_per_trigger=files, buckets=4)
    plain = eps.drop("_corrupt_record")
    ingest.land_snapshot(plain.withColumn("runtime", F.lit(1).cast("bigint")).coalesce(2), raw, "episodes", snapshot="a")
    assert run("c1") == 11
    ingest.land_snapshot(plain.filter("season = 1").coalesce(1), raw, "episodes", snapshot="b")
    assert run("c1") == plain.filter("season = 1").count() and run("c1") == 0

    def state():
        return sorted((str(r.id), str(r.runtime), r.snapshot) for r in t.read().collect())

    keyed = plain.filter("id is not null")
    new = keyed.filter("season = 1")
    want = sorted([(str(r.id), str(r.runtime), "b") for r in new.collect()] + [(str(r.id), "1", "a") for r in keyed.join(new.select("id"), "id", "left_anti").collect()])
    rows = state()
    assert [r for r in rows if r[0] != "None"] == want
    assert t.current().rows == len(rows)
    # All files again, from a new checkpoint and in other batches: the same rows.
    assert run("c2", 2) > 0 and state() == rows
    ids = {r[0] for r in rows if r[0] != "None"}
    assert len([r for r in rows if r[0] != "None"]) == len(ids)


def test_replayed_batch_adds_nothing(spark, monkeypatch, bronze):
    raw, t = shared_path(spark, "t", "raw"), table(spark)
    plain = bronze["episodes"].select(*BRONZE_EPISODES.fieldNames())
    for snapshot in "ab":
        ingest.land_snapshot(plain.filter("id is not null").coalesce(1), raw, "episodes", snapshot=snapshot)
    args = (spark, f"{raw}/episodes", BRONZE_EPISODES, t, f"{t.root}/ckpt", {"id": "id"})
    upsert, calls = incremental.upsert_batch, []

    def dies_after_commit(*a):
        calls.append(upsert(*a))
        if len(calls) == 2:
            raise OSError("killed after the table's commit, before the stream's")
        return calls[-1]

    with monkeypatch.context() as patch:
        patch.setattr(incremental, "upsert_batch", dies_after_commit)
        with pytest.raises(Exception, match="killed"):
            incremental.ingest_upsert(*args, max_files_per_trigger=1)
    done = t.current()
    assert incremental.ingest_upsert(*args, max_files_per_trigger=1) == 0
    assert t.current() == done and t.read().count() == t.read().select("id").distinct().count()


def test_upsert_compacts_many_parts(spark, monkeypatch):
    monkeypatch.setattr(incremental, "MAX_PARTS", 2)
    t = table(spark)
    for i in range(6):
        batch = spark.createDataFrame([(j, i, f"s{i}", f"f{i}") for j in range(i, i + 3)], "id long, v int, snapshot string, _source_file string")
        assert incremental.upsert_batch(t, batch, {"id": "id"}, {"m": str(i)}, 50) == 3
        assert len(t.current().parts) <= 3
    assert values(t, "id", "v") == [(0, 0), (1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (6, 5), (7, 5)]
    assert t.marks() == {"m": "5"}
    assert incremental.upsert_batch(t, batch.limit(0), {"id": "id"}, {"m": "6"}, 50) == 0 and t.marks() == {"m": "6"}
