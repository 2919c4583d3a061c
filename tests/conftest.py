"""Shared fixtures: one local SparkSession and the JSON fixture layers."""

from __future__ import annotations

import os
import shutil
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

FIXTURES = os.path.join(ROOT, "tests", "fixtures")


@pytest.fixture(scope="session")
def spark():
    from tierflow.session import build_session

    # Tests are the one place where we set our own checkpoint folder.
    ckpt = tempfile.mkdtemp(prefix="tierflow-test-ckpt-")
    session = build_session(
        "local[4]",
        app_name="tierflow-tests",
        shuffle_partitions=4,
        conf={"spark.checkpoint.dir": ckpt},
    )
    session.sparkContext.setCheckpointDir(ckpt)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def raw_root(tmp_path_factory):
    """Fixture files laid out as snapshot folders: <root>/<entity>/snapshot=<ts>/."""
    root = tmp_path_factory.mktemp("raw")
    layout = {
        ("shows", "20240101_000000"): "shows_s1.jsonl",
        ("shows", "20240102_000000"): "shows_s2.jsonl",
        ("episodes", "20240101_000000"): "episodes.jsonl",
        ("cast", "20240101_000000"): "cast.jsonl",
    }
    for (entity, snap), name in layout.items():
        target = root / entity / f"snapshot={snap}"
        target.mkdir(parents=True)
        shutil.copy(os.path.join(FIXTURES, name), target / "part-00000.json")
    return str(root)


@pytest.fixture(scope="session")
def bronze(spark, raw_root):
    from tierflow.schemas import BRONZE_CAST, BRONZE_EPISODES, BRONZE_SHOWS
    from tierflow.sources.ingest import scan_json_permissive, with_ingest_metadata

    def scan(entity, schema):
        return with_ingest_metadata(scan_json_permissive(spark, f"{raw_root}/{entity}", schema), "fixture")

    return {
        "shows": scan("shows", BRONZE_SHOWS),
        "episodes": scan("episodes", BRONZE_EPISODES),
        "cast": scan("cast", BRONZE_CAST),
    }


@pytest.fixture(scope="session")
def silver_layer(spark, bronze):
    """Silver frames from the first snapshot of shows (the second is for T-1 tests)."""
    from pyspark.sql import functions as F

    from tierflow.operators import silver

    shows_s1 = bronze["shows"].filter(F.col("snapshot") == "20240101_000000")
    shows = silver.silver_shows(shows_s1, timestamps=False).cache()
    return {
        "shows": shows,
        "episodes": silver.silver_episodes(bronze["episodes"], timestamps=False).cache(),
        "cast": silver.silver_cast(bronze["cast"], timestamps=False).cache(),
        "genres": silver.bridge_explode(shows).cache(),
    }


def rows(df, *cols):
    """Sorted list of tuples for order-insensitive comparison."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))
