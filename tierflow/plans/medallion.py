"""End-to-end layer run: raw JSON snapshots -> Bronze -> Silver -> fact -> Gold -> DQ.

Plain function composition of the operators (no scheduler): each layer is
written as Parquet under ``out_root`` and the next layer reads the written
tables, so every layer boundary is a lineage cut in shared storage (the
reference's hand-over between notebooks). Row counts are observed during the
writes, not recomputed afterwards. Finally the Silver and Gold tables are
rewritten clustered on the reference's Z-order columns (to new paths, which
then become the published ones).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.operators import gold, quality, silver
from tierflow.schemas import BRONZE_SCHEMAS, CORRUPT_COLUMN
from tierflow.sinks.products import Product
from tierflow.sinks.tables import brief_shuffles, cluster_table, session_settings, write_table
from tierflow.sources import ingest


@dataclass
class MedallionConfig:
    raw_root: str  # <raw_root>/<entity>/snapshot=<ts>/*.json
    out_root: str  # tables are written to <out_root>/<layer>/<table>
    source: str = "raw_json"
    dedupe_snapshots: bool = True  # T-1: keep the newest version of each key
    cluster: bool = True  # rewrite Silver/Gold tables clustered (OPTIMIZE ... ZORDER BY)
    cluster_files: int | None = None  # default: the session's shuffle partitions
    codec: str = "zstd"  # of the tables' files
    # Checks that may fail; None: report only, () : every failed check stops the run.
    allow_failed: tuple[str, ...] | None = None


@dataclass
class MedallionResult:
    paths: dict[str, str] = field(default_factory=dict)
    rows: dict[str, int] = field(default_factory=dict)


# Natural keys of the Bronze entities (fixed values).
# Clustering columns per table (fixed values, the reference's ZORDER choices).
# The rows of the cast are the most that a rewrite shuffles: it runs before the larger files are there.
CLUSTER_BY = {
    "silver_cast": ["show_id", "person_id"],
    "silver_shows": ["show_id"],
    "silver_episodes": ["show_id", "season"],
    "gold_episodes_per_season": ["show_id"],
    "gold_avg_runtime_per_show": ["show_id"],
    "gold_top_cast_members": ["cast_rank"],
    "gold_genre_statistics": ["genre_rank"],
    "gold_show_dashboard": ["overall_rank"],
    "fact_show_data": ["show_id", "genre"],
}
PARTITIONED_BY = {"fact_show_data": ["language"]}
FACT_STAMP = "_fact_created_at"

BRONZE_KEYS = {
    "shows": {"id": "id"},
    "episodes": {"id": "id"},
    "cast": {"_k_show": "show_id", "_k_person": "person.id", "_k_character": "character.id"},
}


def _latest(scanned: DataFrame, entity: str) -> DataFrame:
    """T-1 across snapshots on the entity's natural key (rows without a key are kept, T-14).

    Rows are superseded by a later snapshot only: all rows of a single one are its newest.
    """
    if len(ingest.snapshots(scanned)) == 1:
        return scanned
    keys = BRONZE_KEYS[entity]
    keyed = scanned.withColumns({k: F.col(path) for k, path in keys.items() if k != path})
    latest = ingest.latest_per_key(keyed, list(keys), ["snapshot"])
    return latest.drop(*[k for k, path in keys.items() if k != path])


def _write(spark: SparkSession, result: MedallionResult, layer: str, name: str, df: DataFrame, cfg: MedallionConfig, **kw) -> DataFrame:
    path = f"{cfg.out_root.rstrip('/')}/{layer}/{name}"
    result.rows[name] = write_table(df, path, **kw)
    result.paths[name] = path
    return spark.read.parquet(path)


def _fact(packs: DataFrame) -> Product:
    return silver.fact_product(packs, keep=[FACT_STAMP])


def run_medallion(spark: SparkSession, cfg: MedallionConfig) -> MedallionResult:
    """Every layer of a run; each step's shuffle files go when it has been written, not when the driver collects garbage."""
    with brief_shuffles(spark), session_settings(spark, {"spark.sql.parquet.compression.codec": cfg.codec}):
        return _run(spark, cfg)


def _run(spark: SparkSession, cfg: MedallionConfig) -> MedallionResult:
    result = MedallionResult()

    bronze: dict[str, DataFrame] = {}
    corrupt: dict[str, tuple[int, int]] = {}
    for entity, schema in BRONZE_SCHEMAS.items():
        scanned = ingest.with_ingest_metadata(
            ingest.scan_json_permissive(spark, f"{cfg.raw_root.rstrip('/')}/{entity}", schema), cfg.source
        )
        if cfg.dedupe_snapshots:
            scanned = _latest(scanned, entity)
        found: dict[str, object] = {}
        metrics = {"corrupt": F.count(CORRUPT_COLUMN)}
        bronze[entity] = _write(spark, result, "bronze", f"bronze_{entity}", scanned, cfg, metrics=metrics, measured=found)
        corrupt[f"bronze_{entity}"] = (found["corrupt"] or 0, result.rows[f"bronze_{entity}"])

    shows = _write(spark, result, "silver", "silver_shows", silver.silver_shows(bronze["shows"]), cfg)
    genres = _write(spark, result, "silver", "silver_show_genres", silver.bridge_explode(shows), cfg)
    episodes = _write(spark, result, "silver", "silver_episodes", silver.silver_episodes(bronze["episodes"]), cfg)
    cast = _write(spark, result, "silver", "silver_cast", silver.silver_cast(bronze["cast"]), cfg)
    # The fact's rows are many times its inputs': the files of both its layouts are made from
    # this table, so that no shuffle or sort sees them.
    stamped = silver.fact_packs(episodes, shows, genres, cast).withColumn(FACT_STAMP, F.current_timestamp())
    packs = _write(spark, result, "silver", "fact_packs", stamped, cfg)
    fact = _fact(silver.dealt_packs(packs))
    _write(
        spark, result, "silver", "fact_show_data", fact.rows(), cfg,
        partition_by=PARTITIONED_BY["fact_show_data"], unsorted=True, product=fact,
    )

    _write(spark, result, "gold", "gold_episodes_per_season", gold.episodes_per_season(episodes, shows), cfg)
    _write(spark, result, "gold", "gold_avg_runtime_per_show", gold.avg_runtime_per_show(episodes, shows), cfg)
    _write(spark, result, "gold", "gold_top_cast_members", gold.top_cast_members(cast), cfg)
    _write(spark, result, "gold", "gold_genre_statistics", gold.genre_statistics(genres, shows), cfg)
    _write(spark, result, "gold", "gold_show_dashboard", gold.show_dashboard(shows, episodes, cast, genres), cfg)

    report = quality.silver_report(shows, episodes, cast).unionByName(quality.corrupt_report(spark, corrupt))
    _write(spark, result, "quality", "dq_report", report, cfg)

    if cfg.allow_failed is not None:
        quality.require(spark.read.parquet(result.paths["dq_report"]), cfg.allow_failed)

    if cfg.cluster:
        for table, columns in CLUSTER_BY.items():
            source, unpack = (packs, _fact) if table == "fact_show_data" else (spark.read.parquet(result.paths[table]), None)
            target = f"{result.paths[table]}_clustered"
            result.rows[f"{table}_clustered"] = cluster_table(
                source, columns, target, files=cfg.cluster_files, partition_by=PARTITIONED_BY.get(table, ()), unpack=unpack
            )
            result.paths[table] = target
    return result
