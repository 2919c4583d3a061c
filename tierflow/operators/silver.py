"""Silver layer: flatten nested Bronze records, clean, bridge, and the fact table.

Every builder is lazy (DataFrame in, DataFrame out) and made of projections,
filters and generators, so Catalyst collapses a whole Bronze -> Silver step
into one narrow stage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.functions.columns import default, safe_cast, safe_date
from tierflow.sinks.products import Product

# (source path, output name, cast type or None) -- the flattening contracts.
ID_TYPE = "bigint"  # 64-bit ids: a 32-bit cast silently NULLs ids past 2^31 at scale

SHOW_SPEC: list[tuple[str, str, str | None]] = [
    ("id", "show_id", ID_TYPE),
    ("name", "show_name", None),
    ("type", "show_type", None),
    ("language", "language", None),
    ("genres", "genres", None),
    ("status", "status", None),
    ("runtime", "runtime", "int"),
    ("averageRuntime", "average_runtime", "int"),
    ("premiered", "premiered_date", None),
    ("ended", "ended_date", None),
    ("officialSite", "official_site", None),
    ("schedule.time", "schedule_time", None),
    ("schedule.days", "schedule_days", None),
    ("rating.average", "rating_average", "double"),
    ("network.id", "network_id", ID_TYPE),
    ("network.name", "network_name", None),
    ("network.country.name", "network_country", None),
    ("network.country.code", "network_country_code", None),
    ("webChannel.id", "web_channel_id", ID_TYPE),
    ("webChannel.name", "web_channel_name", None),
    ("externals.imdb", "imdb_id", None),
    ("externals.thetvdb", "thetvdb_id", ID_TYPE),
    ("image.medium", "image_url", None),
    ("weight", "weight", "int"),
]

EPISODE_SPEC: list[tuple[str, str, str | None]] = [
    ("id", "episode_id", ID_TYPE),
    ("show_id", "show_id", ID_TYPE),
    ("name", "episode_name", None),
    ("season", "season", "int"),
    ("number", "episode_number", ID_TYPE),
    ("type", "episode_type", None),
    ("airdate", "airdate", None),
    ("airtime", "airtime", None),
    ("runtime", "episode_runtime", "int"),
    ("rating.average", "episode_rating", "double"),
    ("image.medium", "episode_image_url", None),
]

CAST_SPEC: list[tuple[str, str, str | None]] = [
    ("show_id", "show_id", ID_TYPE),
    ("person.id", "person_id", ID_TYPE),
    ("person.name", "cast_name", None),
    ("person.country.name", "person_country", None),
    ("person.birthday", "person_birthday", None),
    ("person.gender", "person_gender", None),
    ("person.image.medium", "person_image_url", None),
    ("character.id", "character_id", ID_TYPE),
    ("character.name", "character_name", None),
    ("character.image.medium", "character_image_url", None),
    ("self", "is_self", None),
    ("voice", "is_voice", None),
]

META_IN = "_ingestion_timestamp"
META_OUT = "_silver_timestamp"


def _has_path(df: DataFrame, path: str) -> bool:
    try:
        df.select(F.col(path)).schema  # analysis only, no job
        return True
    except Exception:  # AnalysisException: field missing after schema evolution
        return False


def flatten(df: DataFrame, spec: Sequence[tuple[str, str, str | None]], keep: Sequence[str] = ()) -> DataFrame:
    """One projection: dotted struct access, rename and ANSI-safe cast.

    A path that is absent from ``df`` (an upstream field that disappeared)
    becomes a typed NULL column, so the Silver contract stays fixed.
    """
    cols: list[Column] = []
    for path, name, dtype in spec:
        if _has_path(df, path):
            c = F.col(path)
            cols.append((safe_cast(c, dtype) if dtype else c).alias(name))
        else:
            cols.append(F.lit(None).cast(dtype or "string").alias(name))
    cols.extend(F.col(k) for k in keep if k in df.columns)
    return df.select(*cols)


def _stamp(df: DataFrame, timestamps: bool) -> DataFrame:
    if not timestamps:
        return df.drop(META_IN)
    return df.withColumn(META_OUT, F.current_timestamp())


def silver_shows(bronze: DataFrame, timestamps: bool = True) -> DataFrame:
    """D-2: flatten 24 fields, null defaults, runtime fallback chain, dates."""
    flat = flatten(bronze, SHOW_SPEC, keep=[META_IN])
    out = flat.withColumns(
        {
            "show_name": default("show_name", "Unknown"),
            "language": default("language", "Unknown"),
            "status": default("status", "Unknown"),
            "runtime": default("runtime", F.col("average_runtime"), 0),
            "rating_average": default("rating_average", 0.0),
            "premiered_date": safe_date("premiered_date"),
            "ended_date": safe_date("ended_date"),
        }
    ).filter(F.col("show_id").isNotNull())
    return _stamp(out, timestamps)


def silver_episodes(bronze: DataFrame, timestamps: bool = True) -> DataFrame:
    """D-4: flatten 11 fields, defaults ('Untitled', 0, 0.0), date, key filter."""
    flat = flatten(bronze, EPISODE_SPEC, keep=[META_IN])
    out = flat.withColumns(
        {
            "episode_name": default("episode_name", "Untitled"),
            "episode_runtime": default("episode_runtime", 0),
            "episode_rating": default("episode_rating", 0.0),
            "airdate": safe_date("airdate"),
        }
    ).filter(F.col("episode_id").isNotNull() & F.col("show_id").isNotNull())
    return _stamp(out, timestamps)


def silver_cast(bronze: DataFrame, timestamps: bool = True) -> DataFrame:
    """D-5: flatten two struct levels, 'Unknown' defaults, key filter."""
    flat = flatten(bronze, CAST_SPEC, keep=[META_IN])
    out = flat.withColumns(
        {
            "cast_name": default("cast_name", "Unknown"),
            "character_name": default("character_name", "Unknown"),
            "person_country": default("person_country", "Unknown"),
        }
    ).filter(F.col("person_id").isNotNull() & F.col("show_id").isNotNull())
    return _stamp(out, timestamps)


def bridge_explode(
    df: DataFrame,
    key_cols: Sequence[str] = ("show_id", "show_name"),
    array_col: str = "genres",
    out_col: str = "genre",
    missing: str = "Unclassified",
) -> DataFrame:
    """D-3: one row per array element; NULL or empty arrays keep one row.

    The default is applied before ``trim``, so a blank element becomes ''
    rather than the placeholder (reference behaviour).
    """
    exploded = df.select(*key_cols, F.explode_outer(array_col).alias(out_col))
    return exploded.withColumn(out_col, F.trim(default(out_col, missing)))


FACT_COLUMNS = [
    "show_id", "show_name", "language", "genre", "season", "episode_name",
    "airdate", "runtime", "cast_name", "character_name",
]


# Entries of a pack at most, about: a packed fact row stands for PACK * PACK rows at most.
PACK = 256
# Parts that packs are dealt to for each core, at least.
DEALT = 4
# Packed rows dealt and sorted on these: a task has few languages, and shows that follow each other.
PACK_ORDER = ["language", "show_id", "show_name", "genre", "_cast_pack", "_episode_pack"]


def _packs(side: DataFrame, packs: str, number: str, size: int) -> DataFrame:
    """show_id, ``number`` and ``packs``: a sorted array of about ``size`` of the show's distinct entries at most.

    A show of more entries has several, dealt by hash, so no group grows with its show.
    """
    entries = [c for c in side.columns if c != "show_id"]
    side = side.distinct()
    large = side.groupBy("show_id").agg(F.ceil(F.count(F.lit(1)) / size).alias("_packs")).filter(F.col("_packs") > 1)
    here = F.pmod(F.xxhash64(*entries), F.coalesce("_packs", F.lit(1)))
    numbered = side.join(large, "show_id", "left").withColumn(number, here)
    return numbered.groupBy("show_id", number).agg(F.array_sort(F.collect_list(F.struct(*entries))).alias(packs))


def fact_packs(episodes: DataFrame, shows: DataFrame, genres: DataFrame, cast: DataFrame, pack: int = PACK) -> DataFrame:
    """The fact before its fan-out: show x genre x pack of episodes x pack of cast entries.

    Its size is that of the inputs, so it is what to shuffle, sort or keep; ``unpack_fact``
    makes the rows where they are written.
    """
    ep = _packs(
        episodes.select("show_id", "season", "episode_name", "airdate", F.col("episode_runtime").alias("runtime")),
        "_episodes", "_episode_pack", pack,
    )
    sh = shows.select("show_id", "show_name", "language").distinct()
    ge = genres.select("show_id", "genre").distinct()
    ca = _packs(cast.select("show_id", "cast_name", "character_name"), "_cast", "_cast_pack", pack)
    return sh.join(ep, "show_id", "inner").join(ge, "show_id", "left").join(ca, "show_id", "left")


def dealt_packs(packs: DataFrame) -> DataFrame:
    """Packed rows in as many parts as the session's shuffle partitions, ``DEALT`` a core at least, by language and show.

    The number is fixed: bytes of packs say nothing of the rows they stand for. Parts differ
    in rows, so there are several for a core.
    """
    spark = packs.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), DEALT * spark.sparkContext.defaultParallelism)
    return packs.repartitionByRange(parts, *PACK_ORDER).sortWithinPartitions(*PACK_ORDER)


def fact_product(packs: DataFrame, keep: Sequence[str] = ()) -> Product:
    """How the fact's rows are made of packed rows; a show without cast keeps its rows."""
    entries = {c: f"_episodes.{c}" for c in ("season", "episode_name", "airdate", "runtime")} | {c: f"_cast.{c}" for c in ("cast_name", "character_name")}
    return Product(packs, {c: entries.get(c, c) for c in [*FACT_COLUMNS, *keep]}, slow="_episodes", fast="_cast")


def unpack_fact(packs: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The fact rows of packed rows, in their order."""
    return fact_product(packs, keep).rows()


def build_fact(
    episodes: DataFrame,
    shows: DataFrame,
    genres: DataFrame,
    cast: DataFrame,
    timestamps: bool = True,
    dealt: bool = False,
    packed: bool = False,
) -> DataFrame | Product:
    """D-6: episodes x shows x genres x cast, one row per distinct combination.

    The reference builds the full product and then drops duplicates over all
    columns, which shuffles the product. Here every side is made distinct on
    the columns it contributes *before* the fan-out: the product of distinct
    sides joined on a key is already distinct, so the output equals
    ``dropDuplicates`` of the product. The joins carry packs of entries, which
    are opened last: no shuffle sees the product. ``dealt`` lays the packs out
    for a partitioned write (few languages a task, tasks of like size); ``packed`` gives
    them as they are, with how they are opened.
    """
    packs = fact_packs(episodes, shows, genres, cast)
    if timestamps:
        packs = packs.withColumn("_fact_created_at", F.current_timestamp())
    fact = fact_product(dealt_packs(packs) if dealt else packs, keep=["_fact_created_at"] if timestamps else [])
    return fact if packed else fact.rows()
