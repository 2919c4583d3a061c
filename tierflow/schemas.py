"""Explicit schemas for the Bronze layer and the Silver contracts.

Bronze is read with a declared schema (plus ``_corrupt_record``) instead of
inference: inference is an extra pass over every raw file, and a field that is
absent from a sample would turn a later ``col("person.name")`` into an
analysis error.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

CORRUPT_COLUMN = "_corrupt_record"


def _s(*fields: StructField) -> StructType:
    return StructType(list(fields))


def _f(name: str, dtype, nullable: bool = True) -> StructField:
    return StructField(name, dtype, nullable)


IMAGE = _s(_f("medium", StringType()))
RATING = _s(_f("average", DoubleType()))

BRONZE_SHOWS = _s(
    _f("id", LongType()),
    _f("name", StringType()),
    _f("type", StringType()),
    _f("language", StringType()),
    _f("genres", ArrayType(StringType())),
    _f("status", StringType()),
    _f("runtime", LongType()),
    _f("averageRuntime", LongType()),
    _f("premiered", StringType()),
    _f("ended", StringType()),
    _f("officialSite", StringType()),
    _f("schedule", _s(_f("time", StringType()), _f("days", ArrayType(StringType())))),
    _f("rating", RATING),
    _f(
        "network",
        _s(
            _f("id", LongType()),
            _f("name", StringType()),
            _f("country", _s(_f("name", StringType()), _f("code", StringType()))),
        ),
    ),
    _f("webChannel", _s(_f("id", LongType()), _f("name", StringType()))),
    _f("externals", _s(_f("imdb", StringType()), _f("thetvdb", LongType()))),
    _f("image", IMAGE),
    _f("weight", LongType()),
)

BRONZE_EPISODES = _s(
    _f("id", LongType()),
    _f("show_id", LongType()),
    _f("name", StringType()),
    _f("season", LongType()),
    _f("number", LongType()),
    _f("type", StringType()),
    _f("airdate", StringType()),
    _f("airtime", StringType()),
    _f("runtime", LongType()),
    _f("rating", RATING),
    _f("image", IMAGE),
)

BRONZE_CAST = _s(
    _f("show_id", LongType()),
    _f(
        "person",
        _s(
            _f("id", LongType()),
            _f("name", StringType()),
            _f("country", _s(_f("name", StringType()))),
            _f("birthday", StringType()),
            _f("gender", StringType()),
            _f("image", IMAGE),
        ),
    ),
    _f("character", _s(_f("id", LongType()), _f("name", StringType()), _f("image", IMAGE))),
    _f("self", BooleanType()),
    _f("voice", BooleanType()),
)

BRONZE_SCHEMAS = {"shows": BRONZE_SHOWS, "episodes": BRONZE_EPISODES, "cast": BRONZE_CAST}

INGEST_METADATA = _s(
    _f("_ingestion_timestamp", TimestampType()),
    _f("_source", StringType()),
    _f("_source_file", StringType()),
)


def with_corrupt_column(schema: StructType) -> StructType:
    """Schema plus the permissive-mode corrupt-record column."""
    if CORRUPT_COLUMN in schema.fieldNames():
        return schema
    return StructType(schema.fields + [StructField(CORRUPT_COLUMN, StringType(), True)])


# Column sets the data-quality schema checks require (fixed values).
REQUIRED_BRONZE_SHOW_COLUMNS = frozenset(
    {"id", "name", "type", "language", "genres", "status", "runtime", "premiered",
     "rating", "network", "_ingestion_timestamp", "_source"}
)
REQUIRED_SILVER_SHOW_COLUMNS = frozenset(
    {"show_id", "show_name", "show_type", "language", "status", "runtime", "premiered_date",
     "rating_average", "network_name", "network_country", "_silver_timestamp"}
)

SILVER_DATE_TYPE = DateType()
