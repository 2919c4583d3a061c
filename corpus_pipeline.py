"""Corpus pipeline: documents to packed training sequences, a stage at a time.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and
returns a DataFrame that is written as Parquet and read again as the next one's
docs. All but the last return the columns of documents; stages that cut words out
of a text also set n_chars, and drop a document of which nothing is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm import decontaminate, lang_id, packing, simhash, substrings
from tierflow.llm.queries import tokenizer_path
from tierflow.llm.storage import written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops null texts and texts without a letter, whatever language was learned or found."""
    kept = lang_id.predict(docs.select(*COLUMNS), lang_id.fit(docs), letter_col="has_letter")
    return kept.where("has_letter").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of smallest doc_id of each SimHash group; rows without doc_id come last, ties go to the earlier row."""
    rows = written(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("row")), "rows")
    groups = simhash.near_duplicate_groups(rows, id_col="row").select("row", "component_id")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    first = rows.select("row", "doc_id").join(groups, "row").groupBy("component_id").agg(F.min(place).alias("first")).select("first.row")
    return rows.join(first, "row", "left_semi").select(*COLUMNS)


OTHERS = [c for c in COLUMNS if c != "text"]


def _with_text(df: DataFrame, text, changed) -> DataFrame:
    """The documents columns with another text and, where it changed, its length; emptied documents go."""
    return df.where(~changed | (F.trim(text) != "")).select(
        "doc_id",
        text.alias("text"),
        "lang",
        "source",
        F.when(changed, F.length(text).cast(df.schema["n_chars"].dataType)).otherwise(F.col("n_chars")).alias("n_chars"),
    )


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of 20 words or more that occur earlier in the corpus."""
    given = docs.withColumn("no_text", F.col("text").isNull())
    found = substrings.dedup_substrings(given, carry=[*OTHERS, "no_text"])
    return _with_text(found, F.when(~F.col("no_text"), F.col("kept_text")), F.col("n_removed") > 0)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts every word inside an occurrence of a benchmark window."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.decontaminated(docs, items, carry=OTHERS)
    return _with_text(found, F.col("clean_text"), F.col("n_hit") > 0)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens in sequences of at most 1024."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("language ID", language),
    ("SimHash near-dedup", near_duplicates),
    ("substring dedup", repeated_passages),
    ("benchmark decontamination", benchmark_passages),
    ("best-fit packing", packed),
]

# No stage can be told in SQL at the size of the tables; tests hold each against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
