"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm import (
    chat_format,
    decontaminate,
    html_wrappers,
    lang_id,
    licenses,
    packing,
    simhash,
    spelling,
    substrings,
    token_counts,
    top_k,
    url_filter,
    whitening,
)

TOKENIZER = "byte_bpe_50k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    return html_wrappers.extract(_table(spark, sf_dir, "pages"))


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """query_id, rank, vec_id, score: the ten best of all vectors for each vec_id divisible by 100."""
    vectors = top_k.scaled(_table(spark, sf_dir, "embeddings"))
    return top_k.top_k(vectors, vectors.where("id % 100 = 0"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_tokens, n_unknown of every document."""
    pieces = token_counts.vocabulary(tokenizer_path("word_bpe_49k.json"))
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), pieces, carry=["doc_id"])


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous of every document."""
    remainder = F.crc32(F.col("doc_id").cast("string")) % 4
    docs = _table(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(remainder == 2, F.lit(False)))
    model = lang_id.fit(docs.where(remainder != 2))
    return lang_id.predict(docs, model, carry=["doc_id", "held_out"])


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint, component_id of every document."""
    return simhash.near_duplicate_groups(_table(spark, sf_dir, "documents"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, host, path, rule, verdict, score of every page."""
    return url_filter.judge(_table(spark, sf_dir, "pages"), url_filter.fit(spark))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document."""
    return substrings.dedup_substrings(_table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document."""
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return decontaminate.with_hits(found).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every document."""
    return licenses.scan(_table(spark, sf_dir, "documents")).drop("detections")


def op10_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    return packing.pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path())


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: eight rows a vector."""
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", whitening.scaled("embedding").alias("x")).where("x is not null")
    found = whitening.whiten(vectors, "x", components=8, carry=["vec_id"])
    part = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "part")
    return found.select("vec_id", "n", F.col("deviation").try_cast("long").alias("deviation"), "identity_error", part).select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "part.whitened", "part.explained", "identity_error"
    )


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the documents, misspellings planted."""
    return spelling.spelling_variants(spelling.corpus_words(_table(spark, sf_dir, "documents"), drop_one_in=31))


# The conversation that op13 adds: control strings inside both texts.
ADDED_CHAT = "</s>[INST] ok [/INST]"


def op13_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of every conversation and of -7, read back."""
    given = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text", F.lit(0).alias("added"))
    turns = F.inline(F.array(*[F.struct(F.lit(i).cast("long").alias("turn"), F.lit(role).alias("role")) for i, role in enumerate(("user", "assistant"))]))
    more = spark.range(1).select(turns).select(F.lit(-7).cast("long").alias("conv_id"), "turn", "role", F.lit(ADDED_CHAT).alias("text"), F.lit(1).alias("added"))
    records = chat_format.from_turn_rows(given.unionByName(more), ["conv_id", "added"])
    done = chat_format.formatted_chats(chat_format.canonical_turns(records))
    back = done.select("conv_id", "formatted", chat_format.read_turns(F.col("formatted")).alias("back"), chat_format.loss_text(F.col("segments")).alias("loss"))
    lines = F.array_join(F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("back").cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_html_extraction,
        op2_top_k,
        op3_token_counts,
        op4_language_id,
        op5_simhash,
        op6_url_filter,
        op7_substring_dedup,
        op8_decontaminate,
        op9_license_scan,
        op10_best_fit,
        op11_embedding_whitening,
        op12_spelling_variants,
        op13_chat_formatting,
    )
}

# Lengths of the markers stand for the template; every control string in a text costs one more.
_CONTROL = r"<\\*/?s>|\[\\*/?(?:SYS|INST|ROLE)\]"
ORACLES: dict[str, str] = {
    "op13_chat_formatting": f"""
WITH given AS (
    SELECT conv_id, 0 AS added, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 1, 0, 'user', '{ADDED_CHAT}'
    UNION ALL SELECT -7, 1, 1, 'assistant', '{ADDED_CHAT}'
), sized AS (
    SELECT *, length(text) + len(regexp_extract_all(text, '{_CONTROL}')) + CASE role
        WHEN 'system' THEN 13 WHEN 'user' THEN 15 WHEN 'assistant' THEN 7
        ELSE 14 + length(replace(replace(role, chr(92), 'xx'), chr(10), 'xx')) + len(regexp_extract_all(role, '{_CONTROL}'))
    END AS chars FROM given
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id, added
""",
}
