"""Queries from a folder without the package on the workers' path, and words that polynomials modulo 2**64 confuse."""

from __future__ import annotations

import os
import subprocess
import sys

import numpy as np

from tierflow.llm import decontaminate, packing, substrings, token_counts, words
from tierflow.llm.queries import tokenizer_path

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

APART = """
import os, sys
for name in ("PYTHONPATH",):
    os.environ.pop(name, None)
sys.path.insert(0, {root!r})
os.environ["PYTHONPATH"] = {tools!r}  # what the workers inherit: not the repository
from tierflow.session import build_session
spark = build_session("local[4]", shuffle_partitions=4)
import corpus_pipeline
from tierflow.llm.queries import QUERIES
for name, query in {{**QUERIES, "pipeline": corpus_pipeline.run}}.items():
    print(name, query(spark, "/root/testdata/sf0.001").count(), flush=True)
"""


def test_every_query_runs_where_workers_have_no_copy_of_the_package(tmp_path):
    tools = os.path.dirname(os.path.dirname(tokenizer_path()))
    code = APART.format(root=ROOT, tools=tools)
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stdout[-2000:] + done.stderr[-4000:]
    assert len(done.stdout.split("\n")) >= 14


def thue_morse(n: int) -> tuple[str, str]:
    """A word of 2**n letters a and b, and the word with the letters exchanged."""
    word = "a"
    for _ in range(n):
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


ONE, OTHER = thue_morse(11)


def test_hashes_of_thue_morse_words():
    scanner = words.Scanner(words.byte_table(words.WHITE, lower=False))
    raw = np.frombuffer(f"{ONE} {OTHER} {ONE}".encode(), np.uint8)
    h = scanner.scan(raw, np.array([0, len(raw)]))[0]
    assert h[0] != h[1] and h[0] == h[2]


def test_operators_tell_thue_morse_words_apart(spark):
    texts = [f"{ONE} {OTHER}", OTHER, f"{OTHER} {ONE} {ONE}"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    # Token ids and counts of the two words differ from those of one word twice.
    own = packing.Tokens(tokenizer_path())
    for encoded, text in zip(own.texts(*_slice(texts)), texts, strict=True):
        assert encoded.tolist() == own.whole(text).tolist()
    pieces = token_counts.vocabulary(tokenizer_path("word_bpe_49k.json"))
    alone = [spark.createDataFrame([(0, t)], "doc_id long, text string") for t in texts]
    together = [r.n_tokens for r in token_counts.token_counts(docs, pieces, carry=["doc_id"]).orderBy("doc_id").collect()]
    assert together == [token_counts.token_counts(d, pieces, carry=["doc_id"]).first().n_tokens for d in alone]
    # A benchmark item of the one word hits only that word.
    bench = spark.createDataFrame([(1, ONE)], "item_id long, text string")
    found = decontaminate.with_hits(decontaminate.contamination(docs, bench)).orderBy("doc_id").collect()
    assert [r.n_hit for r in found] == [1, 0, 2]
    # Windows of 20 words that differ in one such word are no repeats.
    rest = " ".join(f"w{i}" for i in range(19))
    pair = spark.createDataFrame([(0, f"{ONE} {rest}"), (1, f"{OTHER} {rest}"), (2, f"{ONE} {rest}")], "doc_id long, text string")
    kept = substrings.dedup_substrings(pair).orderBy("doc_id").collect()
    assert [r.n_removed for r in kept] == [0, 0, 20]


def _slice(texts):
    data = [t.encode() for t in texts]
    return np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)])
