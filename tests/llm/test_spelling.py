"""Spelling variants against brute force, with divided groups and odd words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import pandas as pd
import pytest

from tierflow.llm import spelling
from tierflow.llm.queries import op12_spelling_variants

SF = "/root/testdata/sf0.001"


def brute(counts, factor=10):
    holes, near = defaultdict(set), defaultdict(set)
    for w in counts:
        for i in range(len(w)):
            holes[w[:i], w[i + 1 :]].add(w)
            less = w[:i] + w[i + 1 :]
            if less in counts:
                near[w].add(less)
                near[less].add(w)
    for words in holes.values():
        for w in words:
            near[w] |= words - {w}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= factor * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {w: (form[w], root(w), n, len(near[w]), counts[form[w]] if form[w] is not None else None) for w, n in counts.items()}


def variants(spark, counts, **kw):
    rows = spelling.spelling_variants(spark.createDataFrame(list(counts.items()), "word string, n long"), **kw).collect()
    assert len(rows) == len({r.word for r in rows})
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def test_op12_equals_brute_force(spark):
    docs, counts = pd.read_parquet(f"{SF}/documents.parquet"), Counter()
    for i, text in zip(docs.doc_id, docs.text, strict=True):
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for w in re.findall("[A-Za-zÀ-ÿ]+", text):
            h = zlib.crc32(f"{i}:{w}".encode())
            if h % 31 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            if len(w) >= 7:
                counts[w] += 1
    expected = brute({w: n for w, n in counts.items() if n > 1})
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in op12_spelling_variants(spark, SF).collect()}
    assert got == expected and any(v[0] for v in got.values())


@pytest.mark.parametrize("letters,longest,limit", [("ab", 9, 1 << 18), ("ab", 9, 8), ("abé\U0001f600", 7, 30), ("a", 60, 5)])
def test_divided_groups_lose_no_pair(spark, monkeypatch, letters, longest, limit):
    monkeypatch.setattr(spelling, "GROUP_ROWS", 3 if limit < 100 else 128)
    draw = random.Random(limit)
    counts = {"".join(draw.choice(letters) for _ in range(draw.randint(1, longest))): draw.choice([1, 2, 5, 20, 300, 4000]) for _ in range(900)}
    assert variants(spark, counts, group_chars=limit) == brute(counts)


def test_skips_entry_by_entry(monkeypatch):
    """The way without a table of skips finds the same pairs."""
    import numpy as np

    words = sorted({"".join(p) for p in [("ab" * 9)[i : i + 5] + str(i % 7) for i in range(12)]} | {"aaaa", "aaab", "baaa"})
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    length = np.array([len(w) for w in words])
    args = codes, np.cumsum(length) - length, length, np.arange(len(words)) == 0, length, np.zeros(len(words), np.uint32)
    table = [x.tolist() for x in spelling.near_pairs(*args)]
    monkeypatch.setattr(spelling, "SKIP_CELLS", -1)
    assert [x.tolist() for x in spelling.near_pairs(*args)] == table


def test_odd_words(spark):
    long = "x" * 5000
    counts = {long: 40, long[:-1] + "y": 2, "y" + long: 3, "": 5, "a": 50, "b": 5}
    got = variants(spark, counts)
    assert got[long[:-1] + "y"][:2] == (long, long) and got["y" + long][3] == 1 and got["b"][0] == "a" and got[""] == (None, "", 5, 0, None)
    # Nulls, repeated words, clashing columns, an empty table.
    rows = [("same", 1, "x"), ("same", 2, "y"), (None, 9, "z"), ("samee", None, "z")]
    out = spelling.spelling_variants(spark.createDataFrame(rows, "word string, n long, FORM string")).collect()
    assert [tuple(r) for r in out] == [("same", None, "same", 3, 0, None)]
    assert spelling.spelling_variants(spark.createDataFrame([], "word string, n long")).count() == 0


def test_corpus_words_of_nulls_and_long_texts(spark):
    docs = [(1, "Abcdefg abcdefG short"), (None, None), (2, ""), (None, "abcdefg " * 200_000), (3, "ABCDÉFGH")]
    rows = spelling.corpus_words(spark.createDataFrame(docs, "doc_id long, text string"), min_count=1).collect()
    assert {r.word: r.n for r in rows} == {"abcdefg": 200_002, "abcdÉfgh": 1}
