"""Each registered query over whole small tables against a brute-force version."""

from __future__ import annotations

import hashlib
import html
import re
import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pytest
import xxhash

import corpus_pipeline
from tierflow.llm import licenses, token_counts, url_filter
from tierflow.llm.queries import QUERIES, tokenizer_path

SF = "/root/testdata/sf0.001"
WHITE = re.compile(r"[^\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def table(name):
    return pd.read_parquet(f"{SF}/{name}.parquet")


def run(spark, name):
    key = next(q for q in QUERIES if q.startswith(name + "_"))
    return QUERIES[key](spark, SF).toPandas()


@pytest.fixture(scope="module")
def docs():
    return table("documents")


def test_op1_takes_the_article(spark):
    pages = table("pages").set_index("page_id")
    got = run(spark, "op1").set_index("page_id")
    assert set(got.index) == set(pages.index)
    for i, page in pages.html.items():
        body = re.search("<article>(.*)</article>", page, re.S)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", "", s.replace("<br>", " "))).split()) for s in re.split("</?(?:p|h1)>", body)]
        assert got.text[i] == "\n".join(p for p in parts if p)
        assert got.n_chars[i] == len(got.text[i])


def test_op2_matches_all_inner_products(spark):
    e = table("embeddings")
    x = np.floor(1024 * np.stack(e.embedding).astype(float)).astype(np.int64)
    ids = e.vec_id.to_numpy()
    got = {k: g.sort_values("rank") for k, g in run(spark, "op2").groupby("query_id")}
    asked = np.flatnonzero(ids % 100 == 0)
    assert set(got) == set(ids[asked].tolist())
    for i in asked:
        score = x @ x[i]
        best = [j for j in np.lexsort((ids, -score)) if j != i][:10]
        assert got[ids[i]].vec_id.tolist() == ids[best].tolist()
        assert got[ids[i]].score.tolist() == score[best].tolist()
        assert got[ids[i]]["rank"].tolist() == list(range(1, 11))


def test_op3_matches_greedy_longest_match(spark, docs):
    pieces = set(token_counts.vocabulary(tokenizer_path("word_bpe_49k.json")))

    @lru_cache(None)
    def greedy(word):
        s, n, i = (*word, token_counts.END), 0, 0
        while i < len(s):
            j = next((j for j in range(len(s), i, -1) if s[i:j] in pieces), None)
            if j is None:
                return 0
            n, i = n + (s[i:j] != (token_counts.END,)), j
        return n

    got = run(spark, "op3").set_index("doc_id")
    for i, text in zip(docs.doc_id, docs.text, strict=True):
        n = [greedy(w) for w in re.findall(rb"[0-9a-z\x80-\xff]+|[!-/:-@\[-`{-~]+", lower(text).encode())]
        assert tuple(got.loc[i]) == (len(n), sum(max(k, 1) for k in n), n.count(0))


def test_op4_is_right_on_held_out_documents(spark, docs):
    got = run(spark, "op4").set_index("doc_id")
    held = {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in docs.doc_id}
    assert got.held_out.to_dict() == held
    known = docs[docs.lang.notna() & (docs.n_chars >= 20)]
    out = known[known.doc_id.map(held)]
    assert len(out) > 30 and (got.lang_pred[out.doc_id].to_numpy() == out.lang.to_numpy()).mean() > 0.98
    assert got.score.between(0, 1).all()


def test_op5_links_all_near_fingerprints(spark, docs):
    def fingerprint(text):
        words = WHITE.findall(lower(text))
        if not words:
            return 0
        h = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    prints = {i: fingerprint(t) for i, t in zip(docs.doc_id, docs.text, strict=True)}
    group = {i: i for i in prints}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    ids = sorted(prints)
    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = sorted((root(a), root(b)))
                group[y] = x
    got = run(spark, "op5").set_index("doc_id")
    assert got.fingerprint.to_dict() == {i: f"{p:016x}" for i, p in prints.items()}
    assert got.component_id.to_dict() == {i: root(i) for i in ids}


def test_op6_rules_and_verdicts(spark):
    got = run(spark, "op6").set_index("page_id")
    block_at = url_filter.fit(spark).block_at
    for i, url in table("pages").set_index("page_id").url.items():
        m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (lower(m[1]), m[2]) if m else ("", "")
        fits = [r for r in url_filter.RULES for h, _, p in [r.partition("/")] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
        want = max(fits, key=len, default=None)
        assert (got.host[i], got.path[i]) == (host, path)
        assert (got.rule[i] if isinstance(got.rule[i], str) else None) == want
        if want:
            assert got.verdict[i] == url_filter.RULES[want]
        else:
            assert got.verdict[i] == ("block" if got.score[i] >= block_at else "allow")


def removed(rows, depth=20):
    """doc_id -> (words, mask of removed words), windows judged on the input."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        words = WHITE.findall(text or "")
        mask = [False] * len(words)
        for s in range(len(words) - depth + 1):
            key = tuple(words[s : s + depth])
            if key in seen:
                mask[s : s + depth] = [True] * depth
            seen.add(key)
        out[i] = (words, mask)
    return out


def test_op7_removes_later_windows(spark, docs):
    want = removed(zip(docs.doc_id, docs.text, strict=True))
    got = run(spark, "op7").set_index("doc_id")
    assert sum(got.n_removed) > 0
    for i, (words, mask) in want.items():
        kept = " ".join(w for w, m in zip(words, mask, strict=True) if not m)
        assert tuple(got.loc[i]) == (len(words), sum(mask), hashlib.sha256(kept.encode()).hexdigest())


def hits(text, windows, lengths):
    words = WORD.findall(lower(text))
    mask, items = [False] * len(words), set()
    for n in lengths:
        for s in range(len(words) - n + 1):
            found = windows.get(tuple(words[s : s + n]))
            if found:
                items |= found
                mask[s : s + n] = [True] * n
    return words, mask, items


def windows_of(items):
    windows = {}
    for i, text in items:
        words = WORD.findall(lower(text))
        for s in range(max(1, len(words) - 9) if words else 0):
            windows.setdefault(tuple(words[s : s + 10]), set()).add(i)
    return windows


def test_op8_hits_every_window(spark, docs):
    b = table("benchmark")
    windows = windows_of(zip(b.item_id, b.text, strict=True))
    got = run(spark, "op8").set_index("doc_id")
    assert got.contaminated.any()
    for i, text in zip(docs.doc_id, docs.text, strict=True):
        words, mask, items = hits(text, windows, {len(w) for w in windows})
        sha = hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()
        assert tuple(got.loc[i]) == (len(words), sum(mask), len(items), sha, any(mask))


def kept_detections(text):
    """All matches of all rules whose keyword stands in the text, without those inside another (ties: the earlier rule)."""
    line = re.sub(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ", lower(text)).strip()
    found = [(m.start(), m.end(), r["priority"], r["label"]) for r in licenses.rules() if r["keyword"] in line for m in re.finditer(r["pattern"], line)]
    # From the widest of each start on: whatever ends at or before an earlier, wider interval's end lies inside it.
    kept, reach = [], -1
    for start, end, priority, label in sorted(found, key=lambda d: (d[0], -d[1], d[2])):
        if end > reach:
            kept.append((start, end, label, priority))
            reach = end
    return kept


def test_op9_detections_by_brute_force(spark, docs):
    notices = [
        "Licensed under the terms of the MIT License; see the Apache License, Version 2.0 for details.",
        "SPDX-License-Identifier: GPL-2.0 or later. All rights reserved. Neither the name of the author nor others may be used to endorse or promote products",
        "This program is free software: you can redistribute it and/or modify it under the GNU General Public License version 3",
        "dedicated to the public domain under CC0 1.0 and cc-by-nc-sa, cc by",
    ]
    long = " ".join(f"{notices[i % 4]} word{i} " + "x" * (i % 97) for i in range(1500))
    texts = [*docs.text.head(150), *notices, long]
    rows = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    got = {r.doc_id: [(d["start"], d["end"], d["label"], d["priority"]) for d in r.detections or []] for r in rows}
    for i, text in enumerate(texts):
        assert sorted(got[i]) == kept_detections(text or ""), i
    assert len(got[len(texts) - 1]) > 3000


def test_op9_a_megabyte_of_notices_in_one_text(spark):
    import time

    text = "licensed under the mit license " * 34_000
    start = time.perf_counter()
    row = licenses.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert time.perf_counter() - start < 60
    assert (row.n_base, len(row.detections), row.labels) == (34_000, 34_000, "mit")


def test_op9_base_places(spark, docs):
    got = run(spark, "op9").set_index("doc_id")
    for i, text in zip(docs.doc_id, docs.text, strict=True):
        words = WORD.findall(lower(text))
        places, labels = [], set()
        for phrase, label in licenses.BASE.items():
            p = phrase.split()
            at = [s for s in range(len(words)) if words[s : s + len(p)] == p]
            places += at
            labels |= {label} if at else set()
        row = got.loc[i]
        assert (row.n_words, row.n_base, row.base_labels) == (len(words), len(places), ",".join(sorted(labels)))
        assert (row.first_word, row.last_word) == (min(places), max(places)) if places else pd.isna(row.first_word) and pd.isna(row.last_word)
        assert labels <= set(row.labels.split(",")) and 0 <= row.score <= 1


def test_op10_pieces_and_sequences(spark, docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    got = run(spark, "op10")
    by_doc = {i: g.sort_values("piece") for i, g in got.groupby("doc_id")}
    for i, text in zip(docs.doc_id, docs.text, strict=True):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        g = by_doc[i]
        assert g.piece.tolist() == list(range(len(g))) and g.length.sum() == len(ids)
        assert (g.length.iloc[1:] == 1024).all() and g.start.tolist() == [0, *np.cumsum(g.length)[:-1]]
        assert g.ids_crc32.tolist() == [zlib.crc32(ids[s : s + n].tobytes()) for s, n in zip(g.start, g.length, strict=True)]
    filled = got.sort_values(["sequence_id", "offset"]).groupby("sequence_id")
    assert (filled.length.sum() <= 1024).all()
    for _, g in filled:
        assert g.offset.tolist() == [0, *np.cumsum(g.length)[:-1]]
    assert got.sequence_id.nunique() <= 1.03 * got.length.sum() / 1024 + 1


def test_pipeline_stages_against_brute_force(spark, docs):
    from tierflow.llm.storage import written

    frames = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(written(stage(spark, frames[-1], SF), name.replace(" ", "_")))
    kept = [f.toPandas().set_index("doc_id") for f in frames]
    for f in frames[:-1]:
        assert f.columns == corpus_pipeline.COLUMNS
    assert set(kept[1].index) == {i for i, t in zip(docs.doc_id, docs.text, strict=True) if any(map(str.isalpha, t or ""))}
    b = table("benchmark")
    windows = windows_of(zip(b.item_id, b.text, strict=True))
    for i, (words, mask) in removed(kept[2].text.items()).items():
        left = " ".join(w for w, m in zip(words, mask, strict=True) if not m)
        if not left:
            assert i not in kept[3].index
        else:
            assert kept[3].text[i] == (left if any(mask) else kept[2].text[i])
            assert not any(mask) or kept[3].n_chars[i] == len(left)
    for i, text in kept[3].text.items():
        words, mask, _ = hits(text, windows, {len(w) for w in windows})
        if any(mask):
            left = [w for w, m in zip(words, mask, strict=True) if not m]
            assert WORD.findall(lower(kept[4].text[i])) == left if left else i not in kept[4].index
        else:
            assert kept[4].text[i] == text
    assert set(frames[-1].toPandas().doc_id) == set(kept[4].index)


def test_op9_no_rule_matches_as_much_as_a_margin():
    from re import _parser

    assert max(_parser.parse(r["pattern"]).getwidth()[1] for r in licenses.rules()) < licenses.MARGIN
