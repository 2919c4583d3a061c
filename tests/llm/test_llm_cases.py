"""Nulls, empty and long texts, ties and repeated rows, empty tables, clashing columns; hot groups; parts of the methods."""

from __future__ import annotations

import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tierflow.llm import (
    components,
    decontaminate,
    fm_index,
    html_wrappers,
    lang_id,
    licenses,
    packing,
    simhash,
    substrings,
    token_counts,
    top_k,
    url_filter,
)
from tierflow.llm.queries import tokenizer_path
from tierflow.llm.words import text_slices

LONG = " ".join(f"word{i % 700} the" for i in range(60_000))
ROWS = [
    (0, None, None, "a"),
    (1, "", "en", None),
    (2, "  \n\t ", None, "a"),
    (3, "One two three four five.", "en", "a"),
    (3, "One two three four five.", "en", "a"),
    (4, "ÉTÉ à la plage, 12 mit license <|endoftext|>", "fr", "b"),
    (5, LONG, "en", "a"),
    (None, "no id at all here", "en", "a"),
    (6, "1234 !!! ---", None, "a"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_simhash_cases(odd, none):
    got = by_id(simhash.near_duplicate_groups(odd))
    assert len(got) == len(ROWS)
    for i in (0, 1, 2):
        assert (i, "0" * 16, 0) in got  # no word: fingerprint zero, one group
    assert sum(r[0] == 3 for r in got) == 2 and all(r[2] == 3 for r in got if r[0] == 3)
    assert all(r[2] is None for r in got if r[0] is None)
    assert simhash.near_duplicate_groups(none).count() == 0


@pytest.mark.parametrize("max_bits", range(0, 9))
def test_cover_meets_every_guaranteed_share(max_bits):
    least = max(0, 8 - max_bits)
    cover = [set(c) for c in simhash.cover(least)]
    for shared in combinations(range(8), least):
        assert any(c <= set(shared) for c in cover)


@pytest.mark.parametrize("block", [4, 50, 8192])
def test_simhash_long_lists_lose_no_link(spark, block):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(4)]
    prints = {b for b in base}
    for b in base:
        for _ in range(60):
            x = b
            for bit in rng.sample(range(64), rng.randint(1, 5)):
                x ^= 1 << bit
            prints.add(x)
    prints = sorted(prints)
    signed = [(int(np.array([p], np.uint64).view(np.int64)[0]), i) for i, p in enumerate(prints)]
    links = simhash.near_links(spark.createDataFrame(signed, "fp long, rep long"), 4, block)
    got = dict(components.components(links, "a", "b").collect())
    group = list(range(len(prints)))
    for a, b in combinations(range(len(prints)), 2):
        if (prints[a] ^ prints[b]).bit_count() <= 4:
            x, y = sorted((group[a], group[b]))
            group = [x if g == y else g for g in group]
    assert {i: got.get(i, i) for i in range(len(prints))} == dict(enumerate(group))


def test_components_of_a_long_chain(spark):
    order = list(range(200))
    random.Random(1).shuffle(order)
    chain = spark.createDataFrame([(order[i], order[i + 1]) for i in range(199)], "a long, b long")
    got = components.components(chain, "a", "b").collect()
    assert {r.node for r in got} == set(range(200)) and {r.component for r in got} == {0}


def test_substring_cases(spark, odd, none):
    got = {(r.doc_id, r.n_words): r for r in substrings.dedup_substrings(odd).collect()}
    assert got[(0, 0)].kept_text == "" and got[(1, 0)].n_removed == 0
    assert got[(5, 120_000)].n_removed > 100_000  # the text repeats itself after 1,400 words
    assert substrings.dedup_substrings(none).count() == 0
    with pytest.raises(ValueError):
        substrings.dedup_substrings(odd.withColumn("n_words", F.lit(1)), carry=["doc_id", "n_words"])
    clash = odd.select("doc_id", "text", F.lit(7).alias("id"), F.lit("x").alias("spans"))
    assert substrings.dedup_substrings(clash, carry=["doc_id", "id", "spans"]).count() == len(ROWS)


@pytest.mark.parametrize("depth,anchor", [(1, 8), (3, 2), (20, 8), (20, 20)])
def test_substring_windows_against_brute_force(spark, depth, anchor):
    rng = random.Random(depth)
    passages = [[rng.choice("abcde") + str(rng.randrange(3)) for _ in range(45)] for _ in range(4)]
    rows = []
    for i in range(60):
        words = []
        for _ in range(rng.randrange(4)):
            words += rng.choice([["x"] * rng.randrange(30), rng.choice(passages), [rng.choice("uvw") for _ in range(10)]])
        rows.append((i, " ".join(words)))
    rng.shuffle(rows)
    seen, want = set(), {}
    for i, text in sorted(rows):
        words, mask = text.split(), [False] * len(text.split())
        for s in range(len(words) - depth + 1):
            key = tuple(words[s : s + depth])
            if key in seen:
                mask[s : s + depth] = [True] * depth
            seen.add(key)
        want[i] = sum(mask)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.n_removed for r in substrings.dedup_substrings(df, min_words=depth, anchor_words=anchor).collect()}
    assert got == want


def test_substring_rows_without_id_or_with_one_id_stay_apart(spark):
    shared = " ".join(f"s{i}" for i in range(30))
    own = [" ".join(f"{c}{i}" for i in range(n)) for c, n in (("a", 100), ("b", 40), ("c", 25))]
    rows = [
        (None, own[0] + " " + shared),  # the shared words begin beyond the end of the shorter texts
        (None, own[1]),
        (None, own[2] + " " + shared),
        (None, own[1]),  # a copy without an id
        (7, shared),
        (7, own[2]),
        (7, own[2]),
        (9, "x y z"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.kept_text) for r in substrings.dedup_substrings(df, carry=["doc_id"]).collect()))
    want = [(7, shared), (7, own[2]), (7, ""), (9, "x y z"), (None, own[0]), (None, own[1]), (None, ""), (None, "")]
    assert got == sorted((i is None, i or 0, t) for i, t in want)


def test_near_duplicates_without_id_go_and_rows_of_one_id_stay(spark):
    rng = random.Random(8)
    a, b, c = (" ".join(rng.choice("abcdefgh") + str(rng.randrange(500)) for _ in range(200)) for _ in range(3))
    rows = [(None, a), (None, a), (None, b), (4, b), (2, b), (5, c), (5, a + " " + c)]
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    got = sorted(((r.doc_id or 0, r.text) for r in corpus_pipeline.near_duplicates(spark, df, "").collect()))
    assert got == sorted([(0, a), (2, b), (5, c), (5, a + " " + c)])


def test_stream_state_survives_any_batch_size(spark):
    rng = np.random.default_rng(3)
    a = np.stack([rng.integers(0, 6, 300), rng.integers(0, 3, 300), rng.integers(0, 9, 300), rng.integers(0, 4, 300), np.ones(300, int)], axis=1)
    a = a[np.lexsort(a.T[::-1][1:])]
    a = np.array(sorted(map(tuple, a)), np.int64)

    def parts(step):
        stream, out = substrings._Stream(), [set(), set()]
        for i in range(0, len(a), step):
            for kind, rows in zip(out, stream.take(a[i : i + step]), strict=True):
                kind.update(map(tuple, rows.tolist()))
        return out

    assert parts(1) == parts(7) == parts(1000)


def test_decontamination_cases(spark, odd, none):
    items = spark.createDataFrame([(1, "two three"), (2, None), (3, "..."), (None, "one"), (4, "One TWO three four five"), (1, "word699 the")], "item_id long, text string")
    found = decontaminate.with_hits(decontaminate.contamination(odd, items))
    got = by_id(found.select("doc_id", "n_words", "n_hit", "items"))
    assert got.count((3, 5, 5, ["1", "4"])) == 2 and (0, 0, 0, []) in got
    assert next(r for r in got if r[0] == 5)[2:] == (170, ["1"])  # 85 places
    # An item without an id hits and is named nowhere; ids need not be numbers.
    named = spark.createDataFrame([(None, "one"), ("b-7", "two three"), ("b-7", "two")], "item_id string, text string")
    for block_words in (decontaminate.BLOCK_WORDS, 1):
        some = decontaminate.with_hits(decontaminate.contamination(odd.where("doc_id = 3"), named, block_words=block_words))
        assert {(r.n_hit, tuple(r["items"])) for r in some.collect()} == {(3, ("b-7",))}
    assert decontaminate.contamination(none, items).count() == 0
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.with_hits(decontaminate.contamination(odd, empty)).agg(F.sum("n_hit")).first()[0] == 0
    split = decontaminate.with_hits(decontaminate.contamination(odd, items, block_words=3))
    assert by_id(split.select("doc_id", "n_words", "n_hit", "items")) == got
    clean = decontaminate.remove_spans(decontaminate.contamination(odd, items, carry=["doc_id", "text"]), "text", "spans")
    assert {r.text for r in clean.where("doc_id = 3").collect()} == {"."}


@pytest.mark.parametrize("block_words", [decontaminate.BLOCK_WORDS, 3])
def test_one_pass_cut_equals_spans_removed(odd, none, block_words):
    items = odd.sparkSession.createDataFrame([(1, "two three"), (2, "plage 12 mit"), (3, None), (4, "word699 the")], "item_id long, text string")
    carry = ["doc_id", "lang", "source"]
    found = decontaminate.with_hits(decontaminate.contamination(odd, items, carry=[*carry, "text"]))
    want = decontaminate.remove_spans(found, "text", "spans").select(*carry, "text", "n_hit")
    got = decontaminate.decontaminated(odd, items, carry=carry, block_words=block_words)
    assert got.columns == [*carry, "clean_text", "n_hit"]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, map(tuple, want.collect())))
    assert {r.doc_id: r.n_hit for r in got.where("n_hit > 0").collect()} == {3: 2, 4: 3, 5: 170}
    assert decontaminate.decontaminated(none, items).count() == 0
    untouched = decontaminate.decontaminated(odd, items.limit(0), carry=carry)
    assert untouched.where("n_hit > 0").isEmpty() and untouched.count() == odd.count()


def test_fm_index_counts_and_locates():
    rng = np.random.default_rng(2)
    text = np.concatenate([rng.integers(1, 6, 400), np.full(120, 3), rng.integers(1, 6, 50)])
    index = fm_index.FMIndex(text, 7)
    patterns = [text[i : i + n] for i in range(0, 500, 7) for n in (1, 2, 5, 9)] + [np.array([6, 6])]
    wide = np.zeros((len(patterns), 9), np.int64)
    for row, p in zip(wide, patterns, strict=True):
        row[9 - len(p) :] = p
    lo, hi = index.search(wide, np.array([len(p) for p in patterns]))
    for p, a, b in zip(patterns, lo, hi, strict=True):
        places = [i for i in range(len(text) - len(p) + 1) if (text[i : i + len(p)] == p).all()]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == places


def test_packing_cases(odd, none):
    got = packing.pack_documents(odd, tokenizer_path(), most=64).toPandas()
    assert got[got.doc_id == 0][["piece", "length"]].values.tolist() == [[0, 1]]
    assert len(got[got.doc_id == 3]) == 2 and got.doc_id.isna().sum() >= 1
    long = got[got.doc_id == 5].sort_values("piece")
    assert (long.length.iloc[1:] == 64).all() and 1 <= long.length.iloc[0] <= 64
    assert (got.groupby("sequence_id").length.sum() <= 64).all()
    assert packing.pack_documents(none, tokenizer_path()).count() == 0


def test_shards_follow_the_pieces_and_full_ones_stand_alone(spark):
    docs = spark.createDataFrame([(i, f"{i} the word " * 200) for i in range(40)], "doc_id long, text string")
    got = packing.pack_documents(docs, tokenizer_path(), most=16, shard_pieces=20).toPandas()
    full = got[got.length == 16]
    assert len(full) > 1000 and full.sequence_id.is_unique and (full.sequence_id >= packing.FULL).all() and (full.offset == 0).all()
    short = got[got.length < 16]
    assert len(got) - len(full) == len(short) <= 40 and not set(short.sequence_id) & set(full.sequence_id)
    assert (got.groupby(got.sequence_id // 2**40).length.count()[lambda n: n.index < packing.FULL // 2**40] <= 40).all()
    assert (short.groupby("sequence_id").length.sum() <= 16).all()


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_best_fit_keeps_every_capacity(rule):
    rng = np.random.default_rng(4)
    length = -np.sort(-rng.integers(1, 101, 3000))
    capacity = (100, 5, 100 * 100)
    bins = packing.best_fit(length, capacity, (1.0, 0.1, 0.1), rule)
    for b in range(bins.max() + 1):
        held = length[bins == b]
        assert len(held) <= 5 and held.sum() <= 100 and np.square(held).sum() <= 100 * 100 and len(held)
    assert bins.max() + 1 <= 1.08 * max(length.sum() / 100, len(length) / 5)


def test_tokens_equal_the_tokenizer_on_odd_texts():
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(tokenizer_path())
    rng = random.Random(9)
    marks = ["a", "É", " ", "  ", "\n", "\t", "\xa0", "　", "\u2003", "\x1c", "\x85", "'s", "'", "12", "!", "—", "日本", "😀", "the", "à", "<|endoftext|>", "\u200b"]
    texts = ["".join(rng.choices(marks, k=rng.randrange(25))) for _ in range(1500)]
    tokens = packing.Tokens(tokenizer_path())
    assert tokens.ranked is not None
    got = [e.tolist() for _, raw, off in text_slices(pa.array(texts), 3000) for e in tokens.texts(raw, off)]
    assert got == [own.encode(t, add_special_tokens=False).ids for t in texts]


def test_language_cases(odd, none):
    model = lang_id.fit(odd)
    assert model.languages == ["en", "fr"]
    got = {r.doc_id: r for r in lang_id.predict(odd, model).collect()}
    for i in (0, 1, 2, 6):
        assert (got[i].lang_pred, got[i].score, got[i].ambiguous) == ("und", 0.0, True)
    assert got[5].lang_pred == "en" and got[4].lang_pred == "fr"
    assert lang_id.predict(none, model).count() == 0
    nothing = lang_id.fit(none)
    assert {r.lang_pred for r in lang_id.predict(odd, nothing).collect()} == {"und"}
    one = lang_id.fit(odd.where("lang = 'fr'"))
    assert {r.lang_pred for r in lang_id.predict(odd.where("doc_id = 3"), one).collect()} == {"fr"}
    with pytest.raises(ValueError):
        lang_id.predict(odd.withColumn("score", F.lit(1)), model)


def test_documents_with_a_letter_stay_whatever_the_labels(spark, odd, none):
    for label in (F.lit(None).cast("string"), F.lit(lang_id.UNKNOWN), F.col("lang")):
        docs = odd.withColumn("lang", label).withColumn("n_chars", F.length("text").cast("long"))
        kept = corpus_pipeline.language(spark, docs, "").collect()
        assert sorted(str(r.doc_id) for r in kept) == ["3", "3", "4", "5", "None"]
    assert corpus_pipeline.language(spark, none.withColumn("n_chars", F.lit(1)), "").count() == 0


def test_codewords_are_apart():
    for n in (2, 3, 4, 7, 12):
        code = lang_id.codewords(n)
        assert min(int((code[a] != code[b]).sum()) for a, b in combinations(range(n), 2)) >= 1
        assert all(abs(c.sum()) < n for c in code.T)


def test_token_count_cases(odd, none):
    pieces = [tuple(b"one"), (*b"one", token_counts.END), *[(b,) for b in range(97, 123)], (token_counts.END,)]
    got = {r.doc_id: (r.n_words, r.n_tokens, r.n_unknown) for r in token_counts.token_counts(odd, pieces, carry=["doc_id"]).collect()}
    assert got[0] == got[1] == got[2] == (0, 0, 0)
    assert got[3] == (6, 1 + 3 + 5 + 4 + 4 + 1, 1)  # the full stop cannot be spelt
    assert token_counts.token_counts(none, pieces).count() == 0
    assert {r.n_unknown for r in token_counts.token_counts(odd.where("doc_id = 3"), []).collect()} == {6}


def test_top_k_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, None), (4, [None, 1.0]), (5, [nan, 1.0]), (6, [inf, 0.0]), (None, [1.0, 1.0]), (7, [-1.0, 0.5]), (8, []), (2, [1.0, 2.0]), (9, [1.0, 2.0, 3.0])]
    v = top_k.scaled(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = top_k.top_k(v, v.where("id in (0, 8)"), k=4).collect()
    first = [(r.vec_id, r.score) for r in sorted((r for r in got if r.query_id == 0), key=lambda r: r.rank)]
    unit = 5 * 1024 * 1024
    assert first == [(1, unit), (2, unit), (2, unit), (9, unit)]
    assert [r.score for r in got if r.query_id == 8] == [0] * 4
    assert top_k.top_k(v.where("id < 0"), v.where("id < 0")).count() == 0
    assert top_k.top_k(v.where("id = 0"), v.where("id = 0")).count() == 0
    blocks = top_k.top_k(v, v, k=3, query_block=2)
    assert by_id(blocks) == by_id(top_k.top_k(v, v, k=3))


PAGE = """<html><head><title>x</title><style>p{}</style></head><body class="with-sidebar"><header class="site-header"><a href=/>Home</a></header>
<div id="cookie-notice">We use cookies</div><ul class="menu"><li>One<li>Two</ul><div class="layout"><div class="post-body"><h1>Title %d &amp; more</h1>
<p>First   paragraph %d with a <a href=x>link</a> and &lt;b&gt; text.<p>Second one, %d.<ul><li>item<li>thing</ul><div class="share">Share me</div>
<table><tr><td>cell %d<td>next</table><div>Printed by our press</div></div><div class="sidebar"><p>Popular</p></div></div>
<section id="comments"><article class="comment"><p>Nice post %d</p></article></section><form><p>sign up</form><script>var t="</p>";</script><footer>foot</footer>"""


def test_html_cases(spark):
    rows = [(i, f"http://h.example/{i}", PAGE % ((i,) * 5)) for i in range(12)]
    rows += [(100, None, "<p>alone here"), (101, "no url", None), (102, "http://x/", ""), (103, "http://x/1", "plain text only"), (103, "http://x/1", "plain text only"), (104, "http://x/2", "<div><p>a < b & c</div></p>&#233;&nbsp;!")]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id long, url string, html string, text string, host int").repartition(4)
    for limit in (html_wrappers.BROADCAST_CHARS, 0):  # rules broadcast, rules joined
        got = {r.page_id: r for r in html_wrappers.extract(df, broadcast_chars=limit).collect()}
        for i in range(12):
            assert got[i].text == f"Title {i} & more\nFirst paragraph {i} with a link and <b> text.\nSecond one, {i}.\nitem\nthing\ncell {i}\nnext"
        assert (got[100].text, got[101].text, got[102].text, got[103].text) == ("alone here", "", "", "plain text only")
        assert got[104].text == "a < b & c\né !" and got[104].n_chars == 13
    assert html_wrappers.extract(df.limit(0)).count() == 0


def test_copies_of_an_article_make_no_fixed_text(spark):
    page = "<body><nav>menu</nav><article><div>share this</div><h1>T {0}</h1><p>Words of {0}.</p>{1}</article></body>"
    block = "<section>Only this article has it.</section>"
    rows = [(i, f"http://h.example/{i}", page.format(i, "")) for i in range(20)]
    rows += [(100 + i, f"http://h.example/copy/{i}", page.format("copy", block)) for i in range(300)]
    # A text that is fixed elsewhere on the page is kept where it is not.
    rows.append((500, "http://h.example/500", page.format(500, "<section>share this</section>")))
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r.page_id: r.text for r in html_wrappers.extract(df).collect()}
    assert all(got[i] == f"T {i}\nWords of {i}." for i in range(20))
    assert {got[100 + i] for i in range(300)} == {"T copy\nWords of copy.\nOnly this article has it."}
    assert got[500] == "T 500\nWords of 500.\nshare this"


def test_pages_nested_thousands_deep(spark):
    deep = lambda i, n: "<div>" * n + f"<p>Words of {i}.</p>" + "</div>" * (n if i % 2 else 0)
    rows = [(i, "http://deep.example/", deep(i, 5000)) for i in range(4)] + [(9, "http://deep.example/9", deep(9, 3000))]
    rows += [(20 + i, "http://kinds.example/", "<section><nav>" * 3000 + f"<article><p>Words of {20 + i}.") for i in range(2)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    assert {r.page_id: r.text for r in html_wrappers.extract(df).collect()} == {i: f"Words of {i}." for i, _, _ in rows}
    item = html_wrappers.lift(html_wrappers.parse("<ul><li>a<li>b</ul><p>same</p><h1></h1><div><div>x</div>y</div>"))
    assert html_wrappers.from_json(html_wrappers.to_json(item)) == item


def test_wrapper_alignment_is_union_free():
    a = html_wrappers.lift(html_wrappers.parse("<ul><li>a<li>b</ul><p>same</p>"))
    b = html_wrappers.lift(html_wrappers.parse("<ul><li>c</ul><blockquote>q</blockquote><p>same</p>"))
    items = html_wrappers.align(a, b)[3]
    assert [(x[0].split()[0], x[1]) for x in items] == [("ul", 0), ("blockquote", 1), ("p", 0)]
    assert items[0][3][0][1] & 2 and items[0][3][0][3][0][3][0] is None  # li repeats, its text is a slot
    assert items[2][3][0][3][0] == html_wrappers.digest("same")


def test_url_cases(spark):
    rows = [(0, None), (1, ""), (2, "no scheme"), (3, "HTTP://WWW.Example.ORG/es/1?x"), (4, "http://org"), (5, "x://a.org/b://c"), (6, "http://cheap-casino-pills.biz/"), (6, "http://weather-museum.biz/")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, host string")
    model = url_filter.fit(spark)
    got = [(r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(df, model).collect()]
    assert [g[1:4] for g in got[:3]] == [("", "", None)] * 3
    assert got[3] == (3, "www.example.org", "/es/1", "example.org/es/", "block")
    assert got[4][1:4] == ("org", "", None) and got[5] == (5, "a.org", "/b://c", "org/", "allow")
    assert [g[4] for g in got[6:]] == ["block", "allow"]
    assert url_filter.judge(df.limit(0), model).count() == 0


# Hosts of none of the training words, and ordinary hosts that hold a blocked word by chance.
UNSEEN = {
    1: ["roulette-vegas.com", "dating-singles.net", "hotgirls-live.com", "buy-cialis-online.com", "poker-stars-club.com", "torrent-movies.net", "free-casino-bonus.com", "xxx-tube.net"],
    0: ["cheapflights.com", "farmersweekly.co.uk", "adservice.gov.uk", "camsden.gov.uk", "wikipedia.org", "guardian.co.uk", "lemonde.fr", "spiegel.de", "elpais.com", "python.org", "stackoverflow.com", "bundestag.de", "nasa.gov", "sussexlive.co.uk"],
}


def test_url_filter_on_hosts_it_was_not_taught(spark):
    """Balanced accuracy of the regression alone; the labelled table itself is nearly all right."""
    model = url_filter.fit(spark)
    rows = [(i, f"https://{h}/en/1", y) for y, hosts in UNSEEN.items() for i, h in enumerate(hosts)]
    judged = url_filter.judge(spark.createDataFrame([(i + 100 * y, u) for i, u, y in rows], "page_id long, url string"), model, rules={}).collect()
    right = {y: sum((r.verdict == "block") == (y == 1) for r in judged if (r.page_id >= 100) == (y == 1)) for y in (0, 1)}
    print("unseen hosts right:", {y: f"{n} of {len(UNSEEN[y])}" for y, n in right.items()}, [(r.host, round(r.score, 2)) for r in judged if (r.verdict == "block") != (r.page_id >= 100)])
    assert right[1] / 8 + right[0] / 14 >= 1.6
    taught = url_filter.judge(spark.createDataFrame([(y, u) for u, y in url_filter.labelled()], "page_id long, url string"), model, rules={})
    assert taught.where("(verdict = 'block') = (page_id = 1)").count() >= 0.95 * len(url_filter.labelled())


def test_url_scores_by_hand(spark):
    """The score is the regression's probability over hashed n-grams, recomputed row by row in Python."""
    import math

    import numpy as np
    from pyspark.ml.feature import HashingTF

    fitted = url_filter.fit(spark)
    urls = ["https://www.cheap-pills.example.com/fr/gardens/", "http://m.museum.test/de/9", "://", "http://x"]
    lr = fitted.model.stages[-1]
    weights, hashing = lr.coefficients.toArray(), HashingTF(numFeatures=url_filter.FEATURES)
    got = {r.page_id: r for r in url_filter.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), fitted, rules={}).collect()}
    for i, url in enumerate(urls):
        host, path = re.match(r"^.*?://([^/?#]*)([^?#]*)", url).groups()
        framed = [("h:", host)] + [("p:", w) for w in re.findall("[a-zA-Z]{3,}", path.lower())]
        grams = {mark + f"<{t}>"[k : k + n] for mark, t in framed for n in url_filter.NGRAMS for k in range(len(t) + 3 - n)}
        places = {hashing.indexOf(g) for g in grams}
        z = lr.intercept + sum(weights[p] for p in places) / (math.sqrt(len(places)) or 1)
        assert abs(got[i].score - 1 / (1 + np.exp(-z))) < 1e-9
        assert got[i].verdict == ("block" if got[i].score >= fitted.block_at else "allow")


def test_license_cases(spark, odd, none):
    got = {r.doc_id: r for r in licenses.scan(odd).collect()}
    assert (got[0].n_words, got[0].labels, got[0].score) == (0, "", 0.0)
    assert (got[4].n_base, got[4].first_word, got[4].last_word, got[4].base_labels) == (1, 5, 5, "mit")
    texts = ["MIT License mit license", "Licensed under the Apache License, Version 2.0", "SPDX-License-Identifier: GPL-2.0", "cc-by-sa 4.0", "the limit licenses", "released under the MIT license; all rights reserved"]
    rows = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert (rows[0].n_base, rows[0].first_word, rows[0].last_word, rows[0].labels) == (2, 0, 2, "mit")
    assert rows[1].labels == "apache,apache-2.0" and rows[1].score == 0.95 and len(rows[1].detections) == 1
    assert rows[2].labels == "gpl-2.0" and rows[3].labels == "cc-by,cc-by-sa" and rows[4].labels == ""
    assert rows[5].labels == "all-rights-reserved,mit"
    assert licenses.scan(none).count() == 0
    assert len(licenses.rules()) > 200
