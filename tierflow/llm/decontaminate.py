"""Benchmark decontamination: an FM-index per training shard, searched backwards for test windows.

A shard is a slice of whole documents inside a task. Its words become symbols
(words that no test item has share one symbol, and a run of them is one place),
the shard gets a Burrows-Wheeler transform with wavelet-tree ranks, every test
window is searched backwards, occurrences are located by sampled suffix
positions, and their word spans are merged per document. Documents are never
shuffled. Test windows are broadcast in blocks of at most ``BLOCK_WORDS`` words,
one pass over the documents for each, so what a task holds is bounded however
large the benchmark is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.llm.fm_index import FMIndex
from tierflow.llm.storage import shipped, written
from tierflow.llm.words import PUNCTUATION, Scanner, byte_table, text_slices

WINDOW_WORDS = 10
BLOCK_WORDS = 2_000_000
SHARD_BYTES = 2 << 20

_PAD, _BREAK, _OTHER, _FIRST = 0, 1, 2, 3


class TestWindows:
    """Distinct windows of a block of test items, as symbols."""

    __test__ = False

    def __init__(self, names: list[str | None], hashes: list[np.ndarray], window: int):
        self.names = names
        self.vocabulary = np.unique(np.concatenate(hashes)) if hashes else np.zeros(0, np.uint64)
        rows, lengths, owner = [], [], []
        for item, h in enumerate(hashes):
            symbols = np.searchsorted(self.vocabulary, h) + _FIRST
            size = min(window, len(symbols))
            cut = np.lib.stride_tricks.sliding_window_view(symbols, size)
            rows.append(np.pad(cut, ((0, 0), (window - size, 0))))
            lengths.append(np.full(len(cut), size))
            owner.append(np.full(len(cut), item))
        if rows:
            table = np.concatenate(rows)
            self.patterns, which = np.unique(table, axis=0, return_inverse=True)
            which = which.reshape(-1)
            self.lengths = np.zeros(len(self.patterns), np.int64)
            self.lengths[which] = np.concatenate(lengths)
            order = np.argsort(which, kind="stable")
            self.items = np.concatenate(owner)[order]
            self.first = np.searchsorted(which[order], np.arange(len(self.patterns) + 1))

    def symbols(self, h: np.ndarray) -> np.ndarray:
        place = np.minimum(np.searchsorted(self.vocabulary, h), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[place] == h, place + _FIRST, _OTHER)


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int, block_words: int) -> Iterator[TestWindows]:
    """Test items in blocks of whole items; the driver holds one block at a time."""
    scanner = Scanner(byte_table(PUNCTUATION, lower=True))
    items, hashes, held = [], [], 0
    rows = benchmark.select(F.col(item_col).cast("string"), F.col(text_col).cast("string")).where(F.col(text_col).isNotNull())
    for item, text in rows.toLocalIterator():
        raw = np.frombuffer(text.encode(), np.uint8)
        h = scanner.scan(raw, np.array([0, len(raw)], np.int64))[0]
        if not len(h):
            continue
        if held and held + len(h) > block_words:
            yield TestWindows(items, hashes, window)
            items, hashes, held = [], [], 0
        items.append(item)
        hashes.append(h)
        held += len(h)
    if items:
        yield TestWindows(items, hashes, window)


def _shard_hits(h: np.ndarray, first: np.ndarray, windows: TestWindows):
    """(document, start word, length, pattern) of every occurrence in a shard."""
    if not len(h):
        return (np.zeros(0, np.int64),) * 4
    symbols = windows.symbols(h)
    doc = np.searchsorted(first, np.arange(len(h)), side="right") - 1
    # One break after each document, one place for a run of other words.
    other = symbols == _OTHER
    kept = ~(other & np.concatenate([[False], other[:-1] & (doc[1:] == doc[:-1])]))
    word = np.flatnonzero(kept)
    place = np.arange(len(word)) + doc[word]
    sequence = np.full(len(word) + len(first) - 1, _BREAK, np.int64)
    sequence[place] = symbols[word]
    index = FMIndex(sequence, len(windows.vocabulary) + _FIRST)
    lo, hi = index.search(windows.patterns, windows.lengths)
    n = hi - lo
    found = np.flatnonzero(n)
    pattern = np.repeat(found, n[found])
    row = np.repeat(lo[found], n[found]) + np.arange(len(pattern)) - np.repeat(np.cumsum(n[found]) - n[found], n[found])
    start = word[np.searchsorted(place, index.locate(row))]
    return doc[start], start - first[doc[start]], windows.lengths[pattern], pattern


def _search(batches, windows: TestWindows | None):
    """Adds n_words, spans (start << 8 | length) and items to each row; the text comes last."""
    scanner = Scanner(byte_table(PUNCTUATION, lower=True))
    for batch in batches:
        n_words, spans, items = [], [], []
        for _, raw, off in text_slices(batch.column(batch.num_columns - 1), SHARD_BYTES):
            h, _, _, first = scanner.scan(raw, off)
            n_words.append(np.diff(first))
            docs = len(off) - 1
            if windows is None:
                spans += [None] * docs
                items += [None] * docs
                continue
            doc, start, length, pattern = _shard_hits(h, first, windows)
            order = np.lexsort((start, doc))
            packed = (start << 8 | length)[order]
            cut = np.searchsorted(doc[order], np.arange(docs + 1))
            pairs = np.unique(np.stack([doc, pattern], axis=1), axis=0)
            n = windows.first[pairs[:, 1] + 1] - windows.first[pairs[:, 1]]
            at = np.repeat(windows.first[pairs[:, 1]], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            owned = np.unique(np.stack([np.repeat(pairs[:, 0], n), windows.items[at]], axis=1), axis=0)
            cut_items = np.searchsorted(owned[:, 0], np.arange(docs + 1))
            for i in range(docs):
                spans.append(packed[cut[i] : cut[i + 1]] if cut[i + 1] > cut[i] else None)
                mine = {windows.names[j] for j in owned[cut_items[i] : cut_items[i + 1], 1].tolist()} - {None}
                items.append(sorted(mine) or None)
        words = pa.array(np.concatenate(n_words) if n_words else np.zeros(0, np.int64), pa.int64())
        lists = [pa.array(spans, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string()))]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], words, *lists], [*batch.schema.names[:-1], "n_words", "spans", "items"])


def contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window_words: int = WINDOW_WORDS,
    block_words: int = BLOCK_WORDS,
    carry: list[str] | None = None,
) -> DataFrame:
    """Per row: the `carry` columns (by default the id), n_words, spans, items.

    Words are runs of ASCII letters and digits and of all other characters beyond
    ASCII, A-Z lower-cased. A window is `window_words` consecutive words of one
    test item; an item of fewer words is one window. spans: start << 8 | length,
    in words, of every occurrence, sorted; items: ids, as strings, of the test items that
    have an occurring window, distinct, sorted. Both are empty if there is none. Null
    texts have no words; items whose text is null or has no word are skipped, and items
    without an id hit, but are named nowhere; an empty benchmark hits nothing. Each row
    of a repeated id is searched for itself.
    """
    if not 1 <= window_words <= 255:
        raise ValueError("window_words must be 1 to 255")
    carry = [id_col] if carry is None else list(carry)
    clash = {"n_words", "spans", "items"} & set(carry)
    if clash:
        raise ValueError(f"carried columns clash with output columns: {sorted(clash)}")
    held = documents.select(*carry, F.col(text_col).cast("string").alias("__text"))
    out = T.StructType([*documents.select(*carry).schema.fields, T.StructField("n_words", T.LongType()), T.StructField("spans", T.ArrayType(T.LongType())), T.StructField("items", T.ArrayType(T.StringType()))])
    blocks = _blocks(benchmark, item_col, item_text_col, window_words, block_words)
    head, second = next(blocks, None), next(blocks, None)

    def passed(rows: DataFrame, windows, schema) -> DataFrame:
        sent = shipped(documents.sparkSession, windows)
        return rows.mapInArrow(lambda it: _search(it, sent()), schema)

    filled = [F.coalesce(F.col(c), F.array().cast(f"array<{t}>")).alias(c) for c, t in (("spans", "bigint"), ("items", "string"))]
    if second is None:
        return passed(held, head, out).select(*carry, "n_words", *filled)
    # More than one block: rows get a number, each block adds its hits, and hits are gathered by number.
    numbered = written(held.select(*carry, F.monotonically_increasing_id().alias("__row"), "__text"), "numbered")
    narrow = T.StructType([T.StructField("__row", T.LongType()), *out.fields[-3:]])
    narrow_rows = numbered.select("__row", "__text")
    parts = []
    for windows in (w for group in ([head, second], blocks) for w in group):
        parts.append(written(passed(narrow_rows, windows, narrow).where("spans is not null").drop("n_words"), "hits"))
    hits = parts[0]
    for p in parts[1:]:
        hits = hits.union(p)
    joined = hits.groupBy("__row").agg(*[F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in ("spans", "items")])
    counted = passed(numbered, None, T.StructType([*documents.select(*carry).schema.fields, T.StructField("__row", T.LongType()), *out.fields[-3:]]))
    return counted.drop("spans", "items").join(joined, "__row", "left").select(*carry, "n_words", *filled)


def covered(spans: np.ndarray, n_words: int) -> np.ndarray:
    """Mask of the words inside any span."""
    mark = np.zeros(n_words + 1, np.int32)
    start, length = spans >> 8, spans & 255
    np.add.at(mark, start, 1)
    np.add.at(mark, start + length, -1)
    return np.cumsum(mark[:-1]) > 0


def with_hits(found: DataFrame) -> DataFrame:
    """Adds n_hit: words inside any span, spans merged where they overlap. Replaces a column n_hit."""
    end = lambda s: F.shiftright(s, 8) + s.bitwiseAND(F.lit(255))
    # Spans are sorted by start: a word counts once, at the first span that covers it.
    step = lambda acc, s: F.struct(
        F.greatest(acc["reach"], end(s)).alias("reach"),
        (acc["hit"] + F.greatest(F.lit(0).cast("long"), end(s) - F.greatest(acc["reach"], F.shiftright(s, 8)))).alias("hit"),
    )
    zero = F.lit(0).cast("long")
    return found.withColumn("n_hit", F.aggregate("spans", F.struct(zero.alias("reach"), zero.alias("hit")), step)["hit"])


def _without(raw: bytes, starts: np.ndarray, ends: np.ndarray, hit: np.ndarray) -> bytes:
    """A text without its hit words; what stands between them is trimmed and joined by one space."""
    edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    pieces, at = [], 0
    for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True):
        pieces.append(raw[at : starts[a]])
        at = ends[b - 1]
    pieces.append(raw[at:])
    return b" ".join(p.strip() for p in pieces if p.strip())


def _remove(batches):
    """Rows end in (text, spans): the text with the words of its spans cut out."""
    scanner = Scanner(byte_table(PUNCTUATION, lower=True))
    for batch in batches:
        texts, spans = batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1)
        kept = []
        for i, n in enumerate(np.asarray(pa.compute.list_value_length(spans).fill_null(0))):
            text = texts[i].as_py()
            if n and text is not None:
                raw = text.encode()
                _, starts, ends, _ = scanner.scan(np.frombuffer(raw, np.uint8), np.array([0, len(raw)], np.int64))
                text = _without(raw, starts, ends, covered(np.array(spans[i].as_py(), np.int64), len(starts))).decode()
            kept.append(text)
        yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(kept, pa.string())], [*batch.schema.names[:-2], "__clean"])


def _clean(batches, windows: TestWindows):
    """Rows end in the text: it is replaced by clean_text and n_hit."""
    scanner = Scanner(byte_table(PUNCTUATION, lower=True))
    for batch in batches:
        texts = batch.column(batch.num_columns - 1)
        n_hit, cut = np.zeros(batch.num_rows, np.int64), []
        for row, raw, off in text_slices(texts, SHARD_BYTES):
            h, starts, ends, first = scanner.scan(raw, off)
            doc, start, length, _ = _shard_hits(h, first, windows)
            order = np.argsort(doc, kind="stable")
            doc, spans = doc[order], (start << 8 | length)[order]
            for i in np.unique(doc).tolist():
                mine = spans[np.searchsorted(doc, i) : np.searchsorted(doc, i, side="right")]
                a, b = first[i], first[i + 1]
                hit = covered(mine, b - a)
                n_hit[row + i] = hit.sum()
                cut.append(_without(raw[off[i] : off[i + 1]].tobytes(), starts[a:b] - off[i], ends[a:b] - off[i], hit))
        if cut:
            texts = pa.compute.replace_with_mask(texts, pa.array(n_hit > 0), pa.array(cut, pa.binary()).cast(texts.type))
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], texts, pa.array(n_hit)], [*batch.schema.names[:-1], "clean_text", "n_hit"])


def remove_spans(df: DataFrame, text_col: str = "text", spans_col: str = "spans") -> DataFrame:
    """The text column with merged spans removed; rows without spans keep their text unchanged.

    What stands between removed spans is trimmed and joined by one space. The
    spans column goes; other columns stay as they are.
    """
    others = [c for c in df.columns if c != spans_col]
    held = df.select(*others, F.col(text_col).cast("string").alias("__text"), F.col(spans_col).alias("__spans"))
    schema = T.StructType([*held.select(*others).schema.fields, T.StructField("__clean", T.StringType())])
    return held.mapInArrow(_remove, schema).select(*[F.col("__clean").alias(c) if c == text_col else F.col(c) for c in others])


def decontaminated(
    documents: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window_words: int = WINDOW_WORDS,
    block_words: int = BLOCK_WORDS,
    carry: list[str] | None = None,
) -> DataFrame:
    """Per row: the `carry` columns (none by default), clean_text, n_hit.

    clean_text is the text without the n_hit words that stand inside an occurrence
    of a window (see `contamination`, `remove_spans`); without one it is the text
    itself, null included. Windows of one block are searched and cut in one pass
    over the texts, those of more blocks through `contamination`.
    """
    if not 1 <= window_words <= 255:
        raise ValueError("window_words must be 1 to 255")
    carry = list(carry or [])
    clash = {"clean_text", "n_hit", "n_words", "spans", "items"} & set(carry)
    if clash:
        raise ValueError(f"carried columns clash with output columns: {sorted(clash)}")
    held = documents.select(*carry, F.col(text_col).cast("string").alias("clean_text"))
    blocks = _blocks(benchmark, item_col, item_text_col, window_words, block_words)
    head, second = next(blocks, None), next(blocks, None)
    if head is None:
        return held.withColumn("n_hit", F.lit(0).cast("long"))
    if second is None:
        sent = shipped(documents.sparkSession, head)
        schema = T.StructType([*held.schema.fields, T.StructField("n_hit", T.LongType())])
        return held.mapInArrow(lambda it: _clean(it, sent()), schema)
    found = contamination(held, benchmark, text_col="clean_text", item_col=item_col, item_text_col=item_text_col, window_words=window_words, block_words=block_words, carry=held.columns)
    return remove_spans(with_hits(found), "clean_text", "spans").select(*held.columns, "n_hit")
