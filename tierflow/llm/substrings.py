"""Exact substring dedup through a sparse, prefix-partitioned suffix tree.

A window of ``min_words`` consecutive words is removed when the same words start
earlier (smaller id, then earlier row of the table, or the same row and an earlier
start). Every row has a number of its own, written once with the texts; a place is a
row number and a start, so rows without an id and rows that share one stay apart. In a suffix
tree of the corpus, cut at depth ``min_words``, the windows with equal words are
the leaves below one node of that depth; all but the earliest leaf are repeats,
and consecutive repeated windows merge into the maximal repeats that are removed.

The tree is never held whole. Of all suffixes only those at *anchors* are kept:
the anchor of a window is the leftmost smallest hash among its runs of
``ANCHOR_WORDS`` words. Equal windows have equal anchors at the same offset, so
no repeat is lost, and about one suffix in seven is kept. Suffixes are
partitioned by their prefix, the anchor. The prefix of a suffix is then extended
only as far as a group needs it:

1. ``runs``: consecutive windows of one anchor form a run. Equal runs inside some
   megabytes of text are settled there; only their earliest goes on (pre-aggregation, so a
   passage in a third of all documents is no hot group).
2. ``classes``: per anchor, sorted by the words of the whole run. Later runs of a
   class repeat its first one. An anchor with a single class is done: its prefix
   was long enough. The first runs of other classes share a prefix only.
3. ``leaves``: for those the prefix is extended to the full depth: one row per
   window, grouped by all of its words, all but the earliest repeat.

Sorted streams with constant state do steps 1 to 3; no group is held in memory.
Hashes of 64 bits stand for words, and prefix and full depth are hashed
separately, so two windows are taken for equal on 128 bits.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.llm.storage import written
from tierflow.llm.words import WHITE, Powers, Rolling, Scanner, byte_table, mix, reduced, text_slices, texts_of

MIN_WORDS = 20
ANCHOR_WORDS = 8
# Rows without an id come after all others: this id, and numbers from NO_ID_ROWS on.
NO_ID, NO_ID_ROWS = (1 << 63) - 1, 1 << 62

# Bytes of texts whose runs are settled among themselves before the shuffle, and rows
# whose kept texts are held at once.
SETTLED_BYTES = 8 << 20
CUT_ROWS = 500

RUN = "key long, words long, id long, row long, start long, n long, settled boolean"


class _Windows:
    """Hashes of the runs of words of a slice of texts."""

    def __init__(self, depth: int, anchor: int):
        self.depth, self.anchor = depth, min(anchor, depth)
        self.scanner = Scanner(byte_table(WHITE, lower=False))
        self.short, self.long = Powers(0xA0761D6478BD642F), Powers(0xE7037ED1A0B428DB)

    def runs(self, raw: np.ndarray, offsets: np.ndarray):
        """(key, words, text, start, n) of the runs of all texts of a slice."""
        h, _, _, first = self.scanner.scan(raw, offsets)
        n, k, span = len(h), self.anchor, self.depth - self.anchor + 1
        if n < self.depth:
            none = np.zeros(0, np.int64)
            return none.view(np.uint64), none.view(np.uint64), none, none, none
        at = np.arange(n - k + 1)
        r = reduced(h)
        low, pos = Rolling(r, self.short).of(at, at + k), at
        grams, width = low, 1
        while width < span:  # leftmost smallest of ever wider spans
            step = min(width, span - width)
            later = low[step:] < low[: len(low) - step]
            pos = np.where(later, pos[step:], pos[: len(pos) - step])
            low = np.where(later, low[step:], low[: len(low) - step])
            width += step
        text = np.searchsorted(first, np.arange(len(pos)), side="right") - 1
        valid = np.flatnonzero(np.arange(len(pos)) + self.depth <= first[text + 1])
        pos, text = pos[valid], text[valid]
        new = np.concatenate([[True], (pos[1:] != pos[:-1]) | (valid[1:] != valid[:-1] + 1)]) if len(pos) else np.zeros(0, bool)
        cut = np.flatnonzero(new)
        size = np.diff(np.concatenate([cut, [len(pos)]]))
        begin, text, pos = valid[cut], text[cut], pos[cut]
        words = Rolling(r, self.long).of(begin, begin + size + self.depth - 1)
        shape = (pos - begin).astype(np.uint64) << np.uint64(32) | size.astype(np.uint64)
        return grams[pos], mix(words ^ mix(shape)), text, begin - first[text], size


def _runs(batches, depth: int, anchor: int):
    windows = _Windows(depth, anchor)
    for batch in batches:
        ids, numbers = (c.to_numpy(zero_copy_only=False) for c in batch.columns[:2])
        parts, held = [], 0
        for row, raw, off in text_slices(batch.column(2)):
            key, words, text, start, n = windows.runs(raw, off)
            parts.append((key, words, ids[row + text], numbers[row + text], start, n))
            held += len(raw)
            if held >= SETTLED_BYTES:
                yield _settle(parts)
                parts, held = [], 0
        if parts:
            yield _settle(parts)


def _settle(parts: list[tuple]) -> pa.RecordBatch:
    """Equal runs among these: the earliest stays open, later places are settled."""
    key, words, doc, number, start, n = (np.concatenate(c) for c in zip(*parts, strict=True))
    both = mix(key ^ mix(words))
    order = np.lexsort((start, number, doc, both))
    b = both[order]
    later = np.concatenate([[False], b[1:] == b[:-1]]) if len(b) else np.zeros(0, bool)
    spread = mix(number[order].astype(np.uint64) ^ mix(start[order].astype(np.uint64)))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.where(later, spread, key[order]).view(np.int64)),
            pa.array(words[order].view(np.int64)),
            pa.array(doc[order]),
            pa.array(number[order]),
            pa.array(start[order]),
            pa.array(n[order]),
            pa.array(later),
        ],
        ["key", "words", "id", "row", "start", "n", "settled"],
    )


class _Stream:
    """Walks rows sorted by (key, words, place); state is two rows at most. place: the columns of a place."""

    def __init__(self, place: slice = slice(2, 4)):
        self.place = place
        self.group = self.leader = self.waiting = None

    def take(self, a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """a: key, words, place, n. (repeats, first rows of classes of groups that have several)."""
        key, words = a[:, 0], a[:, 1]
        new_group = np.concatenate([[self.group is None or self.group[0] != key[0]], key[1:] != key[:-1]])
        new_class = new_group | np.concatenate([[self.group is None or self.group[1] != words[0]], words[1:] != words[:-1]])
        lead = np.maximum.accumulate(np.where(new_class, np.arange(len(a)), -1))
        place = a[:, self.place][np.maximum(lead, 0)]
        if self.leader is not None:
            place = np.where((lead < 0)[:, None], self.leader, place)
        repeats = a[~new_class & np.any(a[:, self.place] != place, axis=1)]
        heads = np.flatnonzero(new_class)
        several = ~new_group[heads]  # a class after the group's first
        mixed = several.copy()
        mixed[:-1] |= several[1:]
        open_rows = a[heads[mixed]]
        if len(heads):
            if several[0] and self.waiting is not None:
                open_rows = np.concatenate([self.waiting, open_rows])
            # The last class may be the first of its group: the next rows tell.
            self.waiting = None if mixed[-1] else a[heads[-1:]]
        self.group, self.leader = a[-1, :2].copy(), place[-1].copy()
        return repeats, open_rows


# The columns id, row and start of runs and of leaves.
PLACE = slice(2, 5)


def _classes(batches):
    stream = _Stream(PLACE)
    for batch in batches:
        if not batch.num_rows:
            continue
        a = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[:6]])
        settled = batch.column(6).to_numpy(zero_copy_only=False)
        done, rest = a[settled], a[~settled]
        repeats, open_rows = stream.take(rest) if len(rest) else (rest, rest)
        out = np.concatenate([done, repeats, open_rows])
        flag = np.zeros(len(out), bool)
        flag[len(out) - len(open_rows) :] = True
        yield pa.RecordBatch.from_arrays([pa.array(out[:, 3]), pa.array(out[:, 4]), pa.array(out[:, 5]), pa.array(flag)], ["row", "start", "n", "several"])


def _leaves(batches, depth: int, anchor: int):
    """Rows begin with (id, row, text) and end in the runs: a row for each window of the runs, with all of its words hashed."""
    windows = _Windows(depth, anchor)
    for batch in batches:
        ids, numbers = (c.to_numpy(zero_copy_only=False) for c in batch.columns[:2])
        runs = batch.column(batch.num_columns - 1)
        bounds = np.frombuffer(runs.buffers()[1], np.int32)[runs.offset : runs.offset + len(runs) + 1]
        packed = runs.values.to_numpy(zero_copy_only=False)
        for row, raw, off in text_slices(batch.column(2)):
            h, _, _, first = windows.scanner.scan(raw, off)
            lo, hi = bounds[row], bounds[row + len(off) - 1]
            text = np.repeat(np.arange(len(off) - 1), np.diff(bounds[row : row + len(off)]))
            start, n = packed[lo:hi] >> 8, packed[lo:hi] & 255
            begin = np.repeat(start, n) + (np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n))
            text = np.repeat(text, n)
            at = begin + first[text]
            at_end = np.minimum(at + windows.depth, len(h))
            near, whole = (Rolling(reduced(h), powers).of(at, at_end) for powers in (windows.short, windows.long))
            yield pa.RecordBatch.from_arrays(
                [pa.array(near.view(np.int64)), pa.array(whole.view(np.int64)), pa.array(ids[text + row]), pa.array(numbers[text + row]), pa.array(begin)],
                ["key", "words", "id", "row", "start"],
            )


def _repeated_leaves(batches):
    stream = _Stream(PLACE)
    for batch in batches:
        if batch.num_rows:
            a = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            out, _ = stream.take(a)
            yield pa.RecordBatch.from_arrays([pa.array(out[:, 3]), pa.array(out[:, 4]), pa.array(np.ones(len(out), np.int64))], ["row", "start", "n"])


def repeated_windows(texts: DataFrame, depth: int, anchor: int) -> DataFrame:
    """(row, start, n): n windows from word `start` on that occur earlier. texts: (id, row, text, ...), id not null, each row once.

    All columns of texts go into the join with the open runs, so that the caller's join of texts
    with the result reads the same shuffled texts.
    """
    runs = texts.select("id", "row", "text").mapInArrow(lambda it: _runs(it, depth, anchor), RUN)
    sorted_runs = runs.repartition("key").sortWithinPartitions("key", "words", "id", "row", "start")
    classes = written(sorted_runs.mapInArrow(_classes, "row long, start long, n long, several boolean"), "classes")
    packed = F.collect_list(F.shiftleft("start", 8).bitwiseOR(F.col("n"))).alias("runs")
    several = classes.where("several").groupBy("row").agg(packed)
    leaves = texts.join(several, "row").select(*texts.columns, "runs").mapInArrow(lambda it: _leaves(it, depth, anchor), "key long, words long, id long, row long, start long")
    # A window in many documents is reduced before the shuffle by its run.
    sorted_leaves = leaves.repartition("key").sortWithinPartitions("key", "words", "id", "row", "start")
    late = sorted_leaves.mapInArrow(_repeated_leaves, "row long, start long, n long")
    return classes.where("not several").select("row", "start", "n").union(late)


def _cut(batches, depth: int, carry: list[str]):
    for batch in (b.slice(at, CUT_ROWS) for b in batches for at in range(0, b.num_rows, CUT_ROWS)):
        names = [*carry, "n_words", "n_removed", "kept_text", "kept_sha256"]
        spans, kept_columns = batch.column(3), batch.column(4).flatten()
        n_words, n_removed, kept, digest = [], [], [], []
        for i, text in enumerate(texts_of(batch.column(2))):
            words = text.split()
            n_words.append(len(words))
            hit = spans[i].as_py()
            if hit:
                packed = np.array(hit, np.int64)
                start, n = packed >> 8, packed & 255
                mark = np.zeros(len(words) + 1, np.int32)
                np.add.at(mark, start, 1)
                np.add.at(mark, np.minimum(start + n + depth - 1, len(words)), -1)
                inside = np.cumsum(mark[:-1]) > 0
                words = [words[j] for j in np.flatnonzero(~inside).tolist()]
            line = b" ".join(words)
            n_removed.append(n_words[-1] - len(words))
            kept.append(line if hit else text)
            digest.append(hashlib.sha256(line).hexdigest())
        texts = pa.array(kept, pa.binary()).cast(pa.string())
        given = [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), texts, pa.array(digest, pa.string())]
        yield pa.RecordBatch.from_arrays([*kept_columns, *given], names)


def dedup_substrings(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = MIN_WORDS,
    anchor_words: int = ANCHOR_WORDS,
    carry: list[str] | None = None,
) -> DataFrame:
    """Per row: the `carry` columns (by default the id), n_words, n_removed, kept_text, kept_sha256.

    kept_text is the text itself when nothing is removed, else the kept words
    joined by one space; kept_sha256 is of the joined words in either case. Words
    are runs of bytes other than ASCII white space. Null and empty texts have no
    words. Every row is a document of its own: rows of one id follow each other in
    the order of the rows read, and rows without an id come after all others in
    that order. An empty table gives an empty result. A clash of a carried name with an output name is an error.
    """
    if not 1 <= min_words <= 128 or anchor_words < 1:
        raise ValueError("min_words must be 1 to 128, anchor_words at least 1")
    carry = [id_col] if carry is None else list(carry)
    ident = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    clash = {"n_words", "n_removed", "kept_text", "kept_sha256"} & set(carry)
    if clash:
        raise ValueError(f"carried columns clash with output columns: {sorted(clash)}")
    kept = [F.col(c).alias(f"c{i}") for i, c in enumerate(carry)]
    number = F.monotonically_increasing_id() + F.when(F.col(id_col).cast("long").isNull(), F.lit(NO_ID_ROWS)).otherwise(F.lit(0))
    # Written, so that every reader and every retry sees the same numbers.
    texts = written(df.select(ident.alias("id"), number.alias("row"), text.alias("text"), F.struct(*kept).alias("kept")), "texts")
    texts = texts.where(F.col("row").isNotNull())  # as the inner join reads them: one shuffle of the texts serves both joins
    windows = repeated_windows(texts, min_words, anchor_words)
    spans = windows.groupBy("row").agg(F.collect_list(F.shiftleft("start", 8).bitwiseOR(F.col("n"))).alias("spans"))
    joined = texts.join(spans, "row", "left").select("id", "row", "text", "spans", "kept")
    added = [("n_words", T.LongType()), ("n_removed", T.LongType()), ("kept_text", T.StringType()), ("kept_sha256", T.StringType())]
    schema = T.StructType([*df.select(*carry).schema.fields, *[T.StructField(n, t) for n, t in added]])
    return joined.mapInArrow(lambda it: _cut(it, min_words, carry), schema)

