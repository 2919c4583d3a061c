"""Spelling variants of a vocabulary: words one edit apart, by dynamic programming over sorted lists.

Two words are near if exactly one inserted, deleted or replaced code point lies between
them. A sorted list of words is scanned for each of its words (the query): the rows of
the edit matrix, a band of three columns, are kept for the path to the entry last read;
an entry goes on from the row at the prefix it shares with that one (the LCP of
neighbours), and once every value of a row exceeds one edit, all entries that share
this prefix are skipped. All words of a task's slice scan in step, as numpy lanes.

One list of the whole vocabulary would be one task, so it is divided by where the edit
lies. ``m`` is the length of the longer word of a pair and the edit is put at the
length of their common prefix. A division (m, p, q) holds the words of m or m - 1 code
points for edits at p..q-1: near words then agree on the first p and the last m - q
code points, and these deal the words to groups; the middles form a group's sorted
list. (m, 0, m) is halved at once; a group that holds more than ``GROUP_CHARS``
code points of middles is halved again, until the edit has one place left and a group
can hold no more words than there are letters. So no frequent prefix makes a large task,
and each pair is found in exactly one group.

A word's form is its near word of largest count (ties: the smaller word), if that count
is at least ``factor`` times its own; counts grow along a chain of forms, so chains are
short, and roots are found by pointer doubling.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.storage import written

# Letters of a word, after A-Z became a-z (fixed values).
RUN = "[a-zÀ-ÿ]"
MIN_CHARS = 7
MIN_COUNT = 2
FACTOR = 10

# A group of more than GROUP_ROWS words and more code points of middles than this is halved again.
GROUP_CHARS = 1 << 18
GROUP_ROWS = 128
# Code points of middles that are scanned at once (a larger single group is scanned alone).
SLICE_CHARS = 1 << 19
# Entries of the table of skips; beyond, skips go entry by entry.
SKIP_CELLS = 1 << 24
ROWS_PER_TASK = 50_000
HELD_WORDS = 200_000


def _counted(batches, min_chars: int, every: int):
    """Partial (word, n) of texts; with ``every``, one run in so many of a document loses a code point."""
    run = re.compile(f"{RUN}{{{min_chars},}}")
    held: Counter = Counter()

    def out():
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        for i in range(batch.num_rows):
            text = texts[i].as_py()
            if not text:
                continue
            text = text.encode().lower().decode()  # bytes.lower() touches A-Z alone
            found = iter(run.findall(text)) if len(text) < 1 << 20 else (x[0] for x in run.finditer(text))
            name = f"{ids[i].as_py() or ''}:".encode()
            while part := Counter(islice(found, HELD_WORDS)):
                for word, n in part.items():
                    if every:
                        h = zlib.crc32(word.encode(), zlib.crc32(name))
                        if h % every == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < min_chars:
                                continue
                    held[word] += n
                if len(held) >= HELD_WORDS:
                    yield out()
                    held.clear()
    if held:
        yield out()


def corpus_words(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_count: int = MIN_COUNT,
    drop_one_in: int = 0,
) -> DataFrame:
    """(word, n): letter runs of whole texts, A-Z lower-cased, of ``min_chars`` code points and ``min_count`` occurrences at least.

    ``drop_one_in`` = k plants misspellings: where k divides the CRC-32 h of
    ``<id>:<run>``, the run's code point h % length goes (before words are measured
    and counted). Null and empty texts give no words; a null id reads as empty.
    """
    given = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    parts = given.mapInArrow(lambda batches: _counted(batches, min_chars, drop_one_in), "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _lcps(codes: np.ndarray, off: np.ndarray, length: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Common prefix of each entry with the one before it; -1 where a group begins."""
    lcp = np.where(first, -1, 0).astype(np.int64)
    at = np.flatnonzero(~first)
    depth = 0
    while len(at):
        at = at[(length[at] > depth) & (length[at - 1] > depth)]
        at = at[codes[off[at] + depth] == codes[off[at - 1] + depth]]
        depth += 1
        lcp[at] = depth
    return lcp


class _Skips:
    """skip(pos, f): the first later entry that shares less than f code points with the one before it."""

    def __init__(self, lcp: np.ndarray):
        self.lcp, self.n = lcp, len(lcp)
        deepest = int(lcp.max(initial=0))
        self.table = None
        if deepest * self.n <= SKIP_CELLS:
            place = np.arange(self.n)
            self.table = np.full((deepest + 1, self.n + 1), self.n, np.int32)
            for f in range(1, deepest + 1):
                stops = np.where(lcp < f, place, self.n)
                self.table[f, : self.n] = np.minimum.accumulate(stops[::-1])[::-1]

    def __call__(self, pos: np.ndarray, f: np.ndarray) -> np.ndarray:
        pos = pos + 1
        if self.table is not None:
            deep = f < len(self.table)
            return np.where(deep, self.table[np.where(deep, f, 0), pos], pos)
        going = np.flatnonzero(pos < self.n)
        while len(going := going[pos[going] < self.n]):
            going = going[self.lcp[pos[going]] >= f[going]]
            pos[going] += 1
        return pos


def near_pairs(
    codes: np.ndarray, off: np.ndarray, length: np.ndarray, first: np.ndarray, span: np.ndarray, follow: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j), i < j, of one group whose middles are one edit apart.

    ``codes[off:off+length]`` are the middles, sorted and distinct in each group,
    ``first`` marks where groups begin, ``span`` is the length of the longer middles
    (the others are one less) and ``follow`` the code point after an entry's middle (0:
    none). Left out, because other groups hold them, are pairs of two shorter middles
    and pairs whose edit can also stand behind the middle.
    """
    n = len(off)
    lcp = _lcps(codes, off, length, first)
    skip = _Skips(lcp)
    number = np.cumsum(first) - 1
    starts = np.flatnonzero(first)
    end = np.append(starts[1:], n)[number]
    deepest = np.maximum.reduceat(length, starts)[number] if n else length
    query = np.flatnonzero(np.arange(n) + 1 < end)
    # The stack of each lane: a row of three values for each depth, at first those of the query itself.
    base = np.concatenate([np.zeros(1, np.int64), np.cumsum(deepest[query] + 1)])
    depth_of = np.arange(base[-1]) - np.repeat(base[:-1], np.diff(base))
    rows = np.full((len(depth_of), 3), 2, np.uint8)
    rows[:, 1] = 0
    rows[depth_of >= 1, 0] = 1
    rows[depth_of < np.repeat(length[query], np.diff(base)), 2] = 1
    lcp = np.append(lcp, -1)
    pos = query + 1
    depth = lcp[pos]
    base = base[:-1]
    qlen, qoff, qend = length[query], off[query], end[query]
    last = max(0, len(codes) - 1)
    left, right = [], []
    while len(query):
        a = rows[base + depth].astype(np.int64)
        c = codes[off[pos] + depth]
        # Columns depth, depth + 1 and depth + 2 of the next row; columns beyond the query stay at two edits.
        b0 = np.minimum(a[:, 0] + (c != codes[np.clip(qoff + depth - 1, 0, last)]), a[:, 1] + 1)
        b1 = np.minimum(np.minimum(a[:, 1] + (c != codes[np.minimum(qoff + depth, last)]), a[:, 2] + 1), b0 + 1)
        b0[depth > qlen] = 2
        b1[depth + 1 > qlen] = 2
        b2 = np.minimum(a[:, 2] + (c != codes[np.minimum(qoff + depth + 1, last)]), b1 + 1)
        b2[depth + 2 > qlen] = 2
        dead = (b0 > 1) & (b1 > 1) & (b2 > 1)
        depth = depth + 1
        at = base + depth
        live = ~dead
        rows[at[live], 0] = np.minimum(b0, 2)[live]
        rows[at[live], 1] = np.minimum(b1, 2)[live]
        rows[at[live], 2] = np.minimum(b2, 2)[live]
        whole = live & (depth == length[pos])
        if whole.any():
            column = qlen - depth + 1
            ok = whole & (column >= 0) & (column <= 2) & (np.maximum(depth, qlen) == span[pos])
            ok[ok] = rows[at[ok], column[ok]] == 1
            # The query and one code point more, which is the one that follows: the edit may stand behind the middle.
            longer = np.flatnonzero(ok & (depth == qlen + 1))
            twice = (rows[at[longer] - 1, 1] == 0) & (c[longer] == follow[pos[longer]])
            ok[longer[twice]] = False
            left.append(query[ok])
            right.append(pos[ok])
        step = dead | whole
        # A whole entry shares all it has with what extends it, so it is left by one place.
        pos = np.where(step, skip(pos, np.where(dead, depth, 1 << 40)), pos)
        depth = np.where(step, lcp[pos], depth)
        on = pos < qend
        if not on.all():
            query, pos, depth, base, qlen, qoff, qend = (x[on] for x in (query, pos, depth, base, qlen, qoff, qend))
    none = np.zeros(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def _shape(batch: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points, offsets and lengths of the middles."""
    middles = batch.column("middle").combine_chunks()
    codes = np.frombuffer("".join(middles.to_pylist()).encode("utf-32-le"), np.uint32)
    length = pc.utf8_length(middles).to_numpy(zero_copy_only=False).astype(np.int64)
    return codes, np.cumsum(length) - length, length


def _firsts(rows: pa.Table) -> np.ndarray:
    """Where a new group begins."""
    first = np.ones(rows.num_rows, bool)
    if rows.num_rows > 1:
        same = np.ones(rows.num_rows - 1, bool)
        for name in ("m", "p", "q", "head", "tail"):
            col = rows.column(name).combine_chunks()
            same &= pc.equal(col.slice(1), col.slice(0, len(col) - 1)).to_numpy(zero_copy_only=False)
        first[1:] = ~same
    return first


def _found(rows: pa.Table, factor: int) -> pa.RecordBatch | None:
    """(word, n_near, form_n, form) of whole groups: counts, and the best near words that can be forms."""
    first = _firsts(rows)
    codes, off, length = _shape(rows)
    tails = pc.utf8_slice_codeunits(rows.column("tail"), 0, 1).to_pylist()
    follow = np.array([ord(t) if t else 0 for t in tails], np.uint32)
    span = rows.column("q").to_numpy().astype(np.int64) - rows.column("p").to_numpy()
    i, j = near_pairs(codes, off, length, first, span, follow)
    if not len(i):
        return None
    n = rows.column("n").to_numpy()
    word, other = np.concatenate([i, j]), np.concatenate([j, i])
    order = np.lexsort((-n[other], word))
    word, other = word[order], other[order]
    start = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
    best = n[other[start]]
    size = np.diff(np.append(start, len(word)))
    # Near words of the group's largest count: ties are settled where the groups of a word meet.
    tied = (n[other] == np.repeat(best, size)) & (n[other] >= factor * n[word])
    spelled = pc.binary_join_element_wise(rows.column("head"), rows.column("middle"), rows.column("tail"), "").combine_chunks()
    k, t = len(start), int(tied.sum())
    return pa.RecordBatch.from_arrays(
        [
            spelled.take(pa.array(np.concatenate([word[start], word[tied]]))),
            pa.array(np.concatenate([size, np.zeros(t, np.int64)]), pa.int64()),
            pa.concat_arrays([pa.nulls(k, pa.int64()), pa.array(n[other[tied]], pa.int64())]),
            pa.concat_arrays([pa.nulls(k, pa.string()), spelled.take(pa.array(other[tied]))]),
        ],
        ["word", "n_near", "form_n", "form"],
    )


def _scanned(batches, factor: int):
    """Whole groups of a sorted partition, some of them at once."""
    held, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += int(pc.sum(pc.utf8_length(batch.column(batch.schema.get_field_index("middle")))).as_py()) + batch.num_rows
        if size < SLICE_CHARS:
            continue
        rows = pa.Table.from_batches(held)
        cut = int(np.flatnonzero(_firsts(rows))[-1])  # the last group may go on
        if cut and (out := _found(rows.slice(0, cut), factor)) is not None:
            yield out
        rest = rows.slice(cut)
        held, size = rest.to_batches(), int(pc.sum(pc.utf8_length(rest.column("middle"))).as_py()) + rest.num_rows
    if held and (out := _found(pa.Table.from_batches(held), factor)) is not None:
        yield out


GROUP = ["m", "p", "q", "head", "tail"]


def _dealt(rows: DataFrame) -> DataFrame:
    """Each word as the head and tail its group shares and the middle between them."""
    return rows.select(
        "n", "m", "p", "q",
        F.expr("substr(word, 1, p)").alias("head"),
        F.expr("substr(word, p + 1, char_length(word) - (m - q) - p)").alias("middle"),
        F.expr("substr(word, char_length(word) - (m - q) + 1)").alias("tail"),
    )


def _halved(rows: DataFrame) -> DataFrame:
    """Each (word, n, m, p, q) for the edits in the first and in the second half of p..q-1."""
    half = F.floor((F.col("p") + F.col("q")) / 2).cast("int")
    parts = F.array(F.struct(F.col("p").alias("p"), half.alias("q")), F.struct(half.alias("p"), F.col("q").alias("q")))
    return rows.select("word", "n", "m", F.inline(parts))


def _groups(words: DataFrame, group_chars: int) -> DataFrame:
    """All rows of all groups of two words or more, large groups divided."""
    size = F.char_length("word")
    longer = F.explode(F.array(size, size + 1)).alias("m")
    whole = words.where(size > 0).select("word", "n", longer).select("word", "n", "m", F.lit(0).alias("p"), F.col("m").alias("q"))
    ready, rows = None, _halved(whole)
    while True:
        dealt = written(_dealt(rows), "spelling_rows")
        sizes = dealt.groupBy(*GROUP).agg(F.count("*").alias("words"), F.sum(F.char_length("middle")).alias("chars"))
        large = (F.col("words") > GROUP_ROWS) & (F.col("chars") > group_chars) & (F.col("q") - F.col("p") > 1)
        hot = written(sizes.where(large).select(*GROUP), "spelling_large")
        if hot.isEmpty():
            return dealt if ready is None else ready.unionByName(dealt)
        cold = dealt.join(hot, GROUP, "left_anti").select(*dealt.columns)
        ready = cold if ready is None else ready.unionByName(cold)
        rows = _halved(dealt.join(hot, GROUP, "left_semi").withColumn("word", F.concat("head", "middle", "tail")))


def _roots(links: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the last form of each chain, by doubling."""
    roots = written(links.select("word", F.col("form").alias("root")), "spelling_roots")
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        moved = roots.join(onward, "root", "left").select("word", F.coalesce("onward", "root").alias("root"), F.col("onward").isNotNull().alias("moved"))
        moved = written(moved, "spelling_roots")
        roots = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return roots


def spelling_variants(words: DataFrame, *, factor: int = FACTOR, group_chars: int = GROUP_CHARS) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of a (word, n) table.

    Any non-null text is a word; equal words count together, null words and words whose
    counts are all null go, and other columns are ignored. ``n_near`` counts near words
    (0: none), ``form`` is the near word of largest n (ties: smallest in code-point
    order) if its n is ``factor`` times the word's or more, else null, ``root`` the end
    of the chain of forms. An empty table gives no rows.
    """
    vocabulary = words.where("word is not null and n is not null").groupBy("word").agg(F.sum("n").alias("n"))
    vocabulary = written(vocabulary, "spelling_words")
    rows = _groups(vocabulary, group_chars)
    spark = words.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-4 * vocabulary.count() // ROWS_PER_TASK))
    order = rows.repartition(tasks, *GROUP).sortWithinPartitions(*GROUP, "middle").select(*GROUP, "middle", "n")
    found = order.mapInArrow(lambda batches: _scanned(batches, factor), "word string, n_near long, form_n long, form string")
    none = vocabulary.select("word", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("long").alias("form_n"), F.lit(None).cast("string").alias("form"), "n")
    met = none.unionByName(found.withColumn("n", F.lit(None).cast("long")))
    best = F.min(F.when(F.col("form").isNotNull(), F.struct((-F.col("form_n")).alias("less"), F.col("form").alias("form"))))
    near = written(met.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("best")), "spelling_near")
    near = near.select("word", "n", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))
    roots = _roots(near.where("form is not null"))
    return near.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
