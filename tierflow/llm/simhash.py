"""SimHash near-duplicate groups through a byte-position inverted index.

A fingerprint has 8 positional bytes. Two fingerprints that differ in at most
``max_bits`` bits differ in at most that many bytes, so they share at least
``8 - max_bits`` positional bytes. The inverted index posts each distinct
fingerprint under combinations of ``COVER`` positional bytes chosen so that any
two fingerprints sharing the guaranteed minimum meet in some list. In a list the
shared positional bytes of a pair are tallied, pairs that reach the guaranteed
minimum are retained, and their bit distance is verified.

Scale. Equal fingerprints are merged before the index, so groups of exact copies
cost one posting set. A list returns links that span its connected groups, never
all pairs. A list longer than ``block`` fingerprints is dealt in blocks: each
pair of blocks is one group of rows, so no task holds more than two blocks of a
list, and every pair of the list still meets.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.components import components
from tierflow.llm.storage import written
from tierflow.llm.words import texts_of

BYTES = 8
SHINGLE_WORDS = 4
MAX_BITS = 4
BLOCK = 8192

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def cover(shared: int) -> list[tuple[int, ...]]:
    """Byte combinations such that any `shared` of the 8 positions hold one of them.

    Positions are dealt into three rings; a combination of three is taken when it
    lies in one ring, or has two positions in a ring and one in the next. Any four
    positions hold such a combination. With fewer than four shared bytes the
    combinations are the shared ones themselves.
    """
    if shared < 4:
        return list(combinations(range(BYTES), max(shared, 0)))
    ring = lambda p: p % 3
    taken = []
    for c in combinations(range(BYTES), 3):
        r = sorted(map(ring, c))
        if r[0] == r[2] or any(sorted([k, k, (k + 1) % 3]) == r for k in range(3)):
            taken.append(c)
    return taken


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit fingerprint of one text."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    k = min(shingle_words, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    xxh = xxhash.xxh64_intdigest
    h = np.array([xxh(line[a:b], 42) for a, b in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)], np.uint64)
    ones = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(id, fp): the fingerprint as a signed long; null text or no word gives 0."""

    def run(batches):
        for batch in batches:
            out = np.fromiter((fingerprint(t, shingle_words) for t in texts_of(batch.column(1))), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out.view(np.int64))], ["id", "fp"])

    return df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "id long, fp long")


class _Groups:
    """Union-find over row numbers."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i


def _spanning(fp: np.ndarray, rep: np.ndarray, left: np.ndarray, right: np.ndarray, least: int, max_bits: int):
    """Links (rep, rep) that span the groups among left x right of one list."""
    found = _Groups(len(fp))
    for i in left.tolist():
        other = right[found.up[right] != found.up[i]]
        if not len(other):
            continue
        x = fp[other] ^ fp[i]
        same = (x.view(np.uint8).reshape(-1, BYTES) == 0).sum(axis=1)
        kept = other[same >= least]
        close = kept[np.bitwise_count(fp[kept] ^ fp[i]) <= max_bits]
        for j in close.tolist():
            a, b = found.root(i), found.root(j)
            if a != b:
                found.up[max(a, b)] = min(a, b)
                yield rep[i], rep[j]
        if len(close):
            close_roots = found.up[close]
            found.up[close] = found.up[close_roots]


def _list_links(batches, least: int, max_bits: int):
    """Rows come sorted by list; a list's rows are held together, two blocks of one at most."""
    held: list[np.ndarray] = []

    def links(a: np.ndarray):
        # a: key, block pair, side, fp, rep; lists of one fingerprint are gone already
        cut = np.flatnonzero(np.any(a[1:, :2] != a[:-1, :2], axis=1)) + 1
        sizes = np.diff(np.concatenate([[0], cut, [len(a)]]))
        starts = np.concatenate([[0], cut])
        for s, n in zip(starts[sizes > 1].tolist(), sizes[sizes > 1].tolist(), strict=True):
            side, fp, rep = a[s : s + n, 2], a[s : s + n, 3].copy().view(np.uint64), a[s : s + n, 4]
            if n == 2:
                if side[0] != side[1] or side[0] == 2:
                    x = fp[0] ^ fp[1]
                    if int((x.reshape(1).view(np.uint8) == 0).sum()) >= least and int(np.bitwise_count(x)) <= max_bits:
                        yield rep[0], rep[1]
                continue
            rows = np.arange(n)
            if side[0] == 2:
                yield from _spanning(fp, rep, rows, rows, least, max_bits)
            else:
                yield from _spanning(fp, rep, rows[side == 0], rows[side == 1], least, max_bits)

    def out(pairs):
        pairs = list(pairs)
        a = np.array(pairs, np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1])], ["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        a = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
        last = np.flatnonzero(np.any(a[:, :2] != a[-1, :2], axis=1))
        whole = last[-1] + 1 if len(last) else 0
        if not whole and held and np.array_equal(held[-1][-1, :2], a[0, :2]):
            held.append(a)
            continue
        yield out(links(np.concatenate([*held, a[:whole]])))
        held = [a[whole:]]
    if held:
        yield out(links(np.concatenate(held)))


def near_links(prints: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """(a, b) links that span the groups of near fingerprints. prints: distinct (fp, rep)."""
    least = max(0, BYTES - max_bits)
    byte = lambda p: F.shiftrightunsigned(F.col("fp"), 8 * p).bitwiseAND(F.lit(255))
    keys = []
    for n, combo in enumerate(cover(least)):
        key = F.lit(n).cast("long")
        for p in combo:
            key = F.shiftleft(key, 8).bitwiseOR(byte(p))
        keys.append(key)
    posted = prints.select("fp", "rep", F.explode(F.array(*keys)).alias("key"))
    # Lists of more than `block` fingerprints: a short table, found by counts.
    long_lists = written(posted.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > block), "long_lists")
    ordinary, pairs = posted, None
    if not long_lists.isEmpty():
        blocks = F.ceil(F.col("n") / block).cast("int")
        mine = F.pmod(F.xxhash64("fp"), blocks).cast("int")
        dealt = (
            posted.join(long_lists, "key")
            .withColumn("mine", mine)
            .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
            .select(
                "key",
                (F.least("mine", "other").cast("long") * (1 << 31) + F.greatest("mine", "other") + 1).alias("pair"),
                F.when(F.col("mine") == F.col("other"), 2).when(F.col("mine") < F.col("other"), 0).otherwise(1).cast("long").alias("side"),
                "fp",
                "rep",
            )
        )
        ordinary, pairs = posted.join(long_lists, "key", "left_anti"), dealt
    rows = ordinary.select("key", F.lit(0).cast("long").alias("pair"), F.lit(2).cast("long").alias("side"), "fp", "rep")
    rows = rows if pairs is None else rows.union(pairs)
    rows = rows.repartition("key", "pair").sortWithinPartitions("key", "pair")
    return rows.mapInArrow(lambda it: _list_links(it, least, max_bits), "a long, b long")


def near_duplicate_groups(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    block: int = BLOCK,
) -> DataFrame:
    """Per row: id, fingerprint (16 hex digits), component_id (smallest id reachable).

    Null and empty texts have fingerprint zero and form a group like any other.
    Rows without an id get a fingerprint, take no part in groups, and have a null
    component. Repeated ids are rows of one document: each row links that id.
    An empty table gives an empty result. Other columns are not read.
    """
    prints = written(fingerprints(df, id_col, text_col, shingle_words), "prints")
    known = prints.where("id is not null")
    distinct = written(known.groupBy("fp").agg(F.min("id").alias("rep")), "distinct")
    links = near_links(distinct, max_bits, block)
    # An id that stands on several rows joins the groups of all its fingerprints.
    twice = known.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id")
    repeated = known.join(twice, "id").join(distinct, "fp").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    found = components(links.union(repeated), "a", "b")
    labels = distinct.join(found, distinct.rep == found.node, "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return prints.join(labels, "fp", "left").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"),
    )
