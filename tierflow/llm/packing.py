"""Best-fit packing of token pieces into sequences under several capacities.

Documents are tokenised in the tasks that read them. A document longer than a
sequence is cut so that its first piece may be short and all later ones are
full. Pieces are written once; full ones are sequences of their own in the tasks
that read them. The others are counted and dealt evenly into as many shards of
about ``SHARD_PIECES`` as that count asks for, and each shard is packed by vector best fit,
longest pieces first: a bin has residual capacities of tokens, documents and
attention cost (the sum of squared lengths); among the bins that can take the
piece under every constraint, the one whose weighted residual vector has the
smallest norm afterwards (or the largest dot product with the piece) takes it.
No group is packed by more than one task and none grows with the corpus.
"""

from __future__ import annotations

import json
import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.storage import written
from tierflow.llm.words import Powers, Rolling, mix, reduced, text_slices

SEQUENCE_TOKENS = 1024
SHARD_PIECES = 120_000
# Sequences of one full piece are numbered from here on, those of shard n from n * 2**40 on.
FULL = 1 << 62
END_ID = 2
# Distinct chunks whose ids a task keeps.
KEPT_CHUNKS = 300_000
SLICE_BYTES = 2 << 20

# The byte-level splitting pattern of the tokenizer file, ASCII white
# space, and the last and first bytes that UTF-8 forms of other white space can have.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_SPACE = bytes([9, 10, 11, 12, 13, 32])
_SPACE_ENDS = bytes([*range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF])
_SPACE_LEADS = bytes([0xC2, 0xE1, 0xE2, 0xE3])


def _flags(which: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[np.frombuffer(which, np.uint8)] = True
    return t


class Tokens:
    """Ids of whole texts under a byte-level BPE file of the `tokenizers` library.

    The file's splitting pattern never joins characters across a place where white
    space follows something else, so texts are cut there into chunks, each distinct
    chunk of a task is encoded once and its ids are gathered with numpy. New chunks
    are encoded in one call, by ranks read from the same file when its merges stand
    in rank order and it splits by PATTERN, else by the file's own tokenizer; a
    text that holds a special token is always encoded whole by the latter.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.path, self.own = path, None
        with open(path, encoding="utf8") as f:
            spec = json.load(f)
        self.special = [t["content"].encode() for t in spec["added_tokens"]]
        self.ranked = self._ranked(spec)
        self.powers, self.values = Powers(0xD1342543DE82EF95), reduced(mix(np.arange(1, 257, dtype=np.uint64)))
        self.space, self.space_end, self.space_lead = map(_flags, (_SPACE, _SPACE_ENDS, _SPACE_LEADS))
        self._forget()

    def _forget(self):
        self.keys, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.uint32)
        self.start = self.size = np.zeros(0, np.int64)

    def _ranked(self, spec: dict):
        import tiktoken
        from tokenizers.pre_tokenizers import ByteLevel

        pre, model = spec["pre_tokenizer"] or {}, spec["model"]
        if pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or spec["normalizer"] or model["type"] != "BPE":
            return None
        letters = _byte_letters(ByteLevel.alphabet())
        vocab = model["vocab"]
        joined = [vocab.get("".join(m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]]
        if None in joined or joined != sorted(joined):
            return None
        special = {t["content"] for t in spec["added_tokens"]}
        ranks = {bytes(letters[c] for c in t): i for t, i in vocab.items() if t not in special}
        self.length = np.zeros(max(vocab.values()) + 1, np.int64)
        for t, i in ranks.items():
            self.length[i] = len(t)
        return tiktoken.Encoding("from_file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def whole(self, text: str) -> np.ndarray:
        if self.own is None:
            from tokenizers import Tokenizer

            self.own = Tokenizer.from_file(self.path)
        return np.array(self.own.encode(text, add_special_tokens=False).ids, np.uint32)

    def _encode(self, chunks: list[bytes], lead: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, start, size) of chunks of which no two neighbours may merge, without `lead` ids of each."""
        ids = self.ranked.encode_to_numpy(b"".join(chunks).decode(), disallowed_special=())
        ends = np.cumsum(self.length[ids])
        stop = np.searchsorted(ends, np.cumsum(np.fromiter(map(len, chunks), np.int64, len(chunks))), side="right")
        start = np.concatenate([[0], stop[:-1]]) + lead
        return ids, start, stop - start

    def _learn(self, keys: np.ndarray, raw: np.ndarray, begin: np.ndarray, end: np.ndarray):
        """Encode new chunks and keep their ids under their hashes."""
        # A chunk that begins without white space gets a line break, whose id is left out,
        # so that it doesn't run on from the one before. One that ends in white space, or may
        # begin with white space beyond ASCII, goes alone: these stand at the ends of a text.
        data = raw.tobytes()
        chunks = [data[x:y] for x, y in zip(begin.tolist(), end.tolist(), strict=True)]
        last = raw[end - 1]
        ends = self.space[last] | (self.space_end[last] & (raw[np.maximum(end - 2, 0)] != 0xC3))
        head = raw[begin]
        bare = ~self.space[head]
        ends |= self.space_lead[head]
        groups = [(np.flatnonzero(~ends & ~bare), 0), (np.flatnonzero(~ends & bare), 1), *((np.array([i]), 0) for i in np.flatnonzero(ends))]
        start, size, ids, held = [self.start], [self.size], [self.ids], len(self.ids)
        order = [group for group, _ in groups]
        for group, lead in groups:
            if len(group):
                more, at, n = self._encode([b"\n" * lead + chunks[i] for i in group.tolist()], lead)
                ids.append(more)
                start.append(at + held)
                size.append(n)
                held += len(more)
        known = np.concatenate([self.keys, keys[np.concatenate(order)]])
        by = np.argsort(known, kind="stable")
        self.keys, self.start, self.size, self.ids = known[by], np.concatenate(start)[by], np.concatenate(size)[by], np.concatenate(ids)

    def slice(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, first id of each text and the total) of the texts of a slice."""
        n = len(raw)
        blank = self.space[raw]
        cut = np.zeros(n + 1, bool)
        if n > 1:
            safe = ~self.space_end[raw[:-1]]
            safe[1:] |= raw[:-2] == 0xC3  # a letter
            cut[1:n] = blank[1:] & ~blank[:-1] & safe
        cut[offsets] = True
        cuts = np.flatnonzero(cut)
        begin, end = cuts[:-1], cuts[1:]
        h = Rolling([v[raw] for v in self.values], self.powers).of(begin, end)
        distinct, at, which = np.unique(h, return_index=True, return_inverse=True)
        if len(self.keys) > KEPT_CHUNKS:
            self._forget()
        place = np.searchsorted(self.keys, distinct)
        fresh = np.flatnonzero(self.keys[np.minimum(place, len(self.keys) - 1)] != distinct) if len(self.keys) else np.arange(len(distinct))
        if len(fresh):
            self._learn(distinct[fresh], raw, begin[at[fresh]], end[at[fresh]])
            place = np.searchsorted(self.keys, distinct)
        entry = place[which.reshape(-1)]
        size, first = self.size[entry], self.start[entry]
        total = np.cumsum(size)
        out = self.ids[np.repeat(first - (total - size), size) + np.arange(int(total[-1]) if len(total) else 0)]
        chunk_at = np.searchsorted(begin, offsets)
        return out, np.concatenate([[0], total])[chunk_at]

    def texts(self, raw: np.ndarray, offsets: np.ndarray):
        """Ids of each text of a slice."""
        if self.ranked is None:
            data = raw.tobytes()
            for a, b in zip(offsets[:-1], offsets[1:], strict=True):
                yield self.whole(data[a:b].decode())
            return
        ids, first = self.slice(raw, offsets)
        data = raw.tobytes()
        marked = [i for s in self.special if s in data for i in range(len(offsets) - 1) if s in data[offsets[i] : offsets[i + 1]]]
        for i in range(len(offsets) - 1):
            yield self.whole(data[offsets[i] : offsets[i + 1]].decode()) if i in marked else ids[first[i] : first[i + 1]]


def _byte_letters(alphabet: list[str]) -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable bytes stand for themselves, others follow from U+0100 on."""
    plain = [b for b in range(256) if chr(b) in alphabet]
    others = [b for b in range(256) if chr(b) not in alphabet]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _pieces(batches, path: str, most: int, end_id: int):
    tokens = Tokens(path)
    end = np.array([end_id], "<u4").tobytes()
    for batch in batches:
        ids = batch.column(0).to_pylist()
        out: list[tuple] = []
        row = 0
        for _, raw, off in text_slices(batch.column(1), SLICE_BYTES):
            for encoded in tokens.texts(raw, off):
                data = encoded.astype("<u4").tobytes() + end
                n = len(data) // 4
                size, at = (n - 1) % most + 1, 0  # only the first piece may be short
                for piece in range(-(-n // most)):
                    out.append((ids[row], piece, at, size, zlib.crc32(data[4 * at : 4 * (at + size)])))
                    at, size = at + size, most
                row += 1
        cols = list(zip(*out, strict=True)) or [[]] * 5
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])


def pieces(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", most: int = SEQUENCE_TOKENS, end_id: int = END_ID) -> DataFrame:
    """Token pieces of every row; null text is empty and gives one piece, the end id."""
    return df.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(lambda it: _pieces(it, tokenizer_path, most, end_id), PIECES)


def best_fit(length: np.ndarray, capacity: tuple[int, int, int], weights: tuple[float, float, float], rule: str) -> np.ndarray:
    """Bin of each piece; length must be descending and a single piece must fit an empty bin.

    Pieces of one length are placed together: bins are scored once, the best ones
    take a piece each, and scoring goes on until none fits and bins are opened.
    """
    cap = np.array(capacity, float)
    scale = np.sqrt(np.array(weights, float)) / cap
    bins = np.zeros(len(length), np.int64)
    room = np.zeros((1024, 3), np.int64)  # residual tokens, documents, attention
    opened = 0
    live = np.zeros(0, np.int64)  # bins that can take a piece of one token
    cut = np.flatnonzero(np.concatenate([[True], length[1:] != length[:-1]])) if len(length) else []
    for a, b in zip(cut, [*cut[1:], len(length)], strict=True):
        size = int(length[a])
        need = np.array([size, 1, size * size])
        at = a
        while at < b:
            fits = live[np.all(room[live] >= need, axis=1)]
            if len(fits):
                left = (room[fits] - need) * scale
                score = np.square(left).sum(axis=1) if rule == "norm" else -(room[fits] * scale) @ (need * scale)
                take = min(b - at, len(fits))
                best = fits[np.argsort(score, kind="stable")[:take]]
            else:
                per = max(1, int(np.min(np.array(capacity) // need)))  # pieces of this length that one bin holds
                take = -(-(b - at) // per)
                best = np.arange(opened, opened + take)
                while len(room) < opened + take:
                    room = np.concatenate([room, np.zeros_like(room)])
                room[best] = capacity
                opened += take
                live = np.concatenate([live, best])
            bins[at : at + take] = best
            room[best] -= need
            at += take
        live = live[np.all(room[live] >= 1, axis=1)]
    return bins


def _pack(batches, capacity: tuple[int, int, int], weights: tuple[float, float, float], rule: str):
    from pyspark import TaskContext

    shard = TaskContext.get().partitionId()
    cols: list[list[np.ndarray]] = [[], [], [], [], [], []]
    for batch in batches:
        values = [batch.column(0).is_null(), batch.column(0).fill_null(0), *batch.columns[1:]]
        for c, v in zip(cols, values, strict=True):
            c.append(v.to_numpy(zero_copy_only=False))
    if not cols[0]:
        return
    null, doc, piece, start, length, crc = (np.concatenate(c) for c in cols)
    order = np.lexsort((crc, start, piece, doc, null, -length))
    null, doc, piece, start, length, crc = (c[order] for c in (null, doc, piece, start, length, crc))
    bins = best_fit(length, capacity, weights, rule)
    order = np.lexsort((np.arange(len(bins)), bins))
    head = np.concatenate([[True], bins[order][1:] != bins[order][:-1]])
    run = np.cumsum(length[order]) - length[order]
    offset = np.empty(len(bins), np.int64)
    offset[order] = run - run[np.maximum.accumulate(np.where(head, np.arange(len(bins)), 0))]
    yield pa.RecordBatch.from_arrays(
        [pa.array(doc, mask=null), pa.array(piece), pa.array(start), pa.array(length), pa.array(crc), pa.array(bins + (shard << 40)), pa.array(offset)],
        ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    )


def pack(
    parts: DataFrame,
    most: int = SEQUENCE_TOKENS,
    documents: int | None = None,
    attention: int | None = None,
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05),
    rule: str = "norm",
    shard_pieces: int = SHARD_PIECES,
) -> DataFrame:
    """Writes the pieces and adds sequence_id and offset to them.

    Capacities of a sequence: `most` tokens, `documents` pieces (default: as many
    as tokens) and `attention`, the sum of squared lengths (default: that of one
    full piece). A single piece must fit: attention must allow the longest one.
    rule: "norm" or "dot".
    """
    documents = most if documents is None else documents
    attention = most * most if attention is None else attention
    if documents < 1 or attention < most * most or rule not in ("norm", "dot"):
        raise ValueError("a sequence must be able to hold one full piece; rule is norm or dot")
    parts = written(parts, "pieces")
    short, full = parts.where(F.col("length") < most), parts.where(F.col("length") >= most)
    shards = max(1, -(-short.count() // shard_pieces))
    dealt = short.repartition(shards, F.xxhash64("doc_id", "piece", "ids_crc32", "length"))
    capacity = (most, documents, attention)
    packed = dealt.mapInArrow(lambda it: _pack(it, capacity, weights, rule), PIECES + ", sequence_id long, offset long")
    return packed.union(full.select("*", F.monotonically_increasing_id() + F.lit(FULL), F.lit(0).cast("long")))


def pack_documents(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", most: int = SEQUENCE_TOKENS, **limits) -> DataFrame:
    """Tokenise and pack every row: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Repeated rows are packed one by one; rows without an id keep a null doc_id.
    An empty table gives an empty result. Other columns are not read.
    """
    return pack(pieces(df, tokenizer_path, id_col, text_col, most), most, **limits)
