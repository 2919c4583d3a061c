"""Word-piece token counts by a linear longest-match automaton.

The vocabulary is a trie over bytes and an end-of-word symbol. Every node has a
failure link: where matching goes on when the next symbol has no edge, after the
longest pieces that are then certain have been popped. How many are popped is
precomputed, so counting walks a word once, adds popped counts, and never builds a
piece. The distinct words of a slice of texts walk together, a symbol at a time.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.llm.storage import shipped
from tierflow.llm.words import Scanner, byte_table, text_slices

END = 256
SYMBOLS = 257
NONE = -1


class Automaton:
    """edges (sorted node * SYMBOLS + symbol -> node), failure links, popped counts.

    The end symbol alone, if it is a piece, counts as no token.
    """

    def __init__(self, pieces: list[tuple[int, ...]]):
        children: list[dict[int, int]] = [{}]
        whole = [False]
        for piece in pieces:
            at = 0
            for symbol in piece:
                if symbol not in children[at]:
                    children[at][symbol] = len(children)
                    children.append({})
                    whole.append(False)
                at = children[at][symbol]
            whole[at] = at > 0
        fail, pops = [NONE] * len(children), [0] * len(children)
        level = [0]
        while level:  # by depth: a link leads to a node of smaller depth
            below = []
            for u in level:
                for symbol, v in children[u].items():
                    below.append(v)
                    if whole[v]:
                        fail[v], pops[v] = 0, int(u > 0 or symbol != END)
                        continue
                    z, n = fail[u], pops[u]
                    while z != NONE and symbol not in children[z]:
                        n, z = n + pops[z], fail[z]
                    if z != NONE:
                        fail[v], pops[v] = children[z][symbol], n
            level = below
        edges = sorted((u * SYMBOLS + symbol, v) for u, kids in enumerate(children) for symbol, v in kids.items())
        self.edges = np.array([e for e, _ in edges] or [0], np.int64)
        self.to = np.array([v for _, v in edges] or [0], np.int32)
        self.fail, self.pops = np.array(fail, np.int32), np.array(pops, np.int32)
        if not edges:
            self.edges[0] = -1

    def step(self, node: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """The next node, NONE where there is no edge."""
        key = node.astype(np.int64) * SYMBOLS + symbol
        at = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
        return np.where(self.edges[at] == key, self.to[at], NONE)

    def count(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Pieces of each word raw[start:end]; 0 where the vocabulary cannot spell it."""
        size = (end - start).astype(np.int64)
        order = np.argsort(-size, kind="stable")
        start, size = start[order], size[order]
        n, node, dead = np.zeros(len(size), np.int64), np.zeros(len(size), np.int32), np.zeros(len(size), bool)
        for place in range(int(size[0]) + 1 if len(size) else 0):
            live = np.searchsorted(-size, -place, side="right")  # words with a symbol left, the end included
            lanes = np.flatnonzero(~dead[:live])
            symbol = np.where(size[lanes] > place, raw[np.minimum(start[lanes] + place, len(raw) - 1)].astype(np.int64), END)
            while len(lanes):
                then = self.step(node[lanes], symbol)
                moved = then != NONE
                node[lanes[moved]] = then[moved]
                lanes, symbol = lanes[~moved], symbol[~moved]
                lanes, symbol = self._pop(lanes, symbol, n, node, dead)
        lanes = np.flatnonzero(~dead & (node != 0))
        while len(lanes):
            lanes, _ = self._pop(lanes, lanes, n, node, dead)
            lanes = lanes[node[lanes] != 0]
        n[dead] = 0
        out = np.zeros(len(size), np.int64)
        out[order] = n
        return out

    def _pop(self, lanes, symbol, n, node, dead):
        back = self.fail[node[lanes]]
        lost = back == NONE
        dead[lanes[lost]] = True
        lanes, symbol, back = lanes[~lost], symbol[~lost], back[~lost]
        n[lanes] += self.pops[node[lanes]]
        node[lanes] = back
        return lanes, symbol


def vocabulary(path: str, word_end: str = "</w>") -> list[tuple[int, ...]]:
    """Pieces of a byte-level vocabulary file of the `tokenizers` library, as symbols."""
    from tokenizers.pre_tokenizers import ByteLevel

    with open(path, encoding="utf8") as f:
        spec = json.load(f)
    special = {t["content"] for t in spec["added_tokens"]}
    alphabet = set(ByteLevel.alphabet())
    # Printable bytes stand for themselves, the others for letters from U+0100 on.
    letter = {chr(b): b for b in range(256) if chr(b) in alphabet}
    letter |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if chr(b) not in alphabet)}
    pieces = []
    for token in spec["model"]["vocab"]:
        body = token.removesuffix(word_end)
        if token not in special and body and all(c in letter for c in body):
            pieces.append((*[letter[c] for c in body], *([END] if body != token else [])))
    return [*pieces, (END,)]  # a word may also end in a piece that is not marked as an ending


def _words(scanners, raw, offsets):
    """(hash, start, end, text) of words: runs of letters, digits and bytes beyond ASCII, and runs of other marks."""
    out = []
    for kind, scanner in enumerate(scanners):
        h, start, end, first = scanner.scan(raw, offsets)
        out.append((h ^ np.uint64(kind), start, end, np.repeat(np.arange(len(offsets) - 1), np.diff(first))))
    return [np.concatenate(c) for c in zip(*out, strict=True)]


def _tables() -> list[np.ndarray]:
    """Two tables of bytes: one keeps word bytes, the other marks; white space and controls are in neither."""
    letters = [b for b in range(256) if chr(b).isalnum() and b < 128 or b >= 128]
    marks = [b for b in range(33, 127) if b not in letters]
    return [byte_table(bytes(sorted(set(range(256)) - set(keep))), lower=True) for keep in (letters, marks)]


def _count(batches, automaton: Automaton):
    scanners = [Scanner(t) for t in _tables()]
    lower = byte_table(b"", lower=True)
    for batch in batches:
        words, tokens, unknown = [], [], []
        for _, raw, off in text_slices(batch.column(batch.num_columns - 1)):
            h, start, end, text = _words(scanners, raw, off)
            _, at, which = np.unique(h, return_index=True, return_inverse=True)
            n = automaton.count(lower[raw], start[at], end[at])[which.reshape(-1)]
            docs = len(off) - 1
            words.append(np.bincount(text, minlength=docs))
            unknown.append(np.bincount(text[n == 0], minlength=docs))
            tokens.append(np.bincount(text, np.maximum(n, 1), docs).astype(np.int64))
        values = [pa.array(np.concatenate(v) if v else np.zeros(0, np.int64), pa.int64()) for v in (words, tokens, unknown)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *values], [*batch.schema.names[:-1], "n_words", "n_tokens", "n_unknown"])


def token_counts(df: DataFrame, pieces: list[tuple[int, ...]], text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Per row: the `carry` columns (all by default), n_words, n_tokens, n_unknown.

    Words are runs of ASCII letters and digits and characters beyond ASCII, A-Z
    lower-cased, and runs of other visible ASCII marks. A word is cut greedily into
    the longest pieces of the vocabulary, the end of the word being a symbol that an
    ending piece may take along; a word that cannot be spelt is one unknown token. Null and empty texts count zero.
    """
    carry = df.columns if carry is None else list(carry)
    clash = {"n_words", "n_tokens", "n_unknown"} & set(carry)
    if clash:
        raise ValueError(f"carried columns clash with output columns: {sorted(clash)}")
    schema = T.StructType([*df.select(*carry).schema.fields, *[T.StructField(c, T.LongType()) for c in ("n_words", "n_tokens", "n_unknown")]])
    sent = shipped(df.sparkSession, Automaton(pieces))
    return df.select(*carry, F.col(text_col).cast("string").alias("__text")).mapInArrow(lambda it: _count(it, sent()), schema)
