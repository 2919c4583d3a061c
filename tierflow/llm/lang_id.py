"""Language identification by error-correcting output codes.

Every language has a codeword of +1 and -1. Each bit has a binary classifier over
hashed byte trigrams: naive Bayes log odds of the languages coded +1 against those
coded -1, every language weighing the same. Counts are summed over all training
rows, in the tasks first. Decoding sums the logistic loss of each bit against a
codeword, weighted by how well the bit's two sides are told apart, and takes the
codeword of least loss; a text whose two best codewords are close is flagged.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.llm.storage import shipped
from tierflow.llm.words import mix, text_slices

BUCKETS = 1 << 16
UNKNOWN = "und"
# Trigrams from which on a longer text gives no more certainty.
ENOUGH = 24
# Flagged as ambiguous when the two best scores differ by less.
MARGIN = 0.2


def _letters() -> np.ndarray:
    """Bytes of words, A-Z lower-cased; everything else a space."""
    t = np.full(256, 32, np.uint8)
    t[97:123] = np.arange(97, 123)
    t[65:91] = np.arange(97, 123)
    t[128:] = np.arange(128, 256)
    return t


def _trigrams(raw: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text) of the trigrams with at least two bytes of words; none crosses two texts."""
    b = table[raw]
    if len(b) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = (b != 32).astype(np.int8)
    keep = word[:-2] + word[1:-1] + word[2:] >= 2
    edge = offsets[1:-1]
    for back in (1, 2):
        e = edge - back
        keep[e[(e >= 0) & (e < len(keep))]] = False
    at = np.flatnonzero(keep)
    g = b[at].astype(np.uint32) << np.uint32(16) | b[at + 1].astype(np.uint32) << np.uint32(8) | b[at + 2]
    bucket = (g * np.uint32(0x9E3779B1)) >> np.uint32(16)
    return bucket.astype(np.int64), np.searchsorted(offsets, at, side="right") - 1


def _counts(batches):
    table = _letters()
    held: dict[str, np.ndarray] = {}
    for batch in batches:
        names, codes = np.unique(np.array(batch.column(1).to_pylist(), object).astype(str), return_inverse=True)
        for row, raw, off in text_slices(batch.column(0)):
            bucket, text = _trigrams(raw, off, table)
            code = codes[row + text]
            for k in np.unique(code):
                n = np.bincount(bucket[code == k], minlength=BUCKETS)
                held[names[k]] = held.get(names[k], 0) + n
        for name in names:  # a language without a trigram is learned too
            held.setdefault(name, np.zeros(BUCKETS, np.int64))
    for name, n in held.items():
        at = np.flatnonzero(n) if n.any() else np.zeros(1, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([name] * len(at)), pa.array(at), pa.array(n[at])], ["lang", "bucket", "n"])


def codewords(languages: int) -> np.ndarray:
    """A row of +1 and -1 for each language: all distinct splits up to seven, else dense pseudo-random bits."""
    if languages <= 1:
        return np.ones((languages, 0))
    if languages <= 7:
        splits = [s for r in range(1, languages) for s in combinations(range(languages), r) if 0 in s]
        return np.array([[1 if k in s else -1 for s in splits] for k in range(languages)])
    bits, best, apart = int(np.ceil(10 * np.log2(languages))), None, -1
    for trial in range(50):
        code = np.where(mix(np.arange(languages * bits, dtype=np.uint64) + np.uint64(trial << 32)).reshape(languages, bits) & np.uint64(1), 1, -1)
        code = code[:, np.abs(code.sum(axis=0)) < languages]
        nearest = min(int((code[a] != code[b]).sum()) for a, b in combinations(range(languages), 2))
        if nearest > apart:
            best, apart = code, nearest
    return best


class Model:
    """languages, code (languages x bits), weights (bits x buckets), trust (bits)."""

    def __init__(self, counts: dict[str, np.ndarray], smoothing: float = 0.5):
        self.languages = sorted(counts)
        self.code = codewords(len(self.languages))
        p = np.array([(counts[k] + smoothing) / (counts[k].sum() + smoothing * BUCKETS) for k in self.languages]).reshape(-1, BUCKETS)
        weights, trust = [], []
        for bit in self.code.T:
            plus, minus = p[bit > 0].mean(axis=0), p[bit < 0].mean(axis=0)
            w = np.log(plus / minus)
            weights.append(w)
            trust.append(min(float(plus @ w), float(-minus @ w)))
        self.weights = np.array(weights).reshape(-1, BUCKETS)
        trust = np.array(trust)
        self.trust = trust / trust.mean() if len(trust) and trust.mean() > 0 else np.ones(len(trust))

    def probabilities(self, sums: np.ndarray, n: np.ndarray) -> np.ndarray:
        """texts x languages from summed weights (bits x texts) of n trigrams."""
        z = sums / np.maximum(n, 1) * np.minimum(n, ENOUGH)
        loss = np.zeros((len(n), len(self.languages)))
        for b in range(len(self.weights)):
            loss += self.trust[b] * np.logaddexp(0, -z[b][:, None] * self.code[:, b][None, :])
        e = np.exp(loss.min(axis=1, keepdims=True) - loss)
        return e / e.sum(axis=1, keepdims=True)


def fit(rows: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learn from all rows with a text and a language. What comes to the driver is languages x buckets at most."""
    known = rows.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    parts = known.select(F.col(text_col).cast("string"), F.col(lang_col).cast("string")).mapInArrow(_counts, "lang string, bucket long, n long")
    counts: dict[str, np.ndarray] = {}
    for lang, buckets, n in parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).groupBy("lang").agg(F.collect_list("bucket").alias("b"), F.collect_list("n").alias("n")).collect():
        counts[lang] = np.zeros(BUCKETS, np.int64)
        counts[lang][buckets] = n
    return Model(counts)


def _predict(batches, model: Model, letters: list[str]):
    """Rows end in the text; it is replaced by lang_pred, score, ambiguous, and whether it has a letter if `letters` has a name for that."""
    table = _letters()
    ascii_letter = np.zeros(256, bool)
    ascii_letter[65:91] = ascii_letter[97:123] = True
    for batch in batches:
        pred, score, unsure, with_letter = [], [], [], []
        col = batch.column(batch.num_columns - 1)
        for row, raw, off in text_slices(col):
            docs = len(off) - 1
            bucket, text = _trigrams(raw, off, table)
            n = np.bincount(text, minlength=docs)
            sums = np.array([np.bincount(text, w[bucket], docs) for w in model.weights]).reshape(-1, docs)
            seen = np.concatenate([[0], np.cumsum(ascii_letter[raw])])
            lettered = seen[off[1:]] > seen[off[:-1]]
            for i in np.flatnonzero(~lettered & (off[1:] > off[:-1])):
                lettered[i] = any(map(str.isalpha, col[row + int(i)].as_py()))
            with_letter.append(lettered)
            if not model.languages:
                lettered = np.zeros(docs, bool)
                p = np.ones((docs, 1))
            else:
                p = model.probabilities(sums, n)
            best = p.argmax(axis=1)
            top = p[np.arange(docs), best]
            rest = p.copy()
            rest[np.arange(docs), best] = 0
            unsure.append(~lettered | (top - rest.max(axis=1) < MARGIN))
            score.append(np.where(lettered, top, 0.0))
            names = [*model.languages, UNKNOWN]
            pred += [names[k] for k in np.where(lettered, best, len(names) - 1).tolist()]
        values = [pa.array(pred, pa.string()), pa.array(np.concatenate(score or [np.zeros(0)])), pa.array(np.concatenate(unsure or [np.zeros(0, bool)]))]
        values += [pa.array(np.concatenate(with_letter or [np.zeros(0, bool)])) for _ in letters]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *values], [*batch.schema.names[:-1], "lang_pred", "score", "ambiguous", *letters])


def predict(df: DataFrame, model: Model, text_col: str = "text", carry: list[str] | None = None, letter_col: str | None = None) -> DataFrame:
    """Per row: the `carry` columns (all by default), lang_pred, score (0 to 1), ambiguous.

    lang_pred is a learned language, or `und` with score 0 (and flagged) when the
    text is null or has no letter, or when nothing was learned. Every row is judged
    for itself by its text alone. Equal losses go to the first language in sort
    order. A `letter_col` adds whether the text has a letter, whatever was learned.
    Carried columns of the names of the output are an error.
    """
    carry = df.columns if carry is None else list(carry)
    letters = [] if letter_col is None else [letter_col]
    clash = {"lang_pred", "score", "ambiguous", *letters} & set(carry)
    if clash:
        raise ValueError(f"carried columns clash with output columns: {sorted(clash)}")
    added = [("lang_pred", T.StringType()), ("score", T.DoubleType()), ("ambiguous", T.BooleanType()), *((c, T.BooleanType()) for c in letters)]
    schema = T.StructType([*df.select(*carry).schema.fields, *[T.StructField(n, t) for n, t in added]])
    sent = shipped(df.sparkSession, model)
    return df.select(*carry, F.col(text_col).cast("string").alias("__text")).mapInArrow(lambda it: _predict(it, sent(), letters), schema)
