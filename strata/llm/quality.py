"""Quality scores learned from preference pairs (Bradley-Terry).

A document is a vector of shares read off its whole text: symbols, case,
digits, repeated words and lines, compressibility, word and line lengths.  A
preferred document beats another with probability
``1 / (1 + exp(-w.(x - y)))``; ``w`` minimises the logistic loss of the feature
differences over pairs of a good and a bad training document.  The score is
``w.x``, and the threshold is a quantile of the training scores: the share of
bad documents among them.  Scores are mapped to 0..1 so that the threshold
lands on ``cut``.

The fit takes every training row and every pair of a good and a bad one.  The
pairs are never listed: what a row adds to the gradient depends on its score
and on how the other label's scores are spread, so each Newton step spreads all rows,
by score, over a grid (between its two neighbouring places), works out
the pairs of places on the driver, and adds up what the rows make of that.
Counts and quantiles are exact.  Vectors are written once; a step reads them
twice and hands on sums only.

Defined results: a null or empty text has the vector of an empty text and gets
the score that this gives; rows without label are scored only; without rows
of both labels every score is ``cut``, so nothing is rejected.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, map_rows, materialise

RIDGE = 1e-3
#: places of the grid on one unit of score, and where it ends: farther rows stand at its end, where a pair is as good as certain
FINE, REACH = 16, 64
_PLACES = np.arange(-REACH * FINE, REACH * FINE + 1) / FINE

_CLASS = np.zeros(256, np.int64)  # byte classes: 0 space, 1 lower, 2 upper, 3 digit, 4 full stop and comma, 5 other mark, 6 high
for _c in range(33, 127):
    _CLASS[_c] = 1 if 97 <= _c <= 122 else 2 if 65 <= _c <= 90 else 3 if 48 <= _c <= 57 else 4 if _c in b".," else 5
_CLASS[128:] = 6

FEATURES = ("upper", "upper_soft", "digit", "digit_soft", "mark", "mark_soft", "stop", "high", "space",
            "same_word", "same_word_soft", "distinct_words", "same_line", "same_line_soft", "same_triple",
            "same_triple_soft", "packed", "packed_low", "word_length", "long_words", "line_words", "log_words",
            "empty", "one_char_words")


def _soft(x: float, half: float) -> float:
    return x / (x + half)


def _different_triples(words: list[bytes]) -> int:
    """Different runs of three words, told apart by 64-bit hashes: 8 bytes a word, however long the text."""
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    t = h[:-2]
    for x in (h[1:-1], h[2:]):
        t = (t ^ (t >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + x
    return np.unique(t).size


def features(text: bytes | None) -> list[float]:
    """The vector of :data:`FEATURES` of one text."""
    t = text or b""
    n = len(t)
    if not n:
        return [0.0] * (len(FEATURES) - 2) + [1.0, 0.0]
    kinds = np.bincount(_CLASS, weights=np.bincount(np.frombuffer(t, np.uint8), minlength=256), minlength=7)
    letters = max(1.0, kinds[1] + kinds[2] + kinds[6])
    shown = max(1.0, n - kinds[0])
    words = t.split()
    k = max(1, len(words))
    same = sum(a == b for a, b in zip(words, words[1:])) / k
    again = 1 - _different_triples(words) / (len(words) - 2) if len(words) > 2 else 0.0
    lines = [x for x in t.split(b"\n") if x.strip()]
    same_line = 1 - len(set(lines)) / max(1, len(lines))
    # blocks of about one size, so that the ratio doesn't follow the text's length; the last one takes a short rest
    starts = range(0, max(1, n - 1024), 2048)
    packed = [len(zlib.compress(t[a:b], 1)) / (b - a) for a, b in zip(starts, [*starts[1:], n])]
    upper, digit, mark = kinds[2] / letters, kinds[3] / shown, kinds[5] / shown
    return [upper, _soft(upper, 0.2), digit, _soft(digit, 0.05), mark, _soft(mark, 0.05), kinds[4] / shown,
            kinds[6] / shown, kinds[0] / n, same, _soft(same, 0.1), len(set(words)) / k, same_line,
            _soft(same_line, 0.1), again, _soft(again, 0.1), sum(packed) / len(packed), min(packed),
            min(20.0, shown / k), sum(len(w) > 24 for w in words) / k, min(200, k / max(1, len(lines))) / 200,
            float(np.log1p(k)), 0.0, sum(len(w) == 1 for w in words) / k]


def _raw(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """``x @ w``, the same for a row whatever rows come with it."""
    return (np.ascontiguousarray(x) * w).sum(axis=1)


@dataclass
class Ranker:
    """``score = w.x``; ``threshold`` on that scale is mapped to ``cut``."""

    w: np.ndarray
    threshold: float
    cut: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        raw = np.clip(_raw(x, self.w) - self.threshold, -30, 30)
        return 1 / (1 + np.exp(-raw) * (1 - self.cut) / self.cut)


# ---- what a batch of rows adds to a sum, added to ``out`` (places, columns)

def _add_rows(x, good, out):
    for k in (0, 1):
        out[k, 0] += (good == k).sum()
        out[k, 1:] += x[good == k].sum(axis=0)


def _add_squares(x, good, out, mean):
    out[0] += ((x - mean) ** 2).sum(axis=0)


def _add_places(x, good, out, mean, scale, w):
    """Rows and their vectors by label and place of the grid, each shared between its two neighbours."""
    z = (x - mean) / scale
    at = (np.clip(z @ w, -REACH, REACH) + REACH) * FINE
    low = np.minimum(at.astype(np.int64), len(_PLACES) - 2)
    own = np.column_stack([np.ones(len(z)), z])
    for place, share in ((low, 1 - (at - low)), (low + 1, at - low)):
        cell = (2 * place + good)[:, None] * own.shape[1] + np.arange(own.shape[1])
        out += np.bincount(cell.ravel(), (own * share[:, None]).ravel(), out.size).reshape(out.shape)


def _add_products(x, good, out, mean, scale, w, spread):
    """Products of the vectors; a row weighs what its label's (places, weights) in ``spread`` say."""
    z = (x - mean) / scale
    s = np.clip(z @ w, -REACH, REACH)
    weight = np.where(good == 1, np.interp(s, *spread[1]), np.interp(s, *spread[0]))
    out += (z * weight[:, None]).T @ z


def _keys(s: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of these doubles."""
    bits = (s + 0.0).view(np.int64)
    return np.where(bits < 0, bits ^ np.int64(2 ** 63 - 1), bits)


def _double(key: int) -> float:
    return float(np.array([key if key >= 0 else key ^ (2 ** 63 - 1)], np.int64).view(float)[0])


def _reached(counts: list, weights: tuple[int, int], before: int, target: int) -> tuple[int, int]:
    """The first of the rows (value, bad, good) of ``counts`` with which the weights reach the target, and the weight before it."""
    for i, (_, bad, good) in enumerate(counts):
        own = bad * weights[0] + good * weights[1]
        if before + own >= target or i == len(counts) - 1:
            return i, before
        before += own
    raise ValueError("no rows")


class _Held:
    """Training rows in memory."""

    def __init__(self, x: np.ndarray, good: np.ndarray):
        self.x, self.good = np.asarray(x, float), np.asarray(good).astype(np.int64)

    def total(self, add: Callable, places: int, columns: int) -> np.ndarray:
        out = np.zeros((places, columns))
        add(self.x, self.good, out)
        return out

    def ordered(self, w: np.ndarray):
        keys = _keys(_raw(self.x, w))

        def counts(shift: int, prefix: int | None) -> list:
            own = keys if prefix is None else keys[keys >> (shift + 16) == prefix]
            good = self.good if prefix is None else self.good[keys >> (shift + 16) == prefix]
            values, code = np.unique(own >> shift, return_inverse=True)
            n, up = np.bincount(code), np.bincount(code, good)
            return [(int(v), int(a - b), int(b)) for v, a, b in zip(values, n, up)]

        return counts, lambda key: min((int(k) for k in keys[keys > key]), default=key)


class _Table:
    """Training rows (good, x) as a table; only sums leave the tasks."""

    def __init__(self, rows: DataFrame):
        self.rows = rows

    def total(self, add: Callable, places: int, columns: int) -> np.ndarray:
        def run(batches):
            out = np.zeros((places, columns))
            for batch in batches:
                if batch.num_rows:
                    add(_matrix(batch.column(1).to_pylist()), batch.column(0).to_numpy(zero_copy_only=False), out)
            used = np.flatnonzero(out.any(axis=1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(used, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(used) + 1) * columns, pa.int32()), pa.array(out[used].ravel()))],
                names=["place", "v"])

        sums = (self.rows.select("good", "x").mapInArrow(run, "place long, v array<double>").groupBy("place")
                .agg(F.array(*[F.sum(F.col("v")[i]) for i in range(columns)]).alias("v")))
        out = np.zeros((places, columns))
        for r in sums.collect():
            out[r["place"]] = r["v"]
        return out

    def ordered(self, w: np.ndarray):
        def run(cols):
            return {"good": cols["good"], "key": pa.array(_keys(_raw(_matrix(cols["x"]), w)), pa.int64())}

        keys = materialise(map_rows(self.rows.select("good", "x"), run, "good long, key long"), "keys")

        def counts(shift: int, prefix: int | None) -> list:
            own = keys if prefix is None else keys.filter(F.shiftright("key", shift + 16) == prefix)
            rows = own.groupBy(F.shiftright("key", shift).alias("p")).agg(
                F.sum(1 - F.col("good")).alias("bad"), F.sum("good").alias("good")).collect()  # at most 2 ** 16
            return sorted((r["p"], r["bad"], r["good"]) for r in rows)

        def after(key: int) -> int:
            least = keys.filter(F.col("key") > key).agg(F.min("key")).first()[0]
            return key if least is None else least

        return counts, after


def _threshold(ordered, n: tuple[int, int], share: Fraction) -> float:
    """Between the scores up to which the rows weigh ``share`` and those after; bad rows weigh ``share`` in all, good ones
    the rest.  The score is found by 16 bits of its number at a time, from counts of all rows."""
    counts, after = ordered
    weights = (share.numerator * n[1], (share.denominator - share.numerator) * n[0])
    target, before, prefix = share.numerator * n[0] * n[1], 0, None
    for shift in (48, 32, 16, 0):
        rows = counts(shift, prefix)
        i, before = _reached(rows, weights, before, target)
        prefix, bad, good = rows[i]
    last = weights[1] if good else weights[0]
    # with equal scores on both sides that score itself
    high = prefix if before + bad * weights[0] + good * weights[1] - last >= target and bad + good > 1 else after(prefix)
    return (_double(prefix) + _double(high)) / 2


def _fitted(rows, columns: int, share: Fraction, cut: float) -> Ranker:
    """Newton's method on the loss over all pairs of a good and a bad row."""
    sums = rows.total(_add_rows, 2, 1 + columns)
    n = (int(sums[0, 0]), int(sums[1, 0]))
    if not n[0] or not n[1]:
        return Ranker(np.zeros(columns), 0.0, cut)
    mean = sums[:, 1:].sum(axis=0) / sum(n)
    scale = np.sqrt(rows.total(lambda x, good, out: _add_squares(x, good, out, mean), 1, columns)[0] / sum(n))
    scale = np.array([float(f"{v:.9g}") if v >= 1e-9 else 1.0 for v in scale])
    w, pairs = np.zeros(columns), float(n[0]) * n[1]
    for _ in range(25):
        grid = rows.total(lambda x, good, out: _add_places(x, good, out, mean, scale, w), 2 * len(_PLACES), 1 + columns)
        used = [np.flatnonzero(grid[k::2, 0]) for k in (0, 1)]
        down, up = (grid[k::2][used[k]] for k in (0, 1))
        # probability of the wrong order of a good place (rows) and a bad one (columns)
        p = 1 / (1 + np.exp(np.clip(_PLACES[used[1]][:, None] - _PLACES[used[0]], -30, 30)))
        slope = ((p @ down[:, 0]) @ up[:, 1:] - (p.T @ up[:, 0]) @ down[:, 1:]) / pairs - RIDGE * w
        p *= 1 - p
        spread = [(_PLACES[used[0]], p.T @ up[:, 0] / pairs), (_PLACES[used[1]], p @ down[:, 0] / pairs)]
        both = up[:, 1:].T @ p @ down[:, 1:] / pairs
        bend = rows.total(lambda x, good, out: _add_products(x, good, out, mean, scale, w, spread), columns, columns)
        step = np.linalg.solve(bend - both - both.T + RIDGE * np.eye(columns), slope)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    # sums of doubles depend on their order in the last digits, so these go
    w = np.round(w, 6) / scale
    return Ranker(w, _threshold(rows.ordered(w), n, share), cut)


def fit(x: np.ndarray, good: np.ndarray, bad_share: float, cut: float, pairs: int | None = None) -> Ranker:
    """The ranker of rows in memory.  ``bad_share``: that quantile of the scores of good and bad rows,
    in that proportion, is the threshold.  All pairs count; ``pairs``, once the size of a sample, is ignored."""
    return _fitted(_Held(x, good), x.shape[1], Fraction(float(bad_share)).limit_denominator(10 ** 6), cut)


def _matrix(vectors: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), "<f8").reshape(-1, len(FEATURES))


def vectors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, x) of every row: its :data:`FEATURES` as doubles of 8 bytes."""
    def run(cols):
        return {"doc_id": cols["doc_id"], "x": [np.array(features(t), "<f8").tobytes() for t in cols["text"]]}

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_rows(slim, run, "doc_id long, x binary")


def learn_vectors(x: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 5, cut: float = 0.3) -> Ranker:
    """:func:`learn` from (doc_id, x)."""
    marked = (labels.select(F.col("doc_id").alias("doc_id"), F.col(label).cast("int").alias("label"))
              .filter("label is not null and doc_id is not null").filter(~held_out("doc_id", folds)).distinct())
    n = marked.agg(F.count(F.lit(1)).alias("all"), F.count_if(F.col("label") == 0).alias("bad")).first()
    rows = x.filter(~held_out("doc_id", folds)).join(marked, "doc_id").sortWithinPartitions("doc_id", "label", "x")
    rows = materialise(rows.select((F.col("label") == 1).cast("long").alias("good"), "x"), "training")
    return _fitted(_Table(rows), len(FEATURES), Fraction(n["bad"], max(1, n["all"])), cut)


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 5, cut: float = 0.3,
          id_col: str = "doc_id", text_col: str = "text") -> Ranker:
    """A ranker from the labels of all documents whose id's CRC-32 isn't 0 modulo ``folds``."""
    return learn_vectors(vectors(docs.filter(~held_out(id_col, folds)), id_col, text_col), labels, label, folds, cut)


def score_vectors(x: DataFrame, ranker: Ranker) -> DataFrame:
    """:func:`score` of (doc_id, x)."""
    def run(cols):
        return {"doc_id": cols["doc_id"], "score": ranker.scores(_matrix(cols["x"])).tolist()}

    return map_rows(x.select("doc_id", "x"), run, "doc_id long, score double")


def score(docs: DataFrame, ranker: Ranker, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row."""
    return score_vectors(vectors(docs, id_col, text_col), ranker)


def keep(docs: DataFrame, ranker: Ranker, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that score below the threshold; a narrow filter, nothing is joined."""
    @F.pandas_udf("boolean")
    def good(texts):
        import pandas as pd
        x = np.array([features(t.encode() if t is not None else None) for t in texts], float)
        return pd.Series(ranker.scores(x.reshape(-1, len(FEATURES))) >= ranker.cut)

    return docs.filter(good(F.col(text_col).cast("string")))
