"""Toxicity by a subsequence string-kernel SVM with Nystroem landmarks.

The kernel compares two short strings by the three-character subsequences they
share, contiguous or not: a subsequence that spans ``s`` characters weighs
``DECAY ** s``, up to ``SPAN``.  So an insult with inserted, dropped or appended
characters stays close to the plain one.  Strings are the words of a sentence
with a boundary mark at either end; runs of single characters ("i d i o t")
are joined first, and long words are cut into overlapping windows, all of which
are trained on and scored.

Training (on labelled sentences, by multiple-instance rounds): a sentence has the
label of its document.  Words that toxic documents hold far more often than chance allows
are positive; after each round, so is the worst word of a toxic document
without any of them, and the clean words that score too high join the
negatives.  The kernel's feature space is projected on landmark words (the most
telling ones, common and too high-scoring clean ones), in which a linear SVM with squared hinge loss is fitted by Newton's method.

Because the kernel counts explicit subsequences, landmarks, their whitening and
the SVM weights collapse into one weight per subsequence.  Scoring a word is
then a few table look-ups, done once per distinct word of a worker; a document's
margin is that of its worst word, mapped to 0..1 by a logistic fit.

The fit uses at most ``MAX_ROWS`` training documents of each label; scoring
reads every word of every text.

Defined results: a text without words scores as the mildest word could; without
training rows of both labels every score is 0.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ASCII_LOWER, held_out, map_rows

SPAN, DECAY, WIDTH = 6, 0.5, 24
MAX_ROWS, LANDMARKS, NEGATIVES, ROUNDS, RIDGE = 4000, 400, 8000, 4, 1e-2
CACHE = 1_000_000
#: gaps (d1, d2) between the three places of a subsequence
_STEPS = [(a, b) for a in range(1, SPAN) for b in range(1, SPAN) if a + b < SPAN]
_WEIGHT = np.array([DECAY ** (a + b + 1) for a, b in _STEPS])
_SHORT = 2 * float((_WEIGHT ** 2).sum())

# 64 symbols: 0 padding, 1-26 letters, 27 boundary, 28-37 digits, 38 other marks, the rest high bytes
_SYMBOL = np.full(256, 38, np.int32)
for _c in range(128):
    if 97 <= _c <= 122:
        _SYMBOL[_c] = _c - 96
    elif 48 <= _c <= 57:
        _SYMBOL[_c] = 28 + _c - 48
for _c in range(128, 256):
    _SYMBOL[_c] = 39 + _c % 25
_SYMBOL[0] = 0
_EDGE = 27
_STRIP = b".,;:!?\"'()[]{}<>*#$%&|-_/\\~`^+="

_cache: dict = {}


def units(text: bytes | None) -> set[bytes]:
    """The distinct strings of a text that are scored; every character lies in one."""
    words = (text or b"").translate(ASCII_LOWER).split()
    met = {w.strip(_STRIP) or w for w in set(words)}
    if any(len(w) == 1 for w in met):  # spaced-out words
        run: list[bytes] = []
        for w in (*words, b"  "):
            w = (w.strip(_STRIP) or w) if len(w) == 2 else w
            if len(w) == 1:
                run.append(w)
            else:
                if len(run) > 2:
                    met.add(b"".join(run))
                run = []
    return met


def _cut(word: bytes) -> list[bytes]:
    """The overlapping windows of a word, itself if it is short."""
    return [word[at:at + WIDTH] for at in range(0, max(1, len(word) - WIDTH // 2), WIDTH // 2)]


def _windows(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Symbol codes, a row of ``WIDTH + 2`` per window of a word, and each row's word."""
    rows, owner = [], []
    for i, w in enumerate(words):
        for part in _cut(w):
            rows.append(part)
            owner.append(i)
    lengths = np.fromiter(map(len, rows), np.int64, len(rows))
    codes = np.zeros((len(rows), WIDTH + 2), np.int32)
    flat = _SYMBOL[np.frombuffer(b"".join(rows), np.uint8)]
    inside = np.arange(WIDTH)[None, :] < lengths[:, None]
    codes[:, 1:-1][inside] = flat
    codes[:, 0] = _EDGE
    codes[np.arange(len(rows)), lengths + 1] = _EDGE
    return codes, np.array(owner, np.int64)


def _triples(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Subsequence codes (0 where a place is padding) with their weights, scaled so that
    a long row's weights have unit length and a row of a few characters less."""
    cols, weights = [], []
    for (a, b), w in zip(_STEPS, _WEIGHT):
        n = codes.shape[1] - a - b
        x, y, z = codes[:, :n], codes[:, a:a + n], codes[:, a + b:a + b + n]
        cols.append(np.where((x > 0) & (y > 0) & (z > 0), (x << 12) | (y << 6) | z, 0))
        weights.append(np.full(n, w))
    t, w = np.concatenate(cols, axis=1), np.concatenate(weights)
    scaled = (t > 0) * w
    return t, scaled / np.sqrt((scaled ** 2).sum(axis=1, keepdims=True) + _SHORT)


@dataclass
class Model:
    """``weights`` per subsequence code; score = logistic(slope * margin + shift)."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float
    name: int

    def margins(self, words: list[bytes]) -> np.ndarray:
        """The SVM's decision for each word, of a long one that of its worst window."""
        out = np.full(len(words), -np.inf)
        for at in range(0, len(words), 1024):
            codes, owner = _windows(words[at:at + 1024])
            t, w = _triples(codes)
            np.maximum.at(out[at:at + 1024], owner, (self.weights[t] * w).sum(axis=1) + self.bias)
        return out

    def scores(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.shift, -30, 30)))


def _newton_svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """Linear SVM with squared hinge loss; the last column of ``x`` is 1, and its weight, the bias, isn't shrunk much."""
    ridge = RIDGE * np.eye(x.shape[1])
    ridge[-1, -1] *= 1e-3
    w, kept = np.zeros(x.shape[1]), None
    for _ in range(30):
        on = np.concatenate([y[at:at + 1024] * (x[at:at + 1024].astype(float) @ w) < 1 for at in range(0, len(x), 1024)])
        if kept is not None and (on == kept).all():
            break
        kept = on
        inside, left, right = np.flatnonzero(on), ridge.copy(), np.zeros(x.shape[1])
        for at in range(0, len(inside), 1024):  # a copy of a few rows at a time
            k = inside[at:at + 1024]
            rows = x[k].astype(float)
            weighed = rows * weight[k, None]
            left += weighed.T @ rows
            right += weighed.T @ y[k]
        w = np.linalg.solve(left, right)
    return w[:-1], float(w[-1])


def _logistic(m: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of P(toxic | margin); targets are smoothed so that separable data stay finite."""
    target = np.where(y, (y.sum() + 1) / (y.sum() + 2), 1 / ((~y).sum() + 2))
    x = np.stack([m, np.ones_like(m)], axis=1)
    w = np.array([1.0, 0.0])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (target - p))
        step *= min(1.0, 5 / max(1e-9, np.abs(step).max()))
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return max(1e-3, float(w[0])), float(w[1])


def _independent(docs: list[np.ndarray], crc: np.ndarray, bands: int = 6, rows: int = 4) -> list[int]:
    """One of each group of near copies: documents that meet in a band of ``rows``
    smallest hashes and have over half of their strings in common."""
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    factor = np.random.default_rng(3).integers(1, 1 << 62, bands * rows).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    first: dict = {}
    for i, d in enumerate(docs):
        h = crc[d] + np.uint64(1) if len(d) else np.zeros(1, np.uint64)
        low = np.array([(h * f >> np.uint64(16)).min() for f in factor], np.uint64).reshape(bands, rows)
        for k in range(bands):
            other = first.setdefault((k, low[k].tobytes()), i)
            both = len(np.intersect1d(d, docs[other], assume_unique=True))
            if 2 * both > len(d) + len(docs[other]) - both:
                a, b = root(i), root(other)
                parent[max(a, b)] = min(a, b)
    return [i for i in range(len(docs)) if root(i) == i]


def _numbered(docs: Iterable[Iterable[bytes]]) -> tuple[list[bytes], list[np.ndarray]]:
    """The distinct windows of all documents in order, and each document's, as sorted places in that list."""
    met: dict[bytes, int] = {}
    held = [np.array(list({met.setdefault(p, len(met)) for w in d for p in _cut(w)}), np.int32) for d in docs]
    strings = sorted(met)
    place = np.zeros(len(strings), np.int32)
    place[np.fromiter((met[w] for w in strings), np.int64, len(strings))] = np.arange(len(strings))
    return strings, [np.sort(place[d]) for d in held]


class _Nystroem:
    """Coordinates of windows in the span of some landmark windows."""

    def __init__(self, landmarks: list[bytes]):
        codes, owner = _windows(landmarks)
        t, w = _triples(codes)
        self.known = np.unique(t[t > 0])
        self.column = np.zeros(1 << 18, np.int32)
        self.column[self.known] = np.arange(1, len(self.known) + 1)
        rows, cols, w = np.repeat(owner, t.shape[1]), self.column[t].ravel(), w.ravel()
        order = np.argsort(cols, kind="stable")
        rows, cols, w = rows[order], cols[order], w[order]

        def blocks(size=2048):  # the dense table of subsequences by landmarks, some columns at a time; column 0 is padding
            for low in range(1, len(self.known) + 1, size):
                high = min(low + size, len(self.known) + 1)
                a, b = np.searchsorted(cols, [low, high])
                phi = np.zeros((len(landmarks), high - low))
                np.add.at(phi, (rows[a:b], cols[a:b] - low), w[a:b])
                yield low, high, phi

        gram = np.zeros((len(landmarks), len(landmarks)))
        for _, _, phi in blocks():
            gram += phi @ phi.T
        values, vectors = np.linalg.eigh(gram)
        keep = values > 1e-5 * values.max()
        whiten = vectors[:, keep] / np.sqrt(values[keep])
        self.project = np.zeros((len(self.known) + 1, int(keep.sum())), np.float32)
        for low, high, phi in blocks():
            self.project[low:high] = phi.T @ whiten

    def embed(self, windows: list[bytes]) -> np.ndarray:
        """A row per window, its last column 1."""
        out = np.ones((len(windows), self.project.shape[1] + 1), np.float32)
        for at in range(0, len(windows), 32):
            codes, _ = _windows(windows[at:at + 32])
            t, w = _triples(codes)
            out[at:at + 32, :-1] = np.einsum("wt,wtd->wd", w.astype(np.float32), self.project[self.column[t]])
        return out

    def collapse(self, u: np.ndarray) -> np.ndarray:
        """Weights per subsequence that score like ``u`` on the coordinates."""
        weights = np.zeros(1 << 18, np.float32)
        weights[self.known] = (self.project @ u)[1:]
        return weights


def fit(docs: Iterable[Iterable[bytes]], toxic: np.ndarray) -> Model:
    """``docs``: the distinct words of each training document.  Near copies count once."""
    strings, docs = _numbered(docs)
    chosen = _independent(docs, np.array([zlib.crc32(w) for w in strings], np.uint64))
    docs, toxic = [docs[i] for i in chosen], toxic[chosen]
    if toxic.all() or not toxic.any():
        return Model(np.zeros(1 << 18), 0.0, 1.0, -30.0, 0)
    bad, good = (np.bincount(np.concatenate([d for d, t in zip(docs, toxic) if t == which]), minlength=len(strings))
                 for which in (True, False))
    n_bad, n_good = int(toxic.sum()), int((~toxic).sum())
    # strings of so many documents, to tell one that only toxic documents hold from chance
    alike = np.bincount(bad + good)
    chance = math.log((n_bad + n_good) / n_bad)
    # log odds against meeting such a string by chance
    telling_by = bad * chance - np.log(20 * np.maximum(1, alike[bad + good]))
    rarely = good * n_bad <= 0.02 * bad * n_good

    def ranked_by(among, value):  # places with the largest value first, equal ones in order
        at = np.flatnonzero(among)
        return at[np.argsort(-value[at], kind="stable")].tolist()

    ranked = ranked_by((bad > 0) & rarely, telling_by)
    telling = [k for k in ranked if telling_by[k] > 0][:LANDMARKS] or ranked[:8]
    if not telling:
        return Model(np.zeros(1 << 18), 0.0, 1.0, -30.0, 0)
    clean = ranked_by(good > 0, good)
    negatives = list(dict.fromkeys([*clean[:LANDMARKS], *clean[::max(1, len(clean) // NEGATIVES)]]))
    positives, hard, known = telling, [], np.array(telling)
    for _ in range(ROUNDS):
        landmarks = dict.fromkeys([*telling, *hard[:LANDMARKS], *negatives[::max(1, len(negatives) * 4 // LANDMARKS)]])
        space = _Nystroem([strings[k] for k in landmarks])
        x = space.embed([strings[k] for k in (*positives, *negatives)])
        y = np.concatenate([np.ones(len(positives)), -np.ones(len(negatives))])
        even = np.concatenate([np.full(len(positives), 0.25 * len(y) / len(positives)), np.full(len(negatives), 0.75 * len(y) / len(negatives))])
        u, bias = _newton_svm(x, y, even)
        model = Model(space.collapse(u), bias, 1.0, 0.0, 0)
        del space, x
        margin = model.margins(strings)
        # of toxic documents without a telling string, the worst one, if it looks like the positives so far
        witness = {int(d[::-1][np.argmax(margin[d[::-1]])]) for d, t in zip(docs, toxic) if t and len(d) and not np.isin(d, known).any()}
        positives = [*telling, *sorted(k for k in witness if margin[k] > 0 and rarely[k])]
        # clean strings that score too high join the negatives and the landmarks
        taken = set(positives)
        worse = [k for k in ranked_by(good > 0, margin)[:NEGATIVES // 4] if k not in taken and not rarely[k]]
        negatives = list(dict.fromkeys([*negatives, *worse]))
        hard = list(dict.fromkeys([*worse[:LANDMARKS // 3], *hard]))
    worst = np.array([margin[d].max() if len(d) else -3.0 for d in docs])
    model.slope, model.shift = _logistic(worst, toxic)
    model.name = zlib.crc32(model.weights.tobytes() + str(model.bias).encode())
    return model


def training_rows(docs: DataFrame, labels: DataFrame, label: str, folds: int, max_rows: int,
                  id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, dict[int, int]]:
    """Labelled rows (doc_id, label, text) of documents that aren't held out, at most
    ``max_rows`` of each label by smallest hash of the id, and each label's count."""
    marked = (labels.select(F.col("doc_id").alias("doc_id"), F.col(label).cast("int").alias("label"))
              .filter("label is not null and doc_id is not null").filter(~held_out("doc_id", folds)).distinct())
    counts = {r["label"]: r["n"] for r in marked.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = None
    for value in sorted(counts):
        part = marked.filter(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
        chosen = part if chosen is None else chosen.unionByName(part)
    if chosen is None:
        chosen = marked
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # at most max_rows short rows of each label: bounded, so broadcast
    return texts.join(F.broadcast(chosen), "doc_id"), counts


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 5, max_rows: int = MAX_ROWS,
          id_col: str = "doc_id", text_col: str = "text") -> Model:
    """A model from the labels of documents whose id's CRC-32 isn't 0 modulo ``folds``."""
    rows, _ = training_rows(docs, labels, label, folds, max_rows, id_col, text_col)

    def run(cols):
        return {"doc_id": cols["doc_id"], "label": cols["label"],
                "words": [b" ".join(sorted(units(t))).decode("utf-8", "replace") for t in cols["text"]]}

    got = sorted((r["doc_id"], r["label"], r["words"])
                 for r in map_rows(rows, run, "doc_id long, label int, words string").collect())
    toxic = np.array([label == 1 for _, label, _ in got], bool)
    got.reverse()
    return fit((got.pop()[2].encode().split() for _ in range(len(got))), toxic)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed table of 2**18 weights

    def run(cols):
        model = shared.value
        known = _cache.setdefault(model.name, {})
        texts = [units(t) for t in cols["text"]]
        new = list(set().union(*texts) - known.keys()) if texts else []
        if len(known) + len(new) > CACHE:
            known.clear()
            new = list(set().union(*texts))
        known.update(zip(new, model.margins(new).tolist()))
        worst = np.array([max(map(known.__getitem__, u), default=-3.0) for u in texts])
        return {"doc_id": cols["doc_id"], "score": model.scores(worst).tolist()}

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_rows(slim, run, "doc_id long, score double")
