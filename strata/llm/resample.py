"""Target-distribution importance resampling over hashed n-grams.

Features of a text are its runs of ``low`` to ``high`` consecutive words; a
feature's bucket is its CRC-32 modulo ``buckets``.  Counting the buckets of the
documents and of a target corpus gives every bucket a gain, how much likelier the
target is to hold it; a document's weight is the mean gain of its features.  Gumbel noise
keyed by the id turns the top of weight + noise into a sample without
replacement in proportion to exp(weight).

Both passes intern the n-grams of a batch in a :class:`Table`: open addressing
in NumPy arrays, keyed by xxhash64, every meeting verified by bytes.  A slot
holds the n-gram's bucket and count, so a bucket is computed once per different
n-gram, and slot ids of the occurrences gather counts (first pass) or gains (second).
A batch is about :data:`BLOCK` bytes of text; longer texts take several.

Ranks: scores are whole numbers, so a histogram of them tells at which score
the draw ends and at which rank each score starts; documents are ordered only within
a score.

Defined results: null text has no words; without features the weight is 0; a
null id draws the noise of an empty id and ranks behind others of its score;
rows alike in everything get ranks next to each other; empty tables: no rows,
or gains from the smoothing alone.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD_BYTES, bounded_broadcast, materialise, slices, unrolled

BUCKETS = 10_000
BLOCK = 1 << 20
#: rows of the histogram of scores (two numbers each) that may be broadcast
BROADCAST_ROWS = 1_000_000
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], "<u8")


class Table:
    """Open-addressed table of the different strings in ``grams``.

    ``slots[i]`` is the slot of ``grams[i]``; ``owner[s]`` an occurrence that
    slot ``s`` holds, or -1; ``bucket[s]`` and ``count[s]`` belong to it.
    """

    def __init__(self, grams: Sequence[bytes], buckets: int):
        n = len(grams)
        size = 1 << max(4, (2 * n - 1).bit_length())  # at most half full
        self.owner = np.full(size, -1, np.int64)
        keys = np.zeros(size, np.uint64)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams), np.uint64, n)
        lengths = np.fromiter(map(len, grams), np.int64, n)
        starts = np.cumsum(lengths) - lengths
        flat = b"".join(grams) + bytes(8)
        eight = np.ndarray(len(flat) - 7, "<u8", flat, strides=(1,))  # the 8 bytes from every place on

        def same(a, b):  # whether occurrences a and b are equal byte by byte
            ok = lengths[a] == lengths[b]
            left, at = np.flatnonzero(ok), 0
            while left.size:
                x, y = a[left], b[left]
                rest = np.minimum(lengths[x] - at, 8)
                equal = (eight[starts[x] + at] ^ eight[starts[y] + at]) & _MASKS[rest] == 0
                ok[left] = equal
                at += 8
                left = left[equal & (lengths[x] > at)]
            return ok

        self.slots = (hashes & np.uint64(size - 1)).astype(np.int64)
        todo = np.arange(n)
        while todo.size:
            at = self.slots[todo]
            free = at[self.owner[at] < 0]
            # of those that meet at a free slot one takes it; equal strings always meet
            self.owner[free] = todo[self.owner[at] < 0]
            keys[free] = hashes[self.owner[free]]
            fits = keys[at] == hashes[todo]
            fits[fits] = same(todo[fits], self.owner[at[fits]])
            todo = todo[~fits]
            self.slots[todo] = (self.slots[todo] + 1) & (size - 1)
        self.count = np.bincount(self.slots, minlength=size)
        self.bucket = np.zeros(size, np.int64)
        self.used = np.flatnonzero(self.owner >= 0)
        self.bucket[self.used] = [zlib.crc32(grams[i]) % buckets for i in self.owner[self.used].tolist()]

    def by_bucket(self, buckets: int) -> np.ndarray:
        totals = np.zeros(buckets, np.int64)
        np.add.at(totals, self.bucket[self.used], self.count[self.used])
        return totals

    def gather(self, gains: np.ndarray) -> np.ndarray:
        """The gain of each occurrence."""
        each = np.zeros(len(self.owner), np.int64)
        each[self.used] = gains[self.bucket[self.used]]
        return each[self.slots]


def _words(text: bytes | None) -> Iterator[list[bytes]]:
    """Words of a text, in blocks cut between words."""
    at, size = 0, len(text or b"")
    while at < size:
        flat = text[at:at + BLOCK].translate(WORD_BYTES)
        at += len(flat)
        while at < size and flat[-1:] != b" ":
            step = text[at:at + 4096].translate(WORD_BYTES)
            step = step[:step.find(b" ") + 1] or step
            flat += step
            at += len(step)
        yield flat.split()


def grams(text: bytes | None, low: int, high: int) -> Iterator[tuple[int, list[bytes]]]:
    """(words, features) of a text, block by block; features across blocks are in the later one."""
    kept: list[bytes] = []
    for words in _words(text):
        every, old = kept + words, len(kept)
        out = []
        for k in range(low, high + 1):
            first = max(0, old - k + 1)
            out += every[first:] if k == 1 else [b" ".join(every[i:i + k]) for i in range(first, len(every) - k + 1)]
        yield len(words), out
        kept = every[-(high - 1):] if high > 1 else []


def _batches(texts: Sequence[bytes | None], low: int, high: int) -> Iterator[tuple[list[bytes], list[tuple[int, int, int]]]]:
    """(features, [(text, words, features)]) of about :data:`BLOCK` bytes each; a text may go over several."""
    held, parts, size = [], [], 0
    for i, text in enumerate(texts):
        for n, found in grams(text, low, high):
            held += found
            parts.append((i, n, len(found)))
            size += sum(map(len, found))
            if size >= BLOCK:
                yield held, parts
                held, parts, size = [], [], 0
    if parts:
        yield held, parts


def bucket_counts(docs: DataFrame, low: int = 1, high: int = 1, buckets: int = BUCKETS, text_col: str = "text") -> np.ndarray:
    """Occurrences of each bucket in all texts: ``buckets`` numbers, whatever the input."""
    def run(batches):
        totals = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch):
                for found, _ in _batches(part.column(0).cast(pa.binary()).to_pylist(), low, high):
                    totals += Table(found, buckets).by_bucket(buckets)
        some = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(totals[some], pa.int64())], names=["bucket", "n"])

    found = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for r in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of the two distributions, each with one more in every bucket."""
    m, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log(float((int(t) + 1) * (s_all + m)) / float((int(s) + 1) * (t_all + m))))
                     for s, t in zip(source, target)], np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """Thousandths of a Gumbel variate that depends on the seed and the id alone."""
    key = f"{seed}:{'' if doc_id is None else doc_id}"
    h = int(hashlib.sha256(key.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(docs: DataFrame, gain: np.ndarray, seed: int, low: int = 1, high: int = 1, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every row."""
    schema = pa.schema([(n, pa.int64()) for n in ("doc_id", "n_words", "n_features", "weight", "score")])
    shared = docs.sparkSession.sparkContext.broadcast(gain)  # one number for each bucket

    def run(batches):
        own = shared.value
        for batch in batches:
            for part in slices(batch):
                ids = part.column(0).to_pylist()
                n_words, n_grams, total = [0] * len(ids), [0] * len(ids), [0] * len(ids)
                for found, parts in _batches(part.column(1).cast(pa.binary()).to_pylist(), low, high):
                    sums = np.concatenate([[0], np.cumsum(Table(found, len(own)).gather(own))])
                    at = 0
                    for i, n, k in parts:
                        n_words[i] += n
                        n_grams[i] += k
                        total[i] += int(sums[at + k] - sums[at])
                        at += k
                weight = [t // n if n else 0 for t, n in zip(total, n_grams)]
                score = [w + noise(i, seed) for w, i in zip(weight, ids)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (ids, n_words, n_grams, weight, score)], schema=schema)

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long, score long")


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, seed: int = 2024, low: int = 1,
             high: int = 1, buckets: int = BUCKETS, id_col: str = "doc_id", text_col: str = "text",
             target_text_col: str = "text") -> DataFrame:
    """doc_id, n_features, weight, score, rank of every row: ``percent`` of the documents of at least
    ``least_words`` words are drawn and ranked 1, 2, 3, ... by score, ties to the smaller id."""
    if not 1 <= low <= high or not 0 <= percent <= 100 or buckets < 1:
        raise ValueError("low is between 1 and high, percent between 0 and 100, buckets at least 1")
    gain = gains(bucket_counts(docs, low, high, buckets, text_col), bucket_counts(target, low, high, buckets, target_text_col))
    scored = materialise(weigh(docs, gain, seed, low, high, id_col, text_col), "weighed")
    eligible = scored.filter(F.col("n_words") >= least_words)
    # a row for each score: gains and noise are bounded, so there are some ten thousand
    met = eligible.groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    ahead = W.orderBy(F.desc("score")).rowsBetween(W.unboundedPreceding, -1)
    starts = met.select("score", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("start"), F.sum("n").over(W.partitionBy()).alias("all"))
    drawn = starts.withColumn("draw", F.expr(f"(all * {int(percent)}) div 100")).filter("start < draw").drop("all")
    drawn = bounded_broadcast(materialise(drawn, "drawn-scores"), BROADCAST_ROWS)
    near = eligible.join(drawn, "score").groupBy("score", "start", "draw", "doc_id", "n_words", "n_features", "weight").agg(
        F.count(F.lit(1)).alias("n"))
    order = W.partitionBy("score").orderBy(F.asc_nulls_last("doc_id"), "n_words", "n_features", "weight").rowsBetween(W.unboundedPreceding, -1)
    placed = materialise(near.withColumn("before", F.coalesce(F.sum("n").over(order), F.lit(0))), "placed-scores")
    rank = F.col("start") + F.col("before") + F.col("k") + 1
    columns = ["doc_id", "n_features", "weight", "score"]
    ranked = unrolled(placed, "n").select(*columns, F.when(rank <= F.col("draw"), rank).alias("rank"))
    rest = scored.join(drawn.select("score", "start"), "score", "left").filter(
        F.col("start").isNull() | (F.col("n_words") < least_words))
    return ranked.unionByName(rest.select(*columns, F.lit(None).cast("long").alias("rank")))
