"""Packing documents into sequences of bounded length, large items first.

A document is its token ids and an end id; a longer one is cut into pieces of
a whole sequence.  Pieces above a third of the capacity go at most two to a
sequence: the longest left is matched with the longest partner that fits.
The smaller ones then go, longest first, each into the tightest gap that takes
it, and open sequences only when no gap does.

What goes where depends on lengths alone, and there are no more lengths than
``capacity``.  So Spark counts the pieces of each length, the plan is made over
that histogram in runs ("the next 17 of length 300 into sequences 40 to 56"),
and the pieces, numbered within their length, look their place up by a
join on (length, number).  The driver sees only the histogram and the plan, whose
size follows the number of lengths, not of documents.

Defined results: a null or empty text is its end id alone; repeated rows are
packed one by one; no rows give no sequences.
"""

from __future__ import annotations

import bisect
import zlib
from collections import deque

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, materialise, number_within
from .tokenise import word_ids

#: rows of a plan are cut to this many pieces, so that no task unrolls a long run
RUN = 100_000
#: words whose ids a worker remembers; it writes no files, so there is room for more than by default
CACHE = 400_000


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32), a row per piece of each document."""
    end = end_id.to_bytes(4, "little")

    def run(cols):
        out: dict = {n: [] for n in ("doc_id", "piece", "start", "length", "ids_crc32")}
        for i, ids in zip(cols["doc_id"], word_ids(tokenizer, cache=CACHE).encode(cols["text"])):
            ids += end
            for k, at in enumerate(range(0, len(ids) // 4, capacity)):
                part = ids[at * 4:(at + capacity) * 4]
                for n, v in zip(out, (i, k, at, len(part) // 4, zlib.crc32(part))):
                    out[n].append(v)
        return out

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_rows(slim, run, "doc_id long, piece int, start long, length long, ids_crc32 long")


class _Gaps:
    """Sequences with room left: for each gap, runs (first sequence, how many)."""

    def __init__(self):
        self.sizes: list[int] = []
        self.runs: dict[int, deque] = {}

    def add(self, gap: int, first: int, n: int) -> None:
        if gap > 0 and n > 0:
            if gap not in self.runs:
                bisect.insort(self.sizes, gap)
                self.runs[gap] = deque()
            self.runs[gap].append((first, n))

    def tightest(self, length: int) -> int | None:
        at = bisect.bisect_left(self.sizes, length)
        return self.sizes[at] if at < len(self.sizes) else None

    def take(self, gap: int, most: int) -> tuple[int, int]:
        first, n = self.runs[gap].popleft()
        if n > most:
            self.runs[gap].appendleft((first + most, n - most))
            n = most
        if not self.runs[gap]:
            del self.runs[gap]
            self.sizes.pop(bisect.bisect_left(self.sizes, gap))
        return first, n


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first number, how many, first sequence, offset): pieces
    ``first number`` and on of that length go to successive sequences, at that offset."""
    if any(not 0 < n <= capacity for n in counts):
        raise ValueError("lengths must be between 1 and the capacity")
    left = {n: c for n, c in counts.items() if c > 0}
    used = dict.fromkeys(left, 0)
    out: list = []
    gaps, sequences = _Gaps(), 0

    def put(length, n, first, offset):
        out.append((length, used[length], n, first, offset))
        used[length] += n
        left[length] -= n

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        a = large[-1]
        c = left[a]
        at = bisect.bisect_right(large, capacity - a) - 1
        if at >= 0 and large[at] == a and c == 1:
            at -= 1  # it can't be its own partner
        if at < 0:
            put(a, c, sequences, 0)
            gaps.add(capacity - a, sequences, c)
            n = c
        else:
            b = large[at]
            n = c // 2 if b == a else min(c, left[b])
            put(a, n, sequences, 0)
            put(b, n, sequences, a)
            gaps.add(capacity - a - b, sequences, n)
            if b != a and not left[b]:
                large.pop(at)
        sequences += n
        if not left[a]:
            large.pop(bisect.bisect_left(large, a))
    for a in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[a] and (gap := gaps.tightest(a)) is not None:
            first, n = gaps.take(gap, left[a])
            put(a, n, first, capacity - gap)
            gaps.add(gap - a, first, n)
        per = capacity // a
        full, rest = divmod(left[a], per)
        for k in range(per if full else 0):
            put(a, full, sequences, k * a)
        gaps.add(capacity - per * a, sequences, full)
        sequences += full
        for k in range(rest):
            put(a, 1, sequences, k * a)
        if rest:
            gaps.add(capacity - rest * a, sequences, 1)
            sequences += 1
    return out


def pack(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """:func:`pieces` with sequence_id and offset."""
    spark = docs.sparkSession
    cut = materialise(pieces(docs, tokenizer, capacity, end_id, id_col, text_col), "pieces")
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = [(a, number + k, min(RUN, n - k), first + k, offset)
            for a, number, n, first, offset in plan(counts, capacity) for k in range(0, n, RUN)]
    planned = spark.createDataFrame(runs, "length long, number long, n long, first long, offset long")
    step = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1))
    places = (planned.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "length", "number").withColumn("k", step)
              .select("length", (F.col("number") + F.col("k")).alias("number"),
                      (F.col("first") + F.col("k")).alias("sequence_id"), "offset"))
    numbered = number_within(cut, ["length"], ["doc_id", "piece", "start", "ids_crc32"], "number")
    return numbered.join(places, ["length", "number"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
