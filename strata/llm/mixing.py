"""Mixing sources to target weights by systematic sampling, in DataFrame functions only.

A source's target is its share, by weight, of the words of all documents, but
at most ``most`` times its own words; what lies above is shared out again among
the rest by weight, until none is above.  Sorted by how many words a unit of
weight brings, the sources that stop at their limit come first, so one running
sum over the sources finds the level ``x`` at which the targets ``min(limit, weight * x)``
make up the whole.

A document of a source is expected ``target / own words`` times.  Documents
stand in a row; each covers an interval as long as its expected copies, and one
random offset per source is added.  A document is emitted once for every whole
number in its interval: never more than its expectation rounded up, and the
copies of any stretch of the row differ from what is expected by less than one.
The row is sorted by size class, so small and large documents are each taken at
their share, and the words taken come near the target.

Expected copies are whole multiples of 1 / :data:`UNIT`, so that running sums are exact
whatever order Spark adds them in, and a rerun gives the same copies.  The
running sum has two levels: within (source, size class, part), and over those.
A source of any size is spread over its parts.

Defined results: null text has size 0; null is a source of its own, the last;
rows alike in id, source and text are one interval as long as all of them, then
dealt out again; no rows, or no words at all, take nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialise, text_of, unrolled

UNIT_BITS = 20
UNIT = 1 << UNIT_BITS
#: parts that a size class of a source is spread over
PARTS = 256
#: the targets are broadcast up to so many sources and bytes of their names, and joined by shuffle beyond
BROADCAST_ROWS, BROADCAST_BYTES = 100_000, 8 << 20
WORD = r"[^\x20\x09-\x0D]+"


def size_of(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float], most: float = 3.0) -> DataFrame:
    """``sizes`` (source, source_size: a row per source) with ``target``.

    Weights go round the sources in code point order, null last.  All sources
    pass through one task here: there is one short row for each."""
    if not weights or min(weights) <= 0 or most < 1:
        raise ValueError("weights must be positive and most at least 1")
    n = len(weights)
    nth = F.row_number().over(W.orderBy(F.asc_nulls_last("source")))
    ranked = sizes.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((nth - 1) % n + 1).cast("int")))
    limited = ranked.withColumn("limit", F.col("source_size") * F.lit(float(most)))
    order = W.orderBy(F.col("limit") / F.col("w"), F.asc_nulls_last("source"))
    before, every = order.rowsBetween(W.unboundedPreceding, -1), W.partitionBy()
    # x if this source and those behind it stay below their limits; the largest that holds is the level
    x = ((F.sum("source_size").over(every) - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
         / (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0))))
    tried = limited.withColumn("x", x)
    level = F.max(F.when(F.col("x") * F.col("w") <= F.col("limit"), F.col("x"))).over(every)
    return tried.withColumn("target", F.least("limit", level * F.col("w"))).select("source", "source_size", "target")


def running(rows: DataFrame, group: Sequence[str], classes: Sequence[str], part: str, order: Sequence[str],
            value: str, out: str = "before") -> DataFrame:
    """``rows`` with ``out``: the sum of ``value`` (long) over the rows of the group that come before,
    by ``classes``, ``part``, then ``order``.  A task holds one part of one class at a time."""
    keys = [*group, *classes, part]
    starts = rows.groupBy(*keys).agg(F.sum(value).alias("__sum")).withColumn("__start", F.coalesce(F.sum("__sum").over(
        W.partitionBy(*group).orderBy(*classes, part).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("__sum")
    own = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    local = rows.withColumn("__own", F.coalesce(F.sum(value).over(own), F.lit(0)))
    return local.join(starts, keys).withColumn(out, F.col("__own") + F.col("__start")).drop("__own", "__start")


def plan(docs: DataFrame, weights: Sequence[float], most: float = 3.0, seed: int = 1, id_col: str = "doc_id",
         text_col: str = "text", source_col: str = "source") -> DataFrame:
    """A row per row of ``docs``: doc_id, source, text_hash, size, source_size, target, copies."""
    slim = materialise(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        F.xxhash64(text_of(text_col)).alias("text_hash"), size_of(text_of(text_col)).alias("size")), "sized")
    sizes = materialise(targets(slim.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most), "targets")
    ratio = F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))
    # never above the expectation, so copies are never above it rounded up
    expected = sizes.select(F.col("source").alias("s"), "source_size", "target", F.floor(ratio * UNIT).cast("long").alias("unit"),
                            F.pmod(F.xxhash64(F.lit(seed), F.coalesce("source", F.lit("")), F.col("source").isNull()), F.lit(UNIT)).alias("offset"))
    met = sizes.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("source")), F.lit(0)).alias("b")).first()
    if met["n"] <= BROADCAST_ROWS and met["b"] <= BROADCAST_BYTES:
        expected = F.broadcast(expected)
    same = slim.groupBy("source", "doc_id", "text_hash", "size").agg(F.count(F.lit(1)).alias("n"))
    rows = same.join(expected, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    placed = rows.select("*", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("__g"),
                         F.floor(F.log2(F.col("size") + 1) * 2).cast("int").alias("__class"),
                         F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text_hash"), F.lit(PARTS)).cast("int").alias("__part"),
                         (F.col("n") * F.col("unit")).alias("__length"))
    ahead = running(placed, ["__g"], ["__class"], "__part", ["size", "text_hash", "doc_id"], "__length")
    each = unrolled(materialise(ahead.drop("__g", "__class", "__part", "__length"), "placed"), "n")
    start = F.col("before") + F.col("k") * F.col("unit") + F.col("offset")
    copies = F.shiftright(start + F.col("unit"), UNIT_BITS) - F.shiftright(start, UNIT_BITS)
    return each.select("doc_id", "source", "text_hash", "size", "source_size", "target", copies.alias("copies"))


def mix(docs: DataFrame, weights: Sequence[float], most: float = 3.0, seed: int = 1, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mixture itself: doc_id, source, text, a row for every copy (numbered in ``copy``, from 0).

    The documents are not grouped to be joined: rows alike in id, source and
    text share their copies, of which one such row takes all."""
    chosen = plan(docs, weights, most, seed, id_col, text_col, source_col).groupBy("doc_id", "source", "text_hash").agg(
        F.sum("copies").alias("n")).filter("n > 0")
    texts = docs.select(F.col(id_col).alias("__id"), F.col(source_col).cast("string").alias("__source"),
                        text_of(text_col).alias("text")).withColumn("__hash", F.xxhash64("text")).dropDuplicates(["__id", "__source", "__hash"])
    same = (F.col("doc_id").eqNullSafe(F.col("__id")) & F.col("source").eqNullSafe(F.col("__source"))
            & (F.col("text_hash") == F.col("__hash")))
    found = materialise(texts.join(chosen, same).select("doc_id", "source", "text", "n"), "chosen")
    return unrolled(found, "n", "copy").drop("n")
