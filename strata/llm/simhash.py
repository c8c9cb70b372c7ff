"""Near-duplicates by 64-bit SimHash, found through pivot distance tables.

A fingerprint bit is 1 if it is set in over half of the hashes of a text's
word shingles.  Two fingerprints link at ``radius`` differing bits or fewer;
linked fingerprints, and chains of them, form a component.

The search works on distinct fingerprints only, so copies cost nothing:

1. *Cells.*  The 64 bits are cut into ``BLOCKS`` blocks.  ``radius`` flips touch
   at most ``radius`` blocks, so a linked pair agrees on the others; a cell is
   a choice of ``BLOCKS - radius`` blocks with their values.  Every linked
   pair meets in some cell, whatever the data.
2. *Pivot tables.*  For the fingerprints of a cell, distances to ``PIVOTS``
   reference fingerprints are computed once.  By the triangle inequality a pair
   whose tables differ by more than ``radius`` in any coordinate cannot link:
   such pairs are discarded without looking at their bits.
3. *Verification.*  The pairs left are compared bit by bit.

A crowded cell is cut into tiles: its members are dealt to rows of a triangle
and every pair of rows meets in a task of its own, so no task holds an unbounded
cell and no pair is lost.  A task reports a spanning forest of what it
linked (fewer edges than members), never all pairs.

Defined results: null and word-less texts have fingerprint 0, which links like
any other; a text of fewer words than a shingle is one shingle; rows with
equal ids are rows of one component if their texts link, and are judged once per
text otherwise; a null id never names a component unless all of its ids are null.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ASCII_LOWER, map_rows, materialise, text_of
from .components import components

SEED, BLOCKS, PIVOTS, TILE = 42, 5, 24, 2048
_BITS = 64


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """Unsigned SimHash of one text (A-Z lower-cased, words split at ASCII white space)."""
    words = (text or b"").translate(ASCII_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        # a shingle is the stretch of the joined text from its first word to its last
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED)
                  for a, b in zip(starts[:len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist())]
    return _majority(np.array(hashes, np.uint64))


def _majority(hashes: np.ndarray) -> int:
    count = np.zeros(_BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[at:at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8),
                             axis=1, bitorder="little")
        count += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(count * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text",
                 digest: bool = False) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long; with ``digest`` also the text's SHA-256."""
    def run(cols):
        fps = np.array([fingerprint(t, shingle) for t in cols["text"]], np.uint64).view(np.int64)
        out = {"doc_id": cols["doc_id"], "fp": pa.array(fps)}
        if digest:
            out["text_sha256"] = [hashlib.sha256(t or b"").hexdigest() for t in cols["text"]]
        return out

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_rows(slim, run, "doc_id long, fp long" + (", text_sha256 string" if digest else ""))


def pivots(n: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints, the same in every task: hashes of 0, 1, 2, ..."""
    return np.array([xxhash.xxh64_intdigest(f"pivot {i}".encode()) for i in range(n)], np.uint64)


def pivot_table(fps: np.ndarray, refs: np.ndarray) -> np.ndarray:
    """Hamming distances, a row per fingerprint and a column per reference."""
    return np.bitwise_count(fps[:, None] ^ refs[None, :]).astype(np.int8)


def linked(left: np.ndarray, right: np.ndarray, lt: np.ndarray, rt: np.ndarray,
           radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``left`` and ``right`` of the pairs within ``radius``: table coordinates
    are compared one after the other, each on the pairs that the earlier ones left."""
    i, j = np.nonzero(np.abs(lt[:, None, 0] - rt[None, :, 0]) <= radius)
    for k in range(1, lt.shape[1]):
        near = np.abs(lt[i, k] - rt[j, k]) <= radius
        i, j = i[near], j[near]
    near = np.bitwise_count(left[i] ^ right[j]) <= radius
    return i[near], j[near]


def cell_masks(radius: int, blocks: int = BLOCKS) -> list[int]:
    """For every choice of ``blocks - radius`` of the blocks, the mask of their bits."""
    if not 0 < radius < blocks:
        raise ValueError("radius must be between 1 and blocks - 1")
    edges = [round(_BITS * k / blocks) for k in range(blocks + 1)]
    block = [((1 << edges[k + 1]) - 1) ^ ((1 << edges[k]) - 1) for k in range(blocks)]
    return [sum(choice) for choice in itertools.combinations(block, blocks - radius)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> tuple[list[int], list[int]]:
    """Each of ``n`` members that some pair joins, with the first member it hangs from."""
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in zip(a.tolist(), b.tolist()):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    hang = [(x, root(x)) for x in range(n)]
    return [x for x, r in hang if x != r], [r for x, r in hang if x != r]


def links(fps: DataFrame, radius: int = 3, tile: int = TILE) -> DataFrame:
    """Edges (a, b) that connect exactly the fingerprints that chains of links
    connect.  ``fps`` has distinct values in ``fp``."""
    masks = cell_masks(radius)
    cells = F.array(*[F.struct(F.lit(k).alias("choice"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("value"))
                      for k, m in enumerate(masks)])
    dealt = fps.select("fp", F.explode(cells).alias("cell")).select("fp", "cell.*")
    sizes = dealt.groupBy("choice", "value").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    sizes = materialise(sizes.withColumn("rows", F.ceil(F.col("n") / tile).cast("int")), "cells")
    met = dealt.join(sizes, ["choice", "value"])
    # member of row r meets rows 0..rows-1: tile (min, max); in its own tile (r, r) once
    own = F.pmod(F.xxhash64("fp", "choice"), F.col("rows")).cast("int")
    tiled = met.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)))
    keyed = tiled.select("choice", "value", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"),
                         "own", "fp")
    place = ["choice", "value", "lo", "hi"]
    sorted_ = keyed.repartition(*place).sortWithinPartitions(*place)
    refs = pivots()

    def run(batches):
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            cols = {n: rows.column(n).to_numpy() for n in (*place, "own", "fp")}
            new = np.zeros(rows.num_rows, bool)
            for n in place:
                new[1:] |= cols[n][1:] != cols[n][:-1]
            starts = np.concatenate(([0], np.flatnonzero(new)))
            held = rows.slice(int(starts[-1]))
            yield from _edges(cols, starts[:-1], starts[1:], refs, radius)
        if held is not None:
            cols = {n: held.column(n).to_numpy() for n in (*place, "own", "fp")}
            yield from _edges(cols, np.array([0]), np.array([held.num_rows]), refs, radius)

    return sorted_.mapInArrow(run, "a long, b long")


def _edges(cols, starts, ends, refs, radius):
    out_a, out_b = [], []
    for s, e in zip(starts.tolist(), ends.tolist()):
        if e - s < 2:
            continue
        fp, own, lo = cols["fp"][s:e].view(np.uint64), cols["own"][s:e], cols["lo"][s]
        mixed = lo != cols["hi"][s]
        table = pivot_table(fp, refs)
        if mixed:
            one, two = np.flatnonzero(own == lo), np.flatnonzero(own != lo)
        else:
            one = two = np.arange(e - s)
        found_a, found_b = [], []
        step = max(1, (1 << 20) // max(1, len(two)))
        for at in range(0, len(one), step):
            part = one[at:at + step]
            i, j = linked(fp[part], fp[two], table[part], table[two], radius)
            x, y = part[i], two[j]
            keep = x != y if mixed else x < y
            found_a.append(x[keep])
            found_b.append(y[keep])
        a, b = _forest(np.concatenate(found_a) if found_a else np.zeros(0, int),
                       np.concatenate(found_b) if found_b else np.zeros(0, int), e - s)
        signed = cols["fp"][s:e]
        out_a += signed[a].tolist()
        out_b += signed[b].tolist()
    if out_a:
        yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], names=["a", "b"])


def cluster(docs: DataFrame, shingle: int = 3, radius: int = 3, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """(doc_id, fp, component_id), a row per row of ``docs``; component_id is the
    smallest id that chains of links reach, the row's own included."""
    marked = materialise(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    return _with_lowest(marked, F.col("doc_id"), radius).select("doc_id", "fp", F.col("low").alias("component_id"))


def _with_lowest(marked: DataFrame, value: Column, radius: int) -> DataFrame:
    """``marked`` with ``low``, the smallest ``value`` in the component of the row's ``fp``."""
    values = materialise(marked.groupBy("fp").agg(F.min(value).alias("low")), "values")
    found = components(links(values.select("fp"), radius)).select(F.col("node").alias("fp"), "root")
    rooted = materialise(values.join(found, "fp"), "rooted")
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_low"))
    named = materialise(rooted.join(materialise(lowest, "lowest"), "root").select("fp", "component_low"), "named")
    own = materialise(values.join(named, "fp", "left").select("fp", F.coalesce("component_low", "low").alias("low")), "own")
    return marked.join(own, "fp")


def hex_digits(fp: str = "fp"):
    """16 lower-case hex digits of a fingerprint column."""
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


def deduplicate(docs: DataFrame, shingle: int = 3, radius: int = 3, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """``docs`` with one document left of each component: the one whose id names it.

    Of several texts with that id, or of a component without any id, the text with
    the smallest SHA-256 is left; of rows alike in id and text, one.
    """
    marked = materialise(fingerprints(docs, shingle, id_col, text_col, digest=True), "fingerprints")
    # nulls sort first in a struct: a null id comes after all others
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_sha256")
    rows = materialise(_with_lowest(marked, order, radius), "clustered")
    # rows alike in id and text share a fingerprint, so they go or stay together
    named = F.col("doc_id").eqNullSafe(F.col("low.doc_id")) & (F.col("text_sha256") == F.col("low.text_sha256"))
    gone = rows.filter(~named).select(F.col("doc_id").alias("__gone"), F.col("text_sha256").alias("__gone_sha")).distinct()
    many = materialise(rows.filter(named).groupBy("doc_id", "text_sha256").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
                       .select(F.col("doc_id").alias("__many"), F.col("text_sha256").alias("__many_sha")), "many")
    own = docs.withColumn("__id", F.col(id_col).cast("long")).withColumn("__sha", F.sha2(text_of(text_col).cast("binary"), 256))
    left = own.join(gone, F.col("__id").eqNullSafe(F.col("__gone")) & (F.col("__sha") == F.col("__gone_sha")), "left_anti")
    if many.isEmpty():
        return left.drop("__id", "__sha")
    same = F.col("__id").eqNullSafe(F.col("__many")) & (F.col("__sha") == F.col("__many_sha"))
    return left.join(many, same, "left_anti").unionByName(
        left.join(many, same, "left_semi").dropDuplicates(["__id", "__sha"])).drop("__id", "__sha")
