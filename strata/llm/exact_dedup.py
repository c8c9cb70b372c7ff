"""Exact deduplication by recipes of content-defined chunks.

A text (A-Z lower-cased, nothing else changed) is cut where a rolling value of
its last 16 bytes says so, so that equal texts get equal cuts wherever they
lie.  A chunk is named by its 64-bit hash once that name is verified: chunks
are grouped by hash *and bytes*, which moves each distinct chunk of a task
once, and a hash that names two different chunks gets an ordinal per content.
A text is then its ordered list of identifiers, its recipe; equal recipes are
equal texts.  Whole texts are never shuffled or compared again.

Hot groups: the grouping of chunks and of recipes combines before its shuffle;
the way back from groups to documents is a join of two freshly read tables,
which adaptive execution splits.

Defined results: null text is the empty text, whose recipe is empty; rows with
a null id are one group member each and lose against any id; rows that share
both id and text are told apart nowhere, all of them are returned and exactly
one is kept; an id with two texts is judged once per text.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import ASCII_LOWER, ascii_lower, map_rows, materialise, text_of, unrolled

AVERAGE, SMALLEST, LARGEST, WINDOW = 2048, 512, 16384, 16
# odd multiplier of the rolling polynomial, modulo 2**32 by overflow
_BASE = 0x9E3779B1


def cut_points(data: bytes, average: int = AVERAGE, smallest: int = SMALLEST,
               largest: int = LARGEST) -> list[int]:
    """Ends of the chunks of ``data``; the last is ``len(data)``, none if empty.

    A cut follows a byte whose preceding ``WINDOW`` bytes hash to 0 modulo
    ``average``, at least ``smallest`` and at most ``largest`` bytes after the
    previous one.
    """
    n = len(data)
    if n <= smallest:
        return [n] if n else []
    b = np.frombuffer(data, np.uint8).astype(np.uint32)
    power = np.uint32(1)
    rolled = np.zeros(n - WINDOW + 1, np.uint32) if n >= WINDOW else np.zeros(0, np.uint32)
    for k in range(WINDOW):
        rolled += b[WINDOW - 1 - k:n - k][:rolled.size] * power
        power = np.uint32(int(power) * _BASE & 0xFFFFFFFF)
    ends = np.flatnonzero((rolled >> np.uint32(7)) % np.uint32(average) == 0) + WINDOW
    out, last = [], 0
    for e in ends.tolist():
        while e - last > largest:
            last += largest
            out.append(last)
        if e - last >= smallest and e < n:
            out.append(e)
            last = e
    while n - last > largest:
        last += largest
        out.append(last)
    out.append(n)
    return out


def chunks_of(text: bytes | None, bits: int = 64) -> tuple[bytes, list[tuple[int, bytes]]]:
    """The normalised text and its chunks as (hash, bytes); ``bits`` shortens
    the hash, which tests use to make it collide."""
    data = (text or b"").translate(ASCII_LOWER)
    out, last, keep = [], 0, (1 << bits) - 1
    for e in cut_points(data):
        c = data[last:e]
        h = xxhash.xxh64_intdigest(c) & keep
        out.append((h - (1 << 64) if h >> 63 else h, c))
        last = e
    return data, out


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 64) -> DataFrame:
    """id, SHA-256 of the normalised text, its unverified recipe of chunk hashes."""
    def run(cols):
        shas, lists = [], []
        for t in cols["text"]:
            data, parts = chunks_of(t, bits)
            shas.append(hashlib.sha256(data).hexdigest())
            lists.append([h for h, _ in parts])
        return {"doc_id": cols["doc_id"], "text_sha256": shas, "hashes": lists}

    return map_rows(_slim(docs, id_col, text_col), run, "doc_id long, text_sha256 string, hashes array<long>")


def chunk_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 64) -> DataFrame:
    """A row (id, text_sha256, place, hash, bytes) per chunk."""
    def run(cols):
        ids, shas, places, hashes, parts = [], [], [], [], []
        for i, t in zip(cols["doc_id"], cols["text"]):
            data, got = chunks_of(t, bits)
            sha = hashlib.sha256(data).hexdigest() if got else ""
            for k, (h, c) in enumerate(got):
                ids.append(i)
                shas.append(sha)
                places.append(k)
                hashes.append(h)
                parts.append(c)
        return {"doc_id": ids, "text_sha256": shas, "place": places, "hash": hashes, "chunk": pa.array(parts, pa.binary())}

    return map_rows(_slim(docs, id_col, text_col), run,
                    "doc_id long, text_sha256 string, place int, hash long, chunk binary")


def _slim(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def colliding_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 64) -> DataFrame:
    """(hash, chunk, ordinal) of every hash that names more than one content."""
    distinct = (chunk_rows(docs, id_col, text_col, bits).groupBy("hash", "chunk").agg(F.lit(1).alias("__one")))
    bad = materialise(distinct.groupBy("hash").agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").select("hash"),
                      "collisions")
    if bad.isEmpty():
        return bad.select("hash", F.lit(None).cast("binary").alias("chunk"), F.lit(0).alias("ordinal"))
    ordinal = F.row_number().over(W.partitionBy("hash").orderBy("chunk")) - 1
    return materialise(distinct.select("hash", "chunk").join(bad, "hash", "left_semi").withColumn("ordinal", ordinal),
                       "ordinals")


def verified_recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 64) -> DataFrame:
    """(doc_id, text_sha256, recipe) with a row per document, where equal recipes are equal texts."""
    listed = recipes(docs, id_col, text_col, bits)
    bad = colliding_chunks(docs, id_col, text_col, bits)
    plain = listed.select("doc_id", "text_sha256", F.col("hashes").alias("recipe"))
    if bad.isEmpty():
        return materialise(plain, "recipes")
    # Some hash names two contents: the texts that hold one carry the ordinals, appended in order of place.
    # The rows of a repeated document agree in both columns, so grouping by (id, digest) leaves one of them.
    ordinals = (chunk_rows(docs, id_col, text_col, bits).join(bad, ["hash", "chunk"])
                .groupBy("doc_id", "text_sha256")
                .agg(F.sort_array(F.collect_set(F.struct("place", "ordinal"))).alias("__named")))
    named = F.transform("__named", lambda x: x["ordinal"].cast("long"))
    p, o = plain.alias("p"), ordinals.alias("o")
    joined = p.join(o, F.col("p.doc_id").eqNullSafe(F.col("o.doc_id"))
                    & (F.col("p.text_sha256") == F.col("o.text_sha256")), "left")
    return materialise(joined.select("p.doc_id", "p.text_sha256", F.concat(
        "p.recipe", F.coalesce(named, F.array().cast("array<long>"))).alias("recipe")), "recipes")


def decide(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 64) -> DataFrame:
    """A row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest id is kept.
    """
    rows = verified_recipes(docs, id_col, text_col, bits)
    # rows alike in id and text are counted here and told apart again at the end
    alike = rows.groupBy("recipe", "doc_id", "text_sha256").agg(F.count(F.lit(1)).alias("__copies"))
    alike = materialise(alike, "alike")
    groups = materialise(
        alike.groupBy("recipe").agg(F.max("doc_id").alias("keep_id"), F.sum("__copies").alias("group_size"))
        .filter("group_size > 1"), "groups")
    back = alike.join(groups, "recipe", "left")
    out = back.select("doc_id", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                      F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), "text_sha256", "__copies")
    return (unrolled(out, "__copies", "__copy")
            .select("doc_id", "keep_id", "group_size",
                    (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("__copy") == 0)).alias("kept"),
                    "text_sha256"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that :func:`decide` drops, all columns kept.

    Only ids are moved to find them; the rows that stay are then picked by an
    anti join on the ids that go.  Where an id occurs more than once its rows
    are first brought down to one per text.
    """
    decided = materialise(decide(docs, id_col, text_col), "decided")
    many = materialise(decided.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc_id"),
                       "many")
    gone = decided.filter(~F.col("kept")).select(F.col("doc_id").alias("__gone"))
    if many.isEmpty():
        return docs.join(gone, F.col(id_col).cast("long").eqNullSafe(F.col("__gone")), "left_anti")
    marked = many.select(F.col("doc_id").alias("__many"))
    same = F.col(id_col).cast("long").eqNullSafe(F.col("__many"))
    single = docs.join(marked, same, "left_anti").join(
        gone, F.col(id_col).cast("long").eqNullSafe(F.col("__gone")), "left_anti")
    sha = F.sha2(ascii_lower(text_of(text_col)), 256)
    stay = decided.filter("kept").select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha")).distinct()
    repeated = (docs.join(marked, same, "left_semi").withColumn("__own", sha)
                .join(stay, F.col(id_col).cast("long").eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__sha")),
                      "left_semi")
                .dropDuplicates([id_col, "__own"]).drop("__own"))
    return single.unionByName(repeated)
