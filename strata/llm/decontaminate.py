"""Benchmark decontamination by winnowing, in DataFrame functions only.

Of every ``window - k + 1`` consecutive k-gram hashes of a text the smallest is
kept (all places, where several tie).  A stretch of ``window`` words that a
document shares with a benchmark item has the same smallest hash in both, so
joining the kept hashes finds every such stretch: nothing is left to chance.
Of an item each different window is marked once, at its first place, so words that repeat in
both meet once for each place in the document, not for each pair of places.
Each meeting fixes an alignment of document and item; its matching words are
then compared one by one and extended to runs as long as the alignment allows, and a run counts from
``window`` words on.  The runs cover every window that document and item share.  Items shorter than ``window`` are fingerprinted whole, one
k-gram of the item's own length.

Word hashes are computed inside the row, so the documents' text is not
shuffled; of a document only the kept hashes are joined.  The benchmark's
kept hashes are broadcast up to a row bound and joined by shuffle beyond it,
where adaptive execution splits a hash that very many documents hold.

Defined results: a null or word-less text has no words and no hits, an item
without words matches nothing; rows with equal ids are told apart by their
text; equal rows get equal results, one each.  An item with a null id matches
like any other: all of them count as one in ``n_items`` and none is listed in ``item_ids``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, WORD_BYTES, bounded_broadcast, materialise, text_of

WINDOW, K = 10, 5
#: rows of the benchmark's fingerprints (24 bytes each) and of matched ids that may be broadcast
BROADCAST_ROWS = 1_000_000
_SEPARATORS = "".join(chr(c) for c in range(128) if WORD_BYTES[c] == 32 and c != 32)


def words(text: Column) -> Column:
    """Words of digits, ASCII letters (lower-cased) and non-ASCII characters."""
    spaced = F.translate(text, UPPER + _SEPARATORS, LOWER + " " * len(_SEPARATORS))
    return F.array_remove(F.split(spaced, " "), "")


def _places(array: str, k: int) -> str:
    return f"if(size({array}) >= {k}, sequence(0, size({array}) - {k}), cast(array() as array<int>))"


def winnowed(df: DataFrame, array: str, window: int = WINDOW, k: int = K, out: str = "kept") -> DataFrame:
    """``df`` with ``out``: array of (pos, hash) of the k-grams of ``array`` that are
    smallest in some run of ``window - k + 1`` neighbours."""
    w = window - k + 1
    if not 1 <= k <= window:
        raise ValueError("k must be between 1 and window")
    gram = ", ".join(f"{array}[i + {j}]" for j in range(k))
    hashed = df.withColumn("__h", F.expr(f"transform({_places(array, k)}, i -> xxhash64({gram}))"))
    if w == 1:
        chosen = hashed.withColumn("__at", F.expr("if(size(__h) > 0, sequence(0, size(__h) - 1), cast(array() as array<int>))"))
    else:
        # __m[i]: smallest of the run that starts at i.  i is kept if it is the smallest of a run that holds
        # it; each such run's smallest is at most __h[i], so it is enough to look at the largest of them
        ahead = ", ".join(f"get(__h, i + {j})" for j in range(w))
        behind = ", ".join(f"get(__m, i - {j})" for j in range(w))
        chosen = (hashed.withColumn("__m", F.expr(f"transform(__h, (x, i) -> least({ahead}))"))
                  .withColumn("__at", F.expr("filter(if(size(__h) > 0, sequence(0, size(__h) - 1), cast(array() as array<int>)),"
                                             f" i -> __h[i] = greatest({behind}))")))
    return (chosen.withColumn(out, F.expr("transform(__at, i -> struct(i as pos, __h[i] as hash))"))
            .drop("__h", "__m", "__at"))


def _marks(items: DataFrame, window: int, k: int) -> DataFrame:
    """(item_key, n, item_pos, hash): the first smallest k-gram of each different window of the items,
    at the window's first place.  Which k-gram that is depends on the window alone, and :func:`winnowed` keeps it in any text."""
    w = window - k + 1
    gram = ", ".join(f"item_words[i + {j}]" for j in range(k))
    hashed = items.withColumn("__h", F.expr(f"transform({_places('item_words', k)}, i -> xxhash64({gram}))"))
    each = hashed.select("item_key", "n", F.explode_outer(F.expr(
        f"transform({_places('item_words', window)}, j -> struct(array_join(slice(item_words, j + 1, {window}), ' ') as words, j as at,"
        f" slice(__h, j + 1, {w}) as h))")).alias("w"))
    at = F.col("w.at") + F.array_position("w.h", F.array_min("w.h")).cast("int") - 1
    marked = each.select("item_key", "n", F.col("w.words").alias("words"), F.struct(F.col("w.at").alias("at"), at.alias("item_pos"),
                                                                                    F.array_min("w.h").alias("hash")).alias("m"))
    return marked.groupBy("item_key", "n", "words").agg(F.min("m").alias("m")).select("item_key", "n", "m.item_pos", "m.hash")


def _items(benchmark: DataFrame, item_col: str, text_col: str, window: int) -> DataFrame:
    """Items that have words: item_id (as text, may be null), their words and how many, and
    item_key, never null and different for each (id, words)."""
    held = (benchmark.select(F.col(item_col).cast("string").alias("item_id"), words(text_of(text_col)).alias("item_words"))
            .distinct().withColumn("n", F.size("item_words")).filter("n > 0"))
    # fixed by being written
    return materialise(held.withColumn("item_key", F.monotonically_increasing_id()), "items")


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, k: int = K, id_col: str = "doc_id",
         text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(rows, runs)``: a row (doc_id, text_hash, n_words) per document, and the
    runs (doc_id, text_hash, item_id, first, last) of words shared with an item."""
    items = _items(benchmark, item_col, item_text_col, window)
    short = sorted(r["n"] for r in items.filter(F.col("n") < window).select("n").distinct().collect())  # below window
    texts = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_of(text_col)).alias("text_hash"),
                        words(text_of(text_col)).alias("words"))
    sides, kinds = [], []
    grams = winnowed(texts, "words", window, k)
    # explode_outer throughout: for explode the optimiser adds a filter on the array's size and
    # pushes a copy of the whole expression below the projections that share its parts
    sides.append(_marks(items.filter(F.col("n") >= window), window, k))
    kinds.append(F.col("kept"))
    for m in short:
        grams = winnowed(grams, "words", m, m, f"kept{m}")
        # the length goes into the hash, so that kinds don't meet by chance
        own = F.xxhash64(F.lit(m), F.col("kept")[0]["hash"])
        sides.append(winnowed(items.filter(F.col("n") == m), "item_words", m, m)
                     .select("item_key", "n", F.lit(0).alias("item_pos"), own.alias("hash")))
        kinds.append(F.expr(f"transform(kept{m}, x -> struct(x.pos as pos, xxhash64({m}, x.hash) as hash))"))
    marked = sides[0]
    for s in sides[1:]:
        marked = marked.unionByName(s)
    marked = bounded_broadcast(materialise(marked.distinct(), "marks"), BROADCAST_ROWS)
    # the last element stands for the document itself and carries its word count as a negative place
    itself = F.array(F.struct((-F.size("words") - 1).alias("pos"), F.col("text_hash").alias("hash")))
    probe = grams.select("doc_id", "text_hash", F.explode_outer(F.concat(*kinds, itself)).alias("kept")).select(
        "doc_id", "text_hash", F.col("kept.pos").alias("pos"), F.col("kept.hash").alias("hash"))
    met = probe.join(marked, (probe["hash"] == marked["hash"]) & (probe["pos"] >= 0), "left").filter(
        "pos < 0 or item_key is not null")
    met = materialise(met.select("doc_id", "text_hash", "pos", "item_key", "n", "item_pos"), "met")
    rows = met.filter("pos < 0").select("doc_id", "text_hash", (-F.col("pos") - 1).cast("long").alias("n_words"))
    lines = materialise(met.filter("pos >= 0").select("doc_id", "text_hash", "item_key", "n",
                                                      (F.col("pos") - F.col("item_pos")).alias("shift")).distinct(), "lines")
    return rows, _extended(docs, lines, items, window, id_col, text_col)


def _extended(docs: DataFrame, lines: DataFrame, items: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """Maximal runs of equal words, word by word, along each alignment in ``lines``."""
    wanted = bounded_broadcast(materialise(lines.select("doc_id", "text_hash").distinct(), "wanted"), BROADCAST_ROWS)
    d = docs.select(F.col(id_col).alias("__id"), text_of(text_col).alias("__text")).withColumn("__hash", F.xxhash64("__text"))
    same = d["__id"].eqNullSafe(wanted["doc_id"]) & (d["__hash"] == wanted["text_hash"])
    held = materialise(d.join(wanted, same, "left_semi").select(
        F.col("__id"), F.col("__hash"), words(F.col("__text")).alias("__words")).dropDuplicates(["__id", "__hash"]), "held")
    # only the stretch that lies along the item goes on
    along = lines.join(held, lines["doc_id"].eqNullSafe(held["__id"]) & (lines["text_hash"] == held["__hash"])).select(
        "doc_id", "text_hash", "item_key", "shift",
        F.expr("slice(__words, greatest(shift, 0) + 1, n)").alias("stretch"))
    both = along.join(items, "item_key").withColumn("apart", F.expr(
        "concat(array(-1), filter(sequence(0, n - 1), j -> not coalesce(get(stretch, j + least(shift, 0)) = item_words[j], false)),"
        " array(n))"))
    runs = F.expr(f"filter(transform(sequence(0, size(apart) - 2), i -> struct(apart[i] + 1 as first, apart[i + 1] - 1 as last)),"
                  f" r -> r.last - r.first + 1 >= least({window}, n))")
    return both.select("doc_id", "text_hash", "item_id", "shift", F.explode_outer(runs).alias("run")).filter("run is not null").select(
        "doc_id", "text_hash", "item_id", (F.col("run.first") + F.col("shift")).alias("first"),
        (F.col("run.last") + F.col("shift")).alias("last"))


def report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """doc_id, text_hash, n_words, n_hit (words inside a shared window), n_items (distinct ids, null
    among them), item_ids (sorted as text, without null), contaminated; a row per row of ``docs``."""
    rows, runs = hits(docs, benchmark, **options)
    runs = materialise(runs.distinct(), "runs")
    key = ["doc_id", "text_hash"]
    # words under the union of a document's runs, taken in order: those beyond the furthest reached so far
    spans = F.array_sort(F.collect_set(F.struct("first", "last")))
    covered = runs.groupBy(*key).agg(F.aggregate(
        spans, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).alias("reach")),
        lambda a, x: F.struct((a["n"] + F.greatest(F.lit(0), x["last"] - F.greatest(x["first"] - 1, a["reach"]))).alias("n"),
                              F.greatest(a["reach"], x["last"]).alias("reach")), lambda a: a["n"]).alias("n_hit"))
    found = runs.groupBy(*key).agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"),
                                    F.max(F.col("item_id").isNull().cast("int")).alias("unnamed"))
    per = materialise(covered.alias("c").join(found.alias("f"), F.col("c.doc_id").eqNullSafe(F.col("f.doc_id"))
                                  & (F.col("c.text_hash") == F.col("f.text_hash")))
                      .select("c.doc_id", "c.text_hash", "n_hit", "item_ids", "unnamed"), "per-document")
    r, p = rows.alias("r"), per.alias("p")
    out = r.join(p, F.col("r.doc_id").eqNullSafe(F.col("p.doc_id")) & (F.col("r.text_hash") == F.col("p.text_hash")), "left")
    return out.select("r.doc_id", "r.text_hash", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                      F.coalesce(F.size("item_ids") + F.col("unnamed"), F.lit(0)).cast("long").alias("n_items"),
                      F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
                      F.col("n_hit").isNotNull().alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  **options) -> DataFrame:
    """``docs`` without the documents that share a window with an item, all columns kept."""
    _, runs = hits(docs, benchmark, id_col=id_col, text_col=text_col, **options)
    gone = materialise(runs.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct(), "gone")
    gone = bounded_broadcast(gone, BROADCAST_ROWS)
    return docs.join(gone, F.col(id_col).eqNullSafe(F.col("__id"))
                     & (F.xxhash64(text_of(text_col)) == F.col("__hash")), "left_anti")
