"""Phrase collocations by SON partitioning.

A *phrase* is a run of consecutive words of one piece of text.  It is wanted if
it occurs at least ``support`` times in its language.  Documents are dealt to
shards by blocks of ids.  If a language has ``N`` words and a shard ``N_s`` of them, a phrase with
``support`` occurrences has at least ``support * N_s / N`` of them in some shard, so:

1. every shard is mined completely at that lowered support: words first, then
   phrases of two words that are both locally frequent, then those of three
   and more whose pairs are;
2. the union over shards of what is locally frequent are the candidates;
3. all candidates are counted over the whole corpus, exactly.

A shard is a share of the corpus, not a task: it is mined by one distributed
aggregation on (shard and language, phrase), so a shard may have any size, and no
task holds one.  The number of shards follows the support, not the data: with
more than half as many shards as the support, the local support falls to one
and the shards no longer discard anything.

Mining goes by 64-bit hashes of phrases.  Two phrases with one hash count
together there, so a frequent phrase is never missed; at worst a rare one becomes a candidate.
What is frequent at one level reaches the tasks of the next as a bitmap of
``2 ** bits`` hashed places, whatever the number of phrases, which errs to the
same side.  The count in step 3 is of the phrases themselves.

Within a task the words of some MB of text are one array of hashes, and
phrases, tests and counts are array operations on it.

Defined results: null text counts as empty, null language as ``und``; repeated
rows count each; an empty table gives no phrases.  Texts are read in blocks cut
at white space or the end of a piece, so a long text needs no more memory than
a short one (but for a single word).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import ASCII_LOWER, materialise, slices

#: five shards lower a support of 30 to 6
SHARDS, BITS = 5, 26
#: documents whose ids agree but for so many last bits go to the same shard: they tend to be
#: in the same task, which then counts more of a shard's phrases together
ID_BITS = 14
#: occurrences that a task counts together before it hands the counts on
HELD = 2_000_000
#: bytes of text that are one array of words, at most and when mining, where counts go on from one to the next
BLOCK, MINED = 1 << 22, 1 << 20
#: parts of a language that are ranked on their own before the best of all are
PARTS = 64
UNKNOWN = "und"

# a piece ends at one of these; no word holds them, so a full stop can stand for all
_END = b"."
_FLAT = bytes(46 if chr(c) in ".,;:!?\n\v\f\r" else 32 if c == 9 else c for c in ASCII_LOWER)
_U = np.uint64
# The constants of XXH64
_P1, _P2, _P3 = _U(11400714785074694791), _U(14029467366897019727), _U(1609587929392839161)
_P4, _P5 = _U(9650029242287828579), _U(2870177450012600261)
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], "<u8")


def _chunks(text: bytes | None, most: int) -> Iterator[tuple[int, bytes]]:
    """A text in chunks of whole words, :data:`_END` between pieces and spaces between words: (k, chunk).
    The first k words, less than ``most``, are the last of the chunk before and end no phrase anew."""
    if not text:
        return
    at, kept = 0, []
    while at < len(text):
        flat = text[at:at + BLOCK].translate(_FLAT)
        at += len(flat)
        if at < len(text):  # go on to the end of the word
            more = []
            while at < len(text):
                step = text[at:at + 4096].translate(_FLAT)
                cut = min((p for p in (step.find(b" "), step.find(_END)) if p >= 0), default=-1)
                more.append(step if cut < 0 else step[:cut])
                at += len(more[-1])
                if cut >= 0:
                    break
            flat += b"".join(more)
        if kept:
            flat = b" ".join(kept) + b" " + flat
        yield len(kept) - kept.count(_END), flat
        if at < len(text):
            kept = flat.replace(_END, b" . ").rsplit(None, most - 1)[-(most - 1):] if most > 1 else []


def _turn(x: np.ndarray, by: int) -> np.ndarray:
    return (x << _U(by)) | (x >> _U(64 - by))


def hash_longs(x: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """What Spark's ``xxhash64`` makes of whole numbers under these seeds."""
    h = (seed + _P5 + _U(8)) ^ (_turn(x * _P2, 31) * _P1)
    h = _turn(h, 27) * _P1 + _P4
    h = (h ^ (h >> _U(33))) * _P2
    h = (h ^ (h >> _U(29))) * _P3
    return h ^ (h >> _U(32))


def _joined(left: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a phrase from those of all but its last word, and of that."""
    h = left * _P3 + word
    h = (h ^ (h >> _U(31))) * _P2
    return h ^ (h >> _U(29))


class Block:
    """Words of some texts: places in ``flat``, the texts' chunks with :data:`_END` between them.

    Word i is ``flat[start[i]:start[i] + length[i]]``, of text ``owner[i]``; ``opens[i]`` if it is the first of
    its piece.  Words that the chunk before had too (see :func:`_chunks`) are in ``old`` as (first, how many)."""

    def __init__(self, chunks: list[tuple[int, int, bytes]]):
        self.flat = _END.join([c for _, _, c in chunks]) + bytes(8)
        raw = np.frombuffer(self.flat, np.uint8)[:-8]
        inside = np.concatenate([[False], (raw != 32) & (raw != 46), [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.start, self.length = edges[::2].astype(np.int32), (edges[1::2] - edges[::2]).astype(np.int32)
        self.opens = np.zeros(len(self.start) + 1, bool)
        self.opens[np.searchsorted(self.start, np.flatnonzero(raw == 46))] = True
        begins = np.cumsum([0] + [len(c) + 1 for _, _, c in chunks[:-1]])
        word = np.searchsorted(self.start, begins)
        self.owner = np.repeat(np.array([i for i, _, _ in chunks], np.int32), np.diff(np.append(word, len(self.start))))
        self.old = [(int(w), again) for w, (_, again, _) in zip(word, chunks) if again]
        # the 8 bytes from every place on
        self.eight = np.ndarray(len(self.flat) - 7, "<u8", self.flat, strides=(1,))
        self.hash = self._hashes()

    def _hashes(self) -> np.ndarray:
        h = self.length.astype(_U) * _P5 + _P4
        left, at = np.arange(len(h)), 0
        while left.size:
            lane = self.eight[self.start[left] + at] & _MASKS[np.minimum(self.length[left] - at, 8)]
            h[left] = _turn(h[left] ^ (_turn(lane * _P2, 31) * _P1), 27) * _P1 + _P4
            at += 8
            left = left[self.length[left] > at]
        h = (h ^ (h >> _U(33))) * _P2
        return h ^ (h >> _U(29))

    def differ(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether words a and b differ, byte by byte."""
        out = self.length[a] != self.length[b]
        left, at = np.flatnonzero(~out), 0
        while left.size:
            x, y = a[left], b[left]
            rest = np.minimum(self.length[x] - at, 8)
            apart = (self.eight[self.start[x] + at] ^ self.eight[self.start[y] + at]) & _MASKS[rest] != 0
            out[left] = apart
            at += 8
            left = left[~apart & (self.length[x] > at)]
        return out

    def texts(self, at: np.ndarray, k: int) -> list[bytes]:
        """The phrases of ``k`` words from words ``at`` on."""
        last = at + k - 1
        stop = self.start[last] + self.length[last]
        words = sum(self.length[at + j] for j in range(k)) + k - 1
        flat = self.flat
        out = [flat[a:b] for a, b in zip(self.start[at].tolist(), stop.tolist())]
        for i in np.flatnonzero(stop - self.start[at] != words).tolist():  # more than one space between two
            out[i] = b" ".join(out[i].split())
        return out

    def phrases(self, longest: int, frequent: dict, seed: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(k, first words, hashes) of the phrases of 1 to ``longest`` words that ``frequent`` does not
        rule out: a phrase counts if its two parts of a word less do, and if the bitmap ``frequent[k]``, where there is one, has its place."""
        alive, h = np.ones(len(self.hash), bool), self.hash
        for k in range(1, longest + 1):
            if k > 1:
                alive = alive[:-1] & alive[1:]
                if k == 2:
                    alive &= ~self.opens[1:len(self.start)]
                h = _joined(h[:-1], self.hash[k - 1:])
            at = np.flatnonzero(alive)
            if k in frequent:
                bits = frequent[k]
                place = hash_longs(h[at], seed[self.owner[at]]) & _U(len(bits) * 8 - 1)
                hit = (bits[place >> _U(3)] >> (place & _U(7)).astype(np.uint8)) & 1 != 0
                alive = np.zeros(len(alive), bool)
                at = at[hit]
                alive[at] = True
            new = at
            for first, many in self.old:
                new = new[(new < first) | (new >= first + max(0, many - k + 1))]
            yield k, new, h[new]


def _blocks(texts: Sequence[bytes | None], longest: int) -> Iterator[Block]:
    chunks: list[tuple[int, int, bytes]] = []
    size = 0
    for i, text in enumerate(texts):
        for again, chunk in _chunks(text, longest):
            chunks.append((i, again, chunk))
            size += len(chunk)
            if size >= BLOCK:
                yield Block(chunks)
                chunks, size = [], 0
    if chunks:
        yield Block(chunks)


def _seeds(groups: Sequence[int]) -> np.ndarray:
    """Spark's ``xxhash64`` of each group, the seed of what is hashed after it."""
    return np.array([xxhash.xxh64_intdigest((g & (1 << 64) - 1).to_bytes(8, "little"), 42) for g in groups], _U)


def _bitmaps(texts: DataFrame, bitmaps: dict[int, bytes]) -> dict:
    return {k: texts.sparkSession.sparkContext.broadcast(b) for k, b in bitmaps.items()}


def mined(texts: DataFrame, first: int, longest: int, bitmaps: dict[int, bytes]) -> DataFrame:
    """(grp, hash, a): occurrences of the phrases of ``first`` to ``longest`` words that the
    bitmaps do not rule out, by group (a whole number) and hash."""
    carried = _bitmaps(texts, bitmaps)
    schema = pa.schema([("grp", pa.int64()), ("hash", pa.int64()), ("a", pa.int64())])

    def rows(held):
        for name in sorted(held):
            own = np.concatenate(held.pop(name))
            own.sort()
            starts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            counts = np.diff(np.append(starts, len(own)))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(starts), name)), pa.array(own[starts].view(np.int64)),
                                              pa.array(counts, pa.int64())], schema=schema)

    def run(batches):
        frequent = {k: np.frombuffer(b.value, np.uint8) for k, b in carried.items()}
        held, size = {}, 0  # by group, so that no more than one group's hashes are there twice
        for batch in batches:
            for part in slices(batch, MINED):
                seed = _seeds(part.column(0).to_pylist())
                names, code = np.unique(part.column(0).to_numpy(zero_copy_only=False), return_inverse=True)
                code = code.astype(np.int16 if len(names) < 1 << 15 else np.int64)
                for block in _blocks(part.column(1).cast(pa.binary()).to_pylist(), longest):
                    for k, at, h in block.phrases(longest, frequent, seed):
                        if k >= first and len(at):
                            own = code[block.owner[at]]
                            h = h[np.argsort(own, kind="stable")]
                            ends = np.cumsum(np.bincount(own, minlength=len(names)))
                            for name, lo, hi in zip(names.tolist(), [0, *ends], ends):
                                if hi > lo:
                                    held.setdefault(name, []).append(h[lo:hi])
                            size += len(at)
                    if size > HELD:
                        yield from rows(held)
                        held, size = {}, 0
        if held:
            yield from rows(held)

    return (texts.select("grp", "text").mapInArrow(run, "grp long, hash long, a long")
            .groupBy("grp", "hash").agg(F.sum("a").alias("a")))


def counted(texts: DataFrame, longest: int, places: bytes) -> DataFrame:
    """(lang, phrase, a): exact occurrences of the phrases of 1 to ``longest`` words whose place in the bitmap is set."""
    carried = _bitmaps(texts, {0: places})
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("a", pa.int64())])

    def run(batches):
        bits = np.frombuffer(carried[0].value, np.uint8)
        frequent = dict.fromkeys(range(1, longest + 1), bits)
        for batch in batches:
            for part in slices(batch):
                seed, langs = _seeds(part.column(0).to_pylist()), part.column(1).to_pylist()
                numbers = {g: i for i, g in enumerate(dict.fromkeys(langs))}
                names, lang = pa.array(list(numbers), pa.string()), np.array([numbers[g] for g in langs])
                for block in _blocks(part.column(2).cast(pa.binary()).to_pylist(), longest):
                    own = lang[block.owner]
                    for k, at, h in block.phrases(longest, frequent, seed):
                        if not len(at):
                            continue
                        at = at[np.argsort(hash_longs(h, own[at].astype(_U)))]
                        # neighbours are equal if they are word by word, which hashes only bring together
                        apart = own[at[1:]] != own[at[:-1]]
                        for j in range(k):
                            apart |= block.differ(at[1:] + j, at[:-1] + j)
                        starts = np.flatnonzero(np.concatenate([[True], apart]))
                        counts, some = np.diff(np.append(starts, len(at))), at[starts]
                        for lo in range(0, len(some), 50_000):
                            few = some[lo:lo + 50_000]
                            yield pa.RecordBatch.from_arrays(
                                [names.take(pa.array(own[few])), pa.array(block.texts(few, k), pa.binary()).cast(pa.string()),
                                 pa.array(counts[lo:lo + 50_000], pa.int64())], schema=schema)

    return (texts.select("lang_hash", "lang", "text").mapInArrow(run, "lang string, phrase string, a long")
            .groupBy("lang", "phrase").agg(F.sum("a").alias("a")))


def bitmap_of(df: DataFrame, columns: Sequence[str], bits: int) -> bytes:
    """``2 ** bits`` bits, set at the hash of the columns of each row.  Whatever the
    number of rows, the driver gets at most that many bits."""
    place = F.xxhash64(*columns).bitwiseAND(F.lit((1 << bits) - 1))
    rows = (df.select(place.alias("p")).groupBy(F.shiftright("p", 15).alias("row"))  # 2 ** 15 bits a row
            .agg(F.bitmap_construct_agg(F.col("p") % (1 << 15)).alias("b")))
    out = bytearray(1 << bits - 3)
    for r in rows.collect():
        out[r["row"] << 12:r["row"] + 1 << 12] = r["b"]
    return bytes(out)


def count(docs: DataFrame, support: int = 30, longest: int = 4, shards: int = SHARDS, bits: int = BITS,
          id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """``(phrases, sizes)``: (lang, phrase, a) of every phrase of 1 to ``longest`` words with at least
    ``support`` occurrences in its language, and (lang, n), the words of each language."""
    if bits < 15 or support < 1 or shards < 1 or longest < 1:
        raise ValueError("support, shards and longest are at least 1, bits at least 15")
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN))
    shard = F.pmod(F.xxhash64(F.shiftright(F.col(id_col).cast("long"), ID_BITS)), F.lit(shards))
    texts = docs.select(F.xxhash64(shard, lang).alias("grp"), shard.alias("shard"), F.xxhash64(lang).alias("lang_hash"),
                        lang.alias("lang"), F.col(text_col).cast("string").alias("text"))
    # one row for each shard and language
    parts = materialise(texts.select("grp", "shard", "lang").distinct(), "parts")
    if parts.groupBy("grp").count().filter("count > 1").limit(1).count():
        raise ValueError("two shards share a hash: change their number")
    words = materialise(mined(texts, 1, 1, {}), "words")
    sizes = words.groupBy("grp").agg(F.sum("a").alias("own")).join(parts, "grp").withColumn("n", F.sum("own").over(W.partitionBy("lang")))
    sizes = materialise(sizes.select("grp", "lang", "own", "n"), "sizes")
    enough = F.col("a").cast("decimal(20,0)") * F.col("n") >= F.col("own").cast("decimal(20,0)") * support

    def local(rows, label):
        return materialise(rows.join(sizes, "grp").filter(enough).select("grp", "lang", "hash"), label)

    found = [local(words, "local-words")]
    if longest > 1:
        bitmaps = {1: bitmap_of(found[0], ["grp", "hash"], bits)}
        found.append(local(mined(texts, 2, 2, bitmaps), "local-pairs"))
    if longest > 2:
        bitmaps[2] = bitmap_of(found[1], ["grp", "hash"], bits)
        found.append(local(mined(texts, 3, longest, bitmaps), "local-longer"))
    union = found[0]
    for f in found[1:]:
        union = union.unionByName(f)
    candidates = union.select(F.xxhash64("lang").alias("lang_hash"), "hash")
    places = bitmap_of(candidates, ["lang_hash", "hash"], bits)
    # whatever reaches the support is a candidate, by 1 and 2; the rest had but a place in common with one
    exact = counted(texts, longest, places).filter(F.col("a") >= support)
    return materialise(exact, "phrases"), sizes.select("lang", "n").distinct()


def collocations(docs: DataFrame, support: int = 30, longest: int = 4, inside: int = 80, top: int = 2000,
                 shards: int = SHARDS, bits: int = BITS, **columns) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Cutting a phrase of ``a`` occurrences in two gives parts of ``l`` and ``r``; the
    score is ``floor(2000000 * a / (l + r))`` of the cut that scores lowest, the
    earliest such.  A phrase goes if a longer one holds it and has at least ``inside`` percent
    of its occurrences.  Order: score, occurrences (both falling), phrase by bytes.
    """
    counts, sizes = count(docs, support, longest, shards, bits, **columns)
    words = F.split("phrase", " ")
    many = counts.withColumn("w", words).withColumn("m", F.size("w")).filter("m > 1")
    # all phrases inside a longer one that still have two words
    held = many.filter("m > 2").select("lang", "a", F.explode(F.expr(
        "flatten(transform(sequence(2, m - 1), k -> transform(sequence(1, m - k + 1), i -> array_join(slice(w, i, k), ' '))))")).alias("phrase"))
    covered = held.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left = many.join(covered, ["lang", "phrase"], "left").filter(
        F.coalesce(F.col("longer").cast("decimal(20,0)") * 100 < F.col("a").cast("decimal(20,0)") * inside, F.lit(True)))
    cuts = left.select("lang", "phrase", "a", F.explode(F.expr(
        "transform(sequence(1, m - 1), k -> struct(k as k, array_join(slice(w, 1, k), ' ') as first,"
        " array_join(slice(w, k + 1, m - k), ' ') as rest))")).alias("c")).select("lang", "phrase", "a", "c.*")
    # parts of a phrase are at least as frequent, so both are there
    part = counts.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l"))
    other = counts.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r"))
    scored = cuts.join(part, ["lang", "first"]).join(other, ["lang", "rest"]).withColumn(
        "score", F.expr("cast((cast(a as decimal(25,0)) * 2000000) div (cast(l as decimal(20,0)) + r) as long)"))
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("b"))
    # the best of each part of a language first, so that no task sorts all of it
    best = best.select("lang", "phrase", "a", "b.l", "b.r", "b.score").withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    few = best.withColumn("nth", F.row_number().over(W.partitionBy("lang", "part").orderBy(*order))).filter(F.col("nth") <= top)
    ranked = few.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
