"""Phrase mining, mixing and resampling against plain recomputation."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import common, mixing, phrases, resample

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
VOCABULARY = ["the", "of", "Red", "fox", "ran", "é", "—", "a/b", "x_y", "\x0c", "\x85z", "\\"]


def _texts(seed, n):
    rng = random.Random(seed)
    return [rng.choice([" ", "\t", "  "]).join(rng.choices(VOCABULARY, [9, 8, 7, 3, 3, 2, 1, 1, 1, 1, 1, 1], k=rng.randint(0, 40)))
            .replace("ran", rng.choice(["ran.", "ran,", "ran\n", "ran"])) for _ in range(n)]


# ---- phrases

def _phrases(rows, support, longest, inside, top):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            for k in range(1, longest + 1):
                f[lang or "und"].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        freq = {g: a for g, a in c.items() if a >= support}
        rows = []
        for g, a in freq.items():
            if len(g) < 2 or any(len(q) > len(g) and 100 * b >= inside * a and any(q[i:i + len(g)] == g for i in range(len(q)))
                                 for q, b in freq.items()):
                continue
            score, k = min((2000000 * a // (freq[g[:k]] + freq[g[k:]]), k) for k in range(1, len(g)))
            rows.append((-score, -a, " ".join(g).encode(), freq[g[:k]], freq[g[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


@pytest.mark.parametrize("support,shards,bits,top", [(6, 3, 20, 2000), (3, 10, 15, 7), (12, 1, 26, 2000)])
def test_phrases_brute_force(spark, support, shards, bits, top):
    texts = _texts(support, 120)
    rng = random.Random(1)
    rows = [(rng.choice([i, i, None, 7]), t, rng.choice(["en", "en", "a/b", None])) for i, t in enumerate(texts)]
    rows += [(1, None, "en"), (2, "", None), (3, "the of " * 300, "en"), (3, "the of " * 300, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("phrase", F.lit("x")).withColumn("grp", F.lit(1))
    got = sorted(map(tuple, phrases.collocations(docs, support, 4, 80, top, shards, bits).collect()))
    assert got == _phrases(rows, support, 4, 80, top) and got


def test_phrases_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    out = phrases.collocations(docs)
    assert out.isEmpty() and out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    odd = spark.createDataFrame([(None, None, None), (1, "", "x")], "doc_id long, text string, lang string")
    assert phrases.collocations(odd, support=1).isEmpty()


@pytest.mark.parametrize("block", [1, 7, 100])
def test_phrases_across_blocks(monkeypatch, block):
    monkeypatch.setattr(phrases, "BLOCK", block)
    texts = [t.encode() for t in _texts(5, 10)] + [None, b"", b"one"]
    got = Counter()
    for b in phrases._blocks(texts, 4):
        for k, at, _ in b.phrases(4, {}, np.zeros(len(texts), np.uint64)):
            got.update(zip(b.owner[at].tolist(), b.texts(at, k)))
    want = Counter()
    for i, text in enumerate(texts):
        for piece in re.split(rb"[.,;:!?\n-\r]", (text or b"").lower()):
            w = re.findall(rb"[^\x20\x09]+", piece)
            for k in range(1, 5):
                want.update((i, b" ".join(w[j:j + k])) for j in range(len(w) - k + 1))
    assert got == want


def test_equal_hashes_are_counted_apart(spark, monkeypatch):
    """With all hashes alike every phrase is a candidate, and the count is still of phrases."""
    docs = spark.createDataFrame([(1, "a b a b c", "x"), (2, "b a. b a b", "x")], "doc_id long, text string, lang string")
    monkeypatch.setattr(phrases.Block, "_hashes", lambda self: np.full(len(self.start), 7, np.uint64))
    texts = docs.select(F.xxhash64("lang").alias("lang_hash"), "lang", "text")
    import pyarrow as pa
    block = next(phrases._blocks([r.text.encode() for r in texts.collect()], 2))
    assert len(set(block.hash.tolist())) == 1
    # the same function that the tasks run, on one batch here
    run = {}
    monkeypatch.setattr(type(texts), "mapInArrow", lambda self, fn, schema: run.setdefault("fn", fn) and self.select("lang", F.lit("").alias("phrase"), F.lit(0).alias("a")))
    phrases.counted(texts, 2, b"\xff" * 4096)
    batch = pa.RecordBatch.from_arrays([pa.array([r.lang_hash for r in texts.collect()]), pa.array(["x", "x"]), pa.array(["a b a b c", "b a. b a b"])],
                                       names=["lang_hash", "lang", "text"])
    got = Counter()
    for out in run["fn"](iter([batch])):
        for r in out.to_pylist():
            got[r["phrase"]] += r["a"]
    assert got == Counter({"a": 4, "b": 5, "c": 1, "a b": 3, "b a": 3, "b c": 1})


def test_bitmap_places_agree_with_the_workers(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(-2 ** 63, 2 ** 63), rng.randrange(-2 ** 63, 2 ** 63)) for _ in range(50)]
    bits = np.frombuffer(phrases.bitmap_of(spark.createDataFrame(rows, "grp long, hash long"), ["grp", "hash"], 22), np.uint8)
    assert int(np.bitwise_count(bits).sum()) <= 50
    place = phrases.hash_longs(np.array([h for _, h in rows], np.int64).view(np.uint64), phrases._seeds([g for g, _ in rows])) & np.uint64((1 << 22) - 1)
    assert all(bits[int(p) >> 3] >> (int(p) & 7) & 1 for p in place) and len(set(place.tolist())) == int(np.bitwise_count(bits).sum())


def test_mining_hands_on_group_by_group(monkeypatch):
    """The counts of a task's groups, taken together over blocks, and with no more than two copies of what is held."""
    import tracemalloc

    import pyarrow as pa
    run = {}

    class Table:
        def select(self, *names):
            return self

        def mapInArrow(self, fn, schema):
            run["fn"] = fn
            return self

        def groupBy(self, *names):
            return self

        def agg(self, *sums):
            return self

    monkeypatch.setattr(phrases, "_bitmaps", lambda texts, bitmaps: {})
    monkeypatch.setattr(phrases.F, "sum", lambda c: type("Sum", (), {"alias": lambda self, n: self})())
    phrases.mined(Table(), 1, 2, {})
    texts = [t.lower() for t in _texts(3, 60)]
    groups = [(-1) ** i * (i % 7) * 2 ** 60 for i in range(60)]
    batch = pa.RecordBatch.from_arrays([pa.array(groups, pa.int64()), pa.array(texts)], names=["grp", "text"])
    totals = []
    for most in (1, 10 ** 9):
        monkeypatch.setattr(phrases, "HELD", most)
        got = Counter()
        for out in run["fn"](iter([batch, batch])):
            for r in out.to_pylist():
                got[r["grp"], r["hash"]] += r["a"]
        totals.append(got)
    words = sum(len(re.findall("[^\x20\x09]+", p)) for t in texts for p in re.split("[.,;:!?\n-\r]", t))
    assert totals[0] == totals[1] and len({g for g, _ in totals[0]}) == len(set(groups))
    assert sum(totals[0].values()) >= 2 * words
    rng = random.Random(8)
    long = [" ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(10_000)) for _ in range(40)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(40), pa.int64()), pa.array(long)], names=["grp", "text"])
    tracemalloc.start()
    for _ in run["fn"](iter([batch])):
        pass
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 45 << 20  # measured: 23 MB, and 73 MB when all groups were sorted apart at once


# ---- mixing

def _targets(sizes, weights, most):
    """Share out, stop who is above, share the excess out again, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, got = Fraction(sum(sizes.values())), set(order), {}
    while open_:
        each = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = {s for s in open_ if each[s] > most * sizes[s]}
        if not above:
            return got | each
        for s in above:
            got[s] = Fraction(most * sizes[s])
            left -= got[s]
        open_ -= above
    return got


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 2, "c": 1000, None: 5}, {"Z": 0, "é": 7, "a": 3, "": 2, None: 900},
                                   {"only": 5}, {"a": 0, None: 0}])
def test_targets_equal_repeated_sharing(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(df, [5, 2, 1]).collect()}
    want = _targets(sizes, [5, 2, 1], 3)
    assert got.keys() == want.keys() and all(math.isclose(got[s], want[s], rel_tol=1e-12, abs_tol=1e-9) for s in want)
    if sum(sizes.values()):
        assert math.isclose(sum(got.values()), sum(sizes.values()))


def _mixed(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(["w"] * int(rng.lognormvariate(4, 1.2))), rng.choice(["a", "b", "b", "b", "c", None, "d"])) for i in range(1500)]
    rows += [(None, "", "b")] * 500 + [(9, "same text here", "b")] * 300 + [(None, None, None), (3, "w " * 9000, "a")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("old")).withColumn("copies", F.lit(0))


def test_systematic_copies(spark, monkeypatch):
    monkeypatch.setattr(common, "CHUNK", 64)  # repeated rows are unrolled in chunks
    rows, docs = _mixed(spark)
    got = mixing.plan(docs, [5, 2, 1]).collect()
    key = lambda i, t, s: (str(i), str(s), len(re.findall(r"[^\x20\x09-\x0D]+", t or "")))
    assert Counter((str(r.doc_id), str(r.source), r.size) for r in got) == Counter(key(*r) for r in rows)
    sizes = Counter()
    for i, t, s in rows:
        sizes[s] += key(i, t, s)[2]
    want = _targets(sizes, [5, 2, 1], 3)
    taken, largest = Counter(), Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, want[r.source], rel_tol=1e-9)
        ratio = r.target / r.source_size
        assert math.floor(ratio - 1e-5) <= r.copies <= math.ceil(ratio) <= 3
        taken[r.source] += r.copies * r.size
        largest[r.source] = max(largest[r.source], r.size)
    # classes differ by a factor of the square root of two: the error stays below the largest few documents
    assert all(abs(taken[s] - want[s]) <= 4 * largest[s] for s in sizes)
    of = lambda found: sorted(map(str, found))
    assert of(mixing.plan(docs.repartition(7), [5, 2, 1]).collect()) == of(got)
    assert of(mixing.plan(docs, [5, 2, 1], seed=2).collect()) != of(got)
    out = Counter((str(r.doc_id), str(r.source), r.text) for r in mixing.mix(docs, [5, 2, 1]).collect())
    emitted = Counter()
    for r in got:
        emitted[str(r.doc_id), str(r.source), r.size] += r.copies
    assert Counter({k: n for k, n in emitted.items() if n}) == sum(
        (Counter({(i, s, key(i, t, s)[2]): n}) for (i, s, t), n in out.items()), Counter())


def test_mixing_of_nothing(spark):
    _, docs = _mixed(spark)
    assert mixing.plan(docs.limit(0), [1]).isEmpty() and mixing.mix(docs.limit(0), [1]).isEmpty()
    empty = spark.createDataFrame([(1, None, "a"), (2, " \t", None)], "doc_id long, text string, source string")
    assert [(r.size, r.target, r.copies) for r in mixing.plan(empty, [5, 2, 1]).collect()] == [(0, 0.0, 0)] * 2
    with pytest.raises(ValueError):
        mixing.plan(docs, [1, 0])


def test_mixing_stays_in_the_engine(spark):
    _, docs = _mixed(spark)
    plan = mixing.plan(docs, [5, 2, 1])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_a_hot_row_is_dealt_out(spark):
    rows = spark.range(3).select(F.col("id"), F.when(F.col("id") == 1, 200_000).otherwise(2).cast("long").alias("n"))
    out = common.unrolled(rows, "n")
    per_task = [r[0] for r in out.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert sum(per_task) == 200_004 and max(per_task) <= 120_000
    assert out.filter("id = 1").agg(F.countDistinct("k"), F.min("k"), F.max("k")).first()[:] == (200_000, 0, 199_999)


# ---- resampling

def _features(text, low, high):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return len(w), [" ".join(w[i:i + k]).encode() for k in range(low, high + 1) for i in range(len(w) - k + 1)]


def _resample(docs, target, percent, least, seed, low, high, m):
    found = [(i, *_features(t, low, high)) for i, t in docs]
    s, t = (Counter(zlib.crc32(g) % m for f in fs for g in f) for fs in ([f for *_, f in found], [_features(x, low, high)[1] for x in target]))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + m) / ((s[b] + 1) * (t_all + m)))) for b in range(m)]
    rows = []
    for i, n, f in found:
        weight = sum(gain[zlib.crc32(g) % m] for g in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32)))])
    fit = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[1:]))
    k = percent * len(fit) // 100
    drawn = [(r[0], r[2], r[3], r[4], i) for i, r in enumerate(fit[:k], 1)]
    return drawn, [(r[0], r[2], r[3], r[4], None) for r in fit[k:] + [r for r in rows if r[1] < least]]


@pytest.mark.parametrize("percent,least,low,high,buckets", [(10, 20, 1, 1, 10_000), (50, 3, 1, 2, 50), (100, 0, 2, 3, 7), (0, 0, 1, 1, 9)])
def test_resample_brute_force(spark, percent, least, low, high, buckets):
    texts = _texts(8, 300)
    docs = list(enumerate(texts)) + [(None, t) for t in texts[:5]] + [(4, texts[4])] * 3 + [(None, None)] * 4 + [(900, "")]
    target = texts[::9] + [None, "the of the of"]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit("x")).withColumn("n", F.lit(1)).repartition(5)
    b = spark.createDataFrame([(t,) for t in target], "text string")
    got = [tuple(r) for r in resample.resample(d, b, percent, least, 2024, low, high, buckets).collect()]
    drawn, rest = _resample(docs, target, percent, least, 2024, low, high, buckets)
    assert sorted((r for r in got if r[4] is not None), key=lambda r: r[4]) == drawn
    assert sorted((r for r in got if r[4] is None), key=str) == sorted(rest, key=str)


def test_resample_of_nothing(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert resample.resample(d.limit(0), d.select("text")).isEmpty()
    assert [r.rank for r in resample.resample(d, d.select("text").limit(0), 100, 0).collect()] == [1]
    with pytest.raises(ValueError):
        resample.resample(d, d, low=2, high=1)


@pytest.mark.parametrize("different", [1, 3, 1 << 60])
def test_table_tells_equal_hashes_apart(monkeypatch, different):
    rng = random.Random(different)
    grams = [bytes(rng.choices(b"abc", k=rng.choice([1, 2, 7, 8, 9, 17, 40]))) for _ in range(2000)] + [b"a" * 300, b"a" * 301] * 3
    real = resample.xxhash.xxh64_intdigest
    monkeypatch.setattr(resample.xxhash, "xxh64_intdigest", lambda g: real(g) % different)
    few = grams[:150] + grams[-6:] if different < 10 else grams
    t = resample.Table(few, 11)
    assert {few[i]: t.count[s] for s, i in enumerate(t.owner) if i >= 0} == Counter(few)
    assert all(few[t.owner[s]] == g for g, s in zip(few, t.slots))
    gain = np.arange(11) - 5
    assert t.gather(gain).tolist() == [zlib.crc32(g) % 11 - 5 for g in few]
    assert t.by_bucket(11).tolist() == [Counter(zlib.crc32(g) % 11 for g in few)[b] for b in range(11)]
    assert resample.Table([], 5).by_bucket(5).tolist() == [0] * 5


@pytest.mark.parametrize("block", [1, 9, 50])
def test_features_across_blocks(monkeypatch, block):
    monkeypatch.setattr(resample, "BLOCK", block)
    texts = [t.encode() for t in _texts(6, 8)] + [None, b"", b"one", b"-- --"]
    got = defaultdict(Counter)
    words = Counter()
    for found, parts in resample._batches(texts, 1, 3):
        at = 0
        for i, n, k in parts:
            got[i].update(found[at:at + k])
            words[i] += n
            at += k
    for i, t in enumerate(texts):
        n, f = _features((t or b"").decode(), 1, 3)
        assert got[i] == Counter(f) and words[i] == n
