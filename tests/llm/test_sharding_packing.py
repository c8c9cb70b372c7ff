"""Sharding, packing and token counts: invariants, round trips, brute force."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import packing, sharding, token_counts
from strata.llm.common import number_within
from strata.llm.tokenise import WordIds, word_vocabulary

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(word_vocabulary())


ODD = ["", None, "it's I'M a<|endoftext|>b", "Áb ́c don't. x., ÉCOLE ß. a.b,, ①", "<|ENDOFTEXT|> <|startoftext|>x",
       "a\x1cb\x0bc\x85d e", "Σας ΟΔΟΣ. İi̇ ﬁ Å", "word " * 9000, "z" * 30_000]


def test_word_cache_equals_whole_text(tokenizer):
    got = WordIds(word_vocabulary()).encode([None if t is None else t.encode() for t in ODD])
    want = [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch([t or "" for t in ODD], add_special_tokens=False)]
    assert got == want


@pytest.mark.parametrize("cache", [40, 100_000])
def test_word_cache_on_random_words(tokenizer, cache):
    rng = random.Random(cache)
    parts = ["an", "der", "é", "À", "ß", "ÿ", "×", "İ", "ő", "s", "'", "'s", ".", ",", "...", "%%%", "-", "3", "—", "́", "日", "<|", "|>", "<"]
    for literal in (False, True):
        own = parts if literal else parts[:-3]  # texts that may name a special token go whole
        texts = [" ".join("".join(rng.choices(own, k=rng.randint(1, 5))) for _ in range(300)) for _ in range(40)]
        ids = WordIds(word_vocabulary(), literal, cache)
        tokenizer.encode_special_tokens = literal
        for at in range(0, 40, 4):
            want = [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch(texts[at:at + 4], add_special_tokens=False)]
            assert ids.encode([t.encode() for t in texts[at:at + 4]]) == want
        assert ids.agree
    tokenizer.encode_special_tokens = False


def test_growing_moves_rows_into_the_new_shard_only(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    rows = sharding.assign(docs, [1.0] * 10, grown_weight=1.0).collect()
    again = {r.doc_id: r.shard for r in sharding.assign(docs, [1.0] * 11).collect()}
    assert all(r.grown_shard in (r.shard, 10) and again[r.doc_id] == r.grown_shard for r in rows)
    moved = sum(r.grown_shard == 10 for r in rows)
    assert 4000 / 11 * 0.75 < moved < 4000 / 11 * 1.25
    n = Counter(r.shard for r in rows)
    assert set(n) == set(range(10)) and max(n.values()) < 1.3 * 400


def test_weights_are_shares_of_keys(spark):
    docs = spark.range(8000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    n = Counter(r.shard for r in sharding.assign(docs, [1.0, 3.0, 4.0]).collect())
    assert all(abs(n[i] / 8000 - w / 8) < 0.03 for i, w in enumerate([1, 3, 4]))
    with pytest.raises(ValueError):
        sharding.assign(docs, [1.0, 0.0])


def test_sharding_odd_rows(spark):
    docs = spark.createDataFrame([(None, f"t{i}") for i in range(200)] + [(1, None), (1, "x"), (1, "x")],
                                 "doc_id long, text string").withColumn("shard", F.lit("old"))
    rows = sharding.assign(docs, [1.0] * 4).collect()
    assert len(rows) == 203 and len({r.shard for r in rows if r.doc_id is None}) == 4
    assert len({r.shard for r in rows if r.doc_id == 1}) == 1
    assert sharding.assign(docs.limit(0), [1.0]).isEmpty()
    plan = sharding.assign(docs, [1.0] * 4)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_numbers_have_no_gap_in_a_hot_group(spark):
    rows = spark.range(1000).select((F.col("id") % 7 == 0).cast("int").alias("g"), (F.col("id") % 300).alias("k"))
    got = defaultdict(list)
    for r in number_within(rows, ["g"], ["k"], "slot", 5).collect():
        got[r.g].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in got.values())


@pytest.mark.parametrize("capacity,n,seed", [(50, 400, 1), (4096, 3000, 2), (7, 100, 3), (1, 5, 4)])
def test_plan_places_everything_without_overlap(capacity, n, seed):
    rng = random.Random(seed)
    counts = Counter(min(capacity, int(rng.lognormvariate(0.55 * np.log(capacity), 1.2)) + 1) for _ in range(n))
    placed, seen = defaultdict(list), Counter()
    for a, first, k, sequence, offset in packing.plan(counts, capacity):
        assert first == seen[a]
        seen[a] += k
        for j in range(k):
            placed[sequence + j].append((offset, a))
    assert seen == counts
    for v in placed.values():
        at = 0
        for offset, a in sorted(v):
            assert offset == at
            at += a
        assert at <= capacity
        assert sum(3 * a > capacity for _, a in v) <= 2
    total = sum(a * c for a, c in counts.items())
    larger = sum(c for a, c in counts.items() if 2 * a > capacity)
    assert len(placed) <= 1.25 * max(-(-total // capacity), larger) + 1


def test_packing_round_trip(spark, tokenizer):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(ODD)] + [(20_000, "same"), (20_000, "same")], "doc_id long, text string")
    every = docs.unionByName(odd).withColumn("length", F.lit("old")).withColumn("piece", F.lit(0))
    rows = packing.pack(every, word_vocabulary(), 512).collect()
    texts = defaultdict(list)
    for r in every.collect():
        texts[r.doc_id].append(r.text or "")
    by = defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    assert by.keys() == texts.keys()
    for i, t in texts.items():
        ids = tokenizer.encode(t[0], add_special_tokens=False).ids + [1]
        want = [(k, at, len(ids[at:at + 512]), zlib.crc32(np.array(ids[at:at + 512], "<u4").tobytes()))
                for k, at in enumerate(range(0, len(ids), 512))] * len(t)
        assert sorted((r.piece, r.start, r.length, r.ids_crc32) for r in by[i]) == sorted(want)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for v in sequences.values():
        at = 0
        for offset, n in sorted(v):
            assert offset == at
            at += n
        assert at <= 512
    assert len(sequences) <= 1.03 * sum(r.length for r in rows) / 512 + 1
    assert packing.pack(docs.limit(0), word_vocabulary()).isEmpty()


def test_token_counts(spark, tokenizer):
    odd = spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(ODD)] + [(None, "x"), (5, "y"), (5, "y")], "doc_id long, text string")
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(odd).withColumn("file", F.lit("f"))
    tokenizer.encode_special_tokens = True
    want = sorted(((r.doc_id, len(tokenizer.encode(r.text or "", add_special_tokens=False).ids)) for r in docs.collect()), key=str)
    tokenizer.encode_special_tokens = False
    got = sorted(((r.doc_id, r.n_tokens) for r in token_counts.count(docs, word_vocabulary(), 49407).collect()), key=str)
    assert got == want
    assert token_counts.count(docs.limit(0), word_vocabulary(), 49407).isEmpty()


@pytest.mark.parametrize("block,group", [(1, 1), (3, 2), (4, 3), (64, 1024)])
def test_stitching_across_blocks(spark, tmp, block, group):
    rng = random.Random(block)
    files = {"a": [rng.choice([0, 1, 2, 9]) for _ in range(57)], "b": [1] * 20, "c": [9] * 7, "d": [], "e": [1, 2, 9, 3], "f": [9, 1, 1, 1, 1, 1, 1, 9]}
    for name, ids in files.items():
        np.array(ids, "<u2").tofile(f"{tmp}/{name}.tokens")
    want = []
    for name, ids in files.items():
        start = k = 0
        for i, t in enumerate(ids):
            if t == 9:
                want.append((f"{name}.tokens", k, start, i - start, True))
                start, k = i + 1, k + 1
        if start < len(ids):
            want.append((f"{name}.tokens", k, start, len(ids) - start, False))
    blocks = token_counts.scan_blocks(token_counts.list_files(spark, tmp), 9, block).cache()
    got = sorted(tuple(r) for r in token_counts.stitch(blocks, block, group).collect())
    assert got == sorted(want)


def test_texts_over_several_blocks(spark):
    docs = spark.createDataFrame([(1, "word " * 500), (2, None), (3, "a b c"), (4, "word " * 64)], "doc_id long, text string")
    got = token_counts.count(docs.coalesce(1), word_vocabulary(), 49407, block_tokens=64)
    assert sorted(map(tuple, got.collect())) == [(1, 500), (2, 0), (3, 3), (4, 64)]


def test_token_ids_that_do_not_fit(spark):
    docs = spark.createDataFrame([(1, "word")], "doc_id long, text string")
    with pytest.raises(ValueError):
        token_counts.count(docs, word_vocabulary(), 70_000)
    own = WordIds(word_vocabulary()).encode([b"word"])[0]
    with pytest.raises(Exception, match="the end id itself"):
        token_counts.count(docs, word_vocabulary(), int.from_bytes(own, "little")).collect()
