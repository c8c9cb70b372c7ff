"""Exact and near deduplication against brute force, and their defined results."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import exact_dedup as X
from strata.llm import simhash as S
from strata.llm.components import components

SF = "/root/testdata/sf0.001"
ODD = [(1, None, "a"), (2, "", "b"), (None, "", "c"), (5, "Aa", "d"), (5, "Aa", "d"), (4, "aa", "e"), (7, "x", "f"),
       (7, "y", "g"), (None, "zz", "h"), (None, "zz", "h"), (9, "é", "i"), (10, "É", "j"), (11, "w " * 60_000, "k")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    # extra columns with names that the operators use inside
    return spark.createDataFrame(ODD, "doc_id long, text string, keep_id string").withColumn("fp", F.lit(1)).withColumn("n", F.lit(2))


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def test_exact_decisions_match_grouping_by_text(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    groups = {}
    for i, t in rows:
        groups.setdefault(lower(t), []).append(i)
    want = {i: (max(groups[lower(t)]), len(groups[lower(t)]), i == max(groups[lower(t)])) for i, t in rows}
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in X.decide(docs).collect()}
    assert got == want


def test_colliding_hashes_are_told_apart_by_content(docs):
    a, b = X.decide(docs, bits=2), X.decide(docs)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_chunks_join_to_the_text_and_follow_content():
    rng = np.random.default_rng(3)
    body = bytes(rng.integers(97, 123, 100_000, np.uint8))
    for t in (b"", b"a", body, b"x" * 50_000):
        _, parts = X.chunks_of(t)
        assert b"".join(c for _, c in parts) == t
        assert all(len(c) <= X.LARGEST for _, c in parts)
        assert all(len(c) >= X.SMALLEST for _, c in parts[:-1])
    shifted = {c for _, c in X.chunks_of(b"inserted " + body)[1]}
    same = [c for _, c in X.chunks_of(body)[1] if c in shifted]
    assert len(same) > 0.8 * len(X.chunks_of(body)[1])


def test_exact_defined_results(odd):
    kept = X.decide(odd).filter("kept").collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.group_size) for r in kept) == sorted([
        (False, 2, 3), (False, 5, 3), (False, 7, 1), (False, 7, 1), (True, 0, 2), (False, 9, 1), (False, 10, 1), (False, 11, 1)])
    left = X.deduplicate(odd)
    assert left.columns == odd.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(["2", "5", "7", "7", "None", "9", "10", "11"])
    assert X.decide(odd.limit(0)).isEmpty() and X.deduplicate(odd.limit(0)).isEmpty()


def brute_components(fps, radius):
    parent = {f: f for f in fps}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    u = sorted(fps)
    for i, a in enumerate(u):
        for b in u[i + 1:]:
            if bin(a ^ b).count("1") <= radius:
                x, y = root(a), root(b)
                if x != y:
                    parent[max(x, y)] = min(x, y)
    return {f: root(f) for f in fps}


def test_fingerprint_bits_by_definition():
    import xxhash
    text = "The cat sat\ton  the mat the cat sat on"
    w = text.lower().split()
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i:i + 3]), 42) for i in range(len(w) - 2)]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert S.fingerprint(text.encode()) == want
    assert S.fingerprint(b"A b") == xxhash.xxh64_intdigest("a b", 42)
    assert S.fingerprint(None) == S.fingerprint(b" \n") == 0


def test_spark_hash_is_the_shingle_hash(spark):
    r = spark.range(1).select(F.xxhash64(F.lit("a b c")).alias("h")).first().h
    import xxhash
    assert r % (1 << 64) == xxhash.xxh64_intdigest("a b c", 42)


def test_clusters_match_brute_force(docs):
    got = S.cluster(docs).collect()
    root = brute_components({r.fp % (1 << 64) for r in got}, 3)
    low = {}
    for r in got:
        k = root[r.fp % (1 << 64)]
        low[k] = min(low.get(k, r.doc_id), r.doc_id)
    assert all(r.component_id == low[root[r.fp % (1 << 64)]] for r in got)
    assert len(got) == docs.count()


def test_crowded_cells_lose_no_link_and_make_no_pairs(spark):
    rng = np.random.default_rng(5)
    base = int(rng.integers(0, 1 << 62))
    fps = {base}
    while len(fps) < 400:  # a cloud around one value, which fills the same cells
        f = base
        for b in rng.choice(64, int(rng.integers(1, 7)), replace=False):
            f ^= 1 << int(b)
        fps.add(f)
    fps |= {int(x) for x in rng.integers(0, 1 << 62, 100)}
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    edges = S.links(spark.createDataFrame(signed, "fp long"), 3, tile=16)
    pairs = edges.collect()
    # a forest per tile: fewer edges than members
    assert len(pairs) < 10 * len(fps) * (400 // 16 + 1)
    found = {r.node % (1 << 64): r.root for r in components(edges).collect()}
    want = brute_components(fps, 3)
    groups = {}
    for f in fps:
        groups.setdefault(want[f], set()).add(f)
    for g in groups.values():
        if len(g) == 1:
            assert not g & found.keys()
        else:
            assert len({found[f] for f in g}) == 1
    assert len({found[f] for f in found}) == sum(len(g) > 1 for g in groups.values())


def test_pivot_discard_never_loses_a_pair():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 1 << 63, 300).astype(np.uint64)
    b = np.array([int(x) ^ sum(1 << int(k) for k in rng.choice(64, int(rng.integers(0, 6)), replace=False)) for x in a], np.uint64)
    refs = S.pivots()
    i, j = S.linked(a, b, S.pivot_table(a, refs), S.pivot_table(b, refs), 3)
    want = {(x, y) for x in range(300) for y in range(300) if bin(int(a[x]) ^ int(b[y])).count("1") <= 3}
    assert set(zip(i.tolist(), j.tolist())) == want


def test_near_defined_results(odd):
    got = S.cluster(odd).collect()
    assert len(got) == len(ODD)
    empty = {r.component_id for r in got if r.fp == 0}
    assert empty == {1}
    left = S.deduplicate(odd)
    assert left.columns == odd.columns
    ids = [r.doc_id for r in left.collect()]
    assert ids.count(1) == 1 and 2 not in ids and ids.count(5) <= 1
    assert S.cluster(odd.limit(0)).isEmpty() and S.deduplicate(odd.limit(0)).isEmpty()


def test_near_keeps_one_row_of_every_component(spark):
    """Null and repeated ids whose texts are unrelated are judged text by text."""
    text = lambda k: " ".join(f"w{k}x{j}" for j in range(60))
    rows = [(None, text(1)), (None, text(2)), (None, text(3)), (9, text(3)),  # a null id that links to 9
            (7, text(4)), (7, text(5)), (8, text(6)), (8, text(7)), (2, text(7)),  # one text of 8 is a copy of 2's
            (None, text(8)), (None, text(8)), (4, text(9)), (4, text(9))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("extra", F.lit("e"))
    left = S.deduplicate(docs)
    assert left.columns == docs.columns
    want = [(None, 1), (None, 2), (9, 3), (7, 4), (7, 5), (8, 6), (2, 7), (None, 8), (4, 9)]
    assert sorted(map(str, ((r.doc_id, r.text) for r in left.collect()))) == sorted(str((i, text(k))) for i, k in want)


def test_near_defined_results_keep_unrelated_rows(odd):
    """Of ODD, rows that share an id but no component stay apart."""
    got = sorted((str(r.doc_id), r.text or "") for r in S.deduplicate(odd).collect())
    fps = {(i, t): S.fingerprint((t or "").encode()) for i, t, *_ in ODD}
    root = brute_components(set(fps.values()), 3)
    assert len(got) == len({root[f] for f in fps.values()})


def test_components_of_a_long_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    hub = [(1, i) for i in range(1000, 1400)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain + hub + [(7, 7)], "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 1 for i in [1, *range(1000, 1400)]}}


def test_a_row_repeated_very_often(spark):
    from pyspark.sql import functions as F

    from strata.llm import exact_dedup
    docs = spark.range(30_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("").alias("text")).unionByName(
        spark.createDataFrame([(1, "A"), (2, "a"), (2, "b")], "doc_id long, text string"))
    out = exact_dedup.decide(docs)
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept): r["count"] for r in out.groupBy("doc_id", "keep_id", "group_size", "kept").count().collect()}
    assert got == {(None, None, 30_000, True): 1, (None, None, 30_000, False): 29_999, (1, 2, 2, False): 1, (2, 2, 2, True): 1, (2, 2, 1, True): 1}
    per_task = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert max(per_task) <= 20_000
