"""Winnowing against every window by brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from strata.llm import decontaminate as D

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items, window):
    wins = {}
    for i, t in items:
        w = words(t)
        n = min(window, len(w))
        for j in range(len(w) - n + 1 if w else 0):
            wins.setdefault(tuple(w[j:j + n]), set()).add(str(i))
    out = []
    for d, t in docs:
        w, hit, ids = words(t), set(), set()
        for n in {len(x) for x in wins}:
            for j in range(len(w) - n + 1):
                if g := wins.get(tuple(w[j:j + n])):
                    ids |= g
                    hit.update(range(j, j + n))
        out.append((d, len(w), len(hit), sorted(ids)))
    return sorted(out, key=str)


def report(docs, items, **k):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.item_ids) for r in D.report(docs, items, **k).collect()), key=str)


def test_sf_tables(spark):
    docs, items = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    assert report(docs, items) == brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()], 10)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("rows", [1_000_000, 0])  # 0: nothing is broadcast
def test_random_texts_with_many_repeats(spark, monkeypatch, seed, rows):
    monkeypatch.setattr(D, "BROADCAST_ROWS", rows)
    rng = random.Random(seed)
    text = lambda n: " ".join(rng.choice(["a", "b", "É", "D7"]) for _ in range(n))
    items = [(i, text(n)) for i, n in enumerate([0, 1, 2, 3, 6, 9, 10, 11, 25])]
    docs = [(i, text(rng.randint(0, 40)) + rng.choice(["", ". " + items[8][1].upper().replace("É", "É"), "-" + items[7][1]])) for i in range(40)]
    docs += [(100, "a " * 300)]
    items += [(50, "a " * 20)]
    got = report(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert got == brute(docs, items, 10)


def test_defined_results(spark):
    passage = " ".join(f"w{i}" for i in range(12))
    rows = [(1, None), (2, ""), (3, passage), (3, passage), (None, "x " + passage), (4, "W0 " * 9), (3, "other")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("item_id", F.lit(1)).withColumn("n", F.lit("n"))
    items = spark.createDataFrame([(1, passage), (2, None), (None, "!!")], "item_id long, text string")
    got = D.report(docs, items).collect()
    assert sorted((str(r.doc_id), r.n_hit, r.contaminated) for r in got) == sorted(
        [("1", 0, False), ("2", 0, False), ("3", 12, True), ("3", 12, True), ("None", 12, True), ("4", 0, False), ("3", 0, False)])
    left = D.decontaminate(docs, items)
    assert left.columns == docs.columns
    assert sorted((r.doc_id, r.text or "") for r in left.collect()) == [(1, ""), (2, ""), (3, "other"), (4, "W0 " * 9)]
    assert D.report(docs.limit(0), items).isEmpty()
    assert D.report(docs, items.limit(0)).filter("contaminated").isEmpty()


@pytest.mark.parametrize("rows", [1_000_000, 0])
def test_items_without_id_count(spark, monkeypatch, rows):
    monkeypatch.setattr(D, "BROADCAST_ROWS", rows)
    one, two, three = (" ".join(f"{c}{i}" for i in range(12)) for c in "abc")
    docs = spark.createDataFrame([(1, "x " + one), (2, f"{two} y {three}"), (3, "z"), (4, f"{one} {two}"), (5, "tiny bit")],
                                 "doc_id long, text string")
    # item 1 has two texts; a null id names a long item twice and a short one
    items = spark.createDataFrame([(None, one), (None, one), (1, two), (1, three), (None, "bit"), (None, "!!")],
                                  "item_id long, text string")
    got = {r.doc_id: (r.n_hit, r.n_items, r.item_ids, r.contaminated) for r in D.report(docs, items).collect()}
    assert got == {1: (12, 1, [], True), 2: (24, 1, ["1"], True), 3: (0, 0, [], False), 4: (24, 2, ["1"], True), 5: (1, 1, [], True)}
    assert [r.doc_id for r in D.decontaminate(docs, items).collect()] == [3]


def test_winnowing_guarantee(spark):
    """Any run of `window` k-grams keeps at least one."""
    df = spark.createDataFrame([(" ".join(random.Random(4).choice("abcde") for _ in range(200)).split(),)], "w array<string>")
    kept = [p.pos for p in D.winnowed(df, "w", 10, 5).first().kept]
    assert all(any(i <= p < i + 6 for p in kept) for i in range(200 - 5 + 1 - 6 + 1))


def test_no_python_in_the_plan(spark):
    docs, items = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    plan = D.report(docs, items)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_periodic_texts(spark, seed):
    """Windows that come again in the same item are marked once; nothing is lost by that."""
    rng = random.Random(seed)
    units = ["a", "a b", "a b c", "a a b", "a b a c"]
    items = [(i, " ".join([rng.choice(units)] * rng.randint(4, 9) + rng.choices("abcx", k=rng.randint(0, 8)) + [rng.choice(units)] * rng.randint(0, 6)))
             for i in range(6)]
    docs = [(i, " ".join(rng.choices("abcxy", k=rng.randint(0, 9)) + [rng.choice(units)] * rng.randint(0, 20) + rng.choices("abcx", k=rng.randint(0, 9))
                         + [rng.choice(units)] * rng.randint(0, 9))) for i in range(30)]
    got = report(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert got == brute(docs, items, 10)


def test_equal_words_do_not_multiply(spark):
    docs = spark.createDataFrame([(1, "a " * 50_000), (2, "a b " * 2_000), (3, "a " * 9)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a " * 400), (2, "b a " * 200)], "item_id long, text string")
    held = D._items(items, "item_id", "text", 10)
    assert D._marks(held, 10, 5).count() == 3  # one window of the first item, two of the second
    got = {r.doc_id: (r.n_hit, r.item_ids) for r in D.report(docs, items).collect()}
    assert got == {1: (50_000, ["1"]), 2: (4_000, ["2"]), 3: (0, [])}
