"""Classifiers, license join and language model: held-out accuracy or brute force."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import licenses, lm_score, quality, toxicity

SF = "/root/testdata/sf0.01"
ODD = [(1, None), (2, ""), (3, "   "), (None, "idiot"), (4, "x" * 200_000), (5, "same"), (5, "same"), (6, "!!! ???")]


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string").withColumn("label", F.lit(7)).withColumn("score", F.lit("s"))


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_quality_separates_held_out_rows(tables):
    docs, labels = tables
    ranker = quality.learn(docs, labels)
    got = {r.doc_id: r.score for r in quality.score(docs, ranker).collect()}
    rows = [(got[r.doc_id], r.quality) for r in labels.collect() if held(r.doc_id)]
    assert all(0 <= s <= 1 for s in got.values())
    right = [(s >= 0.3) == (q == 1) for s, q in rows]
    assert sum(right) / len(right) > 0.97
    kept = {r.doc_id for r in quality.keep(docs, ranker).collect()}
    assert kept == {i for i, s in got.items() if s >= 0.3}


def test_compressibility_reads_the_tail():
    at = [quality.FEATURES.index(k) for k in ("packed", "packed_low")]
    body, junk = np.random.default_rng(2).bytes(2048), b"z" * 1000
    plain, tail = quality.features(body), quality.features(body + junk)
    assert all(tail[k] < plain[k] - 0.2 for k in at)
    assert quality.features(b"ab")[at[0]] == quality.features(b"ab")[at[1]] > 0


def test_preference_pairs_order_scores():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 5))
    good = x @ np.array([1, -2, 0, 0, 0.5]) > -0.5
    r = quality.fit(x, good, (~good).mean(), 0.3, pairs=5000)
    s = r.scores(x)
    assert ((s >= 0.3) == good).mean() > 0.95
    # one more unit of margin, one more unit of log odds of being preferred
    assert np.all(np.diff(s[np.argsort(x @ r.w)]) >= 0)


def test_quality_defined_results(tables, odd):
    docs, labels = tables
    ranker = quality.learn(docs, labels)
    got = quality.score(odd, ranker).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    score = {r.doc_id: r.score for r in got}
    assert score[1] == score[2]
    assert quality.score(odd.limit(0), ranker).isEmpty()
    blank = quality.learn(docs, labels.filter("quality = 1"))
    assert {r.score for r in quality.score(odd, blank).collect()} == {0.3}
    assert quality.keep(odd, blank).count() == len(ODD)
    assert quality.learn(docs, labels.limit(0)).w.any() == False  # noqa: E712


def insulted(rng, words, insult):
    t = [rng.choice(words) for _ in range(30)]
    if insult:
        t.insert(rng.randint(0, 30), insult)
    return " ".join(t)


def test_toxicity_tolerates_gaps_and_insertions():
    rng = random.Random(9)
    syllables = ["er", "on", "tha", "re", "in", "li", "mo", "su", "da", "pe"]
    words = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(800)]
    insults = ["blockhead", "numskull", "dimwit", "vermin"]
    docs = [toxicity.units(insulted(rng, words, rng.choice(insults) if k % 3 == 0 else None).encode()) for k in range(900)]
    model = toxicity.fit(docs, np.array([k % 3 == 0 for k in range(900)]))

    def score(t):
        u = list(toxicity.units(t.encode()))
        return float(model.scores(model.margins(u)).max())

    for changed in ("blockhead", "block-head", "blo.ckhead", "numskulls", "n u m s k u l l", "numsskull", "verrmin", "dim-wit", "BLOCKHEAD!"):
        assert score(insulted(rng, words, changed)) > 0.5, changed
    clean = [score(insulted(rng, words, None)) for _ in range(200)]
    assert sum(s >= 0.5 for s in clean) <= 4


def test_toxicity_learns_from_every_window_of_a_long_word():
    """The insult lies 150 bytes into texts without white space, beyond any prefix."""
    rng = random.Random(5)
    syllables = ["er", "on", "tha", "re", "in", "li", "mo", "su", "da", "pe"]
    solid = lambda n: "".join(rng.choice(syllables) for _ in range(n))
    docs = [{(solid(80) + ("blockhead" if k % 3 == 0 else "") + solid(20)).encode()} for k in range(900)]
    model = toxicity.fit(docs, np.array([k % 3 == 0 for k in range(900)]))
    score = lambda t: float(model.scores(model.margins([t.encode()]))[0])
    bad = [score(solid(80) + "blockhead" + solid(20)) for _ in range(100)]
    clean = [score(solid(100)) for _ in range(100)]
    assert np.mean(bad) > np.mean(clean) + 0.3
    assert (toxicity.MAX_ROWS, toxicity.ROUNDS) == (4000, 4)


def test_toxicity_on_tables(tables, odd):
    docs, labels = tables
    model = toxicity.learn(docs, labels)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    rows = [(got[r.doc_id], r.toxic) for r in labels.collect() if held(r.doc_id)]
    good = [s for s, t in rows if not t]
    assert sum(s < 0.5 for s in good) / len(good) > 0.97
    bad = [s for s, t in rows if t]
    assert np.mean(bad) > np.mean(good) + 0.3
    r = toxicity.score(odd, model).collect()
    assert len(r) == len(ODD) and all(0 <= x.score <= 1 for x in r)
    assert next(x.score for x in r if x.doc_id is None) >= 0.5
    assert all(x.score < 0.5 for x in r if x.doc_id in (1, 2, 3, 5))
    assert toxicity.score(odd.limit(0), model).isEmpty()
    none = toxicity.learn(docs, labels.limit(0))
    assert all(x.score < 0.01 for x in toxicity.score(odd, none).collect())


def test_license_join_equals_brute_force(spark):
    rng = random.Random(4)
    bag = sorted({w.decode() for t in licenses.TEMPLATES.values() for w in licenses.words(t.encode())}) + ["other", "code"]
    rows = [(i, " ".join(rng.choice(bag) for _ in range(rng.randint(0, 300)))) for i in range(60)]
    rows += [(100 + k, "intro words " * rng.randint(0, 30) + t.upper() + " tail" * rng.randint(0, 50)) for k, t in enumerate(licenses.TEMPLATES.values())]
    for threshold in (0.5, 0.9, 1.0):
        want = set()
        for i, t in rows:
            w = licenses.words(t.encode())
            for b in range(max(1, -(-(len(w) - 32) // 32))):
                own = set(w[b * 32:b * 32 + 64])
                for label, x in licenses.TEMPLATES.items():
                    s = set(licenses.words(x.encode()))
                    if len(s & own) >= threshold * len(s) - 1e-9 and len(s & own):
                        want.add((i, b, label, len(s & own) / len(s)))
        got = {(r.doc_id, r.block, r.label, r.containment)
               for r in licenses.join(spark.createDataFrame(rows, "doc_id long, text string"), threshold=threshold).collect()}
        assert got == want
    assert {k - 100 for k, *_ in got if k >= 100} == set(range(len(licenses.TEMPLATES)))


def test_license_places(spark, odd):
    rows = [(1, "MIT License, mit license. The GNU GENERAL public\nlicense 3"), (2, "cc byx, cc  by-nc"), (3, "summit license")]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1].n_words, got[1].n_base, got[1].first_word, got[1].last_word, got[1].base_labels) == (10, 3, 0, 5, "gpl,mit")
    assert (got[2].n_base, got[2].first_word, got[2].base_labels) == (1, 2, "cc-by") and got[2].score == 1.0
    assert (got[3].n_base, got[3].first_word, got[3].labels, got[3].score) == (0, None, "", 0.0)
    r = licenses.scan(odd).collect()
    assert len(r) == len(ODD) and all(x.score == 0 for x in r)
    assert licenses.scan(odd.limit(0)).isEmpty()


def test_license_labels_stay_with_their_text(spark):
    bsd = licenses.TEMPLATES["bsd"]
    rows = [(1, bsd), (1, "plain text"), (None, bsd.upper()), (None, "other text"), (None, None), (1, bsd)]
    got = sorted((str(r.doc_id), r.n_words, r.labels, r.score) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    n = len(licenses.words(bsd.encode()))
    assert got == sorted([("1", n, "bsd", 1.0)] * 2 + [("1", 2, "", 0.0), ("None", n, "bsd", 1.0), ("None", 2, "", 0.0), ("None", 0, "", 0.0)])


def test_license_blocks_hold_the_longest_template(spark):
    body = " ".join(f"w{i}" for i in range(100))
    docs = spark.createDataFrame([(i, "x " * i + body) for i in range(0, 400, 37)], "doc_id long, text string")
    got = licenses.join(docs, {"body": body}, 1.0)
    assert {r.doc_id for r in got.collect()} == set(range(0, 400, 37))
    with pytest.raises(ValueError):
        licenses.join(docs, {"body": body}, 1.0, block=64)


def test_license_base_columns_equal_sql(spark):
    import duckdb
    sf = "/root/testdata/sf0.001"
    sql = f"""WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM '{sf}/documents.parquet'),
      p AS (SELECT unnest(['gnu general public license', 'apache license', 'cc by', 'mit license']) AS p, unnest(['gpl', 'apache', 'cc-by', 'mit']) AS label),
      m AS (SELECT doc_id, i, label FROM (SELECT doc_id, w, unnest(generate_series(0, len(w) - 1)) AS i FROM d WHERE len(w) > 0), p
        WHERE array_to_string(w[i + 1 : i + len(string_split(p, ' '))], ' ') = p)
      SELECT d.doc_id, len(w) AS n_words, count(i) AS n_base, min(i) AS first_word, max(i) AS last_word,
        coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS base_labels FROM d LEFT JOIN m USING (doc_id) GROUP BY d.doc_id, w"""
    want = sorted(duckdb.sql(sql.replace("\\\\", "\\")).fetchall())
    got = licenses.scan(spark.read.parquet(f"{sf}/documents.parquet"))
    assert sorted(map(tuple, got.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels").collect())) == want
    assert sum(r[2] for r in want) > 0


def test_many_license_phrases_in_a_long_text(spark):
    r = licenses.places(spark.createDataFrame([(1, "mit license x " * 100_000)], "doc_id long, text string")).first()
    assert (r.n_base, r.first_word, r.last_word) == (100_000, 0, 299_997)


def test_lattice_sums_every_segmentation():
    pieces = {"▁": math.log(.1), "▁a": math.log(.2), "a": math.log(.1), "b": math.log(.05), "ab": math.log(.2), "ba": math.log(.1)}
    lattice = lm_score.Lattice(pieces, math.log(.001))

    def every(s):
        if not s:
            return 1.0
        p = sum(math.exp(pieces[s[:k]]) * every(s[k:]) for k in range(1, len(s) + 1) if s[:k] in pieces)
        if s[0] not in pieces:
            p += .001 ** len(s[0].encode()) * every(s[1:])
        return p

    for w in ("abab", "a", "abcba", "é", "bbabaab"):
        assert math.isclose(lattice.log_p(w.encode()), math.log(every("▁" + w)), rel_tol=1e-9)
    many = [b"abab", b"a", b"abcba", "é".encode(), b"bbabaab", b"ab" * 50, b""] * 3
    assert np.allclose(lattice.log_ps(many), [lattice.log_p(w) for w in many], rtol=1e-9)
    one, all_ = {}, lattice.expected_uses(many, [2.0] * len(many))
    for w in many:
        lattice.expected(w, 2.0, one)
    assert one.keys() == all_.keys() and all(math.isclose(one[k], all_[k], rel_tol=1e-9) for k in one)
    used = {}
    lattice.expected(b"abcba", 3.0, used)
    # every segmentation spells the word: expected characters add up
    assert math.isclose(sum(n * len(p) for p, n in used.items() if p), 3.0 * 5)
    assert math.isclose(used[None], 3.0)


@pytest.mark.parametrize("head", [10, 100_000])
def test_lm_scores(spark, odd, head):
    import public_tokenizers
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    rows = docs.collect()
    split = lambda t: lm_score.words((t or "").encode())
    out = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    c, ends = Counter(), 0
    for r in rows:
        if not out(r.doc_id):
            c.update(split(r.text))
            ends += 1
    n, v = sum(c.values()) + ends, len(c) + 1
    want = sorted((str(r.doc_id), out(r.doc_id), len(split(r.text)) + 1, sum(c[w] > 0 for w in split(r.text)) + 1, n,
                   round(sum(math.log10((k + .1) / (n + .1 * (v + 1))) for k in [*(c[w] for w in split(r.text)), ends]), 5)) for r in rows)
    got = lm_score.score(docs, public_tokenizers.path("piece_bpe_32k.model"), head=head).collect()
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got) == want
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    by = {r.doc_id: r.score for r in got}
    assert by[1] == by[2] == by[3] > by[5]  # an end alone is likelier than a word and an end
    assert lm_score.score(odd.limit(0), public_tokenizers.path("piece_bpe_32k.model")).isEmpty()


def test_different_triples_equal_a_set_of_triples():
    rng = random.Random(9)
    for n, alphabet in ((3, 2), (50, 3), (2000, 5), (2000, 400)):
        w = [b"w%d" % rng.randrange(alphabet) for _ in range(n)]
        assert quality._different_triples(w) == len(set(zip(w, w[1:], w[2:])))


def ranked_pairs(x, good):
    """Newton's method on the listed pairs."""
    z = x / x.std(axis=0)
    diff = (z[good][:, None] - z[~good][None]).reshape(-1, x.shape[1])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(diff @ w))
        w += np.linalg.solve((diff * (p * (1 - p))[:, None]).T @ diff / len(diff) + quality.RIDGE * np.eye(len(w)),
                             diff.T @ p / len(diff) - quality.RIDGE * w)
    return w / x.std(axis=0)


def test_the_fit_takes_all_pairs():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 4)) * [1, 50, 0.01, 1] + [0, 900, 5, 0]
    s = x @ np.array([1, -0.02, 60, 0]) + rng.normal(size=300)
    good = s > np.quantile(s, 0.3)
    r = quality.fit(x, good, (~good).mean(), 0.3)
    assert np.allclose(r.w * x.std(axis=0), ranked_pairs(x, good) * x.std(axis=0), atol=1e-3)
    assert (r.scores(x) < 0.3).sum() == (~good).sum()


def test_quality_learns_from_every_labelled_row(spark):
    """More rows of a label than the 6,000 that were once the most."""
    rng = random.Random(6)
    rows = []
    for i in range(11_000):
        bad = rng.random() < 0.1
        words = ["".join(rng.choices("abcdefgh", k=rng.randint(1, 9))) for _ in range(rng.randint(3, 14))]
        rows.append((i, " ".join(w.upper() if rng.random() < (0.5 if bad else 0.2) else w for w in words), int(not bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int").repartition(3)
    ranker = quality.learn(docs.select("doc_id", "text"), docs.select("doc_id", "quality"))
    kept = [(quality.features(t.encode()), q == 1) for i, t, q in rows if not held(i)]
    x, good = np.array([v for v, _ in kept]), np.array([q for _, q in kept])
    assert good.sum() > 7000
    same = quality.fit(x, good, (~good).mean(), 0.3)
    assert np.allclose(ranker.w, same.w, rtol=1e-4, atol=1e-5) and abs(ranker.threshold - same.threshold) < 1e-3
    low = ranker.scores(x)
    assert (low < 0.3).sum() <= (~good).sum() <= (low <= 0.3 + 1e-9).sum()


@pytest.mark.parametrize("bad,good,share,want", [([1, 2], [3, 4, 5], 0.4, 2.5), ([-2, -1], [-1, 0.5], 0.5, -1.0), ([0.0], [-0.0, 7], 1 / 3, 0.0),
                                                 ([1, 5], [2, 3], 0.5, 2.5), ([3] * 4, [9], 0.8, 6.0)])
def test_threshold_is_an_exact_quantile(bad, good, share, want):
    x = np.array([*bad, *good], float)[:, None]
    rows = quality._Held(x, [0] * len(bad) + [1] * len(good))
    n = (len(bad), len(good))
    assert quality._threshold(rows.ordered(np.ones(1)), n, quality.Fraction(share).limit_denominator(100)) == want
