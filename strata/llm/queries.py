"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.tables import table
from . import (decontaminate, exact_dedup, licenses, lm_score, mixing, packing, phrases, quality, resample, sharding,
               simhash, token_counts, toxicity)
from .common import held_out, materialise, number_within, text_of
from .tokenise import word_vocabulary

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}

SHARDS = 40


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _classified(scored: DataFrame, cut: float) -> DataFrame:
    return scored.select("doc_id", held_out("doc_id", 5).alias("held_out"), "score",
                         (F.col("score") >= cut).cast("int").alias("predicted"))


@register("op1_toxicity")
def op1(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    model = toxicity.learn(docs, table(spark, d, "labels"), "toxic", folds=5)
    return _classified(toxicity.score(docs, model), 0.5)


@register("op2_license_scan")
def op2(spark: SparkSession, d: str) -> DataFrame:
    return licenses.scan(table(spark, d, "documents"))


@register("op3_quality_classifier")
def op3(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    x = materialise(quality.vectors(docs), "vectors")
    ranker = quality.learn_vectors(x, table(spark, d, "labels"), "quality", folds=5, cut=0.3)
    return _classified(quality.score_vectors(x, ranker), ranker.cut)


@register("op4_benchmark_decontamination", f"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORD}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORD}') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[j + 1 : j + n], ' ') AS g
  FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(generate_series(0, len(w) - least(10, len(w)))) AS j FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, i, n, array_to_string(w[i + 1 : i + n], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(generate_series(0, len(w) - n)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
m AS (SELECT doc_id, i, n, item_id FROM dw JOIN bw USING (n, g)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM m) GROUP BY doc_id),
ids AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS s
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN ids USING (doc_id)""")
def op4(spark: SparkSession, d: str) -> DataFrame:
    out = decontaminate.report(table(spark, d, "documents"), table(spark, d, "benchmark"), window=10)
    return out.select("doc_id", "n_words", "n_hit", "n_items",
                      F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), "contaminated")


@register("op5_simhash_near_dedup")
def op5(spark: SparkSession, d: str) -> DataFrame:
    out = simhash.cluster(table(spark, d, "documents"), shingle=3, radius=3)
    return out.select("doc_id", simhash.hex_digits().alias("fingerprint"), "component_id")


@register("op6_token_counts")
def op6(spark: SparkSession, d: str) -> DataFrame:
    return token_counts.count(table(spark, d, "documents"), word_vocabulary(), end_id=49407)


@register("op7_best_fit_packing")
def op7(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(table(spark, d, "documents"), word_vocabulary(), capacity=4096, end_id=1)


@register("op8_lm_scoring")
def op8(spark: SparkSession, d: str) -> DataFrame:
    import public_tokenizers
    return lm_score.score(table(spark, d, "documents"), public_tokenizers.path("piece_bpe_32k.model"), folds=10)


@register("op9_sharding")
def op9(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    placed = sharding.assign(docs, [1.0] * SHARDS, grown_weight=1.0).select(
        "doc_id", (F.octet_length(text_of()) + 16).cast("long").alias("size"),
        F.crc32(text_of().cast("binary")).alias("text_crc32"), F.lit("key").alias("law"), "shard", "grown_shard")
    return number_within(materialise(placed, "placed"), ["shard"], ["doc_id", "text_crc32", "size"])


@register("op10_exact_dedup", f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g USING (t)""")
def op10(spark: SparkSession, d: str) -> DataFrame:
    return exact_dedup.decide(table(spark, d, "documents"))


def _runs(k: int) -> str:
    """Every run of k words of a piece, from the pieces' word lists ``p``."""
    return (f"SELECT lang, {k} AS m, array_to_string(w[i : i + {k - 1}], ' ') AS phrase FROM "
            f"(SELECT lang, w, unnest(generate_series(1, len(w) - {k - 1})) AS i FROM p WHERE len(w) >= {k})")


@register("op11_phrase_collocations", f"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS t FROM documents),
p AS (SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM t),
sizes AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang),
f AS (SELECT lang, m, phrase, count(*) AS a FROM ({" UNION ALL ".join(_runs(k) for k in range(1, 5))}) GROUP BY lang, m, phrase HAVING count(*) >= 30),
c AS (SELECT lang, m, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE m > 1),
inner_runs AS (SELECT lang, a, array_to_string(w[i : i + k - 1], ' ') AS phrase FROM
  (SELECT lang, a, w, k, unnest(generate_series(1, m - k + 1)) AS i FROM (SELECT *, unnest(generate_series(2, m - 1)) AS k FROM c WHERE m > 2))),
longer AS (SELECT lang, phrase, max(a) AS longer FROM inner_runs GROUP BY lang, phrase),
kept AS (SELECT c.* FROM c LEFT JOIN longer USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 80 * a),
cuts AS (SELECT lang, phrase, a, k, array_to_string(w[1 : k], ' ') AS first, array_to_string(w[k + 1 : m], ' ') AS rest
  FROM (SELECT *, unnest(generate_series(1, m - 1)) AS k FROM kept)),
scored AS (SELECT cuts.lang, cuts.phrase, cuts.a, k, x.a AS l, y.a AS r, CAST((CAST(cuts.a AS HUGEINT) * 2000000) // (x.a + y.a) AS BIGINT) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = first JOIN f y ON y.lang = cuts.lang AND y.phrase = rest),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000""")
def op11(spark: SparkSession, d: str) -> DataFrame:
    return phrases.collocations(table(spark, d, "documents"), support=30, longest=4, inside=80, top=2000)


@register("op12_mixing")
def op12(spark: SparkSession, d: str) -> DataFrame:
    taken = mixing.plan(table(spark, d, "documents"), [5, 2, 1], most=3.0)
    return taken.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


@register("op13_importance_resampling")
def op13(spark: SparkSession, d: str) -> DataFrame:
    return resample.resample(table(spark, d, "documents"), table(spark, d, "benchmark"), percent=10, least_words=20, seed=2024,
                             low=1, high=1, buckets=10_000)
