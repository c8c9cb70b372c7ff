"""License scan: phrases in place, and an exact set-similarity join with templates.

A text's words are cut into blocks of ``BLOCK`` words that overlap by half, so
that any stretch of ``BLOCK // 2`` words lies whole in one.  A block matches a
template if it holds at least ``threshold`` of the template's distinct words.
The join finds every such pair without comparing all of them:

* words are ordered by how often they occur in the whole corpus, rarest first;
* *prefix*: a match shares ``a = ceil(threshold * |T|)`` words, so one of the
  first ``|T| - a + 1`` words of the template is among the first ``|B| - a + 1`` of the block;
* *length*: the block has at least ``a`` template words;
* *position*: what follows the two places of that word must suffice to reach ``a``;
* the pairs left are verified by intersecting the two sets.

Words that no template has can't add to an overlap and are left out of the
blocks beforehand.  Templates are a fixed list, so their prefix table is small
by construction and broadcast; blocks are not shuffled.

Blocks are at least twice as long as the longest template, else a template could lie
across two of them; a shorter block is refused.

Defined results: a null or word-less text has no block, no place and score 0;
rows with equal ids, or none, are told apart by their text; equal rows get equal results, one each.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD_BYTES, map_rows, materialise, text_of

BLOCK, THRESHOLD = 64, 0.9

# Phrases whose places are reported, with their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Opening words of public license notices.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
           "that the following conditions are met",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "gpl-notice": "This work is licensed under the GNU General Public License, version",
    "isc": "Permission to use, copy, modify, and or distribute this software for any purpose with or without fee is "
           "hereby granted",
    "mit-notice": "Released under the MIT License",
    "mit-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
                      "and associated documentation files",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
}


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(WORD_BYTES).split()


def _slim(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text, text_hash): the hash tells rows with equal ids apart."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.xxhash64(text_of(text_col)).alias("text_hash"))


def places(docs: DataFrame, phrases: dict[str, str] = PHRASES, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, n_words, n_base, first_word, last_word, base_labels: where phrases stand."""
    wanted = [(b" " + p.encode() + b" ", label) for p, label in phrases.items()]

    def run(cols):
        out: dict = {n: [] for n in ("doc_id", "text_hash", "n_words", "n_base", "first_word", "last_word", "base_labels")}
        for i, key, t in zip(cols["doc_id"], cols["text_hash"], cols["text"]):
            w = words(t)
            line = b" " + b" ".join(w) + b" "
            starts, labels = [], set()
            for phrase, label in wanted:
                at, seen, number = line.find(phrase), 0, 0
                while at >= 0:
                    number += line.count(b" ", seen, at)  # spaces before a word's own: its number
                    seen = at
                    starts.append(number)
                    labels.add(label)
                    at = line.find(phrase, at + 1)
            for n, v in zip(out, (i, key, len(w), len(starts), min(starts, default=None), max(starts, default=None), sorted(labels))):
                out[n].append(v)
        return out

    return map_rows(_slim(docs, id_col, text_col), run,
                    "doc_id long, text_hash long, n_words long, n_base long, first_word long, last_word long, base_labels array<string>")


def word_order(docs: DataFrame, vocabulary: set[str], text_col: str = "text") -> dict[str, int]:
    """Rank of each word of ``vocabulary`` (a fixed, small set): rarest in the corpus first."""
    wanted = {w.encode() for w in vocabulary}

    def run(cols):
        met = Counter()
        for t in cols["text"]:
            met.update(w for w in words(t) if w in wanted)
        return {"word": [w.decode() for w in met], "n": list(met.values())}

    slim = docs.select(F.col(text_col).cast("string").alias("text"))
    rows = map_rows(slim, run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    met = {r["word"]: r["n"] for r in rows}
    return {w: k for k, w in enumerate(sorted(vocabulary, key=lambda w: (met.get(w, 0), w)))}


def join(docs: DataFrame, templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD,
         block: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, block, first_word, label, containment) of every matching block and template."""
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be above 0 and at most 1")
    longest = max(len(words(t.encode())) for t in templates.values())
    block = max(BLOCK, 2 * longest) if block is None else block
    if block < 2 * longest:
        raise ValueError(f"a template of {longest} words needs blocks of {2 * longest}")
    spark = docs.sparkSession
    sets = {label: {w.decode() for w in words(t.encode())} for label, t in templates.items()}
    rank = word_order(docs, set().union(*sets.values()), text_col)
    prefix = []
    for label, s in sets.items():
        order, need = sorted(rank[w] for w in s), math.ceil(threshold * len(s) - 1e-9)
        prefix += [(r, k, len(order), need, order, label) for k, r in enumerate(order[:len(order) - need + 1])]
    table = spark.createDataFrame(prefix, "token int, at int, t_size int, need int, t_tokens array<int>, label string")
    least, probing = min(p[3] for p in prefix), {p[0] for p in prefix}
    ranks = {w.encode(): r for w, r in rank.items()}
    stride = block // 2

    def run(cols):
        out: dict = {n: [] for n in ("doc_id", "text_hash", "block", "token", "place", "tokens")}
        for i, key, t in zip(cols["doc_id"], cols["text_hash"], cols["text"]):
            w = words(t)
            where = [k for k, x in enumerate(w) if x in ranks]
            hit = [ranks[w[k]] for k in where]
            if len(hit) < least or probing.isdisjoint(hit):
                continue
            for b in range(max(1, -(-(len(w) - stride) // stride))):
                lo, hi = bisect_left(where, b * stride), bisect_left(where, b * stride + block)
                own = sorted(set(hit[lo:hi]))
                for place, r in enumerate(own[:max(0, len(own) - least + 1)]):
                    if r in probing:
                        for n, v in zip(out, (i, key, b, r, place, own)):
                            out[n].append(v)
        return out

    probes = map_rows(_slim(docs, id_col, text_col), run, "doc_id long, text_hash long, block long, token int, place int, tokens array<int>")
    p, size = probes.join(F.broadcast(table), "token"), F.size("tokens")
    rest = F.least(size - F.col("place"), F.col("t_size") - F.col("at"))
    met = p.filter((size >= F.col("need")) & (F.col("place") <= size - F.col("need")) & (rest >= F.col("need")))
    shared = F.size(F.array_intersect("tokens", "t_tokens"))
    return (met.withColumn("shared", shared).filter("shared >= need")
            .select("doc_id", "text_hash", "block", (F.col("block") * stride).alias("first_word"), "label",
                    (F.col("shared") / F.col("t_size")).alias("containment")).distinct())


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """:func:`places` with the labels of both ways and a score: 1 for a phrase in place,
    else the best containment of a matching block, else 0."""
    met = join(docs, templates, threshold, None, id_col, text_col)
    # a document has at most as many labels as there are templates
    per = materialise(met.groupBy("doc_id", "text_hash").agg(F.collect_set("label").alias("more"), F.max("containment").alias("best")), "labels")
    found = places(docs, id_col=id_col, text_col=text_col).alias("p")
    m = per.alias("m")
    out = found.join(m, F.col("p.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.col("p.text_hash") == F.col("m.text_hash")), "left")
    none = F.array().cast("array<string>")
    return out.select(
        "p.doc_id", "n_words", "n_base", "first_word", "last_word", F.concat_ws(",", "base_labels").alias("base_labels"),
        F.concat_ws(",", F.sort_array(F.array_union("base_labels", F.coalesce("more", none)))).alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"))
