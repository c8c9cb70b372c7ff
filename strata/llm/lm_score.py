"""Language-model scores: the likelihood of a text over all its segmentations.

The vocabulary is that of a public subword tokenizer, whose scores rank its
pieces.  They give the prior (``log p`` falls with the logarithm of the rank); one round of
expectation over the training words re-weighs the pieces by how often
the corpus uses them.  A word's probability is the sum over every way to cut it into
pieces, by forward recursion in log space; bytes stand in for characters that
no piece covers, so every word has one.  Pieces don't cross words, so a
document's marginal is the product of its words' and of one end per text.

What is learned grows with the corpus: the table of all distinct words with
their training counts and log likelihoods.  It is never collected.  Its ``HEAD``
most frequent words of at most 64 bytes, a bounded table, go to every task;
the other words of a document join the table by shuffle.  Those are all
rarer than the head, so no key of that join is hot.

Defined results: a null or empty text is its end alone; with no training row
counts are 0 and the pieces keep their prior.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ASCII_LOWER, held_out, map_rows, materialise

HEAD, HEAD_BYTES, SMOOTH, LN10 = 100_000, 64, 0.1, math.log(10)
LONG, CELLS = 64, 60_000
_MARK = "▁"


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(ASCII_LOWER).split()


def prior(model: str) -> tuple[dict[str, float], float]:
    """Natural-log probabilities of a sentencepiece model's pieces, from the ranks
    that its scores give, and of any single byte."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    pieces = {sp.id_to_piece(i): sp.get_score(i) for i in range(sp.get_piece_size())
              if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))}
    # pieces with a word mark inside never match a single word
    ranked = {p: 1.0 - s for p, s in pieces.items() if _MARK not in p[1:] and s > -1e6}
    norm = math.log(sum(1 / r for r in ranked.values()) * 1.01)  # the rest is shared by the 256 bytes
    return {p: -math.log(r) - norm for p, r in ranked.items()}, math.log(0.01 / 1.01 / 256)


class Lattice:
    """One word at a time; :class:`Trie` does the same for many words of a length."""

    def __init__(self, pieces: dict[str, float], byte: float):
        self.pieces, self.byte = pieces, byte
        self.longest = max(map(len, pieces), default=1)
        self._trie = None

    def __getstate__(self):
        return self.pieces, self.byte, self.longest

    def __setstate__(self, state):
        self.pieces, self.byte, self.longest = state
        self._trie = None

    @property
    def trie(self) -> Trie:
        if self._trie is None:
            self._trie = Trie(self.pieces, self.byte)
        return self._trie

    def log_ps(self, words: list[bytes]) -> list[float]:
        """:meth:`log_p` of many words."""
        out = [0.0] * len(words)
        for places, codes, sizes in batches(words):
            if codes is None:
                for k in places:
                    out[k] = self.log_p(words[k])
            else:
                a, _ = self.trie.forward(codes, sizes)
                for k, v in zip(places, a[:, -1].tolist()):
                    out[k] = v
        return out

    def expected_uses(self, words: list[bytes], counts: list[float]) -> dict:
        """Expected uses of each piece in all words, each as often as counted."""
        total: dict = {}
        sums = np.zeros(len(self.trie.names) + 1)
        for places, codes, sizes in batches(words):
            n = np.array([counts[k] for k in places], float)
            if codes is None:
                for k in places:
                    self.expected(words[k], counts[k], total)
            else:
                self.trie.add_expected(codes, sizes, n, sums)
        for k in np.flatnonzero(sums):
            name = self.trie.names[k - 1] if k else None
            total[name] = total.get(name, 0.0) + float(sums[k])
        return total

    def edges(self, s: str) -> list[list[tuple[int, float, str | None]]]:
        """For each place, the pieces that end there: (start, log p, piece); a
        character that is no piece is spelt in bytes."""
        get, out = self.pieces.get, [[]]
        for j in range(1, len(s) + 1):
            into = []
            for i in range(max(0, j - self.longest), j):
                p = get(s[i:j])
                if p is not None:
                    into.append((i, p, s[i:j]))
            if not into or into[-1][0] != j - 1:
                into.append((j - 1, self.byte * len(s[j - 1].encode("utf-8", "replace")), None))
            out.append(into)
        return out

    def forward(self, edges) -> list[float]:
        a = [0.0]
        for into in edges[1:]:
            terms = [a[e[0]] + e[1] for e in into]
            top = max(terms)
            a.append(top + math.log(sum([math.exp(t - top) for t in terms])) if len(terms) > 1 else top)
        return a

    def log_p(self, word: bytes) -> float:
        """Natural log of the word's probability, all segmentations together."""
        return self.forward(self.edges(_MARK + word.decode("utf-8", "replace")))[-1]

    def expected(self, word: bytes, n: float, into: dict) -> None:
        """Adds the expected uses of each piece in ``n`` such words; None stands for bytes."""
        edges = self.edges(_MARK + word.decode("utf-8", "replace"))
        a = self.forward(edges)
        share = [0.0] * len(a)
        share[-1] = n
        for j in range(len(edges) - 1, 0, -1):
            if share[j]:
                for i, p, piece in edges[j]:
                    part = share[j] * math.exp(min(0.0, a[i] + p - a[j]))
                    share[i] += part
                    into[piece] = into.get(piece, 0.0) + part


def batches(words: list[bytes]):
    """Words as code points, a matrix per length: (places in ``words``, code points, bytes
    per character).  Words of over ``LONG`` characters come without matrix, one by one."""
    by: dict[int, list[int]] = {}
    text = [_MARK + w.decode("utf-8", "replace") for w in words]
    for k, t in enumerate(text):
        by.setdefault(len(t), []).append(k)
    for n, places in by.items():
        if n > LONG:
            yield places, None, None
            continue
        step = max(1, CELLS // n)
        for at in range(0, len(places), step):
            part = places[at:at + step]
            codes = np.frombuffer("".join([text[k] for k in part]).encode("utf-32-le", "replace"), "<u4").reshape(len(part), n)
            sizes = 1 + (codes > 0x7F).astype(np.int8) + (codes > 0x7FF) + (codes > 0xFFFF)
            yield part, codes, sizes


class Trie:
    """The pieces as a trie of sorted (node, character) keys, walked for all words at once."""

    def __init__(self, pieces: dict[str, float], byte: float):
        self.names, self.byte = sorted(pieces), byte
        steps: dict[tuple[int, str], int] = {}
        ends = {}
        for k, piece in enumerate(self.names):
            node = 0
            for c in piece:
                node = steps.setdefault((node, c), len(steps) + 1)
            ends[node] = k
        keys = np.array([node << 21 | ord(c) for node, c in steps], np.int64)
        order = np.argsort(keys)
        self.keys, self.next = keys[order], np.array(list(steps.values()), np.int64)[order]
        self.piece = np.zeros(len(steps) + 1, np.int64)  # 1 + number of the piece that ends at a node, else 0
        self.log_p = np.zeros(len(steps) + 1)
        for node, k in ends.items():
            self.piece[node], self.log_p[node] = k + 1, pieces[self.names[k]]

    def edges(self, codes: np.ndarray, sizes: np.ndarray):
        """For each start, its edges (end, rows, log p, piece); piece 0 is spelling in bytes."""
        w, n = codes.shape
        points = codes.astype(np.int64)
        for i in range(n):
            out, rows, node = [], np.arange(w), np.zeros(w, np.int64)
            for j in range(i, n):
                key = node << 21 | points[rows, j]
                at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                on = self.keys[at] == key
                rows, node = rows[on], self.next[at[on]]
                whole = self.piece[node] > 0
                if j == i:  # a character that is no piece
                    spelt = np.ones(w, bool)
                    spelt[rows[whole]] = False
                    r = np.flatnonzero(spelt)
                    if len(r):
                        out.append((j + 1, r, self.byte * sizes[r, j], np.zeros(len(r), np.int64)))
                if whole.any():
                    out.append((j + 1, rows[whole], self.log_p[node[whole]], self.piece[node[whole]]))
                if not len(rows):
                    break
            yield i, out

    def forward(self, codes: np.ndarray, sizes: np.ndarray):
        """Log probability of every prefix of every word, and the edges."""
        a = np.full((codes.shape[0], codes.shape[1] + 1), -np.inf)
        a[:, 0] = 0.0
        kept = []
        for i, out in self.edges(codes, sizes):
            for j, rows, p, _ in out:
                a[rows, j] = np.logaddexp(a[rows, j], a[rows, i] + p)
            kept.append(out)
        return a, kept

    def add_expected(self, codes: np.ndarray, sizes: np.ndarray, counts: np.ndarray, sums: np.ndarray) -> None:
        """Adds the expected uses of each piece to ``sums``, by number + 1; 0 is for bytes."""
        a, kept = self.forward(codes, sizes)
        b = np.full(a.shape, -np.inf)
        b[:, -1] = 0.0
        for i in range(len(kept) - 1, -1, -1):
            for j, rows, p, piece in kept[i]:
                through = p + b[rows, j]
                b[rows, i] = np.logaddexp(b[rows, i], through)
                sums += np.bincount(piece, np.exp(a[rows, i] + through - a[rows, -1]) * counts[rows], len(sums))


def count_words(docs: DataFrame, folds: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n, n_train) of every distinct word of all documents; counts of a few MB
    of text are summed before they are shuffled."""
    slim = docs.select(held_out(id_col, folds).alias("out"), F.col(text_col).cast("string").alias("text"))

    def run(cols):
        train, rest = Counter(), Counter()
        for out, t in zip(cols["out"], cols["text"]):
            (rest if out else train).update(words(t))
        met = list(train.keys() | rest.keys())
        return {"word": pa.array(met, pa.binary()), "n": [train[w] + rest[w] for w in met], "n_train": [train[w] for w in met]}

    return map_rows(slim, run, "word binary, n long, n_train long").groupBy("word").agg(
        F.sum("n").alias("n"), F.sum("n_train").alias("n_train"))


def reweigh(counted: DataFrame, pieces: dict[str, float], byte: float) -> tuple[dict[str, float], float]:
    """One round of expectation and maximisation over the training words.  The sums come
    back per piece: as many rows as the vocabulary has, whatever the corpus."""
    spark = counted.sparkSession
    lattice = spark.sparkContext.broadcast(Lattice(pieces, byte))  # the vocabulary: fixed size

    def run(cols):
        total = lattice.value.expected_uses(cols["word"], cols["n_train"])
        return {"piece": list(total), "n": list(total.values())}

    used = map_rows(counted.filter("n_train > 0").select("word", "n_train"), run, "piece string, n double")
    rows = used.groupBy("piece").agg(F.sum("n").alias("n")).collect()
    n = {r["piece"]: r["n"] for r in rows}
    if not n:
        return pieces, byte
    # a piece that wasn't used keeps a trace of its prior; bytes share what they were used for
    total = sum(n.values()) + 1.0
    out = {p: math.log((n.get(p, 0.0) + 0.99 * math.exp(q)) / total) for p, q in pieces.items()}
    return out, math.log((n.get(None, 0.0) + 0.01) / total / 256)


def score(docs: DataFrame, model: str, folds: int = 10, head: int = HEAD, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score; a row per row of ``docs``.

    base_score is the smoothed word-count likelihood, score the lattice's, both in log10.
    """
    spark = docs.sparkSession
    counted = materialise(count_words(docs, folds, id_col, text_col), "word-counts")
    lattice = Lattice(*reweigh(counted, *prior(model)))
    shared = spark.sparkContext.broadcast(lattice)

    def likelihoods(cols):
        return {"word": pa.array(cols["word"], pa.binary()), "n": cols["n"], "c": cols["n_train"],
                "lm": shared.value.log_ps(cols["word"])}

    # dealt anew, since a word's work is not a row's: long words spread out
    table = materialise(map_rows(counted, likelihoods, "word binary, n long, c long, lm double"), "word-table")
    sums = table.filter("c > 0").agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    ends = docs.filter(~held_out(id_col, folds)).count()  # one end per training text
    n_train, kinds = sums["n"] + ends, sums["v"] + (1 if ends else 0)
    floor = n_train + SMOOTH * (kinds + 1)
    end_base = math.log10((ends + SMOOTH) / floor)
    # the end of a text: as likely as training texts are among training tokens
    end_lm = math.log10((ends + SMOOTH) / (n_train + 2 * SMOOTH))
    go_on = math.log10((n_train - ends + SMOOTH) / (n_train + 2 * SMOOTH))
    # the head: words from some frequency on, as low as leaves at most `head` of them.  Frequencies are
    # looked at in steps of a sixteenth of a doubling, of which there are a few hundred whatever the corpus
    step = F.floor(F.log2("n") * 16)
    short = table.filter(F.octet_length("word") <= HEAD_BYTES)
    steps = short.groupBy(step.alias("s")).agg(F.count(F.lit(1)).alias("k")).orderBy(F.desc("s")).collect()
    room, lowest = head, None
    for r in steps:
        room -= r["k"]
        if room < 0:
            break
        lowest = r["s"]
    top = short.filter(step >= lowest).collect() if lowest is not None else []
    known = spark.sparkContext.broadcast({  # at most `head` words of at most HEAD_BYTES bytes
        bytes(r["word"]): (math.log10((r["c"] + SMOOTH) / floor), r["lm"] / LN10, r["c"] > 0) for r in top})

    def run(cols):
        out: dict = {k: [] for k in ("doc_id", "held_out", "n_words", "n_known", "base", "lm", "rare")}
        get = known.value.get
        for i, held, t in zip(cols["doc_id"], cols["held_out"], cols["text"]):
            met = words(t)
            rare, n_known, base, lm = [], 0, 0.0, 0.0
            for w, k in Counter(met).items():
                got = get(w)
                if got is None:
                    rare += [w] * k
                else:
                    base += k * got[0]
                    lm += k * got[1]
                    n_known += k * got[2]
            for n, v in zip(out, (i, held, len(met), n_known, base, lm, rare)):
                out[n].append(v)
        return out

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col, folds).alias("held_out"),
                       F.col(text_col).cast("string").alias("text"))
    part = map_rows(slim, run, "doc_id long, held_out boolean, n_words long, n_known long, base double, lm double, rare array<binary>")
    part = materialise(part.withColumn("row", F.monotonically_increasing_id()), "partial")
    rare = part.select("row", F.explode("rare").alias("word")).groupBy("row", "word").agg(F.count(F.lit(1)).alias("k"))
    joined = rare.join(table.select("word", "c", "lm"), "word").groupBy("row").agg(
        F.sum(F.col("k") * F.log10((F.col("c") + SMOOTH) / F.lit(floor))).alias("r_base"),
        F.sum(F.col("k") * F.col("lm") / LN10).alias("r_lm"), F.sum(F.when(F.col("c") > 0, F.col("k")).otherwise(0)).alias("r_known"))
    zero = F.lit(0.0)
    return part.drop("rare").join(joined, "row", "left").select(
        "doc_id", "held_out", (F.col("n_words") + 1).alias("n_tokens"),
        (F.col("n_known") + F.coalesce("r_known", F.lit(0)) + F.lit(1 if ends else 0)).cast("long").alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("r_base", zero) + F.lit(end_base)).alias("base_score"),
        (F.col("lm") + F.coalesce("r_lm", zero) + F.col("n_words") * F.lit(go_on) + F.lit(end_lm)).alias("score"))
