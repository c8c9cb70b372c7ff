"""Token ids of a public word-level BPE vocabulary, remembered per word.

The vocabulary drops white space and never joins across it, so a text's ids
are those of its white-space separated words in turn.  Each Python worker keeps
the ids of words it has met (at most ``cache`` of them, those used last), which
spares most of the work, and tokenizes only new words.

A new word of plain letters and a tail of ASCII punctuation is two pieces to
the vocabulary, so its ids are those of the two, and far fewer letter runs than
words are new.  Letter runs go to the vocabulary's model many at a time: the last
token of each, and no other, is marked as a word's end, which tells them apart
again.  They need none of the tokenizer's pattern matching and composition; a
worker compares its first ones with the whole tokenizer's and keeps to that if
they differ.
"""

from __future__ import annotations

import itertools
import os
import re
import string

import numpy as np

from .common import ASCII_LOWER

CACHE = 300_000
#: letter runs that one call of the tokenizer gets
TOGETHER = 256
_PUNCTUATION = string.punctuation.encode()
# letters that lower-casing and composition leave letters: ASCII and Latin-1
_LETTERS = re.compile(rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
_held: dict = {}


def word_vocabulary() -> str:
    """Place of the default vocabulary file on the machine that asks."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


class _Recent:
    """A dict of at most ``size`` entries.  What a call of :meth:`missing` asks for
    is there until the next; beyond that, entries not asked for of late go."""

    def __init__(self, size: int):
        self.half = max(1, size // 2)
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def missing(self, keys: set[bytes]) -> set[bytes]:
        if len(self.young) > self.half:
            self.young, self.old = {}, self.young
        new = keys - self.young.keys()
        again = new & self.old.keys()
        self.young.update((k, self.old[k]) for k in again)
        return new - again


class WordIds:
    """``literal`` reads the special tokens' names in a text as ordinary text."""

    def __init__(self, path: str, literal: bool = False, cache: int = CACHE):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, normalizers, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = literal
        self.literal = literal
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.normalizer = normalizers.Lowercase()
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.agree: bool | None = None
        self.words, self.runs = _Recent(cache), _Recent(cache)
        self.tails: dict[bytes, bytes] = {}

    def _encode(self, texts: list[bytes]) -> list[bytes]:
        got = self.tokenizer.encode_batch_fast([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in got]

    def _encode_runs(self, runs: list[bytes]) -> list[bytes]:
        if self.agree is None and runs:
            probe = runs[:2000]
            self.agree = self._together(probe) == self._encode(probe)
        return self._together(runs) if self.agree else self._encode(runs)

    def _together(self, runs: list[bytes]) -> list[bytes]:
        joined = [b" ".join(runs[k:k + TOGETHER]).decode() for k in range(0, len(runs), TOGETHER)]
        got = self.plain.encode_batch_fast(joined, add_special_tokens=False)
        ids = np.fromiter(itertools.chain.from_iterable(e.ids for e in got), "<u4")
        stops = ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip([0, *stops], stops)]

    def _learn(self, new: set[bytes]) -> None:
        heads = [w.rstrip(_PUNCTUATION) for w in new]
        letters = [head.isalpha() or _LETTERS.fullmatch(head) is not None for head in heads]
        unmet = list(self.runs.missing(set(itertools.compress(heads, letters))))
        runs, words = self.runs.young, self.words.young
        runs.update(zip(unmet, self._encode_runs(unmet)))
        tails, whole = self.tails, []
        for w, head, plain in zip(new, heads, letters):
            if not plain:
                whole.append(w)
            elif len(head) == len(w):
                words[w] = runs[head]
            else:
                tail = w[len(head):]
                if tail not in tails:
                    if len(tails) > 10_000:
                        tails.clear()
                    tails[tail] = self._encode([tail])[0]
                words[w] = runs[head] + tails[tail]
        words.update(zip(whole, self._encode(whole)))

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text; None is empty."""
        split: list = []
        met: set[bytes] = set()
        for t in texts:
            t = t or b""
            if not self.literal and b"<|" in t:  # may hold a special token, whose name keeps its case
                split.append(t)
                continue
            words = t.translate(ASCII_LOWER).split()
            met.update(words)
            split.append(words)
        new = self.words.missing(met)
        if new:
            self._learn(new)
        get = self.words.young.__getitem__
        return [b"".join(map(get, w)) if isinstance(w, list) else self._encode([w])[0] for w in split]


def word_ids(path: str, literal: bool = False, cache: int = CACHE) -> WordIds:
    """The worker's tokenizer for ``path``."""
    key = path, literal, cache
    if key not in _held:
        _held[key] = WordIds(*key)
    return _held[key]
