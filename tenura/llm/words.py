"""Token ids of whole texts: each distinct word of a batch goes through the tokenizer once.

The vocabulary file splits every text at white space before it merges anything, so the ids of a text are those of its
words in order. Texts that hold one of the tokenizer's special strings, or white space that only Unicode knows, are
encoded whole by the tokenizer.
"""

from __future__ import annotations

import os
import re
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Words kept between batches, beyond those of one batch. Only speed depends on it: a word that is not kept is encoded again.
KEPT_WORDS = 300_000
# A mark of punctuation behind a letter or digit begins a new token, whatever follows (the apostrophe is the exception).
_BOUNDARY = r"([a-z0-9])([.,;:!?#$%&*()\"-])"
# Words that are one pre-token as they stand: letters up to U+00FF (none changes under NFC, all have one lower-case
# form), or a run of ASCII punctuation without the apostrophe. Digits are one pre-token each.
_LETTERS = re.compile("[a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
_ASCII = re.compile("[a-z]+")
_SIGNS = re.compile(r"[!-&(-/:-@\[-`{-~]+")
_DIGITS = re.compile("[0-9]+")
# Texts with a special string, or with white space beyond ASCII, go to the tokenizer whole.
_ODD = "<\\||[\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200d}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"


def _byte_letters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it prints, else one past U+00FF."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordCoder:
    """Ids of texts under one vocabulary file (``tokenizers`` library, ``add_special_tokens=False``)."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self._forget()

    def _forget(self):
        self.index: dict[str, int] = {}
        self.lengths = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)
        self.met = np.zeros(0, np.int32)

    def _trim(self):
        """Keep the half of the words that most batches held."""
        keep = np.sort(np.argsort(-self.met, kind="stable")[: KEPT_WORDS // 2])
        starts = np.concatenate([[0], np.cumsum(self.lengths)])
        words = list(self.index)
        self.index = {words[i]: k for k, i in enumerate(keep.tolist())}
        lengths = self.lengths[keep]
        ends = np.cumsum(lengths)
        self.ids = self.ids[np.repeat(starts[keep] - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)]
        self.lengths, self.met = lengths, self.met[keep] // 2

    def _ids(self, word: str) -> list[int]:
        if _LETTERS.fullmatch(word):
            spelt = word if word.isascii() else word.lower().encode().decode("latin-1").translate(self.letters)
            return [t.id for t in self.model.tokenize(spelt)]
        if _SIGNS.fullmatch(word):
            return [t.id for t in self.model.tokenize(word)]
        if _DIGITS.fullmatch(word):
            return [t.id for digit in word for t in self.model.tokenize(digit)]
        return self.tokenizer.encode(word, add_special_tokens=False).ids

    def _codes(self, words: list[str]) -> list[list[int]]:
        """The ids of each word; most words are plain letters."""
        tokenize, plain, ids = self.model.tokenize, _ASCII.fullmatch, self._ids
        return [[t.id for t in tokenize(w)] if plain(w) else ids(w) for w in words]

    def _learn(self, words: list[str]):
        codes = self._codes(words)
        n = len(self.index)
        self.index.update(zip(words, range(n, n + len(words))))
        lengths = np.fromiter(map(len, codes), np.int64, len(codes))
        self.lengths = np.concatenate([self.lengths, lengths])
        self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(codes), np.uint32, int(lengths.sum()))])
        self.met = np.concatenate([self.met, np.zeros(len(words), np.int32)])

    def _places(self, distinct: list[str]) -> np.ndarray:
        """Where each of these words stands among those known; new ones are learnt first."""
        if len(self.index) > KEPT_WORDS:
            self._trim()
        known = len(self.index)
        places = np.fromiter(map(self.index.get, distinct, repeat(-1)), np.int64, len(distinct))
        new = np.flatnonzero(places < 0)
        if len(new):
            self._learn([distinct[i] for i in new.tolist()])
            places[new] = np.arange(known, known + len(new))
        return places

    def _plain(self, texts: pa.Array):
        lowered = pc.replace_substring_regex(pc.ascii_lower(texts), pattern=_BOUNDARY, replacement=r"\1 \2")
        words = pc.ascii_split_whitespace(lowered)
        offsets = words.offsets.to_numpy()
        coded = words.flatten().dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        places = self._places(distinct)
        starts = np.concatenate([[0], np.cumsum(self.lengths)])
        self.met[places] += 1
        word = places[coded.indices.to_numpy()] if len(distinct) else np.zeros(0, np.int64)
        lengths = self.lengths[word]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        flat = self.ids[np.repeat(starts[word] - ends[:-1], lengths) + np.arange(ends[-1])]
        return flat, ends[offsets - offsets[0]]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids as uint32, offsets): text i has ids[offsets[i]:offsets[i + 1]]. Null counts as empty."""
        texts = pc.fill_null(texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts, "")
        odd = pc.match_substring_regex(texts, pattern=_ODD).to_numpy(zero_copy_only=False)
        if not odd.any():
            return self._plain(texts)
        plain, cuts = self._plain(pc.if_else(pa.array(odd), "", texts))
        parts = [plain[cuts[i] : cuts[i + 1]] for i in range(len(texts))]
        for i in np.flatnonzero(odd):
            parts[i] = np.array(self.tokenizer.encode(texts[int(i)].as_py(), add_special_tokens=False).ids, np.uint32)
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])


_CODERS: dict[str, WordCoder] = {}


def coder(path: str) -> WordCoder:
    """One coder per vocabulary file and Python worker."""
    if path not in _CODERS:
        _CODERS[path] = WordCoder(path)
    return _CODERS[path]
