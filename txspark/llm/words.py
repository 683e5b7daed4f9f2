"""Words of whole texts as numpy arrays, for the operators that run in Python tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash

#: Odd multipliers that mix the word hashes of a window, by place.
PLACES = np.array([(0x9E3779B97F4A7C15 * (2 * k + 1)) | 1 for k in range(1, 9)], dtype=object)
PLACES = np.array([int(x) & 0xFFFFFFFFFFFFFFFF for x in PLACES], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: a bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def split_words(text: str | None) -> list[bytes]:
    """Lower-case A-Z and split at ASCII white space; null has no words."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def text_slices(frame: pd.DataFrame, limit: int) -> Iterator[pd.DataFrame]:
    """The rows of a frame in runs of about ``limit`` characters of text, to bound what a task holds; a text is never cut."""
    size = np.array([len(t) if t else 0 for t in frame["text"]], np.int64)
    for _, own in frame.groupby((np.cumsum(size) - size) // limit, sort=True):
        yield own


class _Codes(dict):
    """Words by the order in which they are first asked for."""

    def __missing__(self, word: bytes) -> int:
        code = self[word] = len(self)
        return code


class Words:
    """Texts as codes of words, text by text: no list of all words is held."""

    def __init__(self):
        self.seen, self.parts, self.lengths = _Codes(), [], []

    def add(self, text: str | None) -> None:
        own = split_words(text)
        self.parts.append(np.fromiter(map(self.seen.__getitem__, own), np.int32, len(own)))
        self.lengths.append(len(own))

    def codes(self) -> np.ndarray:
        return np.concatenate(self.parts) if self.parts else np.zeros(0, np.int32)


def tokenise(texts) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Codes of all words in order, the distinct words by code, and the number of words of each text."""
    words = Words()
    for text in texts:
        words.add(text)
    return words.codes(), list(words.seen), np.array(words.lengths, np.int64)


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of distinct words."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash for each run of ``width`` consecutive words; the last ``width - 1`` places have none."""
    n = len(hashes) - width + 1
    out = np.zeros(max(n, 0), np.uint64)
    for k in range(width if n > 0 else 0):
        out += mix(hashes[k : k + n] * PLACES[k])
    return mix(out)
