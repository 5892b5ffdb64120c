"""Words of a text as 64-bit hashes; five-word shingles and their counts."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from functools import cache

import numpy as np
import xxhash

from .memory import remembered

WORD = re.compile(r"\w+")
SHINGLE = 5
_LONGEST_KEPT = 48
_PIECE = 1 << 16
_ODD = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F))


class WordHashes(dict):
    """Word -> its hash; forgets everything when ``most`` words are held."""

    def __init__(self, most: int = 150_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: str) -> int:
        h = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        if len(word) <= _LONGEST_KEPT:
            if len(self) >= self.most:
                self.clear()
            self[word] = h
        return h

    def of(self, words: Iterable[str], n: int) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=n)

    def text(self, text: str | None) -> np.ndarray:
        """Hashes of the lower-cased runs of letters, digits and underscores."""
        found = WORD.findall((text or "").lower())
        return self.of(found, len(found))


#: One per Python worker.
HASHES = WordHashes()
remembered("words", lambda: len(HASHES), lambda: HASHES.clear())


@cache
def _word_characters() -> np.ndarray:
    """Whether a code point is a letter, a digit or an underscore."""
    return np.fromiter((chr(x).isalnum() or x == 95 for x in range(0x110000)), dtype=np.int8, count=0x110000)


@cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2 ** 64."""
    base = int(_ODD[0]) & ~0x7 | 0x3
    return tuple(np.cumprod(np.append(np.uint64(1), np.full(_PIECE + _LONGEST_KEPT, x, dtype=np.uint64))) for x in (base, pow(base, -1, 1 << 64)))


def _word_pieces(text: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Where the words of a lower-cased text begin and their hashes, for pieces of ``_PIECE`` characters and up to
    the end of the last word."""
    power, back = _powers()
    low = 0
    while low < len(text):
        high = low + _PIECE
        rest = WORD.match(text, high) if WORD.match(text[high - 1 : high]) else None
        high = rest.end() if rest else min(high, len(text))
        code = np.frombuffer(text[low:high].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        edges = np.diff(_word_characters()[code], prepend=np.int8(0), append=np.int8(0))
        start, stop = np.nonzero(edges == 1)[0], np.nonzero(edges == -1)[0]
        if len(start):
            known = code[: len(power)]  # what lies behind belongs to a long word
            total = np.append(np.uint64(0), np.cumsum((known + np.uint32(1)) * power[: len(known)]))
            out = mix((total[np.minimum(stop, len(known))] - total[start]) * back[start])
            for i in np.nonzero(stop - start > _LONGEST_KEPT)[0].tolist():
                out[i] = xxhash.xxh3_64_intdigest(text[low + start[i] : low + stop[i]].encode("utf-8", "surrogatepass"))
            yield start + low, out
        low = high


def word_hashes(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, one text after the other, and how many each text has.

    The words are those of ``WordHashes.text``, the hashes are others: a polynomial of a word's code points as a difference
    of running sums, for many texts at once; words of over ``_LONGEST_KEPT`` characters are hashed one by one.
    """
    lower = [(x or "").lower() for x in texts]
    none = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    start, out = (np.concatenate(x) for x in zip(none, *_word_pieces("\n".join(lower)), strict=True))
    return out, np.diff(np.searchsorted(start, np.cumsum([len(x) + 1 for x in lower])), prepend=0)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hash of every run of ``size`` words; shorter texts are one run, a text without words has none."""
    n = len(words)
    if not n:
        return words
    size = min(size, n)
    total = np.zeros(n - size + 1, dtype=np.uint64)
    for k in range(size):
        total = mix(total + words[k : n - size + 1 + k] * _ODD[k % len(_ODD)])
    return total


def bag(text: str | None, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles in ascending order and how often each occurs."""
    return np.unique(shingles(HASHES.text(text), size), return_counts=True)
