"""Cutting texts into pieces that byte-level tokenizers treat apart, with a bounded memory of pieces seen.

A single space between two characters that are no white space always begins a new pre-token of the
public pattern, so the text before it and the text from it on can be tokenized separately. Most pieces
come back again and again, so that remembering their ids saves most of the work.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BLANK = "\t\n\v\f\r\x1c\x1d\x1e\x1f"
_BESIDE_SPACE = [x for c in _BLANK for x in (c + " ", " " + c)] + ["  "]
_OTHER_BLANK = re.compile(r"[^\S \t\n\v\f\r\x1c\x1d\x1e\x1f]")
#: What a text must not hold to be cut at every space; the same as ``_is_plain`` says, for Arrow.
_UNEVEN = r"^ | $|  |[\t\n\x0b\x0c\r\x1c-\x1f] | [\t\n\x0b\x0c\r\x1c-\x1f]|[\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")
LONGEST_KEPT = 64


def _is_plain(text: str) -> bool:
    """Whether each space of ``text`` stands alone between two characters that are no white space."""
    plain = text[:1] != " " and text[-1:] != " " and (text.isascii() or _OTHER_BLANK.search(text) is None)
    return plain and not any(x in text for x in _BESIDE_SPACE)


def cut(text: str) -> list[str]:
    """Pieces of ``text``; a space belongs before every piece but the first."""
    return text.split(" ") if _is_plain(text) else _LONE_SPACE.split(text)


class Remembered(dict):
    """Piece -> what ``encode`` gives for it; forgets everything when ``most`` pieces are held."""

    def __init__(self, encode: Callable[[str], bytes], most: int = 1_000_000):
        super().__init__()
        self.encode, self.most = encode, most

    def __missing__(self, piece: str) -> bytes:
        found = self.encode(piece)
        if len(piece) <= LONGEST_KEPT:
            if len(self) >= self.most:
                self.clear()
            self[piece] = found
        return found


class PieceEncoder:
    """Ids of whole texts as little-endian unsigned 32-bit integers, from an encoder of single pieces.

    ``many`` encodes a list of pieces at once; with it, ``batch`` learns all unseen pieces of a batch together. ``whole`` does
    the same for pieces at the beginning of a text.
    """

    def __init__(self, encode: Callable[[str], bytes], many: Callable[[list[str]], list[bytes]] | None = None, most: int = 1_000_000, whole: Callable[[list[str]], list[bytes]] | None = None):
        self.first = Remembered(encode, most // 10)
        self.later = Remembered(lambda piece: encode(" " + piece), most)
        self.many, self.most, self.whole = many, most, whole
        self.older: dict[str, bytes] = {}

    def __call__(self, text: str) -> bytes:
        return self._join(cut(text))

    def _join(self, pieces: list[str]) -> bytes:
        later = iter(pieces)
        return self.first[next(later)] + b"".join(map(self.later.__getitem__, later))

    def _learn(self, found: list[str]) -> None:
        """Ids of all unseen pieces of ``found``. Of ``most`` pieces held, those that don't come again among as many are forgotten."""
        if len(self.later) > self.most // 2:
            self.older = dict(self.later)
            self.later.clear()
        seen, older, new = self.later, self.older, []
        for p in found:
            if p not in seen:
                if p in older:
                    seen[p] = older[p]
                elif len(p) <= LONGEST_KEPT:
                    new.append(p)
        for at in range(0, len(new), 5000):
            part = new[at : at + 5000]
            seen.update(zip(part, self.many([" " + p for p in part]), strict=True))

    def batch(self, texts: Iterable[str], chars: int = 4_000_000) -> Iterator[bytes]:
        """Ids of each text in turn, learned for about ``chars`` characters at a time."""
        held, size = [], 0
        for text in texts:
            held.append(text)
            size += len(text)
            if size > chars:
                yield from self._flush(held)
                held, size = [], 0
        if held:
            yield from self._flush(held)

    def _flush(self, held: list[str]) -> Iterator[bytes]:
        if self.many is None:
            return map(self, held)
        return self._together(held)

    def _firsts(self, pieces: list[str]) -> list[bytes]:
        return [self.first[p] for p in pieces] if self.whole is None else self.whole(pieces)

    def _together(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text: each distinct piece is looked up once, and Arrow puts the ids of all of them in order."""
        held = pa.array(texts, pa.string())
        plain = ~pc.match_substring_regex(held, _UNEVEN).to_numpy(zero_copy_only=False)
        order = np.argsort(~plain, kind="stable")
        simple, odd = (order[: int(plain.sum())].tolist(), order[int(plain.sum()) :].tolist())
        split = pc.split_pattern(held.take(pa.array(simple, pa.int64())), " ")
        lists = pa.concat_arrays([split, pa.array([cut(texts[i]) for i in odd], split.type)])
        edges = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        pieces = coded.dictionary.to_pylist()
        self._learn(pieces)
        firsts = self._firsts([pieces[k] for k in coded.indices.to_numpy()[edges[:-1]].tolist()])
        codes = coded.indices.to_numpy().astype(np.int32, copy=True)
        codes[edges[:-1]] = len(pieces) + np.arange(len(texts))
        found = pa.array([*map(self.later.__getitem__, pieces), *firsts], pa.large_binary()).take(pa.array(codes))
        ends = np.frombuffer(found.buffers()[1], dtype=np.int64)[: len(found) + 1]
        data, bounds = memoryview(found.buffers()[2]) if ends[-1] else memoryview(b""), ends[edges].tolist()
        places = np.empty(len(texts), dtype=np.int64)
        places[order] = np.arange(len(texts))
        for k in places.tolist():
            yield bytes(data[bounds[k] : bounds[k + 1]])
