"""Words and their hashes from UTF-8 bytes, vectorised over many texts at once.

A word is a maximal run of bytes of digits, letters (A-Z lower-cased) and bytes of non-ASCII characters, the
same words as ``decontam.WORD``. Hashes are 64-bit: a polynomial in an odd constant over the word's bytes,
scaled to its start and mixed.
"""

from __future__ import annotations

import numpy as np

LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32
IS_WORD = np.zeros(256, bool)
IS_WORD[48:58] = IS_WORD[97:123] = IS_WORD[128:] = True
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_powers = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for reuse."""
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        grown = np.full(max(n, 1 << 20), base, np.uint64)
        grown[0] = 1
        have = _powers[int(base)] = np.multiply.accumulate(grown)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (two multiply-xorshift rounds)."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    """Running polynomial sums; ``span_hash`` of them hashes any span in constant time."""
    out = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(buf)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes [start, end); equal spans hash alike wherever they lie."""
    inverse = powers(BASE_INVERSE, len(prefix))
    return mix((prefix[end] - prefix[start]) * inverse[start])


def cut_at_words(text: bytes, most: int):
    """Consecutive pieces of about ``most`` bytes that split no word (a longer word stays whole)."""
    at = 0
    while len(text) - at > most:
        end = at + most
        while end < len(text):  # the next byte outside words
            outside = np.flatnonzero(~IS_WORD[LOWERED[np.frombuffer(text, np.uint8, min(4096, len(text) - end), end)]])
            if len(outside):
                end += int(outside[0])
                break
            end = min(len(text), end + 4096)
        yield text[at:end]
        at = end
    yield text[at:]


def in_pieces(texts: list[bytes], most: int = 1 << 19):
    """Runs of (text indexes, pieces) of about ``most`` bytes, whatever the length of a text."""
    who, parts, size = [], [], 0
    for k, text in enumerate(texts):
        for part in cut_at_words(text, most):
            if parts and size + len(part) > most:
                yield np.array(who), parts
                who, parts, size = [], [], 0
            who.append(k), parts.append(part)
            size += len(part)
    if parts:
        yield np.array(who), parts


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, strung together, and the number of words of each text."""
    counts, hashes = np.zeros(len(texts), np.int64), [np.zeros(0, np.uint64)]
    for who, parts in in_pieces(texts):
        w = Words(parts)
        np.add.at(counts, who, np.diff(w.first))
        hashes.append(w.hashes())
    return np.concatenate(hashes), counts


class Words:
    """Words of many texts: ``start``, ``end`` (bytes of ``buf``), ``first`` (index of each text's first word)."""

    def __init__(self, texts: list[bytes]):
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        self.buf = LOWERED[np.frombuffer(b"".join(texts), np.uint8)]
        self.ends = np.cumsum(size)
        inside = IS_WORD[self.buf]
        new_text = np.zeros(len(self.buf) + 1, bool)
        new_text[self.ends[size > 0]] = True
        before = np.concatenate([[False], inside[:-1]]) if len(inside) else inside
        after = np.concatenate([inside[1:], [False]]) if len(inside) else inside
        self.start = np.flatnonzero(inside & (~before | new_text[:-1]))
        self.end = np.flatnonzero(inside & (~after | new_text[1:])) + 1
        self.first = np.searchsorted(self.start, np.concatenate([[0], self.ends]), "left")

    def hashes(self) -> np.ndarray:
        return span_hash(prefix_hash(self.buf), self.start, self.end)
