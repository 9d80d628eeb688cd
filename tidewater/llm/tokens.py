"""Encoding of many texts with one tokenizer file: each distinct piece is merged once per worker.

A byte-level BPE tokenizer splits a text by a fixed pattern and merges inside each piece only, so a piece
encodes the same alone and in its text. Pieces are looked up in a bounded cache (emptied when full; results do
not depend on it), new ones go to the tokenizer's merge model. Texts of ``SAFE`` characters are split by the
standard library, all others by the tokenizers' own pattern. Pattern libraries differ only on characters that
Unicode has not assigned, or not long ago; since no piece goes on from a visible character to white space, a
text with such characters is cut there, and only the stretches that hold them go to the tokenizer as they are.
A special string is a piece of its own.
"""

from __future__ import annotations

import functools
import itertools
import re
import unicodedata

import numpy as np
import regex

#: The split pattern of the tokenizer files for texts of SAFE characters, in terms of the standard library.
PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
#: Characters on which the standard library and the tokenizers split alike (swept in tests).
SAFE = ("\x00-\x1b\x20-\xb1\xb4-\xb8\xba\xbb\xbf-ԯא-תؠ-يऀ-ॣ฀-ฺ"
        " -⁯₠-⃀、。ぁ-ゖァ-ヺ一-龥가-힣！-／")
UNSAFE = re.compile(f"[^{SAFE}]")
CACHE_PIECES = 700_000


#: White space with the visible characters after it: every piece lies in one stretch.
STRETCH = regex.compile(r"\s*\S+|\s+")


@functools.cache
def exact_pattern():
    """The split pattern of the tokenizer files."""
    import public_tokenizers

    return regex.compile(public_tokenizers.PATTERN)


def doubtful(text: str) -> bool:
    """Does the text hold characters on which pattern libraries differ?"""
    return bool(UNSAFE.search(text)) and any(unicodedata.category(c) == "Cn" for c in set(text))


def pieces(text: str) -> list[str]:
    """The pieces that encode independently; a stretch with doubtful characters is one piece."""
    if not UNSAFE.search(text):
        return PIECE.findall(text)
    split = exact_pattern().findall
    if not doubtful(text):
        return split(text)
    found = []
    for stretch in STRETCH.findall(text):
        found.extend([stretch] if doubtful(stretch) else split(stretch))
    return found


def byte_names() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(rest)}


class Pool:
    """Id lists by code: flat ids and their ends; ``take`` strings the lists of many codes together."""

    def __init__(self):
        self.flat, self.ends = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def add(self, lists: list) -> None:
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        more = np.fromiter(itertools.chain.from_iterable(lists), np.uint32, int(sizes.sum()))
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])
        self.flat = np.concatenate([self.flat, more])

    def take(self, codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all codes in order, and the number of ids for each run of ``sizes`` codes."""
        n = self.ends[codes + 1] - self.ends[codes]
        ends = np.concatenate([[0], np.cumsum(n)])
        at = np.repeat(self.ends[codes] - ends[:-1], n) + np.arange(ends[-1])
        return self.flat[at], np.diff(ends[np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)])


class PieceEncoder:
    """Token ids of texts by a byte-level ``tokenizers`` file, as its ``encode(..., add_special_tokens=False)``."""

    def __init__(self, path: str, cache_pieces: int = CACHE_PIECES):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True))) or r"(?!)")
        self.names = byte_names()
        self.cache_pieces = cache_pieces
        self.index: dict[str, int] = {}
        self.pool = Pool()

    def _pieces(self, text: str) -> list[str]:
        found, at = [], 0
        for m in self.special.finditer(text):
            found += [*pieces(text[at:m.start()]), m.group()]
            at = m.end()
        return found + pieces(text[at:]) if at else pieces(text)

    def _merge(self, piece: str) -> list[int]:
        if doubtful(piece) or self.special.fullmatch(piece):
            return self.tokenizer.encode(piece, add_special_tokens=False).ids
        return [t.id for t in self.model.tokenize(piece.encode().decode("latin-1").translate(self.names))]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts, and the number of ids of each."""
        if len(self.index) > self.cache_pieces:
            self.index, self.pool = {}, Pool()
        index, known = self.index, len(self.index)
        codes, sizes = [], []
        for text in texts:
            found = self._pieces(text)
            for p in set(found).difference(index):
                index[p] = len(index)
            codes.extend(map(index.__getitem__, found))
            sizes.append(len(found))
        if len(index) > known:
            self.pool.add([self._merge(p) for p in itertools.islice(index, known, None)])
        return self.pool.take(np.array(codes, np.int64), np.array(sizes, np.int64))


_encoders: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """The worker's encoder for a file; workers are reused, so its cache serves many tasks."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


def runs(sizes, most: int = 4 << 20):
    """Cut consecutive items into runs (start, end) of about ``most`` in sum; a larger item is a run of its own."""
    start, total = 0, 0
    for k, n in enumerate(sizes):
        if k > start and total + n > most:
            yield start, k
            start, total = k, 0
        total += n
    if len(sizes) > start:
        yield start, len(sizes)


def give_back() -> None:
    """Return the Arrow memory that a worker no longer uses; workers outlive their tasks and would keep it."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()


def text_runs(column, most: int = 4 << 20):
    """(start, end, texts) over an Arrow string column, about ``most`` bytes of text at a time; NULL is empty."""
    import pyarrow.compute as pc

    for lo, hi in runs(pc.fill_null(pc.binary_length(column), 0).to_pylist(), most):
        yield lo, hi, [t or "" for t in column.slice(lo, hi - lo).to_pylist()]
    give_back()
