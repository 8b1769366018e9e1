"""Words of Arrow text batches as numpy arrays of places and hashes, without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 20
MULTIPLIER = 0x9E3779B97F4A7C15
_MOD = 1 << 64
_INVERSE = pow(MULTIPLIER, -1, _MOD)

WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
NO_SPACE = ~WHITE
_codes = np.arange(256)
LETTER = ((_codes | 32) >= 97) & ((_codes | 32) <= 122) & (_codes < 128) | (_codes >= 128)  # non-ASCII counts as letter
FOLD = np.where((_codes >= 65) & (_codes <= 90), _codes + 32, _codes).astype(np.uint8)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_cache: dict[str, np.ndarray] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _cache or len(_cache["up"]) < n:
        size = max(n, BLOCK + 4096)
        _cache["up"], _cache["down"] = _powers(MULTIPLIER, size), _powers(_INVERSE, size)
    return _cache["up"], _cache["down"]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


@dataclass
class Piece:
    """Whole texts ``first`` to ``first + len(offsets) - 2`` of a batch as one run of bytes."""
    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def count(self) -> int:
        return len(self.offsets) - 1


def pieces(batch: pa.Array, size: int = BLOCK) -> Iterator[Piece]:
    """The texts of a batch in runs of about ``size`` bytes, one text at least; null counts as empty."""
    batch = pc.fill_null(batch.cast(pa.large_string()), "")
    _, offsets, data = batch.buffers()
    offsets = np.frombuffer(offsets, np.int64)[batch.offset:batch.offset + len(batch) + 1] if len(batch) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    k = 0
    while k < len(batch):
        end = max(k + 1, int(np.searchsorted(offsets, offsets[k] + size, "right")) - 1)
        yield Piece(k, data[offsets[k]:offsets[end]], offsets[k:end + 1] - offsets[k])
        k = end


@dataclass
class Words:
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray


def letters(data: np.ndarray) -> np.ndarray:
    """Bytes of ASCII letters and of non-ASCII characters other than general and Latin-1 punctuation."""
    is_in = LETTER[data]
    if len(data) > 2:
        wide = np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] == 0x80))
        is_in[wide] = is_in[wide + 1] = is_in[wide + 2] = False
    if len(data) > 1:
        latin = np.flatnonzero((data[:-1] == 0xC2) & (data[1:] != 0xAA) & (data[1:] != 0xB5) & (data[1:] != 0xBA))
        is_in[latin] = is_in[latin + 1] = False
    return is_in


def folded(data: np.ndarray) -> np.ndarray:
    """ASCII and Latin-1 capitals as small letters."""
    out = FOLD[data]
    if len(data) > 1:
        second = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
        out[second] += 32
    return out


def find_words(piece: Piece, is_in: np.ndarray | None = None) -> Words:
    """Runs of marked bytes (by default all but white space); no run crosses from one text to the next."""
    n = len(piece.data)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(none, none, none)
    is_in = NO_SPACE[piece.data] if is_in is None else is_in
    cut = np.zeros(n + 1, bool)
    cut[piece.offsets] = True
    begins, ends = is_in.copy(), is_in.copy()
    begins[1:] &= ~is_in[:-1] | cut[1:-1]
    ends[:-1] &= ~is_in[1:] | cut[1:-1]
    start = np.flatnonzero(begins)
    return Words(np.searchsorted(piece.offsets, start, "right") - 1, start, np.flatnonzero(ends) + 1)


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray, prefixes: tuple[int, ...] = ()) -> np.ndarray:
    """64-bit hash of each span of bytes (spans sorted by start), made block by block.

    With ``prefixes`` a row for each of these lengths instead, 0 where a span is shorter.
    """
    out = np.zeros((len(prefixes) or 1, len(start)), np.uint64)
    k = 0
    while k < len(start):
        to = max(k + 1, int(np.searchsorted(start, start[k] + BLOCK, "left")))
        low, high = int(start[k]), int(end[k:to].max())
        up, down = _tables(high - low + 1)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum((data[low:high].astype(np.uint64) + np.uint64(1)) * up[:high - low], out=sums[1:])
        s, e = start[k:to] - low, end[k:to] - low
        if prefixes:
            for row, size in enumerate(prefixes):
                fits = np.flatnonzero(e - s >= size)
                out[row, k + fits] = mix((sums[s[fits] + size] - sums[s[fits]]) * down[s[fits]])
        else:
            out[0, k:to] = mix((sums[e] - sums[s]) * down[s])
        k = to
    return out if prefixes else out[0]


def hash_text(text: str) -> int:
    """The same hash of a single word."""
    data = folded(np.frombuffer(text.encode(), np.uint8))
    return int(hash_spans(data, np.zeros(1, np.int64), np.array([len(data)]))[0]) if len(data) else 0


def count_by(doc: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(doc, weights, minlength=n)
