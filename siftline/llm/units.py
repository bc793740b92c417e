"""Vectorised text units: whole batches of texts become arrays of hashed units in numpy.

A unit is a lower-cased run of letters, digits and combining marks; a run of Han or kana gives all
its pairs of adjacent characters and a Thai run all its runs of four (shorter runs whole). Units are
32-bit hashes, distinct within a row. A null or empty text has no units.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd

OTHER, WORD, PAIRED, THAI = 0, 1, 2, 3
# Code point ranges of Han and of kana (with the long-vowel and iteration marks).
PAIRED_RANGES = (
    (0x3005, 0x3007), (0x3041, 0x3096), (0x3099, 0x309A), (0x309D, 0x309F), (0x30A1, 0x30FA), (0x30FC, 0x30FF),
    (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x20000, 0x323AF),
)
THAI_RANGE = (0x0E01, 0x0E5B)
R = 0x9E3779B97F4A7C15 | 1
MASK = (1 << 64) - 1


@lru_cache(1)
def classes() -> np.ndarray:
    """Class of every code point, from the Unicode categories."""
    kind = np.zeros(0x110000, np.uint8)
    for cp in range(0x323B0):
        if unicodedata.category(chr(cp))[0] in "LMN":
            kind[cp] = WORD
    for lo, hi in PAIRED_RANGES:
        kind[lo : hi + 1] = np.where(kind[lo : hi + 1], PAIRED, 0)
    lo, hi = THAI_RANGE
    kind[lo : hi + 1] = np.where(kind[lo : hi + 1], THAI, 0)
    return kind


@lru_cache(1)
def digits() -> np.ndarray:
    """Which code points are decimal digits."""
    return np.array([unicodedata.category(chr(c)) == "Nd" for c in range(0x20000)])


@lru_cache(2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inv = pow(R, -1, 1 << 64)
    ones = np.ones(n, np.uint64)
    up, down = ones.copy(), ones.copy()
    up[1:], down[1:] = np.uint64(R), np.uint64(inv)
    with np.errstate(over="ignore"):
        return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def slices(batches: Iterator[pd.DataFrame], text: str, chars: int = 1_000_000) -> Iterator[pd.DataFrame]:
    """The batches in parts of about `chars` characters (one text at least), which bounds the memory of the arrays."""
    for b in batches:
        total = np.cumsum([1 if t is None else len(t) + 1 for t in b[text]])
        at = 0
        while at < len(b):
            done = total[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(total, done + chars)))
            yield b.iloc[at:end]
            at = end


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(33))


def code_points(texts: list, lower: Callable[[str], str] = str.lower) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points of all texts, joined by line feeds, and each text's start."""
    low = ["" if t is None else lower(t) for t in texts]
    cp = np.frombuffer("\n".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.zeros(len(low), np.int64)
    np.cumsum([len(t) + 1 for t in low[:-1]], out=starts[1:]) if len(low) > 1 else None
    return np.append(cp, np.uint32(10)), starts


def _run_hash(cp: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of cp[begin:end], from prefix sums of a polynomial: no loop over runs."""
    size = 1 << max(20, int(len(cp)).bit_length())
    up, down = _powers(size)
    with np.errstate(over="ignore"):
        prefix = np.zeros(len(cp) + 1, np.uint64)
        np.cumsum((cp.astype(np.uint64) + np.uint64(1)) * up[: len(cp)], out=prefix[1:])
        return mix((prefix[end] - prefix[begin]) * down[begin] + (end - begin).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _runs(kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(kind[1:] != kind[:-1]) + 1
    begin = np.concatenate(([0], edge))
    end = np.concatenate((edge, [len(kind)]))
    keep = kind[begin] != OTHER
    return begin[keep], end[keep]


def words(cp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """In text order: 64-bit hash, begin and end of every run of letters, digits and marks (runs of one class)."""
    begin, end = _runs(classes()[cp])
    return _run_hash(cp, begin, end), begin, end


def _distinct(row: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    key = np.sort((row.astype(np.uint64) << np.uint64(32)) | (h & np.uint64(0xFFFFFFFF)))
    if len(key):
        key = key[np.concatenate(([True], key[1:] != key[:-1]))]
    offsets = np.searchsorted(key, np.arange(n + 1, dtype=np.uint64) << np.uint64(32))
    return (key & np.uint64(0xFFFFFFFF)).astype(np.uint32), offsets


def unit_sets(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Distinct unit hashes of all rows, ascending within each, and the rows' offsets (length n + 1)."""
    cp, starts = code_points(texts)
    kind = classes()[cp]
    begin, end = _runs(kind)
    sort, size = kind[begin], end - begin
    whole = (sort == WORD) | ((sort == PAIRED) & (size < 2)) | ((sort == THAI) & (size < 4))
    pair = np.flatnonzero((kind[:-1] == PAIRED) & (kind[1:] == PAIRED))
    thai = np.flatnonzero((kind[:-3] == THAI) & (kind[1:-2] == THAI) & (kind[2:-1] == THAI) & (kind[3:] == THAI)) if len(kind) > 3 else pair[:0]
    begin = np.concatenate((begin[whole], pair, thai))
    end = np.concatenate((end[whole], pair + 2, thai + 4))
    row = np.searchsorted(starts, begin, "right") - 1
    return _distinct(row, _run_hash(cp, begin, end), len(texts))


def number_keys(texts: list) -> np.ndarray:
    """One 64-bit key per row for its set of digit runs; 0 where there is none."""
    cp, starts = code_points(texts)
    table = digits()
    kind = np.where(cp < len(table), table[np.minimum(cp, len(table) - 1)], False).astype(np.uint8)
    begin, end = _runs(kind)
    row = np.searchsorted(starts, begin, "right") - 1
    h, offsets = _distinct(row, _run_hash(cp, begin, end), len(texts))
    return set_keys(h, offsets)


def set_keys(h: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One 64-bit key per row, equal for equal sets; 0 for an empty set."""
    with np.errstate(over="ignore"):
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(h.astype(np.uint64) + np.uint64(0x1234567)), dtype=np.uint64)))
        return (total[offsets[1:]] - total[offsets[:-1]]).view(np.int64)


def rare_first(h: np.ndarray, offsets: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Unit hashes reordered within each row: unlisted ones by hash, then the listed ones from rare to common."""
    rank = np.zeros(len(h), np.int32)
    if len(common):
        by = np.argsort(common.view(np.uint32))
        keys = common.view(np.uint32)[by]
        at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        rank = np.where(keys[at] == h, by[at] + 1, 0)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    return h[np.lexsort((h, rank, row))]
