"""Numpy over the bytes of many texts at once: words, hashes of words and of word n-grams.

A slice of texts is one uint8 buffer with offsets (text i is buf[off[i]:off[i+1]]). A word's hash is a
polynomial over a table of 64-bit numbers, taken from prefix sums modulo 2**64, so that it depends on
the word's bytes alone and costs a few numpy passes over the slice.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1_000_000
_U = np.uint64
_MUL = 0x9E3779B97F4A7C15 | 1
_INV = pow(_MUL, -1, 1 << 64)
_LETTERS = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Letters, digits and every byte of a character outside ASCII.
WORD = np.zeros(256, bool)
WORD[48:58] = WORD[65:91] = WORD[97:123] = WORD[128:] = True

_ASCII_WORD = WORD & (np.arange(256) < 128)

_pow = np.ones(1, _U)
_inv = np.ones(1, _U)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _pow, _inv
    if len(_pow) < n:
        m = max(n, SLICE_BYTES + 1)
        p, q = np.full(m, _MUL, _U), np.full(m, _INV, _U)
        p[0] = q[0] = 1
        _pow, _inv = np.cumprod(p, dtype=_U), np.cumprod(q, dtype=_U)
    return _pow, _inv


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def unit(x: np.ndarray) -> np.ndarray:
    """Hashes as doubles in [0, 1)."""
    return (x >> _U(11)).astype(np.float64) * 2.0**-53


def slices(column: pa.Array, slice_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string column into runs of whole texts of about slice_bytes; one text at least."""
    n = len(column)
    if not n:
        return
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(off, off[lo] + slice_bytes, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi, data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]
        lo = hi


def spans(buf: np.ndarray, off: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each maximal run of bytes with inside[byte], within texts."""
    if not len(buf):
        z = np.zeros(0, np.int64)
        return z, z, z
    w = inside[buf]
    edge = np.empty(len(buf), bool)
    edge[0], edge[1:] = w[0], w[1:] & ~w[:-1]
    full = off[:-1][off[:-1] < off[1:]]
    edge[full] = w[full]
    starts = np.flatnonzero(edge)
    edge[-1], edge[:-1] = w[-1], w[:-1] & ~w[1:]
    last = off[1:][off[:-1] < off[1:]] - 1
    edge[last] = w[last]
    ends = np.flatnonzero(edge) + 1
    return starts, ends, np.searchsorted(off, starts, side="right") - 1


def prefix_sums(buf: np.ndarray, lower: bool = True) -> np.ndarray:
    """What span_hashes needs of a buffer; ASCII case is folded with lower."""
    sums = np.zeros(len(buf) + 1, _U)
    np.cumsum(_LETTERS[LOWER[buf] if lower else buf] * _powers(len(buf) + 1)[0][: len(buf)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of buf[starts:ends] for each span."""
    return mix((sums[ends] - sums[starts]) * _powers(len(sums))[1][starts] + (ends - starts).astype(_U))


def hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    return span_hashes(prefix_sums(buf, lower), starts, ends)


def words(buf: np.ndarray, off: np.ndarray, inside: np.ndarray = WORD, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of each word in order."""
    s, e, d = spans(buf, off, inside)
    return d, hashes(buf, s, e, lower)


_SPLIT, _JOINED, _ALONE = 0, 1, 2
# How Unicode's names of characters begin in scripts that put no space between words.
_UNSPACED = ("CJK", "HIRAGANA", "KATAKANA", "HALFWIDTH KATAKANA", "BOPOMOFO", "THAI", "LAO", "KHMER", "MYANMAR", "YI", "TAI", "NEW TAI", "BALINESE", "JAVANESE")


@cache
def _classes() -> np.ndarray:
    """For each character: it splits words, belongs to one, or is a word by itself (letters of unspaced scripts)."""
    out = np.zeros(0x110000, np.uint8)
    for c in range(0x33480):  # the planes with letters
        if unicodedata.category(chr(c))[0] in "LMN":
            out[c] = _ALONE if c > 0x600 and unicodedata.name(chr(c), "").startswith(_UNSPACED) else _JOINED
    return out


def any_words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, hash, alone) of each word in order, by Unicode's classes of characters.

    Letters, marks and digits make words, all else splits them, quotes and other punctuation outside ASCII too. A
    character of a script without spaces is a word by itself: alone.
    """
    n = len(buf)
    inside = _ASCII_WORD[buf]
    fresh = np.zeros(n + 1, bool)  # no word goes on over these places
    fresh[off] = True
    alone = np.zeros(n + 1, bool)
    lead = np.flatnonzero(buf >= 0xC0)
    if len(lead):
        b = [buf[np.minimum(lead + k, n - 1)].astype(np.int64) for k in range(4)]
        width = 2 + (b[0] >= 0xE0) + (b[0] >= 0xF0)
        tail = [x & 0x3F for x in b]
        code = np.select([width == 2, width == 3], [(b[0] & 0x1F) << 6 | tail[1], (b[0] & 0x0F) << 12 | tail[1] << 6 | tail[2]], (b[0] & 0x07) << 18 | tail[1] << 12 | tail[2] << 6 | tail[3])
        kind = _classes()[code]
        for k in range(4):
            inside[lead[(kind > _SPLIT) & (width > k)] + k] = True
        single = kind == _ALONE
        alone[lead[single]] = fresh[lead[single]] = True
        fresh[lead[single] + width[single]] = True
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    starts = np.flatnonzero(inside & (~before | fresh[:-1]))
    ends = np.flatnonzero(inside & (~after | fresh[1:])) + 1
    return np.searchsorted(off, starts, side="right") - 1, hashes(buf, starts, ends), alone[starts]


def pairs(d: np.ndarray, h: np.ndarray, gap: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of each pair of words gap places apart in one text."""
    if len(h) <= gap:
        return d[:0], h[:0]
    same = d[gap:] == d[:-gap]
    return d[gap:][same], mix(h[:-gap] * _U(3 + 2 * gap) + h[gap:] * _U(0xD6E8FEB86659FD93))[same]


def shingles(d: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of each run of n words; a shorter text that has words gives one run of all."""
    if not len(h):
        return d, h
    total = int(d[-1]) + 1
    count = np.bincount(d, minlength=total)
    first = np.cumsum(count) - count
    size = np.minimum(count, n)
    runs = np.where(count > 0, np.maximum(count - n + 1, 1), 0)
    doc = np.repeat(np.arange(total), runs)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(runs) - runs, runs) + first[doc]
    out = np.zeros(len(at), _U)
    for k in range(n):
        live = size[doc] > k
        out = np.where(live, mix(out * _U(0x9FB21C651E98DF25) + h[np.minimum(at + k, len(h) - 1)]), out)
    return doc, out


def by_text(d: np.ndarray, h: np.ndarray, bits: int = 44) -> tuple[np.ndarray, np.ndarray]:
    """(text number, top bits of the hash) sorted by both; needs fewer than 2**(64 - bits) texts."""
    key = np.sort((d.astype(_U) << _U(bits)) | (h >> _U(64 - bits)))
    return (key >> _U(bits)).astype(np.int64), key & _U((1 << bits) - 1)
