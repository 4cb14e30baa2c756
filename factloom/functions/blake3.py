"""BLAKE3 of many texts at once, in numpy over Arrow batches.

A text is cut into chunks of 1024 bytes, a chunk into blocks of 64. All chunks of a batch advance together, one
block a step; their chaining values are then joined pairwise, a level of all trees a step. The left subtree
of a parent holds the largest power of two of chunks that leaves something for the right one: joining
neighbours and passing an odd last one on gives that same tree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the published algorithm: initial words, the order of message words, flags.
_IV = np.array([0x6A09E667, 0xBB67AE85, 0x3C6EF372, 0xA54FF53A, 0x510E527F, 0x9B05688C, 0x1F83D9AB, 0x5BE0CD19], np.uint32)
_ORDER = (2, 6, 3, 10, 7, 0, 4, 13, 1, 11, 12, 5, 9, 14, 15, 8)
_START, _END, _PARENT, _ROOT = 1, 2, 4, 8
_CHUNK, _BLOCK = 1024, 64
#: Bytes of texts that are hashed together; a longer text is hashed alone.
_SLICE = 4_000_000


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x >> np.uint32(n)) | (x << np.uint32(32 - n))


def _compress(chain: np.ndarray, block: np.ndarray, counter: np.ndarray, size: np.ndarray, flags: np.ndarray) -> np.ndarray:
    """The new chaining values, 8 words a row, from rows of 8 and 16 words."""
    v = [chain[:, i].copy() for i in range(8)] + [np.full(len(chain), _IV[i], np.uint32) for i in range(4)]
    v += [(counter & 0xFFFFFFFF).astype(np.uint32), (counter >> 32).astype(np.uint32), size.astype(np.uint32), flags.astype(np.uint32)]
    m = [block[:, i] for i in range(16)]

    def mix(a: int, b: int, c: int, d: int, x: np.ndarray, y: np.ndarray) -> None:
        v[a] = v[a] + v[b] + x
        v[d] = _turn(v[d] ^ v[a], 16)
        v[c] = v[c] + v[d]
        v[b] = _turn(v[b] ^ v[c], 12)
        v[a] = v[a] + v[b] + y
        v[d] = _turn(v[d] ^ v[a], 8)
        v[c] = v[c] + v[d]
        v[b] = _turn(v[b] ^ v[c], 7)

    for _ in range(7):
        for i in range(4):  # columns, then diagonals
            mix(i, 4 + i, 8 + i, 12 + i, m[2 * i], m[2 * i + 1])
        for i in range(4):
            mix(i, 4 + (i + 1) % 4, 8 + (i + 2) % 4, 12 + (i + 3) % 4, m[8 + 2 * i], m[9 + 2 * i])
        m = [m[i] for i in _ORDER]
    return np.column_stack([v[i] ^ v[i + 8] for i in range(8)])


def digests(texts: list[bytes]) -> list[str]:
    """Hexadecimal digests of 32 bytes."""
    if not texts:
        return []
    length = np.array([len(t) for t in texts], np.int64)
    chunks = np.maximum(1, -(-length // _CHUNK))
    owner = np.repeat(np.arange(len(texts)), chunks)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
    padded = np.zeros((len(owner), _CHUNK), np.uint8)
    flat = padded.reshape(-1)
    start = (np.cumsum(chunks) - chunks) * _CHUNK
    for s, t in zip(start.tolist(), texts, strict=True):
        flat[s : s + len(t)] = np.frombuffer(t, np.uint8)
    size = np.clip(length[owner] - place * _CHUNK, 0, _CHUNK)
    blocks = np.maximum(1, -(-size // _BLOCK))
    words = padded.view("<u4").astype(np.uint32)
    alone = chunks[owner] == 1
    chain = np.tile(_IV, (len(owner), 1))
    for k in range(int(blocks.max())):
        at = np.flatnonzero(blocks > k)
        last = blocks[at] == k + 1
        flags = np.where(k == 0, _START, 0) | np.where(last, _END, 0) | np.where(last & alone[at], _ROOT, 0)
        chain[at] = _compress(chain[at], words[at, 16 * k : 16 * k + 16], place[at], np.minimum(_BLOCK, size[at] - _BLOCK * k), flags)
    while len(owner) > len(texts):
        count = np.bincount(owner, minlength=len(texts))
        first = np.cumsum(count) - count
        place = np.arange(len(owner)) - first[owner]
        left = np.flatnonzero((place % 2 == 0) & (place + 1 < count[owner]))
        flags = np.where(count[owner[left]] == 2, _PARENT | _ROOT, _PARENT)
        zero = np.zeros(len(left), np.int64)
        joined = _compress(np.tile(_IV, (len(left), 1)), np.hstack([chain[left], chain[left + 1]]), zero, zero + _BLOCK, flags)
        kept = np.flatnonzero(place % 2 == 0)
        chain[left] = joined
        chain, owner = chain[kept], owner[kept]
    return [row.tobytes().hex() for row in chain.astype("<u4")]


def _in_slices(texts: pd.Series) -> list[str | None]:
    """Digests of texts, null for null, of so many at once as _SLICE allows."""
    out: list[str | None] = []
    held: list[bytes] = []
    places: list[int] = []
    size = 0

    def flush() -> None:
        nonlocal size
        for i, d in zip(places, digests(held), strict=True):
            out[i] = d
        held.clear()
        places.clear()
        size = 0

    for text in texts:
        out.append(None)
        if text is None:
            continue
        held.append(text.encode() if isinstance(text, str) else bytes(text))
        places.append(len(out) - 1)
        size += len(held[-1]) + _CHUNK
        if size >= _SLICE:
            flush()
    flush()
    return out


def blake3(column: Column) -> Column:
    """Hexadecimal BLAKE3 digest of a text's UTF-8 bytes; null for null."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield pd.Series(_in_slices(b), dtype=object)

    return run(column)
