"""Vectorised word kernel shared by the text operators.

A *word* is a maximal run of ASCII letters, ASCII digits and non-ASCII
characters of the lower-cased text; anything else separates.  Null counts as
empty text.  Whole Arrow batches are tokenised and hashed with numpy passes
over the UTF-8 buffer, in slices of about half a megabyte so that the temporaries
stay in cache and the memory of a worker doesn't follow the batch size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19
#: Words are hashed so many bytes at a time, so that the 64-bit temporaries of a very long text stay small.
HASH_BYTES = 1 << 20
U = np.uint64

IS_WORD = np.zeros(256, dtype=bool)
IS_WORD[ord("0") : ord("9") + 1] = True
IS_WORD[ord("a") : ord("z") + 1] = True
IS_WORD[ord("A") : ord("Z") + 1] = True
IS_WORD[128:] = True

_rng = np.random.default_rng(20240607)
BYTE_CODE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_P = U(0x9E3779B97F4A7C15 | 1)
_P_INV = U(pow(int(_P), -1, 2**64))
_pow = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base of the rolling sum, and of its inverse."""
    if "p" not in _pow or len(_pow["p"]) < n:
        size = max(n, SLICE_BYTES + 4096)
        for name, base in (("p", _P), ("i", _P_INV)):
            a = np.full(size, base, dtype=np.uint64)
            a[0] = 1
            _pow[name] = np.cumprod(a, dtype=np.uint64)
    return _pow["p"], _pow["i"]


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every input bit over all 64."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


@dataclass
class Words:
    """Words of a slice of rows: row i has words first[i] to first[i + 1]."""

    buf: np.ndarray  # lower-cased UTF-8 of the slice
    row_at: np.ndarray  # byte at which each row begins, and the end
    first: np.ndarray
    start: np.ndarray  # bytes of each word
    end: np.ndarray
    hash: np.ndarray  # 64 bits for each word

    @property
    def rows(self) -> int:
        return len(self.first) - 1

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), np.diff(self.first))


def _bytes(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.frombuffer(arr.buffers()[1], dtype=np.int64 if pa.types.is_large_string(arr.type) else np.int32)[arr.offset : arr.offset + len(arr) + 1].astype(np.int64)
    data = arr.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def spans(buf: np.ndarray, row_at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the first word of each row."""
    inside = IS_WORD[buf]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    edge = row_at[1:-1]
    edge = edge[(edge > 0) & (edge < len(buf))]
    begins[edge] = inside[edge]  # a word never goes on from one row into the next
    ends[edge - 1] = inside[edge - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(start, row_at)


def words(arr: pa.Array) -> Words:
    """Tokenise and hash one array of texts."""
    buf, row_at = _bytes(pc.utf8_lower(pc.fill_null(arr, "")))
    start, end, first = spans(buf, row_at)
    h, lo = np.empty(len(start), dtype=np.uint64), 0
    while lo < len(start):
        hi = max(lo + 1, int(np.searchsorted(start, start[lo] + HASH_BYTES)))
        a, n = start[lo], end[hi - 1] - start[lo]
        p, inv = powers(n + 1)
        acc = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(BYTE_CODE[buf[a : a + n]] * p[:n], out=acc[1:])
        b, e = start[lo:hi] - a, end[lo:hi] - a
        h[lo:hi] = mix((acc[e] - acc[b]) * inv[b] + (e - b).astype(np.uint64))
        lo = hi
    return Words(buf, row_at, first, start, end, h)


def pieces(raw: np.ndarray, size: int) -> Iterator[bytes]:
    """UTF-8 in pieces of about size bytes, each but the last ending between words; a longer word stays whole."""
    lo = 0
    while lo < len(raw):
        hi, at = lo, lo
        while hi < len(raw):
            hi = min(len(raw), hi + size)
            between = np.flatnonzero(~IS_WORD[raw[at:hi]])
            if len(between) and hi < len(raw):
                hi = at + int(between[-1]) + 1
                break
            at = hi
        yield raw[lo:hi].tobytes()
        lo = hi


def slices(batch: pa.RecordBatch, text: str = "text", size: int = SLICE_BYTES, long: int | None = None) -> Iterator[tuple[pa.RecordBatch, Words | None]]:
    """The batch in slices of whole rows of about size bytes of text, with their words; a longer row is a slice of its own.

    With `long`, a row of more bytes comes without its words: it is for the caller to read in pieces.
    """
    col = batch.column(batch.schema.get_field_index(text))
    n = batch.num_rows
    if not n:
        return
    at = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False))])
    i = 0
    while i < n:
        j = min(n, max(i + 1, int(np.searchsorted(at, at[i] + size, side="right")) - 1))
        part = batch.slice(i, j - i)
        if long is not None and at[j] - at[i] > long and j == i + 1:
            yield part, None
        else:
            yield part, words(part.column(part.schema.get_field_index(text)))
        i = j


def grams(w: Words, k: int, short: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all runs of k words, and where each row's begin.

    With short, a row of 1 to k-1 words has one gram, of all its words.
    Gram j of row i begins at word first[i] + j.
    """
    n = np.diff(w.first)
    count = np.maximum(n - k + 1, 0)
    total = len(w.hash)
    if total >= k:
        g = w.hash[: total - k + 1].copy()
        for j in range(1, k):
            g *= U(0xD6E8FEB86659FD93)
            g += w.hash[j : total - k + 1 + j]
        g = mix(g)
    else:
        g = np.zeros(0, np.uint64)
    firsts = np.concatenate([[0], np.cumsum(count)])
    index = np.arange(firsts[-1]) + np.repeat(w.first[:-1] - firsts[:-1], count)
    g = g[index]
    little = np.flatnonzero((n > 0) & (n < k)) if short else []
    if len(little):
        extra = []
        for i in little:
            x = U(n[i])
            for h in w.hash[w.first[i] : w.first[i + 1]]:
                x = U((int(x) * 0xD6E8FEB86659FD93 + int(h)) & 0xFFFFFFFFFFFFFFFF)
            extra.append(x)
        extra = mix(np.array(extra, dtype=np.uint64))
        g = np.insert(g, firsts[little], extra)
        count = count.copy()
        count[little] = 1
        firsts = np.concatenate([[0], np.cumsum(count)])
    return g, firsts


def minhashes(g: np.ndarray, firsts: np.ndarray, n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """n minimum hashes (32 bits) of each row that has grams; the rows' numbers, and an array of n columns."""
    rows = np.flatnonzero(np.diff(firsts))
    out = np.empty((len(rows), n), dtype=np.uint64)
    if len(rows):
        rng = np.random.default_rng(seed)
        a = rng.integers(1, 2**63, n, dtype=np.uint64) * U(2) + U(1)
        b = rng.integers(0, 2**63, n, dtype=np.uint64)
        at = firsts[rows]
        tmp = np.empty_like(g)
        for j in range(n):
            np.multiply(g, a[j], out=tmp)
            tmp += b[j]
            tmp >>= U(32)
            out[:, j] = np.minimum.reduceat(tmp, at)
    return rows, out


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def lists(values: np.ndarray, firsts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list array of values cut at firsts."""
    return pa.ListArray.from_arrays(pa.array(firsts.astype(np.int32), pa.int32()), pa.array(values, kind))


def winnow(g: np.ndarray, firsts: np.ndarray, window: int) -> np.ndarray:
    """Positions in g of the least gram (the last of equals) of every window of a row; a shorter row is one window."""
    n = np.diff(firsts)
    if not len(g):
        return np.zeros(0, np.int64)
    pad = np.concatenate([g, np.full(window - 1, ~U(0))])
    best, at = pad[: len(g)].copy(), np.arange(len(g))
    here = np.arange(len(g))
    for j in range(1, window):
        other = pad[j : len(g) + j]
        take = other <= best
        best[take] = other[take]
        at[take] = here[take] + j
    full = here + window <= np.repeat(firsts[1:], n)
    chosen = np.zeros(len(g), dtype=bool)
    chosen[at[full]] = True
    for i in np.flatnonzero((n > 0) & (n < window)):
        part = g[firsts[i] : firsts[i + 1]]
        chosen[firsts[i + 1] - 1 - int(np.argmin(part[::-1]))] = True
    return np.flatnonzero(chosen)


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
