"""Words and word shingles of Arrow text batches as 64-bit hashes, whole arrays at a time (numpy).

Used inside Arrow tasks.  A batch is cut at document borders into pieces of a few MB, so memory is a
small multiple of the piece, or of the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from cordon.llm.idcache import worker_cache

U = np.uint64
PIECE = 2 << 20
#: where each piece becomes sets and nothing is looked up across it, arrays that fit a core's cache are quicker
SET_PIECE = 1 << 18
_BASE = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd
#: tables of powers grow by so many entries; pieces of 2 MB leave 40 MB of them a base
_STEP_UP = 1 << 19
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = worker_cache()

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: anything but 0-9, a-z and bytes of multi-byte characters (after A-Z became a-z)
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def pieces(texts: pa.Array, limit: int = PIECE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, row after the last, bytes, offsets)``; nulls are empty texts."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(pc.cast(texts, pa.large_string()), "")
    if len(texts) == 0:
        return
    bufs = texts.buffers()
    offsets = np.frombuffer(bufs[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None and bufs[2].size else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(texts):
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), len(texts))
        yield lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z as a-z."""
    return data + (((data >= 65) & (data <= 90)).astype(np.uint8) << 5)


def _powers(n: int, which: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, at least ``n``."""
    if which not in _POWERS or len(_POWERS[which][0]) < n:
        size = -(-n // _STEP_UP) * _STEP_UP
        base = _BASE[which]
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, U)
            p[0] = 1
            both.append(np.cumprod(p, dtype=U))
        if n > 4 * PIECE:  # one very long text: not kept
            return both[0], both[1]
        _POWERS[which] = (both[0], both[1])
    return _POWERS[which]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def prefix_hash(data: np.ndarray, which: int = 0) -> np.ndarray:
    """Running sums from which ``span_hash`` takes the hash of any span."""
    out = np.empty(len(data) + 1, U)
    out[0] = 0
    np.cumsum((data.astype(U) + U(1)) * _powers(len(data) + 1, which)[0][:len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, stop: np.ndarray, which: int = 0) -> np.ndarray:
    inverse = _powers(len(prefix), which)[1]
    return mix((prefix[stop] - prefix[start]) * inverse[start] + (stop - start).astype(U))


def word_spans(data: np.ndarray, offsets: np.ndarray, gap: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(document, start, stop)`` of each word; ``gap`` says which bytes are not of words."""
    inside = ~gap[data]
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    borders = offsets[(offsets > 0) & (offsets < n)]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    first[borders] = inside[borders]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[borders - 1] = inside[borders - 1]
    start, stop = np.flatnonzero(first), np.flatnonzero(last) + 1
    return np.searchsorted(offsets, start, "right") - 1, start, stop


_STEP = np.array([0x9FB21C651E98DF25, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3], U)


def shingles(words: np.ndarray, doc: np.ndarray, n_docs: int, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, document)`` of all k-word shingles in order; a text with fewer words is one shingle."""
    n = len(words)
    counts = np.bincount(doc, minlength=n_docs)
    steps = _STEP if k <= len(_STEP) else mix(np.arange(1, k + 1, dtype=U) * _STEP[0]) | U(1)
    at = np.flatnonzero(doc[: n - k + 1] == doc[k - 1:]) if n >= k else np.zeros(0, np.int64)
    h = np.zeros(len(at), U)
    for j in range(k):
        h += words[at + j] * steps[j]
    of = doc[at] if len(at) else np.zeros(0, np.int64)
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        begin = np.cumsum(counts) - counts
        extra = counts[short].astype(U) * U(0x2545F4914F6CDD1D)
        for j in range(k - 1):
            has = counts[short] > j
            extra[has] += words[begin[short][has] + j] * steps[j]
        h, of = np.concatenate([h, extra]), np.concatenate([of, short])
        order = np.argsort(of, kind="stable")
        h, of = h[order], of[order]
    return mix(h), of


def shingle_sets(texts: pa.Array, k: int = 5) -> Iterator[tuple[int, np.ndarray]]:
    """``(row, sorted distinct shingle hashes)`` of each text, lower-cased A-Z."""
    for lo, hi, data, offsets in pieces(texts, SET_PIECE):
        data = lowered(data)
        doc, start, stop = word_spans(data, offsets)
        h, of = shingles(span_hash(prefix_hash(data), start, stop), doc, hi - lo, k)
        ends = np.searchsorted(of, np.arange(hi - lo + 1))
        for i in range(hi - lo):
            yield lo + i, np.unique(h[ends[i]:ends[i + 1]])
