"""Simple-8b word-aligned coding of token ids, whole arrays at a time (numpy).

A 64-bit word holds a 4-bit selector and 60 bits of payload: so many ids of so many bits each.  Ids are
coded in blocks of ``BLOCK``; every block starts a new word, and the number of words of each block is
kept, so blocks can be found and decoded without the ones before.  An id of more than 60 bits is an
escape: selector 0, and its place and value stand in a list of their own.
"""

from __future__ import annotations

import numpy as np

BLOCK = 256
#: selector -> (ids a word, bits an id); 0 is the escape
SELECTORS = ((1, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
COUNT = np.array([c for c, _ in SELECTORS], np.int64)
_TOP = np.array([(1 << b) - 1 for _, b in SELECTORS[1:]], np.uint64)


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(words, words per block, places of escapes, values of escapes)``."""
    ids = np.ascontiguousarray(ids, np.uint64)
    n_blocks = -(-len(ids) // BLOCK)
    if n_blocks == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint16), np.zeros(0, np.uint32), np.zeros(0, np.uint64)
    padded = np.zeros(n_blocks * BLOCK, np.uint64)
    padded[:len(ids)] = ids
    escapes = np.flatnonzero(padded > _TOP[-1])
    # the narrowest selector whose bits hold the id; an escape gets one more, so that no window takes it in
    if len(escapes) == 0 and padded.max() < 65536:
        need = _NARROWEST[padded.astype(np.int64)]
    else:
        need = (np.searchsorted(_TOP, padded) + 1).astype(np.uint8)
    need = need.reshape(n_blocks, BLOCK)
    best = np.zeros((n_blocks, BLOCK), np.uint8)
    reach, width = need, 1  # largest need of the next `width` ids (beyond the block: none)
    for s in range(len(SELECTORS) - 1, 0, -1):
        count = SELECTORS[s][0]
        while width < count:
            step = min(width, count - width)
            wider = reach.copy()
            np.maximum(reach[:, :-step], reach[:, step:], out=wider[:, :-step])
            reach, width = wider, width + step
        best[reach <= s] = s
    # all blocks take their words side by side, one word of each at a time
    at, live = np.zeros(n_blocks, np.int64), np.arange(n_blocks)
    owners, places, chosen = [], [], []
    while len(live):
        s = best[live, at[live]]
        owners.append(live)
        places.append(at[live])
        chosen.append(s)
        at[live] += COUNT[s]
        live = live[at[live] < BLOCK]
    owner, place, sel = np.concatenate(owners), np.concatenate(places), np.concatenate(chosen)
    order = np.lexsort((place, owner))
    owner, place, sel = owner[order], place[order], sel[order]
    begin = owner * BLOCK + place
    stop = (owner + 1) * BLOCK
    words = sel.astype(np.uint64) << np.uint64(60)
    for s in range(1, len(SELECTORS)):
        mine = np.flatnonzero(sel == s)
        count, bits = SELECTORS[s]
        acc = np.zeros(len(mine), np.uint64)
        for j in range(count):
            at_j = begin[mine] + j
            inside = at_j < stop[mine]
            acc |= np.where(inside, padded[np.minimum(at_j, len(padded) - 1)], np.uint64(0)) << np.uint64(j * bits)
        words[mine] |= acc
    return words, np.bincount(owner, minlength=n_blocks).astype(np.uint16), escapes.astype(np.uint32), padded[escapes]


def decode(words: np.ndarray, per_block: np.ndarray, escape_at: np.ndarray, escape_value: np.ndarray, n: int,
           first: int = 0, last: int | None = None) -> np.ndarray:
    """The ids of blocks ``first`` to ``last`` (exclusive; all by default); ``n`` is the number of all ids."""
    last = len(per_block) if last is None else last
    skip = int(per_block[:first].sum(dtype=np.int64))
    take = per_block[first:last].astype(np.int64)
    words = words[skip:skip + int(take.sum())]
    sel = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNT[sel]
    upto = np.cumsum(counts) - counts
    first_word = np.cumsum(take) - take
    owner = np.repeat(np.arange(len(take)), take)
    begin = owner * BLOCK + upto - upto[first_word][owner] if len(words) else np.zeros(0, np.int64)
    out = np.zeros((last - first) * BLOCK + 64, np.uint64)  # what a block's last word holds too many is zero
    stop = (owner + 1) * BLOCK
    for s in range(1, len(SELECTORS)):
        mine = np.flatnonzero(sel == s)
        count, bits = SELECTORS[s]
        for j in range(count):
            at = begin[mine] + j
            inside = at < stop[mine]
            out[at[inside]] = (words[mine[inside]] >> np.uint64(j * bits)) & _TOP[s - 1]
    lo, hi = first * BLOCK, min(n, last * BLOCK)
    mine = (escape_at >= lo) & (escape_at < hi)
    out[escape_at[mine].astype(np.int64) - lo] = escape_value[mine]
    return out[:hi - lo]


_NARROWEST = (np.searchsorted(_TOP, np.arange(65536, dtype=np.uint64)) + 1).astype(np.uint8)
