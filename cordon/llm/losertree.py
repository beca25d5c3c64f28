"""Merging front-coded sorted runs of byte strings with a loser tree that knows common prefixes.

Next to every string in the tree stands the length of its common prefix with the string that went out
last (for a loser: with the winner it lost to).  Of two strings the one with the longer such prefix is
the smaller; only when the prefixes are equally long are bytes compared, and only from there on.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np


def common_prefix(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the common prefix, known to be at least ``start``."""
    n = min(len(a), len(b))
    x, y = a[start:n], b[start:n]
    if x == y:
        return n
    diff = int.from_bytes(x, "big") ^ int.from_bytes(y, "big")
    return n - 1 - (diff.bit_length() - 1) // 8


def front_code(strings: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, bytes]:
    """A sorted run as ``(common prefix with the one before, length, the rest of each string)``."""
    shared, before = np.zeros(len(strings), np.uint16), b""
    for i, s in enumerate(strings):
        shared[i] = common_prefix(before, s)
        before = s
    return shared, np.array([len(s) for s in strings], np.uint16), b"".join(s[k:] for s, k in zip(strings, shared.tolist()))


def decode_run(shared: np.ndarray, lengths: np.ndarray, rests: bytes) -> Iterator[tuple[int, bytes]]:
    """``(common prefix with the one before, string)``."""
    at, s = 0, b""
    for k, n in zip(shared.tolist(), lengths.tolist()):
        s = s[:k] + rests[at:at + n - k]
        at += n - k
        yield k, s


def merge(runs: Sequence[Iterator[tuple[int, bytes]]]) -> Iterator[tuple[int, int, bytes]]:
    """``(run, common prefix with the string put out before, string)`` in ascending order."""
    k = 1
    while k < len(runs):
        k *= 2
    iters = [iter(r) for r in runs] + [iter(())] * (k - len(runs))
    strings: list[bytes | None] = [None] * k  # None: the run is over
    prefix = [0] * k
    for i, it in enumerate(iters):
        for prefix[i], strings[i] in it:
            prefix[i] = 0  # nothing went out yet
            break

    losers = [0] * k

    def play(held: int, comer: int) -> tuple[int, int]:
        """Winner and loser; the loser's prefix becomes that with the winner."""
        if strings[held] is None:
            return comer, held
        if strings[comer] is None:
            return held, comer
        a, b = prefix[held], prefix[comer]
        if a != b:
            return (held, comer) if a > b else (comer, held)
        s, t = strings[held], strings[comer]
        h = common_prefix(s, t, a)
        # equal strings: the lower run first, so the merge is stable
        less = s[h:h + 1] < t[h:h + 1] if s[h:h + 1] != t[h:h + 1] else held < comer
        winner, loser = (held, comer) if less else (comer, held)
        prefix[loser] = h
        return winner, loser

    def build(node: int) -> int:
        if node >= k:
            return node - k
        winner, losers[node] = play(build(2 * node), build(2 * node + 1))
        return winner

    top = build(1)
    while strings[top] is not None:
        yield top, prefix[top], strings[top]
        strings[top] = None
        for prefix[top], strings[top] in iters[top]:  # the front code is the prefix with what just went out
            break
        node = (top + k) // 2
        while node:
            top, losers[node] = play(losers[node], top)
            node //= 2
