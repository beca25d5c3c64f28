"""Token ids of strings met lately, looked up whole arrays at a time.

Strings are known by two 64-bit hashes, and a table is a few sorted numpy arrays: some 40 bytes an entry, and
one binary search for all strings of a piece.  Used inside Arrow tasks, one table per worker.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable

import numpy as np
import pyarrow as pa

_CACHES: list[dict] = []


def worker_cache() -> dict:
    """A dictionary that a Python worker keeps from task to task, until other work calls ``forget``."""
    _CACHES.append({})
    return _CACHES[-1]


def forget() -> None:
    """Empty this worker's caches and give the memory back: Spark reuses workers, and what the tokens of one stage
    needed should not lie beside the next stage's arrays."""
    for cache in _CACHES:
        cache.clear()
    gc.collect()
    give_back()


def give_back() -> None:
    """Return freed memory to the machine; the C library and Arrow keep it otherwise, and every worker of an executor has its own."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)


class _Half:
    def __init__(self):
        self.key, self.check = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.begin, self.size, self.pool = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def find(self, key: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(whether known, its place)``."""
        if len(self.key) == 0:
            return np.zeros(len(key), bool), np.zeros(len(key), np.int64)
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return (self.key[at] == key) & (self.check[at] == check), at

    def add(self, key: np.ndarray, check: np.ndarray, size: np.ndarray, pool: np.ndarray) -> None:
        begin = np.cumsum(size) - size + len(self.pool)
        order = np.argsort(key, kind="stable")
        key, check, begin, size = key[order], check[order], begin[order], size[order]
        at = np.searchsorted(self.key, key)
        self.key, self.check = np.insert(self.key, at, key), np.insert(self.check, at, check)
        self.begin, self.size = np.insert(self.begin, at, begin), np.insert(self.size, at, size)
        self.pool = np.concatenate([self.pool, pool])


def gather(pool: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The spans of ``pool``, one after the other."""
    upto = np.cumsum(size)
    return pool[np.repeat(begin - (upto - size), size) + np.arange(int(upto[-1]) if len(upto) else 0)]


class KnownIds:
    """Two generations: when the younger one is full, it becomes the older one, and what is still in use moves on."""

    def __init__(self, limit: int = 500_000):
        self.limit, self.young, self.old = limit, _Half(), _Half()

    def ids_of(self, key: np.ndarray, check: np.ndarray, encode: Callable[[np.ndarray], list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(pool, begin, size)`` of the ids of each of the distinct strings; ``encode`` gets the positions of
        unknown ones and returns their ids as bytes of 32-bit integers."""
        young, at_young = self.young.find(key, check)
        old, at_old = self.old.find(key, check)
        old &= ~young
        new = np.flatnonzero(~(young | old))
        made = encode(new) if len(new) else []
        made_pool, made_size = np.frombuffer(b"".join(made), "<u4"), np.array([len(x) for x in made], np.int64) >> 2
        begin, size = np.zeros(len(key), np.int64), np.zeros(len(key), np.int64)
        begin[young], size[young] = self.young.begin[at_young[young]], self.young.size[at_young[young]]
        begin[old], size[old] = self.old.begin[at_old[old]] + len(self.young.pool), self.old.size[at_old[old]]
        begin[new], size[new] = np.cumsum(made_size) - made_size + len(self.young.pool) + len(self.old.pool), made_size
        pool = np.concatenate([self.young.pool, self.old.pool, made_pool])
        moved = np.flatnonzero(~young)
        if len(moved):
            self.young.add(key[moved], check[moved], size[moved], gather(pool, begin[moved], size[moved]))
            if len(self.young.key) > self.limit:
                self.old, self.young = self.young, _Half()
        return pool, begin, size


class Recent:
    """A dictionary of what was used lately, in two halves: a full younger half becomes the older one."""

    def __init__(self, limit: int):
        self.limit = limit
        self.young: dict = {}
        self.old: dict = {}

    def get(self, key) -> bytes | None:
        found = self.young.get(key)
        if found is None:
            found = self.old.get(key)
            if found is not None:
                self.put(key, found)
        return found

    def put(self, key, value: bytes) -> None:
        if len(self.young) >= self.limit:
            self.old, self.young = self.young, {}
        self.young[key] = value
