"""Benchmark decontamination by rare n-gram seeds and Smith-Waterman alignment (operator 5).

1. How many documents hold each word n-gram of the benchmark is counted over the whole corpus.
2. Seeds: every n-gram of an item that some document holds, and every two pairs of neighbouring words with at
   most one word between the pairs, in the item, in the document or in both.  There is no limit on how common a
   seed may be: which ones an edited copy keeps cannot be told from counts, so none is left out.  A copy
   without any seed has single words between its edits at least every other time, so where words were replaced
   or dropped its score is at most 0.4 of the best, up to the copy's ends; words put in lower the score less, and
   a copy with one after every word or two can be missed.
3. Around a seed the words that the stretch and the item share bound the score.  Where the bound reaches
   the limit the stretch is aligned, word by word, with the item.  The local alignment score over the
   best possible one is the degree of contamination; edited copies keep most of it.

The documents are only read: two passes, no shuffle of text.  What goes to the tasks is the benchmark,
in slices of at most ``SLICE`` words (one pass for each slice), so its size is bounded whatever it holds.  Texts are
worked on in pieces of 256 KB, and workers give back what earlier work and each batch leave.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cordon.llm.idcache import forget, give_back
from cordon.llm.wordhash import NOT_ALNUM, SET_PIECE, lowered, pieces, prefix_hash, shingles, span_hash, word_spans

GRAM = 3
SLICE = 400_000  # words; a word begins three seeds at most
#: a document is contaminated from this share of the best score on
LIMIT = 0.4
MATCH, MISMATCH, GAP = 2, -1, -1
_FILTER = 1 << 20
_PAIRS = 512
#: seed hits, and words of stretches, that are looked at together
_AT_ONCE = 1 << 20


def _words(data: np.ndarray, offsets: np.ndarray):
    """``(document, hash)`` of the words: runs of 0-9, a-z and non-ASCII characters, lower-cased A-Z."""
    data = lowered(data)
    doc, start, stop = word_spans(data, offsets, NOT_ALNUM)
    return doc, span_hash(prefix_hash(data), start, stop)


def _grams(words: np.ndarray, doc: np.ndarray, n: int):
    """``(hash, first word)`` of all n-grams inside one document."""
    if len(words) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(doc[: len(doc) - n + 1] == doc[n - 1:])
    h, _ = shingles(words, np.zeros(len(words), np.int64), 1, n)
    return h[at], at


def _seeds(words: np.ndarray, doc: np.ndarray, n: int):
    """``(hash, first word)`` of the n-grams and of two pairs of words with no or one word between them; the
    word between is not part of the hash."""
    found = [_grams(words, doc, n)]
    if len(words) >= 4:
        pair, _ = shingles(words, np.zeros(len(words), np.int64), 1, 2)
        for gap in (0, 1):
            at = np.flatnonzero(doc[: max(len(doc) - 3 - gap, 0)] == doc[3 + gap:])
            found.append(((pair[at] * np.uint64(0x9E3779B97F4A7C15)) ^ (pair[at + 2 + gap] * np.uint64(0xC2B2AE3D27D4EB4F)), at))
    return np.concatenate([h for h, _ in found]), np.concatenate([at for _, at in found])


class Lookup:
    """Which of many hashes are among a few: a bit table first, then the sorted few."""

    def __init__(self, few: np.ndarray):
        self.few = np.unique(few)
        self.table = np.zeros(_FILTER, bool)
        self.table[(self.few & np.uint64(_FILTER - 1)).astype(np.int64)] = True

    def __call__(self, many: np.ndarray) -> np.ndarray:
        maybe = np.flatnonzero(self.table[(many & np.uint64(_FILTER - 1)).astype(np.int64)])
        if len(maybe) == 0 or len(self.few) == 0:
            return np.zeros(0, np.int64)
        place = np.minimum(np.searchsorted(self.few, many[maybe]), len(self.few) - 1)
        return maybe[self.few[place] == many[maybe]]


@dataclass
class Items:
    """A slice of the benchmark: word hashes of each item, and later its seeds as ``(hash, item, word)`` and
    its words as hashes of ``(item, word)``."""

    ids: list
    words: list[np.ndarray]
    seeds: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None
    held: Lookup | None = None


def _slices(benchmark: DataFrame, id_col: str, text_col: str):
    """The benchmark from the driver's side, a slice at a time."""
    held = Items([], [])
    size = 0
    rows = benchmark.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")) \
        .distinct().orderBy("id", "text")
    for row in rows.toLocalIterator():
        raw = (row["text"] or "").encode()
        _, h = _words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)], np.int64))
        held.ids.append(row["id"])
        held.words.append(h)
        size += len(h)
        if size >= SLICE:
            yield held
            held, size = Items([], []), 0
    if held.ids:
        yield held


def _document_counts(docs: DataFrame, items: Items, gram: int) -> dict[int, int]:
    """How many documents hold each seed of the slice."""
    spark = docs.sparkSession
    every = [_seeds(w, np.zeros(len(w), np.int64), gram)[0] for w in items.words]
    look = spark.sparkContext.broadcast(Lookup(np.concatenate(every) if every else np.zeros(0, np.uint64)))  # at most 3 * SLICE hashes

    def run(batches):
        forget()
        find = look.value
        total = np.zeros(len(find.few), np.int64)
        for batch in batches:
            for _, _, data, offsets in pieces(batch.column(0), SET_PIECE):
                doc, words = _words(data, offsets)
                h, at = _seeds(words, doc, gram)
                hit = find(h)
                if len(hit):
                    which = np.searchsorted(find.few, h[hit])
                    seen, n = np.unique(np.unique(which * len(offsets) + doc[at[hit]]) // len(offsets), return_counts=True)
                    total[seen] += n
            give_back()
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(find.few[held].view(np.int64)), pa.array(total[held])], ["h", "n"])

    rows = docs.mapInArrow(run, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n")).toPandas()
    return dict(zip(rows["h"].to_numpy(np.int64).view(np.uint64).tolist(), rows["n"].tolist()))


def _in_item(words: np.ndarray, item: np.ndarray) -> np.ndarray:
    """Hashes of ``(item, word)``; pairs that fall together can only raise a bound."""
    return words ^ ((item.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))


def pick_seeds(items: Items, counts: dict[int, int], gram: int = GRAM) -> None:
    """Every seed of an item that is in some document."""
    out = [[np.zeros(0, t)] for t in (np.uint64, np.int64, np.int64)]
    for i, w in enumerate(items.words):
        h, at = _seeds(w, np.zeros(len(w), np.int64), gram)
        live = np.array([counts.get(x, 0) > 0 for x in h.tolist()], bool)
        for x, v in zip(out, (h[live], np.full(int(live.sum()), i, np.int64), at[live])):
            x.append(v)
    seed, item, place = (np.concatenate(x) for x in out)
    order = np.argsort(seed, kind="stable")
    items.seeds = seed[order], item[order], place[order]
    items.held = Lookup(np.concatenate([np.zeros(0, np.uint64), *[_in_item(w, np.full(len(w), i)) for i, w in enumerate(items.words)]]))


def align(left: np.ndarray, left_size: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment score of each pair of rows, and where it ends in ``right``.

    ``left`` is padded with zeros beyond ``left_size``; ``right`` may be padded with ones (words are neither).
    Row by row; a run of gaps along the row is a running maximum.
    """
    n, width = right.shape
    slope = np.arange(width, dtype=np.int32) * -GAP
    h = np.zeros((n, width), np.int32)
    best, where = np.zeros(n, np.int32), np.zeros(n, np.int64)
    for i in range(int(left_size.max(initial=0))):
        diagonal = np.zeros_like(h)
        diagonal[:, 1:] = h[:, :-1]
        same = right == left[:, i:i + 1]
        h = np.maximum(np.maximum(diagonal + np.where(same, MATCH, MISMATCH), h + GAP), 0)
        h = np.maximum.accumulate(h + slope, axis=1) - slope
        h[i >= left_size] = 0
        end = h.argmax(axis=1)
        top = h[np.arange(n), end]
        better = top > best
        best[better], where[better] = top[better], end[better]
    return best, where


def _parts(sizes: np.ndarray):
    """Ranges ``(lo, hi)`` of ``_AT_ONCE`` together at most, or of one."""
    ends = np.cumsum(sizes)
    lo = 0
    while lo < len(sizes):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + _AT_ONCE, "right")))
        yield lo, hi
        lo = hi


def _each(first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``first[i]``, ``first[i] + 1``, ... ``n[i]`` times for each ``i``: the ``i`` and the numbers."""
    which = np.repeat(np.arange(len(n)), n)
    return which, first[which] + np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)


def _one_per_step(d, item, step, least, most):
    """The least and the greatest offset of each ``(document, item, step)``."""
    order = np.lexsort((step, item, d))
    d, item, step, least, most = (x[order] for x in (d, item, step, least, most))
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (item[1:] != item[:-1]) | (step[1:] != step[:-1])
    at = np.flatnonzero(new)
    if len(at) == 0:
        return d, item, step, least, most
    return d[at], item[at], step[at], np.minimum.reduceat(least, at), np.maximum.reduceat(most, at)


def _hits(words: np.ndarray, doc: np.ndarray, n_docs: int, items: Items, look: Lookup, gram: int, limit: float):
    """``(document, item, first word, score, last word)`` of the best alignment of each pair that shares a seed;
    pairs that cannot reach ``limit`` may be missing."""
    h, at = _seeds(words, doc, gram)
    hit = look(h)
    none = [np.zeros(0, np.int64)] * 5
    if len(hit) == 0:
        return none
    seed, item_of, place_of = items.seeds
    lo, hi = np.searchsorted(seed, h[hit], "left"), np.searchsorted(seed, h[hit], "right")
    size = np.array([len(w) for w in items.words], np.int64)
    begin = np.searchsorted(doc, np.arange(n_docs + 1))
    # seeds of one copy ask for nearly the same stretch: for each step of half an item one is aligned that
    # holds all of theirs
    found = []
    for a, b in _parts(hi - lo):
        which, k = _each(lo[a:b], (hi - lo)[a:b])
        word, item = at[hit[a:b]][which], item_of[k]
        offset = word - place_of[k]
        step = np.maximum((offset - begin[doc[word]]) // np.maximum(size[item] // 2, 1), -1) + 1
        found.append(_one_per_step(doc[word], item, step, offset, offset))
    d, item, _, least, most = _one_per_step(*(np.concatenate(x) for x in zip(*found)))
    slack = size[item] // 4 + 4
    start = np.maximum(least - slack, begin[d])
    stop = np.minimum(most + size[item] + slack, begin[d + 1])
    # a score is at most MATCH for each word of the stretch that the item holds
    able = np.zeros(len(d), bool)
    for a, b in _parts(stop - start):
        which, k = _each(start[a:b], (stop - start)[a:b])
        same = items.held(_in_item(words[k], item[a:b][which]))
        able[a:b] = np.bincount(which[same], minlength=b - a) >= limit * size[item[a:b]] - 1e-9
    d, item, start, stop = d[able], item[able], start[able], stop[able]
    if len(d) == 0:
        return none
    score, last = np.zeros(len(d), np.int64), np.zeros(len(d), np.int64)
    by_size = np.argsort(size[item], kind="stable")
    for c in range(0, len(d), _PAIRS):
        rows = by_size[c:c + _PAIRS]
        left = np.zeros((len(rows), int(size[item[rows]].max())), np.uint64)
        right = np.ones((len(rows), int((stop - start)[rows].max())), np.uint64)
        for x, r in enumerate(rows.tolist()):
            left[x, :size[item[r]]] = items.words[item[r]]
            right[x, :stop[r] - start[r]] = words[start[r]:stop[r]]
        score[rows], end = align(left, size[item[rows]], right)
        last[rows] = start[rows] + end
    order = np.lexsort((last, -score, item, d))
    d, item, start, score, last = (x[order] for x in (d, item, start, score, last))
    best = np.ones(len(d), bool)
    best[1:] = (d[1:] != d[:-1]) | (item[1:] != item[:-1])
    d, item, start, score, last = (x[best] for x in (d, item, start, score, last))
    return d, item, start - begin[d], score, last - begin[d]


def _prepared(docs: DataFrame, benchmark: DataFrame, item_col: str, item_text_col: str, gram: int):
    for items in _slices(benchmark, item_col, item_text_col):
        pick_seeds(items, _document_counts(docs, items, gram), gram)
        yield docs.sparkSession.sparkContext.broadcast((items, Lookup(items.seeds[0])))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", gram: int = GRAM,
                 limit: float = LIMIT) -> DataFrame:
    """``id, item_id, score, first_word, last_word``: every document and item that share a seed and align with
    at least ``limit`` of the item's best score; the best alignment of each pair, words counted from 0
    (``first_word`` is where the aligned stretch was cut out, ``last_word`` where the alignment ends).

    Null or empty texts, and items of fewer than ``gram`` words, match nothing.  Null ids are carried.
    Repeated documents give repeated rows; repeated items count once.  Empty tables give no rows.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    names = ["id", "item_id", "score", "first_word", "last_word"]
    schema = "id bigint, item_id bigint, score double, first_word bigint, last_word bigint"
    out = None
    for held in _prepared(rows.select("text"), benchmark, item_col, item_text_col, gram):
        def run(batches, held=held):
            forget()
            items, look = held.value
            size, names_of = np.array([len(w) for w in items.words], np.int64), pa.array(items.ids, pa.int64())
            for batch in batches:
                for lo, hi, data, offsets in pieces(batch.column(1), SET_PIECE):
                    doc, words = _words(data, offsets)
                    d, item, first, score, last = _hits(words, doc, hi - lo, items, look, gram, limit)
                    share = score / np.maximum(MATCH * size[item], 1)
                    good = np.flatnonzero(share >= limit)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(lo + d[good])), names_of.take(pa.array(item[good])), pa.array(share[good]),
                         pa.array(first[good]), pa.array(last[good])], names)
                give_back()

        found = rows.mapInArrow(run, schema)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else rows.limit(0).select(
        "id", F.lit(0).cast("long").alias("item_id"), F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("first_word"),
        F.lit(0).cast("long").alias("last_word"))


def clean_rows(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
               item_text_col: str = "text", gram: int = GRAM, limit: float = LIMIT) -> DataFrame:
    """The input's rows and columns without the contaminated ones, decided where they lie."""
    at = docs.columns.index(text_col)
    out = docs
    for held in _prepared(docs.select(F.col(f"`{text_col}`").cast("string").alias("text")), benchmark, item_col, item_text_col, gram):
        def run(batches, held=held):
            forget()
            items, look = held.value
            size = np.array([len(w) for w in items.words], np.int64)
            for batch in batches:
                for lo, hi, data, offsets in pieces(batch.column(at), SET_PIECE):
                    doc, words = _words(data, offsets)
                    d, item, _, score, _ = _hits(words, doc, hi - lo, items, look, gram, limit)
                    keep = np.ones(hi - lo, bool)
                    keep[d[score >= limit * MATCH * size[item]]] = False
                    yield batch.slice(lo, hi - lo).filter(pa.array(keep))  # no second copy of a batch, here or where it is read
                give_back()

        out = out.mapInArrow(run, docs.schema)
    return out
