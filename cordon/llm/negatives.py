"""Hard negatives by an inverted multi-index (operator 13).

A vector is two halves, and each half has a codebook; a pair of codewords is a cell.  With the codewords'
radii (the greatest distance of a member's half to its codeword) the score of any member of a cell is at
most the sum of two half-score bounds, ``q . c + |q| r`` each.  A heap over the two codebooks, sorted by
these bounds, visits an anchor's cells in descending order of the sum, so the bound of the next cell is a
bound of everything not visited.  An anchor is done when its windows are certified by that bound: the last
of its five positives is above it, and each positive's negatives are full above it, or it is below the
window.  Results are exact; the codebooks decide only how many cells are visited.

Spark does the search in rounds: visits ``(anchor, cell)`` meet the cells' blocks in a shuffle, a task
holds one block and scores the anchors that come by, and the few best of each anchor and block go into a
ranking.  The anchors that are not done go into the next round with four times as many cells, so the rounds
are few.  A cell of many rows is many blocks, and a cell that many anchors visit is dealt to many tasks.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cordon.llm.scratch import discard, written

POSITIVES = 5
NEGATIVES = 10
#: a negative's score is between these hundredths of its positive's
LEAST, MOST = 30, 90
#: the codebooks are fitted on so many rows at most, those with the least hashes of their ids
FIT_ROWS = 8192
#: rows a cell has on average, until the codebooks have MAX_WORDS codewords
CELL_ROWS = 512
MAX_WORDS = 64
BLOCK_ROWS = 2048
#: visits of a cell that go to one task
VISITS = 4096
#: cells of the first round; four times as many in each round after it
FIRST_CELLS = 16
#: scores stay below this, so that a hundred times a score fits 64 bits
LIMIT = 1 << 56


def usable(vector: Column) -> Column:
    """A vector without null, NaN or infinite components."""
    return vector.isNotNull() & F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))


def quantised(vector: Column) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * 256).cast("long"))


def k_means(rows: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """At most ``k`` codewords of a sample of half vectors."""
    words = np.unique(rows, axis=0, return_index=True)[1]
    words = rows[np.sort(words)[:k]].astype(np.float64)
    for _ in range(rounds):
        near = _nearest(rows, words)[0]
        count = np.bincount(near, minlength=len(words))
        total = np.zeros_like(words)
        np.add.at(total, near, rows)
        words[count > 0] = total[count > 0] / count[count > 0, None]
    return words


def _nearest(rows: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(codeword, distance to it)`` of each row."""
    near = np.argmin((words ** 2).sum(axis=1)[None, :] - 2 * rows @ words.T, axis=1)
    return near, np.sqrt(((rows - words[near]) ** 2).sum(axis=1))


def _padded(column: pa.Array, d: int) -> np.ndarray:
    """Vectors as a matrix of ``d`` columns; shorter ones end in zeros."""
    out = np.zeros((len(column), d), np.int64)
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = lists.value_lengths().to_numpy()
    flat = lists.flatten().to_numpy()
    at = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[np.repeat(np.arange(len(column)), sizes), at] = flat
    return out


class MultiIndex:
    """Two codebooks, the radii of their codewords, and which cells have rows."""

    def __init__(self, first: np.ndarray, second: np.ndarray):
        self.books = first, second
        self.half = first.shape[1]
        self.radii = np.zeros(len(first)), np.zeros(len(second))
        self.cells: frozenset[int] = frozenset()

    def place(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(cell, distance in the first half, distance in the second)`` of each row."""
        (a, da), (b, db) = (_nearest(rows[:, s].astype(np.float64), book) for s, book in zip(self._halves(), self.books))
        return a * len(self.books[1]) + b, da, db

    def _halves(self):
        return slice(0, self.half), slice(self.half, None)

    def bounds(self, q: np.ndarray, sign: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
        """Half-score bounds of each codeword, from above (``sign`` 1) or below (-1), a little wider than exact arithmetic gives."""
        out = []
        for s, book, radius in zip(self._halves(), self.books, self.radii):
            h = q[s].astype(np.float64)
            norm = np.sqrt(h @ h)
            slack = 1e-9 * norm * (np.sqrt((book ** 2).sum(axis=1)) + radius) + 1e-3
            out.append(book @ h + sign * (norm * radius + slack))
        return out[0], out[1]

    def visits(self, q: np.ndarray) -> Iterator[tuple[float, int]]:
        """Cells with rows, by descending summed bound: the multi-sequence heap."""
        one, two = self.bounds(q)
        a, b = np.argsort(-one, kind="stable"), np.argsort(-two, kind="stable")
        heap = [(-(one[a[0]] + two[b[0]]), 0, 0)]
        width = len(two)
        while heap:
            bound, i, j = heapq.heappop(heap)
            cell = int(a[i]) * width + int(b[j])
            if cell in self.cells:
                yield -bound, cell
            if j + 1 < width:
                heapq.heappush(heap, (-(one[a[i]] + two[b[j + 1]]), i, j + 1))
            if j == 0 and i + 1 < len(one):
                heapq.heappush(heap, (-(one[a[i + 1]] + two[b[0]]), i + 1, 0))


def _fit(rows: DataFrame, n: int, d: int) -> MultiIndex:
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(FIT_ROWS).select("vec").toArrow().column("vec")
    m = _padded(sample, d).astype(np.float64)
    k = int(min(MAX_WORDS, max(1, round((n / CELL_ROWS) ** 0.5))))
    half = (d + 1) // 2
    return MultiIndex(k_means(m[:, :half], k), k_means(m[:, half:], k) if d > half else np.zeros((1, 0)))


def _placed(rows: DataFrame, index: MultiIndex, d: int, kind: str) -> DataFrame:
    def run(batches):
        for batch in batches:
            m = _padded(batch.column(3), d)
            cell, da, db = index.place(m) if len(m) else (np.zeros(0, np.int64), np.zeros(0), np.zeros(0))
            raw = np.ascontiguousarray(m.astype(kind))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array([r.tobytes() for r in raw], pa.binary()),
                                              batch.column(4), pa.array(cell, pa.int32()), pa.array(da), pa.array(db)],
                                             ["uid", "id", "label", "vec", "anchor", "cell", "da", "db"])

    return rows.select("uid", "id", "label", "vec", "anchor").mapInArrow(
        run, "uid bigint, id bigint, label bigint, vec binary, anchor boolean, cell int, da double, db double")


def _blocks(placed: DataFrame, sizes: DataFrame) -> DataFrame:
    """``cell, block, uids, ids, labels, vecs``: the rows of each cell packed, ``BLOCK_ROWS`` to a block."""
    dealt = placed.join(sizes.select(F.col("cell").alias("s_cell"), "blocks"), F.col("cell") == F.col("s_cell")) \
        .withColumn("block", F.pmod(F.xxhash64("uid"), F.col("blocks")).cast("int")) \
        .repartition("cell", "block").sortWithinPartitions("cell", "block").select("cell", "block", "uid", "id", "label", "vec")
    schema = pa.schema([("cell", pa.int32()), ("block", pa.int32()), *[(c, pa.binary()) for c in ("uids", "ids", "labels", "vecs")]])

    def run(batches):
        key, held = None, ([], [], [], [])

        def packed():
            numbers = [np.array(x, "<i8").tobytes() for x in held[:3]]
            return pa.RecordBatch.from_pylist([dict(zip(schema.names, (*key, *numbers, b"".join(held[3]))))], schema=schema)

        for batch in batches:
            for cell, block, *rest in zip(*(c.to_pylist() for c in batch.columns)):
                if (cell, block) != key:
                    if key is not None:
                        yield packed()
                    key, held = (cell, block), ([], [], [], [])
                for x, v in zip(held, rest):
                    x.append(v)
        if key is not None:
            yield packed()

    return dealt.mapInArrow(run, "cell int, block int, uids binary, ids binary, labels binary, vecs binary")


def _visited(state: DataFrame, index: MultiIndex, kind: str, cells: int) -> DataFrame:
    """The next ``cells`` cells of each anchor of ``state``, and (cell null) the bound of those that remain.

    Cells that lie above every window, or whose bound is below every window, are not visited.
    """
    schema = pa.schema([("uid", pa.int64()), ("label", pa.int64()), ("vec", pa.binary()), ("scores", pa.list_(pa.int64())),
                        ("cell", pa.int32()), ("seen", pa.int32()), ("rest", pa.float64())])

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                q, out, seen, rest = np.frombuffer(r["vec"], kind), [], 0, None
                scores = r["scores"]
                floor, roof = (min(scores) * LEAST / 100, max(scores) * MOST / 100) if scores else (-np.inf, np.inf)
                low = index.bounds(q, -1.0)
                for bound, cell in index.visits(q):
                    if bound < floor:
                        break
                    if seen >= r["seen"]:
                        if seen >= r["seen"] + cells:
                            rest = bound
                            break
                        if low[0][cell // len(low[1])] + low[1][cell % len(low[1])] <= roof:
                            out.append({"uid": r["uid"], "label": r["label"], "vec": r["vec"], "scores": scores, "cell": cell})
                    seen += 1
                out.append({"uid": r["uid"], "label": r["label"], "vec": r["vec"], "scores": scores, "seen": seen, "rest": rest})
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    return state.select("uid", "label", "vec", "scores", "seen").mapInArrow(
        run, "uid bigint, label bigint, vec binary, scores array<bigint>, cell int, seen int, rest double")


def best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the first ``k`` by descending score, ties by ascending id."""
    if len(score) > k:
        at = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
    else:
        at = np.arange(len(score))
    return at[np.lexsort((ids[at], -score[at]))[:k]]


def _scored(visits: DataFrame, blocks: DataFrame, sizes: DataFrame, kind: str, d: int, exact: bool) -> DataFrame:
    """``uid, slot, score, id``: the best of each visit, positives (slot -1) or negatives of each positive (slot its place)."""
    parts = visits.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(float(VISITS))).cast("int").alias("parts"))
    shape = parts.join(sizes.select("cell", "blocks"), "cell").select(F.col("cell").alias("s_cell"), "parts", "blocks")
    places = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    to = visits.join(shape, F.col("cell") == F.col("s_cell")) \
        .select("cell", places, F.pmod(F.xxhash64("uid"), F.col("parts")).cast("int").alias("part"), "uid", "label", "vec", "scores")
    own = blocks.join(shape.select("s_cell", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")), F.col("cell") == F.col("s_cell")) \
        .select("cell", "block", "part", "uids", "ids", "labels", "vecs")
    rows = to.unionByName(own, allowMissingColumns=True).repartition("cell", "block", "part") \
        .sortWithinPartitions("cell", "block", "part", F.col("uid").asc_nulls_first()) \
        .select("cell", "block", "part", "uid", "label", "vec", "scores", "uids", "ids", "labels", "vecs")
    number = np.float64 if exact else np.int64

    def run(batches):
        key, held = None, None
        for batch in batches:
            uid, out = batch.column(3).to_pylist(), ([], [], [], [])
            label, scores = batch.column(4).to_pylist(), batch.column(6).to_pylist()
            keys = list(zip(*(batch.column(i).to_pylist() for i in (0, 1, 2))))
            row = 0
            while row < batch.num_rows:
                if uid[row] is None:
                    uids, ids, labels = (np.frombuffer(batch.column(i)[row].as_py(), "<i8") for i in (7, 8, 9))
                    held = uids, ids, labels, np.frombuffer(batch.column(10)[row].as_py(), kind).reshape(-1, d).astype(number)
                    key, row = keys[row], row + 1
                    continue
                stop = row
                while stop < batch.num_rows and stop - row < 512 and uid[stop] is not None and keys[stop] == key:
                    stop += 1
                if stop == row:
                    raise RuntimeError("a visit without its block")
                uids, ids, labels, m = held
                q = np.frombuffer(b"".join(batch.column(5).slice(row, stop - row).to_pylist()), kind).reshape(-1, d).astype(number)
                both = (q @ m.T).astype(np.int64)
                for i in range(row, stop):
                    s = both[i - row]
                    if scores[i] is None:
                        at = np.flatnonzero((labels == label[i]) & (uids != uid[i]))
                        found = [(-1, at[best(s[at], ids[at], POSITIVES)])]
                    else:
                        other, found = np.flatnonzero(labels != label[i]), []
                        for slot, p in enumerate(scores[i]):
                            at = other[(100 * s[other] >= LEAST * p) & (100 * s[other] <= MOST * p)]
                            found.append((slot, at[best(s[at], ids[at], NEGATIVES)]))
                    for slot, at in found:
                        for x, v in zip(out, ([uid[i]] * len(at), [slot] * len(at), s[at].tolist(), ids[at].tolist())):
                            x += v
                row = stop
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int64()),
                                              pa.array(out[3], pa.int64())], ["uid", "slot", "score", "id"])

    return rows.mapInArrow(run, "uid bigint, slot int, score bigint, id bigint")


def _search(anchors: DataFrame, blocks: DataFrame, sizes: DataFrame, index: MultiIndex, kind: str, d: int, exact: bool, k: int) -> DataFrame:
    """``uid, slot, rank, score, id``: the first ``k`` of every slot of each anchor (``uid, label, vec, scores``)."""
    state = anchors.withColumn("seen", F.lit(0))
    ranked, cells = None, FIRST_CELLS
    while True:
        visits = written(_visited(state, index, kind, cells), "visits")
        found = _scored(visits.filter(F.col("cell").isNotNull()), blocks, sizes, kind, d, exact)
        if ranked is not None:
            found = found.unionByName(ranked.select("uid", "slot", "score", "id"))
        place = F.row_number().over(Window.partitionBy("uid", "slot").orderBy(F.desc("score"), "id"))
        merged = written(found.withColumn("rank", place).filter(F.col("rank") <= k), "ranked")
        # certified: every slot is full above the bound of what remains, or nothing remains
        full = merged.filter(F.col("rank") == k).groupBy("uid").agg(F.min("score").alias("last"), F.count(F.lit(1)).alias("slots"))
        open_ = visits.filter("cell IS NULL AND rest IS NOT NULL").drop("cell").join(full.withColumnRenamed("uid", "f_uid"), F.col("uid") == F.col("f_uid"), "left")
        slots = F.coalesce(F.size("scores"), F.lit(1))
        left = written(open_.filter(~F.coalesce((F.col("slots") >= slots) & (F.col("last") > F.col("rest")), F.lit(False)))
                       .select("uid", "label", "vec", "scores", "seen"), "anchors")
        discard(visits, ranked, state if cells > FIRST_CELLS else None)
        ranked, state, cells = merged, left, 4 * cells
        if state.isEmpty():
            discard(state)
            return ranked


def mine(rows: DataFrame, id_col: str, label: Column, vector: Column, is_anchor: Column) -> DataFrame:
    """Hard negatives of every anchor and positive: ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``vector`` is an array of integers, ``label`` an integer, ``is_anchor`` says which rows ask.  An anchor's positives
    are its first five other rows of the same label, by integer inner product; the negatives of a positive the first ten
    rows of other labels whose score is 30 to 90 hundredths of the positive's.  Ties go by the smaller id.

    Rows with a null id, label or vector take no part.  A shorter vector counts as if it ended in zeros, so an empty one
    scores 0 everywhere.  Repeated rows are rows of their own: each can be an anchor, a positive and a negative.  Fewer
    positives or negatives than asked give fewer rows, an empty table gives none.  A vector may be long; a block of 2,048
    is held at once.  Vectors whose scores may pass 2^56 raise an error.  Other columns are not read.
    """
    taken = rows.select(F.col(f"`{id_col}`").cast("long").alias("id"), label.cast("long").alias("label"), vector.alias("vec"),
                        F.coalesce(is_anchor, F.lit(False)).alias("anchor")).filter("id IS NOT NULL AND label IS NOT NULL AND vec IS NOT NULL")
    # the ids follow the files' order and hold for all that is derived from the written table
    taken = written(taken.withColumn("uid", F.monotonically_increasing_id()), "vectors")
    greatest = F.aggregate("vec", F.lit(0).cast("long"), lambda a, x: F.greatest(a, F.abs(x)))
    n, d, most = taken.agg(F.count(F.lit(1)), F.max(F.size("vec")), F.max(greatest)).first()
    d, most = max(d or 0, 1), most or 0
    if most * most * d >= LIMIT:
        raise ValueError(f"components of up to {most} in {d} dimensions give scores beyond 2^56")
    kind = "<i2" if most < 1 << 15 else "<i4"
    exact = most * most * d < 1 << 53  # so small that sums of doubles are exact
    index = _fit(taken, n, d) if n else MultiIndex(np.zeros((1, (d + 1) // 2)), np.zeros((1, d // 2)))
    placed = written(_placed(taken, index, d, kind), "placed")
    discard(taken)
    per_cell = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("rows"), F.max("da").alias("da"), F.max("db").alias("db"))
    width = len(index.books[1])
    for r in per_cell.collect():  # at most MAX_WORDS squared
        for radius, word, dist in ((index.radii[0], r["cell"] // width, r["da"]), (index.radii[1], r["cell"] % width, r["db"])):
            radius[word] = max(radius[word], dist)
        index.cells |= {r["cell"]}
    sizes = written(per_cell.select("cell", F.ceil(F.col("rows") / F.lit(float(BLOCK_ROWS))).cast("int").alias("blocks")), "cells")
    blocks = written(_blocks(placed, sizes), "blocks")
    anchors = written(placed.filter("anchor").select("uid", "id", "label", "vec"), "asking")
    discard(placed)
    asked = anchors.select("uid", "label", "vec", F.lit(None).cast("array<bigint>").alias("scores"))
    positives = _search(asked, blocks, sizes, index, kind, d, exact, POSITIVES)
    windows = positives.groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("p")) \
        .select(F.col("uid").alias("w_uid"), F.col("p.score").alias("scores"))
    asked = written(anchors.join(windows, F.col("uid") == F.col("w_uid")).select("uid", "label", "vec", "scores"), "asking")
    negatives = _search(asked, blocks, sizes, index, kind, d, exact, NEGATIVES)
    chosen = positives.select(F.col("uid").alias("p_uid"), (F.col("rank") - 1).alias("p_slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    names = anchors.select(F.col("uid").alias("a_uid"), F.col("id").alias("anchor_id"))
    out = negatives.join(chosen, (F.col("uid") == F.col("p_uid")) & (F.col("slot") == F.col("p_slot"))).join(names, F.col("uid") == F.col("a_uid"))
    out = written(out.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")), "negatives")
    discard(blocks, sizes, anchors, asked, positives, negatives)
    return out
