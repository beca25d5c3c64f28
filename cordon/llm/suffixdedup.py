"""Removing repeated byte strings of all documents with sorted suffixes (operator 1).

A byte goes if a string of ``LENGTH`` bytes that covers it starts earlier somewhere else.  Sorting every
suffix of the corpus is not needed for that:

1. Anchors.  In each window of ``LENGTH`` bytes the ``GRAM``-byte substring with the least hash is the
   window's anchor.  Equal windows have equal anchors at equal places, so only windows around equal
   anchors need comparing.  An anchor's windows are neighbours; what they cover is its span.
2. Equal spans (by hash, told apart by the anchor's) are one class.  Its earliest member stands for it;
   all windows of the others start earlier, there.  An anchor with only one class is done.
3. The suffixes that begin at the remaining anchors are sorted: every task sorts its own, front-codes
   them, and sends runs to the tasks that merge them with a loser tree which takes the common prefixes
   from the runs and never compares them again (``losertree``).  The merge puts out the suffix order and
   its common-prefix lengths; the text to the left of the anchors is ordered likewise.  A window that
   reaches ``o`` bytes to the left of its anchor equals another's if their common prefix is at least
   ``LENGTH - o`` in the one order and ``o`` in the other, so runs of the two orders name equal windows
   and the earliest of each is kept.
4. Anchors with very many classes are not brought together: their windows are told apart by 128-bit
   hashes, and the earliest of each comes from an aggregation that is summed up before the shuffle.

The ranges found go back to the documents, which are cut and hashed.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cordon.llm.losertree import common_prefix, decode_run, front_code, merge
from cordon.llm.scratch import discard, written
from cordon.llm.wordhash import pieces, prefix_hash, span_hash

LENGTH = 100
GRAM = 32
#: classes of one anchor from which on windows are hashed instead of sorted together
MANY = 2000
#: suffixes merged by one task
PART = 40_000
_FLUSH = 2_000_000


def _sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while have < width:
        step = min(have, width - have)
        a = np.minimum(a[:-step], a[step:])
        have += step
    return a


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """``(document, anchor hash, class hash, first window, last window, anchor)``, places within the document.

    Each row is one anchor and the consecutive windows that it is the anchor of.
    """
    n = len(data)
    if n < length:
        return None
    p = prefix_hash(data)
    at = np.arange(n - gram + 1)
    h = span_hash(p, at, at + gram)
    low = np.uint64(0xFFFFFFFF)
    # least hash first; of equal ones the last, which is the same choice wherever the window stands
    best = _sliding_min((h & ~low) | (low - at.astype(np.uint64)), length - gram + 1)
    anchor = (low - (best & low)).astype(np.int64)
    first_window = np.arange(len(best))
    doc = np.searchsorted(offsets, first_window, "right") - 1
    whole = first_window + length <= offsets[doc + 1]
    window, anchor, doc = first_window[whole], anchor[whole], doc[whole]
    if len(window) == 0:
        return None
    begins = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])]))
    ends = np.concatenate([begins[1:], [len(window)]]) - 1
    lo, hi, a, doc = window[begins], window[ends], anchor[begins], doc[begins]
    span = span_hash(p, lo, hi + length) + (a - lo).astype(np.uint64)
    start = offsets[doc]
    return doc, h[a], span, lo - start, hi - start, a - start


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc, sub, text``: a document's place in the order.  ``sub`` tells texts of one id apart (by hash);
    null ids come first.  Where ids are unique it is 0 and costs nothing."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")) \
        .withColumn("doc", F.coalesce("id", F.lit(-(1 << 63))))
    shared = rows.groupBy("doc").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc")
    if shared.isEmpty():
        return rows.select("id", "doc", F.lit(0).cast("bigint").alias("sub"), "text")
    tie = F.coalesce(F.xxhash64("text"), F.lit(0))
    marked = rows.join(shared.withColumn("twin", F.lit(True)), "doc", "left")
    return marked.select("id", "doc", F.when(F.col("twin"), tie).otherwise(F.lit(0)).cast("bigint").alias("sub"), "text")


_FIELDS = "kind tinyint, gram bigint, span bigint, doc bigint, sub bigint, lo int, box int"
_NAMES = ["kind", "gram", "span", "doc", "sub", "lo", "box"]
COVERED, ANCHOR = 0, 1


def _batch(kind: int, gram, span, doc, sub, lo, box) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(doc), kind, np.int8)), pa.array(gram.view(np.int64)), pa.array(span.view(np.int64)), pa.array(doc), pa.array(sub),
         pa.array(lo.astype(np.int32)), pa.array(box.astype(np.int32))], _NAMES)


def _covered(doc, sub, start, stop) -> pa.RecordBatch:
    """Ranges to remove; ranges of one document that touch become one."""
    order = np.lexsort((start, sub, doc))
    doc, sub, start, stop = doc[order], sub[order], start[order], stop[order]
    # spans have bounded lengths and come sorted, so a running maximum within the document merges them
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (sub[1:] != sub[:-1])
    if len(doc):
        group = np.cumsum(new) - 1
        wide = int(stop.max()) + 1
        reach = np.maximum.accumulate(stop + group * wide) - group * wide
        new[1:] |= start[1:] > reach[:-1]
        at = np.flatnonzero(new)
        last = np.concatenate([at[1:], [len(doc)]]) - 1
        doc, sub, start, stop = doc[at], sub[at], start[at], reach[last]
    gram = np.bitwise_xor(doc.view(np.uint64), np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)  # only deals rows out
    return _batch(COVERED, gram, np.zeros(len(doc), np.uint64), doc, sub, start, stop - start)


def _scan(keyed: DataFrame, length: int, gram: int) -> DataFrame:
    """Anchors with ``box = (last window - lo) << 12 | (anchor - lo)``; of equal classes in a task only the
    earliest goes on, the others' spans are covered already."""
    def settle(held):
        g, s, doc, sub, lo, hi, a = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((lo, sub, doc, s, g))
        g, s, doc, sub, lo, hi, a = (x[order] for x in (g, s, doc, sub, lo, hi, a))
        again = np.zeros(len(g), bool)
        again[1:] = (g[1:] == g[:-1]) & (s[1:] == s[:-1])
        yield _covered(doc[again], sub[again], lo[again], hi[again] + length)
        one = ~again
        yield _batch(ANCHOR, g[one], s[one], doc[one], sub[one], lo[one], ((hi - lo)[one] << 12) | (a - lo)[one])

    def run(batches):
        held, count = [], 0
        for batch in batches:
            docs, subs = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
            for first, _, data, offsets in pieces(batch.column(2)):
                found = anchors(data, offsets, length, gram)
                if found is not None:
                    doc, g, s, lo, hi, a = found
                    held.append((g, s, docs[first + doc], subs[first + doc], lo, hi, a))
                    count += len(doc)
                if count >= _FLUSH:
                    yield from settle(held)
                    held, count = [], 0
        if held:
            yield from settle(held)

    return keyed.select("doc", "sub", "text").mapInArrow(run, _FIELDS)


def _classes(scanned: DataFrame, length: int) -> DataFrame:
    """From anchors sorted by class: spans of all but the earliest of a class as covered ranges, and the
    earliest of each class where an anchor has several.  One pass, one row carried over."""
    def run(batches):
        before = None  # gram and span of the last row
        held = None  # the last class's first row, and whether its gram had another class before
        for batch in batches:
            if not batch.num_rows:
                continue
            kind, g, s, doc, sub, lo, box = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(7))
            if (kind == COVERED).any():
                yield batch.filter(pa.array(kind == COVERED))
            take = kind == ANCHOR
            g, s, doc, sub, lo, box = (x[take] for x in (g, s, doc, sub, lo, box))
            if len(g) == 0:
                continue
            again = np.zeros(len(g), bool)
            again[1:] = (g[1:] == g[:-1]) & (s[1:] == s[:-1])
            again[0] = before == (g[0], s[0])
            before = (g[-1], s[-1])
            if again.any():
                x = lo[again].astype(np.int64)
                yield _covered(doc[again], sub[again], x, x + (box[again] >> 12) + length)
            rows = [x[~again] for x in (g, s, doc, sub, lo, box)]
            if held is not None:
                rows = [np.concatenate([h, x]) for h, x in zip(held[0], rows)]
            if len(rows[0]) == 0:
                continue
            same = rows[0][1:] == rows[0][:-1]
            several = np.concatenate([[held is not None and held[1]], same]) | np.concatenate([same, [False]])
            held = [x[-1:] for x in rows], bool(several[-1])
            keep = several[:-1]
            if keep.any():
                yield _batch(ANCHOR, *(x[:-1][keep] for x in rows))
        if held is not None and held[1]:
            yield _batch(ANCHOR, *held[0])

    ordered = scanned.repartition("gram").sortWithinPartitions("gram", "span", "doc", "sub", "lo")
    return ordered.mapInArrow(run, _FIELDS)


def _with_text(keyed: DataFrame, reps: DataFrame) -> DataFrame:
    """``text`` and the anchors in it, one row per document that has any."""
    per = reps.groupBy("doc", "sub").agg(F.collect_list(F.struct("gram", "lo", "box", "many", "part")).alias("found"))
    return keyed.join(per, ["doc", "sub"]).select("doc", "sub", "text", "found")


def _rows_of(batch: pa.RecordBatch):
    """``(doc, sub, bytes, [(gram, lo, box, part)])`` of each document of a batch."""
    doc, sub = batch.column(0).to_pylist(), batch.column(1).to_pylist()
    for i, text in enumerate(batch.column(2).to_pylist()):
        yield doc[i], sub[i], (text or "").encode(), batch.column(3)[i].as_py()


def _runs(texts: DataFrame, length: int) -> DataFrame:
    """Front-coded runs, one per task and part, sorted by the suffix at the anchor: ``part`` and, for each
    suffix, its place, the bytes from the anchor on, and those before it, backwards."""
    def code(part: int, rows: list) -> dict:
        rows.sort(key=lambda r: r[0])
        shared, sizes, rests = front_code([r[0] for r in rows])
        left = [r[1] for r in rows]
        return {"part": part, "shared": shared.tobytes(), "sizes": sizes.tobytes(), "rests": rests,
                "left_sizes": np.array([len(x) for x in left], np.uint16).tobytes(), "left": b"".join(left),
                "places": np.array([r[2:] for r in rows], np.int64).tobytes()}

    schema = pa.schema([("part", pa.int32()), *[(n, pa.binary()) for n in ("shared", "sizes", "rests", "left_sizes", "left", "places")]])

    def run(batches):
        held, count = {}, 0
        for batch in batches:
            for doc, sub, raw, found in _rows_of(batch):
                for r in found:
                    lo, a, hi = r["lo"], r["lo"] + (r["box"] & 0xFFF), r["lo"] + (r["box"] >> 12)
                    held.setdefault(r["part"], []).append((raw[a:hi + length], raw[lo:a][::-1], doc, sub, a, a - hi, a - lo))
                    count += 1
            if count >= _FLUSH // 10:
                yield pa.RecordBatch.from_pylist([code(p, rows) for p, rows in held.items()], schema=schema)
                held, count = {}, 0
        if held:
            yield pa.RecordBatch.from_pylist([code(p, rows) for p, rows in held.items()], schema=schema)

    return texts.mapInArrow(run, "part int, shared binary, sizes binary, rests binary, left_sizes binary, left binary, places binary")


def equal_windows(suffix_prefix: np.ndarray, left: list[bytes], places: np.ndarray, length: int = LENGTH):
    """Ranges ``(doc, sub, start, stop)`` covered by windows that start earlier elsewhere.

    ``suffix_prefix``: common prefix of each suffix with the one before, in suffix order; ``left``: the
    bytes before the anchor, backwards; ``places``: rows of ``doc, sub, anchor, least and most reach to
    the left``.
    """
    n = len(left)
    by_left = sorted(range(n), key=left.__getitem__)
    left_prefix = np.zeros(n, np.int64)
    for i in range(1, n):
        left_prefix[i] = common_prefix(left[by_left[i - 1]], left[by_left[i]])
    by_left = np.array(by_left, np.int64)
    doc, sub, anchor, least, most = places.T
    age = np.lexsort((anchor, sub, doc))  # at equal reach, the order of the windows' starts
    hit = np.zeros((n, int(most.max()) + 2), bool)
    for o in range(int(least.min()), int(most.max()) + 1):
        has = (least <= o) & (o <= most)
        right_name = np.cumsum(suffix_prefix < length - o)
        left_name = np.empty(n, np.int64)
        left_name[by_left] = np.cumsum(left_prefix < o)
        mine = age[has[age]]
        name = right_name[mine] * (n + 1) + left_name[mine]
        _, first, which = np.unique(name, return_index=True, return_inverse=True)
        hit[mine, o] = first[which] != np.arange(len(mine))
    # reaches o1..o2 of one anchor: starts anchor - o2 to anchor - o1
    edge = np.diff(np.concatenate([np.zeros((n, 1), bool), hit], axis=1).astype(np.int8), axis=1)
    row, o1 = np.nonzero(edge == 1)
    _, after = np.nonzero(edge == -1)
    return doc[row], sub[row], anchor[row] - after + 1, anchor[row] - o1 + length


def _merged(runs: DataFrame, length: int) -> DataFrame:
    """Merge the runs of each part, and name its equal windows."""
    def finish(held):
        order, prefix = [], []
        offset = np.concatenate([[0], np.cumsum([len(r["places"]) for r in held])])
        taken = [0] * len(held)
        for run_no, shared, _ in merge([decode_run(r["shared"], r["sizes"], r["rests"]) for r in held]):
            order.append(offset[run_no] + taken[run_no])
            taken[run_no] += 1
            prefix.append(shared)
        lefts = [x for r in held for x in r["left"]]
        places = np.concatenate([r["places"] for r in held])[order]
        return _covered(*equal_windows(np.array(prefix, np.int64), [lefts[i] for i in order], places, length))

    def run(batches):
        held, part = [], None
        for batch in batches:
            for r in batch.to_pylist():
                if r["part"] != part and held:
                    yield finish(held)
                    held = []
                part = r["part"]
                ends = np.cumsum(np.frombuffer(r["left_sizes"], np.uint16).astype(np.int64)).tolist()
                held.append({"shared": np.frombuffer(r["shared"], np.uint16), "sizes": np.frombuffer(r["sizes"], np.uint16), "rests": r["rests"],
                             "left": [r["left"][a:b] for a, b in zip([0, *ends[:-1]], ends)],
                             "places": np.frombuffer(r["places"], np.int64).reshape(-1, 5)})
        if held:
            yield finish(held)

    return runs.repartition("part").sortWithinPartitions("part").mapInArrow(run, _FIELDS)


def _hashed(texts: DataFrame, length: int) -> DataFrame:
    """Windows of anchors with very many classes: ``h1, h2`` (the window's hashes), ``doc, sub, start``."""
    def run(batches):
        for batch in batches:
            out = [[] for _ in range(5)]
            for doc, sub, raw, found in _rows_of(batch):
                data = np.frombuffer(raw, np.uint8)
                start = np.unique(np.concatenate([np.arange(r["lo"], r["lo"] + (r["box"] >> 12) + 1) for r in found]))
                base = int(start[0])
                part = data[base:int(start[-1]) + length]
                for j in (0, 1):
                    out[j].append(span_hash(prefix_hash(part, j), start - base, start - base + length, j).view(np.int64))
                out[2].append(np.full(len(start), doc, np.int64))
                out[3].append(np.full(len(start), sub, np.int64))
                out[4].append(start.astype(np.int32))
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], ["h1", "h2", "doc", "sub", "start"])

    return texts.mapInArrow(run, "h1 bigint, h2 bigint, doc bigint, sub bigint, start int")


def covered_ranges(keyed: DataFrame, length: int = LENGTH, gram: int = GRAM, many: int = MANY, part: int = PART) -> DataFrame:
    """``(doc, sub, start, stop)``: ranges to remove; they may overlap."""
    found = written(_classes(_scan(keyed, length, gram), length), "classes")
    as_range = ["doc", "sub", F.col("lo").alias("start"), (F.col("lo") + F.col("box")).alias("stop")]
    out = found.filter(F.col("kind") == COVERED).select(*as_range)
    reps = found.filter(F.col("kind") == ANCHOR)
    per = reps.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    big = per.filter(F.col("n") > many).select("gram", F.lit(True).alias("many"))
    parts = max(1, -(-reps.count() // part))
    reps = reps.join(big, "gram", "left").withColumn("many", F.coalesce("many", F.lit(False))) \
        .withColumn("part", F.pmod(F.xxhash64("gram"), F.lit(parts)).cast("int"))
    runs = written(_runs(_with_text(keyed, reps.filter("not many")), length), "runs")
    out = out.unionByName(written(_merged(runs, length), "merged").select(*as_range))
    discard(runs)
    windows = written(_hashed(_with_text(keyed, reps.filter("many")), length), "windows")
    earliest = windows.groupBy("h1", "h2").agg(F.min(F.struct("doc", "sub", "start")).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    later = windows.join(earliest, ["h1", "h2"]).filter(F.struct("doc", "sub", "start") != F.col("first"))
    return out.unionByName(later.select("doc", "sub", "start", (F.col("start") + length).alias("stop")))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM,
                   many: int = MANY, part: int = PART, with_kept: bool = False) -> DataFrame:
    """One row per input row: ``id, n_bytes, n_removed, n_spans, kept_sha256`` and, if asked, ``kept`` (the
    remaining bytes) and ``spans`` (the removed ranges).

    Null text: no bytes.  Null ids come before all others.  Rows with the same id and text are one
    document, and each gets its result; rows with the same id and other texts are ordered by a hash of
    the text.  Texts shorter than ``length`` keep everything.  An empty table gives no rows.
    """
    keyed = _keyed(docs, id_col, text_col)
    ranges = covered_ranges(keyed, length, gram, many, part).groupBy("doc", "sub").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("ranges"))
    rows = keyed.join(ranges, ["doc", "sub"], "left").select("id", "text", F.col("ranges.start").alias("start"), F.col("ranges.stop").alias("stop"))
    schema = "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + \
        ", kept binary, spans array<struct<start:int,stop:int>>" * with_kept
    names = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(),
             pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))]

    def cut(batches):
        for batch in batches:
            out = [[] for _ in names]
            ids, texts, starts, stops = (batch.column(i).to_pylist() for i in range(4))
            for i, text in enumerate(texts):
                raw = (text or "").encode()
                spans = []
                for a, b in zip(starts[i] or (), stops[i] or ()):
                    if spans and a <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], b)
                    else:
                        spans.append([a, b])
                edges = [0, *[x for s in spans for x in s], len(raw)]
                kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))
                row = (ids[i], len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept,
                       [{"start": a, "stop": b} for a, b in spans])
                for x, v in zip(out, row):
                    x.append(v)
            n = len(names) if with_kept else 5
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out[:n], kinds)], names[:n])

    return rows.mapInArrow(cut, schema)
