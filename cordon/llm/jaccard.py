"""N-gram Jaccard join: an exact metric-space join with pivots (operator 4).

A document is its set of word shingles; two documents link when the Jaccard distance of their sets is at
most ``1 - t``.  Equal sets are one point (a class).  Jaccard distance is a metric, and the join is built
on that:

1. Regions.  For a text no document pivot lies near (most texts share no shingle), distances to document
   pivots are all 1 and tell nothing apart.  The first pivots are therefore single shingles: a point is
   nearer to the pivots it holds than to any other, and of those its cell is the first in one global
   order (rare ones first).  Two points within the radius share at least ``ceil(t n)`` of the ``n``
   shingles of either, so they meet in one of the first ``n - ceil(t n) + 1`` pivots of both: this is the
   window over which boundary points are copied.  In the first region where two points meet, all they
   share lies at or behind the region's pivot in the order of either, which bounds their intersection: a
   pair whose bound is too small for the radius in a region is not looked at there.
2. Pivots inside a region.  The region's smallest point is its pivot; distances of all others to it are
   computed.  Points within the radius of a pivot are linked, and never need comparing with each other:
   they are in one component already.
3. Recursion.  Points of a region that are still in different components form smaller regions, each with
   new pivots, until every region is one component or all its pairs were compared.  A pair is left out
   only if the triangle inequality puts it beyond the radius: |d(x, p) - d(y, p)| > 1 - t.

Every pair within the radius ends in one component; no pair beyond it makes a link.  Distances are exact
counts over 64-bit shingle hashes; sets with equal 64-bit hashes (a sum over all shingles) are one point.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cordon.llm.components import components
from cordon.llm.idcache import forget
from cordon.llm.scratch import discard, written
from cordon.llm.wordhash import mix, shingle_sets

WORDS = 5
THRESHOLD = Fraction(8, 10)
#: the most frequent shingles, so many at most, come last in the pivots' order, by their counts
HEAVY = 1 << 20
#: one of so many (shingle, set) pairs is counted for that order, which decides speed and not results
COUNTED = 4
#: sampled counts from which a shingle can be one of the frequent
LEAST_COUNT = 3
#: regions of up to so many points are compared in one go in the first round of the recursion; twice as many in the next
SMALL = 24
#: a point's profile: how many of its shingles fall into each of so many parts of their universe
PARTS = 256
#: members of a pivot in one group of the distance step
GROUP = 512


def window(n: int | np.ndarray, t: Fraction = THRESHOLD):
    """How many pivots a point of ``n`` shingles is copied to."""
    return n - (n * t.numerator + t.denominator - 1) // t.denominator + 1


def _as_long(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _points(rows: DataFrame, k: int) -> DataFrame:
    """``kind, id, tie, n, point, profile``: of each row (kind 0) its set's size, hash and profile; and
    (kind 1) sampled shingles as ``id`` with their counts as ``n``, added up per batch."""
    names = ["kind", "id", "tie", "n", "point", "profile"]

    def run(batches):
        forget()
        for batch in batches:
            n, point, seen, profile = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.uint64), [], [b""] * batch.num_rows
            for i, s in shingle_sets(batch.column(1), k):
                spread = mix(s)
                n[i], point[i] = len(s), spread.sum(dtype=np.uint64)
                seen.append(s[mix(spread ^ point[i]) % np.uint64(COUNTED) == 0])
                profile[i] = np.minimum(np.bincount((s >> np.uint64(56)).astype(np.int64), minlength=PARTS), 0xFFFF).astype("<u2").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(n), np.int8)), batch.column(0), batch.column(2), pa.array(n),
                                              _as_long(point), pa.array(profile, pa.binary())], names)
            found, counts = np.unique(np.concatenate(seen), return_counts=True) if seen else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            for lo in range(0, len(found), 1 << 16):
                some = found[lo:lo + (1 << 16)]
                none = pa.nulls(len(some), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(some), np.int8)), _as_long(some), none, pa.array(counts[lo:lo + (1 << 16)].astype(np.int64)),
                                                  none, pa.nulls(len(some), pa.binary())], names)

    return rows.mapInArrow(run, "kind tinyint, id bigint, tie bigint, n bigint, point bigint, profile binary")


def _order(points: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """``(shingles, ranks)`` of the most frequent shingles, sorted: one rank for each doubling of the count, the others
    have rank 0.  ``HEAVY`` of them at most, whatever the input; a histogram of the counts tells where to cut."""
    counts = written(points.filter("kind = 1").groupBy("id").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT), "frequent")
    least, room = None, HEAVY
    for r in sorted(counts.groupBy(F.floor(F.log2("n") * 8).cast("int").alias("step")).count().collect(), reverse=True):  # a few hundred steps
        if r["count"] > room:
            break
        least, room = r["step"], room - r["count"]
    kept = counts.filter(F.floor(F.log2("n") * 8).cast("int") >= (least if least is not None else 1 << 30)).select("id", "n").toArrow()
    discard(counts)
    heavy, n = kept.column("id").to_numpy().astype(np.int64).view(np.uint64), kept.column("n").to_numpy()
    by = np.argsort(heavy)
    return heavy[by], np.ceil(np.log2(np.maximum(n[by], 1))).clip(1, 60).astype(np.uint8)


def _ranks(s: np.ndarray, order: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    heavy, ranks = order
    if len(heavy) == 0:
        return np.zeros(len(s), np.uint64)
    at = np.minimum(np.searchsorted(heavy, s), len(heavy) - 1)  # sets are sorted, so this walks through once
    return np.where(heavy[at] == s, ranks[at], 0).astype(np.uint64)


def _cells(rows: DataFrame, order: tuple[np.ndarray, np.ndarray], k: int, t: Fraction) -> DataFrame:
    """``(pivot, point, n, rare, pos)``: each row's point with the pivots of its window and their places in its order;
    ``rare`` counts its shingles that are not frequent ones: a text that others were copied from has few, an edited
    copy has more."""
    def run(batches):
        forget()
        for batch in batches:
            pivots, points, sizes, rare, places = [], [], [], [], []
            for _, s in shingle_sets(batch.column(1), k):
                if len(s):
                    # by rank, then by a hash
                    ranks = _ranks(s, order)
                    key = (ranks << np.uint64(58)) | (mix(s ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(6))
                    w = window(len(s), t)
                    at = np.argpartition(key, w - 1)[:w] if w < len(s) else np.arange(len(s))
                    first = s[at[np.argsort(key[at], kind="stable")]]
                    pivots.append(first)
                    places.append(np.arange(len(first), dtype=np.int32))
                    points.append(np.full(len(first), mix(s).sum(dtype=np.uint64), np.uint64))
                    sizes.append(np.full(len(first), len(s), np.int32))
                    rare.append(np.full(len(first), np.count_nonzero(ranks == 0), np.int32))
            if pivots:
                yield pa.RecordBatch.from_arrays([_as_long(np.concatenate(pivots)), _as_long(np.concatenate(points)),
                                                  pa.array(np.concatenate(sizes)), pa.array(np.concatenate(rare)), pa.array(np.concatenate(places))],
                                                 ["pivot", "point", "n", "rare", "pos"])

    return rows.mapInArrow(run, "pivot bigint, point bigint, n int, rare int, pos int")


def _near_size(a: Column, b: Column, t: Fraction) -> Column:
    """Sets so different in size cannot be within the radius."""
    return (F.least(a, b) * t.denominator >= F.greatest(a, b) * t.numerator)


def _placed(na: Column, pa_: Column, nb: Column, pb: Column, t: Fraction) -> Column:
    """Whether two points may be within the radius if the region's pivot, at places ``pa_`` and ``pb`` of their orders, is
    the first they share.  If it is not, they meet in the region of that one too, where this holds for linked points."""
    return F.least(na - pa_, nb - pb) * (t.denominator + t.numerator) >= (na + nb) * t.numerator


def _bounded(pairs: DataFrame, profiles: DataFrame, t: Fraction) -> DataFrame:
    """Pairs ``(a, b, na, nb)`` with ``low``, a lower bound of their distance, and whether they may be ``near``.

    Each part of the universe is a pivot: what two sets hold of it differs by at most what they differ in, so the sum
    of these differences is never more than the size of the symmetric difference.  A difference of ``x`` gives a
    distance of at least ``2 x / (na + nb + x)``, and for a link it is at most ``(na + nb) (1 - t) / (1 + t)``.
    """
    joined = pairs.join(profiles.select(F.col("point").alias("a"), F.col("profile").alias("pa")), "a") \
        .join(profiles.select(F.col("point").alias("b"), F.col("profile").alias("pb")), "b").select("a", "b", "na", "nb", "pa", "pb")
    lo, hi = t.denominator - t.numerator, t.denominator + t.numerator

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), "<u2").reshape(-1, PARTS).astype(np.int32) for i in (4, 5))
                n = batch.column(2).to_numpy() + batch.column(3).to_numpy()
                apart = np.abs(x - y).sum(axis=1, dtype=np.int64)
                yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(2 * apart / (n + apart)), pa.array(apart * hi <= n * lo)],
                                                 ["a", "b", "na", "nb", "low", "near"])

    return joined.select("a", "b", F.col("na").cast("long"), F.col("nb").cast("long"), "pa", "pb") \
        .mapInArrow(run, "a bigint, b bigint, na bigint, nb bigint, low double, near boolean")


def _distances(pairs: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """``(a, b, na, nb, inter)`` of each pair ``(a, b, na, nb)``; ``texts`` is ``(point, text)``, one row per point.

    Pairs are grouped by ``a`` and a part of its partners, so a pivot with very many partners is many
    groups.  A task reads its groups sorted, the pivot's text first, and holds one set at a time.
    """
    parts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / F.lit(float(GROUP))).cast("int").alias("parts"))
    dealt = pairs.join(parts, "a").withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int"))
    own = parts.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(None).cast("bigint").alias("b"),
                       F.lit(0).alias("na"), F.lit(0).alias("nb"), F.col("a").alias("needs"))
    wanted = dealt.select("a", "part", "b", "na", "nb", F.col("b").alias("needs")).unionByName(own)
    rows = wanted.join(texts, F.col("needs") == F.col("point")).select("a", "part", "b", "text", "na", "nb") \
        .repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())

    def run(batches):
        held, mine = None, None
        for batch in batches:
            a, part, b, na, nb = (batch.column(i).to_pylist() for i in (0, 1, 2, 4, 5))
            out = ([], [], [], [], [])
            for i, s in shingle_sets(batch.column(3), k):
                if b[i] is None:
                    held, mine = s, (a[i], part[i])
                elif mine == (a[i], part[i]):
                    row = a[i], b[i], na[i], nb[i], len(np.intersect1d(held, s, assume_unique=True))
                    for x, v in zip(out, row):
                        x.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], ["a", "b", "na", "nb", "inter"])

    return rows.mapInArrow(run, "a bigint, b bigint, na bigint, nb bigint, inter bigint")


def _within(inter: Column, na: Column, nb: Column, t: Fraction) -> Column:
    return inter * t.denominator >= (na + nb - inter) * t.numerator


def similar_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = WORDS,
                       t: Fraction = THRESHOLD) -> DataFrame:
    """One row per input row: ``id, tie`` (a hash of the text)``, n_shingles, point`` (the set)``, group,
    component_id, n_links``.

    ``component_id`` is the smallest id reachable by links; ``n_links`` counts the links of the row's set
    that the join computed (pairs within a component are not all compared).  Null or empty text: no
    shingles, linked with nothing, its own id.  Null ids take part, and a component of null ids alone has
    none.  Repeated rows have equal sets and so one component.  An empty table gives no rows.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")) \
        .withColumn("tie", F.coalesce(F.xxhash64("text"), F.lit(0)))
    counted = written(_points(rows, k), "counted")
    order = _order(counted)
    points = written(counted.filter("kind = 0").drop("kind"), "points")
    discard(counted)
    own = points.select("id", "tie", "n", "point")
    classes = own.filter("n > 0").groupBy("point").agg(F.min("id").alias("least"))
    # cells are computed twice and not kept: almost all are of one point, and all together are large.
    # First the regions with two points or more; equal rows fall together before the shuffle
    cells = _cells(rows, order, k, t)
    regions = written(cells.groupBy("pivot").agg(F.min("point").alias("first"), F.max("point").alias("last"))
                      .filter("first < last").select(F.col("pivot").alias("region")), "regions")
    inside = written(cells.join(regions, F.col("pivot") == F.col("region")).select("region", "point", "n", "rare", "pos").distinct(), "inside")
    # the region's pivot is the point with the fewest rare shingles, the likeliest origin of copies
    first = inside.groupBy("region").agg(F.min(F.struct("rare", "point")).alias("least"), F.min("n").alias("n_least")) \
        .select("region", F.col("least.point").alias("p"), "n_least")
    # a point too far behind the pivot for the region's smallest set is so for all
    members = written(inside.join(first, "region").filter(((F.col("n") - F.col("pos")) * (t.denominator + t.numerator) >= (F.col("n") + F.col("n_least")) * t.numerator) | (F.col("p") == F.col("point")))
                      .select("region", "p", "point", "n", "rare", "pos"), "members")
    discard(regions, inside)
    involved = members.select("point").distinct()
    profiles = written(points.join(involved, "point", "left_semi").groupBy("point").agg(F.first("profile").alias("profile")), "profiles")
    texts = _texts_of(involved, own, rows)

    pivot_sizes = members.filter("p = point").select(F.col("region").alias("r"), F.col("n").alias("np"), F.col("pos").alias("p_pos"))
    near = members.filter("p <> point").join(pivot_sizes, F.col("region") == F.col("r")) \
        .filter(_placed(F.col("n"), F.col("pos"), F.col("np"), F.col("p_pos"), t))
    pairs = _ordered(near, "p", "np", "point", "n")
    # measured pairs (a < b) stay in the tables of their rounds
    known, far = _measured(pairs, texts, profiles, [], k, t)
    labels = _linked(None, known, t)
    # what the first pivots' distances, or bounds of them, say about their regions' points; the pivots are done
    d = _all(known).select("a", "b", _distance().alias("low"), _distance().alias("high")) \
        .unionByName(far.select("a", "b", "low", F.lit(1.0).alias("high")))
    d = d.select(F.col("a").alias("d_a"), F.col("b").alias("d_b"), "low", "high")
    rest = members.filter("p <> point").join(d, (F.least("p", "point") == F.col("d_a")) & (F.greatest("p", "point") == F.col("d_b")), "left")
    rest = written(rest.select("region", "p", "point", "n", "rare", "pos", F.coalesce("low", F.lit(0.0)).alias("low"), F.coalesce("high", F.lit(1.0)).alias("high")), "rest")
    discard(members, far)
    small = SMALL
    while True:
        rest, pairs = _next_round(rest, labels, t, small)
        if pairs is None:  # no pivots: every region is one component, or all its pairs were ruled out or measured
            break
        small *= 2  # so the number of rounds is logarithmic in the size of the largest region
        new, far = _measured(pairs, texts, profiles, known, k, t)
        discard(pairs, far)
        known = known + new
        labels = _linked(labels, new, t)
    discard(texts, profiles, rest)
    links = _links(_all(known), t)

    named = _roots(labels)
    ids = classes.join(named, F.col("point") == F.col("node"), "left").select("point", "least", F.coalesce("root", "point").alias("root"))
    smallest = ids.groupBy("root").agg(F.min("least").alias("component"))
    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n_links"))
    found = ids.join(smallest, "root").join(degree, F.col("point") == F.col("node"), "left") \
        .select(F.col("point").alias("c_point"), "root", "component", "n_links")
    out = written(own.join(found, (F.col("point") == F.col("c_point")) & (F.col("n") > 0), "left").select(
        "id", "tie", F.col("n").alias("n_shingles"), "point", F.col("root").alias("group"),
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links")), "similar")
    discard(points, labels, *known)
    return out


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = WORDS,
                  t: Fraction = THRESHOLD) -> DataFrame:
    """The input's rows and columns, one row of each group of linked documents: the one with the smallest id
    (null ids last).  Rows alike in id and text count as one document; of those, too, one row stays.
    Texts without words are in no group and stay.
    """
    found = similar_components(docs, id_col, text_col, k, t).select("id", "tie", "group")
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "tie")
    kept = found.filter(F.col("group").isNotNull()).groupBy("group").agg(F.min(place).alias("first")).select("first.id", "first.tie") \
        .unionByName(found.filter(F.col("group").isNull()).select("id", "tie").distinct())
    kept = kept.select(F.coalesce("id", F.lit(0)).alias("k_id"), F.col("id").isNull().alias("k_null"), F.col("tie").alias("k_tie"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    own = F.col(f"`{id_col}`").cast("long")
    rows = docs.select(row, F.coalesce(own, F.lit(0)).alias("k_id"), own.isNull().alias("k_null"),
                       F.coalesce(F.xxhash64(F.col(f"`{text_col}`").cast("string")), F.lit(0)).alias("k_tie"))
    joined = rows.join(kept, ["k_id", "k_null", "k_tie"]).groupBy("k_id", "k_null", "k_tie").agg(F.first("row").alias("row"))
    return joined.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def _texts_of(involved: DataFrame, own: DataFrame, rows: DataFrame) -> DataFrame:
    """``(point, text)``: one text of each point that shares a region."""
    one = own.join(involved, "point", "left_semi").groupBy("point").agg(F.min(F.struct(F.coalesce("id", F.lit(-1)).alias("id"), "tie")).alias("row"))
    one = one.select("point", F.col("row.id").alias("id"), F.col("row.tie").alias("tie"))
    found = rows.select(F.coalesce("id", F.lit(-1)).alias("id"), "tie", "text").join(one, ["id", "tie"]).select("point", "text")
    return written(found.dropDuplicates(["point"]), "texts")


def _distance() -> Column:
    return 1 - F.col("inter") / (F.col("na") + F.col("nb") - F.col("inter"))


def _links(known: DataFrame, t: Fraction) -> DataFrame:
    return known.filter(_within(F.col("inter"), F.col("na"), F.col("nb"), t)).select("a", "b")


def _roots(labels: DataFrame) -> DataFrame:
    return labels.unionByName(labels.select(F.col("root").alias("node"), "root").distinct())


def _all(known: list[DataFrame]) -> DataFrame:
    out = known[0]
    for part in known[1:]:
        out = out.unionByName(part)
    return out


def _linked(labels: DataFrame | None, new: list[DataFrame], t: Fraction) -> DataFrame:
    """``labels`` after the links of the ``new`` pairs: only the components that they join are looked at."""
    found = _links(_all(new), t)
    if labels is None:
        return components(found)
    for end in ("a", "b"):
        to = labels.select(F.col("node").alias("l_node"), F.col("root").alias("l_root"))
        found = found.join(to, F.col(end) == F.col("l_node"), "left").withColumn(end, F.coalesce("l_root", end)).drop("l_node", "l_root")
    joined = written(found.filter("a <> b").distinct(), "joined")
    if joined.isEmpty():
        discard(joined)
        return labels
    roots = components(joined)
    to = roots.select(F.col("node").alias("l_node"), F.col("root").alias("l_root"))
    out = written(labels.join(to, F.col("root") == F.col("l_node"), "left").select("node", F.coalesce("l_root", "root").alias("root")).unionByName(roots), "labels")
    discard(joined, labels, roots)
    return out


def _ordered(rows: DataFrame, x: str, nx: str, y: str, ny: str) -> DataFrame:
    """``(a, b, na, nb)`` with ``a < b`` of the points ``x`` and ``y`` and their sizes."""
    swap = F.col(x) > F.col(y)
    pick = lambda c, d: F.when(swap, F.col(d)).otherwise(F.col(c))
    return rows.select(pick(x, y).alias("a"), pick(y, x).alias("b"), pick(nx, ny).alias("na"), pick(ny, nx).alias("nb"))


def _measured(pairs: DataFrame, texts: DataFrame, profiles: DataFrame, known: list[DataFrame], k: int, t: Fraction) -> tuple[list[DataFrame], DataFrame]:
    """The pairs ``(a, b, na, nb)`` that are not ``known`` and may be near, with the size of their intersection, and
    a table that has those ruled out with a lower bound ``low`` of their distance.  They are measured in slices that
    ship about as many texts as there are."""
    new = pairs.filter(_near_size(F.col("na"), F.col("nb"), t)).distinct()
    if known:
        new = new.join(_all(known).select("a", "b"), ["a", "b"], "left_anti")
    bounded = written(_bounded(new, profiles, t), "pairs")
    near = bounded.filter("near").select("a", "b", "na", "nb")
    slices = max(1, -(-2 * near.count() // max(1, texts.count())))
    parts = [written(_distances(near.filter(F.pmod(F.xxhash64("a"), F.lit(slices)) == i), texts, k), "slice") for i in range(slices)]
    far = bounded.filter("NOT near").select("a", "b", "low")
    far._written_to = bounded._written_to
    return parts, far


def _next_round(rest: DataFrame, labels: DataFrame, t: Fraction, small: int) -> tuple[DataFrame, DataFrame | None]:
    """One step of the recursion: the points of regions that are still open, without the new pivots, and
    the pairs of new pivots with the other points of their regions (None if there are no pivots).

    In an open region two points can only be apart if one is outside the first pivot's component, so new
    pivots are drawn from those: all of them in a region of up to ``small`` points, up to ``small`` in a larger one.
    """
    named = _roots(labels)
    home = named.select(F.col("node").alias("p"), F.col("root").alias("p_root"))
    at = rest.join(named, F.col("point") == F.col("node"), "left").drop("node").withColumn("root", F.coalesce("root", "point")) \
        .join(home, "p", "left").withColumn("home", F.coalesce("p_root", "p")).drop("p_root")
    open_ = at.groupBy("region").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.count(F.lit(1)).alias("size")) \
        .filter("r0 <> r1").select("region", "size")
    at = written(at.join(open_, "region"), "open")
    outside = at.filter("root <> home")
    few = outside.filter(F.col("size") <= small).select("region", F.col("point").alias("a"))
    many = outside.filter(F.col("size") > small).groupBy("region", F.pmod(F.xxhash64("point"), F.lit(small)).alias("part")) \
        .agg(F.min(F.struct("rare", "point")).alias("least")).select("region", F.col("least.point").alias("a"))
    chosen = few.unionByName(many)
    pivots = written(chosen.join(at, (chosen["region"] == at["region"]) & (F.col("a") == F.col("point"))).select(
        chosen["region"].alias("region"), "a", F.col("n").alias("na"), F.col("pos").alias("a_pos"), F.col("low").alias("a_low"), F.col("high").alias("a_high"), F.col("root").alias("ra")), "pivots")
    if pivots.isEmpty():
        discard(at, pivots)
        return rest, None
    # the first pivot's distances: d(x, y) >= d(x, p) - d(y, p)
    within = float(1 - t) + 1e-9
    beyond = (F.col("low") - F.col("a_high") > within) | (F.col("a_low") - F.col("high") > within)
    # sizes and places are compared before the pairs are shuffled
    pairs = at.join(pivots, "region").filter(_near_size(F.col("n"), F.col("na"), t)).filter(_placed(F.col("n"), F.col("pos"), F.col("na"), F.col("a_pos"), t)).filter((F.col("root") != F.col("ra")) & ~beyond)
    pairs = written(_ordered(pairs, "a", "na", "point", "n").distinct(), "round")
    left = written(at.join(pivots.select("region", F.col("a").alias("point")), ["region", "point"], "left_anti")
                   .select("region", "p", "point", "n", "rare", "pos", "low", "high"), "rest")
    discard(rest, at, pivots)
    return left, pairs
