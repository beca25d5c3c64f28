"""Mixing sources to target weights by weighted fair queueing (operator 10).

Every source's documents are shuffled by a hash and served in that order.  A document's virtual
finish time is the number of its source's words served so far, itself included, divided by the
source's target.  Repeats go on counting: round 2 starts where the source's whole size ended.  All
copies are then ordered by virtual finish time over all sources and the order is cut at the total
budget.  A source reaches its target at time 1, whatever its size.

Only built-in functions.  Running sums never gather a source in one task: a source is dealt into
hash ranges of about ``rows_per_range`` documents, the ranges' sums are added up first, and a window
runs inside each range alone.  The global order is cut the same way, by ranges of virtual time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cordon.llm.scratch import written
from cordon.llm.text import word_count

#: weights by the rank of the source's name, repeating
WEIGHTS = (5.0, 2.0, 1.0)
MAX_ROUNDS = 3
ROWS_PER_RANGE = 4000
ROWS_PER_SLOT = 50_000


def source_targets(sized: DataFrame, weights: Sequence[float] = WEIGHTS, max_rounds: int = MAX_ROUNDS,
                   budget_share: float = 1.0) -> DataFrame:
    """One row per source: ``source, source_size, n_docs, weight, target``.

    ``sized`` has ``source, size``.  Sources are ranked by code point, null last.  The budget
    (``budget_share`` of all sizes) is shared by weight; a target stops at ``max_rounds`` times the
    source's size and the excess is shared again.  That fixed point is ``min(cap, level * weight)``
    for one level, found by ordering the sources by ``cap / weight``.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    # one row per source from here on
    everything = Window.partitionBy(F.lit(0))
    by_name = everything.orderBy(F.col("source").asc_nulls_last())
    w = F.array(*[F.lit(float(x)) for x in weights])
    ranked = per.select(
        "*", F.get(w, (F.row_number().over(by_name) - 1) % len(weights)).alias("weight"),
        (F.sum("source_size").over(everything) * F.lit(float(budget_share))).alias("budget"),
    ).withColumn("cap", F.col("source_size").cast("double") * max_rounds)
    by_fill = everything.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_fill.rowsBetween(0, Window.unboundedFollowing)
    # the level if exactly the sources before this one are capped; right for the first whose cap is above it
    level = ((F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(rest))
    levelled = ranked.withColumn("level", level)
    settled = levelled.withColumn(
        "level", F.min(F.when(F.col("level") <= F.col("cap") / F.col("weight"),
                              F.struct((F.col("cap") / F.col("weight")).alias("fill"), F.col("level").alias("level"))))
        .over(everything)["level"])
    return settled.select(
        "source", "source_size", "n_docs", "weight", "budget",
        F.when(F.col("source_size") == 0, F.lit(0.0))
        .otherwise(F.coalesce(F.least("cap", F.col("level") * F.col("weight")), F.col("cap"))).alias("target"))


def _rank(key: Column) -> Column:
    """32 bits of the key's hash as a fraction of 1."""
    return F.conv(F.substring(key, 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))


def sized_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               seed: str = "mix") -> DataFrame:
    """The narrow table the queue works on: ``id, source, size, key, tie``.  ``key`` shuffles, ``tie``
    is a hash of the whole row; rows alike in both are alike in every column."""
    hashable = [c for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    return docs.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").cast("string").alias("source"),
        word_count(F.col(f"`{text_col}`")).alias("size"), *_shuffle_key(id_col, hashable, seed))


def _shuffle_key(id_col: str, columns: Sequence[str], seed: str) -> list[Column]:
    return [F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("-")))).alias("key"),
            F.xxhash64(*[F.col(f"`{c}`") for c in columns]).alias("tie")]


def virtual_queue(sized: DataFrame, weights: Sequence[float] = WEIGHTS, max_rounds: int = MAX_ROUNDS,
                  budget_share: float = 1.0, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Each row of ``sized`` with its source's ``source_size, target, budget`` and ``served``: words of
    the source up to and with this row, in the source's shuffled order."""
    t = source_targets(sized, weights, max_rounds, budget_share) \
        .select(F.col("source").alias("t_source"), "source_size", "n_docs", "target", "budget")
    joined = sized.join(t, F.col("source").eqNullSafe(F.col("t_source"))).drop("t_source")
    ranged = joined.withColumn(
        "range", F.floor(_rank(F.col("key")) * F.ceil(F.col("n_docs") / F.lit(float(rows_per_range)))))
    sums = ranged.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    earlier = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("s_source"), F.col("range").alias("s_range"),
                       F.coalesce(F.sum("range_size").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("source", "range").orderBy("key", "tie", "size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    placed = ranged.withColumn("inside", F.sum("size").over(inside))
    return placed.join(sums, F.col("source").eqNullSafe(F.col("s_source")) & (F.col("range") == F.col("s_range"))) \
        .select("id", "source", "size", "source_size", "target", "budget", "key", "tie",
                (F.col("before") + F.col("inside")).alias("served"))


def _rounds(max_rounds: int) -> Column:
    """Virtual finish time of each copy; a document without words takes no part."""
    finish = [F.struct(((F.col("served") + F.col("source_size") * e) / F.col("target")).alias("finish"),
                       F.lit(e + 1).alias("round")) for e in range(max_rounds)]
    return F.when((F.col("size") > 0) & (F.col("target") > 0), F.array(*finish)) \
        .otherwise(F.array().cast("array<struct<finish:double,round:int>>"))


def _order(finish: Column, nth: Column) -> Column:
    """The global order of copies: virtual finish time, then source (null last), then the shuffle."""
    return F.struct(finish.alias("finish"), F.col("source").isNull().alias("no_source"),
                    F.coalesce("source", F.lit("")).alias("source"), F.col("key"), F.col("tie"),
                    F.col("served"), nth.alias("round"))


def budget_cut(queue: DataFrame, max_rounds: int = MAX_ROUNDS, rows_per_slot: int = ROWS_PER_SLOT) -> DataFrame:
    """One row, ``cut``: the place of the last copy within the budget in the global order (null if none).

    Copies are dealt into slots of virtual time, about ``n / rows_per_slot`` of them up to time 1.  The
    slots' sums tell the slot in which the budget ends; copies are ordered in it and the one before.
    """
    slots = max(1, -(-queue.count() // rows_per_slot))
    copies = queue.withColumn("c", F.explode(_rounds(max_rounds))) \
        .select("size", "budget", F.floor(F.col("c.finish") * F.lit(float(slots))).alias("slot"),
                _order(F.col("c.finish"), F.col("c.round")).alias("place"))
    sums = copies.groupBy("slot").agg(F.sum("size").alias("slot_size"), F.max("budget").alias("budget"))
    upto = Window.partitionBy(F.lit(0)).orderBy("slot").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = sums.withColumn("before", F.sum("slot_size").over(upto) - F.col("slot_size")) \
        .filter(F.col("before") <= F.col("budget")).orderBy(F.col("slot").desc()).limit(2) \
        .select(F.col("slot").alias("l_slot"), "before")
    inside = Window.partitionBy("slot").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return copies.join(F.broadcast(last), F.col("slot") == F.col("l_slot")) \
        .withColumn("upto", F.col("before") + F.sum("size").over(inside)) \
        .filter(F.col("upto") <= F.col("budget")).agg(F.max("place").alias("cut"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: Sequence[float] = WEIGHTS, max_rounds: int = MAX_ROUNDS, budget_share: float = 1.0,
                seed: str = "mix") -> DataFrame:
    """One row per input row: ``id, source, size, source_size, target, finish`` (virtual finish time of its
    first copy), ``copies`` (how often the mix takes it), and ``key, tie`` that name it.

    Null text, or one without words: size 0, no copies.  Null source: a source of its own, last in rank.
    Null ids share one place in the shuffle; equal rows tie and are served one after the other.  An empty
    table gives no rows.  Other columns are not looked at, whatever their names, but for the tie.
    """
    sized = written(sized_rows(docs, id_col, text_col, source_col, seed), "mix-sizes")
    queue = written(virtual_queue(sized, weights, max_rounds, budget_share), "mix-queue")
    cut = budget_cut(queue, max_rounds).first()["cut"]  # the place of one copy
    if cut is None:
        copies = F.lit(0)
    else:
        last = F.struct(*[F.lit(v).alias(k) for k, v in cut.asDict().items()])
        copies = F.size(F.filter(_rounds(max_rounds), lambda c: _order(c["finish"], c["round"]) <= last))
    return queue.select(
        "id", "source", "size", "source_size", "target",
        F.when(F.col("target") > 0, F.col("served") / F.col("target")).alias("finish"),
        copies.cast("long").alias("copies"), "key", "tie")


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", seed: str = "mix", **options) -> DataFrame:
    """The mix itself: the input's rows and columns, each row as often as it was taken.

    Rows alike in every column are one group on the way (their copies are added up), so a row repeated
    any number of times stays one row in the shuffle.
    """
    taken = mix_sources(docs, id_col=id_col, seed=seed, **options).groupBy("key", "tie") \
        .agg(F.sum("copies").alias("copies")).filter(F.col("copies") > 0)
    hashable = [c for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(row, *_shuffle_key(id_col, hashable, seed)).groupBy("key", "tie").agg(F.first("row").alias("row"))
    return rows.join(taken, ["key", "tie"]) \
        .select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("nth")) \
        .select(*[F.col("row")[c].alias(c) for c in docs.columns])
