"""Merkle manifest of a dataset, kept as postorder append logs (operator 11).

Every tree (one per source, and one over the sources' roots) is a log of its nodes in the order in which
they complete: a node follows its last child at once, so appending leaves never moves a node that is
there.  A full node of level ``l`` that ends with leaf ``e`` has all full nodes that end earlier before it,
and of those that end with ``e`` the lower ones, so its place is a sum of ``floor(e / 3**j)``; the short
runs at the right edge follow, level by level, when the tree is sealed.  ``position`` is this closed form.
Proofs ask the log for siblings by place and need no pointers.

Leaves get their place in the tree from a global sort (ranges, then running counts of a row per range and
tree), so a source with a third of all rows is many ranges.  Builders take aligned blocks of ``3**SPAN``
nodes of a level and keep only the open runs; each tier of blocks is a ``3**SPAN``-th of the one below.
Proofs go the other way, from the root's tier down, each block with the chain of its own root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cordon.llm.scratch import discard, written

ARITY = 3
#: levels of an aligned block: 729 nodes of one level
SPAN = 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

LOG = "tree string, n bigint, level int, idx bigint, pos bigint, hash string"
PROOF = "array<struct<left:string,right:string>>"


def height(n: int) -> int:
    """Levels above the leaves of a tree of ``n`` leaves."""
    level, reach = 0, 1
    while reach < n:
        level, reach = level + 1, reach * ARITY
    return level


def position(n: int, level: int, index: int) -> int:
    """Place in the log of the node ``index`` of ``level`` in a tree of ``n`` leaves."""
    top, width = height(n), ARITY ** level
    end = (index + 1) * width
    if end <= n:
        return sum(end // ARITY ** j for j in range(level + 1)) + sum((end - 1) // ARITY ** j for j in range(level + 1, top + 1)) - 1
    full, whole = sum(n // ARITY ** j for j in range(top + 1)), 0
    while n % ARITY ** (whole + 1) == 0:
        whole += 1
    return full + level - whole - 1


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, ``:`` and the value."""
    s = value.cast("string")
    return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf_hash(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]).cast("binary"), 256)


def _tiers(n: int) -> int:
    return max(1, -(-height(n) // SPAN))


def _tiers_of(n: Column) -> Column:
    found = F.lit(1)
    for i in range(1, 6):  # 3**30 leaves are beyond any table
        found = found + (n > ARITY ** (SPAN * i)).cast("int")
    return found


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (with a column ``tree``) and ``idx``, the place in the tree by ``order``, and ``n``, the tree's size."""
    dealt = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    dealt = written(dealt.withColumn("at", F.monotonically_increasing_id()), "ordered").withColumn("shard", F.shiftright("at", 33))
    by = Window.partitionBy("tree").orderBy("shard")  # a row per range that the tree lies in
    runs = dealt.groupBy("tree", "shard").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    runs = runs.select(F.col("tree").alias("r_tree"), F.col("shard").alias("r_shard"), "first",
                       F.coalesce(F.sum("rows").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
                       F.sum("rows").over(Window.partitionBy("tree")).alias("n"))
    return dealt.join(runs, (F.col("tree") == F.col("r_tree")) & (F.col("shard") == F.col("r_shard"))) \
        .withColumn("idx", F.col("before") + F.col("at") - F.col("first")).drop("r_tree", "r_shard", "shard", "first", "before", "at")


def _append(base: int, keep_input: bool):
    """Build the blocks of one tier: a task reads them sorted and appends nodes as they complete."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = {"block": None, "open": [], "n": 0, "tree": None}
        out: list[dict] = []

        def put(level: int, index: int, value: str) -> None:
            n = state["n"]
            out.append({"tree": state["tree"], "n": n, "level": level, "idx": index, "pos": position(n, level, index), "hash": value})

        def close(level: int) -> None:
            """The open run of ``level`` becomes a node of the next level."""
            run_ = state["open"][level - base]
            index = run_[0][0] // ARITY
            value = digest("".join(h for _, h in run_))
            run_.clear()
            put(level + 1, index, value)
            if level + 1 < state["top"]:
                state["open"][level + 1 - base].append((index, value))

        def seal() -> None:
            """Short runs of the block, which only the tree's last block has."""
            for level in range(base, state.get("top", base)):
                if state["open"][level - base]:
                    close(level)

        for batch in batches:
            for row in batch.to_pylist():
                block = (row["tree"], row["idx"] // ARITY ** SPAN)
                if block != state["block"]:
                    seal()
                    top = min(base + SPAN, height(row["n"]))
                    state.update(block=block, tree=row["tree"], n=row["n"], top=top, open=[[] for _ in range(base, top)])
                if keep_input:
                    put(base, row["idx"], row["hash"])
                if base < state["top"]:
                    state["open"][0].append((row["idx"], row["hash"]))
                    level = base
                    while level < state["top"] and len(state["open"][level - base]) == ARITY:
                        close(level)
                        level += 1
            if len(out) >= 4096:
                yield _log_batch(out)
                out.clear()
        seal()
        if out:
            yield _log_batch(out)

    return run


_LOG_ARROW = pa.schema([("tree", pa.string()), ("n", pa.int64()), ("level", pa.int32()), ("idx", pa.int64()), ("pos", pa.int64()), ("hash", pa.string())])


def _log_batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=_LOG_ARROW)


def append_log(leaves: DataFrame, largest: int) -> tuple[DataFrame, list[DataFrame]]:
    """The log of every tree of ``leaves`` (``tree, n, idx, hash``; ``largest`` is the greatest ``n``), and the tables it is kept in.

    A row is a node: ``tree, n, level, idx, pos, hash``.  Each block's nodes stand together in the order of
    ``pos``.  The root is the one node of level ``height(n)``; a tree of one leaf is that leaf.
    """
    nodes = leaves.select("tree", F.col("n").cast("long").alias("n"), F.col("idx").cast("long").alias("idx"), "hash")
    parts = []
    for tier in range(_tiers(largest)):
        dealt = nodes.withColumn("block", F.floor(F.col("idx") / F.lit(ARITY ** SPAN).cast("long")).cast("long")).repartition("tree", "block") \
            .sortWithinPartitions("tree", "block", "idx").select("tree", "n", "idx", "hash")
        part = written(dealt.mapInArrow(_append(tier * SPAN, tier == 0), LOG), "log")
        parts.append(part)
        nodes = part.filter((F.col("level") == (tier + 1) * SPAN) & (_tiers_of(F.col("n")) > tier + 1)).select("tree", "n", "idx", "hash")
    log = parts[0]
    for part in parts[1:]:
        log = log.unionByName(part)
    return log, parts


def _extract(base: int, row_type: pa.DataType):
    """Proofs of one tier: a task reads each block's chain, its nodes, then the wanted places."""
    link = pa.struct([("left", pa.string()), ("right", pa.string())])
    schema = pa.schema([("tree", pa.string()), ("n", pa.int64()), ("idx", pa.int64()), ("row", row_type), ("proof", pa.list_(link)),
                        ("subroot", pa.string()), ("root", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, chain, held, links = None, None, {}, {}

        def siblings(n: int, level: int, index: int) -> dict:
            if (level, index) not in links:
                first = index - index % ARITY
                last = min(first + ARITY, -(-n // ARITY ** level))
                run_ = [held[position(n, level, j)] if j != index else None for j in range(first, last)]
                own = index - first
                links[level, index] = {"left": "".join(run_[:own]), "right": "".join(run_[own + 1:])}
            return links[level, index]

        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if (r["tree"], r["block"]) != block:
                    block, held, links = (r["tree"], r["block"]), {}, {}
                if r["kind"] == 0:
                    chain = r
                elif r["kind"] == 1:
                    held[r["pos"]] = r["hash"]
                else:
                    own, index = [], r["idx"]
                    for level in range(base, min(base + SPAN, height(r["n"]))):
                        own.append(siblings(r["n"], level, index))
                        index //= ARITY
                    out.append({"tree": r["tree"], "n": r["n"], "idx": r["idx"], "row": r["row"], "proof": own + chain["proof"],
                                "subroot": chain["subroot"], "root": chain["root"]})
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


def proofs(log: DataFrame, largest: int, wanted: DataFrame, tops: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """For each row of ``wanted`` (``tree, n, idx, row``): its proof, from the leaf's own run up, followed by the
    chain that ``tops`` (``tree, n, proof, subroot, root``) has for the tree's root; and tables to discard later.

    A link holds what stands left and right of the node in its run, so ``sha256(left || node || right)`` is the
    node above.  ``row`` is any struct and comes back as it is.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    row_type, made, above = wanted.schema["row"].dataType, [], None
    for tier in reversed(range(_tiers(largest))):
        base, reach = tier * SPAN, ARITY ** SPAN
        asked = wanted if tier == 0 else log.filter((F.col("level") == base) & (_tiers_of(F.col("n")) > tier)) \
            .select("tree", "n", "idx", F.lit(None).cast(row_type).alias("row"))
        chains = tops.filter(_tiers_of(F.col("n")) == tier + 1).select("tree", F.lit(0).cast("long").alias("block"), "n", "proof", "subroot", "root")
        if above is not None:
            chains = chains.unionByName(above)
        width = F.lit(ARITY ** (base + SPAN)) / F.pow(F.lit(float(ARITY)), F.col("level"))
        nodes = log.filter((F.col("level") >= base) & (F.col("level") < base + SPAN)).withColumn("block", F.floor(F.col("idx") / width).cast("long"))
        none = F.lit(None)
        rows = chains.select("tree", "block", F.lit(0).alias("kind"), none.cast("long").alias("pos"), "n", none.cast("long").alias("idx"), none.cast("string").alias("hash"),
                             none.cast(row_type).alias("row"), "proof", "subroot", "root")
        rows = rows.unionByName(nodes.select("tree", "block", F.lit(1).alias("kind"), "pos", "n", "idx", "hash"), allowMissingColumns=True)
        rows = rows.unionByName(asked.select("tree", F.floor(F.col("idx") / F.lit(reach)).cast("long").alias("block"), F.lit(2).alias("kind"),
                                             none.cast("long").alias("pos"), "n", "idx", "row"), allowMissingColumns=True)
        dealt = rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "kind", "pos")
        found = dealt.mapInArrow(_extract(base, to_arrow_type(row_type)),
                                 f"tree string, n bigint, idx bigint, row {row_type.simpleString()}, proof {PROOF}, subroot string, root string")
        if tier == 0:
            return found, made
        above = written(found.select("tree", F.col("idx").alias("block"), "n", "proof", "subroot", "root"), "chains")
        made.append(above)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that ``leaf`` and the siblings of ``proof`` give."""
    return F.aggregate(proof, leaf, lambda below, p: F.sha2(F.concat(p["left"], below, p["right"]).cast("binary"), 256))


def proof_hash(proof: Column) -> Column:
    return F.sha2(F.array_join(F.transform(proof, lambda p: F.concat(p["left"], p["right"])), "").cast("binary"), 256)


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, source_col: str = "source", id_col: str = "doc_id",
             other_leaf: Column | None = None) -> DataFrame:
    """``id, leaf, other, proof, subroot, root`` of every row; ``other`` is ``other_leaf`` (a leaf hash over the
    input's columns, the own leaf by default), to be folded with the row's proof.

    Leaves of a source ascend by id, null ids first, then by leaf hash; repeated rows are leaves of their own,
    alike in all but their place.  Null sources are one source, before all others; an empty string is another.
    Null fields are ``-``, empty ones ``0:``.  A text may be of any length, it only passes through the hash.  An
    empty table has no rows and no root.  Other columns are not read, whatever their names.
    """
    leaf = leaf_hash(*[F.col(f"`{c}`") for c in fields])
    source = F.col(f"`{source_col}`").cast("string")
    # 'n' before 's...': null first, then bytewise
    rows = docs.select(F.when(source.isNull(), "n").otherwise(F.concat(F.lit("s"), source)).alias("tree"), F.col(f"`{id_col}`").cast("long").alias("id"),
                       leaf.alias("hash"), (leaf if other_leaf is None else other_leaf).alias("other"))
    hashed = written(rows, "leaves")
    leaves = written(ranked(hashed.withColumn("tie", F.monotonically_increasing_id()), ["id", "hash", "tie"]).drop("tie"), "ranked")
    largest = leaves.agg(F.max("n")).first()[0] or 1
    log, parts = append_log(leaves, largest)
    roots = _roots(log)
    # the tree over the sources' roots
    upper = written(ranked(roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("n").alias("leaves"), "hash"), ["name"]), "sources")
    n_sources = upper.count() or 1
    top_log, top_parts = append_log(upper, n_sources)
    start = _roots(top_log).select("tree", "n", F.array().cast(PROOF).alias("proof"), F.lit(None).cast("string").alias("subroot"), F.col("hash").alias("root"))
    asked = upper.select("tree", "n", "idx", F.struct("name", "leaves", "hash").alias("row"))
    found, made = proofs(top_log, n_sources, asked, start)
    tops = written(found.select(F.col("row.name").alias("tree"), F.col("row.leaves").alias("n"), "proof", F.col("row.hash").alias("subroot"), "root"), "tops")
    discard(*made)
    asked = leaves.select("tree", "n", "idx", F.struct("id", F.col("hash").alias("leaf"), "other").alias("row"))
    found, made = proofs(log, largest, asked, tops)
    out = written(found.select("row.id", "row.leaf", "row.other", "proof", "subroot", "root"), "proofs")
    discard(hashed, leaves, upper, tops, *parts, *top_parts, *made)
    return out


def _roots(log: DataFrame) -> DataFrame:
    """The one node of each tree's last level."""
    top = F.lit(0)
    for level in range(SPAN * 6):
        top = top + (F.col("n") > F.lit(ARITY ** level)).cast("int")
    return log.filter(F.col("level") == top)
