"""Quotation linking in conversations (operator 2).

Messages quote earlier ones with ``>`` at the start of lines, nested as deep as they like.  Lines become
passages (neighbouring lines of one level), passages become sentences, and a sentence, like a whole passage
of several, is named by the hash of its normalised text.  What is quoted, however short, is joined to the latest earlier message of the
conversation that says it itself; a message replies to the message that most of its first-level quotes
come from (the later one of a tie), or else to the message before it.  What is left without quotes, in
the order of replies (each message followed by its replies, earlier turns first, with all below them), is
the conversation.

Only built-in functions.  Nothing gathers a conversation: the latest earlier message is found by ranges
of ``TURNS`` turns, whose own latest ones are carried over, so a conversation with a third of all
messages is many small windows.  The order of replies is a walk around the tree of replies, whose steps are
summed up by pointer doubling: each round joins every step with the one its pointer tells, one to one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cordon.llm.scratch import discard, written
from cordon.llm.text import let, whole

TURNS = 256
#: the quote marks before a line
MARKS = r"^[ \t]*+(?:>[ \t]*+)++"
SAID_TYPE = "array<struct<level:int,said:string,weight:int>>"
_NEW, _BODY = "\u0001", "\u0002"


def _lines(text: Column) -> Column:
    """``array<struct<level, body>>``; a line without marks is level 0 and stays as it is."""
    def parse(line: Column) -> Column:
        return let(F.regexp_extract(line, MARKS, 0), lambda m: F.struct(
            (F.length(m) - F.length(F.replace(m, F.lit(">"), F.lit("")))).alias("level"),
            F.substring(line, F.length(m) + 1, F.length(line)).alias("body")))

    clean = F.translate(F.regexp_replace(text, "\r\n?", "\n"), _NEW + _BODY, "  ")
    return F.transform(F.split(clean, "\n", -1), parse)


def own_text(text: Column) -> Column:
    """The text without its quoted lines; blank lines at both ends go."""
    own = F.filter(_lines(whole(text)), lambda x: x["level"] == 0)
    return F.regexp_replace(F.array_join(F.transform(own, lambda x: x["body"]), "\n"), r"^\s+|\s+$", "")


def sentences(text: Column) -> Column:
    """``array<struct<level, said, weight>>``: normalised sentences (``weight`` 2), and the whole of a passage of
    ``k`` of them (``2 k + 1``: more than its sentences together)."""
    def marked(lines: Column) -> Column:
        blank = lambda x: F.trim(x["body"]) == ""
        new = lambda x, i: (i == 0) | blank(x) | F.coalesce(F.get(lines, i - 1)["level"] != x["level"], F.lit(True))
        return F.array_join(F.transform(lines, lambda x, i: F.when(
            new(x, i), F.concat(F.lit(_NEW), x["level"].cast("string"), F.lit(_BODY), x["body"])).otherwise(F.concat(F.lit(" "), x["body"]))), "")

    passages = F.filter(F.split(let(_lines(whole(text)), marked), _NEW, -1), lambda p: F.contains(p, F.lit(_BODY)))
    def said(level: Column, body: Column) -> Column:
        one = lambda s, weight: F.struct(level.alias("level"), F.trim(s).alias("said"), weight.alias("weight"))
        return let(F.split(body, r"(?<=[.!?]) ", -1), lambda each: F.concat(
            F.transform(each, lambda s: one(s, F.lit(2))), F.when(F.size(each) > 1, F.array(one(body, F.size(each) * 2 + 1))).otherwise(F.array().cast(SAID_TYPE))))

    every = F.flatten(F.transform(passages, lambda p: let(F.split(p, _BODY, 2), lambda x: said(
        F.get(x, F.lit(0)).cast("int"), F.trim(F.lower(F.regexp_replace(F.get(x, F.lit(1)), r"\s+", " ")))))))
    return F.filter(every, lambda s: s["said"] != "")


def latest_before(probes: DataFrame, events: DataFrame, keys: list[str]) -> DataFrame:
    """For each distinct ``(keys, turn)`` of ``probes`` the latest earlier ``turn`` of ``events`` with equal
    keys, as ``found`` (null if none).

    Both sides are made distinct first, so a range of ``TURNS`` turns has twice as many rows at most.
    """
    both = probes.select(*keys, "turn").withColumn("event", F.lit(0)).distinct() \
        .unionByName(events.select(*keys, "turn").withColumn("event", F.lit(1)).distinct()) \
        .withColumn("range", F.floor(F.col("turn") / F.lit(float(TURNS))))
    tops = both.groupBy(*keys, "range").agg(F.max(F.when(F.col("event") == 1, F.col("turn"))).alias("top"))
    carried = tops.select(*keys, "range", F.max("top").over(
        Window.partitionBy(*keys).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)).alias("carried"))
    inside = Window.partitionBy(*keys, "range").orderBy("turn", "event").rowsBetween(Window.unboundedPreceding, -1)
    near = both.withColumn("near", F.max(F.when(F.col("event") == 1, F.col("turn"))).over(inside)).filter("event = 0")
    return near.join(carried, [*keys, "range"]).select(*keys, "turn", F.coalesce("near", "carried").alias("found"))


def link_quotes(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text") -> DataFrame:
    """One row per message: ``conv_id, turn, role, body`` (without quotes), ``max_level`` (of its lines),
    ``n_quoted`` and ``n_linked`` (quoted sentences, and those found in an earlier message), ``reply_to`` (a turn),
    ``by_quote`` (whether a quote says so), ``position`` (messages of the conversation before this turn),
    ``thread`` (the turn its chain of replies begins with) and ``place`` (messages before this turn in the
    order of replies).

    Null text: empty body, nothing quoted.  Null conversation or turn: the message stands alone, without
    ``reply_to``, ``position``, ``thread`` and ``place``.  Messages of one turn are one place: they share
    links, position and place.
    Repeated rows stay.  An empty table gives no rows.
    """
    rows = messages.select(F.col(f"`{conv_col}`").cast("long").alias("conv_id"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
                           F.col(f"`{role_col}`").cast("string").alias("role"), F.col(f"`{text_col}`").cast("string").alias("text"))
    placed = rows.filter(F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
    said = placed.select("conv_id", "turn", F.explode(sentences(F.col("text"))).alias("s")) \
        .select("conv_id", "turn", F.col("s.level").alias("level"), F.md5("s.said").alias("said"), F.col("s.weight").alias("weight")).distinct()
    quoted = said.filter("level > 0")
    # only sentences that are quoted somewhere in the conversation matter
    originals = said.filter("level = 0").join(quoted.select("conv_id", "said").distinct(), ["conv_id", "said"], "left_semi")
    found = quoted.join(latest_before(quoted, originals, ["conv_id", "said"]), ["conv_id", "said", "turn"])
    hits = found.filter(F.col("found").isNotNull() & (F.col("level") == 1)).groupBy("conv_id", "turn", "found") \
        .agg(F.sum("weight").alias("n"))
    source = hits.groupBy("conv_id", "turn").agg(F.max(F.struct("n", "found")).alias("best")) \
        .select("conv_id", "turn", F.col("best.found").alias("quoted_turn"))
    counts = found.groupBy("conv_id", "turn").agg(F.count_if(F.col("weight") == 2).alias("n_quoted"),
                                                  F.count_if((F.col("weight") == 2) & F.col("found").isNotNull()).alias("n_linked"))
    turns = placed.groupBy("conv_id", "turn").agg(F.count(F.lit(1)).alias("n"), F.max(
        F.array_max(F.transform(_lines(whole(F.col("text"))), lambda x: x["level"]))).alias("max_level"))
    previous = latest_before(turns, turns, ["conv_id"]).withColumnRenamed("found", "previous")
    per = turns.join(previous, ["conv_id", "turn"]).join(_before(turns), ["conv_id", "turn"]) \
        .join(counts, ["conv_id", "turn"], "left").join(source, ["conv_id", "turn"], "left") \
        .withColumn("reply_to", F.coalesce("quoted_turn", "previous"))
    per = written(per, "replies")
    per = per.join(reply_order(per), ["conv_id", "turn"]) \
        .withColumnsRenamed({"conv_id": "c", "turn": "t"})
    joined = rows.join(per, (F.col("conv_id") == F.col("c")) & (F.col("turn") == F.col("t")), "left")
    zero = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(0))
    return joined.select("conv_id", "turn", "role", own_text(F.col("text")).alias("body"), zero("max_level").alias("max_level"),
                         zero("n_quoted").alias("n_quoted"), zero("n_linked").alias("n_linked"),
                         "reply_to", F.col("quoted_turn").isNotNull().alias("by_quote"), "position", "thread", "place")


def reply_order(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, thread, place`` from distinct ``conv_id, turn`` with ``n`` messages and ``reply_to``, an
    earlier turn or null.

    A walk enters (side 0) and leaves (side 1) each turn, its replies by turn in between.  ``before`` points
    back along it; ``s`` counts the messages entered since.
    """
    replies = turns.filter("reply_to IS NOT NULL").select("conv_id", F.col("reply_to").alias("parent"), "turn")
    first = replies.groupBy("conv_id", "parent").agg(F.min("turn").alias("first")).withColumnRenamed("parent", "turn")
    sibling = latest_before(replies, replies, ["conv_id", "parent"]).filter("found IS NOT NULL") \
        .select("conv_id", F.col("found").alias("turn"), F.col("turn").alias("sibling"))
    near = turns.join(first, ["conv_id", "turn"], "left").join(sibling, ["conv_id", "turn"], "left")
    walk = near.select("conv_id", "turn", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.coalesce("first", "turn").alias("next"), F.col("first").isNull().cast("int").alias("next_side"), F.col("n").alias("s")),
        F.struct(F.lit(1).alias("side"), F.coalesce("sibling", "reply_to").alias("next"), F.col("sibling").isNull().cast("int").alias("next_side"),
                 F.lit(0).cast("long").alias("s")))).alias("e")).select("conv_id", "turn", "e.*")
    walk = written(walk, "walk")
    back = walk.filter("next IS NOT NULL").select("conv_id", F.col("next").alias("turn"), F.col("next_side").alias("side"),
                                                  F.col("turn").alias("before"), F.col("side").alias("before_side"))
    now = written(walk.join(back, ["conv_id", "turn", "side"], "left").select("conv_id", "turn", "side", "before", "before_side", "s", F.col("turn").alias("head")), "order")
    discard(walk)
    while not now.filter("before IS NOT NULL").isEmpty():
        ahead = now.select("conv_id", F.col("turn").alias("before"), F.col("side").alias("before_side"), F.col("before").alias("b"),
                           F.col("before_side").alias("b_side"), F.col("s").alias("more"), F.col("head").alias("top"))
        stepped = now.filter("before IS NOT NULL").join(ahead, ["conv_id", "before", "before_side"]) \
            .select("conv_id", "turn", "side", F.col("b").alias("before"), F.col("b_side").alias("before_side"), (F.col("s") + F.col("more")).alias("s"),
                    F.col("top").alias("head"))
        last, now = now, written(now.filter("before IS NULL").unionByName(stepped), "order")
        discard(last)
    return now.filter("side = 0").join(turns.select("conv_id", "turn", "n"), ["conv_id", "turn"]) \
        .select("conv_id", "turn", F.col("head").alias("thread"), (F.col("s") - F.col("n")).alias("place"))


def _before(turns: DataFrame) -> DataFrame:
    """``position``: how many messages stand before each turn; ranges of turns are added up first."""
    ranged = turns.withColumn("range", F.floor(F.col("turn") / F.lit(float(TURNS))))
    sums = ranged.groupBy("conv_id", "range").agg(F.sum("n").alias("all"))
    sums = sums.select("conv_id", "range", F.coalesce(F.sum("all").over(
        Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("earlier"))
    inside = Window.partitionBy("conv_id", "range").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    return ranged.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(sums, ["conv_id", "range"]) \
        .select("conv_id", "turn", (F.col("earlier") + F.col("inside")).alias("position"))


def chat_chunks(linked: DataFrame, messages_per_chunk: int = 64) -> DataFrame:
    """Conversations as text, in reply order (each message followed by its replies): ``conv_id, chunk,
    part, chat`` with one ``role: body`` paragraph per message.

    A chunk holds the messages of ``messages_per_chunk`` places.  Equal messages of one turn become one
    with a count, and a turn with very many different ones is dealt into parts by hash, so no row grows
    with the conversation.
    """
    entries = linked.filter(F.col("place").isNotNull()).groupBy("conv_id", "place", "turn", "role", "body", "reply_to") \
        .agg(F.count(F.lit(1)).alias("times"))
    crowd = entries.groupBy("conv_id", "place").agg(F.ceil(F.count(F.lit(1)) / F.lit(float(messages_per_chunk))).alias("parts"))
    dealt = entries.join(crowd, ["conv_id", "place"]) \
        .withColumn("chunk", F.floor(F.col("place") / F.lit(float(messages_per_chunk)))) \
        .withColumn("part", F.when(F.col("parts") > 1, F.pmod(F.xxhash64("role", "body"), F.col("parts"))).otherwise(F.lit(0)).cast("long"))
    line = F.concat(F.coalesce("role", F.lit("?")), F.lit(": "), F.col("body"),
                    F.when(F.col("times") > 1, F.concat(F.lit(" (x"), F.col("times").cast("string"), F.lit(")"))).otherwise(F.lit("")))
    grouped = dealt.groupBy("conv_id", "chunk", "part").agg(F.sort_array(F.collect_list(F.struct("place", "turn", line.alias("line")))).alias("m"))
    return grouped.select("conv_id", "chunk", "part", F.array_join(F.transform("m", lambda m: m["line"]), "\n\n").alias("chat"))
