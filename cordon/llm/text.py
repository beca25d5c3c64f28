"""Column expressions that several text operators share (built-in functions only)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: a word: a run of characters other than space and \t \n \v \f \r (fixed by the contracts)
WORD = r"[^\x20\x09-\x0D]+"
SPACE_RUN = r"[\x20\x09-\x0D]+"

SPAN_TYPE = "array<struct<start:bigint,stop:bigint,found:string>>"


def whole(text: Column) -> Column:
    """The text; null counts as empty."""
    return F.coalesce(text.cast("string"), F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(whole(text), F.lit(WORD)).cast("long")


def words(text: Column) -> Column:
    return F.filter(F.split(whole(text), SPACE_RUN, -1), lambda w: w != "")


def match_spans(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches of ``pattern`` (never empty ones) as
    ``array<struct<start, stop, found>>``, code points, ``stop`` exclusive.

    The text between the matches comes from a split on the same pattern, so a match ends
    where the lengths of all pieces and matches up to it add up to.  Time grows with the text's length.
    """
    def of(found: Column) -> Column:
        between = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
        stops = running(F.zip_with(between, found, lambda b, f: (F.length(b) + F.length(f)).cast("long")), lambda a, x: a + x)
        return F.zip_with(found, stops, lambda f, stop: F.struct((stop - F.length(f)).alias("start"), stop.alias("stop"), f.alias("found")))

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return let(found, lambda f: F.when(F.size(f) > 0, of(f)).otherwise(F.array().cast(SPAN_TYPE)))


#: an array is worked on in blocks of so many elements, blocks of blocks alike
BLOCK = 64


def blocks(xs: Column) -> Column:
    """``xs``, which is not empty, cut into arrays of ``BLOCK`` elements."""
    return let(xs, lambda v: F.transform(F.sequence(F.lit(1), F.size(v), F.lit(BLOCK)), lambda i: F.slice(v, i, F.lit(BLOCK))))


def running(xs: Column, join, levels: int = 2) -> Column:
    """The running ``join`` (sum, greatest) of an array of longs that is not empty, each element included.

    An array grown inside ``aggregate`` is copied at each step; in blocks of ``BLOCK``, twice nested, the copies stay
    short whatever the array's length.
    """
    first = lambda v: F.get(v, F.lit(0))
    rest = lambda v: F.slice(v, F.lit(2), F.size(v))

    def plain(v: Column) -> Column:
        zero = F.struct(first(v).alias("at"), F.array(first(v)).alias("all"))
        step = lambda acc, x: let(join(acc["at"], x), lambda y: F.struct(y.alias("at"), F.concat(acc["all"], F.array(y)).alias("all")))
        return F.aggregate(rest(v), zero, step)["all"]

    def of(parts: Column) -> Column:
        totals = F.transform(parts, lambda v: F.aggregate(rest(v), first(v), join))
        return let(running(totals, join, levels - 1), lambda before: F.flatten(F.transform(
            parts, lambda v, i: F.when(i == 0, plain(v)).otherwise(F.transform(plain(v), lambda x: join(F.get(before, i - 1), x))))))

    if levels == 0:
        return let(xs, plain)
    return let(blocks(xs), of)


def span_index(spans: Column) -> Column:
    """Spans in order of start, in blocks of blocks, each with its least start and greatest stop; for ``any_touching``."""
    bounds = lambda v: (F.array_min(F.transform(v, lambda s: s["start"])).alias("start"), F.array_max(F.transform(v, lambda s: s["stop"])).alias("stop"))
    nest = lambda xs: F.transform(blocks(xs), lambda v: F.struct(*bounds(v), v.alias("inside")))
    kind = "array<struct<start:bigint,stop:bigint,kind:string>>"
    for _ in range(2):
        kind = f"array<struct<start:bigint,stop:bigint,inside:{kind}>>"
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind"))))
    return F.when(F.size(spans) > 0, nest(nest(ordered))).otherwise(F.array().cast(kind))


def any_touching(s: Column, index: Column, test=lambda b: F.lit(True)) -> Column:
    """Whether a span of the index shares a character with ``s`` and passes ``test``; only blocks that reach ``s`` are opened."""
    meets = lambda b: (b["start"] < s["stop"]) & (s["start"] < b["stop"])
    return F.exists(index, lambda far: meets(far) & F.exists(far["inside"], lambda near: meets(near) & F.exists(
        near["inside"], lambda b: meets(b) & test(b))))


def chunks(text: Column) -> Column:
    """The text in pieces of ``CHUNK`` code points, for ``part_of``."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))


CHUNK = 256


def part_of(pieces: Column, start: Column, size: Column) -> Column:
    """``size`` code points, at most ``CHUNK``, from ``start`` on (0 or more), in the time of two pieces: ``substring``
    of a whole text walks there from its beginning."""
    piece = lambda k: F.coalesce(F.get(pieces, k), F.lit(""))
    at = F.floor(start / CHUNK).cast("int")
    return F.substring(F.concat(piece(at), piece(at + 1)), (start - at * CHUNK + 1).cast("int"), size.cast("int"))


def spans_if(text: Column, needs: Column, pattern: str) -> Column:
    """``match_spans`` only where the cheap test ``needs`` holds; elsewhere an empty array."""
    return F.when(needs, match_spans(text, pattern)).otherwise(F.array().cast(SPAN_TYPE))


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))
