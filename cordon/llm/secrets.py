"""Secret scan by sliding-window Shannon entropy (operator 9).

Base spans come from three patterns.  The method adds high-entropy strings: every run of secret-like
characters that holds a digit is a candidate; a window slides over it, and the entropy of the window's
characters is kept up to date from the counts of the character that leaves and the one that enters.  A
candidate is a secret if its largest entropy passes the threshold of its character class (hex, letters
and digits, base64) and no allow rule speaks against it.

Only built-in functions; each row is worked on alone, so nothing is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cordon.llm.text import any_touching, let, span_index, spans_if, whole

# --- fixed values of the base patterns (either case where the contract says so)
ASSIGN = (r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
          r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ASSIGN_MIN = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"  # 20 characters or more; a run is taken whole, so the count can be part of the pattern
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "entropy")

#: runs of these characters with a digit; tried at the start of a run only, so the scan stays linear
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])[A-Za-z0-9+/_=-]{20,}+"

#: never secrets: numbers and dates, dashed or underscored plain words, placeholders, UUIDs
ALLOW = (
    r"^[0-9_=/+-]+$",
    r"^[A-Za-z]+(?:[_/=+-]+(?:[A-Za-z]+|[0-9]{1,4}))*$",
    r"(?i)example|placeholder|changeme|dummy|xxxx|0123456789|abcdefgh",
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
)


@dataclass(frozen=True)
class EntropyRule:
    """Bits a character that a window must reach, by class, and the window's length."""

    window: int = 20
    hex_bits: float = 2.9
    alnum_bits: float = 3.6
    base64_bits: float = 3.7
    allow: tuple[str, ...] = ALLOW


DEFAULT = EntropyRule()


def _weight(count: Column) -> Column:
    """c log2 c, and 0 for 0."""
    return F.when(count > 0, count * F.log2(count.cast("double"))).otherwise(F.lit(0.0))


def max_window_entropy(s: Column, window: int) -> Column:
    """The largest entropy, in bits, of ``window`` consecutive characters of ``s`` (of all, if shorter).

    With counts c in a window of n characters, the entropy is log2 n - (sum of c log2 c) / n.  Only
    the counts of the leaving and the entering character change from window to window.
    """
    count = lambda w, ch: F.length(w) - F.length(F.replace(w, ch, F.lit("")))

    def slide(cs: Column) -> Column:
        n = F.least(F.size(cs), F.lit(window))
        first = F.array_join(F.slice(cs, F.lit(1), n), "")
        begin = F.aggregate(F.array_distinct(F.slice(cs, F.lit(1), n)), F.lit(0.0), lambda a, ch: a + _weight(count(first, ch)))

        def step(state: Column, enters: Column) -> Column:
            w = state["w"]
            leaves = F.substring(w, 1, 1)
            rest = F.substring(w, 2, window)
            out, into = count(w, leaves), count(rest, enters)
            total = state["total"] + (_weight(out - 1) - _weight(out)) + (_weight(into + 1) - _weight(into))
            return F.struct(F.concat(rest, enters).alias("w"), total.alias("total"), F.least(state["least"], total).alias("least"))

        later = F.slice(cs, n + 1, F.greatest(F.size(cs) - n, F.lit(0)))
        state = let(begin, lambda b: F.aggregate(later, F.struct(first.alias("w"), b.alias("total"), b.alias("least")), step))
        return F.log2(n.cast("double")) - state["least"] / n

    return F.when(F.length(s) > 0, let(F.split(s, ""), slide)).otherwise(F.lit(0.0))


def is_secret(s: Column, rule: EntropyRule = DEFAULT) -> Column:
    """The class's threshold and the allow rules for one candidate."""
    bits = F.when(s.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"), F.lit(rule.hex_bits)) \
        .when(s.rlike("^[A-Za-z0-9]+$"), F.lit(rule.alnum_bits)).otherwise(F.lit(rule.base64_bits))
    allowed = F.lit(False)
    for pattern in rule.allow:
        allowed = allowed | s.rlike(pattern)
    return F.when(allowed, F.lit(False)).otherwise(max_window_entropy(s, rule.window) >= bits)


def _of_kind(spans: Column, kind: str) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"),
                                                 s["stop"].alias("stop"), F.lit(kind).alias("kind")))


def find_secrets(docs: DataFrame, text_col: str = "text", rule: EntropyRule = DEFAULT) -> DataFrame:
    """The input's columns inside ``row`` and two arrays, ``base`` and ``added``, of
    ``struct<start, rank, stop, kind>`` (code points, ``stop`` exclusive) in order of start and kind.

    An added span never touches a base span.  Null or empty text: no spans.  Rows are independent, so
    repeated rows give repeated results; an empty table gives no rows.  Long texts take time by their length.
    """
    t = F.col("t")
    assign = F.filter(spans_if(t, t.rlike(r"(?:[Pp][Aa][Ss][Ss][Ww]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk])"
                                          r"[A-Za-z]*[\"']?\x20*[:=]"), ASSIGN),
                      lambda s: F.length(F.regexp_extract(s["found"], f"^{ASSIGN}$", 1)) >= ASSIGN_MIN)
    access = spans_if(t, F.contains(t, F.lit("AKIA")), ACCESS)
    hexes = spans_if(t, t.rlike("[0-9a-f]{24}"), HEX)
    # \x85 and friends cannot occur inside a match, so ^...$ above sees the match whole
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(F.struct(*columns).alias("row"), whole(F.col(f"`{text_col}`")).alias("t"))
    rows = rows.withColumn("base", F.sort_array(F.concat(_of_kind(assign, "assign"), _of_kind(access, "access"), _of_kind(hexes, "hex"))))
    candidates = spans_if(t, t.rlike(CANDIDATE), CANDIDATE)
    outside = let(F.struct(candidates.alias("all"), span_index(F.col("base")).alias("base")),
                  lambda x: F.filter(x["all"], lambda s: ~any_touching(s, x["base"])))
    added = F.filter(outside, lambda s: is_secret(s["found"], rule))
    return rows.withColumn("added", _of_kind(added, "entropy")).select("row", "base", "added")


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
