"""Quality rules with host verdicts (operator 8).

Per document, five rules (too few words, repeated word windows, symbols, repeated lines, odd word
length).  Failures are added up per host, each host's failure rate is shrunk towards the corpus by an
empirical beta prior, and a host whose shrunk rate is too high is rejected: of its documents only those
that pass every rule stay.  Elsewhere only the two base rules reject, so a document that passes all
rules is always kept.

Only built-in functions.  The text never crosses a shuffle: rule failures are counted per host (partial
sums first), and the host table, one row per host, is joined back.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cordon.llm.scratch import written
from cordon.llm.text import WORD, let, whole, words

WINDOW = 5


@dataclass(frozen=True)
class HostRules:
    """Limits of the rules; percentages are of words, or of lines with a word."""

    min_words: int = 10
    max_repeat_pct: int = 20
    max_symbol_pct: int = 60
    max_dup_line_pct: int = 50
    word_length: tuple[float, float] = (2.0, 20.0)
    reject_rate: float = 0.5
    #: largest strength of the prior, in documents (reached when all hosts fail alike)
    max_prior: float = 1000.0


DEFAULT = HostRules()


def _window_hashes(ws: Column) -> Column:
    """64-bit hashes of the 5-word windows, in order."""
    return let(F.transform(ws, lambda w: F.xxhash64(w)), lambda h: F.transform(
        F.sequence(F.lit(0), F.size(h) - WINDOW), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)])))


def _covered(hashes: Column) -> Column:
    """Words covered by windows found twice or more, from all windows' hashes.

    In sorted order equal windows are neighbours.  Each one that has an equal neighbour covers five
    words, or as many as lie before the next such window.
    """
    placed = F.zip_with(hashes, F.sequence(F.lit(0), F.size(hashes) - 1), lambda h, i: F.struct(h.alias("h"), i.alias("i")))

    def twice(ps: Column) -> Column:
        same = lambda p, k: F.when((k >= 0) & (k < F.size(ps)), F.get(ps, k)["h"] == p["h"]).otherwise(F.lit(False))
        return F.filter(ps, lambda p, k: same(p, k - 1) | same(p, k + 1))

    def total(at: Column) -> Column:
        steps = F.transform(at, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - p, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    return let(F.sort_array(placed), lambda ps: let(F.sort_array(F.transform(twice(ps), lambda p: p["i"])), total))


def _repeat_words(ws: Column) -> Column:
    found = let(_window_hashes(ws), lambda hs: F.when(F.size(F.array_distinct(hs)) < F.size(hs), _covered(hs)).otherwise(F.lit(0)))
    return F.when(F.size(ws) > WINDOW, found).otherwise(F.lit(0)).cast("long")


def _line_counts(text: Column) -> Column:
    """``n_lines`` (lines with a word) and ``n_dup_lines`` (those equal to an earlier one)."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))
    return let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"),
                                         (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))


def measures(text: Column) -> Column:
    """A struct of the text's counts: ``n_words, word_chars, n_symbols, n_lines, n_dup_lines,
    n_repeat_words`` (all long).  Null counts as empty."""
    t = whole(text)
    in_words = F.length(t) - F.length(F.regexp_replace(t, r"[^\x20\x09-\x0D]+", ""))
    lines = _line_counts(t)
    of_words = let(words(text), lambda ws: F.struct(F.size(ws).cast("long").alias("n_words"), _repeat_words(ws).alias("n_repeat_words")))
    return let(F.struct(of_words.alias("w"), lines.alias("l")), lambda x: F.struct(
        x["w"]["n_words"].alias("n_words"), in_words.cast("long").alias("word_chars"),
        F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        x["l"]["n_lines"].alias("n_lines"), x["l"]["n_dup_lines"].alias("n_dup_lines"),
        x["w"]["n_repeat_words"].alias("n_repeat_words")))


def failures(m: Column, rules: HostRules = DEFAULT) -> dict[str, Column]:
    """The rules over ``measures``; true where the document fails.  Whole numbers throughout."""
    low, high = rules.word_length
    return {
        "few_words": m["n_words"] < rules.min_words,
        "repeats": m["n_repeat_words"] * 100 > m["n_words"] * rules.max_repeat_pct,
        "symbols": m["n_symbols"] * 100 > m["n_words"] * rules.max_symbol_pct,
        "dup_lines": m["n_dup_lines"] * 100 > m["n_lines"] * rules.max_dup_line_pct,
        "word_length": (m["word_chars"] < m["n_words"] * low) | (m["word_chars"] > m["n_words"] * high),
    }


def assess(docs: DataFrame, text_col: str = "text", host_col: str = "source", rules: HostRules = DEFAULT,
           keep: Sequence[str] | None = None) -> DataFrame:
    """``row`` (the input row, or its columns ``keep``), ``host``, ``m`` (the measures), ``base_failed`` and ``n_failed`` (rules failed)."""
    columns = [F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)]
    m = docs.select(F.struct(*columns).alias("row"), F.col(f"`{host_col}`").cast("string").alias("host"),
                    measures(F.col(f"`{text_col}`")).alias("m"))
    rule = failures(F.col("m"), rules)
    return m.withColumn("base_failed", rule["few_words"] | rule["repeats"]) \
        .withColumn("n_failed", sum(r.cast("int") for r in rule.values()))


def host_verdicts(assessed: DataFrame, rules: HostRules = DEFAULT) -> DataFrame:
    """One row per host: ``host, n_docs, n_bad, rate`` (shrunk) and ``rejected``.

    The prior is a beta distribution whose mean and variance are those of the hosts' failure rates
    (each host counts once): mean ``m`` and strength ``m (1 - m) / v - 1``, between 1 and ``max_prior``
    documents.  The shrunk rate is ``(n_bad + m * strength) / (n_docs + strength)``.
    """
    per = assessed.groupBy("host").agg(F.count(F.lit(1)).alias("n_docs"),
                                       F.sum((F.col("n_failed") > 0).cast("long")).alias("n_bad"))
    moments = per.agg(F.avg(F.col("n_bad") / F.col("n_docs")).alias("mean"),
                      F.var_pop(F.col("n_bad") / F.col("n_docs")).alias("var")).first()  # two numbers
    mean, var = moments["mean"] or 0.0, moments["var"] or 0.0
    strength = min(max(mean * (1 - mean) / var - 1, 1.0), rules.max_prior) if var > 0 else rules.max_prior
    return per.select("host", "n_docs", "n_bad",
                      ((F.col("n_bad") + F.lit(mean * strength)) / (F.col("n_docs") + F.lit(strength))).alias("rate")) \
        .withColumn("rejected", F.col("rate") > rules.reject_rate)


def judge(docs: DataFrame, text_col: str = "text", host_col: str = "source", rules: HostRules = DEFAULT,
          keep: Sequence[str] | None = None) -> DataFrame:
    """``row, host, m, base_failed, n_failed, host_rate, host_rejected, kept`` for every input row.

    ``row`` is a struct of the columns ``keep`` (all of them by default), so clashing names stay inside
    it.  Null host: a host of its own.  Null or empty text: fails the first rule.  Repeated rows count as
    often as they occur.  An empty table gives no rows.

    The texts are measured once; the assessed rows are written to the shared folder, read once for the
    host table and once for the verdicts.  The host table is written too: its size is known before the join
    is planned, so texts are dealt by host only where it is too large for Spark to broadcast.
    """
    assessed = written(assess(docs, text_col, host_col, rules, keep), "assessed")
    verdicts = written(host_verdicts(assessed.select("host", "n_failed"), rules), "verdicts") \
        .select(F.col("host").alias("v_host"), F.col("rate").alias("host_rate"), F.col("rejected").alias("host_rejected"))
    joined = assessed.join(verdicts, F.col("host").eqNullSafe(F.col("v_host")), "left").drop("v_host")
    return joined.withColumn("kept", ~F.col("base_failed") & ~(F.col("host_rejected") & (F.col("n_failed") > 0)))


def kept_rows(docs: DataFrame, **options) -> DataFrame:
    """The input's rows and columns, without those that ``judge`` rejects."""
    return judge(docs, **options).filter("kept").select(*[F.col("row")[c].alias(c) for c in docs.columns])
