"""Personal data by candidate gradient boosting (operator 6).

1. Base spans: e-mail addresses, IP addresses, payment cards (Luhn) and international phone numbers.
2. High-recall generators propose overlapping candidates: anything around an at sign or a spelt-out
   "at", and in each run of digit groups every span of neighbouring groups with 7 to 19 digits, every
   longer group, and the whole run.
3. Boosted trees score a candidate by its format and its context.  They are fitted here, on candidates
   that the base patterns label: those that are a valid base span against the rest, pieces of base spans
   among them, and on rows of labelled numbers, which against what lies across them.  The format leaves out what only the base patterns look for (the plus sign and country code).
4. On held-out candidates the scores are calibrated: the threshold is the lowest score from which on
   the share of labelled candidates reaches ``precision``.  Candidates above it that touch no base
   span are added; among overlapping ones the best score stays.

Only DataFrame functions and Spark's own trees; a fitted model becomes a column expression, so each
document is scored where it lies and no text is shuffled.  Fit and calibration see every labelled candidate of
all documents, equal feature rows as one with their number.  In the fit a label weighs ``max_train / 2``
candidates at most, so a rare one is learnt too; the labels' true shares go into the calibration.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from cordon.llm.scratch import discard, written
from cordon.llm.text import SPAN_TYPE, any_touching, chunks, let, match_spans, part_of, running, span_index, spans_if, whole

KINDS = ("email", "ip", "card", "phone")

# --- fixed values: the base patterns.  A run is tried where it starts, or where the last match ended
# (\G): the leftmost match can begin nowhere else, and the scan stays linear on very long runs.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9]){12,}+"  # shorter runs fail anyway; a run is taken whole
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BYTE = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
IP_VALID = rf"^{BYTE}\.{BYTE}\.{BYTE}\.{BYTE}$"

# --- generators of the method
AT_LIKE = (r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++(?:@|\x20?[(\[]at[)\]]\x20?|\x20at\x20)[A-Za-z0-9-]++"
           r"(?:(?:\.|\x20?[(\[]dot[)\]]\x20?|\x20dot\x20)[A-Za-z0-9-]++)*+")
AT_NEEDS = r"@|[(\[]at[)\]]|\x20at\x20[A-Za-z0-9-]+\x20dot\x20"
NUMBER = r"(?:(?<![A-Za-z0-9.])|\G)(?:\+[0-9]{1,3}[\x20.-]?)?\(?[0-9]++(?:[\x20().-]{1,2}+[0-9]++)*+"
GROUP = r"(?:^\+)?\(?[0-9]++"  # of a run: where a span may begin and end
LEAST_DIGITS, MOST_DIGITS = 7, 19
NUMBER_NEEDS = r"[0-9](?:[\x20().-]{0,2}[0-9]){6}"
CUE = r"(?i)(?:tel|phone|call|mobile|cell|fax|mail|contact|card|visa|iban|account|ssn|reach)[^A-Za-z0-9]*(?:[a-z]{1,4}[^A-Za-z0-9]+)?$"

FEATURES = ("digits", "groups", "longest", "last", "parens", "dots", "dashes", "spaces", "letters", "at_sign",
            "spelt", "top_domain", "four_bytes", "luhn", "cue", "odd_before", "odd_after")


@dataclass(frozen=True)
class Boosting:
    """``max_train`` bounds what the labelled candidates weigh in the fit, half of it for either label (rows made of
    them weigh half as many on top); all of them take part.  A fit on the documents alone needs ``least`` candidates of either label in each half."""

    trees: int = 8
    depth: int = 3
    max_train: int = 20_000
    least: int = 20
    precision: float = 0.95
    seed: int = 7


DEFAULT = Boosting()


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    def part(d: Column, i: Column) -> Column:
        v = d.cast("int")
        return F.when(i % 2 == 0, v).when(v > 4, v * 2 - 9).otherwise(v * 2)

    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), part), F.lit(0), lambda a, x: a + x) % 10 == 0


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def base_spans(t: Column) -> dict[str, Column]:
    """Valid base matches by kind; a failing match is dropped and not tried again."""
    n = lambda s: F.length(_digits(s["found"]))
    return {
        "email": spans_if(t, F.contains(t, F.lit("@")), EMAIL),
        "ip": F.filter(spans_if(t, t.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"), IP), lambda s: s["found"].rlike(IP_VALID)),
        "card": F.filter(spans_if(t, t.rlike(CARD), CARD), lambda s: F.when(n(s) <= 19, luhn(_digits(s["found"]))).otherwise(F.lit(False))),
        "phone": F.filter(spans_if(t, t.rlike(r"\+[0-9]"), PHONE), lambda s: n(s).between(9, 15)),
    }


def _ranked(spans: Column, kind: Column) -> Column:
    rank = lambda k: F.array_position(F.array(*[F.lit(x) for x in KINDS]), k)
    return F.transform(spans, lambda s: F.struct(rank(kind).alias("rank"), s["start"].alias("start"), s["stop"].alias("stop"),
                                                 kind.alias("kind")))


def _touches(s: Column, others: Column) -> Column:
    return F.exists(others, lambda b: (b["start"] < s["stop"]) & (s["start"] < b["stop"]))


def _bare(s: Column) -> Column:
    return F.regexp_replace(s["found"], r"^\+[0-9]{1,3}[\x20.-]?", "")


def _before(pieces: Column, s: Column) -> Column:
    return part_of(pieces, F.greatest(s["start"] - 24, F.lit(0)), F.least(s["start"], F.lit(24)))


def _features(pieces: Column, s: Column) -> Column:
    """The features of candidate ``s`` of the text in ``pieces`` (``chunks``), an array of doubles in the order of ``FEATURES``."""
    return _of_context(s, _before(pieces, s), part_of(pieces, s["stop"], F.lit(2)))


def _of_context(s: Column, before: Column, after: Column) -> Column:
    bare = _bare(s)

    def of(x: Column) -> Column:
        b, digits, groups = x["bare"], x["digits"], x["groups"]
        count = lambda ch: F.length(b) - F.length(F.replace(b, F.lit(ch), F.lit("")))
        sizes = F.transform(groups, lambda g: F.length(g))
        return F.array(*[c.cast("double") for c in (
            F.length(digits), F.size(groups), F.coalesce(F.array_max(sizes), F.lit(0)), F.coalesce(F.get(sizes, F.size(groups) - 1), F.lit(0)),
            count("("), count("."), count("-"), count(" "), b.rlike("[A-Za-z]"), F.contains(b, F.lit("@")),
            b.rlike(r"(?:[(\[]|\x20)(?:at|dot)(?:[)\]]|\x20)"), b.rlike(r"(?:\.|dot[)\]]?\x20?)[A-Za-z]{2,6}$"), b.rlike(IP_VALID),
            F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(F.lit(False)),
            x["before"].rlike(CUE), x["before"].rlike(r"[A-Za-z0-9$#=/_.-]$"), x["after"].rlike(r"^(?:[A-Za-z0-9%/_=]|[.-][0-9])"))])

    return let(F.struct(bare.alias("bare"), _digits(bare).alias("digits"),
                        F.regexp_extract_all(bare, F.lit("[0-9]+"), F.lit(0)).alias("groups"),
                        before.alias("before"), after.alias("after")), of)


def _spans_of_run(run: Column) -> Column:
    """The candidates of a run of digit groups; a start has ``MOST_DIGITS`` of them at most, and the run is one more."""
    n = lambda g: F.length(_digits(g["found"]))

    def of(x: Column) -> Column:
        groups = x["groups"]

        def cut(first: Column, last: Column) -> Column:
            # one group may be of any length; several with MOST_DIGITS digits at most are far shorter than a piece
            found = F.when(first["start"] == last["start"], first["found"]) \
                .otherwise(part_of(x["pieces"], first["start"], last["stop"] - first["start"]))
            return F.array(F.struct((run["start"] + first["start"]).alias("start"), (run["start"] + last["stop"]).alias("stop"),
                                    found.alias("found"))).cast(SPAN_TYPE)

        def from_start(first: Column, i: Column) -> Column:
            zero = F.struct(F.lit(0).alias("n"), F.array().cast(SPAN_TYPE).alias("spans"))

            def step(acc: Column, last: Column) -> Column:
                total = acc["n"] + n(last)
                wanted = (total >= LEAST_DIGITS) & ((total <= MOST_DIGITS) | (acc["n"] == 0))
                return F.struct(total.alias("n"), F.when(wanted, F.concat(acc["spans"], cut(first, last))).otherwise(acc["spans"]).alias("spans"))

            return F.aggregate(F.slice(groups, i + 1, F.lit(MOST_DIGITS)), zero, step)["spans"]

        over = (F.size(groups) > 1) & (F.length(_digits(run["found"])) > MOST_DIGITS)
        return F.concat(F.flatten(F.transform(groups, from_start)), F.when(over, F.array(run).cast(SPAN_TYPE)).otherwise(F.array().cast(SPAN_TYPE)))

    return let(F.struct(match_spans(run["found"], GROUP).alias("groups"), chunks(run["found"]).alias("pieces")), of)


def _candidates(t: Column) -> Column:
    """Overlapping candidates of both generators."""
    runs = F.filter(spans_if(t, t.rlike(NUMBER_NEEDS), NUMBER), lambda s: F.length(_digits(s["found"])) >= LEAST_DIGITS)
    return F.concat(spans_if(t, t.rlike(AT_NEEDS), AT_LIKE), F.flatten(F.transform(runs, _spans_of_run)))


def _label(s: Column, base: Column) -> Column:
    """1 for a candidate that is a base span, 0 for another, null for a phone's span without the country code:
    its format is the one to be learnt.  ``base`` is the index of the base spans."""
    size = lambda x: x["stop"] - x["start"]
    whole_one = any_touching(s, base, lambda b: (s["start"] <= b["start"]) & (b["stop"] <= s["stop"]) & (size(s) - size(b) <= 1))
    bare_one = any_touching(s, base, lambda b: (b["kind"] == "phone") & (s["stop"] == b["stop"]) & (s["start"] - b["start"]).between(1, 5))
    return F.when(s["found"].rlike("@|[A-Za-z]"), any_touching(s, base).cast("double")).when(whole_one, F.lit(1.0)) \
        .when(~bare_one, F.lit(0.0))


def _scanned(docs: DataFrame, text_col: str) -> DataFrame:
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), whole(F.col(f"`{text_col}`")).alias("t"))
    base = F.concat(*[_ranked(spans, F.lit(kind)) for kind, spans in base_spans(F.col("t")).items()])
    # sorting needs no key of its own: kind as listed, then start, are the first fields
    return rows.withColumn("base", F.sort_array(base)).withColumn("candidates", _candidates(F.col("t")))


def _tree(node) -> Column:
    """A fitted regression tree as a column over ``x``, the array of features."""
    def build(x: Column, n) -> Column:
        if n.getClass().getSimpleName() == "LeafNode":
            return F.lit(float(n.prediction()))
        split = n.split()
        return F.when(F.get(x, F.lit(int(split.featureIndex()))) <= float(split.threshold()), build(x, n.leftChild())) \
            .otherwise(build(x, n.rightChild()))

    return lambda x: build(x, node)


@dataclass(frozen=True)
class Scorer:
    """Boosted trees as a column expression, and the calibrated threshold."""

    trees: tuple
    weights: tuple[float, ...]
    threshold: float

    def score(self, features: Column) -> Column:
        margin = let(features, lambda x: sum((tree(x) * w for tree, w in zip(self.trees, self.weights)), F.lit(0.0)))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(margin * -2.0))


#: rows of examples that stand in where the documents label too little
MADE = 2400


def made_rows(spark) -> DataFrame:
    """``text``: examples of personal data with and of other numbers, the digits from hashes of the row's number."""
    d = lambda k, salt: F.lpad(F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(10 ** k)).cast("string"), k, "0")
    forms = [("please call +1 (", d(3, 1), ") ", d(3, 2), "-", d(4, 3), " today"), ("phone: +44 20 ", d(4, 4), " ", d(4, 5)),
             ("reach me on +49 ", d(3, 6), "-", d(3, 7), "-", d(4, 8), ", or later"), ("write to u", d(4, 9), "@host", d(2, 10), ".example.org now"),
             ("the ratio ", d(4, 11), " ", d(4, 12), " ", d(2, 13), " is given"), ("page ", d(9, 14), " of it"),
             ("order no. ", d(12, 15), " was sent"), ("on 20", d(2, 16), "-0", d(1, 17), "-1", d(1, 18), " at ", d(2, 19), " in rows ", d(3, 20), " and ", d(3, 21)),
             ("build ", d(1, 22), ".", d(1, 23), ".", d(3, 24), ".", d(4, 25), " of the tool"), ("user", d(3, 26), "@local or so")]
    texts = F.array(*[F.concat(*[x if isinstance(x, Column) else F.lit(x) for x in form]) for form in forms])
    return spark.range(MADE).select(F.get(texts, F.pmod("id", F.lit(len(forms))).cast("int")).alias("text"))


def fit_scorer(docs: DataFrame, text_col: str = "text", settings: Boosting = DEFAULT) -> Scorer | None:
    """Fit on labelled candidates of the documents.  Where they hold fewer than ``least`` of either label in a half,
    ``made_rows`` are added to them.  None if no score reaches the precision on the held-out half: the
    calibration then says that nothing may be added."""
    fitted = _fitted(docs.select(F.col(f"`{text_col}`").cast("string").alias("text")), settings)
    if fitted == TOO_FEW:
        with_made = docs.select(F.col(f"`{text_col}`").cast("string").alias("text")).unionByName(made_rows(docs.sparkSession))
        fitted = _fitted(with_made, settings)
    return None if fitted == TOO_FEW else fitted


TOO_FEW = "too few"


def _fitted(docs: DataFrame, settings: Boosting) -> Scorer | str | None:
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector

    scanned = _scanned(docs, "text").filter(F.size("candidates") > 0)
    # what a candidate is judged by is taken beside its text, which is never copied for each of them
    known = let(F.struct(chunks(F.col("t")).alias("pieces"), span_index(F.col("base")).alias("base"), F.substring("t", 1, 64).alias("head")),
                lambda k: F.filter(F.transform("candidates", lambda s: F.struct(
                    _label(s, k["base"]).alias("label"), s.alias("s"), _before(k["pieces"], s).alias("before"), part_of(k["pieces"], s["stop"], F.lit(2)).alias("after"),
                    k["head"].alias("head"))), lambda c: c["label"].isNotNull()))
    half = F.pmod(F.xxhash64(F.col("s.found"), "head"), F.lit(2)) == 0
    labelled = scanned.select(F.inline(known)) \
        .select("label", _of_context(F.col("s"), F.col("before"), F.col("after")).alias("x"), half.alias("half"),
                F.when((F.col("label") == 1) & ~F.col("s.found").rlike("@|[A-Za-z]"), _bare(F.col("s"))).alias("bare"), "before")
    # every labelled candidate counts: equal ones are one row with their number
    cells = written(labelled.groupBy("half", "label", "x").agg(F.count(F.lit(1)).alias("n")), "pii-cells")
    n = cells.groupBy().agg(*[F.coalesce(F.sum(F.when(c & (F.col("label") == y), F.col("n"))), F.lit(0)).alias(f"n{i}{y}")
                              for i, c in enumerate((F.col("half"), ~F.col("half"))) for y in (0, 1)]).first()
    if min(n) < settings.least:
        discard(cells)
        return TOO_FEW
    held = [n[f"n0{y}"] + n[f"n1{y}"] for y in (0, 1)]
    stands_for = [held[y] / n[f"n1{y}"] for y in (0, 1)]  # candidates of all documents to a held-out one of the label
    # base spans seldom stand side by side: a row of two between other numbers shows that each is one and what lies across is none
    row = labelled.filter(F.col("half") & F.col("bare").isNotNull()).select("bare", F.concat("before", F.lit("12 "), "bare", F.lit(" "), "bare", F.lit(" 12")).alias("t"))
    across = written(row.select("t", "bare", F.explode(_candidates(F.col("t"))).alias("s"))
                     .select((F.col("s.found") == F.col("bare")).cast("double").alias("label"), _features(chunks(F.col("t")), F.col("s")).alias("x"))
                     .groupBy("label", "x").agg(F.count(F.lit(1)).alias("n")), "pii-across")
    n_across = across.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # a label's candidates weigh max_train / 2 together at most, so its rarity does not decide; none is left out
    share = lambda of: min(1.0, settings.max_train // 2 / max(of, 1))
    weighed = cells.filter("half").select("label", "x", (F.col("n") * F.when(F.col("label") == 1, share(held[1])).otherwise(share(held[0]))).alias("w")) \
        .unionByName(across.select("label", "x", (F.col("n") * share(n_across)).alias("w")))
    fitted = GBTClassifier(featuresCol="v", labelCol="label", weightCol="w", maxIter=settings.trees, maxDepth=settings.depth, maxBins=32,
                           stepSize=0.3, seed=settings.seed).fit(
        weighed.repartition(4, "x").sortWithinPartitions("x", "label", "w").select("label", "w", array_to_vector("x").alias("v")))
    trees = tuple(_tree(t._call_java("rootNode")) for t in fitted.trees)
    scorer = Scorer(trees, tuple(float(w) for w in fitted.treeWeights), 1.0)
    ordered = Window.partitionBy(F.lit(0)).orderBy(F.col("p").desc())  # one row for each score the trees can give
    cut = cells.filter(~F.col("half")).select("label", "n", scorer.score(F.col("x")).alias("p")).groupBy("p") \
        .agg((F.sum(F.col("label") * F.col("n")) * stands_for[1]).alias("good"), (F.sum((1 - F.col("label")) * F.col("n")) * stands_for[0]).alias("bad")) \
        .withColumn("n", F.col("good") + F.col("bad")) \
        .withColumn("share", F.sum("good").over(ordered) / F.sum("n").over(ordered)) \
        .filter(F.col("share") >= settings.precision).agg(F.min("p")).first()[0]
    discard(cells, across)
    return None if cut is None or cut < 0.5 else Scorer(trees, scorer.weights, float(cut))


def _kind_of(s: Column) -> Column:
    found, n = s["found"], F.length(_digits(s["found"]))
    return F.when(found.rlike("@|[A-Za-z]"), F.lit("email")).when(found.rlike(r"^[0-9]+(?:\.[0-9]+){3}$"), F.lit("ip")) \
        .when(n >= 13, F.lit("card")).otherwise(F.lit("phone"))


def _apart(spans: Column) -> Column:
    """Of overlapping spans (sorted by start) the best ones.  Spans are settled within each chain of overlapping ones,
    so time does not grow with the square of a text's spans, only of a chain's."""
    empty = F.array().cast(SPAN_TYPE)

    def best(chain: Column) -> Column:
        best_first = F.array_sort(F.transform(chain, lambda s: F.struct((-s["p"]).alias("minus"), s["start"].alias("start"), (s["stop"] - s["start"]).alias("size"),
                                                                       s["stop"].alias("stop"), s["found"].alias("found"))))
        return F.aggregate(best_first, empty, lambda acc, s: F.when(_touches(s, acc), acc).otherwise(
            F.concat(acc, F.array(F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["found"].alias("found"))).cast(SPAN_TYPE))))

    def cut(reach: Column) -> Column:
        # where a chain begins, from 1, and one place behind the last
        firsts = F.filter(F.sequence(F.lit(1), F.size(spans)), lambda i: F.when(i == 1, F.lit(True)).otherwise(
            F.get(spans, i - 1)["start"] >= F.get(reach, i - 2)))
        ends = lambda f: F.concat(F.slice(f, F.lit(2), F.size(f)), F.array(F.size(spans) + 1))
        return let(firsts, lambda f: F.flatten(F.zip_with(f, ends(f), lambda a, b: best(F.slice(spans, a, b - a)))))

    return F.when(F.size(spans) > 0, let(running(F.transform(spans, lambda s: s["stop"]), lambda a, x: F.greatest(a, x)), cut)).otherwise(empty)


def find_personal_data(docs: DataFrame, text_col: str = "text", settings: Boosting = DEFAULT,
                       scorer: Scorer | None = None) -> DataFrame:
    """``row`` (the input row) and the arrays ``base`` and ``added`` of ``struct<rank, start, stop, kind>``
    (code points, ``stop`` exclusive), each by kind as listed, then start.

    ``scorer``: one fitted before; by default it is fitted on these documents (``fit_scorer``).  Where no score
    is precise enough nothing is added.  Long texts take time by their length.  Of overlapping added spans the one with the best score stays, of equal ones the
    first, then the shorter.  Null or empty text: no spans.  Repeated rows give repeated results; an empty table gives no rows.
    """
    scorer = scorer or fit_scorer(docs, text_col, settings)
    rows = _scanned(docs, text_col)
    empty = F.array().cast(SPAN_TYPE)
    if scorer is None:
        chosen = empty
    else:
        scored = let(F.struct(chunks(F.col("t")).alias("pieces"), span_index(F.col("base")).alias("base")), lambda k: F.transform(
            F.filter("candidates", lambda s: ~any_touching(s, k["base"])), lambda s: F.struct(
                s["start"].alias("start"), s["stop"].alias("stop"), s["found"].alias("found"), scorer.score(_features(k["pieces"], s)).alias("p"))))
        good = F.filter(scored, lambda s: s["p"] >= scorer.threshold)
        chosen = F.when(F.size("candidates") > 0, let(F.array_sort(good), _apart)).otherwise(empty)
    added = F.transform(chosen, lambda s: let(_kind_of(s), lambda k: F.struct(
        F.array_position(F.array(*[F.lit(x) for x in KINDS]), k).alias("rank"), s["start"].alias("start"), s["stop"].alias("stop"), k.alias("kind"))))
    return rows.withColumn("added", F.sort_array(added)).select("row", "base", "added")
