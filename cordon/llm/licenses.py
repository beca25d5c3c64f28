"""License scan by ordered signature rules (operator 3).

A text becomes its words (0-9, a-z after lowering A-Z, and non-ASCII characters), joined by single
spaces, and rules are regexes over that.  The rules are hand-written name patterns in a table, put into
a few hand-written forms of words around them: several hundred regexes.  A rule is only tried where its
keyword occurs (one Aho-Corasick scan finds all keywords).  Every match is an interval of words with the
rule's priority; one that lies inside an interval of higher priority, or inside a longer one of equal
priority, is suppressed.  What is left names the labels.

Counting words and the gate (does any keyword stem occur at all?) are column expressions, so only texts
that may hold a license reach Python.  Rows are independent; nothing is shuffled.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cordon.llm.text import whole

WORD = "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"
_WORD = re.compile(WORD)
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

# --- fixed values: the base phrases and their labels
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

#: a text without any of these stems matches no base phrase, and no rule but those of ``NO_STEM``
STEMS = (r"(?i)licen[sc]|copyright|copyleft|spdx|hereby|redistribut|unencumbered|warranty|public[^0-9a-z]+domain|rights[^0-9a-z]+reserved|creative[^0-9a-z]+commons"
        r"|(?<![0-9a-z])(?:cc[^0-9a-z]*(?:by|0|zero)|[al]?gpl|unlicense|wtfpl|creativecommons)")

#: label, the license's names over normalised words, a word that every match holds
NAMES = (
    ("mit", r"mit|expat|x11", "mit|expat|x11"),
    ("mit-0", r"mit (?:0|no attribution)", "mit"),
    ("apache-1", r"(?:apache(?: software)?(?: license)?(?: version| v)? ?1|apachev1)(?: [01])?", "apache|apache1|apachev1"),
    ("apache-2", r"(?:apache(?: software)?(?: license)?(?: version)? v?2|apachev?2)(?: 0)?", "apache|apache2|apachev2"),
    ("bsd-0-clause", r"(?:bsd (?:0|zero)(?: clause)?|0bsd)", "bsd|0bsd"),
    ("bsd-2-clause", r"(?:simplified bsd|freebsd|bsd (?:2|two)(?: clause)?|(?:2|two) clause bsd)", "bsd|freebsd"),
    ("bsd-3-clause", r"(?:(?:new|modified|revised) bsd|bsd (?:3|three)(?: clause)?|(?:3|three) clause bsd)", "bsd"),
    ("bsd-4-clause", r"(?:original bsd|bsd (?:4|four)(?: clause)?|(?:4|four) clause bsd)", "bsd"),
    ("bsd", r"bsd(?: style)?", "bsd"),
    ("gpl-1", r"(?:gnu )?(?:(?:gpl|general public license)(?: version)? v?1|gplv?1)(?: 0)?", "gpl|general|gpl1|gplv1"),
    ("gpl-2", r"(?:gnu )?(?:(?:gpl|general public license)(?: version)? v?2|gplv?2)(?: 0)?", "gpl|general|gpl2|gplv2"),
    ("gpl-3", r"(?:gnu )?(?:(?:gpl|general public license)(?: version)? v?3|gplv?3)(?: 0)?", "gpl|general|gpl3|gplv3"),
    ("gpl", r"(?:gnu )?(?:gpl|general public license)", "gpl|general"),
    ("lgpl-2", r"(?:gnu )?(?:(?:lgpl|(?:lesser|library) general public license)(?: version)? v?2|lgplv?2)(?: 0)?", "lgpl|lesser|library|lgpl2|lgplv2"),
    ("lgpl-2.1", r"(?:gnu )?(?:(?:lgpl|lesser general public license)(?: version)? v?2|lgplv?2) 1", "lgpl|lesser|lgpl2|lgplv2"),
    ("lgpl-3", r"(?:gnu )?(?:(?:lgpl|lesser general public license)(?: version)? v?3|lgplv?3)(?: 0)?", "lgpl|lesser|lgpl3|lgplv3"),
    ("lgpl", r"(?:gnu )?(?:lgpl|(?:lesser|library) general public license)", "lgpl|lesser|library"),
    ("agpl-3", r"(?:gnu )?(?:(?:agpl|affero general public license)(?: version)? v?3|agplv?3)(?: 0)?", "agpl|affero|agpl3|agplv3"),
    ("agpl", r"(?:gnu )?(?:agpl|affero general public license)", "agpl|affero"),
    ("gfdl", r"(?:gnu )?(?:gfdl|free documentation license)", "gfdl|documentation"),
    ("mpl-1.1", r"(?:(?:mpl|mozilla public license)(?: version)? v?1|mplv?1) 1", "mpl|mozilla|mpl1|mplv1"),
    ("mpl-2", r"(?:(?:mpl|mozilla public license)(?: version)? v?2|mplv?2)(?: 0)?", "mpl|mozilla|mpl2|mplv2"),
    ("mpl", r"(?:mpl|mozilla public license)", "mpl|mozilla"),
    ("epl-1", r"(?:(?:epl|eclipse public license)(?: version)? v?1|eplv?1)(?: 0)?", "epl|eclipse|epl1|eplv1"),
    ("epl-2", r"(?:(?:epl|eclipse public license)(?: version)? v?2|eplv?2)(?: 0)?", "epl|eclipse|epl2|eplv2"),
    ("edl-1", r"eclipse distribution license(?: v?1(?: 0)?)?", "eclipse"),
    ("cddl-1", r"(?:cddl|common development and distribution license)(?: version)?(?: v?1(?: [01])?)?", "cddl|development"),
    ("cpl-1", r"(?:cpl|common public license)(?: version)?(?: v?1(?: 0)?)?", "cpl|common"),
    ("eupl-1.2", r"(?:eupl|european union public licen[sc]e)(?: version)?(?: v?1 [0-2])?", "eupl|european"),
    ("artistic-1", r"artistic license(?: version)? v?1(?: 0)?", "artistic"),
    ("artistic-2", r"artistic license(?: version)? v?2(?: 0)?", "artistic"),
    ("isc", r"isc|internet systems consortium", "isc|consortium"),
    ("zlib", r"zlib(?: libpng)?|libpng", "zlib|libpng"),
    ("bsl-1", r"boost software license(?: version)?(?: v?1(?: 0)?)?", "boost"),
    ("unlicense", r"unlicense", "unlicense"),
    ("wtfpl", r"wtfpl|do what the fuck you want to public license", "wtfpl|fuck"),
    ("cc0", r"(?:cc ?0|cc zero|creative commons zero)(?: 1(?: 0)?)?(?: universal)?", "cc|cc0|zero"),
    ("cc-by", r"(?:cc by|creative commons attribution)(?: [1-4](?: [05])?)?", "by|attribution"),
    ("cc-by-sa", r"(?:cc by sa|creative commons attribution share ?alike)(?: [1-4](?: [05])?)?", "sa|alike|sharealike"),
    ("cc-by-nd", r"(?:cc by nd|creative commons attribution no ?deriv(?:ative)?s?)(?: [1-4](?: [05])?)?", "nd|by|attribution"),
    ("cc-by-nc", r"(?:cc by nc|creative commons attribution non ?commercial)(?: [1-4](?: [05])?)?", "nc|attribution"),
    ("cc-by-nc-sa", r"(?:cc by nc sa|creative commons attribution non ?commercial share ?alike)(?: [1-4](?: [05])?)?", "sa|alike|sharealike"),
    ("cc-by-nc-nd", r"(?:cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:ative)?s?)(?: [1-4](?: [05])?)?", "nd|attribution"),
    ("ofl-1.1", r"(?:sil )?open font license(?: version)?(?: 1 1)?", "font"),
    ("odbl-1", r"(?:odbl|open (?:data commons open )?database license)(?: v?1(?: 0)?)?", "odbl|database"),
    ("odc-by-1", r"(?:odc by|open data commons attribution license)(?: v?1(?: 0)?)?", "odc|attribution"),
    ("pddl-1", r"(?:pddl|public domain dedication and license)", "pddl|dedication"),
    ("ms-pl", r"(?:ms pl|microsoft public license)", "pl|microsoft"),
    ("ms-rl", r"(?:ms rl|microsoft reciprocal license)", "rl|microsoft"),
    ("psf-2", r"(?:psf|python software foundation)(?: license)?(?: version)?(?: 2(?: 0)?)?", "psf|python"),
    ("php-3", r"php(?: license)?(?: version)? v?3(?: 0[01]?)?", "php"),
    ("ruby", r"ruby", "ruby"),
    ("postgresql", r"postgresql", "postgresql"),
    ("openssl", r"openssl", "openssl"),
    ("ncsa", r"(?:university of illinois )?ncsa(?: open source)?", "ncsa"),
    ("afl-3", r"(?:afl|academic free license)(?: version)?(?: v?3(?: 0)?)?", "afl|academic"),
    ("osl-3", r"(?:osl|open software license)(?: version)?(?: v?3(?: 0)?)?", "osl|software"),
    ("busl-1.1", r"(?:busl|business source license)(?: 1 1)?", "busl|business"),
    ("sspl-1", r"(?:sspl|server side public license)(?: v?1(?: 0)?)?", "sspl|server"),
    ("elastic-2", r"elastic license(?: v?2(?: 0)?)?", "elastic"),
    ("commons-clause", r"commons clause", "clause"),
    ("llama", r"llama [2-4](?: [0-9])? community license(?: agreement)?", "llama"),
    ("openrail-m", r"(?:bigscience )?(?:open ?rail m?|responsible ai license)", "rail|openrail|responsible"),
)

#: name of the form, priority, confidence, words around the name; ``{}`` is the name
FORMS = (
    ("tag", 100, 1.0, r"spdx license identifier (?:{})(?: only| or later)?"),
    ("grant", 90, 0.95, r"(?:licensed|released|distributed|available|published|provided)(?: to you)? under(?: the)?(?: terms of)?(?: the| a)? (?:{})(?: licen[sc]e)?"),
    ("terms", 80, 0.9, r"under(?: the)? terms of(?: the)? (?:{})(?: licen[sc]e)?"),
    ("under", 70, 0.85, r"under(?: the| an?)? (?:{}) licen[sc]e"),
    ("field", 60, 0.8, r"licen[sc]e (?:is |type |name )?(?:the )?(?:{})"),
    ("mention", 30, 0.5, r"(?:{}) licen[sc]e"),
)

#: forms that need none of the stems, so the gate asks for the whole of them, with any name
NO_STEM = ("grant", "terms")

_ANY_NAME = "|".join(name for _, name, _ in NAMES)
#: a text that does not match this matches no rule and no base phrase
GATE = "|".join([STEMS, *[form.replace("{}", _ANY_NAME).replace(" ", r"(?:[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+)")
                          for kind, _, _, form in FORMS if kind in NO_STEM]])

#: label, priority, confidence, pattern, keyword: texts that say a license without the forms above
OTHER = (
    ("mit", 95, 0.95, r"permission is hereby granted free of charge to any person obtaining a copy", "hereby"),
    ("apache-2", 95, 0.95, r"you may not use this file except in compliance with the license", "compliance"),
    ("bsd", 85, 0.9, r"redistribution and use in source and binary forms with or without modification are permitted", "redistribution"),
    ("gpl", 85, 0.9, r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "redistribute"),
    ("isc", 85, 0.9, r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "hereby"),
    ("zlib", 85, 0.9, r"this software is provided as is without any express or implied warranty", "warranty"),
    ("unlicense", 85, 0.9, r"this is free and unencumbered software released into the public domain", "unencumbered"),
    ("public-domain", 60, 0.7, r"(?:released|placed|dedicated)(?: in| into| to)? the public domain", "domain"),
    ("public-domain", 20, 0.4, r"public domain", "domain"),
    ("all-rights-reserved", 40, 0.6, r"all rights reserved", "reserved"),
    ("copyright", 10, 0.2, r"copyright (?:c )?(?:19|20)[0-9]{2}", "copyright"),
    ("cc-by", 75, 0.9, r"creativecommons org licenses by [1-4] [05]", "creativecommons"),
    ("cc-by-sa", 75, 0.9, r"creativecommons org licenses by sa [1-4] [05]", "creativecommons"),
    ("cc-by-nc", 75, 0.9, r"creativecommons org licenses by nc [1-4] [05]", "creativecommons"),
    ("cc-by-nd", 75, 0.9, r"creativecommons org licenses by nd [1-4] [05]", "creativecommons"),
    ("cc-by-nc-sa", 75, 0.9, r"creativecommons org licenses by nc sa [1-4] [05]", "creativecommons"),
    ("cc-by-nc-nd", 75, 0.9, r"creativecommons org licenses by nc nd [1-4] [05]", "creativecommons"),
    ("cc0", 75, 0.9, r"creativecommons org publicdomain zero 1 0", "creativecommons"),
)


@dataclass(frozen=True)
class Rule:
    """A signature: tried only if one of ``keys`` is a word of the text."""

    label: str
    priority: int
    confidence: float
    pattern: str
    keys: tuple[str, ...]


def rules() -> tuple[Rule, ...]:
    """All rules, highest priority first; of equal priority in the order of the tables."""
    made = [Rule(label, priority, sure, form.replace("{}", name), tuple(key.split("|")))
            for _, priority, sure, form in FORMS for label, name, key in NAMES]
    made += [Rule(label, priority, sure, pattern, (key,)) for label, priority, sure, pattern, key in OTHER]
    return tuple(sorted(made, key=lambda r: -r.priority))


class Scanner:
    """The compiled rules; made once per Python worker."""

    def __init__(self, table: tuple[Rule, ...]):
        import ahocorasick

        self.rules = table
        self.patterns = [re.compile(f"(?<= )(?:{r.pattern})(?= )") for r in table]
        by_key: dict[str, list[int]] = {}
        for i, r in enumerate(table):
            for k in r.keys:
                by_key.setdefault(k, []).append(i)
        self.keywords = ahocorasick.Automaton()
        for k, which in by_key.items():
            self.keywords.add_word(f" {k} ", which)
        self.keywords.make_automaton()
        self.base = [re.compile(f"(?<= ){phrase}(?= )") for phrase, _ in BASE]

    def scan(self, text: str) -> dict:
        words = _WORD.findall(text.translate(_LOWER))
        line = f" {' '.join(words)} "
        starts = np.cumsum([1] + [len(w) + 1 for w in words])
        word_at = lambda place: int(np.searchsorted(starts, place))  # noqa: E731  which word begins there
        base = [(label, word_at(m.start())) for (_, label), p in zip(BASE, self.base) for m in p.finditer(line)]
        tried = {i for _, which in self.keywords.iter(line) for i in which}
        found = []
        for i in sorted(tried):
            for m in self.patterns[i].finditer(line):
                found.append((word_at(m.start()), word_at(m.end() + 1), i))
        kept = suppress(found, [r.priority for r in self.rules])
        return {"base": base, "kept": [(a, b, self.rules[i]) for a, b, i in kept]}


def suppress(found: list[tuple[int, int, int]], priority: list[int]) -> list[tuple[int, int, int]]:
    """Of ``(first word, word after the last, rule)`` those in no interval of higher priority, nor in a
    longer one of equal priority; of equal intervals and priorities the first rule stays.

    Intervals are taken best first; the kept ones' furthest end at or before a start tells at once whether
    one of them holds an interval.
    """
    import bisect

    begins: list[int] = []
    reach: list[int] = []  # furthest end of all kept intervals up to this begin
    kept = []
    for a, b, i in sorted(found, key=lambda x: (-priority[x[2]], x[0] - x[1], x[0], x[2])):
        at = bisect.bisect_right(begins, a)
        if at and reach[at - 1] >= b:
            continue
        kept.append((a, b, i))
        if not (at and begins[at - 1] == a):
            begins.insert(at, a)
            reach.insert(at, reach[at - 1] if at else b)
            at += 1
        for j in range(at - 1, len(reach)):
            if reach[j] >= b:
                break
            reach[j] = b
    return sorted(kept)


@cache
def scanner() -> Scanner:
    return Scanner(rules())


def n_words(text: Column) -> Column:
    """Words of the whole text; upper-case letters count as their lower case."""
    return F.regexp_count(whole(text), F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")).cast("long")


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id, n_words, n_base, first_word, last_word, base_labels, labels, score`` and
    ``detections``, an array of ``struct<label, first, stop, priority, confidence>`` in word places.

    ``score`` is the surest kept detection's confidence, 0.9 at least where a base phrase stands, else 0.
    Null or empty text: no words, no labels.  Repeated rows give repeated results; an empty table gives no
    rows.  Other columns are not read.
    """
    t = F.col("t")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("t"))
    gated = rows.select("id", n_words(t).alias("n_words"), F.when(t.rlike(GATE), t).alias("t"))
    names = ["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections"]
    span = pa.struct([("label", pa.string()), ("first", pa.int64()), ("stop", pa.int64()), ("priority", pa.int32()), ("confidence", pa.float64())])
    kinds = [pa.int64()] * 5 + [pa.string(), pa.string(), pa.float64(), pa.list_(span)]

    def run(batches):
        use = scanner()
        for batch in batches:
            out = [[] for _ in names[2:]]
            for text in batch.column(2).to_pylist():
                found = use.scan(text) if text else {"base": [], "kept": []}
                places = [w for _, w in found["base"]]
                base_labels = {label for label, _ in found["base"]}
                labels = base_labels | {r.label for _, _, r in found["kept"]}
                score = max([0.9 * bool(places), *(r.confidence for _, _, r in found["kept"])])
                row = (len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base_labels)), ",".join(sorted(labels)),
                       float(score), [{"label": r.label, "first": a, "stop": b, "priority": r.priority, "confidence": r.confidence}
                                      for a, b, r in found["kept"]])
                for x, v in zip(out, row):
                    x.append(v)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(x, k) for x, k in zip(out, kinds[2:])]], names)

    return gated.mapInArrow(run, "id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
                            "labels string, score double, detections array<struct<label:string,first:bigint,stop:bigint,priority:int,confidence:double>>")
