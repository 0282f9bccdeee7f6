"""License scans: ordered signature rules behind a keyword prefilter, in DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakegate.llm.common import text_column

# Fixed values.
WORD_CLASS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"  # ASCII letters of both cases, digits, all of non-ASCII
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BEFORE, AFTER = 14, 16  # words of context around a keyword
LONGEST = BEFORE + AFTER
NEIGHBOURS = 256  # detections that can start within LONGEST words before another one, see _rules()

#: label, name before "license", rest behind it; or None and the whole name where the licence is named without the word.
FAMILIES = [
    ("mit", "mit", ""),
    ("mit", "expat", ""),
    ("mit-0", "mit no attribution", ""),
    ("apache-1.1", "apache(?: software)?", "(?: version| v)? v?1 1"),
    ("apache-2", "apache(?: software)?", "(?: version| v)? v?2(?: 0)?"),
    ("apache", "apache(?: software)?", ""),
    ("bsd-2", "(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)", ""),
    ("bsd-3", "(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)", ""),
    ("bsd-4", "(?:bsd 4 clause|4 clause bsd|original bsd)", ""),
    ("bsd", "bsd", ""),
    ("gpl-2", "(?:gnu )?general public", "(?: version| v)? v?2(?: 0)?"),
    ("gpl-3", "(?:gnu )?general public", "(?: version| v)? v?3(?: 0)?"),
    ("gpl", "(?:gnu )?general public", ""),
    ("lgpl-2.1", "(?:gnu )?lesser general public", "(?: version| v)? v?2 1"),
    ("lgpl-3", "(?:gnu )?lesser general public", "(?: version| v)? v?3(?: 0)?"),
    ("lgpl", "(?:gnu )?(?:lesser|library) general public", ""),
    ("agpl-3", "(?:gnu )?affero general public", "(?: version| v)? v?3(?: 0)?"),
    ("agpl", "(?:gnu )?affero general public", ""),
    ("fdl", "(?:gnu )?free documentation", ""),
    ("mpl-1.1", "mozilla public", "(?: version| v)? v?1 1"),
    ("mpl-2", "mozilla public", "(?: version| v)? v?2(?: 0)?"),
    ("mpl", "mozilla public", ""),
    ("epl-1", "eclipse public", "(?: version| v)? v?1(?: 0)?"),
    ("epl-2", "eclipse public", "(?: version| v)? v?2(?: 0)?"),
    ("eupl", "european union public", ""),
    ("cddl", "common development and distribution", ""),
    ("isc", "isc", ""),
    ("zlib", "zlib", ""),
    ("boost", "boost software", ""),
    ("artistic-2", "artistic", "(?: version| v)? v?2(?: 0)?"),
    ("artistic", "artistic", ""),
    ("ofl", "(?:sil )?open font", ""),
    ("odbl", "open database", ""),
    ("python", "python software foundation", ""),
    ("cc-by", "creative commons attribution", ""),
    ("cc-by-sa", "creative commons attribution share ?alike", ""),
    ("cc-by-nc", "creative commons attribution non ?commercial", ""),
    ("cc-by-nd", "creative commons attribution no ?deriv(?:ative|ativework|ative work)s?", ""),
    ("cc-by-nc-sa", "creative commons attribution non ?commercial share ?alike", ""),
    ("cc-by-nc-nd", "creative commons attribution non ?commercial no ?deriv(?:ative|ativework|ative work)s?", ""),
]

#: label, keyword, pattern from the keyword on: licences named by a short form.
SHORT = [
    ("cc-by", "cc", "cc by(?: [1-4] [05])?"),
    ("cc-by-sa", "cc", "cc by sa(?: [1-4] [05])?"),
    ("cc-by-nc", "cc", "cc by nc(?: [1-4] [05])?"),
    ("cc-by-nd", "cc", "cc by nd(?: [1-4] [05])?"),
    ("cc-by-nc-sa", "cc", "cc by nc sa(?: [1-4] [05])?"),
    ("cc-by-nc-nd", "cc", "cc by nc nd(?: [1-4] [05])?"),
    ("cc0", "cc0", "cc0(?: 1 0)?(?: universal)?"),
    ("gpl-2", "gpl", "gpl(?: version| v)? v?2(?: 0)?"),
    ("gpl-3", "gpl", "gpl(?: version| v)? v?3(?: 0)?"),
    ("gpl-2", "gplv2", "gplv2(?: 0)?"),
    ("gpl-3", "gplv3", "gplv3(?: 0)?"),
    ("lgpl-2.1", "lgpl", "lgpl(?: version| v)? v?2 1"),
    ("lgpl-3", "lgpl", "lgpl(?: version| v)? v?3(?: 0)?"),
    ("lgpl-3", "lgplv3", "lgplv3(?: 0)?"),
    ("agpl-3", "agpl", "agpl(?: version| v)? v?3(?: 0)?"),
    ("agpl-3", "agplv3", "agplv3(?: 0)?"),
    ("mpl-2", "mpl", "mpl(?: version| v)? v?2(?: 0)?"),
    ("unlicense", "unlicense", "unlicense"),
    ("wtfpl", "wtfpl", "wtfpl"),
]

#: label, words before, keyword, pattern from the keyword on, priority, weight: sentences of their own.
SENTENCES = [
    ("proprietary", "all ", "rights", "rights reserved", 1, 0.4),
    ("proprietary", "", "proprietary", "proprietary and confidential", 2, 0.6),
    ("public-domain", "(?:released|dedicated|placed) (?:in|in ?to) the public ", "domain", "domain", 3, 0.9),
    ("public-domain", "in the public ", "domain", "domain", 1, 0.5),
    ("mit", "", "permission", "permission is hereby granted free of charge to any person obtaining a copy", 4, 1.0),
    ("isc", "", "permission", "permission to use copy modify and or distribute this software for any purpose", 4, 1.0),
    ("bsd", "", "redistribution", "redistribution and use in source and binary forms with or without modification", 4, 1.0),
    ("copyright", "", "copyright", "copyright (?:c )?(?:19|20)[0-9]{2}", 1, 0.2),
]

#: label, words before, keyword, words from the keyword on: phrases whose every place counts as a base detection.
BASE = [
    ("mit", "under the mit ", "license", "license"),
    ("apache-2", "apache ", "license", "license version 2"),
    ("cc-by-nc", "", "cc", "cc by nc"),
]

#: Ways to grant, each a rule of its own for every family.
GRANTS = ["released", "distributed", "available", "provided", "published", "offered", "covered", "licensed", "governed"]


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: str
    pattern: str
    priority: int
    weight: float
    base: bool = False


def _pattern(before: str, after: str) -> str:
    """Context, with the keyword behind the mark ``@``: group 1 is what stands before it, group 2 the rest."""
    return rf"(?:^| )({before})@({after})(?= |$)"


def _rules() -> list[Rule]:
    """Every signature: the families in all ways of naming and granting them, the short forms, sentences, base phrases.

    The rules of one family differ in what stands around its name, so at one keyword at most eight of them match: LONGEST
    words hold at most LONGEST keywords, which bounds the detections near a place by NEIGHBOURS.
    """
    out = [Rule(label, k, _pattern(b, a), 0, 0.8, base=True) for label, b, k, a in BASE]
    article = "(?:the )?(?:terms of (?:the )?|conditions of (?:the )?)?"
    for label, name, rest in FAMILIES:
        for keyword in ("license", "licence"):
            out.append(Rule(label, keyword, _pattern(f"{name} ", keyword + rest), 1, 0.5))
            verbs = "|".join(GRANTS)
            out.append(Rule(label, keyword, _pattern(f"(?:{verbs}) under {article}{name} ", keyword + rest), 3, 0.9))
            out.append(Rule(label, keyword, _pattern("", f"{keyword} (?:is |type )?(?:the )?{name}{rest}"), 2, 0.7))
        out.append(Rule(label, "licensed", _pattern(f"{name} ", "licensed"), 2, 0.6))
        out.append(Rule(label, "spdx", _pattern("", f"spdx licen[cs]e identifier {name}{rest}"), 4, 1.0))
    for label, keyword, pattern in SHORT:
        out.append(Rule(label, keyword, _pattern("", pattern), 1, 0.5))
        for verb in GRANTS:
            out.append(Rule(label, keyword, _pattern(f"{verb} under {article}", pattern), 3, 0.9))
        out.append(Rule(label, keyword, _pattern("spdx licen[cs]e identifier ", pattern), 4, 1.0))
    out += [Rule(label, k, _pattern(b, a), p, w) for label, b, k, a, p, w in SENTENCES]
    return out


RULES = _rules()
KEYWORDS = sorted({r.keyword for r in RULES})


def _rule_map() -> Column:
    """Rules by keyword; order is a rule's place in the list."""
    parts: list[Column] = []
    for keyword in KEYWORDS:
        rules = [
            F.struct(
                F.lit(order).alias("order"),
                F.lit(r.label).alias("label"),
                F.lit(r.pattern).alias("pattern"),
                F.lit(r.priority).alias("priority"),
                F.lit(r.weight).alias("weight"),
                F.lit(r.base).alias("base"),
            )
            for order, r in enumerate(RULES)
            if r.keyword == keyword
        ]
        parts += [F.lit(keyword), F.array(*rules)]
    return F.create_map(*parts)


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _detections(words: Column) -> Column:
    """All matches as structs ordered by start, then longest, then priority, then place of the rule."""
    at = F.filter(
        F.transform(words, lambda w, i: F.when(w.isin(*KEYWORDS), i)),
        lambda i: i.isNotNull(),
    )
    rules = _rule_map()

    def context(i: Column) -> Column:
        before = F.array_join(F.slice(words, F.greatest(i - BEFORE, F.lit(0)) + 1, F.least(i, F.lit(BEFORE))), " ")
        after = F.array_join(F.slice(words, i + 1, F.lit(AFTER)), " ")
        return F.concat(before, F.when(i > 0, F.lit(" ")).otherwise(F.lit("")), F.lit("@"), after)

    def group(hit: Column, r: Column, number: int) -> Column:
        return F.call_function("regexp_extract", hit["context"], r["pattern"], F.lit(number))

    def matches(hit: Column) -> Column:
        fitting = F.filter(hit["rules"], lambda r: F.rlike(hit["context"], r["pattern"]))
        return F.transform(
            fitting,
            lambda r: F.struct(
                (hit["i"] - _spaces(group(hit, r, 1))).alias("start"),
                (-hit["i"] - _spaces(group(hit, r, 2)) - 1).alias("minus_end"),
                (-r["priority"]).alias("minus_priority"),
                r["order"].alias("order"),
                r["label"].alias("label"),
                r["weight"].alias("weight"),
                r["base"].alias("base"),
            ),
        )

    hits = F.transform(
        at, lambda i: F.struct(i.alias("i"), context(i).alias("context"), F.element_at(rules, F.get(words, i)).alias("rules"))
    )
    return F.sort_array(F.flatten(F.transform(hits, matches)))


def _unsuppressed(found: Column) -> Column:
    """Without the detections inside an earlier one in order that has no lower priority; base ones always stay."""

    def outside(d: Column, i: Column) -> Column:
        near = F.slice(found, F.greatest(i - NEIGHBOURS, F.lit(0)) + 1, F.least(i, F.lit(NEIGHBOURS)))
        covered = F.exists(
            near,
            lambda e: ~e["base"]
            & (e["minus_end"] <= d["minus_end"])
            & (e["minus_priority"] <= d["minus_priority"]),
        )
        return d["base"] | ~covered

    return F.filter(found, outside)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: n_words and the detections (start, end in words, label, weight, base).

    Words are runs of ``WORD_CLASS`` with A-Z in lower case. Texts without a keyword are done after one regular
    expression. In the others, each keyword is looked at with the words around it, and only by its own rules. Of what
    they find, a detection inside another of the same or higher priority goes (the longer, then the earlier rule wins);
    base phrases are counted at every place and never go. All of it is one projection: no shuffle, no Python.

    Null ids pass through; null and empty texts have no words and no detections; repeated rows give repeated rows; an
    empty table gives an empty one; other columns are not read.
    """
    keyword = rf"(?i)(?<!{WORD_CLASS})(?:{'|'.join(KEYWORDS)})(?!{WORD_CLASS})"
    text = text_column(text_col)
    low = docs.select(
        F.col(id_col).alias("id"),
        F.regexp_count(text, F.lit(f"{WORD_CLASS}+")).cast("long").alias("n_words"),
        F.when(
            text.rlike(keyword),
            F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(f"{WORD_CLASS}+"), F.lit(0)),
        ).alias("words"),
    )
    # Bound to a lambda variable, an array is made once however often the lambda uses it.
    found = F.get(F.transform(F.array("words"), _detections), F.lit(0))
    kept = F.get(F.transform(F.array(found), _unsuppressed), F.lit(0))
    spans = F.transform(
        F.coalesce(kept, F.array().cast(_SPAN)),
        lambda d: F.struct(
            d["start"].cast("long").alias("start"),
            (-d["minus_end"]).cast("long").alias("end"),
            d["label"].alias("label"),
            d["weight"].alias("weight"),
            d["base"].alias("base"),
        ),
    )
    return low.select(F.col("id").alias(id_col), "n_words", spans.alias("detections"))


_SPAN = (
    "array<struct<start:int,minus_end:int,minus_priority:int,order:int,label:string,weight:double,base:boolean>>"
)


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The contract's columns of :func:`scan`'s result."""
    base = F.filter("detections", lambda d: d["base"])
    starts = F.transform(base, lambda d: d["start"])
    names = lambda spans: F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda d: d["label"]))), ",")
    weights = F.transform("detections", lambda d: d["weight"])
    return found.select(
        id_col,
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        names(base).alias("base_labels"),
        names(F.col("detections")).alias("labels"),
        F.coalesce(F.array_max(weights), F.lit(0.0)).alias("score"),
    )
