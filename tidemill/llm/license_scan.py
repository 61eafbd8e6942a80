"""License scan: ordered signature rules behind a keyword prefilter.

Texts become lower-case words, each between spaces of its own (``" w0  w1 "``).  A rule is a
regular expression over that form with a keyword that every match holds.  The keywords found in
a text choose the rules that run on it.  Detections are intervals of words; one that lies
inside another detection's interval is suppressed, and of equal intervals the rule of higher
priority stays.  Only built-in functions run, row by row, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import ascii_lower

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class LicenseRule:
    label: str
    regex: str
    keyword: str
    priority: int
    score: float
    base: bool = False


def phrase(text: str) -> str:
    """Expression for consecutive words; ``a|b`` offers choices for one word, ``x?`` an optional word."""
    out = []
    for w in text.split():
        if w.endswith("?"):
            out.append(f"(?: {_choice(w[:-1])} )?")
        else:
            out.append(f" {_choice(w)} ")
    return "".join(out)


def _choice(w: str) -> str:
    return f"(?:{w})" if "|" in w else w


def _rule(label, text, keyword, priority, score, base=False):
    return LicenseRule(label, phrase(text), keyword, priority, score, base)


# The base phrases and labels.
BASE_RULES = [
    _rule("cc-by", "cc by", "cc", 10, 0.75, True),
    _rule("gpl", "general public license", "general", 10, 0.75, True),
    _rule("reserved", "all rights reserved", "reserved", 10, 0.5, True),
]

# Names of licenses: label, words of the name, keyword, versions in use.
FAMILIES = [
    ("agpl", "affero general public license|licence", "affero", ("1", "2", "3")),
    ("lgpl", "lesser general public license|licence", "lesser", ("2", "2 1", "3")),
    ("lgpl", "library general public license|licence", "library", ("2",)),
    ("gpl", "gnu general public license|licence", "gnu", ("1", "2", "3")),
    ("fdl", "gnu free documentation license|licence", "documentation", ("1 1", "1 2", "1 3")),
    ("apache", "apache software? license|licence", "apache", ("1 0", "1 1", "2 0", "2")),
    ("mpl", "mozilla public license|licence", "mozilla", ("1 0", "1 1", "2 0")),
    ("epl", "eclipse public license|licence", "eclipse", ("1 0", "2 0")),
    ("cddl", "common development and distribution license|licence", "development", ("1 0", "1 1")),
    ("cpl", "common public license|licence", "common", ("0 5", "1 0")),
    ("eupl", "european union public licence|license", "european", ("1 0", "1 1", "1 2")),
    ("ibm", "ibm public license|licence", "ibm", ("1 0",)),
    ("mit", "mit license|licence", "mit", ()),
    ("bsd", "bsd license|licence", "bsd", ()),
    ("bsd-2", "bsd 2 clause license|licence", "clause", ()),
    ("bsd-3", "bsd 3 clause license|licence", "clause", ()),
    ("bsd-4", "bsd 4 clause license|licence", "clause", ()),
    ("isc", "isc license|licence", "isc", ()),
    ("zlib", "zlib license|licence", "zlib", ()),
    ("boost", "boost software license|licence", "boost", ("1 0",)),
    ("artistic", "artistic license|licence", "artistic", ("1 0", "2 0")),
    ("afl", "academic free license|licence", "academic", ("2 0", "2 1", "3 0")),
    ("osl", "open software license|licence", "software", ("1 0", "2 0", "2 1", "3 0")),
    ("odbl", "open database license|licence", "database", ("1 0",)),
    ("odc-by", "open data commons attribution license|licence", "commons", ("1 0",)),
    ("ofl", "sil open font license|licence", "font", ("1 0", "1 1")),
    ("python", "python software foundation license|licence", "foundation", ("2",)),
    ("php", "php license|licence", "php", ("3 0", "3 01")),
    ("w3c", "w3c software notice and license|licence", "w3c", ()),
    ("ruby", "ruby license|licence", "ruby", ()),
    ("postgresql", "postgresql license|licence", "postgresql", ()),
    ("openssl", "openssl license|licence", "openssl", ()),
    ("upl", "universal permissive license|licence", "permissive", ("1 0",)),
    ("ms-pl", "microsoft public license|licence", "microsoft", ()),
    ("ms-rl", "microsoft reciprocal license|licence", "microsoft", ()),
    ("qpl", "q public license|licence", "q", ("1 0",)),
    ("sspl", "server side public license|licence", "server", ("1",)),
    ("busl", "business source license|licence", "business", ("1 1",)),
    ("wtfpl", "do what the fuck you want to public license|licence", "want", ("2",)),
    ("vim", "vim license|licence", "vim", ()),
    ("sleepycat", "sleepycat license|licence", "sleepycat", ()),
    ("cecill", "cecill free? license|licence", "cecill", ("1 0", "2 0", "2 1")),
    ("ncsa", "university of illinois ncsa open source license|licence", "ncsa", ()),
    ("unlicense", "the unlicense", "unlicense", ()),
    ("cc0", "cc0 1 0 universal", "cc0", ()),
]

# Words that mark a statement about a license, before its name.
GRANTS = ["licensed under the?", "released under the?", "distributed under the? terms? of? the?",
          "available under the?", "subject to the? terms? of? the?"]

# Other notices: label, words, keyword, priority, score.
NOTICES = [
    ("cc-by", "creative commons attribution", "creative", 40, 0.9),
    ("cc-by-sa", "creative commons attribution share alike", "creative", 50, 0.95),
    ("cc-by-sa", "creative commons attribution sharealike", "creative", 50, 0.95),
    ("cc-by-nc", "creative commons attribution non commercial", "creative", 50, 0.95),
    ("cc-by-nc", "creative commons attribution noncommercial", "creative", 50, 0.95),
    ("cc-by-nd", "creative commons attribution no derivatives", "creative", 50, 0.95),
    ("cc-by-nc-sa", "creative commons attribution noncommercial sharealike", "creative", 60, 0.95),
    ("cc-by-nc-nd", "creative commons attribution noncommercial noderivatives", "creative", 60, 0.95),
    ("cc-by-sa", "cc by sa", "cc", 30, 0.9),
    ("cc-by-nc", "cc by nc", "cc", 30, 0.9),
    ("cc-by-nd", "cc by nd", "cc", 30, 0.9),
    ("cc-by-nc-sa", "cc by nc sa", "cc", 35, 0.9),
    ("cc-by-nc-nd", "cc by nc nd", "cc", 35, 0.9),
    ("cc-by", "cc by 1 0|2 0|2 5|3 0|4 0", "cc", 25, 0.9),
    ("public-domain", "public domain", "domain", 20, 0.6),
    ("public-domain", "dedicated to the public domain", "domain", 30, 0.9),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", "hereby", 60, 1.0),
    ("isc", "permission to use copy modify and or? distribute this software for any purpose", "permission", 60, 1.0),
    ("bsd", "redistribution and use in source and binary forms with or without modification", "redistribution", 60, 1.0),
    ("zlib", "this software is provided as is without any express or implied warranty", "warranty", 60, 0.95),
    ("gpl", "free software foundation either version", "foundation", 40, 0.9),
    ("proprietary", "unauthorized copying of this file", "unauthorized", 40, 0.9),
    ("proprietary", "confidential and proprietary", "confidential", 40, 0.9),
    ("no-commercial", "non commercial use only", "commercial", 30, 0.8),
    ("copyright", "copyright c", "copyright", 5, 0.3),
    ("copyright", "copyright notice", "copyright", 5, 0.2),
    ("reserved", "some rights reserved", "reserved", 20, 0.5),
    ("reserved", "no rights reserved", "reserved", 20, 0.5),
    ("spdx", "spdx license identifier", "spdx", 15, 0.4),
]

# Identifiers written after "spdx license identifier".
SPDX_IDS = ["mit", "apache 2 0", "gpl 2 0", "gpl 3 0", "lgpl 2 1", "lgpl 3 0", "agpl 3 0", "mpl 2 0", "epl 2 0",
            "bsd 2 clause", "bsd 3 clause", "isc", "zlib", "cc0 1 0", "cc by 4 0", "cc by sa 4 0", "unlicense",
            "bsl 1 0", "artistic 2 0", "ofl 1 1"]


def signature_rules() -> list[LicenseRule]:
    """All rules: the base phrases, the notices, and the names with versions and grants."""
    rules = list(BASE_RULES) + [_rule(*n) for n in NOTICES]
    for label, name, key, versions in FAMILIES:
        rules.append(_rule(label, name, key, 30, 0.8))
        for v in versions:
            rules.append(_rule(f"{label}-{v.replace(' ', '.')}", f"{name} version|v? {v}", key, 50, 0.95))
        for g in GRANTS:
            rules.append(_rule(label, f"{g} {name}", key, 40, 0.9))
    rules += [_rule(i.replace(" ", "-"), f"spdx license identifier {i}", "spdx", 70, 1.0) for i in SPDX_IDS]
    return rules


def _rule_literals(rules: Sequence[LicenseRule]) -> Column:
    return F.array(*[F.struct(F.lit(r.label).alias("label"), F.lit(r.regex).alias("regex"),
                              F.lit(r.keyword).alias("keyword"), F.lit(r.priority).alias("priority"),
                              F.lit(float(r.score)).alias("score"), F.lit(r.base).alias("base")) for r in rules])


def _n_words(c: Column) -> Column:
    """Words in a piece of the normal form: every word stands between two spaces."""
    return F.floor((F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))) / 2).cast("long")


def _detections(norm: Column, r: Column) -> Column:
    """Intervals [start, end) of words where rule ``r`` matches, from the pieces between matches."""
    gaps = F.transform(F.split(norm, r["regex"], -1), _n_words)
    lens = F.transform(F.regexp_extract_all(norm, r["regex"], F.lit(0)), _n_words)
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<s:bigint,e:bigint>>").alias("hits"))
    walked = F.aggregate(
        F.arrays_zip(F.slice(gaps, 1, F.size(lens)).alias("gap"), lens.alias("len")), zero,
        lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + x["len"]).alias("at"),
            F.concat(acc["hits"], F.array(F.struct((acc["at"] + x["gap"]).alias("s"),
                                                   (acc["at"] + x["gap"] + x["len"]).alias("e")))).alias("hits")))
    return F.transform(walked["hits"], lambda h: F.struct(
        h["s"].alias("s"), (-h["e"]).alias("neg_e"), (-r["priority"]).alias("neg_priority"), r["label"].alias("label"),
        r["score"].alias("score"), r["base"].alias("base")))


def scan_licenses(df: DataFrame, rules: Sequence[LicenseRule] | None = None, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_words, detections (array of s, neg_e, neg_priority, label, score, base),
    n_base, first_word, last_word, base_labels, labels, score.

    ``detections`` holds every match in order of place; the labels are those of the base rules
    and of the detections that no other suppresses, distinct and sorted.  ``score`` is the
    greatest score among them, 0 without any.  A null or empty text has no words and no
    detections; first_word and last_word are null without a base match, the labels empty.
    Null or repeated ids keep their rows, other columns are ignored.
    """
    rules = list(signature_rules() if rules is None else rules)
    keywords = sorted({r.keyword for r in rules})
    t = df.select(F.col(id_col).alias("id_"), ascii_lower(F.coalesce(F.col(text_col), F.lit(""))).alias("text_"))
    t = t.select("id_", F.filter(F.split("text_", SEPARATORS), lambda w: w != "").alias("words_"))
    t = t.select("id_", F.size("words_").cast("long").alias("n_words"),
                 F.array_intersect("words_", F.array(*[F.lit(k) for k in keywords])).alias("keys_"),
                 F.concat(F.lit(" "), F.array_join("words_", "  "), F.lit(" ")).alias("norm_"))
    found = F.flatten(F.transform(
        F.filter(_rule_literals(rules), lambda r: F.array_contains(F.col("keys_"), r["keyword"])),
        lambda r: F.when(F.rlike(F.col("norm_"), r["regex"]), _detections(F.col("norm_"), r))
        .otherwise(F.expr(f"cast(array() as {_HIT})"))))
    t = t.select("id_", "n_words", F.when(F.size("keys_") > 0, F.array_sort(found))
                 .otherwise(F.expr(f"cast(array() as {_HIT})")).alias("detections"))
    # one pass in order of place: what ends inside the furthest end so far lies inside another interval
    zero = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0.0).alias("score"),
                    F.array().cast("array<string>").alias("labels"))

    def step(acc, d):
        kept = d["base"] | (-d["neg_e"] > acc["end"])
        return F.struct(F.greatest(acc["end"], -d["neg_e"]).alias("end"),
                        F.when(kept, F.greatest(acc["score"], d["score"])).otherwise(acc["score"]).alias("score"),
                        F.when(kept & ~F.array_contains(acc["labels"], d["label"]),
                               F.concat(acc["labels"], F.array(d["label"]))).otherwise(acc["labels"]).alias("labels"))

    t = t.withColumn("sum_", F.aggregate("detections", zero, step)).withColumn("base_", F.filter("detections", lambda d: d["base"]))
    return t.select(
        F.col("id_").alias(id_col), "n_words", "detections",
        F.size("base_").cast("long").alias("n_base"),
        F.array_min(F.transform("base_", lambda d: d["s"])).alias("first_word"),
        F.array_max(F.transform("base_", lambda d: d["s"])).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("base_", lambda d: d["label"]))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.col("sum_.labels")), ",").alias("labels"),
        F.col("sum_.score").alias("score"))


_HIT = "array<struct<s:bigint,neg_e:bigint,neg_priority:int,label:string,score:double,base:boolean>>"
