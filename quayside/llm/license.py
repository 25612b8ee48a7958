"""License scan by ordered signature rules, in Spark expressions only.

A text becomes its words in lower case with one space around each. A rule is a regular expression over that
string with a label, a priority (1 is the strongest), a weight and a keyword. Keywords are looked up first,
and only the rules of those found run; every form of a rule holds one of its keywords. Overlaps are resolved by containment: a detection goes if another one
of the same or a stronger priority covers it; of equal intervals the earlier rule stays. Base phrases are
rules that always stay.

Everything happens within the row: no shuffle, and with m detections O(m log m) work. Positions and the
furthest ends so far are running sums and maxima, taken in doubling steps.

Defined cases: a null or empty text has no words and no detections; equal rows give equal rows; other columns are untouched.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import let, lower_ascii, text_or_empty

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: The base phrases and their labels.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

_V2, _V3, _ANY = r"(?: version| v)? ?2(?: 0)?", r"(?: version| v)? ?3(?: 0)?", r"(?:(?: version| v)? ?\d(?: \d)?)?"
#: Licenses: label, expression of the name, expression of the short identifier, keyword.
FAMILIES = (
    ("apache-2.0", rf"apache(?: software)?(?: licen[sc]e)?{_V2}", r"apache 2 0", "apache"),
    ("apache-1.1", r"apache(?: software)?(?: licen[sc]e)?(?: version| v)? 1 [01]", r"apache 1 [01]", "apache"),
    ("mit", r"(?:mit|expat) licen[sc]e", r"mit(?: 0)?", "mit|expat"),
    ("bsd-2-clause", r"(?:simplified bsd|bsd 2 clause|2 clause bsd|freebsd)(?: licen[sc]e)?", r"bsd 2 clause", "bsd"),
    ("bsd-3-clause", r"(?:new bsd|modified bsd|bsd 3 clause|3 clause bsd)(?: licen[sc]e)?", r"bsd 3 clause", "bsd"),
    ("bsd-4-clause", r"(?:original bsd|bsd 4 clause|4 clause bsd)(?: licen[sc]e)?", r"bsd 4 clause", "bsd"),
    ("bsd", r"bsd(?: style)? licen[sc]e", r"0bsd", "bsd"),
    ("gpl-2.0", rf"(?:gnu )?(?:general public licen[sc]e|gpl){_V2}", r"gpl 2 0(?: only| or later)?", "gpl|general public"),
    ("gpl-3.0", rf"(?:gnu )?(?:general public licen[sc]e|gpl){_V3}", r"gpl 3 0(?: only| or later)?", "gpl|general public"),
    ("lgpl-2.1", r"(?:gnu )?(?:lesser|library) general public licen[sc]e(?: version| v)? ?2(?: [01])?", r"lgpl 2 [01](?: only| or later)?", "lgpl|general public"),
    ("lgpl-3.0", rf"(?:gnu )?lesser general public licen[sc]e{_V3}", r"lgpl 3 0(?: only| or later)?", "lgpl|general public"),
    ("lgpl", rf"(?:gnu )?(?:lesser|library) general public licen[sc]e{_ANY}|(?:gnu )?lgpl{_ANY}", r"lgpl", "lgpl|general public"),
    ("agpl-3.0", rf"(?:gnu )?affero general public licen[sc]e{_ANY}|(?:gnu )?agpl{_ANY}", r"agpl 3 0(?: only| or later)?", "agpl|affero"),
    ("gpl", rf"(?:gnu )?(?:general public licen[sc]e|gpl){_ANY}", r"gpl", "gpl|general public"),
    ("gfdl", rf"(?:gnu )?free documentation licen[sc]e{_ANY}", r"gfdl 1 [123]", "gfdl|free documentation"),
    ("mpl-2.0", rf"mozilla public licen[sc]e{_V2}", r"mpl 2 0", "mozilla|mpl"),
    ("mpl-1.1", r"mozilla public licen[sc]e(?: version| v)? ?1 [01]", r"mpl 1 [01]", "mozilla|mpl"),
    ("epl", rf"eclipse public licen[sc]e{_ANY}", r"epl [12] 0", "eclipse|epl"),
    ("cddl", rf"common development and distribution licen[sc]e{_ANY}", r"cddl 1 [01]", "cddl|common development"),
    ("cpl", rf"common public licen[sc]e{_ANY}", r"cpl 1 0", "cpl|common public"),
    ("eupl", rf"european union public licen[sc]e{_ANY}", r"eupl 1 [012]", "eupl|european union public"),
    ("artistic", rf"(?:clarified |perl )?artistic licen[sc]e{_ANY}", r"artistic [12] 0", "artistic"),
    ("isc", r"(?:isc|internet systems consortium) licen[sc]e", r"isc", "isc|internet systems"),
    ("zlib", r"zlib(?: libpng)? licen[sc]e", r"zlib", "zlib"),
    ("boost", rf"boost software licen[sc]e{_ANY}", r"bsl 1 0", "boost|bsl"),
    ("busl", rf"business source licen[sc]e{_ANY}", r"busl 1 1", "business source|busl"),
    ("sspl", rf"server side public licen[sc]e{_ANY}", r"sspl 1 0", "sspl|server side"),
    ("elastic", rf"elastic licen[sc]e{_ANY}", r"elastic 2 0", "elastic"),
    ("python", rf"python software foundation licen[sc]e{_ANY}|psf licen[sc]e", r"psf 2 0", "python|psf"),
    ("php", rf"php licen[sc]e{_ANY}", r"php 3 0[01]?", "php"),
    ("ruby", r"ruby licen[sc]e", r"ruby", "ruby"),
    ("postgresql", r"postgresql licen[sc]e", r"postgresql", "postgresql"),
    ("openssl", r"openssl licen[sc]e", r"openssl", "openssl"),
    ("ms-pl", r"microsoft public licen[sc]e", r"ms pl", "microsoft|ms pl"),
    ("ms-rl", r"microsoft reciprocal licen[sc]e", r"ms rl", "microsoft|ms rl"),
    ("unlicense", r"(?:the )?unlicen[sc]e", r"unlicense", "unlicen"),
    ("wtfpl", r"do what the fuck you want to public licen[sc]e|wtfpl", r"wtfpl", "wtfpl|do what the"),
    ("odbl", rf"open database licen[sc]e{_ANY}", r"odbl 1 0", "odbl|open database"),
    ("odc-by", rf"open data commons attribution licen[sc]e{_ANY}", r"odc by 1 0", "odc|open data commons"),
    ("pddl", rf"public domain dedication and licen[sc]e{_ANY}", r"pddl 1 0", "pddl|public domain"),
    ("ofl", rf"(?:sil )?open font licen[sc]e{_ANY}", r"ofl 1 [01]", "ofl|open font"),
    ("ogl", rf"open government licen[sc]e{_ANY}", r"ogl uk [123] 0", "ogl|open government"),
    ("cc0", r"cc0(?: 1 0)?|creative commons (?:cc0|zero)(?: 1 0)?", r"cc0 1 0", "cc0|creative commons"),
    ("cc-by-nc-nd", rf"(?:cc by|creative commons attribution) (?:nc|noncommercial|non commercial) (?:nd|noderivatives|no derivatives|noderivs){_ANY}", r"cc by nc nd \d 0", "cc by|creative commons"),
    ("cc-by-nc-sa", rf"(?:cc by|creative commons attribution) (?:nc|noncommercial|non commercial) (?:sa|sharealike|share alike){_ANY}", r"cc by nc sa \d 0", "cc by|creative commons"),
    ("cc-by-nc", rf"(?:cc by|creative commons attribution) (?:nc|noncommercial|non commercial){_ANY}", r"cc by nc \d 0", "cc by|creative commons"),
    ("cc-by-nd", rf"(?:cc by|creative commons attribution) (?:nd|noderivatives|no derivatives|noderivs){_ANY}", r"cc by nd \d 0", "cc by|creative commons"),
    ("cc-by-sa", rf"(?:cc by|creative commons attribution) (?:sa|sharealike|share alike){_ANY}", r"cc by sa \d 0", "cc by|creative commons"),
    ("cc-by", rf"(?:cc by|creative commons attribution){_ANY}", r"cc by \d 0", "cc by|creative commons"),
    ("creative-commons", r"creative commons(?: licen[sc]e)?", r"cc pddc", "creative commons|cc pddc"),
)
#: How a license is named: priority, weight, the expression around the name (N) or the identifier (I).
FORMS = (
    (1, 1.0, "spdx licen[sc]e identifier I"),
    (1, 1.0, "(?:licen[sc]ed|released|distributed|published|provided|available|offered) under (?:the )?(?:terms (?:and conditions )?of )?(?:the )?(?:a )?(?:N)(?: or (?:any )?later(?: version)?)?"),
    (2, 0.9, "(?:subject to|governed by|covered by|according to|pursuant to) (?:the )?(?:terms (?:and conditions )?of )?(?:the )?(?:N)"),
    (2, 0.9, "(?:licen[sc]e|licencia|lizenz|licence) (?:is )?(?:N)"),
    (3, 0.7, "(?:N)(?: or (?:any )?later(?: version)?)?"),
)
#: Texts and notices that name no license: label, priority, weight, expression, keyword.
NOTICES = (
    ("mit", 1, 0.9, "permission is hereby granted free of charge to any person obtaining a copy", "permission is hereby"),
    ("isc", 1, 0.9, "permission to use copy modify and or distribute this software for any purpose", "permission to use"),
    ("bsd", 1, 0.9, "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use"),
    ("gpl", 1, 0.9, "this program is free software you can redistribute it and or modify it", "free software"),
    ("unlicense", 1, 0.9, "this is free and unencumbered software released into the public domain", "unencumbered"),
    ("zlib", 1, 0.9, "this software is provided as is without any express or implied warranty", "provided as is"),
    ("no-warranty", 4, 0.3, "(?:without warranty of any kind|provided as is)", "warranty of any|provided as is"),
    ("public-domain", 3, 0.6, "(?:released into|dedicated to|placed in|in) the public domain", "public domain"),
    ("proprietary", 2, 0.8, "(?:proprietary and confidential|confidential and proprietary)", "proprietary"),
    ("proprietary", 2, 0.8, "(?:unauthori[sz]ed|any) (?:copying|reproduction|distribution) .{0,40}?(?:is )?(?:strictly )?prohibited", "prohibited"),
    ("no-ai-training", 2, 0.8, "(?:may not|must not|not) be used (?:for|to) (?:ai |machine learning |model )?(?:training|train)", "be used"),
    ("reserved", 3, 0.6, "(?:all|some|no) rights reserved", "rights reserved"),
    ("copyright", 4, 0.4, r"copyright (?:c |© )?(?:\d{4}(?: \d{4})*)", "copyright"),
    ("copyright", 4, 0.3, "(?:protected by|under) copyright", "copyright"),
    ("terms", 4, 0.2, "terms (?:of (?:use|service)|and conditions) apply", "terms"),
)
LEVELS = 4


def rules() -> list[dict]:
    """All rules in order; base phrases have priority 1 and are marked."""
    listed = [("base", label, 1, 1.0, phrase, phrase) for phrase, label in BASE]
    for label, name, short, keyword in FAMILIES:
        for priority, weight, form in FORMS:
            listed.append(("", label, priority, weight, form.replace("I", f"(?:{short})").replace("N", name), keyword))
    listed += [("", label, priority, weight, expression, keyword) for label, priority, weight, expression, keyword in NOTICES]
    return [
        {"rule": i, "base": bool(base), "label": label, "priority": p, "weight": w, "regex": f" (?:{x})(?= )", "keywords": k.split("|")}
        for i, (base, label, p, w, x, k) in enumerate(listed)
    ]


def _table(listed: list[dict]) -> Column:
    kind = "array<struct<rule:int,base:boolean,label:string,priority:int,weight:double,regex:string,keywords:array<string>>>"
    return F.from_json(F.lit(json.dumps(listed)), kind)


def _running(values: Column, combine: Callable[[Column, Column], Column], neutral: int) -> Column:
    """Inclusive running sum or maximum of an array, in log2(length) passes over it."""

    def step(acc: Column, k: Column) -> Column:
        shift = F.call_function("shiftleft", F.lit(1), k)
        moved = F.slice(F.concat(F.array_repeat(F.lit(neutral), shift), acc), F.lit(1), F.size(acc))
        return F.zip_with(acc, moved, combine)

    passes = F.sequence(F.lit(0), F.ceil(F.log2(F.size(values).cast("double"))).cast("int") - 1)
    return F.when(F.size(values) > 1, F.aggregate(passes, values, step)).otherwise(values)


def normalized(text: Column) -> Column:
    """Words in lower case with one space before, between and after them."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(lower_ascii(text), NOT_WORD, " ")), F.lit(" "))


def _detections(norm: Column, listed: list[dict]) -> Column:
    keywords = F.from_json(F.lit(json.dumps(sorted({k for r in listed for k in r["keywords"]}))), "array<string>")

    def places(rule: Column) -> Column:
        pieces, matches = F.split(norm, rule["regex"], -1), rule["matches"]
        lengths = F.zip_with(F.slice(pieces, F.lit(1), F.size(matches)), matches, lambda p, m: F.length(p) + F.length(m))
        return F.zip_with(
            _running(lengths, lambda a, b: a + b, 0),
            matches,
            lambda end, m: F.struct(
                (end - F.length(m)).alias("start"),
                (-end).alias("minus_end"),
                rule["priority"].alias("priority"),
                rule["rule"].alias("rule"),
                rule["label"].alias("label"),
                rule["base"].alias("base"),
                rule["weight"].alias("weight"),
            ),
        )

    def matched(r: Column) -> Column:
        fields = ("priority", "rule", "label", "base", "weight", "regex")
        return F.struct(*(r[f].alias(f) for f in fields), F.regexp_extract_all(norm, r["regex"], F.lit(0)).alias("matches"))

    hits = F.filter(keywords, lambda k: norm.contains(k))
    ran = let(hits, lambda h: F.transform(F.filter(_table(listed), lambda r: F.arrays_overlap(r["keywords"], h)), matched))
    found = F.filter(ran, lambda r: F.size(r["matches"]) > 0)
    return F.array_sort(F.flatten(F.transform(found, places)))


def _kept(found: Column) -> Column:
    """Detections that no earlier one of the same or a stronger priority covers, and all base ones.

    They are sorted by start, longest first, so whatever covers one stands before it.
    """

    def reach(level: Column) -> Column:
        ends = F.transform(found, lambda d: F.when(d["priority"] <= level, -d["minus_end"]).otherwise(F.lit(-1)))
        return _running(ends, lambda a, b: F.greatest(a, b), -1)

    def free(reaches: Column) -> Column:
        return F.filter(
            found, lambda d, i: d["base"] | (i == 0) | (F.get(F.get(reaches, d["priority"] - 1), i - 1) < -d["minus_end"])
        )

    return let(F.transform(F.sequence(F.lit(1), F.lit(LEVELS)), reach), free)


def scan(docs: DataFrame) -> DataFrame:
    """Adds ``license_scan``: norm, n_words and the kept detections as start and end in norm, rule, label, base, weight.

    The leading space belongs to a detection, so norm[start:end] is the matched text with a space before it.
    """
    listed = rules()
    out = docs.withColumn("license_scan", F.struct(normalized(text_or_empty()).alias("norm")))
    norm = F.col("license_scan.norm")
    kept = let(norm, lambda n: let(_detections(n, listed), _kept))
    spans = F.transform(
        kept,
        lambda d: F.struct(
            d["start"].alias("start"), (-d["minus_end"]).alias("end"), d["rule"].alias("rule"), d["label"].alias("label"),
            d["base"].alias("base"), d["weight"].alias("weight"),
        ),
    )
    return out.withColumn(
        "license_scan",
        F.struct(norm.alias("norm"), F.when(F.length(norm) > 2, words_before(norm) - 1).otherwise(0).cast("bigint").alias("n_words"), spans.alias("spans")),
    )


def words_before(prefix: Column) -> Column:
    """Number of words that begin in a normalized string, or in a part of one up to a word's space: its spaces."""
    return (F.length(prefix) - F.length(F.replace(prefix, F.lit(" "), F.lit("")))).cast("bigint")
