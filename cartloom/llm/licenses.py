"""License scan by ordered signature rules, in built-in functions only.

A rule is an expression over a text's words (A-Z lower-cased, one blank between words), a keyword every match
contains, hints of which every match contains one, a label, a priority and a score. SIGNATURES are written by hand
from license bodies, headers and addresses; the other rules cross license names, with and without a version, with the
phrasings that announce a license. Texts without any keyword end at one look; others are
searched by the rules whose keyword and hints they hold. Detections inside a longer one, or overlapping one of better priority,
are dropped; detections of the fixed phrases always stay.

Null text is empty, as is one without words: zero counts, null places, empty labels. Rows are independent, so repeated
ones get equal results and an empty table none. Very long texts are searched whole, within one task, in time that
grows with their detections. Columns other than doc_id and text are not read, whatever their names.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .native import match_places

WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: Phrases and labels that are given.
BASE = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

_L = "licen[sc]e"
_PLAIN_BY = "(?: [1-4] [05])?(?! (?:nc|nd|sa|non|no|share))"
#: (label, the name in running words, the name's short form as words)
NAMES = (
    ("mit", "mit(?: x11)?|expat|x11", "mit"),
    ("mit-0", "mit no attribution", "mit 0"),
    ("apache-2", f"apache(?: software)? {_L}(?: version)?(?: v)? ?2(?: 0)?|apache 2(?: 0)?", "apache 2 0"),
    ("apache-1.1", f"apache(?: software)? {_L}(?: version)? 1 1", "apache 1 1"),
    ("gpl-3", f"(?:gnu )?general public {_L}(?: gpl)?(?: version| v)? ?v?3|(?:gnu )?gpl(?: version)? ?v?3", "gpl 3 0(?: only| or later)?"),
    ("gpl-2", f"(?:gnu )?general public {_L}(?: gpl)?(?: version| v)? ?v?2|(?:gnu )?gpl(?: version)? ?v?2", "gpl 2 0(?: only| or later)?"),
    ("gpl-1", f"(?:gnu )?general public {_L}(?: version| v)? ?v?1|(?:gnu )?gpl(?: version)? ?v?1", "gpl 1 0(?: only| or later)?"),
    ("lgpl-3", f"(?:gnu )?lesser general public {_L}(?: version| v)? ?v?3|(?:gnu )?lgpl(?: version)? ?v?3", "lgpl 3 0(?: only| or later)?"),
    ("lgpl-2.1", f"(?:gnu )?lesser general public {_L}(?: version| v)? ?v?2 1|(?:gnu )?lgpl(?: version)? ?v?2 1", "lgpl 2 1(?: only| or later)?"),
    ("lgpl-2", f"(?:gnu )?library general public {_L}(?: version| v)? ?v?2|(?:gnu )?lgpl(?: version)? ?v?2", "lgpl 2 0(?: only| or later)?"),
    ("agpl-3", f"(?:gnu )?affero general public {_L}(?: version| v)? ?v?3|(?:gnu )?agpl(?: version)? ?v?3", "agpl 3 0(?: only| or later)?"),
    ("gfdl", f"(?:gnu )?free documentation {_L}", "gfdl 1 [123](?: only| or later)?"),
    ("bsd-2", "(?:simplified|2 clause|two clause|freebsd) bsd|bsd 2 clause", "bsd 2 clause"),
    ("bsd-3", "(?:new|modified|revised|3 clause|three clause) bsd|bsd 3 clause", "bsd 3 clause"),
    ("bsd-4", "(?:original|4 clause|four clause) bsd|bsd 4 clause", "bsd 4 clause"),
    ("0bsd", "(?:zero clause|free public) bsd", "0bsd"),
    ("isc", "isc|internet systems consortium", "isc"),
    ("mpl-2", "mozilla public(?: licen[sc]e)?(?: version| v)? ?2(?: 0)?|mpl ?v?2(?: 0)?", "mpl 2 0"),
    ("mpl-1.1", "mozilla public(?: licen[sc]e)?(?: version| v)? ?1 1|mpl ?v?1 1", "mpl 1 1"),
    ("epl-2", "eclipse public(?: licen[sc]e)?(?: version| v)? ?2(?: 0)?", "epl 2 0"),
    ("epl-1", "eclipse public(?: licen[sc]e)?(?: version| v)? ?1(?: 0)?", "epl 1 0"),
    ("cddl-1", "common development and distribution(?: licen[sc]e)?(?: version)? 1(?: 0)?", "cddl 1 0"),
    ("eupl-1.2", "european union public(?: licen[sc]e)?(?: version)? 1 2", "eupl 1 2"),
    ("artistic-2", f"artistic {_L}(?: version)? 2(?: 0)?", "artistic 2 0"),
    ("artistic-1", f"artistic {_L}(?: version)? 1(?: 0)?", "artistic 1 0"),
    ("zlib", "zlib(?: libpng)?", "zlib"),
    ("boost-1", f"boost software(?: {_L})?(?: version)? 1(?: 0)?|boost software", "bsl 1 0"),
    ("wtfpl", "do what the [a-z]+ you want to public|wtfpl", "wtfpl"),
    ("unlicense", "unlicense", "unlicense"),
    ("psf-2", "python software foundation(?: version 2)?", "psf 2 0"),
    ("php-3", "php(?: version)? 3(?: 01)?", "php 3 01"),
    ("ruby", "ruby", "ruby"),
    ("perl", "same terms as perl(?: itself)?", "perl 5"),
    ("openssl", "openssl", "openssl"),
    ("postgresql", "postgresql", "postgresql"),
    ("ms-pl", "microsoft public|ms pl", "ms pl"),
    ("odbl-1", "open database|odbl", "odbl 1 0"),
    ("ofl-1.1", "sil open font(?: licen[sc]e)?(?: version 1 1)?|open font", "ofl 1 1"),
    ("cc0-1", "cc0(?: 1 0)?(?: universal)?|creative commons zero", "cc0 1 0"),
    ("cc-by", f"creative commons attribution{_PLAIN_BY}|cc by{_PLAIN_BY}", "cc by [1-4] [05]"),
    ("cc-by-sa", "creative commons attribution share ?alike|cc by sa", "cc by sa [1-4] [05]"),
    ("cc-by-nd", "creative commons attribution no ?deriv(?:s|atives)|cc by nd", "cc by nd [1-4] [05]"),
    ("cc-by-nc", "creative commons attribution non ?commercial(?! (?:share|no))|cc by nc(?! (?:sa|nd))", "cc by nc [1-4] [05]"),
    ("cc-by-nc-sa", "creative commons attribution non ?commercial share ?alike|cc by nc sa", "cc by nc sa [1-4] [05]"),
    ("cc-by-nc-nd", "creative commons attribution non ?commercial no ?deriv(?:s|atives)|cc by nc nd", "cc by nc nd [1-4] [05]"),
)
_VERSION = r"(?: gpl| lgpl| agpl)?(?: version| v)? ?v?[1-3](?= )"
#: Names without a version.
NAMES += (
    ("gpl", f"(?<!lesser )(?<!library )(?<!affero )(?:gnu )?general public {_L}(?!{_VERSION})|(?:gnu )?gpl(?!{_VERSION})", "gpl"),
    ("lgpl", f"(?:gnu )?(?:lesser|library) general public {_L}(?!{_VERSION})|(?:gnu )?lgpl(?!{_VERSION})", "lgpl"),
    ("agpl", f"(?:gnu )?affero general public {_L}(?!{_VERSION})|(?:gnu )?agpl(?!{_VERSION})", "agpl"),
    ("apache", f"apache(?: software)?(?: foundation)?(?! (?:{_L} )?(?:version |v )?v?[12] )", "apache"),
    ("bsd", "(?<!clause )(?<!simplified )(?<!new )(?<!modified )(?<!revised )(?<!original )bsd(?: style| type)?(?! [2-4] clause)", "bsd"),
    ("mpl", f"mozilla public(?! (?:{_L} )?(?:version |v )?[12] )|mpl(?! ?v?[12] )", "mpl"),
    ("epl", f"eclipse public(?! (?:{_L} )?(?:version |v )?[12] )|epl(?! ?v?[12] )", "epl"),
    ("cddl", "common development and distribution|cddl", "cddl"),
    ("eupl", "european union public|eupl", "eupl"),
    ("artistic", f"artistic(?! (?:{_L} )?(?:version )?[12] )", "artistic"),
    ("php", "php(?! (?:version )?3)", "php"),
    ("cc", "creative commons(?! (?:attribution|zero))|cc(?! by)", "cc"),
)

_THE = "(?:the |an? )?"
#: (phrasing around a name, keyword, priority, score); a smaller priority is better
PHRASINGS = (
    (f"licen[sc]ed (?:to you )?under {_THE}(?:terms of {_THE})?(?:NAME)(?: {_L})?", "licen", 1, 0.98),
    (f"(?:released|distributed|published|available|provided|redistributed) under {_THE}(?:terms of {_THE})?(?:NAME)(?: {_L})?", " under ", 2, 0.9),
    (f"under the terms of {_THE}(?:NAME)(?: {_L})?", "under the terms of", 3, 0.9),
    (f"(?:subject to|governed by|covered by) {_THE}(?:terms of {_THE})?(?:NAME) {_L}", "licen", 3, 0.85),
    (f"(?:NAME) {_L} (?:agreement|terms|text|file|applies)", "licen", 4, 0.8),
    (f"(?:use of this|this) [a-z]+ is (?:under|governed by) {_THE}(?:NAME)", " this ", 4, 0.8),
    (f"{_L} (?:is |type )?{_THE}(?:NAME)", "licen", 5, 0.7),
    (f"under {_THE}(?:NAME) {_L}", "licen", 5, 0.7),
    # A title: the name and the word, or a name that ends with the word and a version.
    (f"(?:NAME)(?: {_L}|(?<=licen[sc]e(?: version)?(?: v)? ?v?[0-9 ]{{0,4}}))", "licen", 7, 0.6),
)

_PUBLISHED = f"{_L} as published by the free software foundation (?:either )?version"
_COPYING = "permission to use copy modify and(?: or)? distribute this software"
#: (signature, keyword, label); all written by hand
SIGNATURES = (
    ("permission is hereby granted free of charge(?! to any person or organization)(?: to any person obtaining a copy)?"
     "(?: of this software and associated documentation files)?", "permission is hereby granted", "mit"),
    ("the above copyright notice and this permission notice shall be included in all copies", "permission notice", "mit"),
    ("permission is hereby granted free of charge to any person or organization(?: obtaining a copy of the software)?", "permission is hereby granted", "boost-1"),
    ("redistribution and use in source and binary forms(?: with or without modification)?(?: are permitted)?", "redistribution and use", "bsd"),
    ("redistributions (?:of source code|in binary form) must (?:retain|reproduce) the above copyright notice", "redistributions", "bsd"),
    ("neither the names? of (?:[^ ]+ ){1,16}(?:nor|or) (?:the )?names of (?:its|any|the|their|other) (?:[^ ]+ )?contributors may be used to endorse", "endorse", "bsd-3"),
    ("all advertising materials mentioning features or use of this software must display", "advertising materials", "bsd-4"),
    (f"{_COPYING} for any purpose with or without fee is hereby granted provided", "permission to use", "isc"),
    (f"{_COPYING} for any purpose with or without fee is hereby granted(?! provided)", "permission to use", "0bsd"),
    (f"{_COPYING} and its documentation for any purpose without fee and without a written agreement", "permission to use", "postgresql"),
    (f"you may not use this (?:file|software|work) except in compliance with the {_L}", "licen", "apache-2"),
    (f"{_L} shall mean the terms and conditions for use reproduction and distribution as defined by", "licen", "apache-2"),
    (f"general public {_PUBLISHED} 3", "licen", "gpl-3"),
    (f"(?<!lesser )(?<!library )(?<!affero )general public {_PUBLISHED} 2", "licen", "gpl-2"),
    (f"(?<!lesser )(?<!library )(?<!affero )general public {_PUBLISHED} 1", "licen", "gpl-1"),
    (f"lesser general public {_PUBLISHED} 3", "licen", "lgpl-3"),
    (f"lesser general public {_PUBLISHED} 2 1", "licen", "lgpl-2.1"),
    (f"library general public {_PUBLISHED} 2", "licen", "lgpl-2"),
    (f"affero general public {_PUBLISHED} 3", "licen", "agpl-3"),
    (f"everyone is permitted to copy and distribute verbatim copies of this {_L} document", "licen", "gpl"),
    (f"everyone is permitted to copy and distribute verbatim or modified copies of this {_L} document", "licen", "wtfpl"),
    (f"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation {_L}", "licen", "gfdl"),
    ("altered source versions must be plainly marked as such", "plainly marked", "zlib"),
    ("this is free and unencumbered software released into the public domain", "unencumbered", "unlicense"),
    (f"this source code form is subject to the terms of the mozilla public {_L} v(?:ersion)? 2 0", "licen", "mpl-2"),
    (f"the contents of this file are subject to the mozilla public {_L} version 1 1", "licen", "mpl-1.1"),
    (f"the contents of this file are subject to the terms of the common development and distribution {_L}", "licen", "cddl"),
    (f"accompanying materials are made available under the terms of the eclipse public {_L} v(?:ersion)? ?1 0", "licen", "epl-1"),
    (f"accompanying materials are made available under the terms of the eclipse public {_L} v(?:ersion)? ?2 0", "licen", "epl-2"),
    (f"distributed under the boost software {_L}", "licen", "boost-1"),
    ("has waived all copyright and related or neighboring rights", "waived all copyright", "cc0-1"),
    (f"apache org {_L}s {_L} 2 0", "licen", "apache-2"),
    (f"opensource org {_L}s? mit", "licen", "mit"),
    (f"opensource org {_L}s? bsd 2 clause", "licen", "bsd-2"),
    (f"opensource org {_L}s? bsd 3 clause", "licen", "bsd-3"),
    (f"gnu org {_L}s gpl 3 0", "licen", "gpl-3"),
    (f"gnu org {_L}s (?:old {_L}s )?gpl 2 0", "licen", "gpl-2"),
    (f"mozilla org (?:en us )?mpl 2 0", "mozilla org", "mpl-2"),
    (f"creativecommons org {_L}s by [1-4] [05]", "licen", "cc-by"),
    (f"creativecommons org {_L}s by sa [1-4] [05]", "licen", "cc-by-sa"),
    (f"creativecommons org {_L}s by nd [1-4] [05]", "licen", "cc-by-nd"),
    (f"creativecommons org {_L}s by nc [1-4] [05]", "licen", "cc-by-nc"),
    (f"creativecommons org {_L}s by nc sa [1-4] [05]", "licen", "cc-by-nc-sa"),
    (f"creativecommons org {_L}s by nc nd [1-4] [05]", "licen", "cc-by-nc-nd"),
    ("creativecommons org publicdomain zero 1 0", "creativecommons", "cc0-1"),
    ("(?:gnu )?gpl(?: version)? ?v?3(?: 0)?", "gpl", "gpl-3"),
    ("(?:gnu )?gpl(?: version)? ?v?2(?: 0)?", "gpl", "gpl-2"),
    ("(?:gnu )?lgpl(?: version)? ?v?3(?: 0)?", "gpl", "lgpl-3"),
    ("(?:gnu )?lgpl(?: version)? ?v?2 1", "gpl", "lgpl-2.1"),
    ("(?:gnu )?agpl(?: version)? ?v?3(?: 0)?", "gpl", "agpl-3"),
)


@dataclass(frozen=True)
class Rule:
    pattern: str
    keyword: str
    label: str
    priority: int
    score: float
    base: bool = False
    hints: tuple[str, ...] = ("",)


def literals(name: str) -> tuple[str, ...]:
    """For each alternative of a name the longest fixed piece: what matches the name contains one of them."""
    while (less := re.sub(r"\((?:[^()|]|\|)*\)\??", lambda m: "#" * len(m[0]), name)) != name:
        name = less
    return tuple(max(re.split(r"[^a-z0-9 ]+", re.sub(r"\[[^]]*\]|.\?", "#", part)), key=len) for part in name.split("|"))


def rules() -> list[Rule]:
    out = [Rule(f"(?<= ){phrase}(?= )", phrase, label, 0, 1.0, True) for phrase, label in BASE]
    out += [Rule(f"(?<= )(?:{pattern})(?= )", keyword, label, 2, 0.95) for pattern, keyword, label in SIGNATURES]
    for label, name, short in NAMES:
        for phrasing, keyword, priority, score in PHRASINGS:
            out.append(Rule(f"(?<= ){phrasing.replace('NAME', name)}(?= )", keyword, label, priority, score, hints=literals(name)))
        if label.startswith("cc"):
            out.append(Rule(f"(?<= )(?=creative)(?:{name})(?= )", "creative commons", label, 7, 0.6))
        if label.startswith("cc") and label != "cc":
            out.append(Rule(f"(?<= )(?:{short})(?= )", short[:5] if label.startswith("cc-") else "cc0", label, 7, 0.6))
        out.append(Rule(f"(?<= )spdx license identifier (?:{short})(?= )", "spdx", label, 1, 0.99))
    out += [
        Rule("(?<= )all rights reserved(?= )", "all rights reserved", "proprietary", 6, 0.6),
        Rule("(?<= )(?:proprietary and confidential|confidential and proprietary)(?= )", "proprietary", "proprietary", 6, 0.7),
        Rule("(?<= )(?:dedicated to|released into|placed in) the public domain(?= )", "public domain", "public-domain", 3, 0.9),
    ]
    return out


#: How keywords that are common words are narrowed in GATE: every match of their rules holds one of these.
_NARROWED = {
    " under ": f"(?:released|distributed|published|available|provided){_GAP}under",
    " this ": f"is{_GAP}(?:under|governed)",
}


def gate() -> str:
    keywords = sorted({r.keyword for r in rules()})
    # A keyword that holds another one adds nothing.
    keywords = [k for k in keywords if k in _NARROWED or not any(o != k and o not in _NARROWED and o in k for o in keywords)]
    return "(?i)" + "|".join(_NARROWED.get(k) or k.replace(" ", _GAP) for k in keywords)


#: Raw text with a match of any rule holds one of these.
GATE = gate()


def normal_words(text: Column) -> Column:
    """The words of a text, lower-cased, each with a blank on both sides."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_replace(F.concat(F.lit(" "), lower, F.lit(" ")), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")


def _blanks(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def detections(words: Column) -> Column:
    """array<struct<first, last, label, priority, score, base>> in word places, last exclusive."""
    listed = F.array(
        *(
            F.struct(
                F.lit(r.pattern).alias("pattern"),
                F.lit(r.keyword).alias("keyword"),
                F.lit(r.label).alias("label"),
                F.lit(r.priority).alias("priority"),
                F.lit(r.score).alias("score"),
                F.lit(r.base).alias("base"),
                F.array(*map(F.lit, r.hints)).alias("hints"),
            )
            for r in rules()
        )
    )
    held = F.filter(listed, lambda r: F.contains(words, r["keyword"]) & F.exists(r["hints"], lambda x: F.contains(words, x)))

    def found(r: Column) -> Column:
        return F.transform(
            match_places(words, r["pattern"], _blanks),
            lambda m: F.struct(
                (m["at"] - 1).cast("long").alias("first"),
                (m["at"] + _blanks(m["value"])).cast("long").alias("last"),
                r["label"].alias("label"),
                r["priority"].alias("priority"),
                r["score"].alias("score"),
                r["base"].alias("base"),
            ),
        )

    return F.flatten(F.transform(held, found))


def beats(b: Column, a: Column) -> Column:
    contains = (b["first"] <= a["first"]) & (b["last"] >= a["last"])
    longer = (b["last"] - b["first"]) > (a["last"] - a["first"])
    overlaps = (b["first"] < a["last"]) & (a["first"] < b["last"])
    better = b["priority"] < a["priority"]
    # A longer detection wins over one inside it; otherwise priority decides.
    inside_other = (a["first"] <= b["first"]) & (a["last"] >= b["last"]) & ~(contains & ~longer)
    return (contains & (longer | better)) | (overlaps & better & ~contains & ~inside_other)


def surviving(rows: DataFrame) -> DataFrame:
    """`rows` with the detections of column `every` that no other one beats, as column `kept`.

    Only detections that overlap can beat one another, and none is wider than `width` words, so those that start
    in one stretch of that many words meet those of the stretches beside it: linear in their number.
    """
    rows = rows.withColumn("placed", F.array_sort("every"))
    widest = F.array_max(F.transform("placed", lambda d: d["last"] - d["first"]))
    rows = rows.withColumn("width", F.greatest(widest, F.lit(1)))
    placed, starts = F.col("placed"), F.col("starts")
    stretch = lambda i: F.floor(placed[i]["first"] / F.col("width"))
    fresh = F.filter(F.sequence(F.lit(0), F.size(placed) - 1), lambda i: (i == 0) | (stretch(i) != stretch(F.greatest(i - 1, F.lit(0)))))
    rows = rows.withColumn("starts", F.when(F.size(placed) > 0, F.concat(fresh, F.array(F.size(placed)))))

    def piece(low: Column, high: Column) -> Column:
        return F.slice(placed, starts[low] + 1, starts[high] - starts[low])

    def of_stretch(k: Column) -> Column:
        near = piece(F.greatest(k - 2, F.lit(0)), F.least(k + 1, F.size(starts) - 1))
        return F.filter(piece(k - 1, k), lambda a: a["base"] | ~F.exists(near, lambda b: ~b["base"] & beats(b, a)))

    kept = F.flatten(F.transform(F.sequence(F.lit(1), F.size(starts) - 1), of_stretch))
    return rows.withColumn("kept", F.when(F.size(placed) > 0, kept).otherwise(placed))


def _labels(found: Column) -> Column:
    return F.concat_ws(",", F.array_sort(F.array_distinct(F.transform(found, lambda d: d["label"]))))


def license_scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_words"), text.alias("text"))
    kind = "array<struct<first:bigint,last:bigint,label:string,priority:int,score:double,base:boolean>>"
    words = F.when(F.col("text").rlike(GATE), normal_words(F.col("text")))
    rows = rows.select("doc_id", "n_words", words.alias("words"))
    every = F.when(F.col("words").isNotNull(), detections(F.col("words"))).cast(kind)
    rows = rows.select("doc_id", "n_words", F.coalesce(every, F.array().cast(kind)).alias("every"))
    rows = rows.select("doc_id", "n_words", "every", F.filter("every", lambda d: d["base"]).alias("base"))
    rows = surviving(rows)
    first = F.transform("base", lambda d: d["first"])
    return rows.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(first).alias("first_word"),
        F.array_max(first).alias("last_word"),
        _labels(F.col("base")).alias("base_labels"),
        _labels(F.col("kept")).alias("labels"),
        F.coalesce(F.array_max(F.transform("kept", lambda d: d["score"])), F.lit(0.0)).alias("score"),
    )
