"""License scan by ordered signature rules, in DataFrame functions only.

Texts are reduced to their words (A-Z in lower case, one blank between them, one at either end). Each
rule is a regular expression over that, with a label, a priority and a keyword. Rules whose keyword
is not in the text are not tried. Every place where a tried rule matches is a detection with its
interval; a detection inside the interval of one with the same or a higher priority is suppressed, so
"apache license version 2 0" is not also an "apache license" of any version.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What ends a word: all of ASCII but digits and letters.
NO_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# The phrases of the base and their labels.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}


class Family(NamedTuple):
    """A family of licenses: its label, the word or phrase that must be there, its name as a regular
    expression over words, and its versions."""

    label: str
    keyword: str
    name: str
    versions: tuple[str, ...] = ()


# Names and versions of public licenses.
FAMILIES = (
    Family("mit", " mit ", r"mit"),
    Family("apache", " apache ", r"apache(?: software)?", ("1 0", "1 1", "2 0")),
    Family("lgpl", "lgpl", r"(?:gnu )?lgpl", ("2", "2 1", "3")),
    Family(
        "lgpl", "general public", r"(?:gnu )?(?:lesser|library) general public", ("2", "2 1", "3")
    ),
    Family("agpl", "agpl", r"(?:gnu )?agpl", ("1", "3")),
    Family("agpl", "affero", r"(?:gnu )?affero general public", ("1", "3")),
    Family("gfdl", "free documentation", r"(?:gnu )?free documentation", ("1 1", "1 2", "1 3")),
    Family("gpl", "general public", r"(?:gnu )?general public", ("1", "2", "3")),
    Family("gpl", "gpl", r"(?:gnu )?gpl", ("1", "2", "3")),
    Family("bsd-2-clause", " bsd ", r"(?:simplified bsd|2 clause bsd|bsd 2 clause|freebsd)"),
    Family("bsd-3-clause", " bsd ", r"(?:modified bsd|new bsd|3 clause bsd|bsd 3 clause)"),
    Family("bsd-4-clause", " bsd ", r"(?:original bsd|4 clause bsd|bsd 4 clause)"),
    Family("0bsd", "bsd", r"(?:0bsd|zero clause bsd|bsd zero clause)"),
    Family("bsd", " bsd ", r"(?:berkeley )?bsd"),
    Family("mpl", "mozilla", r"mozilla public", ("1 0", "1 1", "2 0")),
    Family("mpl", " mpl ", r"mpl", ("1 0", "1 1", "2 0")),
    Family("epl", "eclipse", r"eclipse public", ("1 0", "2 0")),
    Family("cddl", "common development", r"common development and distribution", ("1 0", "1 1")),
    Family("cpl", "common public", r"common public", ("1 0",)),
    Family("eupl", "european union public", r"european union public", ("1 0", "1 1", "1 2")),
    Family("cecill", "cecill", r"cecill(?: b| c)?", ("1 0", "2 0", "2 1")),
    Family("artistic", "artistic", r"artistic", ("1 0", "2 0")),
    Family("boost", "boost", r"boost software", ("1 0",)),
    Family("isc", " isc ", r"isc"),
    Family("zlib", "zlib", r"zlib(?: libpng)?"),
    Family("unlicense", "unlicense", r"unlicense"),
    Family("wtfpl", "want to public", r"do what the (?:fuck|f) you want to public", ("1", "2")),
    Family("postgresql", "postgresql", r"postgresql"),
    Family("python", "python software foundation", r"python software foundation", ("2",)),
    Family("php", " php ", r"php", ("3 0", "3 01")),
    Family("openssl", "openssl", r"openssl"),
    Family("ofl", "open font", r"(?:sil )?open font", ("1 0", "1 1")),
    Family("odbl", "open database", r"open database", ("1 0",)),
    Family("mspl", "microsoft public", r"microsoft public"),
    Family("msrl", "microsoft reciprocal", r"microsoft reciprocal"),
    Family("osl", "open software", r"open software", ("1 0", "2 0", "2 1", "3 0")),
    Family("afl", "academic free", r"academic free", ("1 2", "2 0", "2 1", "3 0")),
    Family("ncsa", "ncsa", r"(?:university of illinois )?ncsa(?: open source)?"),
    Family("upl", "universal permissive", r"universal permissive", ("1 0",)),
    Family("sspl", "server side public", r"server side public", ("1",)),
    Family("bsl", "business source", r"business source", ("1 0", "1 1")),
    Family("elastic", "elastic", r"elastic", ("1", "2", "2 0")),
    Family("polyform", "polyform", r"polyform (?:noncommercial|small business|strict|shield)"),
    Family("rail", " rail ", r"(?:creativeml |bigscience )?(?:open )?rail(?: m)?"),
    Family("llama", "llama", r"llama (?:2|3|3 1|3 2|3 3) community"),
)
# Parts of Creative Commons names.
CC_PARTS = {
    "by": "attribution",
    "by sa": "attribution share ?alike",
    "by nd": "attribution no ?deriv(?:ative)?s?",
    "by nc": "attribution non ?commercial",
    "by nc sa": "attribution non ?commercial share ?alike",
    "by nc nd": "attribution non ?commercial no ?deriv(?:ative)?s?",
}
CC_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")
# Sentences of license texts and notices.
SENTENCES = (
    ("mit", "free of charge", "permission is hereby granted free of charge to any person"),
    ("isc", "fee is hereby granted", "permission to use copy modify and or distribute this software"),
    ("apache", "apache org", "www apache org licenses license 2 0"),
    ("gpl", "gnu org", "www gnu org licenses gpl"),
    ("lgpl", "gnu org", "www gnu org licenses lgpl"),
    ("agpl", "gnu org", "www gnu org licenses agpl"),
    ("bsd", "binary forms", "redistribution and use in source and binary forms"),
    ("bsd-3-clause", "endorse or promote", "used to endorse or promote products derived"),
    ("zlib", "misrepresented", "the origin of this software must not be misrepresented"),
    ("unlicense", "unencumbered", "free and unencumbered software released into the public domain"),
    ("public-domain", "public domain", "(?:released|placed|dedicated) (?:in|into|to) the public domain"),
    ("cc0", "cc0", "cc0(?: 1 0)?(?: universal)?"),
    ("cc0", "creative commons zero", "creative commons zero(?: 1 0)?(?: universal)?"),
    ("proprietary", "all rights reserved", "all rights reserved"),
    ("proprietary", "proprietary", "proprietary and confidential"),
)
# Signatures of notices and of license texts themselves, some with a version. A keyword's
# first word lets texts through to the rules, so it is one that other texts seldom have.
SIGNATURES = (
    (
        "gpl-2",
        "general public",
        "gnu general public license as published by the free software foundation either version 2",
    ),
    (
        "gpl-3",
        "general public",
        "gnu general public license as published by the free software foundation either version 3",
    ),
    (
        "lgpl-2.1",
        "general public",
        "gnu lesser general public license as published by the free software foundation either"
        " version 2 1",
    ),
    (
        "lgpl-3",
        "general public",
        "gnu lesser general public license as published by the free software foundation either"
        " version 3",
    ),
    (
        "agpl-3",
        "general public",
        "gnu affero general public license as published by the free software foundation either"
        " version 3",
    ),
    ("gpl", "redistribute it", "this program is free software you can redistribute it"),
    ("lgpl", "redistribute it", "this library is free software you can redistribute it"),
    ("gpl-2", "general public", "gnu general public license version 2 june 1991"),
    ("gpl-3", "general public", "gnu general public license version 3 29 june 2007"),
    ("lgpl-2.1", "general public", "gnu lesser general public license version 2 1 february 1999"),
    ("lgpl-3", "general public", "gnu lesser general public license version 3 29 june 2007"),
    ("agpl-3", "affero", "gnu affero general public license version 3 19 november 2007"),
    ("gfdl", "invariant sections", "with (?:no|the) invariant sections"),
    (
        "apache-2.0",
        "compliance with",
        "you may not use this file except in compliance with the license",
    ),
    ("apache-2.0", "apache", "apache license version 2 0 january 2004"),
    ("apache-2.0", "basis without", "on an as is basis without warranties or conditions of any kind"),
    ("mpl-2.0", "mozilla", "source code form is subject to the terms of the mozilla"),
    ("mpl-1.1", "mozilla", "contents of this file are subject to the mozilla public license version 1 1"),
    ("epl-1.0", "eclipse", "available under the terms of the eclipse public license v1? ?1? ?0"),
    ("epl-2.0", "eclipse", "available under the terms of the eclipse public license (?:v )?2 0"),
    (
        "cddl",
        "common development",
        "subject to the terms of the common development and distribution license",
    ),
    ("bsd", "redistributions", "redistributions of source code must retain the above copyright notice"),
    ("bsd", "redistributions", "redistributions in binary form must reproduce the above copyright"),
    (
        "bsd-3-clause",
        "endorse or promote",
        "nor the names of its contributors may be used to endorse or promote products",
    ),
    ("bsd-4-clause", "advertising materials", "all advertising materials mentioning features or use"),
    ("freebsd", "conclusions contained", "views and conclusions contained in the software"),
    ("mit", "substantial portions", "included in all copies or substantial portions of the software"),
    (
        "mit",
        "merchantability",
        "merchantability fitness for a particular purpose and non ?infringement",
    ),
    (
        "isc",
        "permission notice",
        "above copyright notice and this permission notice appear in all copies",
    ),
    ("boost-1.0", "boost", "boost software license version 1 0 august 17th 2003"),
    ("zlib", "plainly marked", "altered source versions must be plainly marked as such"),
    ("unlicense", "unlicense org", "unlicense org"),
    ("wtfpl", "want to", "you just do what the (?:fuck|f) you want to"),
    ("artistic-2.0", "artistic", "everyone is permitted to copy and distribute verbatim copies of this"),
    ("ofl-1.1", "open font", "font software is licensed under the sil open font license version 1 1"),
    (
        "postgresql",
        "documentation for",
        "use copy modify and distribute this software and its documentation for any purpose without fee",
    ),
    ("openssl", "openssl", "includes software developed by the openssl project"),
    ("eupl", "eupl", "licensed under the eupl"),
    ("php", " php ", "www php net license"),
    ("cc0", "publicdomain zero", "creativecommons org publicdomain zero 1 0"),
    ("cc0", "affirmer", "affirmer hereby overtly fully permanently irrevocably and unconditionally waives"),
    ("cc-by", "creative commons", "licensed under a creative commons attribution"),
    ("ncsa", "ncsa", "developed by .{1,80}? university of illinois"),
    ("proprietary", "prior written", "without (?:the )?(?:express )?prior written (?:permission|consent)"),
    ("proprietary", "trade secrets", "contains trade secrets"),
    ("proprietary", "unauthorized copying", "unauthorized copying of this file"),
)


#: What says that a license is given. "License" itself lets a text through anyhow.
GIVEN = ("licensed", "released", "distributed", "available", "published", "covered")
#: Keywords that are words of a language; their rules all need a word of `GIVEN` or "license".
COMMON_WORDS = ("mit",)


class Rule(NamedTuple):
    label: str
    priority: int  # 1 goes first
    keyword: str
    pattern: str


def rules() -> list[Rule]:
    """All rules in order: names with a version and signatures, stated names, sentences, names alone.

    Those of names are made from templates; sentences and signatures are written one by one.
    """
    found = []
    for label, keyword, name, versions in FAMILIES:
        call = rf"{name}(?: license| licence)?"
        for version in versions:
            found.append(
                Rule(
                    f"{label}-{version.replace(' ', '.')}",
                    1,
                    keyword,
                    rf"(?: the)? {call}(?: version| v)? v?{version}(?: only| or later)?(?= )",
                )
            )
        given = f"(?:{'|'.join(GIVEN)})"
        stated = rf" {given} under(?: the)?(?: terms of(?: the)?)? {call}(?= )"
        found.append(Rule(label, 2, keyword, stated))
        found.append(Rule(label, 2, keyword, rf" spdx license identifier {name}[^ ]*(?= )"))
        found.append(Rule(label, 4, keyword, rf" {name} licen[sc]e(?= )"))
    for short, long in CC_PARTS.items():
        for version in CC_VERSIONS:
            label = f"cc-{short.replace(' ', '-')}-{version.replace(' ', '.')}"
            found.append(Rule(label, 1, " cc ", rf" cc {short} {version}(?= )"))
            url = rf" creativecommons org licenses {short} {version}(?= )"
            found.append(Rule(label, 1, "creativecommons", url))
            found.append(
                Rule(
                    label,
                    1,
                    "creative commons",
                    rf" creative commons {long}(?: license)? {version}(?= )",
                )
            )
        label = f"cc-{short.replace(' ', '-')}"
        found.append(Rule(label, 3, " cc ", rf" cc {short}(?= )"))
        found.append(Rule(label, 3, "creative commons", rf" creative commons {long}(?= )"))
    found += [Rule(label, 3, key, rf" {pattern}(?= )") for label, key, pattern in SENTENCES]
    for label, key, pattern in SIGNATURES:
        found.append(Rule(label, 1 if label[-1].isdigit() else 3, key, rf" {pattern}(?= )"))
    return sorted(found, key=lambda rule: rule.priority)


def normal_words(text: str | Column) -> Column:
    """The words of a text in lower case with blanks between and around; null: one blank."""
    capitals, small = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    column = F.col(text) if isinstance(text, str) else text
    words = F.regexp_replace(F.translate(column, capitals, small), NO_WORD, " ")
    return F.concat(F.lit(" "), F.coalesce(F.trim(words), F.lit("")), F.lit(" "))


def _words_before(words: Column, at: Column) -> Column:
    """How many words stand before the blank at the 0-based place `at`."""
    head = F.substring(words, F.lit(1), at + 1)
    return (F.char_length(head) - F.char_length(F.replace(head, F.lit(" "), F.lit(""))) - 1).cast(
        "long"
    )


def _let(value: Column, use) -> Column:
    """`use(value)` with `value` evaluated once."""
    return F.transform(F.array(value), use)[0]


def _running(items: Column, zero: Column, add, merge, out, kind: str) -> Column:
    """For each of `items` what `out` makes of it and of the fold of all before it.

    `add` takes a fold and an item, `merge` two folds. An array that grows is copied at each step, so the
    items are cut into about as many parts as each part has items: each part's fold is taken first,
    then that of all parts before, and arrays grow only within a part.
    """

    def by_part(own: Column) -> Column:
        step = F.ceil(F.sqrt(F.size(own))).cast("int")
        starts = F.sequence(F.lit(1), F.size(own), step)
        parts = F.transform(starts, lambda start: F.slice(own, start, step))
        folds = F.transform(parts, lambda part: F.aggregate(part, zero, add))

        def inside(all_parts: Column, all_folds: Column) -> Column:
            def one(part: Column, i: Column) -> Column:
                before = F.aggregate(F.slice(all_folds, F.lit(1), i), zero, merge)
                begin = F.struct(before.alias("fold"), F.array().cast(kind).alias("made"))

                def go_on(state: Column, item: Column) -> Column:
                    made = F.concat(state["made"], F.array(out(state["fold"], item)))
                    return F.struct(add(state["fold"], item).alias("fold"), made.alias("made"))

                return F.aggregate(part, begin, go_on, lambda state: state["made"])

            return F.flatten(F.transform(all_parts, one))

        return _let(parts, lambda p: _let(folds, lambda f: inside(p, f)))

    return _let(
        items, lambda own: F.when(F.size(own) > 0, by_part(own)).otherwise(F.array().cast(kind))
    )


def _matches(words: Column, pattern: Column) -> Column:
    """(start, end) of every match, 0-based and exclusive, from the pieces between the matches."""
    pieces = F.split(words, pattern, -1)
    found = F.regexp_extract_all(words, pattern, F.lit(0))
    sizes = F.zip_with(
        F.slice(pieces, 1, F.size(found)),
        found,
        lambda piece, match: F.struct(
            F.char_length(piece).alias("gap"), F.char_length(match).alias("size")
        ),
    )

    def place(at: Column, size: Column) -> Column:
        start = at + size["gap"]
        return F.struct(start.alias("start"), (start + size["size"]).alias("end"))

    return _running(
        sizes,
        F.lit(0),
        lambda at, size: at + size["gap"] + size["size"],
        lambda at, more: at + more,
        place,
        "array<struct<start:int,end:int>>",
    )


def _detections(words: Column, ordered: list[Rule]) -> Column:
    """What the rules whose keyword is there find, by start and then by length and order."""
    table = F.array(
        *[
            F.struct(
                F.lit(i).alias("rule"),
                F.lit(rule.priority).alias("priority"),
                F.lit(rule.label).alias("label"),
                F.lit(rule.keyword).alias("keyword"),
                F.lit(rule.pattern).alias("pattern"),
            )
            for i, rule in enumerate(ordered)
        ]
    )
    gated = F.filter(table, lambda rule: F.contains(words, rule["keyword"]))
    found = F.flatten(
        F.transform(
            gated,
            lambda rule: F.transform(
                _matches(words, rule["pattern"]),
                lambda place: F.struct(
                    place["start"].alias("start"),
                    (-place["end"]).alias("until"),
                    rule["priority"].alias("priority"),
                    rule["rule"].alias("rule"),
                    rule["label"].alias("label"),
                ),
            ),
        )
    )
    return F.array_sort(found)


def _suppressed(found: Column, levels: int) -> Column:
    """Keep what no interval of the same or a higher priority contains.

    In order of start, a container comes before what it contains, so it is enough to know how far
    the intervals of each priority have reached.
    """

    def further(reach: Column, hit: Column) -> Column:
        return F.transform(
            reach,
            lambda old, i: F.when(
                i == hit["priority"] - 1, F.greatest(old, -hit["until"])
            ).otherwise(old),
        )

    def kept(reach: Column, hit: Column) -> Column:
        end = -hit["until"]
        inside = F.exists(F.slice(reach, F.lit(1), hit["priority"]), lambda far: far >= end)
        return F.struct(
            hit["label"].alias("label"),
            hit["start"].alias("start"),
            end.alias("end"),
            hit["priority"].alias("priority"),
            inside.alias("inside"),
        )

    marked = _running(
        found,
        F.array_repeat(F.lit(0), levels),
        further,
        lambda reach, more: F.zip_with(reach, more, lambda a, b: F.greatest(a, b)),
        kept,
        "array<struct<label:string,start:int,end:int,priority:int,inside:boolean>>",
    )
    return F.transform(
        F.filter(marked, lambda hit: ~hit["inside"]), lambda hit: hit.dropFields("inside")
    )


def scan(
    docs: DataFrame, text: str = "text", ordered: list[Rule] | None = None
) -> DataFrame:
    """Add what the scan of `text` finds to every row.

    * `n_words`, `n_base`: words; places where the words of a phrase of the base stand in a row
    * `first_word`, `last_word`: the first and last such place, in words from 0, or null
    * `base_labels`, `labels`: of the base, and of base and rules; distinct, sorted
    * `detections`: label, start, end (in characters of the reduced text) and priority of each rule's
      detections that are left
    * `score`: 0 without a label; else 0.5, and more the more specific the best detection is

    Columns of these names are replaced. A null text has no words. A row depends on itself alone,
    so nothing is shuffled and equal rows get equal results.
    """
    ordered = rules() if ordered is None else sorted(ordered, key=lambda rule: rule.priority)
    levels = max((rule.priority for rule in ordered), default=1)
    result = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    kept = docs.drop(*result, "detections")
    own = F.col(f"`{text}`")
    rows = kept.withColumn("__lower", F.lower(own))
    gate = F.col("__gate")
    rows = rows.withColumn("__gate", _worth_a_look(F.col("__lower"), ordered)).drop("__lower")
    rows = rows.withColumn("__words", F.when(gate, normal_words(own)))
    w = F.col("__words")

    def places(phrase: str) -> Column:
        # A phrase can begin where another ends, so the last blank is not taken.
        return F.regexp_count(w, F.lit(f" {phrase}(?= )")).cast("long")

    n_base = sum((places(phrase) for phrase in PHRASES), F.lit(0).cast("long"))
    has = [F.contains(w, F.lit(f" {phrase} ")) for phrase in PHRASES]
    firsts = [
        F.when(x, F.locate(f" {phrase} ", w) - 1).otherwise(F.char_length(w))
        for x, phrase in zip(has, PHRASES)
    ]
    lasts = [
        F.when(
            x,
            F.char_length(w)
            - F.locate(f" {phrase} "[::-1], F.reverse(w))
            - (len(phrase) + 2)
            + 1,
        ).otherwise(-1)
        for x, phrase in zip(has, PHRASES)
    ]
    found_any = F.coalesce(has[0] | has[1] | has[2], F.lit(False))
    base_labels = F.array_sort(
        F.filter(
            F.array(*[F.when(x, F.lit(label)) for x, label in zip(has, PHRASES.values())]),
            lambda x: x.isNotNull(),
        )
    )
    none = F.array().cast("array<struct<label:string,start:int,end:int,priority:int>>")
    detections = F.when(gate, _suppressed(_detections(w, ordered), levels)).otherwise(none)
    rows = rows.withColumns(
        {
            "n_words": F.coalesce(F.regexp_count(own, F.lit(WORD)), F.lit(0)).cast("long"),
            "n_base": F.coalesce(n_base, F.lit(0).cast("long")),
            "first_word": F.when(found_any, _words_before(w, F.least(*firsts))),
            "last_word": F.when(found_any, _words_before(w, F.greatest(*lasts))),
            "__base": base_labels,
            "detections": detections,
        }
    )
    all_labels = F.array_sort(
        F.array_union(F.col("__base"), F.transform("detections", lambda d: d["label"]))
    )
    best = F.array_min(F.transform("detections", lambda d: d["priority"]))
    score = F.when(F.size(all_labels) == 0, 0.0).otherwise(
        0.5 + 0.5 * (levels - F.coalesce(best, F.lit(levels))) / levels
    )
    return rows.withColumns(
        {
            "base_labels": F.array_join("__base", ","),
            "labels": F.array_join(all_labels, ","),
            "score": score.cast("double"),
        }
    ).drop("__words", "__gate", "__base")


def _worth_a_look(lower: Column, ordered: list[Rule]) -> Column:
    """Whether a text, in lower case, may have a phrase of the base or a keyword of the rules.

    Plain searches come first; an expression only looks at what they let through.
    """
    found = lower.contains("licen")
    keywords = {rule.keyword for rule in ordered}
    open_words = {keyword.split(" ")[0] for keyword in keywords if keyword[0] != " "}
    for word in sorted(open_words):
        if not any(other != word and other in word for other in open_words):
            found = found | lower.contains(word)
    for word in sorted({keyword.strip() for keyword in keywords if keyword[0] == " "}):
        alone = lower.contains(word) & lower.rlike(rf"(?<![0-9a-z]){word}(?![0-9a-z])")
        if word in COMMON_WORDS:
            alone = alone & lower.rlike("|".join(GIVEN))
        found = found | alone
    return F.coalesce(found, F.lit(False))
