"""License detection by ordered signature rules, in DataFrame expressions only.

Texts are reduced to lower-case words. Rules are regular expressions over the words, built from a
table of license families, versions and ways to mention a license. A rule is tried only on texts
that hold a keyword of its family. Detections are places; one that lies inside another, longer one
is dropped, and of detections of the same place the rule of highest priority stays, so that "GNU
Lesser General Public License" is no mention of the plain one. Base phrases are counted apart and
always keep their label.

Results: null counts as empty text, without words or labels. Repeated rows each get the same
result. A null doc_id is kept. Other columns are ignored. A text without any detection has empty
labels and score 0; otherwise the score is the highest confidence of the rules kept, and at least
``BASE_CONFIDENCE`` with a base phrase.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
BASE_CONFIDENCE = 0.8
OPEN, CLOSE = "\x01", "\x02"


class Family(NamedTuple):
    label: str
    name: str  # regular expression over words
    keywords: tuple[str, ...]
    versions: tuple[str, ...] = ()
    url: str = ""


_CC = {
    "by": "attribution",
    "by-sa": "attribution share ?alike",
    "by-nc": "attribution non ?commercial",
    "by-nd": "attribution no ?deriv(?:ative)?s?(?: works)?",
    "by-nc-sa": "attribution non ?commercial share ?alike",
    "by-nc-nd": "attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?",
}

# Names, keywords, versions and addresses of public licenses.
FAMILIES = [
    Family("mit", "mit", (" mit ",), (), "opensource org licenses mit"),
    Family("mit-0", "mit (?:0|no attribution)", (" mit ",)),
    Family("apache", "apache(?: software)?", (" apache ",), ("1.0", "1.1", "2.0"), "apache org licenses license"),
    Family("gpl", "(?:gnu )?(?:gpl|general public)", (" gpl", " general public "), ("1.0", "2.0", "3.0"), "gnu org licenses(?: old licenses)? gpl"),
    Family("lgpl", "(?:gnu )?(?:lgpl|(?:lesser|library) general public)", (" lgpl", " lesser ", " library "), ("2.0", "2.1", "3.0"), "gnu org licenses(?: old licenses)? lgpl"),
    Family("agpl", "(?:gnu )?(?:agpl|affero general public)", (" agpl", " affero "), ("1.0", "3.0"), "gnu org licenses agpl"),
    Family("gfdl", "(?:gnu )?(?:gfdl|free documentation)", (" gfdl", " fdl ", " documentation "), ("1.1", "1.2", "1.3"), "gnu org licenses fdl"),
    Family("mpl", "(?:mpl|mozilla public)", (" mpl", " mozilla "), ("1.0", "1.1", "2.0"), "mozilla org mpl"),
    Family("epl", "(?:epl|eclipse public)", (" epl", " eclipse "), ("1.0", "2.0"), "eclipse org legal epl"),
    Family("cddl", "(?:cddl|common development and distribution)", (" cddl", " development "), ("1.0", "1.1")),
    Family("cpl", "(?:cpl|common public)", (" cpl", " common "), ("1.0",)),
    Family("eupl", "(?:eupl|european union public)", (" eupl", " european "), ("1.0", "1.1", "1.2")),
    Family("osl", "(?:osl|open software)", (" osl", " open "), ("1.0", "1.1", "2.0", "2.1", "3.0")),
    Family("afl", "(?:afl|academic free)", (" afl", " academic "), ("1.1", "1.2", "2.0", "2.1", "3.0")),
    Family("artistic", "artistic", (" artistic ",), ("1.0", "2.0")),
    Family("bsd-2-clause", "(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)", (" bsd ", " freebsd "), (), "opensource org licenses bsd 2 clause"),
    Family("bsd-3-clause", "(?:bsd 3 clause|3 clause bsd|(?:new|revised|modified) bsd)", (" bsd ",), (), "opensource org licenses bsd 3 clause"),
    Family("bsd-4-clause", "(?:bsd 4 clause|4 clause bsd|original bsd)", (" bsd ",)),
    Family("0bsd", "(?:0bsd|zero clause bsd)", (" 0bsd ", " bsd ")),
    Family("bsd", "bsd", (" bsd ",)),
    Family("isc", "isc", (" isc ",), (), "opensource org licenses isc"),
    Family("zlib", "zlib(?: libpng)?", (" zlib ",)),
    Family("bsl", "boost software", (" boost ", " bsl "), ("1.0",), "boost org license"),
    Family("psf", "(?:psf|python software foundation)", (" psf ", " python "), ("2.0",)),
    Family("ofl", "(?:ofl|sil open font)", (" ofl ", " font "), ("1.0", "1.1")),
    Family("odbl", "(?:odbl|open database|odc open database)", (" odbl ", " database "), ("1.0",)),
    Family("unlicense", "unlicense", (" unlicense ",), (), "unlicense org"),
    Family("wtfpl", "(?:wtfpl|do what the fuck you want to public)", (" wtfpl ", " public "), ("2.0",)),
    Family("ms-pl", "(?:ms pl|microsoft public)", (" microsoft ", " ms pl ")),
    Family("ms-rl", "(?:ms rl|microsoft reciprocal)", (" microsoft ", " ms rl ")),
    Family("postgresql", "postgresql", (" postgresql ",)),
    Family("ncsa", "(?:university of illinois )?ncsa(?: open source)?", (" ncsa ",)),
    Family("cc0", "(?:cc0|cc zero|creative commons zero)", (" cc0 ", " zero "), ("1.0",), "creativecommons org publicdomain zero"),
    *(
        Family(
            f"cc-{kind}",
            f"(?:(?:cc|creative commons) {kind.replace('-', ' ')}|(?:creative commons|cc) {words})",
            (" cc ", " creative ", " creativecommons "),
            ("1.0", "2.0", "2.5", "3.0", "4.0"),
            f"creativecommons org licenses {kind.replace('-', ' ')}",
        )
        for kind, words in _CC.items()
    ),
]

# Sentences that stand for a license without naming it.
SENTENCES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", " hereby "),
    ("bsd", "redistribution and use in source and binary forms with or without modification", " redistribution "),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", " distribute "),
    ("zlib", "this software is provided as is without any express or implied warranty in no event", " warranty "),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license", " redistribute "),
    ("unlicense", "this is free and unencumbered software released into the public domain", " unencumbered "),
    ("public-domain", "(?:released|dedicated|placed) (?:in|in ?to) the public domain", " domain "),
    ("rights-reserved", "all rights reserved", " rights "),
    ("rights-reserved", "no part of this (?:work|book|document|publication) may be reproduced", " reproduced "),
    ("proprietary", "(?:proprietary and confidential|confidential and proprietary)", " proprietary "),
]

# Words one of which every rule but a name with a version holds.
HINTS = r" (?:un|re)?licen[sc]e[ds]? | spdx | rights reserved | permission | redistribution | domain | confidential | may be reproduced | creativecommons | (?:[la]?gpl|mpl|epl|cddl|eupl|gfdl|cc|cc0|under|provided|redistribute) "

GIVEN = (
    "(?:licen[sc]ed|released|distributed|available|published|provided|covered|made available|"
    "dual licen[sc]ed|redistribut(?:ed|able)|use is governed)"
)
LATER = {"-or-later": "(?: (?:license|licence))? (?:or(?: at your option)? )?any later version"}


def _version(version: str) -> str:
    """Words of a version: a final zero may be missing."""
    major, minor = version.split(".")
    tail = "(?: 0)?(?! [0-9])" if minor == "0" else f" {minor}"
    return f"(?:(?:version|v|ver) )?v?{major}{tail}"


def _numbered_names() -> str:
    """Names of families before a number: a version needs no word for license."""
    names = "|".join(f.name for f in FAMILIES if f.versions)
    kind = "(?: (?:public|international|unported|generic))?"
    return f" (?:{names}){kind} (?:(?:version|ver|v) )?v?[0-9]"


class Rule(NamedTuple):
    label: str
    pattern: str
    keywords: tuple[str, ...]  # one of them must occur
    priority: int
    confidence: float


def rules() -> list[Rule]:
    """All rules, highest priority first."""
    out = []
    for f in FAMILIES:
        named = f"{f.name}(?: (?:public|international|unported|generic))?(?: licen[sc]e)?"
        for v in f.versions:
            label, number = f"{f.label}-{v}", _version(v)
            out.append(Rule(label, f"spdx licen[sc]e identifier {f.label.replace('-', ' ')} {number}", f.keywords, 100, 1.0))
            out.append(Rule(label, f"{GIVEN} under (?:the )?(?:terms of )?(?:the )?{named} {number}", f.keywords, 90, 1.0))
            out.append(Rule(label, f"{named} {number}", f.keywords, 70, 0.95))
            if f.url:
                out.append(Rule(label, f"{f.url} {number}", f.keywords, 80, 1.0))
            if f.label in ("gpl", "lgpl", "agpl", "gfdl"):
                for suffix, words in LATER.items():
                    out.append(Rule(label + suffix, f"{named} {number}{words}", f.keywords, 95, 1.0))
                    out.append(Rule(label + suffix, f"{named} as published by the free software foundation (?:either )?{number} of the license{words}", f.keywords, 95, 1.0))
        out.append(Rule(f.label, f"spdx licen[sc]e identifier {f.label.replace('-', ' ')}", f.keywords, 60, 0.95))
        out.append(Rule(f.label, f"{GIVEN} under (?:the )?(?:terms of )?(?:the )?{f.name}(?: licen[sc]e)?", f.keywords, 50, 0.9))
        out.append(Rule(f.label, f"{f.name} licen[sc]e", f.keywords, 40, 0.8))
        if f.url:
            out.append(Rule(f.label, f.url, f.keywords, 45, 0.9))
    out += [Rule(label, words, (keyword,), 30, 0.7) for label, words, keyword in SENTENCES]
    return sorted(set(out), key=lambda r: (-r.priority, r.label, r.pattern))


def words_of_text(text: Column) -> Column:
    """Lower-case words with one space before, between and after them."""
    upper, lower = (bytes(range(a, a + 26)).decode() for a in (65, 97))
    plain = F.translate(F.coalesce(text, F.lit("")), upper, lower)
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(plain, SEPARATORS, " ")), F.lit(" "))


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def base_places(words: Column) -> dict[str, tuple[Column, Column, Column]]:
    """Per base phrase: number of places, first and last word index."""
    out = {}
    for phrase in BASE:
        spaced = f" {phrase} "
        has = F.contains(words, F.lit(spaced))
        places = F.when(has, F.regexp_count(words, F.lit(f"(?={spaced})"))).otherwise(F.lit(0))
        first = F.when(has, _spaces(F.substring(words, F.lit(1), F.instr(words, F.lit(spaced)))) - 1)
        rest = F.substring_index(words, spaced, -1)
        until = F.substring(words, F.lit(1), F.length(words) - F.length(rest) - len(spaced) + 1)
        out[phrase] = (places.cast("long"), first.cast("long"), F.when(has, _spaces(until) - 1).cast("long"))
    return out


def _any_word(keywords: tuple[str, ...]) -> Column:
    return F.rlike("words", F.lit("|".join(keywords)))


def detections(texts: DataFrame) -> DataFrame:
    """(doc_id, digest, label, priority, confidence, begin, end): places of rules in ``words``,
    those inside longer or preferred ones dropped."""
    by_keyword: dict[tuple[str, ...], list[Rule]] = {}
    for r in rules():
        by_keyword.setdefault(r.keywords, []).append(r)

    def literal(r: Rule) -> Column:
        return F.struct(
            F.lit(r.label).alias("label"),
            F.lit(f"(?<= ){r.pattern}(?= )").alias("pattern"),
            F.lit(r.priority).alias("priority"),
            F.lit(r.confidence).alias("confidence"),
        )

    none = F.array().cast("array<struct<label:string,pattern:string,priority:int,confidence:double>>")
    gated = [
        F.when(_any_word(k), F.array(*map(literal, own))).otherwise(none)
        for k, own in by_keyword.items()
    ]
    tried = texts.select("doc_id", "digest", "words", F.explode(F.array_distinct(F.flatten(F.array(*gated)))).alias("rule"))
    hit = tried.where(F.rlike("words", F.col("rule.pattern")))
    marked = F.regexp_replace("words", F.col("rule.pattern"), F.lit(f"{OPEN}$0{CLOSE}"))
    parts = hit.select(
        "doc_id", "digest", "rule.label", "rule.priority", "rule.confidence",
        F.xxhash64("rule.label", "rule.pattern").alias("rule_id"), F.posexplode(F.split(marked, OPEN)).alias("no", "part"),
    )
    # Every part but the first begins with a match; places are running sums of what lies before.
    length = F.length(F.replace(F.col("part"), F.lit(CLOSE), F.lit("")))
    before = Window.partitionBy("doc_id", "digest", "rule_id").orderBy("no").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        parts.withColumn("begin", F.sum(length).over(before))
        .where("no > 0")
        .withColumn("end", F.col("begin") + F.length(F.substring_index("part", CLOSE, 1)))
    )
    # A place is inside another one if an earlier or longer one reaches as far.
    order = [F.asc("begin"), F.desc("end"), F.desc("priority"), F.asc("label"), F.asc("rule_id")]
    ahead = Window.partitionBy("doc_id", "digest").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        placed.withColumn("covered", F.max("end").over(ahead))
        .where("covered IS NULL OR end > covered")
        .select("doc_id", "digest", "label", "priority", "confidence", "begin", "end")
    )


def scan_licenses(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_detections)."""
    texts = docs.select("doc_id", F.xxhash64("text").alias("digest"), words_of_text(F.col("text")).alias("words"))
    base = base_places(F.col("words"))
    labelled = F.filter(
        F.array(*(F.when(base[p][0] > 0, F.lit(label)) for p, label in BASE.items())), lambda x: x.isNotNull()
    )
    counted = texts.select(
        "doc_id", "digest",
        F.when(F.length("words") > 2, _spaces(F.col("words")) - 1).otherwise(F.lit(0)).cast("long").alias("n_words"),
        sum((b[0] for b in base.values()), F.lit(0).cast("long")).alias("n_base"),
        F.least(*(b[1] for b in base.values())).alias("first_word"),
        F.greatest(*(b[2] for b in base.values())).alias("last_word"),
        labelled.alias("own"),
    )
    gate = _any_word(tuple(sorted({k for r in rules() for k in r.keywords})))
    hints = F.rlike("words", F.lit(HINTS)) | F.rlike("words", F.lit(_numbered_names()))
    found = detections(texts.where(hints & gate).dropDuplicates(["doc_id", "digest"]))
    per_text = found.groupBy("doc_id", "digest").agg(
        F.collect_set("label").alias("found"), F.max("confidence").alias("best"), F.count(F.lit(1)).alias("n")
    )
    other = per_text.withColumnsRenamed({"doc_id": "d", "digest": "g"})
    joined = counted.join(other, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("digest") == F.col("g")), "left")
    empty = F.array().cast("array<string>")
    every = F.array_sort(F.array_union("own", F.coalesce("found", empty)))
    least = F.when(F.col("n_base") > 0, F.lit(BASE_CONFIDENCE)).otherwise(F.lit(0.0))
    return joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("own"), ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.greatest(F.coalesce("best", F.lit(0.0)), least).alias("score"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_detections"),
    )
