"""License scans: ordered signature rules behind a keyword gate, in DataFrame functions only.

A text becomes its words, joined by single spaces.  Each rule is a regular expression
over such words, blind to the case of A-Z, with keywords that every match holds; the
words of a text that are keywords (one set intersection) pick the rules that run on it,
so a text without any is not searched at all.  Matches are spans of words.

Overlaps are resolved as follows.  Rules have a priority (0 strongest: a tag, then
a link, a grant, a title, a bare name) and an order.  A match that lies within the span of
another one that is stronger, or equally strong and longer or of an earlier rule, is suppressed.
Matches are sorted by start, longest first, so one pass with the furthest end
seen at each priority decides.  The pass goes in chunks, which keeps what it
appends short, so the cost follows the number of matches.

Everything happens inside the row: the plan has one scan, no exchange and no
Python, and no source, key or group of copies can gather rows in one task.

Defined results: a null text counts as empty, which has no words, no spans, no labels and score 0;
a phrase broken by punctuation or line ends is found, as only words count;
very long texts are scanned whole; rows are scanned one by one, so repeated ids and rows stay;
an empty table gives an empty result; extra columns are passed over (``scan``) whatever their names.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NOT_WORDS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
ANY_CASE = "(?i)"  # of A-Z only, as no Unicode flag is set
MARK = "\x01"  # never part of a word
CHUNK = 1000

TAG, LINK, GRANT, TITLE, NAME = range(5)
WEIGHTS = (1.0, 0.95, 0.9, 0.75, 0.5)  # how sure a match of each priority is

# The phrases of the base scan and their labels.
BASE_PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
BASE_KEYWORDS = {"under the mit license": "mit", "apache license version 2": "apache", "cc by nc": "nc"}
BASE_WEIGHT = 0.9

_V = r"(?:v ?|ver(?:sion)? ?)?"
_LATER = r"(?: (?:or|and) (?:\(at your option\) )?(?:any )?(?:later|newer)(?: versions?)?| only)?"
_GNU = r"(?:gnu )?"

# (label, keyword, the license's name in words, whether the name alone is a reference)
NAMES = [
    ("mit", "mit", r"(?:the )?mit(?: x11| expat)?", False),
    ("mit", "expat", r"expat", False),
    ("mit-0", "attribution", r"mit no attribution", True),
    ("x11", "x11", r"x11", False),
    ("apache-1", "apache", r"apache(?: software)?(?: licen[cs]e)? " + _V + r"1(?: [01])?", True),
    ("apache-2", "apache", r"apache(?: software)?(?: licen[cs]e)? " + _V + r"2(?: 0)?", True),
    ("apache-2", "asl2", r"asl2", True),
    ("apache", "apache", r"apache(?: software)?", False),
    ("bsd-2-clause", "bsd", r"(?:bsd (?:2|two) clause|(?:2|two) clause bsd|simplified bsd|freebsd)", True),
    ("bsd-3-clause", "bsd", r"(?:bsd (?:3|three) clause|(?:3|three) clause bsd|(?:new|revised|modified) bsd)", True),
    ("bsd-4-clause", "bsd", r"(?:bsd (?:4|four) clause|(?:4|four) clause bsd|original bsd)", True),
    ("0bsd", "0bsd", r"0bsd", True),
    ("bsd", "bsd", r"bsd(?: style)?", False),
    ("gpl-1.0", "gpl", _GNU + r"gpl " + _V + r"1(?: 0)?" + _LATER, True),
    ("gpl-2.0", "gpl", _GNU + r"gpl " + _V + r"2(?: 0)?" + _LATER, True),
    ("gpl-2.0", "gplv2", _GNU + r"gplv2" + _LATER, True),
    ("gpl-3.0", "gpl", _GNU + r"gpl " + _V + r"3(?: 0)?" + _LATER, True),
    ("gpl-3.0", "gplv3", _GNU + r"gplv3" + _LATER, True),
    ("gpl", "gpl", _GNU + r"gpl", True),
    ("gpl-1.0", "general", _GNU + r"general public licen[cs]e(?: gpl)? " + _V + r"1(?: 0)?" + _LATER, True),
    ("gpl-2.0", "general", _GNU + r"general public licen[cs]e(?: gpl)? " + _V + r"2(?: 0)?" + _LATER, True),
    ("gpl-3.0", "general", _GNU + r"general public licen[cs]e(?: gpl)? " + _V + r"3(?: 0)?" + _LATER, True),
    ("gpl", "general", _GNU + r"general public", False),
    ("lgpl-2.0", "lgpl", _GNU + r"lgpl " + _V + r"2(?: 0)?" + _LATER, True),
    ("lgpl-2.1", "lgpl", _GNU + r"lgpl " + _V + r"2 1" + _LATER, True),
    ("lgpl-3.0", "lgpl", _GNU + r"lgpl " + _V + r"3(?: 0)?" + _LATER, True),
    ("lgpl-3.0", "lgplv3", _GNU + r"lgplv3" + _LATER, True),
    ("lgpl", "lgpl", _GNU + r"lgpl", True),
    ("lgpl-2.1", "lesser", _GNU + r"lesser general public licen[cs]e(?: lgpl)? " + _V + r"2 1" + _LATER, True),
    ("lgpl-3.0", "lesser", _GNU + r"lesser general public licen[cs]e(?: lgpl)? " + _V + r"3(?: 0)?" + _LATER, True),
    ("lgpl", "lesser", _GNU + r"lesser general public", False),
    ("lgpl-2.0", "library", _GNU + r"library general public", False),
    ("agpl-3.0", "agpl", _GNU + r"agpl " + _V + r"3(?: 0)?" + _LATER, True),
    ("agpl-3.0", "agplv3", _GNU + r"agplv3" + _LATER, True),
    ("agpl", "agpl", _GNU + r"agpl", True),
    ("agpl-3.0", "affero", _GNU + r"affero general public licen[cs]e(?: agpl)? " + _V + r"3(?: 0)?" + _LATER, True),
    ("agpl", "affero", _GNU + r"affero general public", False),
    ("gfdl", "gfdl", _GNU + r"gfdl(?: 1 [123])?", True),
    ("gfdl", "documentation", r"gnu free documentation", False),
    ("mpl-1.1", "mpl", r"mpl " + _V + r"1 [01]", True),
    ("mpl-2.0", "mpl", r"mpl " + _V + r"2(?: 0)?", True),
    ("mpl-1.1", "mozilla", r"mozilla public licen[cs]e(?: mpl)? " + _V + r"1 [01]", True),
    ("mpl-2.0", "mozilla", r"mozilla public licen[cs]e(?: mpl)? " + _V + r"2(?: 0)?", True),
    ("mpl", "mozilla", r"mozilla public", False),
    ("epl-1.0", "epl", r"epl " + _V + r"1(?: 0)?", True),
    ("epl-2.0", "epl", r"epl " + _V + r"2(?: 0)?", True),
    ("epl", "eclipse", r"eclipse public", False),
    ("edl", "eclipse", r"eclipse distribution", False),
    ("cddl-1.0", "cddl", r"cddl(?: " + _V + r"1 [01])?", True),
    ("cddl-1.0", "development", r"common development and distribution", False),
    ("cpl-1.0", "common", r"common public", False),
    ("eupl", "eupl", r"eupl(?: " + _V + r"1 [12])?", True),
    ("eupl", "european", r"european union public", False),
    ("isc", "isc", r"isc", False),
    ("zlib", "zlib", r"zlib(?: libpng)?", False),
    ("libpng", "libpng", r"libpng", False),
    ("unlicense", "unlicense", r"(?:the )?unlicense", True),
    ("wtfpl", "wtfpl", r"wtfpl", True),
    ("bsl-1.0", "boost", r"boost software", False),
    ("artistic-1.0", "artistic", r"artistic licen[cs]e " + _V + r"1(?: 0)?", True),
    ("artistic-2.0", "artistic", r"artistic licen[cs]e " + _V + r"2(?: 0)?", True),
    ("artistic", "artistic", r"artistic", False),
    ("psf-2.0", "python", r"python software foundation", False),
    ("php-3.01", "php", r"php", False),
    ("ruby", "ruby", r"ruby", False),
    ("openssl", "openssl", r"openssl", False),
    ("postgresql", "postgresql", r"postgresql", False),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa(?: open source)?", False),
    ("w3c", "w3c", r"w3c(?: software(?: notice)?(?: and)?)?", False),
    ("ofl-1.1", "ofl", r"(?:sil )?ofl(?: 1 [01])?", True),
    ("ofl-1.1", "sil", r"sil open font", False),
    ("ms-pl", "microsoft", r"microsoft public", False),
    ("ms-rl", "microsoft", r"microsoft reciprocal", False),
    ("odbl", "odbl", r"odbl(?: 1 0)?", True),
    ("odbl", "database", r"open (?:data commons )?(?:open )?database", False),
    ("upl-1.0", "universal", r"universal permissive", False),
    ("osl-3.0", "open", r"open software", False),
    ("afl-3.0", "academic", r"academic free", False),
    ("bsl-1.1", "business", r"business source", False),
    ("elastic-2.0", "elastic", r"elastic", False),
    ("sspl-1.0", "sspl", r"sspl", True),
    ("sspl-1.0", "side", r"server side public", False),
    ("openrail", "openrail", r"(?:bigscience |creativeml )?openrail(?: m)?", True),
    ("llama", "llama", r"llama [23](?: [123])? community", False),
    ("cc0", "cc0", r"cc0(?: 1 0)?(?: universal)?", True),
    ("cc-by", "cc", r"cc by(?: [1-4] [05])?", True),
    ("cc-by-sa", "cc", r"cc by sa(?: [1-4] [05])?", True),
    ("cc-by-nd", "cc", r"cc by nd(?: [1-4] [05])?", True),
    ("cc-by-nc", "cc", r"cc by nc(?: [1-4] [05])?", True),
    ("cc-by-nc-sa", "cc", r"cc by nc sa(?: [1-4] [05])?", True),
    ("cc-by-nc-nd", "cc", r"cc by nc nd(?: [1-4] [05])?", True),
    ("cc-by", "commons", r"creative commons by(?: [1-4] [05])?", True),
    ("cc-by-sa", "commons", r"creative commons by sa(?: [1-4] [05])?", True),
    ("cc-by-nd", "commons", r"creative commons by nd(?: [1-4] [05])?", True),
    ("cc-by-nc", "commons", r"creative commons by nc(?: [1-4] [05])?", True),
    ("cc-by-nc-sa", "commons", r"creative commons by nc sa(?: [1-4] [05])?", True),
    ("cc-by-nc-nd", "commons", r"creative commons by nc nd(?: [1-4] [05])?", True),
    ("cc-by", "commons", r"creative commons attribution(?: [1-4] [05])?(?: international)?", True),
    ("cc-by-sa", "commons", r"creative commons attribution sharealike(?: [1-4] [05])?(?: international)?", True),
    ("cc-by-nc", "commons", r"creative commons attribution noncommercial(?: [1-4] [05])?(?: international)?", True),
    ("cc-by-nd", "commons", r"creative commons attribution noderivatives(?: [1-4] [05])?(?: international)?", True),
    ("cc-by-nc-sa", "commons", r"creative commons attribution noncommercial sharealike(?: [1-4] [05])?", True),
    ("cc-by-nc-nd", "commons", r"creative commons attribution noncommercial noderivatives(?: [1-4] [05])?", True),
    ("creative-commons", "commons", r"creative commons", False),
]

# What stands around a name: (priority, words of which one is there, pattern); {0} is the name.
FORMS = [
    (TAG, ["spdx"], r"spdx licen[cs]e identifier {0}(?: or later| only)?"),
    (GRANT, ["under"], r"(?:licen[cs]ed|released|distributed|published|provided|available|shared|offered|redistribute|covered)"
                       r"(?: [^ ]+){{0,4}}? under (?:the )?(?:terms (?:and conditions )?of (?:the )?)?{0}(?: licen[cs]e)?"),
    (TITLE, ["license", "licence"], r"{0} licen[cs]e(?: agreement)?"),
]

# (priority, label, keyword, pattern): links and sentences that name no license but are one's text.
TEXTS = [
    (LINK, "mit", "opensource", r"opensource org licenses mit"),
    (LINK, "bsd-3-clause", "opensource", r"opensource org licenses bsd 3 clause"),
    (LINK, "bsd-2-clause", "opensource", r"opensource org licenses bsd 2 clause"),
    (LINK, "isc", "opensource", r"opensource org licenses isc"),
    (LINK, "apache-2", "apache", r"apache org licenses license 2 0"),
    (LINK, "gpl-2.0", "gnu", r"gnu org (?:licenses|copyleft) (?:old licenses )?gpl 2 0"),
    (LINK, "gpl-3.0", "gnu", r"gnu org (?:licenses|copyleft) gpl 3 0"),
    (LINK, "gpl", "gnu", r"gnu org (?:licenses|copyleft) gpl"),
    (LINK, "lgpl", "gnu", r"gnu org (?:licenses|copyleft) lgpl(?: [23] [01])?"),
    (LINK, "agpl", "gnu", r"gnu org (?:licenses|copyleft) agpl(?: 3 0)?"),
    (LINK, "mpl-2.0", "mozilla", r"mozilla org (?:en us )?mpl 2 0"),
    (LINK, "epl-2.0", "eclipse", r"eclipse org legal epl (?:v20|2 0)"),
    (LINK, "cc-by", "creativecommons", r"creativecommons org licenses by [1-4] [05]"),
    (LINK, "cc-by-sa", "creativecommons", r"creativecommons org licenses by sa [1-4] [05]"),
    (LINK, "cc-by-nd", "creativecommons", r"creativecommons org licenses by nd [1-4] [05]"),
    (LINK, "cc-by-nc", "creativecommons", r"creativecommons org licenses by nc [1-4] [05]"),
    (LINK, "cc-by-nc-sa", "creativecommons", r"creativecommons org licenses by nc sa [1-4] [05]"),
    (LINK, "cc-by-nc-nd", "creativecommons", r"creativecommons org licenses by nc nd [1-4] [05]"),
    (LINK, "cc0", "creativecommons", r"creativecommons org publicdomain zero 1 0"),
    (LINK, "unlicense", "unlicense", r"unlicense org"),
    (GRANT, "mit", "permission", r"permission is hereby granted free of charge to any person obtaining a copy"),
    (GRANT, "mit", "merchantability", r"the software is provided as is without warranty of any kind"
                                      r" express or implied including but not limited to the warranties of merchantability"),
    (GRANT, "isc", "permission", r"permission to use copy modify and or distribute this software for any purpose with or without fee"),
    (GRANT, "bsd", "redistribution", r"redistribution and use in source and binary forms with or without modification are permitted"),
    (GRANT, "bsd-3-clause", "endorse", r"neither the name of (?:[^ ]+ ){1,8}?nor the names of (?:its|their) contributors may be used to endorse"),
    (GRANT, "bsd-4-clause", "advertising", r"all advertising materials mentioning features or use of this software must display"),
    (GRANT, "apache-2", "apache", r"you may not use this file except in compliance with the license you may obtain a copy of the license"
                                  r" at http (?:www )?apache org licenses license 2 0"),
    (GRANT, "zlib", "arising", r"in no event will the authors be held liable for any damages arising from the use of this software"),
    (GRANT, "unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain"),
    (GRANT, "public-domain", "domain", r"(?:released|dedicated|placed|is|are) (?:in|into|to) the public domain"),
    (GRANT, "public-domain", "waive", r"waived? all (?:copyright and related|of (?:his|her|their) rights)"),
    (GRANT, "gpl", "redistribute", r"you can redistribute it and or modify it under the terms of the gnu general public license"),
    (GRANT, "wtfpl", "fuck", r"you just do what the fuck you want to"),
    (GRANT, "proprietary", "proprietary", r"(?:confidential and proprietary|proprietary and confidential)"),
    (GRANT, "proprietary", "unauthorized", r"unauthorized (?:copying|reproduction|distribution|use)(?: [^ ]+){0,8}? (?:prohibited|forbidden)"),
    (GRANT, "proprietary", "permission", r"(?:may|must) not be (?:copied|reproduced|distributed|redistributed)(?: [^ ]+){0,10}? without"
                                         r"(?: [^ ]+){0,4}? permission"),
    (TITLE, "all-rights-reserved", "reserved", r"all rights (?:are )?reserved"),
    (TITLE, "all-rights-reserved", "rights", r"(?:tous droits|todos los derechos|alle rechte) (?:r[^ ]serv[^ ]s|reservados|vorbehalten)"),
    (TITLE, "copyright-notice", "copyright", r"copyright (?:c )?(?:19|20)[0-9]{2}(?: (?:19|20)[0-9]{2})?(?: by)?"),
    (TITLE, "public-domain", "domain", r"public domain"),
    (TITLE, "open-source", "source", r"open source licen[cs]e"),
    (TITLE, "commercial", "commercial", r"(?:commercial|enterprise|end user) licen[cs]e(?: agreement)?"),
    (NAME, "non-commercial", "commercial", r"(?:for )?non commercial (?:use|purposes)(?: only)?"),
]

_RULE = "struct<rank:int,priority:int,label:string,keyword:string,also:array<string>,pattern:string>"


def whole(pattern: str) -> str:
    """The pattern between word boundaries of a space-joined text."""
    return f"{ANY_CASE}(?<![^ ])(?:{pattern})(?![^ ])"


def rules() -> list[dict]:
    """All signature rules in order: every name in every form, bare names where they are references, the texts."""
    found = [(priority, label, keyword, also, form.format(name)) for priority, also, form in FORMS for label, keyword, name, _ in NAMES]
    found += [(NAME, label, keyword, [], name) for label, keyword, name, alone in NAMES if alone]
    found += [(priority, label, keyword, [], pattern) for priority, label, keyword, pattern in TEXTS]
    ordered = sorted(found, key=lambda r: r[0])  # stable: the tables' order within a priority
    return [
        {"rank": k, "priority": p, "label": label, "keyword": keyword, "also": also, "pattern": whole(pattern)}
        for k, (p, label, keyword, also, pattern) in enumerate(ordered)
    ]


def words_text(text: Column) -> Column:
    """The words of a text joined by single spaces, in their own case."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), NOT_WORDS, " "))


def n_words(joined: Column) -> Column:
    spaces = F.octet_length(joined) - F.octet_length(F.replace(joined, F.lit(" "), F.lit("")))
    return F.when(joined == "", F.lit(0)).otherwise(spaces + 1)


def spans(joined: Column, pattern: Column) -> Column:
    """(start, end) of every match of ``pattern`` in words, in order; linear in the text."""
    marked = F.split(F.regexp_replace(joined, pattern, F.lit(MARK + "$0")), " ", -1)
    starts = F.filter(F.transform(marked, lambda w, i: F.when(F.startswith(w, F.lit(MARK)), i)), lambda i: i.isNotNull())
    matches = F.regexp_extract_all(joined, pattern, F.lit(0))
    pairs = F.arrays_zip(starts.alias("s"), matches.alias("m"))
    return F.transform(pairs, lambda x: F.struct(x["s"].alias("start"), (x["s"] + n_words(x["m"])).alias("end")))


def keywords_in(joined: Column, table: list[dict]) -> Column:
    """The gate: the rules' keywords that are among the words (lower() finds all of them; the rules decide)."""
    wanted = {k for r in table for k in (r["keyword"], *r["also"])} | set(BASE_KEYWORDS.values())
    keywords = F.array(*(F.lit(k) for k in sorted(wanted)))
    return F.array_intersect(F.split(F.lower(joined), " ", -1), keywords)


def found_spans(joined: Column, present: Column, table: list[dict]) -> Column:
    """Every match of every rule whose keyword is present, sorted by start, longest and strongest first.

    ``present`` must be a column of its own: an expression would be evaluated again for each rule.
    """
    all_rules, none = (F.from_json(F.lit(json.dumps(t)), f"array<{_RULE}>") for t in (table, []))
    open_rules = F.filter(all_rules, lambda r: F.array_contains(present, r["keyword"]) & (
        (F.size(r["also"]) == 0) | F.arrays_overlap(present, r["also"])))
    gated = F.when(F.size(present) > 0, open_rules).otherwise(none)

    def of_rule(r: Column) -> Column:
        at = F.when(F.rlike(joined, r["pattern"]), spans(joined, r["pattern"])).otherwise(F.array())
        return F.transform(at, lambda x: F.struct(
            x["start"].alias("start"), (-x["end"]).alias("back"), r["priority"].alias("priority"), r["rank"].alias("rank"),
            r["label"].alias("label")))

    return F.array_sort(F.flatten(F.transform(gated, of_rule)))


def kept_spans(sorted_spans: Column) -> Column:
    """``sorted_spans`` without those that lie within a stronger, or earlier equally strong, one."""
    reach = F.array(*(F.lit(0) for _ in WEIGHTS))

    def seen(state: Column, x: Column) -> Column:
        end = -x["back"]
        inside = F.get(state["reach"], x["priority"]) >= end
        return F.struct(
            F.transform(state["reach"], lambda far, p: F.when(p >= x["priority"], F.greatest(far, end)).otherwise(far)).alias("reach"),
            F.concat(state["now"], F.when(inside, F.lit("0")).otherwise(F.lit("1"))).alias("now"),
            state["done"].alias("done"),
        )

    def chunk(state: Column, k: Column) -> Column:
        return F.aggregate(
            F.slice(sorted_spans, k * CHUNK + 1, CHUNK),
            F.struct(state["reach"].alias("reach"), F.lit("").alias("now"), state["done"].alias("done")),
            seen,
            lambda s: F.struct(s["reach"].alias("reach"), F.concat(s["done"], s["now"]).alias("done")),
        )

    chunks = F.sequence(F.lit(0), F.floor((F.size(sorted_spans) - 1) / CHUNK).cast("int"))
    flags = F.aggregate(chunks, F.struct(reach.alias("reach"), F.lit("").alias("done")), chunk, lambda s: F.split(s["done"], ""))
    pairs = F.arrays_zip(sorted_spans.alias("span"), flags.alias("stays"))
    decided = F.transform(F.filter(pairs, lambda x: x["stays"] == "1"), lambda x: x["span"])
    return F.when(F.size(sorted_spans) == 0, sorted_spans).otherwise(decided)


def scan(docs: DataFrame, text_col: str = "text", table: list[dict] | None = None) -> DataFrame:
    """(doc, n_words, base, detections): ``doc`` is the row as it came.

    ``base`` has (label, start, end) of every place of the base phrases, ``detections``
    (start, end, priority, rule, label) of the signature rules' matches that are not suppressed.
    """
    table = rules() if table is None else table
    rows = docs.select(F.struct("*").alias("doc"), words_text(docs[text_col]).alias("joined"))

    def place(phrase: str, label: str) -> Column:
        pattern = F.lit(whole(phrase))
        there = F.array_contains("present", BASE_KEYWORDS[phrase]) & F.rlike("joined", pattern)
        at = F.when(there, spans(F.col("joined"), pattern)).otherwise(F.array())
        return F.transform(at, lambda x: F.struct(F.lit(label).alias("label"), x["start"].alias("start"), x["end"].alias("end")))

    base = F.flatten(F.array(*(place(*p) for p in BASE_PHRASES.items())))
    rows = rows.select("doc", "joined", keywords_in(F.col("joined"), table).alias("present"))
    rows = rows.select("doc", n_words(F.col("joined")).cast("long").alias("n_words"), base.alias("base"),
                       found_spans(F.col("joined"), F.col("present"), table).alias("found"))
    rows = rows.select("doc", "n_words", "base", kept_spans(F.col("found")).alias("kept"))
    detections = F.transform("kept", lambda x: F.struct(
        x["start"].alias("start"), (-x["back"]).alias("end"), x["priority"].alias("priority"), x["rank"].alias("rule"),
        x["label"].alias("label")))
    return rows.select("doc", "n_words", "base", detections.alias("detections"))


def labels_of(*found: Column) -> Column:
    """Distinct labels of arrays of spans, sorted and comma-joined."""
    return F.array_join(F.array_sort(F.array_distinct(F.concat(*(f["label"] for f in found)))), ",")


def score(base: Column, detections: Column) -> Column:
    """The weight of the surest span, 0 without any."""
    weights = F.array(*(F.lit(w) for w in WEIGHTS))
    best = F.array_max(F.transform(detections, lambda x: F.get(weights, x["priority"])))
    return F.greatest(F.when(F.size(base) > 0, F.lit(BASE_WEIGHT)).otherwise(F.lit(0.0)), F.coalesce(best, F.lit(0.0)))
