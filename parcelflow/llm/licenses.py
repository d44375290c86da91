"""License scans by ordered signature rules (operator 7, native).

A text is brought to its words (lower-cased A-Z, runs of other ASCII characters as borders), joined
by single spaces.  A rule is a regex over that line, a label, a priority and a keyword: only rules
whose keyword occurs in the text are matched, and only texts with any of the few root words are
looked at at all.  Matches are places (first word, word after the last).  Of overlapping matches a
place inside a larger one is suppressed, and of two equal places or places that overlap without containment the
one with the better priority (smaller number) stays; equal priorities keep both.

The base rules are the plain phrases; they are never suppressed.  All rules are DataFrame functions;
there is no shuffle but the one that joins a text's surviving labels to it, and only texts that
have matches take part in that.

Defined cases: a null text is an empty text; a text without words has no places; texts are matched
whole; repeated rows are scanned one by one; extra columns are dropped; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.functions.bind import let
from parcelflow.llm.common import text_of

# The base phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Families of licenses - label, keyword that every rule of the family needs, names
# that licenses of the family go by (regexes over words), and versions they come in.
FAMILIES = [
    ("gpl", "gpl", r"gpl", ("1", "2", "3")),
    ("gpl", "general public license", r"(?:gnu )?general public license", ("1", "2", "3")),
    ("lgpl", "lgpl", r"lgpl", ("2", "2 1", "3")),
    ("lgpl", "general public license", r"(?:gnu )?(?:lesser|library) general public license", ("2", "2 1", "3")),
    ("agpl", "agpl", r"agpl", ("1", "3")),
    ("agpl", "affero general public license", r"(?:gnu )?affero general public license", ("1", "3")),
    ("gfdl", "free documentation license", r"(?:gnu )?free documentation license", ("1 1", "1 2", "1 3")),
    ("apache", "apache", r"apache(?: software)? license", ("1 0", "1 1", "2 0", "2")),
    ("mpl", "mozilla public license", r"mozilla public license", ("1 0", "1 1", "2 0")),
    ("mpl", "mpl", r"mpl", ("1 0", "1 1", "2 0")),
    ("epl", "eclipse public license", r"eclipse public license", ("1 0", "2 0")),
    ("edl", "eclipse distribution license", r"eclipse distribution license", ("1 0",)),
    ("cddl", "common development and distribution license", r"common development and distribution license", ("1 0", "1 1")),
    ("cpl", "common public license", r"common public license", ("0 5", "1 0")),
    ("eupl", "european union public licen", r"european union public licen[cs]e", ("1 0", "1 1", "1 2")),
    ("osl", "open software license", r"open software license", ("1 0", "2 0", "2 1", "3 0")),
    ("afl", "academic free license", r"academic free license", ("1 1", "1 2", "2 0", "2 1", "3 0")),
    ("artistic", "artistic license", r"(?:perl )?artistic license", ("1 0", "2 0")),
    ("bsl", "boost software license", r"boost software license", ("1 0",)),
    ("busl", "business source license", r"business source license", ("1 1",)),
    ("elastic", "elastic license", r"elastic license", ("1 0", "2 0")),
    ("sspl", "server side public license", r"server side public license", ("1",)),
    ("zpl", "zope public license", r"zope public license", ("1 1", "2 0", "2 1")),
    ("psf", "python software foundation license", r"python software foundation license", ("1", "2")),
    ("php", "php license", r"php license", ("3 0", "3 01")),
    ("ofl", "open font license", r"(?:sil )?open font license", ("1 0", "1 1")),
    ("odbl", "open database license", r"open database license", ("1 0",)),
    ("odc-by", "open data commons attribution license", r"open data commons attribution license", ("1 0",)),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa open source license", ()),
    ("isc", "isc license", r"isc license", ()),
    ("zlib", "zlib", r"zlib(?: libpng)? license", ()),
    ("wtfpl", "wtfpl", r"wtfpl", ("1", "2")),
    ("unlicense", "unlicense", r"(?:the )?unlicense", ()),
    ("upl", "universal permissive license", r"universal permissive license", ("1 0",)),
    ("mulan", "mulan", r"mulan (?:permissive software|psl) license", ("1", "2")),
    ("ms-pl", "microsoft public license", r"microsoft public license", ()),
    ("ms-rl", "microsoft reciprocal license", r"microsoft reciprocal license", ()),
    ("bsd", "bsd", r"bsd(?: style)? license", ()),
    ("mit", "mit", r"(?:the )?mit(?: x11)? license", ()),
    ("mit", "expat license", r"expat license", ()),
    ("x11", "x11 license", r"x11 license", ()),
    ("vim", "vim license", r"vim license", ()),
    ("openssl", "openssl license", r"openssl license", ()),
    ("cecill", "cecill", r"cecill(?: [bc])?(?: license)?", ("1 0", "1 1", "2 0", "2 1")),
]
# How a notice introduces a license, before its name.
LEAD_INS = [
    r"licensed under (?:the )?(?:terms of )?(?:the )?",
    r"released under (?:the )?(?:terms of )?(?:the )?",
    r"distributed under (?:the )?(?:terms of )?(?:the )?",
    r"covered by (?:the )?",
    r"available under (?:the )?(?:terms of )?(?:the )?",
]
# Creative Commons marks - label, regex over words.
CREATIVE = [
    ("cc-by", r"cc by(?: [1-4] [05])?"),
    ("cc-by-sa", r"cc by sa(?: [1-4] [05])?"),
    ("cc-by-nc", r"cc by nc(?: [1-4] [05])?"),
    ("cc-by-nd", r"cc by nd(?: [1-4] [05])?"),
    ("cc-by-nc-sa", r"cc by nc sa(?: [1-4] [05])?"),
    ("cc-by-nc-nd", r"cc by nc nd(?: [1-4] [05])?"),
    ("cc0", r"cc0(?: 1 0)?(?: universal)?"),
    ("cc-by", r"creative commons attribution(?: [1-4] [05])?(?: international)?(?: license)?"),
    ("cc-by-sa", r"creative commons attribution share ?alike(?: [1-4] [05])?(?: international)?(?: license)?"),
    ("cc-by-nc", r"creative commons attribution non ?commercial(?: [1-4] [05])?(?: international)?(?: license)?"),
    ("cc-by-nd", r"creative commons attribution no ?deriv(?:ative)?s?(?: works)?(?: [1-4] [05])?(?: license)?"),
    ("cc-by-nc-sa", r"creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?(?: license)?"),
    ("cc-by-nc-nd", r"creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?(?: [1-4] [05])?"),
    ("cc0", r"creative commons (?:zero|public domain dedication)"),
]
# Sentences of license texts - label, keyword, regex over words.
SENTENCES = [
    ("mit", "permission is hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", "permission to use copy modify", r"permission to use copy modify and or distribute this software for any purpose"),
    ("bsd", "redistribution and use in source", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3", "neither the name", r"neither the names? of .{1,80}? nor the names of (?:its|their) contributors may be used to endorse"),
    ("gpl", "free software", r"this (?:program|library) is free software you can redistribute it and or modify it"),
    ("public-domain", "public domain", r"(?:released|dedicated|placed)(?: in)?(?: ?to)? the public domain"),
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("zlib", "as is without any express", r"this software is provided as is without any express or implied warranty"),
    ("wtfpl", "do what the", r"do what the f\w+ you want to public license"),
    ("proprietary", "all rights reserved", r"all rights reserved"),
    ("proprietary", "proprietary and confidential", r"proprietary and confidential"),
]
# SPDX identifiers as words, after the tag - label without version, identifier, its
# versions, and whether "only" and "or later" can follow.
SPDX = [
    ("gpl", "gpl", ("1 0", "2 0", "3 0"), True),
    ("lgpl", "lgpl", ("2 0", "2 1", "3 0"), True),
    ("agpl", "agpl", ("1 0", "3 0"), True),
    ("gfdl", "gfdl", ("1 1", "1 2", "1 3"), True),
    ("apache", "apache", ("1 0", "1 1", "2 0"), False),
    ("mpl", "mpl", ("1 0", "1 1", "2 0"), False),
    ("epl", "epl", ("1 0", "2 0"), False),
    ("cddl", "cddl", ("1 0", "1 1"), False),
    ("cpl", "cpl", ("1 0",), False),
    ("eupl", "eupl", ("1 0", "1 1", "1 2"), False),
    ("osl", "osl", ("1 0", "1 1", "2 0", "2 1", "3 0"), False),
    ("afl", "afl", ("1 1", "1 2", "2 0", "2 1", "3 0"), False),
    ("artistic", "artistic", ("1 0", "2 0"), False),
    ("bsl", "bsl", ("1 0",), False),
    ("busl", "busl", ("1 1",), False),
    ("elastic", "elastic", ("2 0",), False),
    ("sspl", "sspl", ("1 0",), False),
    ("zpl", "zpl", ("1 1", "2 0", "2 1"), False),
    ("psf", "(?:psf|python)", ("2 0",), False),
    ("php", "php", ("3 0", "3 01"), False),
    ("ofl", "ofl", ("1 0", "1 1"), False),
    ("odbl", "odbl", ("1 0",), False),
    ("odc-by", "odc by", ("1 0",), False),
    ("upl", "upl", ("1 0",), False),
    ("mulan", "mulanpsl", ("1 0", "2 0"), False),
    ("cecill", "cecill", ("1 0", "1 1", "2 0", "2 1"), False),
    ("cecill", "cecill [bc]", (), False),
    ("bsd-2", "bsd 2 clause", (), False),
    ("bsd-3", "bsd 3 clause", (), False),
    ("bsd-4", "bsd 4 clause", (), False),
    ("0bsd", "0bsd", (), False),
    *[(x, x, (), False) for x in ("mit", "isc", "zlib", "ncsa", "wtfpl", "unlicense", "vim", "openssl", "x11")],
    ("mit-0", "mit 0", (), False),
    ("ms-pl", "ms pl", (), False),
    ("ms-rl", "ms rl", (), False),
    ("cc0", "cc0", ("1 0",), False),
    *[(f"cc-{x.replace(' ', '-')}", f"cc {x}", ("1 0", "2 0", "2 5", "3 0", "4 0"), False)
      for x in ("by", "by sa", "by nc", "by nd", "by nc sa", "by nc nd")],
]
#: A lower-cased text without any of these, and without the mark below, has no match of any rule.
ROOTS = ("licen", "gpl", "mpl", "cc0", "commons", "domain", "cecill", "permission", "redistribut", "endorse",
         "reserved", "warranty", "proprietary", "wtfpl")
MARK = r"cc[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+by"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def rules() -> list[tuple[str, str, str, int]]:
    """(label, keyword, regex, priority) in order; the more a rule says, the better its priority."""
    out = []
    for label, keyword, name, versions in FAMILIES:
        for v in versions:
            number = rf"(?: (?:version )?v?{v})"
            out.append((f"{label}-{v.replace(' ', '.')}", keyword, rf"{name}{number}(?: only)?", 20))
            out.append((f"{label}-{v.replace(' ', '.')}-or-later", keyword,
                        rf"{name}{number} or (?:\(at your option\) |at your option )?(?:any )?later(?: version)?", 10))
        for lead in LEAD_INS:
            out.append((label, keyword, lead + name, 40))
        out.append((label, keyword, name, 50))
        out.append((label, "spdx license identifier", rf"spdx license identifier {name}", 30))
    tag = "spdx license identifier"
    for label, name, versions, later in SPDX:
        for v in versions:
            # A family counts the version 2.0 as 2 if its notices do; Creative Commons marks have none.
            known = next((vs for own, _, _, vs in FAMILIES if own == label), ())
            short = v if v in known or not v.endswith(" 0") else v[:-2]
            full = label if label.startswith("cc") else f"{label}-{short.replace(' ', '.')}"
            out.append((full, tag, rf"{tag} {name} {v}" + ("(?: only)?" if later else ""), 15))
            if later:
                out.append((f"{full}-or-later", tag, rf"{tag} {name} {v} or later", 5))
        if not versions:
            out.append((label, tag, f"{tag} {name}", 15))
    out += [(label, "cc" if regex.startswith("cc") else "creative commons", regex, 45) for label, regex in CREATIVE]
    out += [(label, keyword, regex, 35) for label, keyword, regex in SENTENCES]
    return out


def _words_line(text: Column) -> Column:
    """The words of the text, lower-cased, with one space before, between and after them."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    line = F.regexp_replace(lower, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")
    return F.concat(F.lit(" "), F.trim(line), F.lit(" "))


def _has_root(lower: Column) -> Column:
    # Lower-casing all letters is enough here: no letter outside A-Z becomes one that the roots have
    # but K, which no root has.
    mark = F.contains(lower, F.lit("cc")) & lower.rlike(MARK)
    return reduce(lambda a, b: a | b, [F.contains(lower, F.lit(r)) for r in ROOTS], mark)


def _whole(regex: Column) -> Column:
    return F.concat(F.lit("(?<= )(?:"), regex, F.lit(")(?= )"))


def _count_words(part: Column) -> Column:
    return F.length(part) - F.length(F.replace(part, F.lit(" "), F.lit("")))


def _places(line: Column, regex: Column) -> Column:
    """Array of (start, end) in words of all matches of ``regex`` between spaces."""
    whole = _whole(regex)
    return let(F.struct(F.split(line, whole, -1).alias("out"), F.regexp_extract_all(line, whole, F.lit(0)).alias("hit")),
               lambda m: F.get(F.aggregate(
                   F.zip_with(F.slice(m["out"], 1, F.size(m["hit"])), m["hit"],
                              lambda o, h: F.struct(_count_words(o).alias("gap"), (_count_words(h) + 1).alias("n"))),
                   F.array(F.struct(F.lit(0).alias("at"),
                                    F.expr("cast(array() as array<struct<start:int,end:int>>)").alias("places"))),
                   lambda acc, x: let(F.get(acc, 0), lambda a: F.array(F.struct(
                       # A piece before the first match opens with the line's leading space.
                       (a["at"] + x["gap"] + x["n"] - 1).alias("at"),
                       F.concat(a["places"], F.array(F.struct(
                           (a["at"] + x["gap"] - 1).alias("start"),
                           (a["at"] + x["gap"] - 1 + x["n"]).alias("end")))).alias("places"))))), 0)["places"])


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, matches).

    ``matches`` are the surviving places of all rules as (label, start, end, priority); the score is
    the share of the text's words that lie in the longest of them, at most 1, 0 without a match.
    """
    table = F.array(*[F.struct(F.lit(label).alias("label"), F.lit(keyword).alias("keyword"),
                               F.lit(regex).alias("regex"), F.lit(priority).alias("priority"))
                      for label, keyword, regex, priority in rules()])
    base = F.array(*[F.struct(F.lit(p).alias("phrase"), F.lit(label).alias("label")) for p, label in BASE.items()])
    rows = docs.select("doc_id", text_of().alias("text"), F.lower(text_of()).alias("lower")).select(
        "doc_id", F.regexp_count("text", F.lit(WORD)).cast("long").alias("n_words"),
        F.when(_has_root(F.col("lower")), _words_line(F.col("text"))).alias("line"))
    keywords = F.array(*[F.lit(k) for k in sorted({r[1] for r in rules()})])
    candidates = let(F.filter(keywords, lambda k: F.contains(F.col("line"), k)), lambda held: F.filter(
        table, lambda r: F.array_contains(held, r["keyword"]) & F.rlike(F.col("line"), _whole(r["regex"]))))
    found = F.when(F.col("line").isNotNull(), F.flatten(F.transform(
        candidates,
        lambda r: F.transform(_places(F.col("line"), r["regex"]), lambda p: F.struct(
            p["start"].alias("start"), p["end"].alias("end"), r["priority"].alias("priority"), r["label"].alias("label"))))))
    plain = F.when(F.col("line").isNotNull(), F.flatten(F.transform(
        F.filter(base, lambda r: F.contains(F.col("line"), r["phrase"])),
        lambda r: F.transform(_places(F.col("line"), r["phrase"]), lambda p: F.struct(
            p["start"].alias("start"), p["end"].alias("end"), r["label"].alias("label"))))))
    matched = rows.select("doc_id", "n_words", found.alias("found"), plain.alias("plain"))
    none = F.array().cast("array<string>")

    def beaten(m: Column, o: Column) -> Column:
        overlap = (o["start"] < m["end"]) & (m["start"] < o["end"])
        inside = (o["start"] <= m["start"]) & (m["end"] <= o["end"]) & (
            (o["end"] - o["start"]) > (m["end"] - m["start"]))
        holds = (m["start"] <= o["start"]) & (o["end"] <= m["end"]) & (
            (m["end"] - m["start"]) > (o["end"] - o["start"]))
        return inside | (overlap & ~holds & (o["priority"] < m["priority"]))

    kept = F.filter("found", lambda m: ~F.exists("found", lambda o: beaten(m, o)))
    out = matched.select("doc_id", "n_words", "plain", kept.alias("matches"))
    base_labels = F.coalesce(F.array_distinct(F.transform("plain", lambda p: p["label"])), none)
    more = F.coalesce(F.array_distinct(F.transform("matches", lambda m: m["label"])), none)
    longest = F.array_max(F.transform("matches", lambda m: m["end"] - m["start"]))
    return out.select(
        "doc_id", "n_words", F.coalesce(F.size("plain"), F.lit(0)).cast("long").alias("n_base"),
        F.array_min(F.transform("plain", lambda p: p["start"])).cast("long").alias("first_word"),
        F.array_max(F.transform("plain", lambda p: p["start"])).cast("long").alias("last_word"),
        F.array_join(F.array_sort(base_labels), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base_labels, more)), ",").alias("labels"),
        F.when(longest > 0, F.least(longest / F.col("n_words"), F.lit(1.0))).otherwise(0.0).alias("score"), "matches")
