"""Licence scan: ordered signature rules behind a keyword prefilter.

A text becomes its words (A-Z lower-cased, runs of letters, digits and
non-ASCII bytes) joined by single spaces.  A rule runs only on texts that hold
all its keywords.  Every match is a detection; one that lies inside a detection
of higher priority (or of equal priority, longer or earlier in rule order) is
suppressed, so "mit license" does not count again inside "licensed under the
mit license".  A detection that says less than another of the same notice (a
name without version near one with, "all rights reserved" near any licence) is
suppressed too; base phrases are always counted.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType)

from .arrow import chunks

DETECTION = StructType([
    StructField("rule", StringType()), StructField("label", StringType()), StructField("priority", IntegerType()),
    StructField("first_word", LongType()), StructField("last_word", LongType()), StructField("base", BooleanType()),
    StructField("kept", BooleanType())])

# Word bytes of a text: 0-9 a-z and everything above ASCII; A-Z are lower-cased.
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


@dataclass(frozen=True)
class Rule:
    name: str
    label: str
    priority: int            # 0-100; also the rule's confidence in per cent
    keywords: frozenset      # words a text must hold for the pattern to be tried
    pattern: str             # over words joined by single spaces
    base: bool = False
    identifier: str = ""     # SPDX identifier as words, for the further terms of an expression


# Words between two detections of one notice.
NOTICE_WORDS = 100

# What a label says less than, within a notice.  "proprietary" says less than any.
GENERAL = {
    "apache": ("apache-1.1", "apache-2"),
    "gpl": ("gpl-2", "gpl-3"),
    "lgpl": ("lgpl-2", "lgpl-2.1", "lgpl-3"),
    "agpl": ("agpl-3",),
    "bsd": ("bsd-0", "bsd-2", "bsd-3", "bsd-4"),
    "mpl": ("mpl-1.1", "mpl-2"),
    "epl": ("epl-1", "epl-2"),
}

# The phrases of the contract.
BASE_PHRASES = [
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
]


def _major(n: int) -> str:
    """Version n or n.0 as words."""
    return rf"(?:v |version )?(?:v{n}|{n})(?: 0)?"


def _gnu(label: str, name: str, version: int, minor: str, spdx: str) -> list[tuple]:
    """Abbreviation and version, one row for each way to join them."""
    rows = [(label, name, rf"(?:gnu )?{name} (?:v |version )?(?:v{version}|{version}){minor}", spdx),
            (label, f"{name}{version}", rf"(?:gnu )?{name}{version}{minor}", None),
            (label, f"{name}v{version}", rf"(?:gnu )?{name}v{version}{minor}", None)]
    return rows + [(label, f"{name}{v}", rf"(?:gnu )?{name}{v} (?:v{version}|{version}){minor}", None) for v in ("v", "version")]


_CC = r"(?: [1234] [05](?: international| unported| generic)?)?"

# Licence names as word patterns; the keywords, words that every string of the
# pattern holds, gate the forms below.
# (label, keywords, name pattern, SPDX identifier as words or None)
NAMES = [
    ("mit", "mit", r"mit(?: x11| expat)?", "mit"),
    ("apache-2", "apache", rf"apache(?: software)?(?: license)? {_major(2)}", "apache 2 0"),
    ("apache-1.1", "apache", r"apache(?: software)?(?: license)? (?:v |version )?(?:v1|1) 1", "apache 1 1"),
    ("apache", "apache", r"apache(?: software)?", "apache"),
    *_gnu("gpl-2", "gpl", 2, "(?: 0)?", "gpl 2 0(?: only| or later)?"),
    *_gnu("gpl-3", "gpl", 3, "(?: 0)?", "gpl 3 0(?: only| or later)?"),
    ("gpl-2", "gplv2", None, "gplv2"),
    ("gpl-3", "gplv3", None, "gplv3"),
    ("gpl", "gpl", r"(?:gnu )?gpl", None),
    ("gpl", "general", r"(?:gnu )?general public", "gpl"),
    *_gnu("lgpl-2.1", "lgpl", 2, " 1", "lgpl 2 1(?: only| or later)?"),
    *_gnu("lgpl-3", "lgpl", 3, "(?: 0)?", "lgpl 3 0(?: only| or later)?"),
    ("lgpl", "lgpl", r"(?:gnu )?lgpl", None),
    ("lgpl", "lesser", r"(?:gnu )?lesser general public", "lgpl"),
    *_gnu("agpl-3", "agpl", 3, "(?: 0)?", "agpl 3 0(?: only| or later)?"),
    ("agpl", "agpl", r"(?:gnu )?agpl", None),
    ("agpl", "affero", r"(?:gnu )?affero general public", "agpl"),
    ("bsd-2", "bsd", r"(?:simplified |freebsd )?(?:bsd 2 clause(?: simplified| freebsd)?|2 clause bsd)", "bsd 2 clause"),
    ("bsd-3", "bsd", r"(?:new |modified |revised )?(?:bsd 3 clause(?: new or revised| new| modified| revised)?|3 clause bsd)", "bsd 3 clause"),
    ("bsd-4", "bsd", r"(?:original )?(?:bsd 4 clause(?: original or old| original| old)?|4 clause bsd)", "bsd 4 clause"),
    ("bsd-0", "bsd", r"(?:zero clause bsd|bsd zero clause)", "0bsd"),
    ("bsd-0", "0bsd", r"0bsd", None),
    ("bsd", "bsd", r"bsd(?: style)?", "bsd"),
    ("mpl-1.1", "mozilla", r"mozilla public(?: license)? (?:v |version )?(?:v1|1) 1", "mpl 1 1"),
    ("mpl-2", "mozilla", rf"mozilla public(?: license)? {_major(2)}", "mpl 2 0"),
    ("mpl", "mozilla", r"mozilla public", None),
    ("mpl-1.1", "mpl", r"mpl (?:v |version )?(?:v1|1) 1", None),
    ("mpl-2", "mpl", rf"mpl {_major(2)}", None),
    ("mpl", "mpl", r"mpl(?: 2 0| 1 1)?", "mpl"),
    ("epl-1", "eclipse", rf"eclipse public(?: license)? {_major(1)}", "epl 1 0"),
    ("epl-2", "eclipse", rf"eclipse public(?: license)? {_major(2)}", "epl 2 0"),
    ("epl", "eclipse", r"eclipse public", None),
    ("epl-1", "epl", rf"epl {_major(1)}", None),
    ("epl-2", "epl", rf"epl {_major(2)}", None),
    ("epl", "epl", r"epl", None),
    ("edl", "eclipse", r"eclipse distribution", "edl 1 0"),
    ("cddl", "cddl", r"cddl(?: 1 [01])?", "cddl 1 [01]"),
    ("cddl", "distribution", r"common development and distribution", "cddl"),
    ("cpl", "common", r"common public", "cpl 1 0"),
    ("isc", "isc", r"isc", "isc"),
    ("zlib", "zlib", r"zlib(?: libpng)?", "zlib"),
    ("bsl", "boost", r"boost software", "bsl 1 0"),
    ("unlicense", "unlicense", r"unlicense", "unlicense"),
    ("wtfpl", "wtfpl", r"wtfpl", "wtfpl"),
    ("artistic", "artistic", r"(?:perl )?artistic(?: license)?(?: (?:version )?[12](?: 0)?)?", "artistic [12] 0"),
    ("ofl", "ofl", r"(?:sil )?ofl(?: 1 1)?", "ofl 1 1"),
    ("ofl", "font", r"(?:sil )?open font", "ofl"),
    ("odbl", "odbl", r"odbl(?: 1 0)?", "odbl 1 0"),
    ("odbl", "database", r"open database", "odbl"),
    ("odc-by", "odc", r"odc by", "odc by 1 0"),
    ("pddl", "pddl", r"pddl", "pddl 1 0"),
    ("python", "python", r"python software foundation", "python 2 0"),
    ("php", "php", r"php(?: license)? (?:version )?3 0[01]?", "php 3 01"),
    ("ruby", "ruby", r"ruby", "ruby"),
    ("postgresql", "postgresql", r"postgresql", "postgresql"),
    ("openssl", "openssl", r"openssl", "openssl"),
    ("ms-pl", "microsoft", r"microsoft public", "ms pl"),
    ("ms-rl", "microsoft", r"microsoft reciprocal", "ms rl"),
    ("eupl", "eupl", r"eupl(?: 1 [12])?", "eupl 1 [12]"),
    ("osl", "osl", r"osl(?: 3 0)?", "osl 3 0"),
    ("afl", "academic", r"academic free", "afl 3 0"),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa", "ncsa"),
    ("upl", "universal", r"universal permissive", "upl 1 0"),
    ("gfdl", "documentation", r"(?:gnu )?free documentation", "gfdl 1 [123]"),
    ("cc0", "cc0", r"cc0(?: 1 0(?: universal)?)?", "cc0 1 0"),
    ("cc-by", "cc", rf"cc by{_CC}", "cc by [1234] [05]"),
    ("cc-by-sa", "cc", rf"cc by sa{_CC}", "cc by sa [1234] [05]"),
    ("cc-by-nd", "cc", rf"cc by nd{_CC}", "cc by nd [1234] [05]"),
    ("cc-by-nc", "cc", rf"cc by nc{_CC}", "cc by nc [1234] [05]"),
    ("cc-by-nc-sa", "cc", rf"cc by nc sa{_CC}", "cc by nc sa [1234] [05]"),
    ("cc-by-nc-nd", "cc", rf"cc by nc nd{_CC}", "cc by nc nd [1234] [05]"),
    ("cc-by", "creative commons attribution", rf"creative commons attribution{_CC}", "cc by"),
    ("cc-by-sa", "creative commons attribution", rf"creative commons attribution share ?alike{_CC}", "cc by sa"),
    ("cc-by-nc", "creative commons attribution", rf"creative commons attribution non ?commercial{_CC}", "cc by nc"),
    ("cc-by-nd", "creative commons attribution", rf"creative commons attribution no ?deriv(?:ative)?s{_CC}", "cc by nd"),
    ("cc-by-nc-sa", "creative commons attribution", rf"creative commons attribution non ?commercial share ?alike{_CC}", "cc by nc sa"),
    ("cc-by-nc-nd", "creative commons attribution", rf"creative commons attribution non ?commercial no ?deriv(?:ative)?s{_CC}", "cc by nc nd"),
]

# Forms in which a name is stated: (form, priority, extra keywords, pattern).
# ``{n}`` is the name, ``{s}`` its SPDX identifier.
FORMS = [
    ("spdx", 100, ("spdx",), "spdx licen[cs]e identifier {s}"),
    ("licensed", 90, ("licensed",), "licensed under (?:the )?(?:terms of (?:the )?)?{n}(?: licen[cs]e)?"),
    ("released", 85, ("released",), "released under (?:the )?(?:terms of (?:the )?)?{n}(?: licen[cs]e)?"),
    ("distributed", 85, ("distributed",), "distributed under (?:the )?(?:terms of (?:the )?)?{n}(?: licen[cs]e)?"),
    ("under", 80, ("under",), "under (?:the )?(?:terms of (?:the )?)?{n} licen[cs]e"),
    ("named", 60, (), "{n} licen[cs]e"),
]

# Names that hold the word licence before the version: (label, keywords, pattern).
# They stand in the forms "under" and "named" as they are.
VERSIONED = [(label, keys, rf"{name} licen[cs]e {version}") for label, keys, name, version in [
    ("apache-2", "apache", "apache(?: software)?", _major(2)),
    ("apache-1.1", "apache", "apache(?: software)?", "(?:v |version )?(?:v1|1) 1"),
    ("gpl-2", "general public", "(?:gnu )?general public", _major(2)),
    ("gpl-3", "general public", "(?:gnu )?general public", _major(3)),
    ("lgpl-2.1", "lesser general public", "(?:gnu )?lesser general public", "(?:v |version )?(?:v2|2) 1"),
    ("lgpl-3", "lesser general public", "(?:gnu )?lesser general public", _major(3)),
    ("agpl-3", "affero general public", "(?:gnu )?affero general public", _major(3)),
    ("mpl-1.1", "mozilla public", "mozilla public", "(?:v |version )?(?:v1|1) 1"),
    ("mpl-2", "mozilla public", "mozilla public", _major(2)),
    ("epl-1", "eclipse public", "eclipse public", _major(1)),
    ("epl-2", "eclipse public", "eclipse public", _major(2)),
]]

# Creative Commons names that need no word licence beside them: (label, keywords, pattern).
_CC_VERSION = r"[1234] [05](?: international| unported| generic)?"
BARE = [
    ("cc-by", "cc by", rf"cc by {_CC_VERSION}"),
    ("cc-by-sa", "cc by sa", rf"cc by sa {_CC_VERSION}"),
    ("cc-by-nd", "cc by nd", rf"cc by nd {_CC_VERSION}"),
    ("cc-by-nc", "cc by nc", rf"cc by nc {_CC_VERSION}"),
    ("cc-by-nc-sa", "cc by nc sa", rf"cc by nc sa {_CC_VERSION}"),
    ("cc-by-nc-nd", "cc by nc nd", rf"cc by nc nd {_CC_VERSION}"),
    ("cc-by", "creative commons attribution", rf"creative commons attribution {_CC_VERSION}"),
    ("cc-by-sa", "creative commons attribution", rf"creative commons attribution share ?alike {_CC_VERSION}"),
    ("cc-by-nd", "creative commons attribution", rf"creative commons attribution no ?deriv(?:ative)?s {_CC_VERSION}"),
    ("cc-by-nc", "creative commons attribution", rf"creative commons attribution non ?commercial {_CC_VERSION}"),
    ("cc-by-nc-sa", "creative commons attribution", rf"creative commons attribution non ?commercial share ?alike {_CC_VERSION}"),
    ("cc-by-nc-nd", "creative commons attribution", rf"creative commons attribution non ?commercial no ?deriv(?:ative)?s {_CC_VERSION}"),
    ("cc0", "cc0", r"(?:creative commons )?cc0 1 0(?: universal)?"),
    ("cc0", "creative commons zero", r"creative commons zero (?:v1|1) 0(?: universal)?"),
]

# File headers that state the version after the name: (label, keywords, pattern).
_TERMS = r"(?:(?:you can redistribute it and or modify it )?under the terms of )?(?:the )?"
_FSF = r"as published by the free software foundation"
_GNU_HEADER = "general published foundation"
HEADERS = [
    ("gpl-2", _GNU_HEADER, rf"{_TERMS}gnu general public licen[cs]e {_FSF} (?:either )?version 2(?: 0)?(?: of the licen[cs]e)?"),
    ("gpl-3", _GNU_HEADER, rf"{_TERMS}gnu general public licen[cs]e {_FSF} (?:either )?version 3(?: 0)?(?: of the licen[cs]e)?"),
    ("gpl-2", _GNU_HEADER, rf"{_TERMS}gnu general public licen[cs]e {_major(2)} {_FSF}"),
    ("gpl-3", _GNU_HEADER, rf"{_TERMS}gnu general public licen[cs]e {_major(3)} {_FSF}"),
    ("lgpl-2", _GNU_HEADER + " library",
     rf"{_TERMS}gnu library general public licen[cs]e {_FSF} (?:either )?version 2(?: 0)?(?: of the licen[cs]e)?"),
    ("lgpl-2.1", _GNU_HEADER + " lesser",
     rf"{_TERMS}gnu lesser general public licen[cs]e {_FSF} (?:either )?version 2 1(?: of the licen[cs]e)?"),
    ("lgpl-3", _GNU_HEADER + " lesser",
     rf"{_TERMS}gnu lesser general public licen[cs]e {_FSF} (?:either )?version 3(?: 0)?(?: of the licen[cs]e)?"),
    ("lgpl-2.1", _GNU_HEADER + " lesser", rf"{_TERMS}gnu lesser general public licen[cs]e (?:v |version )?(?:v2|2) 1 {_FSF}"),
    ("lgpl-3", _GNU_HEADER + " lesser", rf"{_TERMS}gnu lesser general public licen[cs]e {_major(3)} {_FSF}"),
    ("agpl-3", _GNU_HEADER + " affero",
     rf"{_TERMS}gnu affero general public licen[cs]e {_FSF} (?:either )?version 3(?: 0)?(?: of the licen[cs]e)?"),
    ("agpl-3", _GNU_HEADER + " affero", rf"{_TERMS}gnu affero general public licen[cs]e {_major(3)} {_FSF}"),
    ("bsd-0", "copy fee granted", r"permission to use copy modify and or distribute this software for any purpose with or without "
                                  r"fee is hereby granted the software is provided as is"),
]

# Sentences of licence texts: (label, keywords, pattern).  "apache" tells the
# first of apache-2 from other licences that hold it.
TEXTS = [
    ("mit", ("granted", "charge"), r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", ("sublicense",), r"use copy modify merge publish distribute sublicense and or sell copies"),
    ("apache-2", ("apache",), r"you may not use this file except in compliance with the licen[cs]e"),
    ("apache-2", ("apache", "licenses"), r"www apache org licenses licen[cs]e 2 0"),
    ("bsd", ("redistribution", "binary"), r"redistribution and use in source and binary forms"),
    ("bsd-3", ("endorse",), r"neither the name of [^ ]+(?: [^ ]+){0,12} may be used to endorse or promote products"),
    ("gpl", ("redistribute", "general"), r"you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", ("redistribute", "lesser"), r"you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("agpl", ("affero",), r"under the terms of the gnu affero general public license"),
    ("isc", ("copy", "fee"), r"permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("zlib", ("implied",), r"this software is provided as is without any express or implied warranty"),
    ("unlicense", ("unencumbered",), r"free and unencumbered software released into the public domain"),
    ("cc0", ("waive",), r"waive all copyright and related or neighboring rights"),
    ("public-domain", ("domain",), r"(?:in|into|to) the public domain"),
    ("wtfpl", ("fuck",), r"do what the fuck you want to public license"),
    ("proprietary", ("reserved",), r"all rights reserved"),
    ("cc-by", ("creativecommons",), r"creativecommons org licenses by [1234] [05]"),
    ("cc-by-sa", ("creativecommons",), r"creativecommons org licenses by sa [1234] [05]"),
    ("cc-by-nd", ("creativecommons",), r"creativecommons org licenses by nd [1234] [05]"),
    ("cc-by-nc", ("creativecommons",), r"creativecommons org licenses by nc [1234] [05]"),
    ("cc-by-nc-sa", ("creativecommons",), r"creativecommons org licenses by nc sa [1234] [05]"),
    ("cc-by-nc-nd", ("creativecommons",), r"creativecommons org licenses by nc nd [1234] [05]"),
    ("cc0", ("creativecommons",), r"creativecommons org publicdomain zero 1 0"),
]


def default_rules() -> list[Rule]:
    """The base phrases, then every name in every form, then the versioned
    names, the bare names, the headers and the sentences."""
    out = [Rule(f"base:{p}", label, 70, frozenset(p.split()), p, True) for p, label in BASE_PHRASES]
    for label, key, name, spdx in NAMES:
        for form, priority, extra, pattern in FORMS:
            if (spdx if form == "spdx" else name) is None:
                continue
            keys = frozenset(extra) if form == "spdx" else frozenset((*key.split(), *extra))
            out.append(Rule(f"{form}:{label}:{key}", label, priority, keys, pattern.format(n=f"(?:{name})", s=spdx),
                            identifier=spdx if form == "spdx" else ""))
    for label, keys, name in VERSIONED:
        for form, priority, extra, before in (("under", 80, ("under",), "under (?:the )?(?:terms of (?:the )?)?"), ("named", 60, (), "")):
            for verb in ("", "licensed ", "released ", "distributed ") if extra else ("",):
                prio = {"licensed ": 90, "released ": 85, "distributed ": 85}.get(verb, priority)
                words = frozenset((*keys.split(), *extra, *verb.split()))
                out.append(Rule(f"{verb.strip() or form}-version:{label}", label, prio, words, f"{verb}{before}{name}"))
    out += [Rule(f"bare:{label}:{i}", label, 60, frozenset(keys.split()), p) for i, (label, keys, p) in enumerate(BARE)]
    out += [Rule(f"header:{label}:{i}", label, 96, frozenset(keys.split()), p) for i, (label, keys, p) in enumerate(HEADERS)]
    out += [Rule(f"text:{label}:{i}", label, 95, frozenset(keys), p) for i, (label, keys, p) in enumerate(TEXTS)]
    return out


_SPDX = re.compile(rb"(?<![^ ])spdx licen[cs]e identifier(?= )")
_EXCEPTION = re.compile(rb" with(?: [^ ]+){1,4}? (?:exception|note)(?: [0-9] [0-9])?(?![^ ])")
_JOIN = re.compile(rb" (?:or|and)(?= )")


class Scanner:
    """Compiled rules, filed under one of their keywords."""

    def __init__(self, rules: list[Rule]):
        self.rules = rules
        self.by_key: dict[bytes, list] = {}
        for i, r in enumerate(rules):
            keys = frozenset(k.encode() for k in r.keywords)
            regex = re.compile(rb"(?<![^ ])(?:" + r.pattern.encode() + rb")(?![^ ])")
            self.by_key.setdefault(max(keys, key=lambda k: (len(k), k)), []).append((i, keys, regex))
        self.identifiers = [(i, re.compile(rb" (?:" + r.identifier.encode() + rb")(?![^ ])"))
                            for i, r in enumerate(rules) if r.identifier]

    def further_terms(self, line: bytes) -> Iterator[tuple]:
        """Start, end and rule of the second and later identifiers of SPDX
        expressions (joined by OR and AND, exceptions after WITH passed over)."""
        for head in _SPDX.finditer(line):
            at, first = head.end(), True
            while True:
                terms = [(m.end(), -i) for i, regex in self.identifiers if (m := regex.match(line, at))]
                if not terms:
                    break
                end, i = max(terms)
                if not first:
                    yield at + 1, end, -i
                exception = _EXCEPTION.match(line, end)
                join = _JOIN.match(line, exception.end() if exception else end)
                if join is None:
                    break
                at, first = join.end(), False

    def _general(self, found: list[tuple]) -> list[tuple]:
        """Detections that say less than a kept one of the same notice are not kept."""
        places = defaultdict(list)  # label -> first words, ascending; "" stands for any licence
        for i, first, _, kept in found:
            label = self.rules[i].label
            if kept:
                places[label].append(first)
                if label != "proprietary":
                    places[""].append(first)

        def near(label: str, first: int) -> bool:
            at = places[label]
            k = bisect_left(at, first - NOTICE_WORDS)
            return k < len(at) and at[k] <= first + NOTICE_WORDS

        out = []
        for i, first, last, kept in found:
            label = self.rules[i].label
            fuller = ("",) if label == "proprietary" else GENERAL.get(label, ())
            out.append((i, first, last, kept and (self.rules[i].base or not any(near(f, first) for f in fuller))))
        return out

    def scan(self, text: bytes) -> tuple[int, list[tuple]]:
        """Number of words; (rule, first word, last word, kept) by place."""
        words = text.translate(_WORDS).split()
        have = set(words)
        hits = []
        for key in have & self.by_key.keys():
            for i, keys, regex in self.by_key[key]:
                if keys <= have:
                    hits.append((i, regex))
        if not hits:
            return len(words), []
        line = b" ".join(words)
        found = [(m.start(), m.end(), i) for i, regex in hits for m in regex.finditer(line)]
        if b"spdx" in have:
            found += self.further_terms(line)
        if not found:
            return len(words), []
        found.sort(key=lambda d: (d[0], -d[1], -self.rules[d[2]].priority, d[2]))
        ends = np.cumsum([len(w) + 1 for w in words])
        reach: dict[int, int] = {}  # priority -> furthest end so far
        out = []
        for start, end, i in found:
            p = self.rules[i].priority
            inside = any(q >= p and to >= end for q, to in reach.items())
            reach[p] = max(reach.get(p, 0), end)
            first, last = np.searchsorted(ends, [start, end - 1], "right")
            out.append((i, int(first), int(last), not inside))
        return len(words), self._general(out)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  rules: list[Rule] | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, detections``.

    ``detections`` lists every match by place: rule, label, priority, first and
    last word (from 0), whether the rule is a base phrase, and whether the
    detection was kept.  Null and empty texts have 0 words and no detections;
    repeated rows are scanned each; an empty table gives an empty result.
    Whole texts are scanned.  Other columns are ignored, whatever their names.
    """
    rules = default_rules() if rules is None else rules
    id_field = docs.select(F.col(f"`{id_col}`").alias("doc_id")).schema.fields[0]
    schema = StructType([id_field, StructField("n_words", LongType()), StructField("detections", ArrayType(DETECTION))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        kind = pa.list_(pa.struct([
            ("rule", pa.string()), ("label", pa.string()), ("priority", pa.int32()), ("first_word", pa.int64()),
            ("last_word", pa.int64()), ("base", pa.bool_()), ("kept", pa.bool_())]))
        for batch in chunks(batches, "text"):
            counts, lists = [], []
            for text in batch.column("text").to_pylist():
                n, found = scanner.scan(text or b"")
                counts.append(n)
                lists.append([
                    {"rule": r.name, "label": r.label, "priority": r.priority, "first_word": a, "last_word": b,
                     "base": r.base, "kept": kept}
                    for i, a, b, kept in found for r in (rules[i],)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(lists, kind)],
                names=["doc_id", "n_words", "detections"])

    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("binary").alias("text")
                       ).mapInArrow(run, schema)
