"""License scan: ordered signature rules behind a keyword test, overlaps resolved by containment.

1. A text becomes its words, lower-case and one space apart. Rules are regular expressions
   over that; a rule's place in the order is its priority.
2. Keyword test. Each rule names words of which every match holds one; only rules with such
   a word in the text are run.
3. Resolution. A detection goes if its interval lies in the interval of another one whose
   rule comes first, or, under one rule, of a longer one. Detections that merely overlap
   stay. Base phrases stay always.
4. Score. Labels count as independent evidence: 1 - product of (1 - weight), a label with
   the weight of its best rule.

The rules are built from families: names, short names and web addresses times versions,
"only" and "or later", with and without an SPDX tag.

Defined results: null and empty texts have no words, labels or places, and score 0; each row
is scanned by itself, so repeated rows and ids give repeated rows; texts of any length are
handled whole; extra columns are not looked at.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.words import bound_batches

_PIECE = 1 << 20


@dataclass(frozen=True)
class Rule:
    """A signature: ``pattern`` over words one space apart, each match of which holds one of ``keys``."""

    label: str
    pattern: str
    keys: tuple[str, ...]
    weight: float
    base: bool = False


# The phrases that are always reported, and their labels.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# Families of licenses. Label, short name, full name, versions, words of which
# the short name and the full name hold one. Short and full names are patterns over words.
_LICENSES = (
    ("apache", "apache|asl", "apache (?:software )?licen[sc]e", ("1.0", "1.1", "2.0"), "apache asl", "apache"),
    ("mpl", "mpl", "mozilla public licen[sc]e", ("1.0", "1.1", "2.0"), "mpl", "mozilla"),
    ("epl", "epl", "eclipse public licen[sc]e", ("1.0", "2.0"), "epl", "eclipse"),
    ("eupl", "eupl", "european union public licen[sc]e", ("1.0", "1.1", "1.2"), "eupl", "european"),
    ("cddl", "cddl", "common development and distribution licen[sc]e", ("1.0", "1.1"), "cddl", "distribution"),
    ("cpl", "cpl", "common public licen[sc]e", ("0.5", "1.0"), "cpl", "common"),
    ("afl", "afl", "academic free licen[sc]e", ("1.1", "1.2", "2.0", "2.1", "3.0"), "afl", "academic"),
    ("osl", "osl", "open software licen[sc]e", ("1.0", "1.1", "2.0", "2.1", "3.0"), "osl", "software"),
    ("artistic", "artistic", "artistic licen[sc]e", ("1.0", "2.0"), "artistic", "artistic"),
    ("cecill", "cecill", "cecill free software licen[sc]e(?: agreement)?", ("1.0", "1.1", "2.0", "2.1"), "cecill", "cecill"),
    ("ofl", "ofl", "(?:sil )?open font licen[sc]e", ("1.0", "1.1"), "ofl", "font"),
    ("odbl", "odbl", "open database licen[sc]e", ("1.0",), "odbl", "database"),
    ("gfdl", "gfdl|fdl", "(?:gnu )?free documentation licen[sc]e", ("1.1", "1.2", "1.3"), "gfdl fdl", "documentation"),
    ("lppl", "lppl", "latex project public licen[sc]e", ("1.0", "1.1", "1.2"), "lppl", "latex"),
    ("zpl", "zpl", "zope public licen[sc]e", ("1.1", "2.0", "2.1"), "zpl", "zope"),
    ("psf", "psf", "python software foundation licen[sc]e", ("2.0",), "psf", "python"),
    ("npl", "npl", "netscape public licen[sc]e", ("1.0", "1.1"), "npl", "netscape"),
    ("rpl", "rpl", "reciprocal public licen[sc]e", ("1.1", "1.5"), "rpl", "reciprocal"),
    ("sspl", "sspl", "server side public licen[sc]e", ("1.0",), "sspl", "server"),
    ("busl", "busl", "business source licen[sc]e", ("1.0", "1.1"), "busl", "business"),
    ("bsl", "bsl|boost", "boost software licen[sc]e", ("1.0",), "bsl boost", "boost"),
    ("elastic", "elastic", "elastic licen[sc]e", ("1.0", "2.0"), "elastic", "elastic"),
    ("cpal", "cpal", "common public attribution licen[sc]e", ("1.0",), "cpal", "attribution"),
    ("sissl", "sissl", "sun industry standards source licen[sc]e", ("1.1", "1.2"), "sissl", "sun"),
    ("apsl", "apsl", "apple public source licen[sc]e", ("1.0", "1.1", "1.2", "2.0"), "apsl", "apple"),
    ("ms-pl", "ms pl", "microsoft public licen[sc]e", (), "ms", "microsoft"),
    ("ms-rl", "ms rl", "microsoft reciprocal licen[sc]e", (), "ms", "microsoft"),
    ("mit-0", "mit 0", "mit no attribution", (), "mit", "mit"),
    ("mit", "mit", "(?:mit|expat|x11) licen[sc]e", (), "mit", "mit expat x11"),
    ("bsd-4-clause", "bsd 4 clause", "(?:four|4) clause bsd(?: licen[sc]e)?|original bsd licen[sc]e", (), "bsd", "bsd"),
    ("bsd-3-clause", "bsd 3 clause", "(?:three|3) clause bsd(?: licen[sc]e)?|(?:new|modified|revised) bsd licen[sc]e", (), "bsd", "bsd"),
    ("bsd-2-clause", "bsd 2 clause", "(?:two|2) clause bsd(?: licen[sc]e)?|(?:simplified|freebsd) bsd licen[sc]e", (), "bsd", "bsd"),
    ("0bsd", "0bsd", "(?:zero|0) clause bsd(?: licen[sc]e)?", (), "0bsd", "bsd"),
    ("bsd", "bsd", "bsd (?:style )?licen[sc]e", (), "bsd", "bsd"),
    ("isc", "isc", "isc licen[sc]e|internet software consortium licen[sc]e", (), "isc", "isc consortium"),
    ("zlib", "zlib", "zlib(?: libpng)? licen[sc]e", (), "zlib", "zlib"),
    ("unlicense", "unlicense", "the unlicense", (), "unlicense", "unlicense"),
    ("wtfpl", "wtfpl", "do what the fuck you want to public licen[sc]e", (), "wtfpl", "fuck"),
    ("ncsa", "ncsa", "(?:university of illinois )?ncsa open source licen[sc]e", (), "ncsa", "ncsa"),
    ("postgresql", "postgresql", "postgresql licen[sc]e", (), "postgresql", "postgresql"),
    ("openssl", "openssl", "openssl licen[sc]e", (), "openssl", "openssl"),
    ("vim", "vim", "vim licen[sc]e", (), "vim", "vim"),
    ("qpl", "qpl", "q public licen[sc]e", (), "qpl", "q"),
    ("sleepycat", "sleepycat", "sleepycat licen[sc]e", (), "sleepycat", "sleepycat"),
    ("w3c", "w3c", "w3c (?:software )?(?:notice and )?licen[sc]e", (), "w3c", "w3c"),
    ("cc0", "cc0", "creative commons zero|public domain dedication", (), "cc0", "commons dedication"),
)

# The GNU family with "only" and "or later".
_GNU = (
    ("agpl", "(?:gnu )?affero general public licen[sc]e", ("1.0", "3.0"), "affero"),
    ("lgpl", "(?:gnu )?(?:lesser|library) general public licen[sc]e", ("2.0", "2.1", "3.0"), "lesser library"),
    ("gpl", "(?:gnu )?general public licen[sc]e", ("1.0", "2.0", "3.0"), "general"),
)
_LATER = ("or later", "or(?: at your option)? any later(?: version)?|or later(?: version)?|or newer")

# The Creative Commons elements and their names.
_CC = (("by-nc-sa", ("by", "nc", "sa")), ("by-nc-nd", ("by", "nc", "nd")), ("by-nc", ("by", "nc")), ("by-sa", ("by", "sa")), ("by-nd", ("by", "nd")), ("by", ("by",)))
_CC_NAMES = {"by": "attribution", "nc": "non ?commercial", "sa": "share ?alike", "nd": "no ?deriv(?:ative)?s(?: works)?"}
_CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")

# Sentences of licenses and notices. Label, pattern, words of which it holds one, weight.
_SENTENCES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", "hereby", 0.95),
    ("mit", "the software is provided as is without warranty of any kind express or implied", "warranty", 0.7),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee", "fee", 0.95),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution", 0.9),
    ("bsd-3-clause", "nor the names of its contributors may be used to endorse", "endorse", 0.95),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache", 0.97),
    ("apache-2.0", "you may not use this file except in compliance with the license", "compliance", 0.8),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla", 0.97),
    ("gpl", "this program is free software you can redistribute it and or modify it", "redistribute", 0.9),
    ("gpl", "without even the implied warranty of merchantability or fitness for a particular purpose", "merchantability", 0.7),
    ("zlib", "this software is provided as is without any express or implied warranty", "warranty", 0.8),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered", 0.97),
    ("public-domain", "(?:released|placed|dedicated) (?:in|into|to) the public domain", "domain", 0.9),
    ("public-domain", "(?:this work|this file|this text|it) is in the public domain", "domain", 0.9),
    ("public-domain", "public domain", "domain", 0.5),
    ("proprietary", "proprietary and confidential|confidential and proprietary", "proprietary", 0.9),
    ("proprietary", "unauthori[sz]ed (?:copying|use|reproduction|distribution)(?: or (?:copying|use|reproduction|distribution))?(?: of this \\S+)?(?: is)?(?: strictly)? prohibited", "prohibited", 0.9),
    ("proprietary", "no part of this (?:\\S+ )?(?:publication|book|work|document) may be reproduced", "reproduced", 0.9),
    ("proprietary", "not for (?:public )?(?:distribution|redistribution)|do not (?:copy|distribute)", "distribution redistribution copy distribute", 0.5),
    ("no-commercial", "for (?:personal|private) and non ?commercial use only|(?:for )?non ?commercial use only", "commercial noncommercial", 0.8),
    ("no-derivatives", "no derivative works", "derivative", 0.5),
    ("creative-commons", "(?:under|with) a creative commons licen[sc]e", "commons", 0.8),
    ("creative-commons", "creative commons", "commons", 0.6),
    ("open-source", "open source licen[sc]e", "source", 0.5),
    ("copyright", "(?:copyright|©) (?:c |© )?(?:by )?(?:[12][0-9]{3})", "copyright ©", 0.6),
)


def _version(version: str) -> str:
    """Words of a version after a name: 2 0, v2 0, version 2, v 2."""
    major, minor = version.split(".")
    return rf"(?:version |ver |v )?v?{major}" + (rf"(?: {minor})?(?! [0-9](?: |$))" if minor == "0" else f" {minor}")


def _glued(short: str, keys: str, versions) -> tuple[str, ...]:
    """Keys of a short name, also with a version glued on, as in gplv3."""
    return tuple(k + end for k in keys.split() for end in ("", *sorted({f"{v}{n.split('.')[0]}" for n in versions for v in ("v", "")})))


@lru_cache(maxsize=1)
def signature_rules() -> tuple[Rule, ...]:
    """All rules in order of priority: tagged, addressed, named with version, named, sentences, base."""
    tagged, addressed, versioned, named = [], [], [], []

    def add(label, short, name, version, short_keys, name_keys, ending=""):
        number = _version(version) if version else ""
        glue = rf"(?: ?(?:{number}))" if version else ""
        end = rf" (?:{ending})" if ending else ""
        short_words = rf"(?:{short}){glue}{end}"
        tagged.append(Rule(label, rf"spdx licen[sc]e identifier {short_words}", ("identifier",), 0.99))
        into = versioned if version or ending else named
        if version:
            into.append(Rule(label, rf"(?:{name}) {number}{end}", name_keys, 0.95))
            into.append(Rule(label, short_words, short_keys, 0.9))
        else:
            into.append(Rule(label, rf"(?:{name}){end}", name_keys, 0.85))
            into.append(Rule(label, rf"(?:licensed|released|distributed|available|published) under (?:the )?(?:terms of the )?{short_words}", short_keys, 0.8))
            into.append(Rule(label, rf"{short_words} licen[sc]ed?", short_keys, 0.8))

    for kind, elements in _CC:
        short = "cc " + " ".join(elements)
        name = "(?:creative commons )?" + " ".join(_CC_NAMES[e] for e in elements)
        address = "creativecommons org licenses " + " ".join(elements)
        for version in (*_CC_VERSIONS, None):
            label = f"cc-{kind}" + (f"-{version}" if version else "")
            end = rf" {version.replace('.', ' ')}" if version else ""
            addressed.append(Rule(label, address + end, ("creativecommons",), 0.97))
            tail = r"(?: international| unported| generic)?"
            tagged.append(Rule(label, rf"spdx licen[sc]e identifier {short}{end}", ("identifier",), 0.99))
            (versioned if version else named).append(Rule(label, short + end, ("cc",), 0.9 if version else 0.8))
            licence = r"(?: (?:public )?licen[sc]e)?"
            full = name + (rf"{licence}(?: version)?{end}{tail}" if version else r" (?:public )?licen[sc]e")
            (versioned if version else named).append(Rule(label, full, ("attribution",), 0.95 if version else 0.8))
    addressed.append(Rule("cc0", "creativecommons org publicdomain zero 1 0", ("creativecommons",), 0.97))
    for label, name, versions, keys in _GNU:
        for version in versions:
            for ending, words in (_LATER, ("only", "only"), ("", "")):
                own = f"{label}-{version}" + (f"-{ending.replace(' ', '-')}" if ending else "")
                add(own, label, name, version, _glued(label, label, versions), tuple(keys.split()), words)
        addressed.append(Rule(label, rf"gnu org licen[sc]es {label}", ("gnu",), 0.95))
        add(label, label, name, None, (label,), tuple(keys.split()))
    for label, short, name, versions, short_keys, name_keys in _LICENSES:
        for version in versions:
            add(f"{label}-{version}", short, name, version, _glued(short, short_keys, versions), tuple(name_keys.split()))
        add(label, short, name, None, tuple(short_keys.split()), tuple(name_keys.split()))
        first = short.split("|")[0]
        addressed.append(Rule(label, rf"opensource org licenses {first}", ("opensource",), 0.95))
    sentences = [Rule(label, pattern, tuple(keys.split()), weight) for label, pattern, keys, weight in _SENTENCES]
    base = [Rule(label, phrase, (phrase.split()[0],), 0.6, base=True) for phrase, label in BASE]
    return tuple(tagged + addressed + versioned + sentences + named + base)


_LOWER_OR_SPACE = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def _words_of(raw: bytes) -> tuple[bytes, int, set[bytes]]:
    """Words one space apart, with a space at both ends; their number; the distinct ones."""
    plain = raw.translate(_LOWER_OR_SPACE)
    out, count, distinct, at = [b""], 0, set(), 0
    while at < len(plain):
        # Long texts in pieces that end between words, so that few word objects exist at once.
        until = plain.find(b" ", at + _PIECE)
        until = len(plain) if until < 0 else until
        words = plain[at:until].split()
        count += len(words)
        distinct.update(words)
        out += [b" ".join(words)] if words else []
        at = until
    return b" ".join(out) + b" ", count, distinct


def contained(starts: np.ndarray, ends: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Whether each interval lies in one of a smaller rank, or of equal rank and greater length.

    Of equal intervals of one rank the first counts. A prefix maximum over the starts, kept
    in a tree, answers for each interval whether an earlier one reaches beyond its end.
    """
    order = np.lexsort((starts, starts - ends, ranks))
    place = np.searchsorted(np.unique(starts), starts) + 1
    size = int(place.max(initial=0))
    reach = [-1] * (size + 1)
    out = np.zeros(len(starts), bool)
    for i in order:
        at, furthest = int(place[i]), -1
        while at > 0:
            furthest = max(furthest, reach[at])
            at -= at & -at
        end = int(ends[i])
        if furthest >= end:
            out[i] = True
            continue
        at = int(place[i])
        while at <= size:
            reach[at] = max(reach[at], end)
            at += at & -at
    return out


class Scanner:
    """Compiled rules with their keyword index."""

    def __init__(self, rules: tuple[Rule, ...], gated: bool = True):
        self.rules, self.gated = rules, gated
        self.patterns = [re.compile(rb"(?<= )(?:" + r.pattern.encode() + rb")(?= )") for r in rules]
        self.by_key: dict[bytes, list[int]] = {}
        for i, rule in enumerate(rules):
            for key in rule.keys:
                self.by_key.setdefault(key.encode(), []).append(i)
        self.keys = frozenset(self.by_key)

    def detections(self, raw: bytes) -> tuple[int, list[tuple[int, int, int]], bytes]:
        """Number of words; (rule, first word, word after the last) of what stays, in text order."""
        text, count, distinct = _words_of(raw)
        if self.gated:
            asked = sorted({i for key in self.keys & distinct for i in self.by_key[key]})
        else:
            asked = range(len(self.rules))
        found = [(i, m.start(), m.end()) for i in asked for m in self.patterns[i].finditer(text)]
        if not found:
            return count, [], text
        rule, start, end = (np.array(c, np.int64) for c in zip(*found))
        gone = contained(start, end, rule) & ~np.array([self.rules[i].base for i in rule])
        spaces = np.flatnonzero(np.frombuffer(text, np.uint8) == 32)
        first, after = np.searchsorted(spaces, start) - 1, np.searchsorted(spaces, end)
        kept = [(int(f), int(r), int(a)) for r, f, a, g in zip(rule, first, after, gone) if not g]
        return count, [(r, f, a) for f, r, a in sorted(kept)], text

    def score(self, labels) -> float:
        """1 - product of (1 - weight) over labels, each (label, weight) with its best weight."""
        best: dict[str, float] = {}
        for label, weight in labels:
            best[label] = max(best.get(label, 0.0), weight)
        rest = 1.0
        for label in sorted(best):
            rest *= 1.0 - best[label]
        return 1.0 - rest


def _places(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Code points at which words start and end."""
    data = np.frombuffer(raw, np.uint8)
    inside = np.frombuffer(raw.translate(_LOWER_OR_SPACE), np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    before = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return before[edges[::2]], before[edges[1::2]]


_FOUND = pa.list_(
    pa.struct([
        ("label", pa.string()), ("rule", pa.int32()), ("base", pa.bool_()),
        ("first_word", pa.int64()), ("end_word", pa.int64()), ("start", pa.int64()), ("end", pa.int64()),
    ])
)
_FOUND_SQL = (
    "array<struct<label:string,rule:int,base:boolean,first_word:bigint,end_word:bigint,start:bigint,end:bigint>>"
)


@lru_cache(maxsize=4)
def _scanner(rules: tuple[Rule, ...]) -> Scanner:
    return Scanner(rules)


def scan(documents: DataFrame, rules: tuple[Rule, ...] | None = None) -> DataFrame:
    """doc_id, n_words, score and detections of every document.

    ``found`` lists, in text order, label, number of the rule, whether it is a base phrase,
    the words and the code points of the source that the detection spans (ends exclusive).
    """
    bound_batches(documents.sparkSession)
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches):
        scanner = _scanner(signature_rules() if rules is None else rules)
        for batch in batches:
            counts, scores, found = [], [], []
            for raw in batch.column(1):
                raw = raw.as_buffer().to_pybytes() if raw.is_valid else b""
                count, kept, _ = scanner.detections(raw)
                rows = []
                if kept:
                    starts, ends = _places(raw)
                    for i, first, after in kept:
                        rule = scanner.rules[i]
                        rows.append((rule.label, i, rule.base, first, after, int(starts[first]), int(ends[after - 1])))
                counts.append(count)
                scores.append(scanner.score((r[0], scanner.rules[r[1]].weight) for r in rows))
                found.append([dict(zip(("label", "rule", "base", "first_word", "end_word", "start", "end"), r)) for r in rows])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(scores, pa.float64()), pa.array(found, _FOUND)],
                names=["doc_id", "n_words", "score", "found"],
            )

    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_words long, score double, found {_FOUND_SQL}")


def summary(scanned: DataFrame) -> DataFrame:
    """One row per document: numbers of words and base places, labels, score."""
    base = F.filter("found", lambda d: d["base"])

    def joined(found):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda d: d["label"]))), ",")

    words = F.transform(base, lambda d: d["first_word"])
    return scanned.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(words).alias("first_word"),
        F.array_max(words).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.col("found")).alias("labels"),
        "score",
    )
