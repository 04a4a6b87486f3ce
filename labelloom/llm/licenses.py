"""License scans by ordered signature rules.

Several hundred expressions, made from families, versions and ways of naming them (license texts' openings, tags, addresses,
names with versions, glued short names, verbs), run in rule order over a text's words. A rule is tried only if its keyword occurs (one pass
finds all keywords). Where detections overlap, the rule of higher priority (then the longer, then
the earlier rule) wins, and a detection that meets a kept one is suppressed: kept detections are marked on
the text, so each further one is tested against its own stretch alone, however many there are.

Base phrases are counted apart from that and are never suppressed. Null texts are
empty. Positions are counted in words from 0. Repeated rows are scanned like any others; columns besides key and text are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Base phrases and their labels.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Families (label, names, versions).
FAMILIES = [
    ("agpl", ["affero general public license", "gnu agpl", "agpl"], ["3", "3 0", "1 0"]),
    ("lgpl", ["lesser general public license", "library general public license", "gnu lgpl", "lgpl"], ["2", "2 0", "2 1", "3", "3 0"]),
    ("gpl", ["gnu general public license", "general public license", "gnu gpl", "gpl"], ["1", "1 0", "2", "2 0", "3", "3 0"]),
    ("fdl", ["gnu free documentation license", "free documentation license", "gfdl"], ["1 1", "1 2", "1 3"]),
    ("apache", ["apache software license", "apache license", "asl"], ["1 0", "1 1", "2", "2 0"]),
    ("mpl", ["mozilla public license", "mpl"], ["1 0", "1 1", "2 0"]),
    ("epl", ["eclipse public license", "epl"], ["1 0", "2 0"]),
    ("cddl", ["common development and distribution license", "cddl"], ["1 0", "1 1"]),
    ("cpl", ["common public license"], ["0 5", "1 0"]),
    ("eupl", ["european union public licence", "eupl"], ["1 0", "1 1", "1 2"]),
    ("artistic", ["artistic license", "perl artistic license"], ["1 0", "2 0"]),
    ("bsl", ["boost software license"], ["1 0"]),
    ("osl", ["open software license"], ["1 0", "2 0", "2 1", "3 0"]),
    ("afl", ["academic free license"], ["1 1", "1 2", "2 0", "2 1", "3 0"]),
    ("psf", ["python software foundation license", "psf license"], ["2", "2 0"]),
    ("zpl", ["zope public license"], ["1 1", "2 0", "2 1"]),
    ("ofl", ["sil open font license", "open font license"], ["1 0", "1 1"]),
    ("php", ["php license"], ["3 0", "3 01"]),
    ("mit", ["mit license", "expat license", "x11 license"], []),
    ("isc", ["isc license", "internet systems consortium license"], []),
    ("zlib", ["zlib license", "zlib libpng license"], []),
    ("bsd", ["bsd license", "bsd style license", "berkeley software distribution license"], []),
    ("unlicense", ["the unlicense", "unlicense"], []),
    ("wtfpl", ["wtfpl"], []),
    ("cc0", ["creative commons zero", "cc0"], ["1 0"]),
    ("public-domain", ["public domain dedication", "dedicated to the public domain"], []),
]
# Short names by which a family is tagged or referred to (the names of the tags).
SHORT = {
    "agpl": "agpl", "lgpl": "lgpl", "gpl": "gpl", "fdl": "gfdl", "apache": "apache", "mpl": "mpl", "epl": "epl", "cddl": "cddl", "cpl": "cpl",
    "eupl": "eupl", "artistic": "artistic", "bsl": "bsl", "osl": "osl", "afl": "afl", "psf": "psf", "zpl": "zpl", "ofl": "ofl", "php": "php",
    "mit": "mit", "isc": "isc", "zlib": "zlib", "bsd": "bsd", "unlicense": "unlicense", "wtfpl": "wtfpl", "cc0": "cc0",
}
# Addresses of license texts (label, words of the address before a version, the word looked for first, versions follow).
ADDRESSES = [
    ("apache", "apache org licenses license", "apache", True),
    ("apache", "apache org licenses", "apache", False),
    ("mit", "opensource org licenses? mit", "opensource", False),
    ("bsd", "opensource org licenses? bsd(?: [23] clause| license)?", "opensource", False),
    ("apache", "opensource org licenses? apache", "opensource", True),
    ("isc", "opensource org licenses? isc", "opensource", False),
    ("gpl", "opensource org licenses? gpl", "opensource", True),
    ("lgpl", "opensource org licenses? lgpl", "opensource", True),
    ("mpl", "opensource org licenses? mpl", "opensource", True),
    ("gpl", "gnu org (?:licenses|copyleft)(?: old licenses)? gpl", "gnu", True),
    ("lgpl", "gnu org (?:licenses|copyleft)(?: old licenses)? lgpl", "gnu", True),
    ("agpl", "gnu org licenses agpl", "gnu", True),
    ("fdl", "gnu org licenses fdl", "gnu", True),
    ("mpl", "mozilla org mpl", "mozilla", True),
    ("epl", "eclipse org (?:org documents|legal) epl", "eclipse", True),
    ("bsl", "boost org license", "boost", True),
    ("ofl", "scripts sil org ofl", "sil", False),
    ("unlicense", "unlicense org", "unlicense", False),
    ("cc0", "creativecommons org publicdomain zero", "creativecommons", True),
]
CC_KINDS = ["by", "by sa", "by nc", "by nd", "by nc sa", "by nc nd"]
# Long names of the parts of a kind.
CC_PARTS = {"by": "attribution", "sa": "share ?alike", "nc": "non ?commercial", "nd": "no ?deriv(?:ative)?s?(?: works)?"}
CC_VERSIONS = ["1 0", "2 0", "2 5", "3 0", "4 0"]
# Opening words of license texts.
OPENINGS = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose"),
    ("bsd", "redistribution and use in source and binary forms with or without modification"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("zlib", "this software is provided as is without any express or implied warranty"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("proprietary", "all rights reserved"),
    ("proprietary", "confidential and proprietary"),
]

# Lower-case ASCII letters and digits and every byte of other characters make words.
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


@dataclass(frozen=True)
class Rule:
    """`pattern` is matched on words joined and surrounded by single blanks."""

    label: str
    keyword: bytes
    pattern: re.Pattern[bytes]
    priority: int
    weight: float


@lru_cache(maxsize=1)
def rules() -> tuple[Rule, ...]:
    """All rules in order: openings, tags, addresses, named with version, named with a verb, bare names."""
    out: list[Rule] = []

    def add(label: str, body: str, keyword: str, priority: int, weight: float) -> None:
        out.append(Rule(label, keyword.encode(), re.compile(f"(?<= )(?:{body})(?= )".encode()), priority, weight))

    for label, words in OPENINGS:
        add(label, words, max(words.split(), key=len), 100 if label != "proprietary" else 40, 1.0 if label != "proprietary" else 0.5)
    for label, names, versions in FAMILIES:
        short = SHORT.get(label)
        under = "(?:licensed|released|distributed|available|published) under (?:the )?(?:terms of (?:the )?)?"
        later = "(?: only| or later| or any later version)?"
        for version in versions if short else []:
            full = f"{label}-{version.replace(' ', '.')}"
            glued = f"{short}v{version.split()[0]}"
            add(full, f"spdx license identifier {short} v?{version}{later}", "spdx", 92, 1.0)
            add(full, f"{short}v{version}{later}", glued, 80, 0.95)
            if label in ("apache", "artistic", "zpl", "ofl", "cpl", "osl", "afl"):
                add(full, f"{short} (?:v(?:ersion)? ?)?{version}", short, 75, 0.85)
            add(full, f"{under}{short} (?:license )?(?:v(?:ersion)? ?)?{version}{later}", short, 78, 0.9)
        if short:
            add(label, f"spdx license identifier {short}(?: [0-9]+)*{later}", "spdx", 90, 1.0)
            add(label, f"{under}{short}", short, 65, 0.85)
        for name in names:
            key = max(name.split(), key=len)
            for version in versions:
                add(f"{label}-{version.replace(' ', '.')}", f"{name}(?: version| v)? v?{version}(?: only| or later| or any later version)?", key, 80, 0.95)
            if len(name.split()) > 1:
                add(label, f"(?:licensed|released|distributed|available|published) under (?:the )?(?:terms of (?:the )?)?{name}", key, 70, 0.9)
                add(label, f"(?:subject to|governed by|covered by) (?:the )?(?:terms of (?:the )?)?{name}", key, 70, 0.9)
                add(label, name, key, 60, 0.8)
    versions_of = {label: versions for label, _, versions in FAMILIES}
    for label, words, key, versioned in ADDRESSES:
        for version in versions_of[label] if versioned else []:
            add(f"{label}-{version.replace(' ', '.')}", f"{words} v?{version}", key, 88, 0.95)
            if " 0" in version:
                add(f"{label}-{version.replace(' ', '.')}", f"{words} v?{version.replace(' ', '')}", key, 88, 0.95)
        add(label, words, key, 86, 0.95)
    for kind in CC_KINDS:
        label = f"cc-{kind.replace(' ', '-')}"
        written = " ".join(CC_PARTS[part] for part in kind.split())
        for version in CC_VERSIONS:
            full = f"{label}-{version.replace(' ', '.')}"
            add(full, f"cc {kind} {version}", "cc", 80, 0.95)
            add(full, f"creative commons (?:{written}|{kind})(?: v(?:ersion)?)? {version}", "commons", 82, 0.95)
            add(full, f"creative commons (?:{written}|{kind}) (?:international |unported |generic )?(?:public )?licen[sc]e(?: v(?:ersion)?)? {version}", "commons", 82, 0.95)
            add(full, f"creativecommons org licenses {kind} {version}", "creativecommons", 88, 0.95)
        add(label, f"creative commons (?:{written}|(?:attribution )?{kind})", "commons", 60, 0.8)
        add(label, f"creativecommons org licenses {kind}", "creativecommons", 86, 0.95)
    for clauses in ("2", "3", "4", "two", "three", "four"):
        add("bsd", f"{clauses} clause bsd(?: license)?|bsd {clauses} clause(?: license)?", "clause", 80, 0.95)
    return tuple(out)


@lru_cache(maxsize=1)
def _keywords():
    from ahocorasick import Automaton

    found, table = Automaton(), {}
    for i, rule in enumerate(rules()):
        table.setdefault(rule.keyword, []).append(i)
    for word, owners in table.items():
        found.add_word(f" {word.decode()} ", tuple(owners))
    found.make_automaton()
    return found


def detect(line: bytes) -> list[tuple[str, int, int, float]]:
    """Kept detections (label, first byte, end byte, weight) in the blank-joined words `line`."""
    tried = sorted({i for _, owners in _keywords().iter(line.decode("latin-1")) for i in owners})
    hits = []
    for i in tried:
        rule = rules()[i]
        hits += [(rule.priority, m.end() - m.start(), -i, m.start(), m.end()) for m in rule.pattern.finditer(line)]
    hits.sort(reverse=True)
    kept: list[tuple[int, int, int]] = []
    taken, mark = bytearray(len(line)), bytes([1])
    for _, _, order, a, b in hits:
        if taken.find(mark, a, b) < 0:
            taken[a:b] = mark * (b - a)
            kept.append((a, b, -order))
    return [(rules()[i].label, a, b, rules()[i].weight) for a, b, i in sorted(kept)]


def scan(text: str) -> tuple[int, int, int | None, int | None, str, str, float]:
    """n_words, n_base, first_word, last_word, base_labels, labels, score of one text."""
    words = text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split(b" ")
    words = [w for w in words if w]
    line = b" " + b" ".join(words) + b" "
    if b" license " not in line and not any(True for _ in _keywords().iter(line.decode("latin-1"))):
        return len(words), 0, None, None, "", "", 0.0
    places, base = [], set()
    for phrase, label in BASE_PHRASES.items():
        wanted = b" " + phrase.encode() + b" "
        at = line.find(wanted)
        while at >= 0:
            places.append(at)
            base.add(label)
            at = line.find(wanted, at + 1)
    found = detect(line)
    labels = base | {label for label, *_ in found}
    score = max([0.8 if base else 0.0, *(w for *_, w in found)])
    word_at = lambda at: line.count(b" ", 0, at)
    first, last = (word_at(min(places)), word_at(max(places))) if places else (None, None)
    return len(words), len(places), first, last, ",".join(sorted(base)), ",".join(sorted(labels)), score


def license_scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The columns of `scan` for every row of `docs`; key first."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [scan(t.as_py() or "") for t in batch.column(1)]
            columns = [pa.array(c, k) for c, k in zip(zip(*found), kinds)] if found else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
    narrow = docs.select(F.col(f"`{key}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return narrow.mapInArrow(
        work,
        "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double",
    )


def license_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, label, first_word, end_word, weight): every kept detection."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                line = b" " + b" ".join((t.as_py() or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()) + b" "
                rows += [(k, label, line.count(b" ", 0, a) - 1, line.count(b" ", 0, b), w) for label, a, b, w in detect(line)]
            columns = zip(*rows) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    names, kinds = ["doc_id", "label", "first_word", "end_word", "weight"], [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64()]
    narrow = docs.select(F.col(f"`{key}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return narrow.mapInArrow(work, "doc_id bigint, label string, first_word bigint, end_word bigint, weight double")
