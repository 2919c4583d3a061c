"""License scan: ordered signature rules behind a keyword gate, with suppression of contained detections.

Base phrases are places where the words of a phrase stand consecutively. The
method adds labels by regular expressions over the words of a text joined by one
space: a rule is tried only where its keyword occurs, detections are intervals,
and one that lies inside another goes; of equal intervals the rule of higher
priority stays. Texts without any license word are counted and otherwise left
alone. Rules read a text in segments that overlap by more than any match, each behind
the gate again, so what a text costs grows with its length. Everything is a row
expression: no shuffle, no Python.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Base phrases and their labels; names, identifiers and texts of licenses.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
NAMES = {
    "gpl-2.0": ["gnu general public licen[cs]e(?: as published by the free software foundation)? version 2", "gnu gpl v ?2", "gpl ?v2", "gplv2"],
    "gpl-3.0": ["gnu general public licen[cs]e(?: as published by the free software foundation)? version 3", "gnu gpl v ?3", "gpl ?v3", "gplv3"],
    "gpl": ["gnu general public licen[cs]e", "gnu gpl", "gpl licen[cs]e"],
    "lgpl-2.1": ["gnu lesser general public licen[cs]e version 2 1", "lgpl ?v?2 1"],
    "lgpl-3.0": ["gnu lesser general public licen[cs]e version 3", "lgpl ?v?3"],
    "lgpl": ["gnu lesser general public licen[cs]e", "gnu library general public licen[cs]e", "lgpl licen[cs]e"],
    "agpl-3.0": ["gnu affero general public licen[cs]e(?: version 3)?", "agpl ?v?3"],
    "gfdl": ["gnu free documentation licen[cs]e"],
    "apache-2.0": ["apache licen[cs]e(?: version)? 2 0", "apache 2 0 licen[cs]e", "apache licen[cs]e v ?2"],
    "apache": ["apache licen[cs]e", "apache software licen[cs]e"],
    "mit": ["mit licen[cs]e", "mit x11 licen[cs]e", "expat licen[cs]e"],
    "bsd-2-clause": ["bsd 2 clause(?: licen[cs]e)?", "simplified bsd licen[cs]e", "two clause bsd licen[cs]e"],
    "bsd-3-clause": ["bsd 3 clause(?: licen[cs]e)?", "new bsd licen[cs]e", "modified bsd licen[cs]e", "three clause bsd licen[cs]e"],
    "bsd": ["bsd licen[cs]e", "bsd style licen[cs]e"],
    "mpl-2.0": ["mozilla public licen[cs]e(?: version| v)? ?2 0", "mpl 2 0"],
    "mpl": ["mozilla public licen[cs]e"],
    "epl": ["eclipse public licen[cs]e(?: version| v)?(?: [12] 0)?"],
    "cddl": ["common development and distribution licen[cs]e"],
    "isc": ["isc licen[cs]e"],
    "zlib": ["zlib licen[cs]e", "zlib libpng licen[cs]e"],
    "boost": ["boost software licen[cs]e"],
    "artistic": ["artistic licen[cs]e(?: 2 0)?", "perl artistic licen[cs]e"],
    "eupl": ["european union public licen[cs]e"],
    "ofl": ["sil open font licen[cs]e", "open font licen[cs]e"],
    "python": ["python software foundation licen[cs]e", "psf licen[cs]e"],
    "unlicense": ["the unlicense"],
    "wtfpl": ["do what the fuck you want to public licen[cs]e", "wtfpl"],
    "odbl": ["open database licen[cs]e", "odc open database licen[cs]e"],
    "cc0": ["creative commons zero", "cc0 1 0", "creative commons cc0"],
    "cc-by-sa": ["cc by sa", "creative commons attribution share ?alike"],
    "cc-by-nc": ["cc by nc", "creative commons attribution non ?commercial"],
    "cc-by-nd": ["cc by nd", "creative commons attribution no ?derivatives", "creative commons attribution no ?derivs"],
    "cc-by-nc-sa": ["cc by nc sa", "creative commons attribution non ?commercial share ?alike"],
    "cc-by-nc-nd": ["cc by nc nd", "creative commons attribution non ?commercial no ?deriv(?:ative)?s"],
    "cc-by": ["cc by", "creative commons attribution"],
    "creative-commons": ["creative commons licen[cs]e", "licensed under creative commons"],
    "public-domain": ["dedicated to the public domain", "in the public domain", "public domain dedication"],
}
# How a name is said, from the most to the least explicit: (before, after, confidence).
MANNERS = [
    ("(?:licen[cs]ed|released|distributed|available|published|provided|shared|offered) under(?: the terms(?: and conditions)? of)?(?: the| a| an)? ", "", 0.95),
    ("spdx licen[cs]e identifier ", "", 0.95),
    ("(?:subject to|governed by|covered by|in accordance with)(?: the terms(?: and conditions)? of)?(?: the| a| an)? ", "", 0.9),
    ("(?:see|read|copy of)(?: the)? ", "(?: for details)?", 0.7),
    ("", "", 0.6),
]
TEXTS = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", "hereby granted"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", "permission to use"),
    ("bsd", "redistribution and use in source and binary forms with or without modification", "redistribution and use"),
    ("bsd-3-clause", "neither the name of .{1,80}? may be used to endorse or promote products", "neither the name"),
    ("gpl", "this program is free software you can redistribute it and or modify it", "free software"),
    ("gpl", "without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public licen[cs]e", "implied warranty"),
    ("lgpl", "this library is free software you can redistribute it and or modify it", "library is free"),
    ("apache-2.0", "you may not use this file except in compliance with the licen[cs]e", "except in compliance"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public licen[cs]e v 2 0", "source code form"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors", "in no event will the authors"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered"),
    ("boost", "permission is hereby granted free of charge to any person or organization obtaining a copy", "person or organization"),
    ("all-rights-reserved", "all rights reserved", "rights reserved"),
    ("proprietary", "proprietary and confidential", "proprietary and confidential"),
]
SPDX_EXTRA = {"mit": "mit", "isc": "isc", "zlib": "zlib", "apache-2.0": "apache 2 0", "mpl-2.0": "mpl 2 0", "cc0": "cc0 1 0", "bsl": "bsl 1 0", "unlicense": "unlicense", "gpl-2.0": "gpl 2 0", "gpl-3.0": "gpl 3 0"}
# Characters of a segment that are its own, and of its neighbours on either side; no rule matches as much as a margin.
CORE, MARGIN = 512, 256
# A text without a match of this holds neither a base phrase nor a keyword.
_OTHER = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
GATE = rf"(?i)licen[cs]e|gpl|wtfpl|mpl|creative{_OTHER}+commons|cc0|cc{_OTHER}+by|bsd|public{_OTHER}+domain|hereby{_OTHER}+granted|rights{_OTHER}+reserved|permission{_OTHER}+to{_OTHER}+use|redistribution{_OTHER}+and|neither{_OTHER}+the{_OTHER}+name|free{_OTHER}+software|library{_OTHER}+is{_OTHER}+free|implied{_OTHER}+warranty|except{_OTHER}+in{_OTHER}+compliance|source{_OTHER}+code{_OTHER}+form|in{_OTHER}+no{_OTHER}+event|unencumbered|person{_OTHER}+or{_OTHER}+organization|proprietary"


def rules() -> list[dict]:
    """All signature rules in order of priority: pattern, keyword, label, confidence."""
    out = []

    def add(pattern: str, keyword: str, label: str, confidence: float):
        out.append({"pattern": f"(?<![^ ])(?:{pattern})(?![^ ])", "keyword": keyword, "label": label, "confidence": confidence, "priority": len(out)})

    for label, pattern, keyword in TEXTS:
        add(pattern, keyword, label, 0.98)
    for label, name in SPDX_EXTRA.items():
        add(f"spdx licen[cs]e identifier {name}(?: or later| only)?", "identifier", label, 0.98)
    for before, after, confidence in MANNERS:
        for label, names in NAMES.items():
            for name in names:
                add(before + name + after, _keyword(name), label, confidence)
    return out


def _keyword(name: str) -> str:
    """The literal start of a name's pattern: what must stand in a text for the rule to be tried."""
    for mark in ("licen[cs]e", "(?:", " ?", "?"):
        name = name.partition(mark)[0] if mark != "?" else name
    return name.rstrip()


def _phrase(words: Column, phrase: str) -> tuple[Column, Column, Column]:
    """(places, first word, last word) of a phrase; every word of `words` stands between spaces of its own."""
    inner = "".join(f" {w} " for w in phrase.split())
    rest = F.replace(words, F.lit(inner), F.lit(""))
    n = ((F.length(words) - F.length(rest)) / len(inner)).cast("long")
    count = lambda before: ((F.length(before) - F.length(F.replace(before, F.lit(" "), F.lit("")))) / 2).cast("long")
    first = F.when(n > 0, count(F.substring(words, F.lit(1), F.instr(words, inner) - 1)))
    back = F.length(words) - F.instr(F.reverse(words), inner[::-1]) + 1 - len(inner)
    return n, first, F.when(n > 0, count(F.substring(words, F.lit(1), back)))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), where value is computed once: an expression that a lambda names is computed for each element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _segments(line: Column) -> Column:
    """A line in cores of ``CORE`` characters, each with up to ``MARGIN`` before and after it: (before, text, offset).

    Cut by one pass of a regular expression, so the cost grows with the line. Every match is
    shorter than the margin: one that starts in a core lies whole in its segment, and so
    does every match that could contain it.
    """

    def of(cores: Column) -> Column:
        def segment(core: Column, i: Column) -> Column:
            before = F.coalesce(F.right(F.get(cores, i - 1), F.lit(MARGIN)), F.lit(""))
            after = F.coalesce(F.left(F.get(cores, i + 1), F.lit(MARGIN)), F.lit(""))
            return F.struct(F.length(before).alias("before"), F.concat(before, core, after).alias("text"), (i * CORE - F.length(before)).alias("offset"))

        return F.transform(cores, segment)

    return _bound(F.regexp_extract_all(line, F.lit(f"(?s).{{1,{CORE}}}"), F.lit(0)), of)


def _detections(segment: Column, table: Column) -> Column:
    """Intervals, in the whole line, of the matches in a segment of the rules whose keyword occurs there."""
    line = segment["text"]

    def places(r: Column) -> Column:
        matched = F.struct(F.regexp_extract_all(line, r["pattern"], F.lit(0)).alias("found"), F.split(line, r["pattern"], -1).alias("between"))
        reach = lambda parts, n: F.aggregate(F.slice(parts, F.lit(1), n), F.lit(0), lambda acc, s: acc + F.length(s))

        def all_of(m: Column) -> Column:
            def place(text: Column, i: Column) -> Column:
                def interval(start: Column) -> Column:
                    return F.struct(
                        start.alias("start"),
                        (start + F.length(text)).alias("end"),
                        r["label"].alias("label"),
                        r["confidence"].alias("confidence"),
                        r["priority"].alias("priority"),
                    )

                return _bound(segment["offset"] + reach(m["between"], i + 1) + reach(m["found"], i), interval)

            return F.transform(m["found"], place)

        return _bound(matched, all_of)

    return F.flatten(F.transform(F.filter(table, lambda r: F.contains(line, r["keyword"])), places))


def _of_core(found: Column, segment: Column) -> Column:
    """The kept detections of a segment that start in its core."""
    first = segment["offset"] + segment["before"]
    return F.filter(_kept(found), lambda d: (d["start"] >= first) & (d["start"] < first + CORE))


def _kept(found: Column) -> Column:
    """Without detections inside another one; of equal intervals the rule of higher priority stays."""

    def over(a: Column, b: Column) -> Column:
        wider = (b["end"] - b["start"]) > (a["end"] - a["start"])
        return (b["start"] <= a["start"]) & (b["end"] >= a["end"]) & (wider | (b["priority"] < a["priority"]))

    return F.filter(found, lambda a: ~F.exists(found, lambda b: over(a, b)))


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", signatures: list[dict] | None = None) -> DataFrame:
    """Per row: id, n_words, n_base, first_word, last_word, base_labels, labels, score, detections.

    A null or empty text has no words, no labels and score 0. Rows are scanned one
    by one. detections: the kept intervals in characters of the words joined by one
    space, null where the keyword gate lets a text pass unseen. score: the highest
    confidence of a kept detection, at least 0.5 when a base phrase stands.
    """
    signatures = rules() if signatures is None else signatures
    kind = "array<struct<pattern:string,keyword:string,label:string,confidence:double,priority:int>>"
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    gated = F.when(text.rlike(GATE), F.trim(F.regexp_replace(lower, f"{_OTHER}+", " ")))
    rows = df.select(F.col(id_col).alias("__id"), F.regexp_count(text, F.lit(f"{_WORD}+")).cast("long").alias("n_words"), gated.alias("__line"))
    rows = rows.withColumn("__words", F.concat(F.lit(" "), F.replace(F.col("__line"), F.lit(" "), F.lit("  ")), F.lit(" ")))
    found = {label: _phrase(F.col("__words"), phrase) for phrase, label in BASE.items()}
    for label, (n, first, last) in found.items():
        rows = rows.withColumn(f"__n_{label}", F.coalesce(n, F.lit(0).cast("long"))).withColumn(f"__first_{label}", first).withColumn(f"__last_{label}", last)
    table = F.from_json(F.lit(json.dumps(signatures)), kind)
    rows = rows.withColumn("__segments", F.filter(_segments(F.col("__line")), lambda s: s["text"].rlike(GATE)))
    # Found once a segment, then compared: both read the same array.
    rows = rows.withColumn("__found", F.transform("__segments", lambda s: _detections(s, table)))
    kept = F.transform(F.arrays_zip("__segments", "__found"), lambda z: _of_core(z["__found"], z["__segments"]))
    rows = rows.withColumn("detections", F.when(F.col("__line").isNotNull(), F.flatten(kept)))
    base = F.array_compact(F.array(*[F.when(F.col(f"__n_{label}") > 0, F.lit(label)) for label in sorted(BASE.values())]))
    rows = rows.withColumn("__base", base)
    all_labels = F.array_sort(F.array_distinct(F.concat("__base", F.coalesce(F.transform("detections", lambda d: d["label"]), F.array().cast("array<string>")))))
    best = F.coalesce(F.array_max(F.transform("detections", lambda d: d["confidence"])), F.lit(0.0))
    return rows.select(
        F.col("__id").alias(id_col),
        "n_words",
        sum((F.col(f"__n_{label}") for label in found), F.lit(0).cast("long")).alias("n_base"),
        F.least(*[F.col(f"__first_{label}") for label in found]).alias("first_word"),
        F.greatest(*[F.col(f"__last_{label}") for label in found]).alias("last_word"),
        F.array_join("__base", ",").alias("base_labels"),
        F.array_join(all_labels, ",").alias("labels"),
        F.greatest(best, F.when(F.size("__base") > 0, F.lit(0.5)).otherwise(F.lit(0.0))).alias("score"),
        "detections",
    )
