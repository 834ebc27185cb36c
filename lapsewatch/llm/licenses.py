"""License scans by sentence rules.

Texts are cut into sentences, which may run over lines and stand in comments; each is normalised and looked up among known license sentences, and the sequence of known
identifiers is matched against ordered rules, longest first. Every known sentence holds one of a few stems, so a text or
sentence without a stem needs no further work; every text is searched for them as a whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import table
from .texts import pieces, texts_of

#: Names of licenses as they stand in notices, and their identifiers.
NAMES = {
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0 License"),
    "MIT": ("MIT License", "MIT license"),
    "BSD-2-Clause": ("BSD 2-Clause License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "New BSD License", "BSD License"),
    "GPL-2.0": ("GNU General Public License, version 2", "GNU GPL v2", "GPL-2.0 License"),
    "GPL-3.0": ("GNU General Public License, version 3", "GNU GPL v3", "GPL-3.0 License"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "GNU LGPL v3"),
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "GNU AGPL v3"),
    "MPL-2.0": ("Mozilla Public License, Version 2.0", "Mozilla Public License 2.0"),
    "CC0-1.0": ("CC0 1.0", "Creative Commons Zero 1.0"),
    "CC-BY-4.0": ("CC BY 4.0", "Creative Commons Attribution 4.0 International License"),
    "CC-BY-SA-4.0": ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC-BY-ND-4.0": ("CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"),
}
#: Sentences that name a license.
NOTICES = ("Licensed under {}", "Licensed under the {}", "Released under {}", "Released under the {}", "Distributed under {}",
           "Distributed under the {}", "This work is licensed under {}", "This work is licensed under the {}",
           "This work is licensed under a {}", "This project is licensed under the {}", "This file is licensed under the {}",
           "This software is licensed under the {}", "This program is licensed under the {}", "License: {}")
#: Other known sentences by identifier.
SENTENCES = {
    "reserved": "All rights reserved.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                 "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
                 "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
                 "permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "as-is": "The software is provided \"as is\", without warranty of any kind, express or implied, including but not limited to the "
             "warranties of merchantability, fitness for a particular purpose and noninfringement.",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
                 "following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
                  "disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
                 "derived from this software without specific prior written permission.",
    "apache-terms": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "gpl3-terms": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
                  "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl2-terms": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License "
                  "as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
}
#: Ordered rules for texts of several sentences.
RULES = (
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    ("MIT", ("mit-grant", "mit-notice", "as-is")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("Apache-2.0", ("apache-terms", "apache-copy")),
    ("Apache-2.0", ("apache-terms",)),
    ("GPL-3.0", ("gpl3-terms",)),
    ("GPL-2.0", ("gpl2-terms",)),
    ("LicenseRef-all-rights-reserved", ("reserved",)),
)
#: Unknown sentences that may stand between two of a rule.
GAP = 2
STEM = re.compile(rb"licen|rights reserved|permission|redistribut|warrant", re.IGNORECASE)
BREAK = re.compile(rb"\n[ \t\r]*\n[ \t\r\n]*|(?<=[.!?:])[ \t\r\n]+(?=[^a-z])|;[ \t\r\n]+")
#: What ends a piece of a sentence: a line feed inside it, a pause that a known sentence may hold, or the sentence's end.
WRAP, PAUSE, END = range(3)


def normalise(sentence: bytes) -> bytes:
    """Lower-case ASCII letters and digits; anything else but dots inside numbers is one space."""
    low = re.sub(rb"[A-Z]", lambda m: m[0].lower(), sentence)
    return re.sub(rb"[^a-z0-9.\x80-\xff]+|\.(?![0-9])|(?<![0-9])\.", b" ", low).strip()


def unmarked(line: bytes) -> bytes:
    """A line without the marks of a comment around it."""
    line = line.lstrip(b" \t\r#*/;%!>|<-").rstrip(b" \t\r#*/|").removesuffix(b"-->").rstrip(b" \t\r-")
    word = line[:4].lower()
    return line[4:].lstrip() if word in (b"dnl ", b"rem ") else b"" if word in (b"dnl", b"rem") else line


def pieces_of(text: bytes) -> list[tuple[bytes, int]]:
    """(normal form, what ends it) of the pieces of all sentences: each line of a sentence is one."""
    body, out, at = b"\n".join(map(unmarked, text.split(b"\n"))), [], 0
    for start, end in [*(m.span() for m in BREAK.finditer(body)), (len(body), len(body))]:
        lines = [normalise(x) for x in body[at:start].split(b"\n")] if start > at else []
        out += [(x, WRAP) for x in lines[:-1]]
        if lines:
            open_ = body[start - 1:start] not in b".!?:" and body[start:start + 1] == b"\n"
            label = lines[-1] == b"license" and body[start - 1:start] == b":"
            out.append((lines[-1], PAUSE if open_ or label else END))
        at = end
    return out


def known_at(pieces: list[tuple[bytes, int]], i: int, known: dict[bytes, tuple[str, ...]], longest: int) -> int:
    """End of the longest known sentence that starts with a piece, or its place if there is none."""
    end, joined = i, b""
    for j in range(i, len(pieces)):
        joined = b" ".join(filter(None, (joined, pieces[j][0])))
        if len(joined) > longest:
            break
        if joined in known:
            end = j + 1
        if pieces[j][1] == END:
            break
    return end


def known_sentences() -> dict[bytes, tuple[str, ...]]:
    """Identifiers of the parts of every known sentence by their normal form."""
    out = {}
    for license_id, names in NAMES.items():
        for name in names:
            for notice in NOTICES:
                out[normalise(notice.format(name).encode())] = (license_id,)
    for identifier, text in SENTENCES.items():
        parts = [normalise(p) for p in BREAK.split(text.encode())]
        out |= {p: (f"{identifier}/{i}",) for i, p in enumerate(parts) if p and STEM.search(p)}
    return out


def ordered_rules() -> list[tuple[str, tuple[str, ...]]]:
    known = known_sentences()
    full = [(name, tuple(i for s in ids for i in sorted({v[0] for v in known.values() if v[0].startswith(f"{s}/")}))) for name, ids in RULES]
    return sorted(full, key=lambda r: -len(r[1])) + [(n, (n,)) for n in NAMES]


def scan(text: bytes, known: dict[bytes, tuple[str, ...]], rules: list[tuple[str, tuple[str, ...]]]) -> tuple[list[tuple[str, int]], int]:
    """[(license, number of its first sentence)] and the number of known sentences."""
    if not STEM.search(text):
        return [], 0
    pieces, longest = pieces_of(text), max(map(len, known))
    ids, sentence, i, starts = [], -1, 0, True
    while i < len(pieces):
        end = known_at(pieces, i, known, longest)
        sentence += starts or end > i
        if end > i:
            ids += [(sentence, k) for k in known[b" ".join(filter(None, (x for x, _ in pieces[i:end])))]]
        starts = end > i or pieces[i][1] != WRAP
        i = max(end, i + 1)
    found, at = [], 0
    while at < len(ids):
        for name, rule in rules:
            run = ids[at:at + len(rule)]
            if tuple(k for _, k in run) == rule and all(b - a <= GAP + 1 for (a, _), (b, _) in zip(run, run[1:])):
                found.append((name, run[0][0]))
                at += len(rule)
                break
        else:
            at += 1
    return found, len(ids)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known, rules = known_sentences(), ordered_rules()
    for batch in pieces(batches, "text"):
        found = [scan(t, known, rules) for t in texts_of(batch, "text")]
        yield pa.RecordBatch.from_arrays(
            [batch.column(batch.schema.get_field_index("id")),
             pa.array([[{"license": n, "sentence": s} for n, s in f] for f, _ in found],
                      pa.list_(pa.struct([("license", pa.string()), ("sentence", pa.int64())]))),
             pa.array([n for _, n in found], pa.int64())], ["id", "matches", "n_known"])


def licenses(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, matches, n_known) for every row of ``docs``: license and first sentence (from 0) of each match, in order.

    Sentences end at blank lines, at dots, question or exclamation marks and colons before a blank or line feed that no small
    letter follows, and at semicolons; a known sentence also ends where its line does, and may go on after a blank line or
    'License:'. Comment marks around lines are no part of them. A null or empty text matches nothing. Null and repeated keys are rows of their own. An
    empty table gives no rows.
    """
    rows = docs.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text"))
    kind = dict(rows.dtypes)["id"]
    out = rows.mapInArrow(_scan, f"id {kind}, matches array<struct<license: string, sentence: bigint>>, n_known long")
    return out.withColumnRenamed("id", key)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents."""
    out = licenses(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", F.array_join(F.array_sort(F.array_distinct(F.col("matches.license"))), ",").alias("licenses"),
        F.size("matches").cast("long").alias("n_matches"), "n_known", F.get("matches.sentence", F.lit(0)).alias("first_sentence"))
