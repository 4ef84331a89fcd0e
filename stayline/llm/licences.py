"""Licence scans: known sentences, and rules that are sequences of them.

A text is normalised (letters and digits of ASCII, in lower case, one space between words) and cut
into sentences at marks followed by blanks and at line breaks; a second cut, for wrapped lines,
ends sentences at empty lines only. The point of a version (``v. 2.0``) ends no sentence, and
numbers before a sentence are list marks, which are left out. Each sentence that is word for word
one of the known licence sentences gets its identifier, all others get none. A rule is an ordered
list of identifiers that have to follow each other directly; it is found if either cut has it.

The tables of sentences and rules are parameters of fixed size and part of the expression, so a
document is judged where it is read: nothing is shuffled, joined or sent, and no group of
documents can be too large.

Defined results: a null or empty text has no sentences and no licences; sentences without a
letter don't count and don't stand between others; repeated rows are judged alike; other
columns are ignored.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Sentences of public licences and of the notices that name them.
SENTENCES = {
    1: "Released under the MIT License",
    2: "Licensed under the MIT License",
    3: "This project is licensed under the MIT License",
    4: "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
    " and associated documentation files (the Software), to deal in the Software without"
    " restriction, including without limitation the rights to use, copy, modify, merge, publish,"
    " distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the"
    " Software is furnished to do so, subject to the following conditions",
    5: "The above copyright notice and this permission notice shall be included in all copies or"
    " substantial portions of the Software",
    6: "The software is provided as is, without warranty of any kind, express or implied, including"
    " but not limited to the warranties of merchantability, fitness for a particular purpose and"
    " noninfringement",
    7: "In no event shall the authors or copyright holders be liable for any claim, damages or other"
    " liability, whether in an action of contract, tort or otherwise, arising from, out of or in"
    " connection with the software or the use or other dealings in the software",
    10: "Licensed under the Apache License, Version 2.0",
    11: "Released under the Apache License, Version 2.0",
    12: "Licensed under the Apache License, Version 2.0 (the License)",
    13: "you may not use this file except in compliance with the License",
    14: "Apache License Version 2.0, January 2004",
    20: "This work is licensed under the GNU General Public License, version 3",
    21: "Licensed under the GNU General Public License, version 3",
    22: "This program is free software",
    23: "you can redistribute it and/or modify it under the terms of the GNU General Public License as"
    " published by the Free Software Foundation, either version 3 of the License, or (at your option)"
    " any later version",
    24: "you can redistribute it and/or modify it under the terms of the GNU General Public License as"
    " published by the Free Software Foundation",
    25: "either version 2 of the License, or (at your option) any later version",
    26: "This library is free software",
    27: "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public"
    " License as published by the Free Software Foundation",
    28: "either version 2.1 of the License, or (at your option) any later version",
    29: "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public"
    " License as published by the Free Software Foundation, either version 3 of the License, or (at"
    " your option) any later version",
    30: "Redistribution and use in source and binary forms, with or without modification, are permitted"
    " provided that the following conditions are met",
    31: "Redistributions of source code must retain the above copyright notice, this list of"
    " conditions and the following disclaimer",
    32: "Redistributions in binary form must reproduce the above copyright notice, this list of"
    " conditions and the following disclaimer in the documentation and/or other materials provided"
    " with the distribution",
    33: "Neither the name of the copyright holder nor the names of its contributors may be used to"
    " endorse or promote products derived from this software without specific prior written"
    " permission",
    34: "Released under the BSD License",
    35: "This software is provided by the copyright holders and contributors as is and any express or"
    " implied warranties, including, but not limited to, the implied warranties of merchantability"
    " and fitness for a particular purpose are disclaimed",
    36: "you can redistribute it and/or modify it under the terms of the GNU Affero General Public"
    " License as published by the Free Software Foundation, either version 3 of the License, or (at"
    " your option) any later version",
    40: "Permission to use, copy, modify, and/or distribute this software for any purpose with or"
    " without fee is hereby granted, provided that the above copyright notice and this permission"
    " notice appear in all copies",
    50: "This work is licensed under a Creative Commons Attribution 4.0 International License",
    51: "Licensed under CC BY 4.0",
    52: "This work is licensed under the Creative Commons Attribution 4.0 International License",
    53: "Licensed under CC BY-NC 4.0",
    60: "This is free and unencumbered software released into the public domain",
    61: "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    62: "All rights reserved",
    70: "This software is provided 'as-is', without any express or implied warranty",
    71: "In no event will the authors be held liable for any damages arising from the use of this"
    " software",
    72: "Permission is granted to anyone to use this software for any purpose, including commercial"
    " applications, and to alter it and redistribute it freely, subject to the following"
    " restrictions",
    73: "Distributed under the Boost Software License, Version 1.0",
    74: "This program and the accompanying materials are made available under the terms of the"
    " Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    75: "To the extent possible under law, the author(s) have dedicated all copyright and related"
    " and neighboring rights to this software to the public domain worldwide",
    90: "SPDX-License-Identifier",
    91: "MIT",
    92: "Apache-2.0",
    93: "BSD-2-Clause",
    94: "BSD-3-Clause",
    95: "GPL-2.0-or-later",
    96: "GPL-3.0-only",
    97: "GPL-3.0-or-later",
    98: "LGPL-2.1-or-later",
    99: "LGPL-3.0-or-later",
    100: "AGPL-3.0-or-later",
    101: "MPL-2.0",
    102: "ISC",
    103: "Unlicense",
    104: "EPL-2.0",
    105: "BSL-1.0",
    106: "Zlib",
    107: "CC0-1.0",
    108: "CC-BY-4.0",
    109: "CC-BY-NC-4.0",
}
RULES = {
    "agpl-3.0-or-later": [[22, 36], [90, 100]],
    "apache-2.0": [[10], [11], [14], [12, 13], [90, 92]],
    "bsd": [[34]],
    "bsd-2-clause": [[30, 31, 32, 35], [90, 93]],
    "bsd-3-clause": [[30, 31, 32, 33, 35], [90, 94]],
    "bsl-1.0": [[73], [90, 105]],
    "cc-by-4.0": [[50], [51], [52], [90, 108]],
    "cc-by-nc-4.0": [[53], [90, 109]],
    "cc0-1.0": [[75], [90, 107]],
    "epl-2.0": [[74], [90, 104]],
    "gpl-2.0-or-later": [[22, 24, 25], [90, 95]],
    "gpl-3.0": [[20], [21], [90, 96]],
    "gpl-3.0-or-later": [[22, 23], [90, 97]],
    "isc": [[40], [90, 102]],
    "lgpl-2.1-or-later": [[26, 27, 28], [90, 98]],
    "lgpl-3.0-or-later": [[22, 29], [90, 99]],
    "mit": [[1], [2], [3], [4, 5, 6, 7], [90, 91]],
    "mpl-2.0": [[61], [90, 101]],
    "proprietary": [[62]],
    "unlicense": [[60], [90, 103]],
    "zlib": [[70, 71, 72], [90, 106]],
}

VERSION = r"(^|[^A-Za-z0-9])[vV]\. +([0-9])"
BREAKS = r"[.!?;:]+[ \t\n\r]+|\n[ \t\r]*\n"
LIST_MARKS = "0123456789 "
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def normal(sentence: str) -> str:
    """What :func:`_sentences` makes of a sentence, for the table of known ones."""
    lower = sentence.translate({ord(c): c.lower() for c in _CAPITALS})
    return re.sub(r"[^a-z0-9]+", " ", lower).lstrip(LIST_MARKS).rstrip()


def _plain(text: Column) -> Column:
    """A text normalised, with 1 for the ends of sentences and 2 for single line breaks."""
    versions = F.contains(text, F.lit("v. ")) | F.contains(text, F.lit("V. "))
    held = F.when(versions, F.regexp_replace(text, VERSION, "$1v.$2")).otherwise(text)
    cut = F.regexp_replace(held, BREAKS, "\x01")
    lower = F.translate(cut, _CAPITALS + "\n\r", _CAPITALS.lower() + "\x02\x02")
    return F.regexp_replace(lower, "[^a-z0-9\x01\x02]+", " ")


def _sentences(cut: Column) -> Column:
    """What stands between cuts, without list marks, and without empty ones."""
    trimmed = F.transform(cut, lambda s: F.rtrim(F.ltrim(s, F.lit(LIST_MARKS))))
    return F.coalesce(F.filter(trimmed, lambda s: s != ""), F.array().cast("array<string>"))


def _identified(of: Column, known: dict[str, int]) -> Column:
    """Identifiers of sentences as text, ``,0,`` for unknown ones: ``,4,5,0,``.

    A set tells first whether a sentence is known, as a map is looked through entry by entry.
    """
    table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    names = list(known)
    ids = F.transform(of, lambda s: F.when(s.isin(names), F.try_element_at(table, s)).otherwise(0))
    return F.concat(F.lit(","), F.concat_ws(",", ids.cast("array<string>")), F.lit(","))


def licence_scan(
    documents: DataFrame,
    known: dict[int, str] = SENTENCES,
    rules: dict[str, list[list[int]]] = RULES,
) -> DataFrame:
    """``doc_id``, ``n_sentences``, ``n_known`` and ``licences`` (names of rules, comma-joined)."""
    table = {normal(s): k for k, s in known.items()}
    unwrapped = F.regexp_replace("plain", "[ \x02]*\x02[ \x02]*", " ")
    cut = documents.select("doc_id", _plain(F.col("text")).alias("plain")).select(
        "doc_id",
        _sentences(F.split("plain", "[\x01\x02]")).alias("lines"),
        _sentences(F.split(unwrapped, "\x01")).alias("paragraphs"),
    )
    found = cut.select(
        "doc_id",
        F.size("lines").cast("long").alias("n_sentences"),
        _identified(F.col("lines"), table).alias("by_line"),
        _identified(F.col("paragraphs"), table).alias("by_paragraph"),
    )

    def has(rule: list[int]) -> Column:
        wanted = "," + ",".join(map(str, rule)) + ","
        return F.contains("by_line", F.lit(wanted)) | F.contains("by_paragraph", F.lit(wanted))

    named = [
        F.when(reduce(lambda a, b: a | b, map(has, of)), F.lit(name))
        for name, of in sorted(rules.items())
    ]
    return found.select(
        "doc_id",
        "n_sentences",
        F.size(F.regexp_extract_all("by_line", F.lit(r"(?<=,)[1-9][0-9]*"), F.lit(0)))
        .cast("long")
        .alias("n_known"),
        F.concat_ws(",", *named).alias("licences"),
    )


def oracle() -> str:
    """The same in SQL for DuckDB."""
    known = ", ".join(f"('{s.replace(chr(39), chr(39) * 2)}', {k})" for k, s in SENTENCES.items())
    parts = []
    for name, of in sorted(RULES.items()):
        wanted = ["," + ",".join(map(str, r)) + "," for r in of]
        tests = [f"contains({c}, '{w}')" for w in wanted for c in ("by_line", "by_paragraph")]
        parts.append(f"CASE WHEN {' OR '.join(tests)} THEN '{name}' END")

    def plain(text: str) -> str:
        return f"ltrim(regexp_replace({text}, '[^a-z0-9]+', ' ', 'g'), '{LIST_MARKS}')"

    def cut(breaks: str) -> str:
        held = f"regexp_replace(text, '{VERSION}', '\\1v.\\2', 'g')"
        broken = f"string_split(regexp_replace({held}, '{breaks}', chr(1), 'g'), chr(1))"
        low = f"translate(s, '{_CAPITALS}', '{_CAPITALS.lower()}')"
        return f"list_filter(list_transform({broken}, lambda s: rtrim({plain(low)})), lambda s: s <> '')"

    def named(column: str) -> str:
        return (
            f"SELECT r, string_agg(coalesce(k.id, 0)::VARCHAR, ',' ORDER BY i) AS ids FROM ("
            f" SELECT r, unnest({column}) AS s, generate_subscripts({column}, 1) AS i FROM cut)"
            " LEFT JOIN known k USING (s) GROUP BY r"
        )

    lines = r"[.!?;:]+[ \t\n\r]+|[\n\r]"
    return f"""
WITH listed(raw, id) AS (VALUES {known}),
known AS (SELECT rtrim({plain("lower(raw)")}) AS s, id FROM listed),
rows AS (SELECT doc_id, text, row_number() OVER () AS r FROM documents),
cut AS (SELECT r, doc_id, coalesce({cut(lines)}, []) AS lines,
        coalesce({cut(BREAKS)}, []) AS paragraphs FROM rows),
a AS ({named("lines")}), b AS ({named("paragraphs")}),
found AS (SELECT doc_id, len(lines) AS n_sentences, ',' || coalesce(a.ids, '') || ',' AS by_line,
          ',' || coalesce(b.ids, '') || ',' AS by_paragraph
          FROM cut LEFT JOIN a USING (r) LEFT JOIN b USING (r))
SELECT doc_id, n_sentences::BIGINT AS n_sentences,
       len(list_filter(string_split(by_line, ','), lambda x: x NOT IN ('', '0')))::BIGINT AS n_known,
       concat_ws(',', {", ".join(parts)}) AS licences
FROM found"""
