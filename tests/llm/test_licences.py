"""Each rule on the notice it names, as it stands in files: wrapped, numbered, in comments."""

import pytest

from stayline.llm import licences

BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
{third}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE.
"""
THIRD = """
3. Neither the name of the copyright holder nor the names of its contributors
   may be used to endorse or promote products derived from this software
   without specific prior written permission.
"""
GNU = """# This {what} is free software{colon} you can redistribute it and/or modify
# it under the terms of the GNU {name} as published by
# the Free Software Foundation{comma} either version {version} of the License, or
# (at your option) any later version.
#
# It is distributed in the hope that it will be useful."""


def gnu(name, version, what="program", colon=":", comma=","):
    return GNU.format(name=name, version=version, what=what, colon=colon, comma=comma)


NOTICES = {
    "agpl-3.0-or-later": gnu("Affero General Public License", "3"),
    "apache-2.0": """ * Licensed under the Apache License, Version 2.0 (the "License");
 * you may not use this file except in compliance with the License.
 * You may obtain a copy of the License at""",
    "bsd-2-clause": BSD.format(third=""),
    "bsd-3-clause": BSD.format(third=THIRD),
    "bsl-1.0": "// Distributed under the Boost Software License, Version 1.0.\n// (See accompanying file)",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc0-1.0": """To the extent possible under law, the author(s) have dedicated all copyright
and related and neighboring rights to this software to the public domain worldwide.
This software is distributed without any warranty.""",
    "epl-2.0": """This program and the accompanying materials are made
available under the terms of the Eclipse Public License 2.0
which is available at https://www.eclipse.org/legal/epl-2.0/

SPDX""",
    "gpl-2.0-or-later": gnu("General Public License", "2", colon=";", comma=";"),
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-or-later": gnu("General Public License", "3"),
    "isc": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.""",
    "lgpl-2.1-or-later": gnu("Lesser General Public License", "2.1", "library", ";", ";"),
    "lgpl-3.0-or-later": gnu("Lesser General Public License", "3"),
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.""",
    "mpl-2.0": """ * This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at""",
    "unlicense": "This is free and unencumbered software released into the public domain.\n\nAnyone is free",
    "zlib": """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented""",
}
OTHERS = {"bsd": "Released under the BSD License.", "proprietary": "(c) 2020. All rights reserved."}


def scan(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = licences.licence_scan(df).collect()
    return [r.licences for r in sorted(rows, key=lambda r: r.doc_id)]


def test_every_rule_has_a_notice():
    assert set(NOTICES) | set(OTHERS) == set(licences.RULES)


def test_notices(spark):
    named = NOTICES | OTHERS
    assert scan(spark, named.values()) == list(named)
    around = [f"Copyright 2020 A. Person\n\n{text}\n\nint main() {{}}" for text in named.values()]
    assert scan(spark, around) == list(named)


def test_spdx_lines(spark):
    names = {licences.SENTENCES[r[1]]: n for n, of in licences.RULES.items() for r in of if r[0] == 90}
    lines = [f"// SPDX-License-Identifier: {s}\npackage x" for s in names]
    assert scan(spark, lines) == list(names.values())
    # a name alone is no licence
    assert scan(spark, [f"{s}\nother" for s in names]) == [""] * len(names)


@pytest.mark.parametrize(
    "text",
    [
        BSD.format(third="\n3. All advertising materials must say so.\n"),
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1.",
        NOTICES["mit"].replace("THE SOFTWARE IS", "It works. THE SOFTWARE IS"),
        NOTICES["gpl-2.0-or-later"].replace("version 2", "version 4"),
        "1. 2. 3.", "v. 2", "\x01\x02", "",
    ],
)
def test_what_no_rule_names(spark, text):
    assert scan(spark, [text]) == [""]


def test_numbers_and_versions_end_no_sentence(spark):
    text = "1. First point. 2. Second, see Act v. 3 of it.\n12\nBrehmer v. Sons. Kiev. 2 more"
    df = spark.createDataFrame([(0, text)], "doc_id long, text string")
    # first point; second see act v 3 of it; brehmer v; sons; kiev; more
    assert licences.licence_scan(df).first().n_sentences == 6
