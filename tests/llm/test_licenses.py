from __future__ import annotations

import re
import textwrap

import pytest

from pressure.llm import licenses

MIT = """Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
BSD2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
NAMES = "\n3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
CASES = [
    (None, ""), ("", ""), ("licensed", ""), ("A licensed plumber.", ""), ("Licensed under the Apache License, Version 2.0.", "Apache-2.0"),
    ("words words\nReleased under the MIT License.\nmore", "MIT"), ("a | b\nLicensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"),
    ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"),
    ("This work is licensed under the GNU General Public License, version 7.", ""), ("# SPDX-License-Identifier: MPL-2.0\ncode", "MPL-2.0"),
    (MIT, "MIT"), ("\n".join(reversed(MIT.split("\n\n"))), ""), (BSD2, "BSD-2-Clause"), (BSD2 + NAMES, "BSD-3-Clause"),
    ("Released under the MIT License. Licensed under the Apache License, Version 2.0.", "Apache-2.0 MIT"),
    ("x " * 50000 + ". Released under the MIT License.", "MIT"),
]


def test_rules(spark):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "doc_id long, text string")
    got = {r["doc_id"]: r["licenses"] for r in licenses.license_report(docs).collect()}
    assert got == {i: want for i, (_, want) in enumerate(CASES)}


def test_places(spark):
    text = "Some words. Released under the MIT License.\nLicensed under CC BY 4.0"
    found = licenses.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()["found"]
    assert [(text[f["at"] :][:8], f["id"]) for f in found] == [("Released", "notice:MIT"), ("Licensed", "notice:CC-BY-4.0")]


def test_no_python_and_no_shuffle(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = licenses.license_report(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Exchange"))


@pytest.mark.parametrize("table", ["odd_docs", "no_docs"])
def test_odd_rows(table, request):
    docs = request.getfixturevalue(table)
    rows = licenses.license_report(docs).collect()
    assert len(rows) == docs.count()
    assert {r["licenses"] for r in rows} <= {""}


WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""
GNU = """    This program is free software{after} you can redistribute it and/or modify
    it under the terms of the GNU {kind}General Public License as published by
    the Free Software Foundation{then} either version {n} of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU {kind}General Public License for more details.
"""
GPL2 = GNU.format(after=";", kind="", then=";", n=2)
GPL3 = GNU.format(after=":", kind="", then=",", n=3)
LGPL3 = GNU.format(after=";", kind="Lesser ", then=";", n=3)
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0
"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies."""
UNLICENSE = """This is free and unencumbered software released into the public
domain."""
CC0 = """To the extent possible under law, the author has waived all copyright
and related or neighboring rights to this work."""


def wrapped(text: str) -> str:
    return "\n".join("\n   ".join(textwrap.wrap(line, 60)) for line in text.split("\n"))


HEADERS = [
    (GPL2, "GPL-2.0"), (GPL3, "GPL-3.0"), (GNU.format(after=";", kind="", then=",", n=2), "GPL-2.0"),
    (GNU.format(after=":", kind="", then=";", n=3), "GPL-3.0"), (" ".join(GPL2.split()), "GPL-2.0"), (MPL, "MPL-2.0"),
    (LGPL3, ""), (GPL2 + "\n" + LGPL3, "GPL-2.0"), (MIT + "\n" + WARRANTY, "MIT"), (WARRANTY, ""), (wrapped(BSD2), "BSD-2-Clause"),
    (wrapped(BSD2 + NAMES), "BSD-3-Clause"), (APACHE, "Apache-2.0"), (ISC, "ISC"), (UNLICENSE, "Unlicense"), (CC0, "CC0-1.0"),
    ("\n".join(" * " + line for line in GPL2.splitlines()), "GPL-2.0"), ("\n".join("# " + line for line in MPL.splitlines()), "MPL-2.0"),
]


def test_wrapped_headers(spark):
    assert {n for n, _ in licenses.TEXT_RULES} <= {want for _, want in HEADERS}
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(HEADERS)], "doc_id long, text string")
    rows = licenses.license_report(docs).collect()
    assert {r["doc_id"]: r["licenses"] for r in rows} == {i: want for i, (_, want) in enumerate(HEADERS)}
    assert {HEADERS[r["doc_id"]][0]: r["n_found"] for r in rows}[WARRANTY] == 1


def test_every_known_sentence_holds_an_anchor():
    assert [s for s in licenses.SENTENCES if not re.search(licenses.ANCHORS, s)] == []

# Written from the notices and texts as they stand in the wild, not from the rules.
MORE = [
    ("SPDX-License-Identifier: GPL-2.0-or-later", "GPL-2.0"), ("// SPDX-License-Identifier: LGPL-2.1-or-later", "LGPL-2.1"),
    ("# SPDX-License-Identifier: (MIT OR Apache-2.0)", "Apache-2.0 MIT"), ("/* Copyright 2020 Foo SPDX-License-Identifier: MIT */", "MIT"),
    ("<!-- SPDX-License-Identifier: GPL-2.0+ WITH Classpath-exception-2.0 AND BSD-3-Clause -->", "BSD-3-Clause GPL-2.0"),
    ("SPDX-License-Identifier: MIT-0", ""), ("SPDX-License-Identifier: BSD-3-Clause-Clear", ""), ("SPDX-License-Identifier: LicenseRef-MIT", ""),
    ("Foo is licensed under the MIT License - see the LICENSE file for details", "MIT"), ("This project is under the MIT license (see LICENSE).", "MIT"),
    ("Licensed under either of Apache License, Version 2.0 or MIT license at your option.", "Apache-2.0 MIT"),
    ("All of it is provided under the BSD 3-Clause License.", "BSD-3-Clause"), ("Dual licensed under MIT/Apache-2.0.", "Apache-2.0 MIT"),
    ("Released under the GNU GPL, version 3.0 or later.", "GPL-3.0"), ("Distributed under the terms of the GNU Lesser General Public License v2.1.", "LGPL-2.1"),
    ("It is licensed under the MIT Zero licence.", ""), ("Licensed under the BSD 3-Clause Clear License.", ""), ("We sat under the mitre arch, licensed or not.", ""),
    (BSD2 + NAMES.replace("the copyright holder", "ACME Systems, Inc."), "BSD-3-Clause"),
    (BSD2 + NAMES.replace("3. ", "(c) ").replace("the copyright holder", "Example University"), "BSD-3-Clause"),
    (BSD2 + NAMES.replace("Neither the name of the copyright holder nor the names of its contributors may", "The name of the author may not"), "BSD-3-Clause"),
    ("\n                                 Apache License\n                           Version 2.0, January 2004\n                        http://www.apache.org/licenses/\n\n"
     "   TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION\n", "Apache-2.0"),
    ("                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright (C) 2007", "GPL-3.0"),
    ("                    GNU GENERAL PUBLIC LICENSE\n                       Version 2, June 1991\n\n Copyright (C) 1989, 1991", "GPL-2.0"),
    ("                   GNU LESSER GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n", "LGPL-3.0"),
    ("                    GNU AFFERO GENERAL PUBLIC LICENSE\n                       Version 3, 19 November 2007\n\n", "AGPL-3.0"),
    ("Mozilla Public License Version 2.0\n==================================\n\n1. Definitions\n", "MPL-2.0"),
    ("Eclipse Public License - v 2.0\n\n    THE ACCOMPANYING PROGRAM IS PROVIDED UNDER", "EPL-2.0"),
    ("Boost Software License - Version 1.0 - August 17th, 2003\n\nPermission is hereby granted", "BSL-1.0"),
    ("Creative Commons Legal Code\n\nCC0 1.0 Universal\n\n    CREATIVE COMMONS", "CC0-1.0"),
    ("Creative Commons Attribution-ShareAlike 4.0 International Public\nLicense\n\nBy exercising", "CC-BY-SA-4.0"),
    ("1. The origin of this software must not be misrepresented; you must not\n   claim that you wrote the original software.\n2. Altered source versions must be plainly "
     "marked as such, and must not be\n   misrepresented as being the original software.\n3. This notice may not be removed or altered from any source distribution.", "Zlib"),
    ("                  GNU LESSER GENERAL PUBLIC LICENSE\n                       Version 2.1, February 1999\n\n", "LGPL-2.1"),
    ("Creative Commons Attribution 4.0 International Public License\n\nBy exercising", "CC-BY-4.0"),
    ("Creative Commons Attribution-NonCommercial 4.0 International Public License", "CC-BY-NC-4.0"),
    ("The mission was released under pressure and distributed under the table.", ""), ("Version 3, 29 June 2007", ""),
]


def test_expressions_names_holders_and_titles(spark):
    import duckdb

    assert {n for n, _ in licenses.WHOLE_RULES} <= {want for _, want in MORE}
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(MORE)], "doc_id long, text string")
    rows = licenses.license_report(docs).collect()
    assert {MORE[r["doc_id"]][0]: r["licenses"] for r in rows} == dict(MORE)
    known = duckdb.connect()
    known.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    known.executemany("INSERT INTO documents VALUES (?, ?)", [(i, t) for i, (t, _) in enumerate(MORE + HEADERS + CASES)])
    same = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(MORE + HEADERS + CASES)], "doc_id long, text string")
    assert sorted(tuple(r) for r in licenses.license_report(same).collect()) == sorted(known.execute(licenses.oracle_sql()).fetchall())


def test_every_title_holds_an_anchor():
    assert [s for s in [*licenses.TITLES, *licenses.ALONE] if not re.search(licenses.ANCHORS, s)] == []
