import re

import cases
from corpusloom.llm.licenses import RULES, SENTENCES, SPDX, Rule, Scanner, normal, scan_licenses

MIT = """Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.
"""


def test_known_texts():
    scan = Scanner().scan
    assert scan(MIT) == (["MIT"], ["mit-grant", "mit-notice", "as-is-mit"])
    assert scan("Some prose.\nLicensed under the Apache License, Version 2.0.\nMore.")[0] == ["Apache-2.0"]
    assert scan("no end here\nReleased under the MIT License.")[0] == ["MIT"]
    assert scan("This work is licensed under the GNU General Public License, version 3.")[0] == ["GPL-3.0-only"]
    assert scan("Prose. Licensed under CC BY-NC 4.0. Released under the MIT License. Licensed under CC BY-NC 4.0.")[0] == ["CC-BY-NC-4.0", "MIT"]
    assert scan("We like the Apache License. A license is a text. " + "." * 50_000) == ([], [])


GPL = """    Copyright (C) 2020  Someone

    This program is free software{} you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation{} either version {} of the License, or
    (at your option) any later version.
"""
HOPE = """
    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details.
"""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at {}://mozilla.org/MPL/2.0/."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD_NAMES = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0
"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies."""

EPL = """This program and the accompanying materials are made available under the
terms of the Eclipse Public License 2.0 which is available at
https://www.eclipse.org/legal/epl-2.0/"""
ZLIB = """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:
"""
BSL = """Permission is hereby granted, free of charge, to any person or organization
obtaining a copy of the software and accompanying documentation covered by
this license (the "Software") to use, reproduce, display, distribute"""

NOTICES = {
    ("mit-grant", "mit-notice", "as-is-mit"): MIT,
    ("isc-grant",): ISC,
    ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names"): BSD + BSD_NAMES,
    ("bsd-grant", "bsd-source", "bsd-binary"): BSD,
    ("apache2-licensed", "apache2-compliance", "apache2-copy"): APACHE,
    ("gpl-free", "gpl-hope"): GPL.format(":", ",", 3) + HOPE,
    ("gpl2-free", "gpl-hope"): GPL.format(";", ";", 2) + HOPE,
    ("mpl2-form", "mpl2-copy"): MPL.format("https"),
    ("apache2-licensed",): "Licensed under the Apache License, Version 2.0.",
    ("gpl-free",): GPL.format(":", ",", 3),
    ("gpl2-free",): GPL.format(";", ";", 2),
    ("gpl3-licensed",): "Licensed under the GNU General Public License, version 3.",
    ("gpl2-licensed",): "Licensed under the GNU General Public License, version 2.",
    ("mpl2-form",): MPL.partition(" If")[0],
    ("cc-by-nc-4",): "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ("cc-by-sa-4",): "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ("cc-by-4",): "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ("cc0",): "Licensed under CC0 1.0.",
    ("unlicense",): "This is free and unencumbered software released into the public domain.",
    ("gpl3-later",): "Licensed under the GNU General Public License, version 3 or later.",
    ("gpl2-later",): "Licensed under the GNU General Public License, version 2 or any later version.",
    ("lgpl3-free", "lgpl-hope"): (GPL.format(":", ",", 3) + HOPE).replace("GNU General", "GNU Lesser General").replace("program", "library"),
    ("lgpl21-free", "lgpl-hope"): (GPL.format(";", ";", 2.1) + HOPE).replace("GNU General", "GNU Lesser General").replace("program", "library"),
    ("agpl3-free", "gpl-hope"): (GPL.format(":", ",", 3) + HOPE).replace("GNU General", "GNU Affero General"),
    ("lgpl3-free",): GPL.format(":", ",", 3).replace("GNU General", "GNU Lesser General"),
    ("lgpl21-free",): GPL.format(";", ";", 2.1).replace("GNU General", "GNU Lesser General"),
    ("agpl3-free",): GPL.format(":", ",", 3).replace("GNU General", "GNU Affero General"),
    ("epl2-available",): EPL,
    ("zlib-as-is", "zlib-grant"): ZLIB,
    ("zlib-grant",): ZLIB.partition("arising")[2],
    ("bsl1-grant",): BSL,
    ("bsl1-distributed",): "Distributed under the Boost Software License, Version 1.0.",
    ("mit-grant",): MIT.partition("The above")[0],
    ("mit-released",): "Released under the MIT License.",
    ("mit-name",): "The MIT License (MIT)",
    ("bsd-released",): "Released under the BSD License.",
}
NOTICES |= {(f"spdx-{name}",): f"SPDX-License-Identifier: {name}" for name in SPDX}


def test_every_rule_on_its_notice():
    assert set(NOTICES) == {r.sequence for r in RULES}
    scan = Scanner().scan
    for rule in RULES:
        text = NOTICES[rule.sequence]
        comment = "/*\n" + "".join(f" * {line}\n" if line else " *\n" for line in text.split("\n")) + " */\nint x;"
        for form in (text, "Prose before it.\n\n" + text + "\n\nProse behind.", text.replace("\n", "\r\n"), comment):
            assert scan(form) == ([rule.license], list(rule.sequence)), (rule, form)
    assert scan(MPL.format("http")) == (["MPL-2.0"], ["mpl2-form", "mpl2-copy"])
    assert scan("Version 2.0. This program is free software: it costs nothing. 2.0.") == ([], [])


def test_order_and_gaps():
    scanner = Scanner({"a": ["one"], "b": ["two"], "c": ["three"]}, (Rule("ABC", ("a", "b", "c"), 1), Rule("AB", ("a", "b"), 0), Rule("A", ("a",))))
    assert scanner.scan("One. Two. Three.")[0] == ["ABC"]
    assert scanner.scan("One. x. Two. y. Three.")[0] == ["ABC"]
    assert scanner.scan("One. x. y. Two. Three.")[0] == ["A"]
    assert scanner.scan("One. Two. x. y. Three. One.")[0] == ["AB", "A"]
    assert scanner.scan("Two. One. Three.") == (["A"], ["b", "a", "c"])


def test_length_of_a_line_does_not_matter():
    grant = SENTENCES["mit-grant"][0]
    assert Scanner().identifiers(f" {'*' * 40} ".join(grant.split()))[0][1] == "mit-grant"


def test_inside_of_sentences():
    scan = Scanner().scan
    assert scan("Code is released under the MIT License.")[0] == ["MIT"]
    assert scan("License: MIT")[0] == ["MIT"] and scan("We discuss the MIT License, and others")[0] == []
    assert scan("It is licensed under the Apache License, Version 2.0, since last year.")[0] == ["Apache-2.0"]
    assert scan("// SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-3.0-or-later\nint x;")[0] == ["MIT", "Apache-2.0", "GPL-3.0-or-later"]
    assert scan("unlicensed under CC0 1.0x. SPDX-License-Identifier: Own-1.0")[0] == []


def _plainly(text: str) -> list[str]:
    """The identifiers by trying every form at every word."""
    words, begins, ends = [], set(), set()
    for piece in re.split(r"(?<=[.!?:;])(?=\s)|\n", text):
        found = "".join(c if c.isalnum() else " " for c in piece.lower()).split()
        if found:
            begins.add(len(words))
            words += found
            ends.add(len(words))
    forms = sorted(((form.split(), name) for name, known in SENTENCES.items() for form in known), key=lambda f: -len(f[0]))
    tags = [(normal(name).split(), f"spdx-{name}") for name in sorted(SPDX, key=lambda n: -len(normal(n).split()))]
    out, at = [], 0
    while at < len(words):
        fits = ((f, name) for f, name in forms if words[at : at + len(f)] == f and (len(f) >= 5 or name.startswith("spdx-") or (at in begins and at + len(f) in ends)))
        form, name = next(fits, ([words[at]], None))
        at += len(form)
        while name:
            out.append(name)
            fits = ((f, n) for f, n in tags if name.startswith("spdx-") and words[at : at + 1] in (["or"], ["and"]) and words[at + 1 : at + 1 + len(f)] == f)
            form, name = next(fits, ([], None))
            at += len(form) + 1 if name else 0
    return out


def test_equals_plain_search(spark):
    texts = [t or "" for _, t, _ in cases.texts()] + [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    notices = list(NOTICES.values())
    texts += [f"We say: {a} and {b}\n{a}" for a, b in zip(notices, notices[1:] + notices[:1], strict=True)]
    scanner = Scanner()
    got = [[name for _, name, _ in scanner.identifiers(t)] for t in texts]
    assert got == [_plainly(t) for t in texts] and sum(map(len, got)) > 100


def test_rules_name_known_sentences():
    assert all(set(r.sequence) <= set(SENTENCES) for r in RULES)
    forms = [s for known in SENTENCES.values() for s in known]
    assert len(forms) == len(set(forms)) and all(normal(s) == s for s in forms)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    lines = {"Licensed under the Apache License, Version 2.0.": "Apache-2.0", "Released under the MIT License.": "MIT", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0-only"}
    want = {r.doc_id: {name for line, name in lines.items() if line in r.text} for r in docs.collect()}
    got = {r.doc_id: set(r.licenses) for r in scan_licenses(docs).collect()}
    assert got == want and sum(map(bool, want.values())) > 50


def test_empty_and_null(spark):
    assert scan_licenses(cases.table(spark, [])).collect() == []
    assert {(r.doc_id, tuple(r.licenses), r.license, r.n_sentences) for r in scan_licenses(cases.with_nulls(spark)).collect()} == {(None, (), None, 0)}
    assert scan_licenses(cases.table(spark)).count() == len(cases.texts())
