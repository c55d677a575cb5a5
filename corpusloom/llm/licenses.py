"""Licence scans by sentence rules: sentences become identifiers, identifier sequences are matched against ordered rules.

A text is cut into sentences, each is normalised, and a sentence that is or holds one that a licence is known to contain gets that
sentence's identifier; others get none.  A rule is a licence with the identifiers that have to follow one another; between them only a bounded
number of unknown sentences may stand.  Rules are tried in order and the first that matches at a place takes it.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.rows import column, in_arrow

# Sentences by identifier, in the form that ``normal`` gives them.  Sources: the licences' own texts and usual notices.
SENTENCES = {
    "mit-name": ["mit license", "the mit license", "the mit license mit", "license mit", "license the mit license"],
    "mit-released": ["released under the mit license", "licensed under the mit license", "this project is licensed under the mit license", "distributed under the mit license"],
    "mit-grant": ["permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"],
    "mit-notice": ["the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"],
    "as-is-mit": ["the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"],
    "isc-grant": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"],
    "bsd-grant": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"],
    "bsd-source": ["redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"],
    "bsd-binary": ["redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"],
    "bsd-names": ["neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"],
    "bsd-released": ["released under the bsd license", "licensed under the bsd license"],
    "apache2-licensed": ["licensed under the apache license version 2 0", "licensed under the apache license version 2 0 the license", "released under the apache license version 2 0", "this project is licensed under the apache license version 2 0"],
    "apache2-compliance": ["you may not use this file except in compliance with the license"],
    "apache2-copy": ["you may obtain a copy of the license at"],
    "gpl3-licensed": ["this work is licensed under the gnu general public license version 3", "licensed under the gnu general public license version 3", "released under the gnu general public license version 3"],
    "gpl2-licensed": ["this work is licensed under the gnu general public license version 2", "licensed under the gnu general public license version 2"],
    "gpl-free": ["this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"],
    "gpl2-free": ["this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"],
    "gpl-hope": ["this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"],
    "gpl3-later": ["licensed under the gnu general public license version 3 or later", "licensed under the gnu general public license version 3 or any later version"],
    "gpl2-later": ["licensed under the gnu general public license version 2 or later", "licensed under the gnu general public license version 2 or any later version"],
    "lgpl3-free": [f"this {work} is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version" for work in ("program", "library")],
    "lgpl21-free": [f"this {work} is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version" for work in ("program", "library")],
    "lgpl-hope": ["this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"],
    "agpl3-free": ["this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version"],
    "epl2-available": ["this program and the accompanying materials are made available under the terms of the eclipse public license 2 0", "this program and the accompanying materials are made available under the terms of the eclipse public license v 2 0"],
    "zlib-as-is": ["this software is provided as is without any express or implied warranty"],
    "zlib-grant": ["permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions"],
    "bsl1-grant": ["permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"],
    "bsl1-distributed": ["distributed under the boost software license version 1 0"],
    "mpl2-form": ["this source code form is subject to the terms of the mozilla public license v 2 0"],
    "mpl2-copy": ["if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0", "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0"],
    "cc-by-nc-4": ["licensed under cc by nc 4 0", "this work is licensed under cc by nc 4 0", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"],
    "cc-by-sa-4": ["licensed under cc by sa 4 0", "this work is licensed under cc by sa 4 0", "this work is licensed under a creative commons attribution sharealike 4 0 international license"],
    "cc-by-4": ["licensed under cc by 4 0", "this work is licensed under cc by 4 0", "this work is licensed under a creative commons attribution 4 0 international license"],
    "cc0": ["this work is dedicated to the public domain", "licensed under cc0 1 0"],
    "unlicense": ["this is free and unencumbered software released into the public domain"],
}

# Licence identifiers that follow the tag SPDX-License-Identifier.
SPDX = (
    "MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-only",
    "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later", "MPL-2.0", "EPL-2.0", "Zlib", "BSL-1.0",
    "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "CC0-1.0", "Unlicense",
)


@dataclass(frozen=True)
class Rule:
    """``sequence`` of identifiers in order; at most ``gap`` unknown sentences between two of them."""

    license: str
    sequence: tuple[str, ...]
    gap: int = 3


# Rules in the order in which they are tried; fuller ones first.
RULES = (
    Rule("MIT", ("mit-grant", "mit-notice", "as-is-mit")),
    Rule("ISC", ("isc-grant",)),
    Rule("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    Rule("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    Rule("Apache-2.0", ("apache2-licensed", "apache2-compliance", "apache2-copy")),
    Rule("GPL-3.0-or-later", ("gpl-free", "gpl-hope")),
    Rule("GPL-2.0-or-later", ("gpl2-free", "gpl-hope")),
    Rule("LGPL-3.0-or-later", ("lgpl3-free", "lgpl-hope")),
    Rule("LGPL-2.1-or-later", ("lgpl21-free", "lgpl-hope")),
    Rule("AGPL-3.0-or-later", ("agpl3-free", "gpl-hope")),
    Rule("Zlib", ("zlib-as-is", "zlib-grant")),
    Rule("MPL-2.0", ("mpl2-form", "mpl2-copy")),
    Rule("Apache-2.0", ("apache2-licensed",)),
    Rule("GPL-3.0-or-later", ("gpl-free",)),
    Rule("GPL-2.0-or-later", ("gpl2-free",)),
    Rule("GPL-3.0-or-later", ("gpl3-later",)),
    Rule("GPL-2.0-or-later", ("gpl2-later",)),
    Rule("LGPL-3.0-or-later", ("lgpl3-free",)),
    Rule("LGPL-2.1-or-later", ("lgpl21-free",)),
    Rule("AGPL-3.0-or-later", ("agpl3-free",)),
    Rule("EPL-2.0", ("epl2-available",)),
    Rule("Zlib", ("zlib-grant",)),
    Rule("BSL-1.0", ("bsl1-grant",)),
    Rule("BSL-1.0", ("bsl1-distributed",)),
    Rule("GPL-3.0-only", ("gpl3-licensed",)),
    Rule("GPL-2.0-only", ("gpl2-licensed",)),
    Rule("MPL-2.0", ("mpl2-form",)),
    Rule("CC-BY-NC-4.0", ("cc-by-nc-4",)),
    Rule("CC-BY-SA-4.0", ("cc-by-sa-4",)),
    Rule("CC-BY-4.0", ("cc-by-4",)),
    Rule("CC0-1.0", ("cc0",)),
    Rule("Unlicense", ("unlicense",)),
    Rule("MIT", ("mit-grant",)),
    Rule("MIT", ("mit-released",)),
    Rule("MIT", ("mit-name",)),
    Rule("BSD", ("bsd-released",)),
)

_BREAK = re.compile(r"(?<=[.!?:;])(?=\s)|\n[ \t]*\n")
_PLAIN = re.compile(r"[\W_]+")


def normal(sentence: str) -> str:
    """Words in lower case with single spaces; everything else is a separator."""
    return _PLAIN.sub(" ", sentence.lower()).strip()


WHOLE = 5  # words; a shorter known sentence counts only as a whole sentence or line (a tagged identifier anywhere)
_TAG = "spdx license identifier"
SENTENCES |= {f"spdx-{name}": [f"{_TAG} {normal(name)}"] for name in SPDX}
RULES += tuple(Rule(name, (f"spdx-{name}",)) for name in SPDX)


class Scanner:
    """Sentence identifiers and rules, ready to scan texts."""

    def __init__(self, sentences: dict[str, list[str]] | None = None, rules: tuple[Rule, ...] | None = None):
        sentences = SENTENCES if sentences is None else sentences
        self.known = ahocorasick.Automaton()
        for name, forms in sentences.items():
            for form in forms:
                self.known.add_word(f" {form} ", (name, len(form), len(form.split()) < WHOLE and not form.startswith(_TAG)))
        if len(self.known):
            self.known.make_automaton()
        self.named = {f"{word} {form.removeprefix(_TAG).strip()} ": name for name, forms in sentences.items() for form in forms if form.startswith(_TAG) for word in ("or", "and")}
        self.rules = RULES if rules is None else rules

    def identifiers(self, text: str) -> list[tuple[int, str, int]]:
        """(number of its first sentence, identifier, of its last) of the known sentences in order; of overlapping ones the first, then the longest.

        Known sentences may hold marks that end others, and line feeds, and may stand inside of longer ones; those of fewer than
        ``WHOLE`` words, but for tags, have to begin and end with a sentence or line.  Sentences without letters and digits don't count.
        """
        pieces, begin = [], 0
        for end in [m.end() for m in _BREAK.finditer(text)] + [len(text)]:
            part = text[begin:end]
            begin = end
            pieces += [plain for p in part.split("\n") if (plain := normal(p))]
        if not pieces or not len(self.known):
            return []
        line, starts, at = f" {' '.join(pieces)} ", [], 1
        for piece in pieces:
            starts.append(at)
            at += len(piece) + 1
        met = []
        for last, (name, length, whole) in self.known.iter(line):
            begin, end = last - length, last  # without the blanks around it
            first, final = bisect_right(starts, begin) - 1, bisect_right(starts, end - 1) - 1
            if not whole or (starts[first] == begin and starts[final] + len(pieces[final]) == end):
                met.append((begin, -end, name, first, final))
        out, upto = [], 0
        for begin, end, name, first, final in sorted(met):
            if begin < upto:
                continue
            upto = -end
            out.append((first, name, final))
            while name.startswith("spdx-"):  # the other licences of an expression
                more = max((form for form in self.named if line.startswith(form, upto + 1)), key=len, default=None)
                if more is None:
                    break
                upto += len(more)
                out.append((final, self.named[more], final))
        return out

    def scan(self, text: str) -> tuple[list[str], list[str]]:
        """Licences in order of their places, each once, and the identifiers in order."""
        found = self.identifiers(text)
        licenses: list[str] = []
        at = 0
        while at < len(found):
            rule = next((r for r in self.rules if self._matches(r, found, at)), None)
            if rule and rule.license not in licenses:
                licenses.append(rule.license)
            at += len(rule.sequence) if rule else 1
        return licenses, [name for _, name, _ in found]

    def _matches(self, rule: Rule, found: list[tuple[int, str, int]], at: int) -> bool:
        part = found[at : at + len(rule.sequence)]
        if tuple(name for _, name, _ in part) != rule.sequence:
            return False
        return all(later[0] - earlier[2] - 1 <= rule.gap for earlier, later in zip(part, part[1:], strict=False))


def scan_licenses(docs: DataFrame, sentences: dict[str, list[str]] | None = None, rules: tuple[Rule, ...] | None = None) -> DataFrame:
    """One row per input row: doc_id, licenses (array, in order of place, each once), sentence_ids (array, in order), n_sentences (of known ones), license (the first or null).

    Whole texts are scanned.  A null, empty or blank text has no sentences and empty arrays.  Repeated rows get equal
    results; an empty table gives an empty result; other columns are ignored.  With no rules nothing matches.
    """

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(sentences, rules)
        for batch in batches:
            found = [scanner.scan(t.as_py() or "") for t in batch.column("text")]
            arrays = [batch.column("doc_id"), pa.array([f[0] for f in found], pa.list_(pa.string())), pa.array([f[1] for f in found], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "licenses", "sentence_ids"])

    narrow = docs.select(column("doc_id").cast("long").alias("doc_id"), column("text").alias("text"))
    found = in_arrow(narrow, step, "doc_id long, licenses array<string>, sentence_ids array<string>")
    return found.select("*", F.size("sentence_ids").cast("long").alias("n_sentences"), F.get("licenses", F.lit(0)).alias("license"))
