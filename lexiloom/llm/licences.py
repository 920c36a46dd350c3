"""Licence recognition by rules over sequences of known sentences.

Texts are cut into pieces at line ends, after full stops and at commas and
brackets; a piece is lower-cased and reduced to letters and digits, which also
takes comment marks away. A known sentence is a run of pieces that begins a line
or sentence and spells it, so that wrapped lines, list marks and what follows
after a comma do not hide it; the longest counts, and the next begins after it.
Known sentences have identifiers, and a licence is a rule: identifiers that must
follow one another, with at most ``GAP`` other lines or sentences between two.

Work is row-local: the rules are fixed and small. Cases: null, empty and
sentence-free texts have no licence; a sentence may serve several rules;
repeated rows each get their result; a rule counts as often as it matches
without overlap, from its leftmost start to the first end from there (ties);
a table without rows gives none; other columns are not touched.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unknown sentences allowed between two sentences of a rule.
GAP = 2

# Sentences of public licences and of their notices, by identifier.
SENTENCES = {
    "mit-released": "Released under the MIT License",
    "mit-licensed": "Licensed under the MIT License",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "as-is": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
    "apache-licensed": "Licensed under the Apache License, Version 2.0",
    "apache-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License",
    "apache-copy": "You may obtain a copy of the License at",
    "gpl3-work": "This work is licensed under the GNU General Public License, version 3",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gpl2-free": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    "cc-by-nc": "Licensed under CC BY-NC 4.0",
    "cc-by": "Licensed under CC BY 4.0",
    "cc-by-sa": "Licensed under CC BY-SA 4.0",
    "cc0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd-endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "mpl": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "reserved": "All rights reserved",
    "apache-required": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    "apache-limits": "See the License for the specific language governing permissions and limitations under the License",
    "gpl-received": "You should have received a copy of the GNU General Public License along with this program",
    "gpl2-only": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation",
    "lgpl21-free": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version",
    "lgpl3-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "lgpl-hope": "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    "agpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "mpl-copy": "If a copy of the MPL was not distributed with this file, You can obtain one at",
    "bsd-as-is": "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED",
    "unlicense-free": "This is free and unencumbered software released into the public domain",
    "unlicense-anyone": "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means",
    "zlib-as-is": "This software is provided 'as-is', without any express or implied warranty",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    "epl1": "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0",
    "epl2": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
    "cddl": "The contents of this file are subject to the terms of the Common Development and Distribution License",
    "artistic": "This is free software; you can redistribute it and/or modify it under the terms of the Artistic License 2.0",
}

# Identifiers of licences and the names that notices give them.
NAMES = {
    "MIT": ("MIT License", "MIT Licence", "MIT"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0"),
    "GPL-2.0": ("GNU General Public License, version 2", "GNU General Public License v2.0", "GNU GPL v2", "GPLv2", "GPL-2.0"),
    "GPL-3.0": ("GNU General Public License, version 3", "GNU General Public License v3.0", "GNU GPL v3", "GPLv3", "GPL-3.0"),
    "LGPL-2.1": ("GNU Lesser General Public License, version 2.1", "LGPLv2.1", "LGPL-2.1"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "LGPLv3", "LGPL-3.0"),
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "AGPLv3", "AGPL-3.0"),
    "BSD-2-Clause": ("BSD 2-Clause License", "Simplified BSD License", "BSD-2-Clause"),
    "BSD-3-Clause": ("BSD 3-Clause License", "New BSD License", "BSD-3-Clause"),
    "ISC": ("ISC License", "ISC"),
    "MPL-2.0": ("Mozilla Public License, v. 2.0", "Mozilla Public License 2.0", "MPL 2.0"),
    "EPL-2.0": ("Eclipse Public License 2.0", "EPL-2.0"),
    "BSL-1.0": ("Boost Software License, Version 1.0", "Boost Software License 1.0", "BSL-1.0"),
    "Zlib": ("zlib License", "Zlib"),
    "Unlicense": ("Unlicense",),
    "CC0-1.0": ("CC0", "CC0 1.0", "CC0-1.0", "Creative Commons Zero"),
    "CC-BY-4.0": ("Creative Commons Attribution 4.0 International License", "CC BY 4.0", "CC-BY-4.0"),
    "CC-BY-SA-4.0": ("Creative Commons Attribution-ShareAlike 4.0 International License", "CC BY-SA 4.0", "CC-BY-SA-4.0"),
    "CC-BY-NC-4.0": ("Creative Commons Attribution-NonCommercial 4.0 International License", "CC BY-NC 4.0", "CC-BY-NC-4.0"),
    "CC-BY-ND-4.0": ("Creative Commons Attribution-NoDerivatives 4.0 International License", "CC BY-ND 4.0", "CC-BY-ND-4.0"),
}
_ARTICLES = ("under the", "under", "under a", "under the terms of the")
_VERBS = ("licensed", "released", "distributed", "published", "provided", "made available", "available")


def notices() -> dict[str, str]:
    """Sentences that name a licence, built from the names: ``named:LICENCE`` and ``tag:LICENCE``."""
    out = {}
    for licence, names in NAMES.items():
        for name in names:
            out |= {f"{verb} {article} {name}": f"named:{licence}" for verb in _VERBS for article in _ARTICLES}
        out |= {f"SPDX-License-Identifier: {licence}{end}": f"tag:{licence}" for end in ("", "-only", "-or-later")}
    return out


# Rules, each a licence and the identifiers it asks for in order.
RULES = (
    ("MIT", ("mit-released",)),
    ("MIT", ("mit-licensed",)),
    ("MIT", ("mit-grant", "mit-notice", "as-is")),
    ("Apache-2.0", ("apache-licensed",)),
    ("Apache-2.0", ("apache-header", "apache-copy")),
    ("GPL-3.0", ("gpl3-work",)),
    ("GPL-3.0", ("gpl-free", "gpl-hope")),
    ("GPL-2.0", ("gpl2-free", "gpl-hope")),
    ("CC-BY-NC-4.0", ("cc-by-nc",)),
    ("CC-BY-4.0", ("cc-by",)),
    ("CC-BY-SA-4.0", ("cc-by-sa",)),
    ("CC0-1.0", ("cc0",)),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("ISC", ("isc-grant",)),
    ("MPL-2.0", ("mpl",)),
    ("proprietary", ("reserved",)),
    ("GPL-2.0", ("gpl2-only", "gpl-hope")),
    ("LGPL-2.1", ("lgpl21-free", "lgpl-hope")),
    ("LGPL-3.0", ("lgpl3-free", "gpl-hope")),
    ("AGPL-3.0", ("agpl-free", "gpl-hope")),
    ("Unlicense", ("unlicense-free", "unlicense-anyone")),
    ("Zlib", ("zlib-as-is", "zlib-grant")),
    ("EPL-1.0", ("epl1",)),
    ("EPL-2.0", ("epl2",)),
    ("CDDL-1.0", ("cddl",)),
    ("Artistic-2.0", ("artistic",)),
    *((licence, (f"{kind}:{licence}",)) for licence in NAMES for kind in ("named", "tag")),
)

# A line or sentence ends at a line end, or after . ! ? before a blank; a piece also at a comma or bracket.
_END = re.compile(r"\n+|(?<=[.!?])[ \t\r\f\v]+|[,;(][ \t]*")
_OTHER = re.compile(r"[^0-9a-z]+")
#: A list mark or a comment word before a sentence, and a subject before a notice.
_MARK = re.compile(r"(?:rem|dnl|[0-9]{1,2}|[a-z]|[ivx]{1,4}) ")
_LEAD = re.compile(r"(?:this|the|all|our|its) (?:[0-9a-z]+ ){0,4}?(?:is|are) (?:also |hereby |dual )?")


def normalised(sentence: str) -> str:
    """Lower-cased ASCII letters and digits, other characters as single spaces."""
    return _OTHER.sub(" ", sentence.lower()).strip()


_KNOWN = {normalised(text): name for text, name in notices().items()}
_KNOWN |= {normalised(text): name for name, text in SENTENCES.items()}
#: What a known sentence may begin with, by whole words.
_BEGINS = {text[:k] for text in _KNOWN for k in [*(m.start() for m in re.finditer(" ", text)), len(text)]}
#: Every text with a known sentence has one of these in lower case.
_HINT = re.compile(r"(?i)licen[sc]e|permission|software|copy|program|distribut|right|neither the name|unless required|(?:released|published|provided|available)\s+\W*under")


def pieces(text: str) -> list[tuple[str, int, int, bool, int]]:
    """Normalised pieces with their places, whether a line or sentence begins there, and its number."""
    out, start, first, number = [], 0, True, 0
    for m in [*_END.finditer(text), None]:
        stop = m.start() if m else len(text)
        if plain := normalised(text[start:stop]):
            out.append((plain, start, stop, first, number))
            first = False
        if not m or m[0][0] not in ",;(":
            number += not first
            first = True
        start = m.end() if m else stop
    return out


def _from(found: list[tuple[str, int, int, bool, int]], i: int, joined: str) -> tuple[str, int] | None:
    """The longest known sentence that begins with the piece ``i``, taken as ``joined``; its last piece."""
    best, j = None, i
    while joined in _BEGINS:
        if name := _KNOWN.get(joined):
            best = name, j
        j += 1
        if j == len(found):
            break
        joined = f"{joined} {found[j][0]}"
    return best


def identified(text: str) -> list[tuple[str, int, int, int, int]]:
    """The known sentences: identifier, numbers of first and last line or sentence, start, end."""
    found, out, i = pieces(text), [], 0
    while i < len(found):
        plain, start, _, first, number = found[i]
        hit = None
        if first:
            hit = _from(found, i, plain)
            for before in (_MARK, _LEAD):
                if not hit and (m := before.match(plain)):
                    hit = _from(found, i, plain[m.end() :])
        if hit:
            name, i = hit
            out.append((name, number, found[i][4], start, found[i][2]))
        i += 1
    return out


def matches(known: list[tuple[str, int, int, int, int]]) -> list[tuple[str, int, int]]:
    """Licences whose rule the sequence fulfils, with start and end; each rule leftmost, without overlap."""
    out, have = [], {k[0] for k in known}
    for licence, rule in RULES:
        if not have.issuperset(rule):
            continue
        k = 0
        while k < len(known):
            ends = [k] if known[k][0] == rule[0] else []
            for wanted in rule[1:]:
                reached = set()
                for e in ends:
                    for j in range(e + 1, len(known)):
                        if known[j][1] - known[e][2] > GAP + 1:
                            break
                        if known[j][0] == wanted:
                            reached.add(j)
                ends = sorted(reached)
            if ends:
                out.append((licence, known[k][3], known[ends[0]][4]))
                k = ends[0]
            k += 1
    return sorted(out, key=lambda m: (m[1], m[2], m[0]))


def scan(text: str | None) -> tuple[int, str, list[tuple[str, int, int]]]:
    """Known sentences, their identifiers in order, and the licences matched."""
    if not text or not _HINT.search(text):
        return 0, "", []
    known = identified(text)
    return len(known), ",".join(k[0] for k in known), matches(known)


def licences(text: Column) -> Column:
    """Struct per text: ``n_known``, ``sentence_ids``, ``spans`` (licence:start:end), ``licences``."""

    @F.arrow_udf("struct<n_known: bigint, sentence_ids: string, spans: string, licences: string>")
    def run(texts: pa.Array) -> pa.Array:
        rows = [scan(t.as_py()) for t in texts]
        return pa.StructArray.from_arrays(
            [
                pa.array([r[0] for r in rows], pa.int64()),
                pa.array([r[1] for r in rows], pa.string()),
                pa.array([",".join(f"{a}:{b}:{c}" for a, b, c in r[2]) for r in rows], pa.string()),
                pa.array([",".join(sorted({m[0] for m in r[2]})) for r in rows], pa.string()),
            ],
            names=["n_known", "sentence_ids", "spans", "licences"],
        )

    return run.asNondeterministic()(text)
