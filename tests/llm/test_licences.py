import itertools
import random
import re
import time

import pytest

from growthlab.llm import licences

APACHE = (
    '/* Licensed under the Apache License, Version 2.0 (the "License");\n * you may not use this file except in '
    "compliance with the License.\n * You may obtain a copy of the License at\n * http://x */"
)


def names(text):
    hinted, every = (licences.Scanner(licences.SENTENCES, licences.RULES, h).scan(text) for h in (licences.HINTS, ()))
    assert hinted == every
    return [x["licence"] for x in every[1]]


def test_every_sentence_has_a_hint():
    for name, pattern in licences.SENTENCES.items():
        for part in licences.NAMES.values() if name.startswith("named-") else [pattern]:
            words = re.sub(r"\(([^()]|\([^()]*\))*\)\??", " ", part) if name != "epl-1.0" else part
            found = [h for h in licences.HINTS if h in words or h in part]
            assert found, name


def test_rules_take_sequences_in_order():
    assert names(APACHE) == ["Apache-2.0"]
    far = "Bar bar baz. " * 40
    assert names(f"Foo. Licensed under the Apache License, Version 2.0. {far}\nAll rights reserved.") == ["Apache-2.0", "proprietary"]
    assert names("Foo. Licensed under the Apache License, Version 2.0. Bar bar.\nAll rights reserved.") == ["Apache-2.0"]
    bsd = "Redistribution and use in source and binary forms, with or without modification, are permitted.\n"
    source = "Redistributions of source code must retain the above copyright notice, x.\n"
    binary = "Redistributions in binary form must reproduce the above copyright notice, x.\n"
    last = "Neither the name of X may be used to endorse or promote products derived from it.\n"
    assert names(bsd + source + binary + last) == ["BSD-3-Clause"]
    assert names(bsd + source + binary) == ["BSD-2-Clause"]
    assert names(bsd + binary + source) == []  # the order matters
    assert names(bsd + "Some other text stands here.\n" + source + binary) == []


def test_places_and_odd_rows(spark):
    text = "é x.\nReleased under the MIT License. And more. Released under the MIT License."
    rows = [(1, text, 0), (1, text, 0), (None, None, 0), (2, "", 0), (3, "z " * 50_000, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, licences int")
    out = licences.scan_licences(docs).collect()
    assert len(out) == 5
    for r in out:
        got = [text[x.start : x.end] for x in r.licences]
        assert got == (["Released under the MIT License."] * 2 if r.doc_id == 1 else [])
        assert len(r.sentences) == len(r.licences)
    assert licences.scan_licences(docs.limit(0)).count() == 0


def test_known_lines_are_all_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = licences.scan_licences(docs.select("doc_id", "text")).collect()
    found = {(r.doc_id, x.licence) for r in out for x in r.licences}
    lines = {
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Released under the MIT License.": "MIT",
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "All rights reserved.": "proprietary",
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
    }
    want, near = set(), set()
    for d in docs.collect():
        places = [(m.start(), m.end(), name) for line, name in lines.items() for m in re.finditer(re.escape(line), d.text or "")]
        for low, high, name in places:
            others = [(a, b) for a, b, n in places if n != "proprietary"]
            weak = name == "proprietary" and any(a - high <= licences.NEAR and low - b <= licences.NEAR for a, b in others)
            (near if weak else want).add((d.doc_id, name))
    assert want and found == want | (found & near) and not (near - want) & found


MIT = """MIT License

Copyright (c) 2020 X Y

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
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY.
"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above
   copyright notice, this list of conditions and the following disclaimer in the
   documentation and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
"""


def test_wrapped_sentences_are_joined():
    two = BSD[: BSD.index("3. ")]
    for text, name, first, last in (
        (MIT, "MIT", "Permission is", "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."),
        (BSD, "BSD-3-Clause", "Redistribution and", "written permission."),
        (two, "BSD-2-Clause", "Redistribution and", "with the distribution."),
        (GPL, "GPL-3.0-or-later", "This program is free", "FITNESS FOR A PARTICULAR PURPOSE."),
    ):
        for mark in ("", " * ", "# ", "// ", "-- "):
            for end in ("\n", "\r\n"):
                wrapped = end.join((mark + x).rstrip() for x in ("Zz yy.\n\n" + text + "\nXx.").split("\n"))
                got = licences.Scanner(licences.SENTENCES, licences.RULES).scan(wrapped)[1]
                assert [x["licence"] for x in got] == [name], (mark, name)
                place = wrapped[got[0]["start"] : got[0]["end"]]
                assert place.removeprefix(mark).startswith(first) and place.endswith(last)


def test_lines_stay_known_beside_joined_sentences():
    scan = licences.Scanner(licences.SENTENCES, licences.RULES).scan
    text = "SPDX-License-Identifier: MIT\nimport x\nCopyright (c) 2020 X\nAll rights reserved\nb c"
    hits, found = scan(text)
    assert [text[x["start"] : x["end"]] for x in hits] == [text.split("\n")[k] for k in (0, 2, 3)]
    assert [x["licence"] for x in found] == ["MIT"]
    assert names("Released under the\n\nMIT License.") == []  # a blank line ends a paragraph
    assert names("# Released under the\n# MIT License.") == ["MIT"]
    assert names("no licence here\n" * 20_000 + "Released under\nthe MIT License.") == ["MIT"]
    assert names("Licensed under CC BY 4.0 not\n" * 2_000) == []


def gnu(title, version, later, mark=";", name="program"):
    either = f"either version {version} of the License, or\n(at your option) any later version." if later else f"version {version} of the License."
    return (
        f"This {name} is free software{mark} you can redistribute it and/or\nmodify it under the terms of the {title}\n"
        f"as published by the Free Software Foundation; {either}\n\nThis {name} is distributed in the hope that it will be useful,\n"
        f"but WITHOUT ANY WARRANTY.\n"
    )


@pytest.mark.parametrize("text, name", [
    (gnu("GNU General Public License", 2, True), "GPL-2.0-or-later"),
    (gnu("GNU General Public License", 2, False), "GPL-2.0-only"),
    (gnu("GNU General Public License", 3, True, ":"), "GPL-3.0-or-later"),
    (gnu("GNU Lesser General Public License", "2.1", True, name="library"), "LGPL-2.1-or-later"),
    (gnu("GNU Library General Public License", 2, True, name="library"), "LGPL-2.0-or-later"),
    (gnu("GNU Affero General Public License", 3, True, ":"), "AGPL-3.0-or-later"),
    (gnu("GNU General Public License", 9, True), "GPL"),
    ("This program is free software; you can redistribute it and/or modify\nit under the terms of the GNU General Public License version 2 as\npublished by the Free Software Foundation.", "GPL-2.0-only"),
    ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"),
    ("Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH\nREGARD TO THIS SOFTWARE.", "ISC"),
    ("This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this file, x.", "MPL-2.0"),
    ("This program and the accompanying materials are made available under the\nterms of the Eclipse Public License 2.0 which is available at\nhttps://x", "EPL-2.0"),
    ("All rights reserved. This program and the accompanying materials\nare made available under the terms of the Eclipse Public License v1.0\nwhich accompanies this distribution.", "EPL-1.0"),
    ("This is free and unencumbered software released into the public domain.", "Unlicense"),
    ("To the extent possible under law, Jane Doe has waived all copyright and\nrelated or neighboring rights to This Thing.", "CC0-1.0"),
    ("This software is provided 'as-is', without any express or implied\nwarranty.", "Zlib"),
    ("Distributed under the Boost Software License, Version 1.0.", "BSL-1.0"),
    ("# SPDX-License-Identifier: mit", "MIT"),
    ("Copyright (c) 2020 X. All rights reserved.\n\n" + BSD, "BSD-3-Clause"),
    ("Copyright (c) 2020 X.\nAll rights reserved.", "proprietary"),
])
def test_standard_notices(text, name):
    for mark in ("", "# ", " * "):
        lines = "\n".join((mark + x).rstrip() for x in text.split("\n"))
        assert names(f"Zz yy.\n\n{lines}\n\nXx.") == [name], mark


def test_expressions_name_their_licences():
    assert names("// SPDX-License-Identifier: (MIT OR apache-2.0) AND GPL-2.0-only WITH Linux-syscall-note") == ["Apache-2.0", "GPL-2.0-only", "MIT"]
    assert names("SPDX-License-Identifier: LicenseRef-x") == ["LicenseRef-x"]


def test_rule_matching_against_brute_force():
    kinds = {k: k for k in "abcde"}
    rules = (("X", ("a", "b?", "c")), ("Y", ("a", "b")), ("Z", ("d?", "e")), ("X", ("c",)))
    scanner, draw = licences.Scanner(kinds, rules), random.Random(4)
    for _ in range(500):
        line = [draw.choice([*"abcde", None]) for _ in range(draw.randrange(12))]
        left, want = list(line), []
        for licence, names_ in rules:
            forms = {tuple(n[0] for n, keep in zip(names_, mask) if keep or not n.endswith("?")) for mask in itertools.product((0, 1), repeat=len(names_))}
            at = 0
            while at < len(left):
                fits = [f for f in sorted(forms, key=len, reverse=True) if tuple(left[at : at + len(f)]) == f]
                if fits:
                    want.append((licence, at, at + len(fits[0]) - 1))
                    left[at : at + len(fits[0])] = ["taken"] * len(fits[0])
                    at += len(fits[0])
                else:
                    at += 1
        assert sorted(scanner.take(line)) == sorted(want)


@pytest.mark.parametrize("body", [
    "\n".join(f"Neither the name of\nCopyright 2020 X{k}" for k in range(2500)) + "\nmay be used to endorse or promote products x",
    "Neither the name of\n" * 5000 + "may be used to endorse or promote products x",
    "Neither the name of " * 8000 + "x",
    "this program is free software; you can redistribute it and/or\nmodify it " * 2500,
    "permission is hereby granted, free of charge, to any person obtaining a copy\nx\n" * 2500,
    "a\n" * 30_000,
    "to the extent possible under law,\n" * 4000,
])
def test_hostile_texts_take_little_time(body):
    scanner = licences.Scanner(licences.SENTENCES, licences.RULES)
    scanner.scan("warm up")
    began = time.perf_counter()
    scanner.scan(body)
    assert time.perf_counter() - began < 2.5
