"""Licence scans by sentence rules.

A text's lines and sentences are normalised and looked up in a table of known licence sentences; a sentence
that is wrapped over several lines of a paragraph is joined, without the comment marks in front of its
lines. What is left of a text is a sequence of sentence identifiers, with a gap wherever other text stands between. Rules
name a licence by a sequence of identifiers; they are tried in their order, longest notices first, and the
sentences that a rule takes are not seen by later rules."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from growthlab.llm.storage import ready, without

#: Titles of the GNU licences, with the versions that their notices name.
GNU: dict[str, tuple[str, tuple[str, ...]]] = {
    "AGPL": ("gnu affero general public license", ("3",)),
    "LGPL": ("gnu (lesser|library) general public license", ("2", "2.1", "3")),
    "GPL": ("gnu general public license", ("1", "2", "3")),
}
#: Names that stand in "released under the ... licence".
NAMES: dict[str, str] = {
    "MIT": r"mit license",
    "ISC": r"isc license",
    "BSD-2-Clause": r"(bsd 2-clause|2-clause bsd|simplified bsd) license",
    "BSD-3-Clause": r"(bsd 3-clause|3-clause bsd|new bsd|modified bsd) license",
    "BSL-1.0": r"boost software license,? version 1\.0",
    "MPL-1.1": r"mozilla public license,? (version|v\.?) ?1\.1",
    "MPL-2.0": r"mozilla public license,? (version|v\.?) ?2\.0",
    "EPL-1.0": r"eclipse public license,? (version |v ?\.? ?|- v ?)?1\.0",
    "EPL-2.0": r"eclipse public license,? (version |v ?\.? ?|- v ?)?2\.0",
    "CC0-1.0": r"(cc0|creative commons zero|cc0 1\.0 universal)( license)?( 1\.0)?",
    "Unlicense": r"unlicense",
}
_TRIED = r"(released|licensed|distributed|available|published)"
_THIS = r"(this|the) (program|library|software|file|code|work|project)|%s"


def _gnu_sentences() -> dict[str, str]:
    """The notice's first sentence by family, version and whether later versions may be chosen; the family alone where
    the version is another one."""
    out = {}
    for family, (title, versions) in GNU.items():
        free = (
            r"([\w.+-]+ |(this|the) ([\w.+-]+ )?)(program|library|software|file|code)? ?is free software[:;,]? you (can|may) "
            rf"redistribute it and/or modify it under the terms of the {title},?"
        )
        for v in versions:
            version = rf"(version |v\.? ?){re.escape(v)}(\.0)?( of the license)?"
            by = r"( as published by the free software foundation[;,:]?)?"
            named = rf"{free}({by} (either )?{version}| {version}{by})"
            out[f"{family}-{v}-later"] = rf"{named},? or,? \(?at your option\)?,? any later version.*"
            out[f"{family}-{v}-only"] = rf"{named}( only)?"
        out[f"{family}-free"] = rf"{free} .*"
        for v in versions:
            out[f"{family}-{v}-named"] = rf"({_THIS % '[^ ]+'}) is {_TRIED} under (the terms of )?the {title},? (version |v\.? ?){re.escape(v)}(\.0)?"
    return out


#: The wording of public licence notices, as normalised regular expressions by identifier. Earlier ones
#: are tried first.
SENTENCES: dict[str, str] = {
    "apache-header": r"licensed under the apache license,? version 2\.0( \(the license\))?",
    "apache-use": r"you may not use this file except in compliance with the license",
    "apache-copy": r"you may obtain a copy of the license at",
    "apache-warranty": r"unless required by applicable law or agreed to in writing,? software .*",
    "mit-permission": r"permission is hereby granted,? free of charge,? to any person obtaining a copy .*",
    "mit-notice": r"the above copyright notice and this permission notice shall be included in .*",
    "as-is": r"the software is provided as is,? without warranty of any kind.*",
    "isc-permission": r"permission to use,? copy,? modify,? and(/or)? distribute this software for any purpose with or without fee is hereby granted,? .*",
    "isc-as-is": r"the software is provided as is and .* disclaims all warranties.*",
    "bsd-redistribution": r"redistribution and use in source and binary forms,? with or without modification,? .*",
    "bsd-source": r"redistributions of source code must retain the above copyright notice.*",
    "bsd-binary": r"redistributions in binary form must reproduce the above copyright notice.*",
    "bsd-endorse": r"neither the name of .* may be used to endorse or promote products .*",
    **_gnu_sentences(),
    "gnu-hope": r"(this|the) [\w.+-]+ is distributed in the hope that it will be useful,? .*",
    "gnu-copy": r"you should have received a copy of the gnu ([a-z]+ )?general public license along with .*",
    "cc-by-nc": r"licensed under cc by-nc 4\.0",
    "cc-by-sa": r"licensed under cc by-sa 4\.0",
    "cc-by": r"licensed under cc by 4\.0",
    "cc0-waiver": r"to the extent possible under law,? .* ha(s|ve) (waived|dedicated) all copyright and related (and|or) neighbou?ring rights to .*",
    "mpl-1.1": r"the contents of this file are subject to the mozilla public license version 1\.1.*",
    "mpl-2.0": r"this source code form is subject to the terms of the mozilla public license,? v\. ?2\.0",
    "epl-1.0": r"(this program and the accompanying materials|all rights reserved\. this program and the accompanying materials) are made available under the terms of the eclipse public license,? (version |v ?\.? ?)?1\.0.*",
    "epl-2.0": r"this program and the accompanying materials are made available under the terms of the eclipse public license,? (version |v ?\.? ?)?2\.0.*",
    "unlicense": r"this is free and unencumbered software released into the public domain",
    "zlib": r"this software is provided as-is,? without any express or implied warranty",
    **{f"named-{k}": rf"((({_THIS % '[^ ]+'}) is )?{_TRIED} under (the terms of )?(the )?|license: ?){v}" for k, v in NAMES.items()},
    "spdx": r"spdx-license-identifier: .*",
    "copyright": r"copyright (\(c\)|©)? ?.*",
    "rights": r"all rights reserved",
}

#: Every sentence above has one of these in a word, so a text without any needs no look-up.
HINTS = (
    "licen", "copyright", "warrant", "redistribut", "permission", "rights", "applicable", "endorse", "hope",
    "unencumbered", "cc0", "creative",
)

#: Sentences that end with their line, whatever stands in the next one.
LINES = frozenset({"spdx", "copyright"})

#: what a rule with an SPDX expression gives: the identifiers of the expression
EXPRESSION = "SPDX"
#: a licence that only counts where no other one is near
WEAK = "proprietary"


def _gnu_rules() -> list[tuple[str, tuple[str, ...]]]:
    rest = ("gnu-hope?", "gnu-copy?")
    rules = []
    for family, (_, versions) in GNU.items():
        for v in versions:
            full = v if "." in v else f"{v}.0"
            rules.append((f"{family}-{full}-or-later", (f"{family}-{v}-later", *rest)))
            rules.append((f"{family}-{full}-only", (f"{family}-{v}-only", *rest)))
            rules.append((f"{family}-{full}", (f"{family}-{v}-named",)))
        rules.append((family, (f"{family}-free", *rest)))
    return rules


#: Licence, the sentences of its notice in order ("?" behind one that may be missing), in rule order.
RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("Apache-2.0", ("apache-header", "apache-use?", "apache-copy", "apache-warranty?")),
    ("BSD-3-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary")),
    *_gnu_rules(),
    ("MIT", ("mit-permission", "mit-notice?", "as-is?")),
    ("ISC", ("isc-permission", "isc-as-is?")),
    ("Apache-2.0", ("apache-header",)),
    ("CC-BY-NC-4.0", ("cc-by-nc",)),
    ("CC-BY-SA-4.0", ("cc-by-sa",)),
    ("CC-BY-4.0", ("cc-by",)),
    ("CC0-1.0", ("cc0-waiver",)),
    ("MPL-1.1", ("mpl-1.1",)),
    ("MPL-2.0", ("mpl-2.0",)),
    ("EPL-1.0", ("epl-1.0",)),
    ("EPL-2.0", ("epl-2.0",)),
    ("Unlicense", ("unlicense",)),
    ("Zlib", ("zlib",)),
    *[(k, (f"named-{k}",)) for k in NAMES],
    (EXPRESSION, ("spdx",)),
    (WEAK, ("copyright?", "rights")),
)

#: characters of the longest known sentence: pieces are joined up to here, so the work is in proportion to the text
LONGEST = 1000
#: characters to the next licence within which "all rights reserved" says nothing
NEAR = 400
_IDENTIFIER = re.compile(r"[A-Za-z0-9][A-Za-z0-9.+-]*")

_LINE = re.compile(r"[^\r\n]+")
_CUT = re.compile(r"(?<=[.!?;])[ \t]+(?=[A-Z\"'(<])")
#: comment marks in front of a line and behind it, and the number of a list item
_HEAD = re.compile(r"[ \t*#/;|!<>%-]*")
_TAIL = re.compile(r"[ \t]+[*#/|>-]*[ \t]*$")
_ITEM = re.compile(r"\(?(?:\d{1,2}|[A-Za-z])[.)][ \t]+(?=\S)")
_EDGE = " \t*#/;|-.,:!>\"'"


class Piece(NamedTuple):
    """A line, or the part of a line that lies in one sentence: its place, and its text without marks."""

    start: int
    end: int
    body: str


def normalise(sentence: str) -> str:
    """Lower case, single spaces, no comment marks or closing punctuation, no quotes."""
    return _plain(sentence).strip(_EDGE)


def _plain(sentence: str) -> str:
    return " ".join(sentence.lower().replace('"', "").replace("'", "").split())


class Scanner:
    """Known sentences and rules, compiled."""

    def __init__(
        self, sentences: dict[str, str], rules: Sequence[tuple[str, tuple[str, ...]]], hints: Sequence[str] = ()
    ) -> None:
        self.hints = re.compile("|".join(map(re.escape, hints)))  # none: every text is looked at
        self.each = [re.compile(s) for s in sentences.values()]
        self.names = list(sentences)
        self.known = re.compile("|".join(f"({s})" for s in sentences.values()))
        groups, at = [], 1
        for s in sentences.values():
            groups.append(at)
            at += 1 + re.compile(s).groups
        self.groups = groups
        code = {name: chr(0xE000 + k) for k, name in enumerate(self.names)}
        self.code = code
        self.rules = [
            (licence, re.compile("".join(code[n.rstrip("?")] + ("?" if n.endswith("?") else "") for n in seq)))
            for licence, seq in rules
        ]

    def identify(self, sentence: str) -> str | None:
        found = self.known.fullmatch(sentence)
        return self.names[self._which(found)] if found else None

    def _which(self, found: re.Match) -> int:
        return next(k for k, g in enumerate(self.groups) if found.group(g) is not None)

    def _known(self, run: list[Piece]) -> Iterator[tuple[str | None, int, int]]:
        """The known sentences of a run and the other pieces (None), with their places.

        A sentence is the fewest pieces that are one. Where its wording is open at the end it goes on to the end
        of the run, of a closed line, or to the next known sentence."""
        joined, lows, highs, at = [], [], [], 0
        for piece in run:
            plain = _plain(piece.body)
            lows.append(at + len(plain) - len(plain.lstrip(_EDGE)))
            highs.append(max(lows[-1], at + len(plain.rstrip(_EDGE))))
            joined.append(plain)
            at += len(plain) + 1
        text, first, alone = " ".join(joined), {}, {}

        def begins(i: int) -> tuple[int, int] | None:
            """Number of the known sentence that starts with piece i, and its last piece."""
            if i not in first:
                first[i] = None
                far = lows[i] + LONGEST
                if self.known.match(text, lows[i], far):  # else no join of pieces from here on is known
                    first[i] = least([k for k, s in enumerate(self.each) if s.match(text, lows[i], far)], i)
            return first[i]

        def least(those: list[int], i: int) -> tuple[int, int] | None:
            for j in range(i, len(run)):
                if highs[j] - lows[i] > LONGEST or j > i and starts(j):
                    return None
                for k in those:
                    if (j > i or run[i].end - run[i].start >= 8) and self.each[k].fullmatch(text, lows[i], highs[j]):
                        return k, j
                those = [k for k in those if self.names[k] not in LINES]
                if not those:
                    return None
            return None

        def starts(j: int) -> bool:
            """Whether piece j alone is a known sentence, and not the middle of one ("copyright holders")."""
            if j not in alone:
                found = highs[j] - lows[j] <= LONGEST and self.known.fullmatch(text, lows[j], highs[j])
                name = self.names[self._which(found)] if found else None
                alone[j] = name is not None and (name not in LINES or not run[j].body[:1].islower())
            return alone[j]

        i = 0
        while i < len(run):
            found, j = begins(i), i
            if found:
                k, j = found
                while j + 1 < len(run) and self.names[k] not in LINES and run[j].body[-1:] not in ".!?:":
                    after = begins(j + 1)
                    if after and (self.names[after[0]] not in LINES or not run[j + 1].body[:1].islower()):
                        break
                    if highs[j + 1] - lows[i] > LONGEST or not self.each[k].fullmatch(text, lows[i], highs[j + 1]):
                        break
                    j += 1
                if j > found[1]:  # the longer wording may be an earlier sentence of the table
                    k = self._which(self.known.fullmatch(text, lows[i], highs[j]))
            yield self.names[k] if found else None, run[i].start, run[j].end
            i = j + 1

    def scan(self, text: str) -> tuple[list[dict], list[dict]]:
        """Known sentences (identifier, start, end) and licences (licence, start, end) in text order."""
        hits: list[dict | None] = []
        if not self.hints.search(text.lower().replace('"', "").replace("'", "")):
            return [], []
        for run in _runs(text):
            for name, start, end in self._known(run):
                if name:
                    hits.append({"sentence": name, "start": start, "end": end})
                elif hits and hits[-1] is not None:
                    hits.append(None)  # other text parts two notices
        found = []
        for licence, first, last in self.take([h and h["sentence"] for h in hits]):
            start, end = hits[first]["start"], hits[last]["end"]
            for name in _identifiers(text[start:end]) if licence == EXPRESSION else (licence,):
                found.append({"licence": name, "start": start, "end": end})
        found.sort(key=lambda x: (x["start"], x["licence"]))
        return [h for h in hits if h], _strong(found)

    def take(self, sequence: Sequence[str | None]) -> list[tuple[str, int, int]]:
        """(licence, first, last) of every rule's matches in a sequence of identifiers and gaps (None). A rule takes its
        matches from left to right, the longest at each place; what it takes later rules do not see."""
        line, out = "".join(" " if name is None else self.code[name] for name in sequence), []
        for licence, rule in self.rules:
            out += [(licence, m.start(), m.end() - 1) for m in rule.finditer(line)]
            line = rule.sub(lambda m: "\0" * len(m.group()), line)
        return out


def _identifiers(line: str) -> list[str]:
    """The licences of an SPDX expression, each once; exceptions after WITH are none."""
    expression = re.sub(r"(?i)\bwith\s+[^\s()]+", " ", line.partition(":")[2])
    names = [n.rstrip(".") for n in _IDENTIFIER.findall(expression) if n.upper() not in ("AND", "OR")]
    return list(dict.fromkeys(_SPELLING.get(n.lower(), n) for n in names))


#: identifiers that rules give, by their lower case
_SPELLING = {licence.lower(): licence for licence, _ in RULES}


def _strong(found: list[dict]) -> list[dict]:
    """Without the weak licences that have another one near."""
    out, after = [], None
    for x in reversed(found):  # the next licence's start
        near = after is not None and after - x["end"] <= NEAR
        out.append((x, near))
        after = after if x["licence"] == WEAK else x["start"]
    kept, before = [], None
    for x, near in reversed(out):
        near = near or before is not None and x["start"] - before <= NEAR
        if x["licence"] != WEAK or not near:
            kept.append(x)
        before = before if x["licence"] == WEAK else x["end"]
    return kept


def _runs(text: str) -> Iterator[list[Piece]]:
    """Pieces between which only a line break stands, and no end of a sentence or paragraph."""
    run, below = [], 0  # below: where the line before ends
    for m in _LINE.finditer(text):
        low, high = m.span()
        blank = text[below:low].replace("\r\n", "\n")
        below = high
        head = _HEAD.match(text, low, high).end()
        tail = _TAIL.search(text, head, high)
        last = tail.start() if tail else high
        closed = not run or len(blank) > 1 or run[-1].body[-1:] in ".!?;:"
        item = _ITEM.match(text, head, last) if closed else None
        if item:
            head = item.end()
        if run and (len(blank) > 1 or item or not text[head:last].strip(_EDGE) or _ends(run[-1].body, text[head : head + 1])):
            yield run
            run = []
        if not text[head:last].strip(_EDGE):
            continue
        start, at = low, head
        for cut in _CUT.finditer(text, head, last):
            run.append(Piece(start, cut.start(), text[at : cut.start()]))
            yield run
            run, start, at = [], cut.end(), cut.end()
        run.append(Piece(start, high, text[at:last]))
    if run:
        yield run


def _ends(body: str, following: str) -> bool:
    return body[-1:] in ".!?;" and (following.isupper() or following in "\"'(<")


_HITS = "array<struct<sentence: string, start: int, end: int>>"
_FOUND = "array<struct<licence: string, start: int, end: int>>"


def scan_licences(
    docs: DataFrame,
    text_col: str = "text",
    sentences: dict[str, str] = SENTENCES,
    rules: Sequence[tuple[str, tuple[str, ...]]] = RULES,
) -> DataFrame:
    """The documents' columns but the text, and sentences (known sentences with their places) and licences
    (licences with their places), in text order, places in code points.

    An SPDX line gives the identifiers of its expression; "all rights reserved" counts where no other licence
    stands within NEAR characters. NULL and empty texts have neither; the work grows with a text's length, as
    no known sentence is longer than LONGEST characters. Rows are scanned one by one, so repeated rows and NULL ids stay as they
    are. Two rules that could take the same sentence: the earlier rule takes it. Input columns named like a
    result are replaced."""
    ready(docs.sparkSession)
    rows = without(docs, "sentences", "licences")
    fields = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes if c != text_col)
    hit = pa.list_(pa.struct([("sentence", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    hints = HINTS if sentences is SENTENCES else ()
    found = pa.list_(pa.struct([("licence", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(sentences, rules, hints)
        for batch in batches:
            got = [scanner.scan(t or "") for t in batch[text_col].to_pylist()]
            out = batch.drop_columns([text_col])
            out = out.append_column("sentences", pa.array([g[0] for g in got], type=hit))
            yield out.append_column("licences", pa.array([g[1] for g in got], type=found))

    return rows.mapInArrow(run, f"{fields}, sentences {_HITS}, licences {_FOUND}")
