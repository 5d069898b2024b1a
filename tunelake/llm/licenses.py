"""Licence wordings found by matching templates with markup.

A template is a licence's or notice's wording. Marked regions may differ:

===================== ========================================================
<<optional>> … <<end>>  the words between may be left out (regions may nest)
<<any 0-8>>             replaceable: that many words, whatever they are
<<one a b/c>>           replaceable by one of the wordings between the slashes
===================== ========================================================

All other words are mandatory and must follow one another exactly. Templates
are compiled into one token automaton, which reads a text's words once and
knows after each whether a wording ends there; its deterministic states are
made when first met and forgotten when they become many. The same automaton
over the reversed templates finds where a wording begins.

Words are runs of digits, ASCII letters (lower-cased) and characters beyond
ASCII; case and punctuation are thus no difference.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunelake.llm.common import quoted, ship

# Deterministic states kept at a time, and bytes of text split into words at a time.
MOST_STATES = 20_000
BLOCK_BYTES = 1 << 20

# The contract's phrases and labels.
BASE = {"gpl": ["gnu general public license"], "apache": ["apache license"], "cc-by": ["cc by"], "mit": ["mit license"]}

UNDER = "<<one licensed/released/distributed/available/published/provided>> under <<optional>>the terms of<<end>> the"

# Wordings of public licences and of their usual notices, by label.
TEMPLATES = {
    "mit": [f"{UNDER} mit <<one license/licence>>", """
        permission is hereby granted free of charge to any person obtaining a copy of this software and
        <<optional>>associated documentation files<<end>> the software to deal in the software without restriction including without
        limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit
        persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this
        permission notice <<optional>>including the next paragraph<<end>> shall be included in all copies or substantial portions of the
        software <<optional>>the software is provided as is without warranty of any kind express or implied including but not limited to
        the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall <<any 1-12>> be liable
        for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection
        with the software or the use or other dealings in the software<<end>>"""],
    "apache-2.0": [f"{UNDER} apache <<one license/licence>> version 2 <<optional>>0<<end>>", """
        licensed under the apache license version 2 0 the license you may not use this <<one file/work/software>> except in compliance
        with the license you may obtain a copy of the license at <<one http/https>> www apache org licenses license 2 0
        <<optional>>unless required by applicable law or agreed to in writing software distributed under the license is distributed on an
        as is basis without warranties or conditions of any kind either express or implied see the license for the specific language
        governing permissions and limitations under the license<<end>>"""],
    "gpl-2.0": [f"{UNDER} gnu general public <<one license/licence>> <<optional>>as published by the free software foundation<<end>> "
                "<<optional>>either<<end>> version 2"],
    "gpl-3.0": [f"{UNDER} gnu general public <<one license/licence>> <<optional>>as published by the free software foundation<<end>> "
                "<<optional>>either<<end>> version 3"],
    "gpl-2.0-or-later": ["under the terms of the gnu general public license as published by the free software foundation either "
                         "version 2 <<optional>>of the license<<end>> or at your option any later version"],
    "gpl-3.0-or-later": ["under the terms of the gnu general public license as published by the free software foundation either "
                         "version 3 <<optional>>of the license<<end>> or at your option any later version"],
    "lgpl": ["gnu <<one lesser/library>> general public <<one license/licence>>"],
    "agpl-3.0": [f"{UNDER} gnu affero general public <<one license/licence>> <<optional>>as published by the free software "
                 "foundation<<end>> <<optional>>either<<end>> version 3"],
    "cc-by-4.0": ["<<one licensed/released/available>> under <<one cc by/creative commons attribution>> 4 0"],
    "cc-by-sa-4.0": ["<<one licensed/released/available>> under <<one cc by sa/creative commons attribution sharealike>> 4 0"],
    "cc-by-nc-4.0": ["<<one licensed/released/available>> under <<one cc by nc/creative commons attribution noncommercial>> 4 0"],
    "cc-by-nc-sa-4.0": ["<<one licensed/released/available>> under "
                        "<<one cc by nc sa/creative commons attribution noncommercial sharealike>> 4 0"],
    "cc0-1.0": ["<<one licensed/released/dedicated/available>> <<one under/to>> <<optional>>the<<end>> "
                "<<one cc0/public domain under cc0/creative commons zero>> <<optional>>1 0<<end>>"],
    "bsd-3-clause": ["""
        redistribution and use in source and binary forms with or without modification are permitted provided that the following
        conditions are met <<optional>>1<<end>> redistributions of source code must retain the above copyright notice this list of
        conditions and the following disclaimer <<optional>>2<<end>> redistributions in binary form must reproduce the above copyright
        notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the
        distribution <<optional>>3<<end>> neither the name of <<any 1-12>> may be used to endorse or promote products derived from this
        software without specific prior written permission"""],
    "bsd-2-clause": ["""
        redistribution and use in source and binary forms with or without modification are permitted provided that the following
        conditions are met <<optional>>1<<end>> redistributions of source code must retain the above copyright notice this list of
        conditions and the following disclaimer <<optional>>2<<end>> redistributions in binary form must reproduce the above copyright
        notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the
        distribution this software is provided by <<any 1-8>> as is"""],
    "isc": ["""
        permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that
        the above copyright notice and this permission notice appear in all copies"""],
    "zlib": ["""
        this software is provided as is without any express or implied warranty in no event will the <<one author/authors>> be held liable
        for any damages arising from the use of this software permission is granted to anyone to use this software for any purpose
        including commercial applications and to alter it and redistribute it freely subject to the following restrictions"""],
    "mpl-2.0": ["""
        this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with
        this file you can obtain one at <<any 0-1>> mozilla org mpl 2 0"""],
    "unlicense": ["""
        this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or
        distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by
        any means"""],
}

# byte -> the same, lower-cased, or a space if it is in no word
LOWERED = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(LOWERED).split()


@dataclass(frozen=True)
class Template:
    """One wording: its label, its parts in order (a word; ``("optional",
    parts)``; ``("any", least, most)``; ``("one", wordings)``), and whether it
    is one of the base phrases."""

    label: str
    parts: tuple
    base: bool = False

    @property
    def wording(self) -> int:
        """Its mandatory words."""
        return sum(1 if isinstance(p, bytes) else min(map(len, p[1])) if p[0] == "one" else 0 for p in self.parts)


def parse(markup: str) -> tuple:
    """The parts of a template's markup; bad markup raises."""
    stack: list[list] = [[]]
    for k, piece in enumerate(re.split(r"<<(.*?)>>", markup)):
        kind, _, rest = piece.partition(" ")
        if k % 2 == 0:
            stack[-1] += words_of(piece)
        elif piece == "optional":
            stack.append([])
        elif piece == "end" and len(stack) > 1:
            inner = tuple(stack.pop())
            stack[-1].append(("optional", inner))
        elif kind == "any" and (m := re.fullmatch(r"(\d+)-(\d+)", rest)) and int(m[1]) <= int(m[2]):
            stack[-1].append(("any", int(m[1]), int(m[2])))
        elif kind == "one" and all(words := [tuple(words_of(w)) for w in rest.split("/")]):
            stack[-1].append(("one", tuple(words)))
        else:
            raise ValueError(f"bad markup: <<{piece}>>")
    if len(stack) > 1:
        raise ValueError("an optional region has no end")
    return tuple(stack[0])


def templates(by_label: dict[str, Sequence[str]], base: bool = False) -> list[Template]:
    found = [Template(label, parse(markup), base) for label, wordings in by_label.items() for markup in wordings]
    for t in found:
        if not t.wording or any(not isinstance(t.parts[k], bytes) and t.parts[k][0] == "any" for k in (0, -1)):
            raise ValueError(f"{t.label}: a wording needs a mandatory word and can't begin or end with any words")
    return found


def turned(parts: tuple) -> tuple:
    """The same parts read backwards."""
    def one(p):
        if isinstance(p, bytes) or p[0] == "any":
            return p
        return ("optional", turned(p[1])) if p[0] == "optional" else ("one", tuple(w[::-1] for w in p[1]))

    return tuple(one(p) for p in reversed(parts))


class Network:
    """Places of templates: by word, by any word, and without reading one."""

    def __init__(self):
        self.by_word: list[dict[bytes, set[int]]] = []
        self.by_any: list[int | None] = []
        self.skips: list[set[int]] = []

    def place(self) -> int:
        self.by_word.append({})
        self.by_any.append(None)
        self.skips.append(set())
        return len(self.skips) - 1

    def read(self, at: int, words: Sequence[bytes]) -> int:
        for w in words:
            to = self.place()
            self.by_word[at].setdefault(w, set()).add(to)
            at = to
        return at

    def build(self, parts: tuple, at: int) -> int:
        for p in parts:
            if isinstance(p, bytes):
                at = self.read(at, [p])
            elif p[0] == "optional":
                end = self.build(p[1], at)
                at, before = self.place(), at
                self.skips[end].add(at)
                self.skips[before].add(at)
            elif p[0] == "one":
                ends = [self.read(at, w) for w in p[1]]
                at = self.place()
                for end in ends:
                    self.skips[end].add(at)
            else:
                out = self.place()
                for k in range(p[2] + 1):
                    if k >= p[1]:
                        self.skips[at].add(out)
                    if k < p[2]:
                        self.by_any[at] = to = self.place()
                        at = to
                at = out
        return at

    def reach(self, places) -> frozenset[int]:
        """The places and all that need no word from there."""
        todo, met = list(places), set(places)
        while todo:
            for to in self.skips[todo.pop()] - met:
                met.add(to)
                todo.append(to)
        return frozenset(met)

    def after(self, places, word: bytes | None) -> set[int]:
        """``word`` None: one that no template has."""
        found = set()
        for p in places:
            found.update(self.by_word[p].get(word, ()))
            if self.by_any[p] is not None:
                found.add(self.by_any[p])
        return found


class Scanner:
    def __init__(self, wordings: Sequence[Template]):
        self.wordings = list(wordings)
        self.net, self.ends, starts = Network(), {}, []
        self.back, self.back_starts, self.back_ends = Network(), [], []
        for n, t in enumerate(self.wordings):
            starts.append(self.net.place())
            self.ends[self.net.build(t.parts, starts[-1])] = n
            self.back_starts.append(self.back.place())
            self.back_ends.append(self.back.build(turned(t.parts), self.back_starts[-1]))
        self.start = self.net.reach(starts)
        if any(self.net.by_any[p] is not None for p in self.start):
            raise ValueError("a wording can't begin with any words")
        vocabulary = sorted({w for by in self.net.by_word for w in by})
        self.word_id = {w: k for k, w in enumerate(vocabulary, 1)}  # 0: any other
        self.word = [None, *vocabulary]
        self.reset()

    def reset(self) -> None:
        self.state_of: dict[frozenset[int], int] = {}
        self.places: list[frozenset[int]] = []
        self.found: list[tuple[int, ...]] = []
        self.table: dict[int, int] = {}
        self.state(self.start)

    def state(self, places: frozenset[int]) -> int:
        n = self.state_of.get(places)
        if n is None:
            n = self.state_of[places] = len(self.places)
            self.places.append(places)
            self.found.append(tuple(sorted({self.ends[p] for p in places if p in self.ends})))
        return n

    def step(self, state: int, word: int) -> int:
        """The state after a word, made now."""
        places = self.net.reach(self.net.after(self.places[state], self.word[word])) | self.start
        if len(self.places) >= MOST_STATES:
            self.reset()
            return self.state(places)
        to = self.table[state << 32 | word] = self.state(places)
        return to

    def begins(self, n: int, ids: list[int], end: int) -> list[int]:
        """Indices of the first words of the forms of wording ``n`` that end at index ``end``."""
        places, at, firsts = self.back.reach([self.back_starts[n]]), end, []
        while places:
            if self.back_ends[n] in places:
                firsts.append(at + 1)
            if at < 0:
                break
            places = self.back.reach(self.back.after(places, self.word[ids[at]]))
            at -= 1
        return firsts

    def scan(self, text: bytes | None) -> tuple[int, list[tuple[int, int, int]]]:
        """Number of words, and (wording, first word, last word) of every
        wording found: for each beginning its longest form."""
        lowered = (text or b"").translate(LOWERED)
        longest: dict[tuple[int, int], int] = {}
        kept: list[int] = []  # ids of the words before, as far back as a wording can reach
        n_words = state = 0
        reach, get, at = self.reach_back, self.word_id.get, 0
        while at < len(lowered):
            cut = lowered.find(b" ", at + BLOCK_BYTES)
            cut = len(lowered) if cut < 0 else cut
            block, at = lowered[at:cut].split(), cut
            ids = kept + [get(w, 0) for w in block]
            first = n_words - len(kept)
            table, found = self.table, self.found
            for k in range(len(kept), len(ids)):
                w = ids[k]
                if not w and not state:
                    continue
                to = table.get(state << 32 | w)
                if to is None:
                    to = self.step(state, w)
                    table, found = self.table, self.found
                state = to
                if state and found[state]:
                    for n in found[state]:
                        longest |= {(n, first + a): first + k for a in self.begins(n, ids, k)}
            n_words += len(block)
            kept = ids[-reach:]
        return n_words, sorted((n, a, b) for (n, a), b in longest.items())

    @property
    def reach_back(self) -> int:
        """Words of the longest wording, at most."""
        return len(self.net.skips)

    def report(self, text: bytes | None) -> dict:
        """What ``license_scan`` says of a text."""
        n_words, spans = self.scan(text)
        base = [(a, self.wordings[n].label) for n, a, _ in spans if self.wordings[n].base]
        most = max((self.wordings[n].wording for n, _, _ in spans), default=0)
        return {"n_words": n_words, "n_base": len(base), "first_word": min(base)[0] if base else None,
                "last_word": max(base)[0] if base else None, "base_labels": ",".join(sorted({x for _, x in base})),
                "labels": ",".join(sorted({self.wordings[n].label for n, _, _ in spans})), "score": most / (most + 2),
                "spans": [{"label": self.wordings[n].label, "first_word": a, "last_word": b, "base": self.wordings[n].base}
                          for n, a, b in spans]}


REPORT = pa.struct([("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
                    ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
                    ("spans", pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()),
                                                  ("base", pa.bool_())])))])


@lru_cache(maxsize=4)
def scanner(wordings: tuple[Template, ...]) -> Scanner:
    """One automaton per set of templates and process."""
    return Scanner(wordings)


def license_scan(docs: DataFrame, name: str = "licenses", *, text_col: str = "text", by_label: dict[str, Sequence[str]] = TEMPLATES,
                 base: dict[str, Sequence[str]] = BASE) -> DataFrame:
    """``docs`` with a struct column ``name``: n_words; n_base, first_word and
    last_word of the places of base phrases (words from 0; null without any);
    base_labels and labels (distinct, sorted, comma-joined; labels has those of
    the templates too); score; spans (label, first_word, last_word, base).

    Score: m / (m + 2) for the most mandatory words m of any wording found, so
    0 without one, 1/2 for a phrase of two words, near 1 for a whole licence.
    Null or empty text: no words, no labels (empty strings), score 0. A text of
    any length is read whole, in blocks. Rows stand for themselves: repeated
    rows, null ids and ties change nothing, no rows give none. An input column
    called ``name`` is replaced, other columns stay."""
    ship(docs.sparkSession)
    wordings = tuple(templates(base, True) + templates(by_label))

    def scan(texts: pa.Array) -> pa.Array:
        report = scanner(wordings).report
        return pa.array((report(t.as_py()) for t in texts), REPORT)

    kind = ("struct<n_words: long, n_base: long, first_word: long, last_word: long, base_labels: string, labels: string, score: double, "
            "spans: array<struct<label: string, first_word: long, last_word: long, base: boolean>>>")
    return docs.withColumn(name, F.arrow_udf(scan, kind)(quoted(text_col).cast("binary")))


def as_pattern(parts: tuple) -> str:
    """A regular expression (RE2) for the parts, where every word is followed
    by a bar."""
    def one(p) -> str:
        if isinstance(p, bytes):
            return p.decode() + r"\|"
        if p[0] == "optional":
            return f"(?:{as_pattern(p[1])})?"
        if p[0] == "any":
            return r"(?:[^|]+\|){%d,%d}" % p[1:]
        return "(?:" + "|".join(as_pattern(w) for w in p[1]) + ")"

    return "".join(map(one, parts))


def oracle_sql(by_label: dict[str, Sequence[str]] = TEMPLATES, base: dict[str, Sequence[str]] = BASE) -> str:
    """DuckDB SQL for the scan of ``documents``."""
    phrases = ", ".join(f"('{t.label}', {[w.decode() for w in t.parts]})" for t in templates(base, True))
    rules = ", ".join(f"CASE WHEN regexp_matches(bars, '\\|{as_pattern(t.parts)}') THEN {{'label': '{t.label}', 'wording': {t.wording}}} END"
                      for t in templates(by_label))
    return rf"""
WITH phrases(label, phrase) AS (VALUES {phrases}),
split AS (
    SELECT doc_id, row_number() OVER () AS row, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents),
places AS (
    SELECT row, label, len(phrase) AS wording,
        unnest(list_filter(range(len(words) - len(phrase) + 1), lambda i: words[i + 1:i + len(phrase)] = phrase)) AS start
    FROM split, phrases WHERE len(words) >= len(phrase)),
base AS (
    SELECT row, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word,
        string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM places GROUP BY row),
found AS (
    SELECT row, label, wording FROM places
    UNION ALL
    SELECT row, rule.label, rule.wording FROM (
        SELECT row, unnest([{rules}]) AS rule FROM (SELECT row, '|' || array_to_string(words, '|') || '|' AS bars FROM split))
    WHERE rule IS NOT NULL),
best AS (SELECT row, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(wording) AS most FROM found GROUP BY row)
SELECT doc_id, len(words) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
    coalesce(labels, '') AS labels, CAST(coalesce(most, 0) AS DOUBLE) / (coalesce(most, 0) + 2) AS score
FROM split LEFT JOIN base USING (row) LEFT JOIN best USING (row)"""
