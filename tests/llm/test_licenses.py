"""The automaton against a plain search that tries every reading of a template."""

import random
import re

import pytest

from tunelake.llm import licenses as L
from tunelake.llm.queries import op13_license_scan

from .conftest import SF, docs_of


def plain_words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def ends(parts, words, at):
    """Indices after which the parts can have ended, when they begin at ``at``."""
    found = {at}
    for p in parts:
        after = set()
        for a in found:
            if isinstance(p, bytes):
                after |= {a + 1} if words[a:a + 1] == [p.decode()] else set()
            elif p[0] == "optional":
                after |= {a} | ends(p[1], words, a)
            elif p[0] == "any":
                after |= {a + n for n in range(p[1], p[2] + 1) if a + n <= len(words)}
            else:
                after |= {a + len(w) for w in p[1] if words[a:a + len(w)] == [x.decode() for x in w]}
        found = after
    return found


def plain(wordings, text):
    words, found = plain_words(text), []
    for n, t in enumerate(wordings):
        for a in range(len(words)):
            found += [(n, a, max(e) - 1)] if (e := ends(t.parts, words, a)) else []
    return len(words), found


def test_random_templates():
    rng = random.Random(1)

    def some(depth=0):
        out = [rng.choice("abc")]
        for _ in range(rng.randrange(4)):
            out.append(rng.choice([rng.choice("abc"), "<<any 0-2>>", "<<any 1-3>>", "<<one a/b c/c>>",
                                   "<<optional>>" + (some(1) if not depth else "b") + "<<end>>"]))
        return " ".join(out + [rng.choice("abc")])

    for _ in range(400):
        wordings = L.templates({f"x{k}": [some()] for k in range(rng.randrange(1, 4))})
        scanner = L.Scanner(wordings)
        text = " ".join(rng.choices("abcd", k=rng.randrange(25)))
        assert scanner.scan(text.encode()) == plain(wordings, text), ([w.parts for w in wordings], text)


@pytest.mark.parametrize("states, block", [(3, 1 << 20), (20_000, 7), (3, 7)])
def test_small_limits_change_nothing(monkeypatch, states, block):
    monkeypatch.setattr(L, "MOST_STATES", states)
    monkeypatch.setattr(L, "BLOCK_BYTES", block)
    wordings = L.templates({"x": ["a <<any 0-3>> b", "a b <<optional>>c a<<end>> b"], "y": ["c <<one a/b b>> c"]})
    rng = random.Random(2)
    for _ in range(200):
        text = " ".join(rng.choices("abcd", k=60))
        assert L.Scanner(wordings).scan(text.encode()) == plain(wordings, text)


@pytest.mark.parametrize("bad", ["", "<<any 0-3>> a", "a <<any 0-3>>", "<<optional>>a<<end>>", "<<optional>>a", "a <<any 3-1>> b",
                                 "a <<one /b>> c", "a <<what>> b", "a <<end>>", "<<optional>><<any 0-2>> b<<end>> c"])
def test_bad_markup_raises(bad):
    with pytest.raises(ValueError):
        L.Scanner(L.templates({"x": [bad]}))


MIT = """Copyright (c) 2020 Someone. Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to
use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software
is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,
INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL
THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

KNOWN = [
    (MIT, "", "mit"), (MIT.replace("free of charge", "for a fee"), "", ""), (MIT.replace("AUTHORS OR COPYRIGHT HOLDERS", "OWNERS"), "", "mit"),
    ("Released under the MIT License.", "mit", "mit"), ("Licensed under CC BY-NC 4.0.", "cc-by", "cc-by,cc-by-nc-4.0"),
    ("Licensed under the Apache License, Version 2.0.", "apache", "apache,apache-2.0"),
    ("This work is licensed under the GNU General Public License, version 3.", "gpl", "gpl,gpl-3.0"),
    ("under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or "
     "(at your option) any later version", "gpl", "gpl,gpl-2.0-or-later"),
    ("GNU Lesser General Public License", "", "lgpl"), ("the commit licenses are under the apache helicopter license", "", ""),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
     "the above copyright notice and this permission notice appear in all copies.", "", "isc"),
    ("mit LICENSE mit license", "mit", "mit"), ("ÉMIT license", "", ""), ("", "", ""), (None, "", ""),
]


@pytest.mark.parametrize("text, base, labels", KNOWN)
def test_known_texts(text, base, labels):
    scanner = L.scanner(tuple(L.templates(L.BASE, True) + L.templates(L.TEMPLATES)))
    got = scanner.report(None if text is None else text.encode())
    assert (got["base_labels"], got["labels"]) == (base, labels)
    assert 0 <= got["score"] <= 1 and (got["score"] > 0) == bool(labels)
    assert got["n_words"] == len(plain_words(text))


def expected(text):
    wordings = L.templates(L.BASE, True) + L.templates(L.TEMPLATES)
    n, spans = plain(wordings, text)
    base = [a for k, a, _ in spans if wordings[k].base]
    most = max((wordings[k].wording for k, _, _ in spans), default=0)
    return (n, len(base), min(base, default=None), max(base, default=None),
            ",".join(sorted({wordings[k].label for k, _, _ in spans if wordings[k].base})),
            ",".join(sorted({wordings[k].label for k, _, _ in spans})), most / (most + 2))


FIELDS = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]


def test_query(spark):
    texts = {r[0]: r[1] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    out = op13_license_scan(spark, SF)
    assert dict(out.dtypes) == {c: "bigint" for c in ["doc_id", *FIELDS[:4]]} | {"base_labels": "string", "labels": "string", "score": "double"}
    got = {r["doc_id"]: tuple(r[c] for c in FIELDS) for r in out.collect()}
    assert got == {d: expected(t) for d, t in texts.items()}
    assert sum(bool(v[5]) for v in got.values()) > 0


def test_odd_rows(spark):
    long = "word " * 400_000 + "Licensed under the Apache License, Version 2.0, mit license " + "x" * 100_000
    rows = [(1, None), (None, "mit license"), (2, ""), (2, "mit license mit license"), (2, "mit license mit license"), (3, long), (4, " \n\t|")]
    docs = docs_of(spark, rows)
    out = L.license_scan(docs, "size")
    assert sorted(out.columns) == sorted(docs.columns)
    got = sorted(((r["doc_id"] or 0, r["size"]["n_base"], r["size"]["labels"], r["size"]["first_word"], r["size"]["last_word"])
                  for r in out.collect()), key=str)
    assert got == sorted([(1, 0, "", None, None), (0, 1, "mit", 0, 0), (2, 0, "", None, None), (2, 2, "mit", 0, 2), (2, 2, "mit", 0, 2),
                          (3, 2, "apache,apache-2.0,mit", 400_003, 400_008), (4, 0, "", None, None)], key=str)
    spans = [s for r in out.collect() if r["doc_id"] == 3 for s in r["size"]["spans"]]
    assert ("apache-2.0", 400_000, 400_006, False) not in map(tuple, spans) and ("apache-2.0", 400_000, 400_007, False) in map(tuple, spans)
    assert L.license_scan(docs.limit(0)).count() == 0
    assert L.license_scan(docs, by_label={"own": ["word <<any 0-1>> licensed"]}).filter("licenses.labels like '%own%'").count() == 1
