"""Alignment against a byte-by-byte comparison with the libraries' own tokens."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tunelake.llm import alignment, bpe
from tunelake.llm.common import store
from tunelake.llm.queries import PIECES, op11_token_alignment, tokenizer_path

from .conftest import SF, docs_of

N_B = 32_000


@pytest.fixture(scope="module")
def both():
    whole = Tokenizer.from_file(tokenizer_path())
    whole.encode_special_tokens = True
    return whole, sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(PIECES))


@pytest.fixture(scope="module")
def aligner():
    with open(tokenizer_path(PIECES), "rb") as f:
        return alignment.Aligner(bpe.read_spec(tokenizer_path()), f.read())


def plain(both, text):
    """(n_a, n_b, groups as lists, links) by walking over the bytes."""
    whole, pieces = both
    if not text:
        return 0, 0, [], []
    symbol = bpe.byte_symbols()
    enc = whole.encode(" " + text, add_special_tokens=False)
    a = [(i, bytes(symbol[c] for c in whole.id_to_token(i))) for i in enc.ids]
    b = []
    for i in pieces.encode(text):
        p = pieces.id_to_piece(i)
        b.append((i, bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode()))
    if not b"".join(x for _, x in a) == b"".join(x for _, x in b) == (" " + text).encode():
        return 0, 0, [], []
    n_a, n_b, groups, links, left, right, at_a, at_b = len(a), len(b), [], [], [], [], 0, 0
    a.reverse(), b.reverse()
    while a or b:
        if at_a <= at_b:
            i, x = a.pop()
            left, at_a = left + [i], at_a + len(x)
        else:
            i, x = b.pop()
            right, at_b = right + [i], at_b + len(x)
        if at_a == at_b:
            groups.append((left, right))
            links.append((left[-1], right[-1]))
            left, right = [], []
    return n_a, n_b, groups, links


def written(groups):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)


ODD = [None, "", " ", "a", "Hello wörld \U0001f642 x", "  a  b ", "\ta\nb\r\n", "a▁b", "<0x41>", " x", "é ﬁ", "\x00a",
       "<s>hi</s><unk>", "<|endoftext|> a<|endoftext|>", "日本語 テキスト", " " * 5000, "x" * 3000, "\n" * 70, "it's 1234567 ---===",
       "ᲊ\U000323b0", "word " * 20_000]


def test_odd_texts(both, aligner):
    for text in ODD:
        n_a, n_b, groups, links = plain(both, text)
        got = aligner.align(text)
        assert got[:4] == (n_a, n_b, len(groups), written(groups)), text
        counted = Counter(a * N_B + b for a, b in links)
        assert dict(zip(got[4].tolist(), got[5].tolist())) == counted
    assert plain(both, "a▁b")[0] == 0 and plain(both, "<|endoftext|>")[0] > 1


def test_random_texts_in_small_blocks(both, aligner, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_TOKENS", 3)
    rng = random.Random(5)
    for _ in range(800):
        text = "".join(rng.choice(" \n\t aabetsstv'1.,!é中\U0001f642<s>") for _ in range(rng.randrange(40)))
        n_a, n_b, groups, _ = plain(both, text)
        assert aligner.align(text)[:4] == (n_a, n_b, len(groups), written(groups)), text


def expected(both, texts):
    """Per text, by brute force: every column of the contract but the id."""
    found = [plain(both, t) for t in texts]
    count = Counter(x for f in found for x in f[3])
    most = Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    return [(n_a, n_b, len(groups), len(links), sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links),
             hashlib.sha256(written(groups).encode()).hexdigest() if groups else "") for n_a, n_b, groups, links in found]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_query(spark, both):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = {d[0]: e for d, e in zip(docs, expected(both, [d[1] for d in docs]))}
    out = op11_token_alignment(spark, SF)
    assert dict(out.dtypes) == {c: "bigint" for c in ["doc_id", *COLUMNS[:-1]]} | {"groups_sha256": "string"}
    assert {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in out.collect()} == want


@pytest.mark.parametrize("head", [0, 7, 200_000])
def test_odd_rows(spark, both, monkeypatch, head):
    """Nulls, repeats, copies and clashing columns; with every size of the broadcast."""
    monkeypatch.setattr(alignment, "HEAD_PAIRS", head)
    monkeypatch.setattr(alignment, "BATCH_BYTES", 3000)
    rows = [(1, None), (None, "a b"), (2, ""), (2, "x y, z"), (2, "x y, z"), (3, "word " * 3000)] + [(10 + i, "same text, again") for i in range(40)]
    docs = docs_of(spark, rows).withColumn("row", F.lit("x"))
    aligned = store(alignment.align_documents(docs, tokenizer_path(), tokenizer_path(PIECES)), "test")
    out = alignment.link_scores(aligned, N_B).collect()
    want = [(d, *e[:6]) for (d, _), e in zip(rows, expected(both, [t for _, t in rows]))]
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(((r["doc_id"], *(r[c] for c in COLUMNS[:-1])) for r in out), key=key) == sorted(want, key=key)
    groups = {r["doc_id"]: r["groups"] for r in out}
    assert groups[1] == "" and np.all([groups[10 + i] == groups[10] for i in range(40)])


def test_no_documents(spark):
    empty = docs_of(spark, [(1, "a")]).limit(0)
    aligned = store(alignment.align_documents(empty, tokenizer_path(), tokenizer_path(PIECES)), "test")
    assert alignment.link_scores(aligned, N_B).count() == 0
