"""The automaton against the tokenizers library."""

import hashlib
import random
import time

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tunelake.llm import bpe
from tunelake.llm.queries import op2_bpe_codec, tokenizer_path

from .conftest import SF, docs_of


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def code():
    return bpe.automaton(bpe.read_spec(tokenizer_path()))


def ids(code, text):
    return np.frombuffer(code.encode(text), "<u4").tolist()


ODD = ["", " ", "   ", "a", " a", "a  b", "a \n b", "\n\n  x  \n", "it's we'll I'd", "ttt aaaa aaaaaaa", "x" * 5000,
       "<|endoftext|>", "a<|endoftext|> b<|endoftext|>", "<|endoftext", "日本語 テキスト", "naïve Ünïcode", "   x",
       "Ᲊ\U000323b0 \U00010940", "1234567 ½ ²", "🙂🙃", "a\x00b\x1cc\x85d", "--- === ###   !!!"]


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(code, library, text):
    want = library.encode(text, add_special_tokens=False).ids
    assert ids(code, text) == want
    assert code.decode(code.encode(text)) == library.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("text", ODD)
def test_compiled_merges_give_the_same(library, text):
    got = bpe.library(bpe.read_spec(tokenizer_path())).encode(text)
    assert got.dtype.str == "<u4" and got.tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("run", [" " * 1_200_000, "\n" * 1_200_000, " \n\t" * 500_000, " " * 100_000, " " * 99_999])
def test_long_white_space(library, run):
    for text in (run, f"a b{run}c d", f"x{run}"):
        got = bpe.library(bpe.read_spec(tokenizer_path())).encode(text)
        assert got.dtype.str == "<u4" and got.tolist() == library.encode(text, add_special_tokens=False).ids


def test_many_medium_blank_runs(library):
    """Runs below the bound are looked at once, not from each of their characters."""
    text = "a".join([" " * 50_000] * 8)
    code = bpe.library(bpe.read_spec(tokenizer_path()))
    code.encode("x")
    began = time.process_time()
    got = code.encode(text)
    assert time.process_time() - began < 1
    assert got.tolist() == library.encode(text, add_special_tokens=False).ids


def test_random_texts(code, library):
    rng = random.Random(3)
    letters = " \n\t aabetsstv'1.,!é中<|endoftext|>  "
    for _ in range(4000):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(20))) + rng.choice(["", "<|endoftext|>", "   y", " \n  "])
        assert ids(code, text) == library.encode(text, add_special_tokens=False).ids, text
        assert bpe.library(bpe.read_spec(tokenizer_path())).encode(text).tolist() == ids(code, text), text


def test_arcs_are_the_pairs_the_library_keeps(code, library):
    """A pair of tokens has an arc exactly when its bytes encode to that pair."""
    rng = random.Random(4)
    whole = {i: v.decode() for v, i in code.token.items() if v.isascii() and v.isalpha()}
    names = sorted(whole)
    for _ in range(20_000):
        a, b = rng.choice(names), rng.choice(names)
        assert code._arc(a, b) == (library.encode(whole[a] + whole[b], add_special_tokens=False).ids == [a, b])


def test_caches_forget_without_changing_results(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ROWS", 5)
    small = bpe.BpeAutomaton(bpe.read_spec(tokenizer_path()))
    text = " ".join(f"word{i % 17}x{i}, and more" for i in range(300))
    assert ids(small, text) == library.encode(text, add_special_tokens=False).ids


def test_query_equals_library(spark, library):
    texts = {r[0]: r[1] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    for r in op2_bpe_codec(spark, SF).collect():
        want = library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(want)
        assert r["ids_sha256"] == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(want, skip_special_tokens=False).encode()).hexdigest()


def test_odd_rows(spark):
    docs = docs_of(spark, [(1, None), (None, "a b"), (2, ""), (2, "x"), (2, "x"), (3, "word " * 100_000)])
    out = bpe.with_decoded(bpe.with_ids(docs, tokenizer_path(), "kept"), tokenizer_path(), "size", ids_col="kept")
    assert sorted(out.columns) == sorted(docs.columns)
    got = sorted((r["doc_id"] or 0, r["size"]) for r in out.select("doc_id", "size").collect())
    assert got == [(0, "a b"), (1, ""), (2, ""), (2, "x"), (2, "x"), (3, "word " * 100_000)]
    assert bpe.with_ids(docs.limit(0), tokenizer_path()).count() == 0
