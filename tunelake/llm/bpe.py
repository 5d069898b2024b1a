"""Byte-level BPE through a deterministic automaton.

The automaton reads tokens. It starts with one state and one arc per byte.
Each merge (a, b) -> c is then built in by a gadget: the arcs labelled a are
redirected to a copy of their target without the arc labelled b, and every
state with an arc a gets an arc c to the target of b. After the last merge a
token sequence is accepted exactly when it is the BPE encoding of its bytes, so
a word has one accepted path, and encoding is following it.

All arcs with one label share their target, so a state is named by the token
read last. Copies are not stored: a state lacks arc x if some gadget removed
it, either from this token's state, or from the state it was copied from (the
right part of the token, as it was when the token was made); and a token made
later has an arc only where its left part had one. Transitions met are kept in
a table.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from tunelake.llm.common import quoted, ship

# Fixed value: the pattern that splits a text into words before merging.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# No character before this one is in doubt (see recent_letters).
FIRST_DISPUTED = "\u0530"

# Longest run of white space that compiled merges are given: beyond about a
# million their pattern engine overflows its stack.
LONGEST_BLANK = 100_000

# Entries a cache may hold before its older half goes.
CACHE_ROWS = 200_000


def byte_symbols() -> dict[str, int]:
    """The character that stands for each byte in the vocabulary file:
    printable Latin-1 characters for themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


@lru_cache(maxsize=1)
def recent_letters() -> re.Pattern:
    """Characters that ``regex`` calls letters or numbers and that this
    Python's older Unicode tables do not know: about them libraries differ."""
    known = regex.compile(r"[\p{L}\p{N}]")
    new = [c for c in range(0x110000) if unicodedata.category(chr(c)) == "Cn" and known.match(chr(c))]
    runs = [[c for _, c in g] for _, g in groupby(enumerate(new), lambda x: x[1] - x[0])]
    return re.compile("[" + "".join(f"{chr(r[0])}-{chr(r[-1])}" for r in runs) + "]" if runs else r"(?!)")


class Recent(dict):
    """A cache of ``make``; when full, what was not used lately is dropped."""

    def __init__(self, make, share: int = 1):
        super().__init__()
        self.make, self.share, self.older = make, share, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if self.share * len(self) >= CACHE_ROWS:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class BpeAutomaton:
    """``spec``: text of a tokenizer file (byte-level BPE, no normaliser)."""

    START = -1

    def __init__(self, spec: str):
        data = json.loads(spec)
        model, split = data["model"], data["pre_tokenizer"]
        if (model["type"] != "BPE" or data["normalizer"] or data["post_processor"] or split["type"] != "ByteLevel"
                or split["add_prefix_space"] or not split["use_regex"] or model.get("ignore_merges")
                or any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in data["added_tokens"])):
            raise ValueError("only plain byte-level BPE files are read")
        symbol = byte_symbols()
        ids = model["vocab"]
        self.label = {i: bytes(symbol[c] for c in t) for t, i in ids.items()}
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.born: dict[int, int] = {}
        self.removed: dict[tuple[int, int], int] = {}
        self.compile([tuple(ids[x] for x in (a, b, a + b)) for a, b in
                      (m if isinstance(m, list) else m.split(" ") for m in model["merges"])])
        self.token = {v: i for i, v in self.label.items() if len(v) == 1 or i in self.born}
        self.longest = max(map(len, self.token))
        self.size = {i: len(v) for v, i in self.token.items()}
        # prefix tree of the tokens: (node, byte) -> node; a token's node is its
        # id + 1, other nodes are negative
        tree: dict[int, int] = {}
        inner = 0
        for v, i in sorted(self.token.items()):
            node = 0
            for k, byte in enumerate(v):
                key = node << 8 | byte
                node = tree.get(key)
                if node is None:
                    node = self.token.get(v[:k + 1], -1) + 1
                    if not node:
                        inner -= 1
                        node = inner
                    tree[key] = node
        self.step = tree.get
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.label |= {i: t.encode() for t, i in self.special.items()}
        self.by_special = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.words = regex.compile(WORDS)
        # a space between white space on both sides: cutting there would change the words
        self.uneven = re.compile(r"\s (?:\s|\Z)")
        self.disputed, self.splitter = recent_letters(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        self.arcs: dict[int, bool] = {}
        self.of_word = Recent(self._word_ids, share=4)
        self.of_chunk = Recent(self._chunk_ids)

    def compile(self, merges: list[tuple[int, int, int]]) -> None:
        for step, (a, b, c) in enumerate(merges):
            if c in self.born:
                raise ValueError("two merges make one token")
            if not self._arc(a, b):
                continue  # a is never followed by b, so there is no such token
            self.removed[a, b] = step
            self.left[c], self.right[c], self.born[c] = a, b, step

    def _arc(self, last: int, token: int) -> bool:
        """Has the state after ``last`` an arc ``token``?"""
        spine, until = [], None
        while token is not None:
            spine.append((token, until))
            until, token = self.born.get(token), self.left.get(token)
        upto = None
        while last is not None:
            for t, made in spine:
                step = self.removed.get((last, t))
                if step is not None and (upto is None or step < upto) and (made is None or step <= made):
                    return False
            upto, last = self.born.get(last), self.right.get(last)
        return True

    def path(self, word: bytes) -> list[int]:
        """Labels of the accepted path that spells ``word``."""
        found = self.token.get(word)
        if found is not None:
            return [found]
        arcs, sizes, step, n = self.arcs, self.size, self.step, len(word)
        path: list[int] = []
        tries: list[list[int]] = []  # per step taken: the shorter steps not yet tried
        at, last, dead = 0, self.START, set()
        while at < n:
            # tokens that begin here, shortest first
            options, node = [], 0
            for byte in word[at:at + self.longest]:
                node = step(node << 8 | byte)
                if node is None:
                    break
                if node > 0:
                    options.append(node - 1)
            while True:
                if options:
                    t = options.pop()
                    if last < 0:
                        ok = True
                    else:
                        ok = arcs.get(last << 32 | t)
                        if ok is None:
                            if len(arcs) >= CACHE_ROWS:
                                arcs.clear()
                            ok = arcs[last << 32 | t] = self._arc(last, t)
                    if ok and (not dead or (at, t) not in dead):
                        break
                else:  # no arc goes on from here: take a shorter step before
                    t = path.pop()
                    at -= sizes[t]
                    dead.add((at, t))
                    last = path[-1] if path else self.START
                    options = tries.pop()
            path.append(t)
            tries.append(options)
            at += sizes[t]
            last = t
        return path

    def _word_ids(self, word: str) -> bytes:
        path = self.path(word.encode())
        return struct.pack(f"<{len(path)}I", *path)

    def _split(self, text: str) -> list[str]:
        if text and max(text) >= FIRST_DISPUTED and self.disputed.search(text):
            # as the tokenizers library does
            return [text[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(text)]
        return self.words.findall(text)

    def _words_ids(self, text: str) -> bytes:
        return b"".join(map(self.of_word.__getitem__, self._split(text)))

    def _chunk_ids(self, chunk: str) -> bytes:
        """Ids of a space and ``chunk``, which follows a character that is not white space or follows nothing."""
        if chunk.isalpha() and max(chunk) < FIRST_DISPUTED:
            return self._word_ids(" " + chunk)
        first, *rest = self._split(" " + chunk)
        word = first[1:]
        ids = self.of_chunk[word] if word.isalpha() and word != chunk else self._word_ids(first)
        return ids + b"".join(map(self.of_word.__getitem__, rest))

    def _plain_ids(self, text: str) -> bytes:
        if self.uneven.search(text):
            return self._words_ids(text)
        first, *rest = text.split(" ")
        return self._words_ids(first) + b"".join(map(self.of_chunk.__getitem__, rest))

    def encode(self, text: str) -> bytes:
        """Token ids as little-endian unsigned 32-bit integers."""
        if self.by_special is None or not self.by_special.search(text):
            return self._plain_ids(text)
        out, at = [], 0
        for m in self.by_special.finditer(text):
            out += [self._plain_ids(text[at:m.start()]), np.array([self.special[m[0]]], "<u4").tobytes()]
            at = m.end()
        return b"".join([*out, self._plain_ids(text[at:])])

    def decode(self, ids: bytes) -> str:
        """The labels of the ids, as text; an unknown id raises."""
        return b"".join(map(self.label.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


class LibraryEncoder:
    """The ids of the same tokenizer file from tiktoken's compiled merges, for
    steps that only need the ids. Texts with characters about which Unicode
    tables differ, or with white space longer than ``LONGEST_BLANK``, go
    through the tokenizers library itself."""

    def __init__(self, spec: str):
        data = json.loads(spec)
        if data["normalizer"] or data["post_processor"] or data["model"].get("ignore_merges"):
            raise ValueError("only plain byte-level BPE files are read")
        symbol, ids = byte_symbols(), data["model"]["vocab"]
        merged = [ids["".join(m if isinstance(m, list) else m.split(" "))] for m in data["model"]["merges"]]
        if merged != sorted(merged):
            raise ValueError("ids do not follow the order of the merges")
        ranks = {bytes(symbol[c] for c in t): i for t, i in ids.items()}
        self.fast = tiktoken.Encoding("file", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
        self.whole = Tokenizer.from_str(spec)
        self.special = {t["content"] for t in data["added_tokens"]}
        self.disputed = recent_letters()
        self.beyond = re.compile(f"[{FIRST_DISPUTED}-\U0010FFFF]")
        self.blank = re.compile(r"(?<!\s)\s{%d}" % LONGEST_BLANK)  # tried once per run

    def encode(self, text: str) -> np.ndarray:
        """Token ids as little-endian unsigned 32-bit integers."""
        if (any(s in text for s in self.special) or self.beyond.search(text) and self.disputed.search(text)
                or len(text) >= LONGEST_BLANK and self.blank.search(text)):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4")
        return np.array(self.fast.encode_ordinary(text), "<u4")


@lru_cache(maxsize=4)
def library(spec: str) -> LibraryEncoder:
    return LibraryEncoder(spec)


@lru_cache(maxsize=4)
def automaton(spec: str) -> BpeAutomaton:
    """One automaton per vocabulary and process."""
    return BpeAutomaton(spec)


def read_spec(path: str) -> str:
    """The vocabulary file, read by the driver (a public file of a few MB)."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def _encode_udf(shared):
    def encode(texts: pa.Array) -> pa.Array:
        code = automaton(shared.value).encode
        return pa.array((code(t.as_py() or "") for t in texts), pa.binary())

    return F.arrow_udf(encode, "binary")


def _decode_udf(shared):
    def decode(ids: pa.Array) -> pa.Array:
        text = automaton(shared.value).decode
        return pa.array((text(i.as_py()) if i.is_valid else None for i in ids), pa.string())

    return F.arrow_udf(decode, "string")


def _codec_udf(shared):
    def codec(texts: pa.Array) -> pa.Array:
        code = automaton(shared.value)
        ids = pa.array((code.encode(t.as_py() or "") for t in texts), pa.binary())
        return pa.StructArray.from_arrays([ids, pa.array((code.decode(i.as_py()) for i in ids), pa.string())], ["ids", "decoded"])

    return F.arrow_udf(codec, "struct<ids: binary, decoded: string>")


def share(spark: SparkSession, tokenizer_path: str):
    """The vocabulary as a broadcast value; its size is the file's."""
    ship(spark)
    return spark.sparkContext.broadcast(read_spec(tokenizer_path))


def with_ids(docs: DataFrame, tokenizer_path: str, name: str = "ids", *, text_col: str = "text") -> DataFrame:
    """``docs`` with the token ids of the whole text as binary column ``name``
    (little-endian unsigned 32-bit). Null text counts as empty. Strings of
    special tokens become their ids. An input column of that name is replaced.
    """
    encode = _encode_udf(share(docs.sparkSession, tokenizer_path))
    return docs.withColumn(name, encode(quoted(text_col)))


def with_decoded(tokens: DataFrame, tokenizer_path: str, name: str = "decoded", *, ids_col: str = "ids") -> DataFrame:
    """``tokens`` with the text of binary column ``ids_col`` as ``name``; null
    ids give null."""
    decode = _decode_udf(share(tokens.sparkSession, tokenizer_path))
    return tokens.withColumn(name, decode(quoted(ids_col)))


def with_round_trip(docs: DataFrame, tokenizer_path: str, name: str = "codec", *, text_col: str = "text") -> DataFrame:
    """``docs`` with a struct of the ids of the text and of the text that these
    ids give, both by one Python worker. Nulls as in ``with_ids``."""
    codec = _codec_udf(share(docs.sparkSession, tokenizer_path))
    return docs.withColumn(name, codec(quoted(text_col)))
