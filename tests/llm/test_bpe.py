"""Byte-level BPE against the library that it has to agree with."""

from __future__ import annotations

import hashlib
import os
import random
import re

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barloom.llm import bpe
from barloom.llm.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
PATH = public_tokenizers.path(bpe.RANKS)
DOCS = "doc_id long, text string, ids string, decoded int, n_tokens int"


@pytest.fixture(scope="module")
def library():
    ranks = bpe.vocabulary(PATH).ids
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoded(texts, known=bpe.KNOWN):
    encoder = bpe.Encoder(PATH, public_tokenizers.PATTERN, known)
    return [np.frombuffer(x, bpe.ID).tolist() for x in encoder.block([encoder.words(t) for t in texts])]


def texts_of_small_alphabets():
    chance = random.Random(11)
    found = []
    for alphabet in ("a", "ab", "aehrst ", " \n\t", "0123456789", "=-_", "éèüßı中文", "aeiou'stdm "):
        for size in (1, 2, 3, 7, 50, 500):
            found += ["".join(chance.choices(alphabet, k=size)) for _ in range(12)]
    tokens = bpe.vocabulary(PATH).tokens
    for _ in range(400):
        found.append("".join(chance.choice(tokens).decode("utf-8", "ignore") for _ in range(12)))
    return [*found, "a" * 70_000, "".join(chance.choices("abcdefghijklmnopqrstuvwxyz", k=70_000))]


def test_equal_to_the_library(library):
    texts = texts_of_small_alphabets()
    assert encoded(texts) == [library.encode_ordinary(t) for t in texts]


@given(st.lists(st.text(max_size=60), max_size=6))
@settings(max_examples=150, deadline=None)
def test_any_text(library, texts):
    assert encoded(texts) == [library.encode_ordinary(t) for t in texts]


def merges_by_hand(word, ids):
    """The usual loop: the least rank first, from the left."""
    parts = [bytes([b]) for b in word]
    while True:
        ranked = [(ids.get(a + b, 1 << 30), k) for k, (a, b) in enumerate(zip(parts, parts[1:]))]
        if not ranked or min(ranked)[0] == 1 << 30:
            return [ids[p] for p in parts]
        k = min(ranked)[1]
        parts[k : k + 2] = [parts[k] + parts[k + 1]]


@given(st.lists(st.text("abc", min_size=1, max_size=24), min_size=1, max_size=8), st.randoms(use_true_random=False))
@settings(max_examples=200, deadline=None)
def test_vocabularies_with_ranks_in_any_order(tmp_path_factory, words, chance):
    """Merges that make a pair of lower rank than their own, which real vocabularies hardly have."""
    import base64

    longer = {bytes(chance.choices(b"abc", k=chance.randint(2, 5))) for _ in range(40)}
    tokens = [bytes([b]) for b in range(256)] + chance.sample(sorted(longer), len(longer))
    path = str(tmp_path_factory.mktemp("ranks") / "ranks")
    with open(path, "wb") as out:
        out.writelines(base64.b64encode(t) + b" %d\n" % k for k, t in enumerate(tokens))
    known = bpe.Vocabulary(path)
    plain = [w.encode() for w in words]
    flat, count = bpe.replay(plain, known)
    found = [x.tolist() for x in np.split(flat, np.cumsum(count)[:-1])]
    assert found == [merges_by_hand(w, known.ids) for w in plain]


def test_small_steps_and_short_memory(library, monkeypatch):
    texts = texts_of_small_alphabets()[:-2]
    expected = [library.encode_ordinary(t) for t in texts]
    monkeypatch.setattr(bpe, "STEP", 3)
    assert encoded(texts) == expected
    encoder = bpe.Encoder(PATH, public_tokenizers.PATTERN, 5)
    for text, ids in zip(texts, expected):
        assert np.frombuffer(next(encoder.block([encoder.words(text)])), bpe.ID).tolist() == ids


def test_the_short_pattern_cuts_alike():
    slow, fast = regex.compile(public_tokenizers.PATTERN).findall, re.compile(bpe.LATIN).findall
    characters = [chr(c) for c in range(256)]
    for a in characters:
        for b in characters:
            text = f" {a}{b}  {a}x'S{b}'s \n{a}"
            assert slow(text) == fast(text)
    chance = random.Random(2)
    for _ in range(2000):
        text = "".join(chance.choices(characters, k=30))
        assert slow(text) == fast(text)


def rows_of(frame):
    return sorted((tuple(row) for row in frame.collect()), key=repr)


def digest_rows(library, rows):
    found = []
    for doc_id, text in rows:
        ids = library.encode_ordinary(text or "")
        packed = np.array(ids, "<u4").tobytes()
        plain = (text or "").encode()
        found.append((doc_id, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(plain).hexdigest()))
    return sorted(found, key=repr)


@pytest.mark.parametrize("block", [bpe.BLOCK, 40])
def test_odd_rows(spark, library, block):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "Été \U0001f600!"), (4, "Été \U0001f600!"), (None, "no id")]
    rows += [(5, "word " * 30_000), (6, "x" * 100_000), (7, "a"), (7, "b")]
    frame = spark.createDataFrame([(*row, "x", 1, 2) for row in rows], DOCS)
    found = bpe.digests(bpe.encode(frame, block=block, known=100))
    assert rows_of(found) == digest_rows(library, rows)
    assert bpe.digests(bpe.encode(frame.limit(0))).count() == 0


def test_decoding_is_an_operator_of_its_own(spark, library):
    ids = library.encode_ordinary("some text")
    frame = spark.createDataFrame(
        [("a", np.array(ids, "<u4").tobytes(), 1.5), ("b", None, 2.5)], "name string, ids binary, x double"
    )
    found = bpe.decode(frame).select("name", F.decode("decoded", "utf-8"), "x")
    assert rows_of(found) == [("a", "some text", 1.5), ("b", "", 2.5)]


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no tables")
def test_query(spark, library):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    assert rows_of(QUERIES["op11_bpe"](spark, SF_DIR)) == digest_rows(library, rows)
