"""Relative Lempel-Ziv factors against the words they stand for."""

from __future__ import annotations

import random
import tracemalloc
from collections import defaultdict

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from test_operators import docs_of, empty

from barloom.llm import substrings

W = 4
SPANS = st.lists(st.tuples(st.integers(0, 30), st.integers(1, 9), st.integers(0, 2), st.integers(-3, 3)), max_size=12)


@given(SPANS)
@settings(max_examples=300, deadline=None)
def test_a_parse_covers_what_its_factors_cover(spans):
    factors = [(start, start + many, ref, start + 40 + shift) for start, many, ref, shift in spans]
    parsed = substrings.greedy_parse(factors, W)
    covered = {k for start, stop, _, _ in factors for k in range(start, stop + W - 1)}
    assert sorted(k for start, length, _, _ in parsed for k in range(start, start + length)) == sorted(covered)
    # every factor lies at the shift of a given one, within it or its continuations
    shifts = {(ref, there - start) for start, _, ref, there in factors}
    assert all((ref, there - start) in shifts for start, _, ref, there in parsed)


@given(SPANS)
@settings(max_examples=200, deadline=None)
def test_no_parse_is_shorter(spans):
    """The greedy parse has the fewest factors that cover the words, of those there are."""
    factors = [(start, start + many, ref, start + 40 + shift) for start, many, ref, shift in spans]
    spans_ = sorted({(a, b + W - 1) for a, b, _, _ in substrings.joined_factors(factors)})
    words = sorted({k for a, b in spans_ for k in range(a, b)})
    fewest = 0
    at = 0
    while at < len(words):
        reach = max(b for a, b in spans_ if a <= words[at] < b)
        fewest += 1
        while at < len(words) and words[at] < reach:
            at += 1
    assert len(substrings.greedy_parse(factors, W)) == fewest


def corpus():
    chance = random.Random(12)
    words = [f"w{k}" for k in range(400)]
    passages = [chance.choices(words, k=chance.randint(20, 90)) for _ in range(6)]
    texts = []
    for _ in range(60):
        parts = [chance.choices(words, k=chance.randint(0, 30)) for _ in range(3)]
        for _ in range(chance.randint(0, 2)):
            own = chance.choice(passages)
            cut = sorted(chance.sample(range(len(own)), 2))
            parts.insert(chance.randint(0, 3), own[cut[0] : cut[1]])
        texts.append(" ".join(sum(parts, [])))
    return texts + [texts[3], "same " * 60, "same " * 50, None, "", "short"]


def block_rows(batches: int, words: int):
    """The one reference block of batches of documents, each with the same passage."""
    chance = random.Random(3)
    passage = [f"p{k}" for k in range(60)]
    found, hashes = [], substrings.WordHashes()
    for k in range(batches):
        texts = [" ".join([*(f"w{chance.randrange(10**9)}" for _ in range(words)), *passage]).encode() for _ in range(20)]
        ids = [20 * k + n for n in range(20)]
        found += substrings.parse_block(ids, ids, texts, 1, substrings.WINDOW, substrings.GRAM, hashes)
    number, data = zip(*found)
    return pa.table({"block": pa.array(number, pa.int64()), "data": pa.array(data, pa.binary())})


def test_parts_of_a_block_give_the_factors_of_the_whole():
    rows = block_rows(6, 100)
    lists = []
    for most in (1 << 30, 1000, 7):
        found = defaultdict(list)
        for row in substrings.resolve_block(rows, most).to_pylist():
            found[row["doc_id"], row["sig"]].append((row["start"], row["stop"], row["ref"], row["ref_start"]))
        lists.append({key: substrings.joined_factors(own) for key, own in found.items()})
    assert lists[0] == lists[1] == lists[2]
    # within a batch against its first document, which stands in the first of all
    assert lists[0] == {(k, k): [(100, 148, k - k % 20 if k % 20 else 0, 100)] for k in range(1, 120)}


def test_a_block_takes_little_memory_beside_its_rows():
    rows = block_rows(20, 1000)
    windows = sum(int(substrings.parted(x)[4].sum()) for x in rows["data"].to_pylist())
    assert windows > 390_000
    tracemalloc.start()
    substrings.resolve_block(rows, 1 << 14)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 * windows  # 136 bytes a window when all were worked on at once


def test_dropped_repeats_leave_null_and_unchanged_texts(spark, monkeypatch):
    monkeypatch.setattr(substrings, "PIECE", 2)
    passage = " ".join(f"q{k}" for k in range(20))
    texts = [f"a  b {passage}", None, "", f"c\td {passage}  e", "f  g\th"]
    docs = docs_of(spark, texts).repartition(1)
    rows = substrings.drop_repeats(docs)
    assert rows.columns == docs.columns
    assert [r.text for r in rows.orderBy("doc_id").collect()] == [texts[0], None, "", "c d e", texts[4]]


@pytest.mark.parametrize("batch, block", [(1 << 19, 6 << 20), (60, 400)])
def test_factors_stand_in_their_references(spark, monkeypatch, batch, block):
    monkeypatch.setattr(substrings, "BATCH_WORDS", batch)
    monkeypatch.setattr(substrings, "BLOCK_BYTES", block)
    texts = corpus()
    found = defaultdict(list)
    for row in substrings.parse(docs_of(spark, texts).repartition(3)).collect():
        found[row.doc_id].append(row)
    lists = [(t or "").split() for t in texts]
    seen = defaultdict(list)
    for doc, own in enumerate(lists):
        gone = set()
        for k in range(len(own) - 12):
            gram = tuple(own[k : k + 13])
            if seen[gram] and seen[gram][0] < doc:
                gone.update(range(k, k + 13))
            seen[gram].append(doc)
        places = []
        for row in found[doc]:
            assert row.ref < doc
            there = lists[row.ref][row.ref_start : row.ref_start + row.length]
            assert there == own[row.start : row.start + row.length] and row.length > 0
            places += range(row.start, row.start + row.length)
        assert sorted(places) == sorted(gone)
    assert len(lists[60]) > 12 and sum(r.length for r in found[60]) == len(lists[60])  # a copy of document 3
    assert substrings.parse(empty(spark)).count() == 0


def test_a_passage_over_many_seeds_is_one_factor(spark):
    passage = " ".join(f"p{k}" for k in range(200))
    rows = substrings.parse(docs_of(spark, [f"a b c {passage}", f"{passage} d e", f"x {passage} y"])).collect()
    assert sorted((r.doc_id, r.start, r.length, r.ref, r.ref_start) for r in rows) == [(1, 0, 200, 0, 3), (2, 1, 200, 0, 3)]
