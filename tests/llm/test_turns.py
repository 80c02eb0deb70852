"""The trie of conversations against dictionaries of prefixes."""

from __future__ import annotations

import hashlib
import os
import random
from collections import defaultdict
from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from barloom.llm import turns
from barloom.llm.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SCHEMA = "conv_id long, turn long, role string, text string"


def key_of(role, text):
    role, text = role or "", text or ""
    return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest(), len(text.encode())


def rebuilt_by_hand(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, *key_of(role, text)))
    original = {c: [x[2:] for x in sorted(found)] for c, found in own.items()}
    found = {}
    for c, turn_list in original.items():
        h = crc32(str(c).encode()) % 9
        base = c - int(np.fmod(c, 5))
        found[c] = original.get(base, [])[:h] + turn_list[h:]
    return found


def trie_by_hand(sequences):
    members, own_end = defaultdict(list), defaultdict(list)
    for c, sequence in sequences.items():
        for d in range(len(sequence) + 1):
            members[tuple(sequence[:d])].append(c)
        own_end[tuple(sequence)].append(c)
    children = defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, found in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(found) - 1) * p[-1][1] if p else 0
    rows = []
    for p, found in members.items():
        ends = ",".join(map(str, sorted(own_end[p]))).encode()
        parent = min(members[p[:-1]]) if p else None
        rows.append(
            (min(found), len(p), parent, len(found), children[p], leaves[p], saved[p], hashlib.sha256(ends).hexdigest())
        )
    return sorted(rows, key=repr)


def collected(frame):
    return sorted((tuple(row) for row in frame.collect()), key=repr)


def conversations(chance, count, longest, words):
    rows = []
    for c in range(count):
        for turn in range(chance.randint(1, longest)):
            rows.append((c, turn, chance.choice(["user", "assistant"]), chance.choice(words)))
    return rows


def odd_rows():
    chance = random.Random(7)
    rows = conversations(chance, 60, 9, ["a", "bb", "é", None, ""])
    rows += [(100 + k, t, "user", "same") for k in range(40) for t in range(12)]  # equal conversations
    rows += [(200 + k, t, "user", f"x{t if t < 11 else k}") for k in range(30) for t in range(14)]
    rows += [(305, t, "user", f"long {t}") for t in range(300)] + [(306, t, "user", f"long {t}") for t in range(250)]
    rows += [(None, 0, "user", "lost"), (-7, 0, "user", "below"), (-5, 0, "user", "zero"), (-6, None, None, None)]
    rows += [(400, 1, "user", "tie"), (400, 1, "user", "eit"), (400, None, "user", "first"), (400, 1, "user", "tie")]
    return rows + rows[:20]


def test_odd_conversations(spark):
    rows = odd_rows()
    frame = spark.createDataFrame(rows, SCHEMA)
    found = collected(turns.conversation_trie(frame))
    assert found == trie_by_hand(rebuilt_by_hand(rows))


@pytest.mark.parametrize("tasks", [1, 3, 40])
def test_shards_of_any_number(spark, tasks):
    """Few or many shards, narrow matrices, and cuts by two turns only."""
    rows = odd_rows()
    frame = spark.createDataFrame(rows, SCHEMA)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", tasks)
    try:
        found = collected(turns.trie(turns.stage(turns.rebuilt(frame), "sequences"), keyed=2, width=3))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found == trie_by_hand(rebuilt_by_hand(rows))


def test_a_cut_wider_than_the_matrix(spark):
    frame = turns.stage(turns.rebuilt(spark.createDataFrame(odd_rows(), SCHEMA)), "sequences")
    with pytest.raises(ValueError):
        turns.trie(frame, keyed=4, width=3)


def test_empty_table_and_further_columns(spark):
    assert turns.conversation_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(c, t, "user", f"t{t % 2}", 1, "x", b"y") for c in range(12) for t in range(3)]
    frame = spark.createDataFrame(rows, SCHEMA + ", depth int, node string, ids binary")
    found = collected(turns.conversation_trie(frame))
    assert found == trie_by_hand(rebuilt_by_hand([row[:4] for row in rows]))


@given(st.lists(st.lists(st.integers(0, 2), max_size=7), min_size=1, max_size=30))
@settings(max_examples=60, deadline=None)
def test_nodes_of_one_shard(lists):
    """All nodes of a shard with every edge closed but the outermost."""
    convs = np.arange(len(lists))
    ids = [b"".join(bytes([x + 1] * 16) for x in one) for one in lists]
    sizes = [np.array([x + 1 for x in one], "<i4").tobytes() for one in lists]
    shard = turns.Shard(convs, ids, sizes, 0, 1, 2)
    shard.build()
    members = defaultdict(list)
    for c, one in zip(convs.tolist(), lists):
        for d in range(len(one) + 1):
            members[tuple(one[:d])].append(c)
    found = sorted(
        (depth, int(c), int(n))
        for depth, level in enumerate(shard.levels)
        for c, n in zip(level["conv_id"], level["n_convs"])
    )
    assert found == sorted((len(p), min(c), len(c)) for p, c in members.items())


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no tables")
def test_query_matches_brute_force_and_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    connection.execute(f"create view conversations as from '{SF_DIR}/conversations.parquet'")
    rows = connection.sql("select conv_id, turn, role, text from conversations").fetchall()
    expected = trie_by_hand(rebuilt_by_hand(rows))
    assert collected(QUERIES["op12_turns"](spark, SF_DIR)) == expected
    names = "conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256"
    found = connection.sql(f"select {names} from ({ORACLES['op12_turns']})").fetchall()
    assert sorted(found, key=repr) == expected
