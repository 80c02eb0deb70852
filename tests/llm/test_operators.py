"""The operators against brute force, on small tables with every odd case."""

from __future__ import annotations

import base64
import hashlib
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from barloom.llm import (
    language, leaks, licences, packing, quality, rules, simhash, substrings, urls, warc,
)
from barloom.llm.common import UPPER
from barloom.llm.queries import ORACLES, QUERIES, URL_RULES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
DOCS = "doc_id long, text string, lang string, source string, n_chars int, sig string, row int, score int"


def docs_of(spark, texts, first=0):
    """Documents with columns whose names the operators use themselves."""
    rows = [(k, t, "en", "s", len(t or ""), "x", 1, 2) for k, t in enumerate(texts, first)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def odd_texts():
    chance = random.Random(3)
    vocabulary = [f"w{k}" for k in range(60)]
    texts = [" ".join(chance.choices(vocabulary, k=chance.randint(1, 80))) for _ in range(60)]
    passage = " ".join(f"p{k}" for k in range(40))
    texts += [f"{t} {passage} tail" for t in texts[:8]] + [passage] * 3
    texts += [None, "", " \t\n", "one", "A b", "a b Été", texts[0], texts[0]]
    texts += [texts[4].replace("w1 ", "w2 ", 1), "\U0001f600 x" * 30, "same " * 400]
    texts.append(" ".join(chance.choices(vocabulary, k=9000)))
    return texts


@pytest.fixture(scope="module")
def odd(spark, odd_texts):
    """All odd texts, a row without id, and one row twice."""
    frame = docs_of(spark, odd_texts)
    nameless = frame.where("doc_id = 62").withColumn("doc_id", F.lit(None).cast("long"))
    return frame.unionByName(nameless).unionByName(frame.where("doc_id = 5"))


def empty(spark):
    return spark.createDataFrame([], DOCS)


# 1


def test_near_values_share_a_key():
    chance = random.Random(1)
    for distance in range(4):
        for _ in range(400):
            x = y = chance.getrandbits(64)
            for bit in chance.sample(range(64), distance):
                y ^= 1 << bit
            row, key = simhash.fuzzy_keys(np.array([x, y], dtype=np.uint64))
            assert set(key[row == 0]) & set(key[row == 1])


def components_by_hand(prints):
    root = list(range(len(prints)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, x in enumerate(prints):
        for j in range(i):
            if (x ^ prints[j]).bit_count() <= 3:
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(k) for k in range(len(prints))]


def test_near_duplicates(spark, odd, odd_texts):
    prints = [simhash.fingerprint(None if t is None else t.encode()) for t in odd_texts]
    assert prints[71:74] == [0, 0, 0]
    expected = {k: (f"{p:016x}", c) for k, (p, c) in enumerate(zip(prints, components_by_hand(prints)))}
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == len(odd_texts) + 2
    for row in rows:
        if row.doc_id is not None:
            assert (row.fingerprint, row.component_id) == expected[row.doc_id]
    assert simhash.near_duplicates(empty(spark)).count() == 0


@pytest.mark.parametrize("block", [4, 512])
def test_large_buckets_are_compared_in_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    centre, chance, values = 0x0123456789ABCDEF, random.Random(2), set()
    while len(values) < 60:
        value = centre
        for bit in chance.sample(range(12), chance.randint(0, 5)):
            value ^= 1 << bit
        values.add(value)
    values = sorted(values) + [centre ^ (0xFF << 40)]
    frame = spark.createDataFrame([(v,) for v in values], "print long")
    roots = {r.node: r.root for r in simhash.components(simhash.links(frame)).collect()}
    groups = components_by_hand(values)
    for value, group in zip(values, groups):
        assert roots.get(value, value) == min(v for v, g in zip(values, groups) if g == group)


def test_the_bit_set_holds_every_key(spark):
    chance = random.Random(9)
    keys = [0, 1, simhash.PLACES - 1, simhash.PLACES] + [chance.getrandbits(44) for _ in range(500)]
    bits = simhash.bits_of(spark.createDataFrame([(k,) for k in keys], "key long"))
    assert simhash.in_bits(np.array(keys), bits).all()
    places = {k % simhash.PLACES for k in keys}
    others = np.array([k for k in range(0, 1 << 24, 997) if k % simhash.PLACES not in places])
    assert not simhash.in_bits(others, bits).any() and int(np.bitwise_count(bits).sum()) == len(places)
    assert not simhash.bits_of(spark.createDataFrame([], "key long")).any()


def test_a_chain_is_one_component(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(50)] + [(90, 91)], "a long, b long")
    roots = {r.node: r.root for r in simhash.components(edges).collect()}
    assert {roots[k] for k in range(1, 51)} == {0} and roots[91] == 90


# 2 and 6


def test_language(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = language.train(docs)
    found = language.identify(docs, model)
    wrong = found.where("lang <> lang_pred").count()
    assert wrong <= 0.02 * docs.count()
    assert found.where("rejected").count() == 0
    odd = docs_of(spark, [None, "", "12 34", "中文 字符 日本語 " * 9, "the and of that"])
    rows = language.identify(odd, model).orderBy("doc_id").collect()
    assert [r.lang_pred for r in rows[:3]] == ["und"] * 3
    assert [r.rejected for r in rows] == [True, True, True, True, False]
    assert all(0 <= r.score <= 1 for r in rows) and rows[0].sig == "x"
    nothing = language.train(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in language.identify(odd, nothing).collect()} == {"und"}
    assert language.identify(empty(spark), language.train(empty(spark))).count() == 0


def test_prediction_reads_the_text_only(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = language.train(docs)
    bare = docs.select("doc_id", "text")
    other = docs.withColumns({"lang": F.lit("xx"), "source": F.lit("y")})
    assert language.identify(bare, model).select("doc_id", "score").exceptAll(
        language.identify(other, model).select("doc_id", "score")
    ).count() == 0


def test_quality(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality.train(docs, labels)
    found = quality.score(docs, model).join(labels, "doc_id").where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2)
    assert found.where("predicted = quality").count() >= 0.93 * found.count()
    odd = quality.score(docs_of(spark, [None, "", "the", "### $$$ " * 40]), model).orderBy("doc_id").collect()
    assert odd[0].score == odd[1].score == pytest.approx(model.prior)
    assert odd[3].predicted == 0 and all(0 <= r.score <= 1 for r in odd)
    assert quality.train(docs, labels.limit(0)).score(["x"]).tolist() == [0.5]
    assert quality.score(empty(spark), model).count() == 0


def test_exact_neighbours():
    model = quality.Model.__new__(quality.Model)
    chance = np.random.default_rng(0)
    model.dimensions, model.prior = 64, 0.5
    model.labels = chance.integers(0, 2, 50).astype(np.float32)
    model.weights = np.ones(64, dtype=np.float32)
    model.projection = np.eye(64, dtype=np.float32)
    texts = ["".join(chr(97 + c) for c in chance.integers(0, 26, 30)) for _ in range(60)]
    vectors = quality.weighted(np.stack([quality.counts_of(t, 64) for t in texts]).astype(np.float32), model.weights)
    model.points = vectors[:50]
    got = model.score(texts[50:], 5)
    for vector, score in zip(vectors[50:], got):
        cosine = model.points @ vector
        near = np.argsort(-cosine)[:5]
        weight = cosine[near].clip(0) ** quality.POWER
        assert score == pytest.approx((weight * model.labels[near]).sum() / weight.sum(), rel=1e-4)


# 3


PAGES = [
    (1, "http://Good.ORG/a", '<a href="http://mid.net/x">'), (2, "http://mid.net/x", '<a href="http://far.net/">'),
    (3, "http://far.net/", None), (4, "http://bad.com/de/1", ""), (5, "http://liar.net/q?x", '<a class=b href=\'http://BAD.com/de/1\'>'),
    (6, "https://a.example.org/en/12#t", ""), (7, "https://example.org/es/1", ""), (8, None, "x"), (9, "mailto:x", ""),
    (10, "http://x.com/fr/", ""), (11, "http://x.com/en/", ""), (11, "http://x.com/en/", ""), (12, "ftp://lone.net", ""),
]


def test_url_verdicts(spark):
    pages = spark.createDataFrame([(*p, "h") for p in PAGES], "page_id int, url string, html string, host string")
    rows = {r.page_id: r for r in urls.judge(pages, urls.rule_table(spark, URL_RULES)).collect()}
    assert (rows[1].host, rows[1].path, rows[1].rule, rows[1].verdict) == ("good.org", "/a", "org/", "allow")
    assert rows[2].trust > rows[3].trust > 0 and rows[2].verdict == "allow"
    assert rows[4].rule == "com/de/" and rows[4].verdict == "block"
    assert rows[5].verdict == "block" and rows[5].distrust > 0 and rows[5].rule is None
    assert rows[6].rule == "example.org/en/1" and rows[7].rule == "example.org/es/"
    assert (rows[8].host, rows[8].path, rows[8].verdict) == ("", "", "allow") and rows[9].host == ""
    assert rows[10].rule == "com/fr/" and rows[11].rule is None and rows[11].verdict == "allow"
    assert (rows[12].host, rows[12].path) == ("lone.net", "")
    assert urls.judge(pages, urls.rule_table(spark, URL_RULES)).count() == len(PAGES)
    assert urls.judge(pages.limit(0), urls.rule_table(spark, URL_RULES)).count() == 0


def test_a_host_of_both_kinds_seeds_both_walks(spark):
    mixed = [(k, f"http://mixed.com/{path}", "") for k, path in enumerate(["de/1", "fr/1", "en/1", "en/2"])]
    pages = [*mixed, (10, "http://liar.net/", '<a href="http://mixed.com/de/1">'), (11, "http://else.net/", "")]
    frame = spark.createDataFrame(pages, "page_id int, url string, html string")
    rows = {r.page_id: r for r in urls.judge(frame, urls.rule_table(spark, URL_RULES)).collect()}
    assert rows[0].trust > 0 and rows[0].distrust > 0
    assert [rows[k].verdict for k in (0, 1, 2, 3, 10, 11)] == ["block", "allow", "allow", "allow", "block", "allow"]
    counts = spark.createDataFrame([("a.b", 4, 1, 2), ("c.d", 3, 0, 0), ("", 1, 1, 0)], "host string, pages long, allowed long, blocked long")
    assert sorted(map(tuple, urls.seeds_of(counts).collect())) == [("distrust", "a.b", 0.5), ("trust", "a.b", 0.25)]


def test_ranks_match_power_iteration(spark):
    chance = random.Random(4)
    edges = sorted({(chance.randrange(12), chance.randrange(12)) for _ in range(40)})
    edges = [(a, b, chance.randint(1, 4)) for a, b in edges if a != b]
    links = spark.createDataFrame([(f"h{a}", f"h{b}", n) for a, b, n in edges], "src string, dst string, n long")
    seeds = spark.createDataFrame([("trust", "h0", 1.0), ("distrust", "h1", 1.0)], "walk string, host string, weight double")
    got = {(r.walk, r.host): r["rank"] for r in urls.propagate(seeds, links).collect()}
    for walk, start, pairs in (("trust", 0, edges), ("distrust", 1, [(b, a, n) for a, b, n in edges])):
        matrix = np.zeros((12, 12))
        for a, b, n in pairs:
            matrix[b, a] = n / sum(x[2] for x in pairs if x[0] == a)
        seed = np.eye(12)[start]
        rank = seed
        for _ in range(200):
            rank = 0.15 * seed + 0.85 * matrix @ rank
        for k in range(12):
            assert got.get((walk, f"h{k}"), 0.0) == pytest.approx(rank[k], abs=1e-5)


@pytest.mark.parametrize("elsewhere", ["", '<a href="http://one.net/">'])
def test_blocked_paths_alone_block_no_host(spark, elsewhere):
    """One page of four blocked, half of them, or all; with and without links between other hosts."""
    hosts = {"few.com": ["de/1", "en/1", "en/2", "en/3"], "half.com": ["de/1", "en/1"], "all.com": ["de/1"]}
    pages = [(k, f"http://{h}/{path}", elsewhere * (h == "all.com")) for h in hosts for k, path in enumerate(hosts[h])]
    pages += [(9, "http://one.net/", '<a href="/x">'), (9, "http://two.net/", elsewhere)]
    frame = spark.createDataFrame(pages, "page_id int, url string, html string")
    rows = urls.judge(frame, urls.rule_table(spark, URL_RULES)).collect()
    assert len(rows) == len(pages)
    assert {r.verdict for r in rows if r.rule is None} == {"allow"}
    assert {r.verdict for r in rows if r.rule} == {"block"}


def test_the_pages_have_no_links_and_no_host_is_blocked(spark):
    rows = QUERIES["op3_urls"](spark, SF_DIR).where("rule is null")
    assert rows.count() > 0 and rows.where("verdict <> 'allow'").count() == 0


def test_a_long_chain_is_walked_to_its_end(spark):
    pages = [(0, "http://bad.com/de/1", "")]
    pages += [(k, f"http://n{k}.net/", f'<a href="http://{f"n{k - 1}.net" if k > 1 else "bad.com"}/">') for k in range(1, 31)]
    frame = spark.createDataFrame(pages, "page_id int, url string, html string")
    rows = {r.page_id: r for r in urls.judge(frame, urls.rule_table(spark, URL_RULES)).collect()}
    for k in range(31):
        assert rows[k].distrust == pytest.approx(0.15 * 0.85**k, rel=0.01)
    # the last hosts have less than a tenth of an even share
    assert [rows[k].verdict for k in (1, 10, 20)] == ["block"] * 3


def test_small_ranks_do_not_end_the_walk(spark):
    """Chains behind so many seeds that every rank is below one millionth."""
    many = 1_000_000
    seeds = spark.range(many).select(
        F.lit("distrust").alias("walk"), F.concat(F.lit("s"), "id").alias("host"), F.lit(1.0).alias("weight")
    )
    chain = [("h1", "s0", 1)] + [(f"h{k + 1}", f"h{k}", 1) for k in range(1, 8)]
    links = spark.createDataFrame(chain, "src string, dst string, n long")
    got = {r.host: r["rank"] for r in urls.propagate(seeds, links).where("host like 'h%'").collect()}
    for k in range(1, 9):
        assert got[f"h{k}"] * many == pytest.approx(0.15 * 0.85**k, rel=1e-3)


# 4, 7 and 9


def view(duck, frame, name):
    duck.register(name, frame.toArrow())


def same_as_sql(found, duck, name):
    expected = duck.sql(ORACLES[name]).to_arrow_table()
    columns = sorted(expected.column_names)
    assert sorted(found.columns) == columns
    rows = [tuple(r[c] for c in columns) for r in found.collect()]
    assert sorted(rows, key=repr) == sorted(zip(*(expected.column(c).to_pylist() for c in columns)), key=repr)


@pytest.fixture
def duck():
    import duckdb

    return duckdb.connect()


def test_rules_match_sql(spark, odd, duck):
    more = docs_of(spark, ["# $ % line\nline\nline"] * 120 + ["plain words in a text of some ten words or more"] * 300, 1000)
    frame = odd.unionByName(more).withColumn("lang", F.when(F.col("doc_id") % 3 > 0, "en"))
    view(duck, frame, "documents")
    same_as_sql(rules.judge(frame), duck, "op4_rules")
    assert rules.judge(empty(spark)).count() == 0


def test_a_sketch_merges_to_the_sketch_of_all(spark, odd):
    rated = rules.with_rates(rules.base_counts(odd)).withColumn("source", (F.col("n_words") % 3).cast("string"))
    parts = rules.merged(rules.sketches(rated), ["lang"])
    whole = rules.merged(rules.sketches(rated.withColumn("source", F.lit("all"))), ["lang"])
    assert parts.exceptAll(whole).count() == whole.exceptAll(parts).count() == 0


def test_substrings_match_sql(spark, odd, duck):
    frame = odd.where("doc_id is not null")
    view(duck, frame, "documents")
    same_as_sql(substrings.without_repeats(frame).drop("kept"), duck, "op7_substrings")
    nameless = substrings.without_repeats(odd).where("doc_id is null").collect()
    assert [r.n_removed for r in nameless] == [0]
    assert substrings.without_repeats(empty(spark)).count() == 0


def test_substrings_across_batches_and_blocks(spark, odd, duck, monkeypatch):
    """Tiny batches and reference blocks give the same rows."""
    monkeypatch.setattr(substrings, "BATCH_WORDS", 50)
    monkeypatch.setattr(substrings, "BLOCK_BYTES", 500)
    frame = odd.where("doc_id is not null").repartition(5)
    view(duck, frame, "documents")
    same_as_sql(substrings.without_repeats(frame).drop("kept"), duck, "op7_substrings")


def test_a_heavy_seed_is_dealt_to_many_blocks(spark, duck, monkeypatch):
    """One gram in changing surroundings: its windows leave its block, and rows stay the same."""
    chance = random.Random(6)

    def seed(gram):
        words = np.array([substrings.WordHashes()[w.encode()] for w in gram.split()], dtype=np.uint64)
        return substrings.rolling(substrings.mixed(words), substrings.GRAM, substrings.ODD[0])[0]

    gram = min((f"g{k} g1 g2 g3 g4" for k in range(3000)), key=seed)  # of least hash, so it is a seed
    around = [[" ".join(f"v{chance.randrange(10**6)}" for _ in range(12)) for _ in range(2)] for _ in range(200)]
    texts = [f"{a} {gram} {b}" for a, b in around] + [f"{a} {gram} {b}" for a, b in around[:40]]
    frame = docs_of(spark, texts).repartition(5)
    monkeypatch.setattr(substrings, "PART", 1)
    monkeypatch.setattr(substrings, "HEAVY", 100)
    monkeypatch.setattr(substrings, "BLOCK_BYTES", 500)
    source = frame.select("doc_id", F.col("text").cast("binary").alias("text"))
    heavy = substrings.heavy_seeds(source, substrings.WINDOW, substrings.GRAM)
    rows = [list(range(240)), [0] * 240, [t.encode() for t in texts], 64, substrings.WINDOW, substrings.GRAM]

    def largest(*more):
        parts = [substrings.parted(d) for _, d in substrings.parse_block(*rows, substrings.WordHashes(), *more)]
        return max(int(p[4].sum()) for p in parts)

    assert heavy.tolist() == [seed(gram)] and largest(heavy) < largest() / 4
    view(duck, frame, "documents")
    same_as_sql(substrings.without_repeats(frame).drop("kept"), duck, "op7_substrings")


def test_texts_without_repeats_stay_as_they_are(spark):
    texts = ["a  b\tc", " ".join(f"x{k}" for k in range(20)), " ".join(f"x{k}" for k in range(14)) + "  end"]
    rows = substrings.drop_repeats(docs_of(spark, texts)).orderBy("doc_id").collect()
    assert [r.text for r in rows] == [*texts[:2], "end"]
    assert [r.n_chars for r in rows] == [6, len(texts[1]), 3] and rows[2].sig == "x"


ITEMS = [
    ("long", " ".join(f"w{k}" for k in range(15))), ("short", "P1, p2 P3"), ("one", "tail"), ("none", " ,;"), ("null", None),
    ("same", "w0 w1 w2 w3 w4 w5 w6 w7 w8 w9"), (None, "p5 p6"), ("absent", "zz yy"), ("twice", "same same same"),
]


def test_leaks_match_sql(spark, odd, duck):
    texts = ["a " + ITEMS[0][1].upper() + " b " + ITEMS[0][1], "w0 w1 w2 w3 w4 w5 w6 w7 w8 x w9", "tail-tail tail"]
    frame = odd.unionByName(docs_of(spark, texts, 500))
    items = spark.createDataFrame(ITEMS, "item_id string, text string").withColumn("term", F.lit(1))
    view(duck, frame, "documents")
    view(duck, items, "benchmark")
    same_as_sql(leaks.find_leaks(frame, items).drop("items"), duck, "op9_leaks")
    left = leaks.drop_leaking(frame, items)
    assert left.columns == frame.columns
    assert left.where("doc_id >= 500").count() == 1
    assert leaks.find_leaks(frame, items.limit(0)).where("contaminated").count() == 0
    assert leaks.find_leaks(empty(spark), items).count() == 0


def test_proximity(spark):
    docs = docs_of(spark, ["x alpha " + "f " * 5 + "beta", "alpha " + "f " * 50 + "beta", "alpha only"])
    items = spark.createDataFrame([("i", "beta alpha")], "item_id string, text string")
    windows = leaks.item_windows(items)
    terms = windows.select(F.explode(F.split("phrase", " ")).alias("term"))
    lists = leaks.rare_lists(windows, leaks.term_counts(docs, terms))
    index = leaks.postings(docs, lists.select("term").distinct())
    assert [r.doc_id for r in leaks.near(index, lists, windows).collect()] == [0]


def near_by_hand(texts, items):
    def split(text):
        return [w for w in re.split(r"[^0-9A-Za-z\x80-\U0010ffff]+", text or "") if w]

    def words(text):
        return [w.translate(str.maketrans(UPPER, UPPER.lower())) for w in split(text)]

    count = Counter(w for t in texts for w in words(t))
    found = {k: set() for k in range(len(texts))}
    for item, text in items:
        own = words(text)
        for at in range(max(1, len(own) - leaks.WINDOW + 1) if item is not None and own else 0):
            known = {w for w in own[at : at + leaks.WINDOW] if count[w]}
            rare = sorted(known, key=lambda w: (count[w], w))[: leaks.LISTS]
            for k, t in enumerate(texts):
                places = [[p for p, w in enumerate(words(t)) if w == r] for r in rare]
                if len(rare) > 1 and any(abs(a - b) <= leaks.SLOP for a in places[0] for b in places[1]):
                    found[k].add(item)
    return found


def test_near_items_match_brute_force(spark, odd_texts):
    passage = [f"q{k}" for k in range(10)]
    swapped = " ".join(passage[:4] + ["other"] + passage[5:])
    texts = [*odd_texts, swapped, " ".join([*passage[:4], "put", "in", *passage[5:8]]), "same once", "q1 " + "x " * 30 + "q2"]
    items = [*ITEMS, ("swapped", " ".join(passage))]
    frame = docs_of(spark, texts)
    rows = leaks.find_near(
        frame.unionByName(frame.where("doc_id = 5")), spark.createDataFrame(items, "item_id string, text string")
    ).collect()
    expected = near_by_hand(texts, items)
    assert len(rows) == len(texts) + 1 and expected[len(odd_texts)] == {"swapped"}
    for r in rows:
        assert (r.near_items, r.n_near_items) == (sorted(expected[r.doc_id]), len(expected[r.doc_id]))
    assert not leaks.find_leaks(frame, spark.createDataFrame(items[-1:], "item_id string, text string")).where("contaminated").count()
    assert "op9_near" in QUERIES


# 5


def test_licences(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    templates = licences.template_table(spark, licences.TEMPLATES)
    classifier = licences.train(docs, templates)
    texts = [f"some words here\n{lines[0]}\nmore words" for _, lines in sorted(licences.TEMPLATES.items())]
    texts += ["the licence of a poet is not a notice\nwords", None, "", "\n \n", "Released under the MIT License.\n" * 3]
    frame = docs_of(spark, texts)
    rows = licences.scan(frame.unionByName(frame.where("doc_id = 12")), templates, classifier).orderBy("doc_id").collect()
    names = sorted(licences.TEMPLATES)
    assert [r.licences for r in rows[: len(names)]] == names
    assert [r.licences for r in rows[len(names) :]] == ["", "", "", "", "mit", "mit"]
    assert rows[-1].n_licensed == 3 and rows[-1].n_paragraphs == 3
    assert licences.scan(empty(spark), templates, classifier).count() == 0


NOTICES = [
    ("All rights reserved.", "reserved", 1),
    ("Copyright 2024 Acme. All rights reserved.", "reserved", 1),
    ("Licensed under CC BY-NC 4.0.", "cc-by-nc", 1),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "cc-by-nc", 1),
    (
        " * This program is free software: you can redistribute it and/or modify\n * it under the terms of the"
        " GNU General Public License as published by\n * the Free Software Foundation.", "gpl", 1,
    ),
    (
        "This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser"
        " General Public\nLicense as published by the Free Software Foundation.", "lgpl", 1,
    ),
    (
        "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided"
        " that the following conditions\nare met.", "bsd", 1,
    ),
    ("Released under the MIT License.\n" * 2 + "Released under\nthe MIT License.", "mit", 3),
    ("All rights\n\nreserved.", "", 0),
    ("all the rights of the reserved seats", "", 0),
]


def test_notices_as_they_occur(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    templates = licences.template_table(spark, licences.TEMPLATES | licences.RELATIVES)
    classifier = licences.train(docs, templates)
    frame = docs_of(spark, [f"some words of prose\n{text}\nand other words" for text, _, _ in NOTICES])
    rows = licences.scan(frame, templates, classifier).orderBy("doc_id").collect()
    assert [(r.licences, r.n_licensed) for r in rows] == [(name, n) for _, name, n in NOTICES]
    assert [r.n_unknown for r in rows if r.licences] == [0] * 8


# 8


def tokens_of(text):
    found = Tokenizer.from_file(public_tokenizers.path(packing.MODEL))
    return np.array([*found.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")


def test_packing_is_a_round_trip(spark, odd, odd_texts):
    texts = {k: tokens_of(t) for k, t in enumerate(odd_texts)}
    frame = odd.where("doc_id is not null").dropDuplicates(["doc_id"]).repartition(3)
    rows = packing.pack(frame).collect()
    at = dict.fromkeys(texts, 0)
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        ids = texts[r.doc_id]
        assert r.start == at[r.doc_id] and r.doc_tokens == len(ids)
        assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
        at[r.doc_id] += r.length
    assert at == {k: len(ids) for k, ids in texts.items()}
    ends = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 2048
    padding = sum(2048 - n for n in ends.values() if n & (n - 1))
    assert padding <= 0.02 * sum(ends.values())
    assert packing.pack(odd).where("doc_id is null").count() >= 1
    assert packing.pack(empty(spark)).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text())
def test_both_token_libraries_agree(text):
    model, ranks = (public_tokenizers.path(name) for name in (packing.MODEL, packing.RANKS))
    assert packing.encode(text, model, ranks).tolist() == tokens_of(text).tolist()


def test_special_strings_are_read_as_the_tokenizer_reads_them():
    model, ranks = (public_tokenizers.path(name) for name in (packing.MODEL, packing.RANKS))
    text = "a <|endoftext|> b"
    assert packing.encode(text, model, ranks).tolist() == tokens_of(text).tolist()


# 10


def test_archives(spark, tmp_path):
    rows = [(k, f"http://h{k % 5}.org/{k % 3}?b c\r\n", f"<p>{k % 4}\r\n\r\né</p>") for k in range(40)]
    rows += [(50, None, None), (51, "no url", ""), (52, "http://[x", "\r\n\r\n"), (52, "http://[x", "\r\n\r\n"), (None, "http://z.org", "z")]
    pages = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, digest string").repartition(4)
    found = warc.archive_pages(spark, pages).collect()
    assert len(found) == len(rows)
    heads = {}
    for k, _, html in rows:
        heads[html or ""] = max(heads.get(html or "", -1), -1 if k is None else k)
    texts = {k: html or "" for k, _, html in rows}
    for r in found:
        data = texts[r.page_id].encode()
        assert r.payload_bytes == len(data)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(data).digest()).decode()
        head = heads[texts[r.page_id]]
        first = head in (r.page_id, -1)
        assert (r.record_type, r.refers_to) == (("response", None) if first else ("revisit", head))
    order = sorted(found, key=lambda r: (r.merge_range, r.merge_place))
    keys = [(r.url_key, r.captured, -1 if r.page_id is None else r.page_id) for r in order]
    assert keys == sorted(keys)
    assert warc.archive_pages(spark, pages.limit(0)).count() == 0


@pytest.mark.parametrize("runs", [0, 1, 2, 3, 7, 8])
def test_loser_tree(runs):
    chance = random.Random(runs)
    rows = [{"url_key": chance.choice("abc"), "captured": str(chance.randint(0, 9)), "page_id": k} for k in range(90)]
    pieces = [sorted(rows[k::runs], key=warc.sort_key) for k in range(runs)] if runs else []
    merged = list(warc.loser_tree([*pieces, []] if runs == 3 else pieces))
    assert merged == (sorted(rows, key=warc.sort_key) if runs else [])


def test_a_changed_payload_is_an_error(spark, tmp_path):
    import datetime

    row = {
        "page_id": 1, "url": "u", "html": "abc", "captured": datetime.datetime(2000, 1, 1, tzinfo=datetime.UTC),
        "digest": hashlib.sha1(b"abc").hexdigest(), "record_type": "response", "refers_to": None,
    }
    data = warc.record(row)
    assert warc.capture(data)["payload_bytes"] == 3
    with pytest.raises(ValueError, match="digest"):
        warc.capture(data.replace(b"abc", b"abd"))


# all


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    for table in ("documents", "benchmark", "conversations"):
        duck.sql(f"create view {table} as from '{SF_DIR}/{table}.parquet'")
    same_as_sql(QUERIES[name](spark, SF_DIR), duck, name)
