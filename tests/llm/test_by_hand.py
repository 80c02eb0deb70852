"""Language and licence decisions against plain Python."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from test_operators import SF_DIR, docs_of

from barloom.llm import language, licences

# 2

PLACES = 512
VOCABULARY = {
    "aa": ["alpha", "banana", "calla", "drama", "agar", "papaya"],
    "oo": ["bloom", "cocoon", "proof", "moon", "oolong", "voodoo"],
    "ii": ["skiing", "vizir", "ibis", "minim", "kiwi", "iris"],
}


def prose(chance, words, size):
    return " ".join(chance.choices(words, k=size))


def gram_places(text):
    """Counts of the hashed runs of one to three letters, words set apart by one space."""
    runs = " " + " ".join(re.findall(r"[^\W\d_]+", text.lower())) + " "
    found = Counter()
    if len(runs) < 3:
        return found
    for size in (1, 2, 3):
        for start in range(len(runs) - size + 1):
            value = size
            for k, letter in enumerate(runs[start : start + size]):
                value = (value ^ ord(letter)) * (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)[k] & 0xFFFFFFFF
                value ^= value >> 15
            found[value % PLACES] += 1
    return found


def unit(vector):
    length = math.sqrt(sum(x * x for x in vector.values()))
    return {k: x / length for k, x in vector.items()} if length else {}


def nearest_by_hand(text, samples, model):
    """(language, cosine, rejected): the nearest centre, judged by the least cosine of its language."""
    rows = [gram_places(t) for texts in samples.values() for t in texts]
    present = Counter(place for row in rows for place in row)
    weight = {p: math.log((1 + len(rows)) / (1 + present[p])) + 1 for p in range(PLACES)}

    def vector(t):
        return unit({p: math.log1p(n) * weight[p] for p, n in gram_places(t).items()})

    def cosines(v):
        return [sum(x * float(centre[p]) for p, x in v.items()) for centre in model.centres]

    own = vector(text)
    if not own:
        return "und", 0.0, True
    each = cosines(own)
    best = each.index(max(each))
    name = model.languages[best]
    mine = [k for k, x in enumerate(model.languages) if x == name]
    least = min(max(cosines(vector(t))[k] for k in mine) for t in samples[name])
    return name, each[best], each[best] < language.REJECT * least


def test_languages_by_hand(spark):
    chance = random.Random(8)
    samples = {name: [prose(chance, words, 12) for _ in range(9)] for name, words in VOCABULARY.items()}
    rows = [(k, t, name) for k, (name, t) in enumerate((n, t) for n, ts in samples.items() for t in ts)]
    frame = spark.createDataFrame(rows * 2, "doc_id long, text string, lang string")  # each row twice
    model = language.train(frame, F.lit(True), clusters=2, dimensions=PLACES)
    assert sorted(set(model.languages)) == sorted(samples) and len(model.languages) == 6
    asked = [prose(chance, words, n) for words in VOCABULARY.values() for n in (1, 3, 12)]
    asked += [prose(chance, sum(VOCABULARY.values(), []), 20), "xyz wvu", "12 34", "", None, "Éé zz", asked[0], asked[0]]
    found = language.identify(docs_of(spark, asked), model).orderBy("doc_id").collect()
    for text, row in zip(asked, found, strict=True):
        name, cosine, rejected = nearest_by_hand(text or "", samples, model)
        assert (row.lang_pred, row.rejected) == (name, rejected), text
        assert row.score == pytest.approx(max(cosine, 0), abs=1e-5)
    assert any(row.rejected for row in found if row.lang_pred != "und")


# 5


def tokens_by_hand(text):
    return [w for w in re.split(r"(?:[^\w.]|_)+|\.(?!\d)", text.lower()) if w]


def shingles_by_hand(words):
    return {" ".join(words[k : k + 3]) for k in range(max(len(words) - 2, 1))}


def all_templates():
    return licences.TEMPLATES | licences.RELATIVES


def test_every_stretch_has_an_anchor():
    """Any choice of shingles of a template's share has one of the anchors."""
    texts = [tokens_by_hand(t) for found in all_templates().values() for t in found]
    known = set(licences.anchors(texts))
    for words in texts:
        own = {tuple(words[k : k + 3]) for k in range(max(len(words) - 2, 1))}
        assert sum(known.isdisjoint(shingle) for shingle in own) < licences.SHARE * len(own)
    assert licences.anchors([]) == []


def test_shares_by_hand(spark):
    chance = random.Random(6)
    templates = [tokens_by_hand(t) for found in all_templates().values() for t in found]
    pairs = []
    for words in templates:
        for _ in range(6):
            cut = sorted(chance.sample(range(len(words) + 1), 2))
            other = words[cut[0] : cut[1]] + chance.choices(words + ["other", "2.0"], k=chance.randint(1, 9))
            pairs.append((other, words))
    frame = spark.createDataFrame(pairs, "words array<string>, own array<string>")
    found = frame.select(licences.closeness(F.col("words"), F.col("own"))).collect()
    for (words, own), (share,) in zip(pairs, found):
        mine = shingles_by_hand(own)
        assert share == pytest.approx(len(shingles_by_hand(words) & mine) / len(mine))


def test_the_cut_by_hand(spark):
    """Halfway between what other lines reach and what lines of a family keep, on the fold that training leaves out."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    templates = licences.template_table(spark, all_templates())
    classifier = licences.train(docs, templates)
    rows = licences.training_rows(docs, templates).where("fold = 3")
    scored = classifier.model.transform(rows).select("family", vector_to_array("probability").alias("p")).collect()
    low = sorted(max(r.p[1:]) for r in scored if r.family == licences.NONE)
    high = sorted(r.p[classifier.names.index(r.family)] for r in scored if r.family != licences.NONE)

    def rank(values, share):
        return values[max(math.ceil(share * len(values)) - 1, 0)]

    # percentiles are right to a thousandth of the rows
    least, most = ((rank(low, 0.99 + by) + rank(high, 0.05 + by)) / 2 for by in (-0.001, 0.001))
    assert least <= classifier.cut <= most


def test_lines_by_hand(spark):
    """What the classifier says of each line, confirmed by shares and telling words in plain Python."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    templates = licences.template_table(spark, all_templates())
    classifier = licences.train(docs, templates)
    chance = random.Random(9)
    lines = [t for found in all_templates().values() for t in found]
    odd = [" ".join(chance.choices(tokens_by_hand(" ".join(lines)), k=chance.randint(1, 12))) for _ in range(60)]
    texts = ["\n\n".join(chance.choices([*lines, *odd, "plain words of prose", "..."], k=4)) for _ in range(40)]
    texts += [None, "", "word " * 200_000 + "\n\nAll rights reserved.", texts[0]]
    frame = docs_of(spark, texts)
    nameless = frame.where("doc_id = 1").withColumn("doc_id", F.lit(None).cast("long"))
    said = {}
    for row in classifier.classify(licences.paragraphs(frame)).collect():
        said[row.doc_id, row.place] = row.family, row.words
    rows = licences.scan(frame.unionByName(nameless), templates, classifier).collect()
    assert len(rows) == len(texts) + 1
    for row in rows:
        doc = 1 if row.doc_id is None else row.doc_id
        found, unknown = set(), 0
        for (own, _), (family, words) in said.items():
            if own != doc or family == licences.NONE:
                continue
            share = max(
                (
                    len(shingles_by_hand(words) & shingles_by_hand(tokens_by_hand(t))) / len(shingles_by_hand(tokens_by_hand(t)))
                    for t in all_templates().get(family, [])
                ),
                default=0,
            )
            told = family not in licences.TELLING or re.search(licences.TELLING[family], " ".join(words))
            if share >= licences.SHARE and told:
                found.add(family)
            else:
                unknown += 1
        # stretches may name more, never less
        assert found <= set(row.licences.split(",")) - {""}, texts[doc]
        assert row.n_unknown <= unknown
        assert row.n_paragraphs == sum(1 for line in (texts[doc] or "").split("\n") if re.search(r"[^\W_]", line))
