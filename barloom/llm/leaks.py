"""Benchmark passages in documents, through a distributed positional inverted index.

Benchmark items are cut into windows of ten words. The index stores (term, document,
position) for the terms that windows are searched by: of each window the ``LISTS``
rarest, by their count over all documents; windows with a term that no document has
are left out. A window's lists are shifted by the terms' offsets and intersected:
what is in all of them is a place where the window may start, and the document's
words there decide. Rows grow with the occurrences of rare terms, and a frequent
passage gives each document its own rows, so no task gets one passage's rows.

``near`` reads the same index for proximity: items of which a window's rare terms
stand within ``SLOP`` words of each other, in any order. The terms are the ``LISTS``
rarest different ones that documents have, so that a word that was swapped for another
does not hide its window; a window with one such term only has no proximity match.
Windows with the same terms are looked up once. ``find_near`` returns these items of
every document.

The benchmark's terms are broadcast only if Spark finds the written table smaller
than its broadcast threshold, and joined by shuffle otherwise.

Defined cases: null texts have no words; an item without words or without item_id
has no window, one of fewer than ten words is a single window; items with equal
windows all count; rows of equal doc_id and text get equal results; other columns
are ignored; without items nothing is hit; an empty table returns no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, covered, split_words, stage

WINDOW = 10
LISTS = 2
SLOP = 20
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
KEY = ["doc_id", "sig"]


def words_of(text: Column) -> Column:
    return split_words(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS)


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(phrase, length, items): the different windows and the items that have them."""
    words = items.where("item_id is not null").select(
        F.col("item_id").cast("string").alias("item"), words_of(F.col("text")).alias("words")
    )
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - window + 1, F.lit(1)))
    return (
        words.where(F.size("words") > 0)
        .select("item", "words", F.explode(starts).alias("at"))
        .select("item", F.slice("words", F.col("at"), window).alias("terms"))
        .groupBy(F.array_join("terms", " ").alias("phrase"))
        .agg(F.collect_set("item").alias("items"))
        .withColumn("length", F.size(F.split("phrase", " ")))
    )


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("text").alias("sig"), "text")


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, n) over all documents, for the given terms."""
    found = docs.select(F.explode(words_of(F.col("text"))).alias("term"))
    return found.join(terms, "term").groupBy("term").agg(F.count("*").alias("n"))


def rare_lists(windows: DataFrame, counts: DataFrame, lists: int = LISTS) -> DataFrame:
    """(phrase, place, lists, offset, term): the terms each window is searched by."""
    spread = windows.select("phrase", F.posexplode(F.split("phrase", " ")).alias("offset", "term"))
    ranked = (
        spread.join(counts, "term", "left")
        .groupBy("phrase")
        .agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "offset", "term"))).alias("all"))
        .where(F.col("all")[0]["n"] > 0)
    )
    chosen = ranked.select("phrase", F.slice("all", 1, lists).alias("rare"))
    return chosen.select(
        "phrase", F.size("rare").alias("lists"), F.posexplode("rare").alias("place", "one")
    ).select("phrase", "place", "lists", "one.offset", "one.term")


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, doc_id, sig, pos): the positional index, for the given terms."""
    found = keyed(docs).select("doc_id", "sig", F.posexplode(words_of(F.col("text"))).alias("pos", "term"))
    return found.join(terms, "term").select("term", *KEY, "pos")


def phrase_places(index: DataFrame, lists: DataFrame) -> DataFrame:
    """(doc_id, sig, phrase, start) in all of a window's shifted lists."""
    shifted = index.join(lists, "term").withColumn("start", F.col("pos") - F.col("offset"))
    return (
        shifted.where("start >= 0")
        .groupBy(*KEY, "phrase", "start")
        .agg(F.count_distinct("place").alias("found"), F.first("lists").alias("lists"))
        .where("found = lists")
        .select(*KEY, "phrase", "start")
    )


def near_lists(windows: DataFrame, counts: DataFrame, lists: int = LISTS) -> DataFrame:
    """(phrase, term): the rarest different terms of each window that documents have."""
    spread = windows.select("phrase", F.explode(F.array_distinct(F.split("phrase", " "))).alias("term"))
    return (
        spread.join(counts, "term")
        .groupBy("phrase")
        .agg(F.array_sort(F.collect_list(F.struct("n", "term"))).alias("all"))
        .select("phrase", F.explode(F.slice("all", 1, lists)).alias("one"))
        .select("phrase", "one.term")
    )


def near(index: DataFrame, lists: DataFrame, windows: DataFrame, slop: int = SLOP) -> DataFrame:
    """(doc_id, sig, item): items of which a window's rare terms stand close together."""
    sets = (
        lists.groupBy("phrase")
        .agg(F.array_sort(F.collect_set("term")).alias("terms"))
        .where(F.size("terms") > 1)
        .join(windows, "phrase")
        .groupBy("terms")
        .agg(F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
        .withColumn("together", F.array_join("terms", " "))
    )
    wanted = sets.select("together", F.size("terms").alias("size"), F.posexplode("terms").alias("place", "term"))
    reach = Window.partitionBy(*KEY, "together").orderBy("pos").rangeBetween(-slop, 0)
    close = (
        index.join(wanted, "term")
        .withColumn("found", F.size(F.collect_set("place").over(reach)))
        .where("found = size")
        .select(*KEY, "together")
        .distinct()
    )
    return close.join(sets, "together").select(*KEY, F.explode("items").alias("item")).distinct()


def find_near(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, lists: int = LISTS, slop: int = SLOP
) -> DataFrame:
    """doc_id, n_near_items, near_items and near_items_sha256 of every row."""
    windows = stage(item_windows(items, window), "windows")
    terms = windows.select(F.explode(F.split("phrase", " ")).alias("term")).distinct()
    counts = stage(term_counts(docs, stage(terms, "terms")), "counts")
    rare = stage(near_lists(windows, counts, lists), "rare")
    index = postings(docs, stage(rare.select("term").distinct(), "terms"))
    found = near(index, rare, windows, slop).groupBy(*KEY).agg(F.array_sort(F.collect_set("item")).alias("items"))
    rows = docs.select("doc_id", F.xxhash64("text").alias("sig"))
    same = F.col("d.doc_id").eqNullSafe(F.col("p.doc_id")) & (F.col("d.sig") == F.col("p.sig"))
    joined = rows.alias("d").join(stage(found, "near").alias("p"), same, "left")
    return joined.select(
        "d.doc_id", F.coalesce("items", F.array().cast("array<string>")).alias("near_items")
    ).select(
        "doc_id",
        F.size("near_items").cast("long").alias("n_near_items"),
        "near_items",
        F.sha2(F.array_join("near_items", ","), 256).alias("near_items_sha256"),
    )


def judged_rows(
    docs: DataFrame, items: DataFrame, carry: list[str], window: int = WINDOW, lists: int = LISTS
) -> DataFrame:
    """row (the carried columns), n_words and hits (start, length, phrase, items) of every row."""
    windows = stage(item_windows(items, window), "windows")
    terms = windows.select(F.explode(F.split("phrase", " ")).alias("term")).distinct()
    counts = stage(term_counts(docs, stage(terms, "terms")), "counts")
    rare = stage(rare_lists(windows, counts, lists), "rare")
    index = stage(postings(docs, stage(rare.select("term").distinct(), "terms")), "postings")
    found = stage(
        phrase_places(index, rare)
        .join(windows, "phrase")
        .groupBy(*KEY)
        .agg(F.collect_list(F.struct("start", "length", "phrase", "items")).alias("places")),
        "places",
    )
    rows = docs.select(
        F.struct(*carry).alias("row"), "doc_id", F.xxhash64("text").alias("sig"), "text"
    )
    same = F.col("d.doc_id").eqNullSafe(F.col("p.doc_id")) & (F.col("d.sig") == F.col("p.sig"))
    joined = rows.alias("d").join(found.alias("p"), same, "left")
    read = joined.select("row", words_of(F.col("text")).alias("words"), "places")

    def holds(place: Column) -> Column:
        own = F.slice("words", place["start"] + 1, place["length"])
        return F.array_join(own, " ") == place["phrase"]

    return read.select(
        "row",
        F.size("words").cast("long").alias("n_words"),
        F.sort_array(F.filter("places", holds)).alias("hits"),
    )


def find_leaks(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, lists: int = LISTS
) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items, items_sha256 and contaminated of every row."""
    rows = judged_rows(docs, items, ["doc_id"], window, lists)
    names = F.array_distinct(F.flatten(F.transform("hits", lambda hit: hit["items"])))
    return (
        rows.withColumn("items", F.coalesce(F.array_sort(names), F.array().cast("array<string>")))
        .withColumn("n_hit", F.coalesce(covered(F.col("hits")), F.lit(0)))
        .select(
            "row.doc_id",
            "n_words",
            "n_hit",
            F.size("items").cast("long").alias("n_items"),
            "items",
            F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
            (F.col("n_hit") > 0).alias("contaminated"),
        )
    )


def drop_leaking(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, lists: int = LISTS
) -> DataFrame:
    """The rows of ``docs`` without any passage of the benchmark."""
    rows = judged_rows(docs, items, docs.columns, window, lists)
    return rows.where(F.coalesce(F.size("hits"), F.lit(0)) <= 0).select("row.*")
