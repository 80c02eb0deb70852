"""From raw documents to packed training sequences, one operator per stage.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept.
All but the last return the columns of ``documents``. ``run`` writes every stage to
the shared folder and gives the written rows to the next.

SQL can't express the first two stages and the last, so ``ORACLE_SQL`` is None.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import language, leaks, packing, simhash, substrings
from barloom.llm.common import stage, table

ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a known language stay; what the classifier rejects goes."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), "text")
    found = language.identify(rows, language.train(docs))
    return found.where(~F.col("rejected")).select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays.

    Rows are told apart by id and text, so of several texts under one id each is judged in
    its own group. Of repeated rows of a document that stays one is kept. Rows without an
    id stay.
    """
    found = stage(simhash.grouped(docs).where("doc_id is not null").select("doc_id", "sign", "leads"), "groups")
    copies = found.where("not leads").select(F.col("doc_id").alias("_id"), F.col("sign").alias("_sign")).distinct()
    rows = docs.select(
        F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("_key"), F.xxhash64("text").alias("_text")
    )
    # the rows that go are the shorter list: Spark may broadcast it and leave the texts in place
    same = (F.col("_key") == F.col("_id")) & (F.col("_text") == F.col("_sign"))
    own = rows.join(stage(copies, "copies"), same, "left_anti")
    leading = found.where("leads").groupBy("doc_id", "sign").agg(F.count("*").alias("n"))
    if leading.where("n > 1").take(1):
        named = own.where("_key is not null").dropDuplicates(["_key", "_text"])
        own = named.unionByName(own.where("_key is null"))
    return own.select("row.*")


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that a smaller document has go; other documents stay as they are."""
    return substrings.drop_repeats(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return leaks.drop_leaking(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences."""
    return packing.pack(docs)


STAGES = [
    ("language ID", identify_language),
    ("SimHash near-dedup", drop_near_copies),
    ("substring dedup", drop_repeated_passages),
    ("benchmark decontamination", drop_leaks),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
