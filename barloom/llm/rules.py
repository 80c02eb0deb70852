"""Quality rules whose thresholds come from the data, by language and source.

Each text has four rates per thousand: symbols per word, duplicate lines per line,
repeated words per word, and mean word length. Rates are gathered in quantile
sketches, one per language, source and rate. A sketch counts log-linear buckets
(six significant bits, so a value is known within 1/32); two sketches merge by
adding their counts, in any order and with the same result, which is also how the
sketches of all sources of a language, and of all languages, come about. A sketch
has a bounded number of buckets whatever it counts.

A rate is an outlier above its upper quartile plus ``FENCE`` times the quartile
distance (which counts as a stated least distance at least); the mean word length
also below the lower quartile less as much. A group with less than ``LEAST_ROWS``
texts takes the fences of its language, or else of all. A text stays if it passes
the base rules and no rate is an outlier. Thresholds see all texts with a word.

Defined cases: a null or wordless text has zero counts and fails the base rules; a
null language or source is a group of its own; repeated rows count and return as
often as they come; other columns are ignored; an empty table returns no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, SPACE_RUN, covered, split_words, stage

WINDOW = 5
SYMBOLS = "#*$%&|<>"
FENCE = 3
LEAST_ROWS = 100
#: Rates, each with the least quartile distance that counts.
RATES = {"symbol_rate": 50, "line_rate": 100, "repeat_rate": 100, "word_length": 500}
BITS = 6


def base_counts(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, lang, source, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: F.translate(line, SPACE, "") != "")
    first = docs.select(
        "doc_id",
        "lang",
        "source",
        F.length(F.translate(text, SPACE, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        lines.alias("_lines"),
        F.transform(split_words(text, SPACE_RUN), lambda word: F.xxhash64(word)).alias("_hash"),
    )
    size = F.size("_hash")
    grams = F.when(
        size > window,
        F.transform(
            F.sequence(F.lit(0), size - window),
            lambda k: F.xxhash64(*(F.get("_hash", k + step) for step in range(window))),
        ),
    )
    second = first.select(
        "doc_id", "lang", "source", "word_chars", "n_symbols",
        size.cast("long").alias("n_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        grams.alias("_gram"),
    )
    placed = F.when(
        F.size("_gram") > F.size(F.array_distinct("_gram")),
        F.array_sort(F.transform("_gram", lambda gram, k: F.struct(gram.alias("g"), k.alias("k")))),
    )
    third = second.withColumn("_placed", placed).drop("_gram")

    def twice(item: Column, k: Column) -> Column:
        return (item["g"] == F.get("_placed", k - 1)["g"]) | (item["g"] == F.get("_placed", k + 1)["g"])

    again = F.transform(
        F.filter("_placed", lambda item, k: F.coalesce(twice(item, k), F.lit(False))), lambda item: F.struct(item["k"].alias("start"), F.lit(window).alias("length"))
    )
    return third.withColumn("_again", F.sort_array(again)).select(
        "doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
        F.coalesce(covered(F.col("_again")), F.lit(0)).alias("n_repeat_words"),
    )


def with_rates(counts: DataFrame) -> DataFrame:
    """Rates per thousand, as whole numbers; null without words."""
    return counts.withColumns(
        {
            "symbol_rate": F.expr("case when n_words > 0 then 1000 * n_symbols div n_words end"),
            "line_rate": F.expr("case when n_lines > 0 then 1000 * n_dup_lines div n_lines end"),
            "repeat_rate": F.expr("case when n_words > 0 then 1000 * n_repeat_words div n_words end"),
            "word_length": F.expr("case when n_words > 0 then 1000 * word_chars div n_words end"),
            "base_failed": F.expr("n_words < 10 or 100 * n_repeat_words > 20 * n_words"),
        }
    )


def sketches(rated: DataFrame) -> DataFrame:
    """(lang, source, rate, bucket, n): a bucket is known by its lowest value."""
    pairs = F.explode(F.array(*(F.struct(F.lit(r).alias("rate"), F.col(r).alias("value")) for r in RATES)))
    bucket = F.expr("shiftleft(shiftright(value, shift), shift)")
    return (
        rated.where("n_words > 0")
        .select("lang", "source", pairs.alias("pair"))
        .select("lang", "source", "pair.*")
        .withColumn("shift", F.greatest(F.lit(0), F.length(F.bin("value")) - BITS))
        .groupBy("lang", "source", "rate", bucket.alias("bucket"))
        .agg(F.count("*").alias("n"))
    )


def merged(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches of coarser groups: bucket counts add up."""
    return sketch.groupBy(*keys, "rate", "bucket").agg(F.sum("n").alias("n"))


def fences(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """One row per group: its size, and per rate the fences low_ and high_."""
    own = Window.partitionBy(*keys, "rate")
    upto = own.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    counted = sketch.withColumns({"_upto": F.sum("n").over(upto), "_all": F.sum("n").over(own)})

    def quantile(quarter: int) -> Column:
        return F.min(F.when(F.col("_upto") * 4 >= F.col("_all") * quarter, F.col("bucket")))

    quartiles = counted.groupBy(*keys, "rate").agg(
        quantile(1).alias("q1"), quantile(3).alias("q3"), F.max("_all").alias("rows")
    )
    columns = [F.max("rows").alias("rows")]
    for rate, least in RATES.items():
        mine = F.col("rate") == rate
        reach = FENCE * F.greatest(F.col("q3") - F.col("q1"), F.lit(least))
        columns += [
            F.max(F.when(mine, F.col("q1") - reach)).alias(f"low_{rate}"),
            F.max(F.when(mine, F.col("q3") + reach)).alias(f"high_{rate}"),
        ]
    return quartiles.groupBy(*keys).agg(*columns)


def thresholds(rated: DataFrame, least_rows: int = LEAST_ROWS) -> DataFrame:
    """Fences of every (lang, source), from the finest group with enough texts."""
    fine = stage(sketches(rated), "sketches")
    names = [f"{side}_{rate}" for rate in RATES for side in ("low", "high")]
    by_source = fences(fine, ["lang", "source"])
    by_lang = fences(merged(fine, ["lang"]), ["lang"])
    overall = fences(merged(fine, []), []).first()  # one row of eight fences
    source, lang = by_source.alias("s"), by_lang.alias("l")
    joined = source.join(lang, F.col("s.lang").eqNullSafe(F.col("l.lang")))
    chosen = [
        F.when(F.col("s.rows") >= least_rows, F.col(f"s.{name}"))
        .when(F.col("l.rows") >= least_rows, F.col(f"l.{name}"))
        .otherwise(F.lit(overall[name] if overall else None))
        .alias(name)
        for name in names
    ]
    return joined.select(F.col("s.lang").alias("_lang"), F.col("s.source").alias("_source"), *chosen)


def judge(docs: DataFrame, least_rows: int = LEAST_ROWS) -> DataFrame:
    """The base counts, rates, base_failed and kept of every text."""
    rated = stage(with_rates(base_counts(docs)), "rated")
    limits = stage(thresholds(rated, least_rows), "limits")
    group = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    outlier = F.col("word_length") < F.col("low_word_length")
    for rate in RATES:
        outlier = outlier | (F.col(rate) > F.col(f"high_{rate}"))
    return rated.join(limits, group, "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~F.coalesce(outlier, F.lit(False))).alias("kept"),
        *RATES,
    )
