from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from barloom.functions.contracts import decode, dollar_expiry, encode, index_expiry


@pytest.mark.parametrize(
    "code, expected",
    [
        ("WINQ26", ("WIN", 8, 2026)),
        ("WDOF07", ("WDO", 1, 2007)),
        ("WDOZ30", ("WDO", 12, 2030)),
        ("WINA26", (None, None, None)),
        ("WIN$", (None, None, None)),
        (None, (None, None, None)),
    ],
)
def test_decode(spark, code, expected):
    df = spark.createDataFrame([(code,)], "code string")
    parts = decode(F.col("code"))
    assert tuple(df.select(*[parts[n] for n in ("root", "month", "year")]).first()) == expected


def test_encode_is_the_inverse(spark):
    df = spark.sql("SELECT explode(sequence(DATE'2026-01-01', DATE'2026-12-01', INTERVAL 1 MONTH)) m")
    coded = df.select("m", decode(encode(F.lit("WDO"), F.col("m")))["month"].alias("n"))
    assert all(r["m"].month == r["n"] for r in coded.collect())


def test_expiries_of_2026(spark):
    df = spark.sql("SELECT explode(sequence(DATE'2026-01-01', DATE'2026-12-01', INTERVAL 1 MONTH)) m")
    rows = df.select("m", index_expiry(F.col("m")).alias("i"), dollar_expiry(F.col("m")).alias("d"))
    found = {r["m"].month: (r["i"], r["d"]) for r in rows.collect()}
    index = {2: 18, 4: 15, 6: 17, 8: 12, 10: 14, 12: 16}
    for month, (expiry, first) in found.items():
        assert expiry == (dt.date(2026, month, index[month]) if month in index else None)
        assert first.weekday() < 5 and first.day <= 3
