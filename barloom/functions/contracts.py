"""Futures contract codes and expiry dates as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from barloom import constants as C

_CODE = rf"^([A-Z0-9]{{3}})([{C.MONTH_LETTERS}])(\d{{2}})$"


def decode(code: Column) -> dict[str, Column]:
    """Root, month and year of a code such as ``WINQ26``; nulls when it does not parse."""
    root, letter, year = (
        F.nullif(F.regexp_extract(code, _CODE, i), F.lit("")) for i in (1, 2, 3)
    )
    return {
        "root": root,
        "month": F.nullif(F.instr(F.lit(C.MONTH_LETTERS), letter), F.lit(0)),
        "year": F.lit(2000) + year.cast("int"),
    }


def encode(root: Column, date: Column) -> Column:
    letter = F.substring(F.lit(C.MONTH_LETTERS), F.month(date), F.lit(1))
    return F.concat(root, letter, F.date_format(date, "yy"))


def index_expiry(month: Column) -> Column:
    """The Wednesday nearest the 15th, in even months; null in odd ones.

    ``weekday`` is 0 on Monday; a Wednesday is at most three days away.
    """
    middle = F.date_add(F.trunc(month, "month"), 14)
    to_wednesday = F.pmod(F.lit(2) - F.weekday(middle) + F.lit(3), F.lit(7)) - F.lit(3)
    return F.when(F.month(month) % 2 == 0, F.date_add(middle, to_wednesday.cast("int")))


def dollar_expiry(month: Column) -> Column:
    """The first business day of the month; weekends are the only holidays known."""
    first = F.trunc(month, "month")
    wait = (
        F.when(F.weekday(first) == 5, F.lit(2)).when(F.weekday(first) == 6, F.lit(1)).otherwise(0)
    )
    return F.date_add(first, wait)
