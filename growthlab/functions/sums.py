"""The three ways a grouped sum may treat NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sum_zero(col: Column) -> Column:
    """All-NULL gives 0."""
    return F.coalesce(F.sum(col), F.lit(0.0))


def sum_null(col: Column) -> Column:
    """All-NULL gives NULL."""
    return F.sum(col)


def sum_strict(col: Column) -> Column:
    """Any NULL gives NULL."""
    return F.when(F.count(col) == F.count(F.lit(1)), F.sum(col))


_TEXT = {
    "zero": "coalesce(sum({c}), 0)",
    "null": "sum({c})",
    "strict": "CASE WHEN count({c}) = count(1) THEN sum({c}) END",
}


def sums(cols: list[str], nulls: str) -> list[Column]:
    """The same sums for a long column list; nulls is 'zero', 'null' or 'strict'."""
    return [F.expr(_TEXT[nulls].format(c=f"`{c}`")).alias(c) for c in cols]


def sum_where(cond: Column, col: Column) -> Column:
    return F.coalesce(F.sum(F.when(cond, col)), F.lit(0.0))


def ratio(num: Column, den: Column) -> Column:
    return F.try_divide(F.sum(num).cast("double"), F.sum(den).cast("double"))
