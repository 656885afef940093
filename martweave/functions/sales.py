"""Column expressions of the sales marts. All are built-in and stay in the JVM."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from martweave.contract import INCENTIVE_RATE, MONEY, MONEY_TOTAL


def field(name: str) -> Column:
    """A column by its literal name, also when the name holds dots or backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def month_key(date: Column | str) -> Column:
    """``yyyy-MM``, the first seven characters of the date's text."""
    return F.substring(F.col(date) if isinstance(date, str) else date, 1, 7)


def month_start(date: Column | str) -> Column:
    """First day of the month: the same groups as ``month_key``, as a cheaper key."""
    return F.trunc(date, "month")


def full_name(first: Column | str, last: Column | str) -> Column:
    """First and last name with a blank between; NULL when either is NULL."""
    return F.concat(first, F.lit(" "), last)


def fold_extras(names: list[str]) -> Column:
    """One text of all extra columns in header order.

    NULL values are skipped, so a row without any value gives ``''``; a file
    without extra columns gives NULL.
    """
    if not names:
        return F.lit(None).cast("string")
    return F.concat_ws(", ", *[field(n) for n in names])


def extras_map(names: list[str]) -> Column:
    """Extra columns as a map that keeps their names."""
    if not names:
        return F.lit(None).cast("map<string,string>")
    pairs = [c for n in names for c in (F.lit(n), field(n))]
    return F.create_map(*pairs).cast("map<string,string>")


def whole_number(text: Column) -> Column:
    """Text to bigint. ``'7'`` and ``'7.0'`` give 7, ``'7.5'`` and ``'x'`` give NULL."""
    number = text.try_cast("decimal(38,10)")
    return F.coalesce(
        text.try_cast("bigint"),  # the common case, without decimal arithmetic
        F.when(number == F.floor(number), number.try_cast("bigint")),
    )


def money(text: Column) -> Column:
    """Text to money, rounded half up to cents; NULL when it is no number."""
    return text.try_cast(MONEY)


def incentive(total: Column, best: Column, rate: str = INCENTIVE_RATE) -> Column:
    """The share paid to the best seller of a group, 0 to the others.

    ``best`` is the group's highest total. Ties are all paid. In a group
    without any total (all NULL) everybody ranks first with a NULL incentive.
    """
    share = F.lit(Decimal(rate))
    return F.round(F.when(total.eqNullSafe(best), total * share).otherwise(F.lit(0)), 2).cast(MONEY_TOTAL)
