"""Months as ``yyyyMM`` strings: they sort and compare as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def col_of(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def month_number(period: Column | str) -> Column:
    """Months since year 0, so that two periods can be subtracted."""
    period = col_of(period)
    return F.substring(period, 1, 4).cast("int") * 12 + F.substring(period, 5, 2).cast("int") - 1


def month_text(number: Column) -> Column:
    year = F.call_function("div", number, F.lit(12))
    month = number % 12 + 1
    return F.concat(year.cast("string"), F.lpad(month.cast("string"), 2, "0"))


def add_months(period: Column | str, n: int) -> Column:
    """Shift a period column by ``n`` months (integer arithmetic, no date parsing)."""
    return month_text(month_number(period) + F.lit(n))


def shift(period: str, n: int) -> str:
    """Shift one period value by ``n`` months."""
    total = int(period[:4]) * 12 + int(period[4:6]) - 1 + n
    return f"{total // 12:04d}{total % 12 + 1:02d}"


def months_between_list(period_from: str, period_to: str) -> list[str]:
    """All months of a closed interval, oldest first."""
    months, current = [], period_from
    while current <= period_to:
        months.append(current)
        current = shift(current, 1)
    return months


def months_ending(period_to: str, months: int) -> list[str]:
    """The ``months`` months that end with ``period_to``, oldest first."""
    return months_between_list(shift(period_to, 1 - months), period_to)


def with_months(df: DataFrame, months: list[str], name: str = "period_cd") -> DataFrame:
    """Repeat every row once per month of a literal list."""
    return df.select("*", F.explode(F.array(*[F.lit(m) for m in months])).alias(name))


def in_range(period_from: str, period_to: str, name: str = "period_cd") -> Column:
    return F.col(name).between(period_from, period_to)
