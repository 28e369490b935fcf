"""Money arithmetic.

Stored prices are ``decimal(18,4)``, means and weighted means ``decimal(22,8)``: sums of decimals
are exact, so results do not depend on the order in which partitions arrive.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from pricemill.functions.periods import col_of

PRICE = "decimal(18,4)"
MEAN = "decimal(22,8)"
UNITS = "decimal(15,0)"  # the widest whose product with a mean keeps all eight decimals


def price(value: Column | str) -> Column:
    return col_of(value).cast(PRICE)


def price_from_double(value: Column) -> Column:
    """Round a computed double half-up to four decimals."""
    return (F.floor(value * F.lit(10000.0) + F.lit(0.5)) / F.lit(10000.0)).cast(PRICE)


def mean(value: Column | str) -> Column:
    return F.avg(col_of(value)).cast(MEAN)


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    return F.when(denominator != 0, F.try_divide(numerator, denominator).cast(MEAN)).otherwise(
        F.lit(0).cast(MEAN)
    )


def weighted_mean(value: Column | str, weight: Column | str) -> Column:
    """``sum(value * weight) / sum(weight)``, 0 where the weights add up to 0."""
    weight = col_of(weight).cast(UNITS)
    return ratio_or_zero(F.sum(col_of(value).cast(MEAN) * weight), F.sum(weight))


def cents(value: Column | str) -> Column:
    """A price as an integer number of cents, rounded half-up on the decimal."""
    return (F.round(price(value), 2) * 100).cast("int")


def dbl(value: Column | str) -> Column:
    return col_of(value).cast("double")
