"""Grids over code lists without a cross join.

A short dimension (states, months of a range, a one-row parameter table) enters the plan as a scalar
subquery: Spark evaluates it once, fails if it is not short, and the rows are multiplied by
``explode`` inside the scan stage.  Nothing is shuffled and nothing is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

CHANNELS = ("R", "I")  # chain, independent
MAX_CODES = 1000


def one_value(parameters: DataFrame, column: str) -> Column:
    """The value of a one-row parameter table (Spark raises if it has more rows)."""
    return parameters.select(column).scalar()


def code_list(df: DataFrame, column: str, limit: int = MAX_CODES) -> Column:
    """Distinct values of a short column as an array; raises when there are more than ``limit``."""
    codes = df.select(column).distinct().agg(F.array_sort(F.collect_list(column)).alias("codes"))
    checked = codes.select(
        F.when(F.size("codes") <= limit, F.col("codes"))
        .otherwise(F.raise_error(F.lit(f"more than {limit} values of {column}")))
        .alias("codes")
    )
    return checked.scalar()


def times(df: DataFrame, codes: Column, name: str) -> DataFrame:
    """Repeat every row once per code."""
    return df.select("*", F.explode(codes).alias(name))


def times_all(df: DataFrame, codes: DataFrame, column: str, buckets: int = 16) -> DataFrame:
    """Repeat every row once per distinct code, however many there are.

    Codes are listed per hash bucket; a row is repeated per bucket, and meets the bucket's codes in an equi-join.
    """
    lists = (
        codes.select(column).distinct().groupBy(F.pmod(F.hash(column), F.lit(buckets)).alias("_bucket"))
        .agg(F.collect_list(column).alias("_codes"))
    )
    repeated = df.withColumn("_bucket", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    return repeated.join(lists, "_bucket").select(*df.columns, F.explode("_codes").alias(column))


def times_geos(df: DataFrame, states: DataFrame, state_column: str = "state_abbrev") -> DataFrame:
    """Repeat every row once per state and channel, as ``geo_lvl_cd``."""
    channels = F.array(*[F.lit(c) for c in CHANNELS])
    by_state = times(df, code_list(states, state_column), "_state")
    by_geo = times(by_state, channels, "_channel")
    return by_geo.withColumn("geo_lvl_cd", F.concat("_state", "_channel")).drop("_state", "_channel")
