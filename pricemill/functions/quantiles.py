"""Exact group quantiles that no hot group can overload.

``percentile`` keeps all values of a group in one aggregation buffer, so one product that holds a
third of all transactions ends up in one task.  Here the values are counted per (group, bucket,
value), where the bucket is a monotone function of the value; a cumulative count over the few
thousand buckets of a group finds the bucket that holds each wanted rank, and only the distinct
values of that bucket are ordered.  All groups, large and small, take this way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pricemill.functions.numbers import MEAN

BUCKETS_PER_E = 256  # one bucket spans 0.4 % of the value


def _bucket(value: Column) -> Column:
    x = value.cast("double")
    magnitude = F.floor(F.log(F.abs(x)) * F.lit(float(BUCKETS_PER_E)))
    offset = F.lit(1_000_000)
    return (
        F.when(x > 0, magnitude + offset).when(x < 0, -magnitude - offset).otherwise(F.lit(0))
    ).cast("long")


def _ranks(probabilities: list[float], interpolate: bool) -> list[tuple[int, Column]]:
    """(id, rank) of the wanted rows, in terms of the group size ``_total``."""
    total = F.col("_total")
    ranks = []
    for i, p in enumerate(probabilities):
        if interpolate:
            position = (total - 1) * F.lit(p)
            ranks += [(2 * i, F.floor(position) + 1), (2 * i + 1, F.ceil(position) + 1)]
        else:
            ranks.append((i, F.greatest(F.ceil(total * F.lit(p)), F.lit(1).cast("long"))))
    return [(i, rank.cast("long")) for i, rank in ranks]


def _hits(rows: DataFrame, keys: list[str], ranks: list[tuple[int, Column]]) -> DataFrame:
    """(keys, _total, _id, _value) of the wanted ranks."""
    counted = (
        rows.withColumn("_bucket", _bucket(F.col("_value")))
        .groupBy(*keys, "_bucket", "_value")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    histogram = counted.groupBy(*keys, "_bucket").agg(F.sum("_n").alias("_in_bucket"))
    whole = Window.partitionBy(*keys)
    ordered = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    targets = (
        histogram.withColumn("_upto", F.sum("_in_bucket").over(ordered))
        .withColumn("_total", F.sum("_in_bucket").over(whole))
        .select(
            *keys,
            "_bucket",
            "_total",
            (F.col("_upto") - F.col("_in_bucket")).alias("_before"),
            "_upto",
            F.explode(
                F.array(
                    *[
                        F.struct(F.lit(i).alias("id"), rank.alias("rank"))
                        for i, rank in ranks
                    ]
                )
            ).alias("_want"),
        )
        .filter((F.col("_want.rank") > F.col("_before")) & (F.col("_want.rank") <= F.col("_upto")))
        .groupBy(*keys, "_bucket", "_total")
        .agg(
            F.collect_list(
                F.struct("_want.id", (F.col("_want.rank") - F.col("_before")).alias("rank"))
            ).alias("_wants")
        )
    )
    renamed = targets.select(
        *[F.col(k).alias(f"_at_{k}") for k in [*keys, "_bucket"]], "_total", "_wants"
    )
    # Groups may have null keys.
    same = [F.col(k).eqNullSafe(F.col(f"_at_{k}")) for k in [*keys, "_bucket"]]
    candidates = counted.join(renamed, same, "inner")
    within = (
        Window.partitionBy(*keys, "_bucket")
        .orderBy("_value")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        candidates.withColumn("_cum", F.sum("_n").over(within))
        .select(*keys, "_value", "_n", "_cum", "_total", F.explode("_wants").alias("_want"))
        .filter(
            (F.col("_want.rank") <= F.col("_cum"))
            & (F.col("_want.rank") > F.col("_cum") - F.col("_n"))
        )
        .select(*keys, "_total", F.col("_want.id").alias("_id"), "_value")
    )


def group_quantiles(
    df: DataFrame,
    keys: list[str],
    value: str,
    probabilities: list[float],
    *,
    names: list[str],
    interpolate: bool = False,
    count_name: str | None = None,
) -> DataFrame:
    """One row per group with a column per probability.

    ``interpolate=False`` returns the value at rank ``ceil(p * n)`` (what ``percentile_approx``
    returns at full accuracy); ``interpolate=True`` the continuous percentile of a price.
    Null values are ignored.  ``df`` is read once: the histogram and the values of the wanted
    buckets come from the same exchange of counts.
    """
    rows = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_value"))
    hits = _hits(rows, keys, _ranks(probabilities, interpolate))

    def at(i: int) -> Column:
        return F.max(F.when(F.col("_id") == i, F.col("_value")))

    columns = []
    for i, (p, name) in enumerate(zip(probabilities, names)):
        if interpolate:
            low, high = at(2 * i).cast(MEAN), at(2 * i + 1).cast(MEAN)
            position = (F.max("_total") - 1) * F.lit(p)
            share = (position - F.floor(position)).cast("decimal(9,8)")
            columns.append((low + (high - low) * share).cast(MEAN).alias(name))
        else:
            columns.append(at(i).alias(name))
    if count_name:
        columns.append(F.max("_total").alias(count_name))
    return hits.groupBy(*keys).agg(*columns)
