"""Row updates, deletes and period replacement as pure functions, plus the partitioned sink."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from pricemill.session import shuffles_dropped


def same(left: DataFrame, right: DataFrame, keys: list[str], null_safe: bool = False) -> Column:
    """Equality of the same-named key columns of two frames."""
    pairs = [
        left[k].eqNullSafe(right[k]) if null_safe else left[k] == right[k] for k in keys
    ]
    return reduce(lambda a, b: a & b, pairs)


def update_join(target: DataFrame, updates: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Replace ``columns`` of the target rows that have a match in ``updates`` (unique by ``keys``).

    A match may set a null, hence the explicit flag instead of a coalesce.
    """
    renamed = updates.select(
        *keys, *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(1).alias("_matched")
    )
    joined = target.join(renamed, keys, "left")
    return joined.select(
        *[
            F.when(F.col("_matched") == 1, F.col(f"_new_{c}").cast(target.schema[c].dataType))
            .otherwise(F.col(c))
            .alias(c)
            if c in columns
            else F.col(c)
            for c in target.columns
        ]
    )


def delete_join(target: DataFrame, deletes: DataFrame, keys: list[str]) -> DataFrame:
    return target.join(deletes.select(*keys), keys, "left_anti").select(*target.columns)


def replace_period(
    table: DataFrame, df: DataFrame, *, period_from: str, period_to: str, name: str = "period_cd"
) -> DataFrame:
    """The table with the rows of a period range replaced by ``df`` (columns matched by name)."""
    kept = clear_period(table, period_from=period_from, period_to=period_to, name=name)
    return kept.unionByName(df.select(*table.columns))


def clear_period(
    table: DataFrame, *, period_from: str, period_to: str, name: str = "period_cd"
) -> DataFrame:
    outside = ~F.col(name).between(period_from, period_to)
    return table.filter(outside | F.col(name).isNull())


def append_audit(history: DataFrame, batch: DataFrame, **stamps) -> DataFrame:
    """Append a batch to a history table; ``stamps`` are literal columns such as the batch id."""
    for column, value in stamps.items():
        batch = batch.withColumn(column, F.lit(value).cast(history.schema[column].dataType))
    return history.unionByName(batch.select(*history.columns))


def write_period(df: DataFrame, path: str, period: str, name: str = "period_cd") -> None:
    """Overwrite one month of a partitioned parquet table, also when the month is now empty."""
    month = df.filter(F.col(name) == period).drop(name)
    month.write.mode("overwrite").parquet(f"{path}/{name}={period}")


def write_periods(df: DataFrame, path: str, name: str = "period_cd", *, gathered: bool = False) -> None:
    """Overwrite exactly the months present in ``df`` (dynamic partition overwrite).

    The rebalance hint gathers a month into few files and splits a month that holds most rows.  Lines that are ``gathered``, as they
    come from few files of one month each, are written as they are read.
    """
    with shuffles_dropped(df.sparkSession):
        (
            (df if gathered else df.hint("rebalance", name))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(name)
            .parquet(path)
        )


def store_in_buckets(df: DataFrame, name: str, path: str, *, keys: list[str], buckets: int) -> DataFrame:
    """Write ``df`` as the table ``name`` in buckets of ``keys``, each one sorted file, and read it back.

    Aggregations and windows whose keys contain these columns, and joins on exactly these, need no exchange of it, with as
    many buckets as shuffle partitions at least.
    """
    (
        df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").option("path", path)
        .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    )
    return df.sparkSession.table(name)
