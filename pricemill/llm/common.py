"""Helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from pricemill.session import cut_lineage

# A word is a run of characters other than space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(df: DataFrame) -> DataFrame:
    """Cut the lineage in the shared checkpoint folder: computed once, and safe when executors are lost."""
    return cut_lineage(df)


def bucket_of(column: Column | str, buckets: int) -> Column:
    """An even, repeatable bucket of a key's text form; null counts as a key of its own."""
    return F.crc32(F.coalesce(F.col(column).cast("string") if isinstance(column, str) else column.cast("string"), F.lit("~"))) % buckets


def chunks_for(rows: int, per_chunk: int = 10_000) -> int:
    return max(1, -(-rows // per_chunk))


def running_total(
    df: DataFrame, value: Column, by: str, order: list[Column], chunks: int, key: str, total: str, row: str
) -> DataFrame:
    """Per value of ``by``: ``total``, the sum of ``value`` over the rows before this one, and ``row``, their number.

    The order is (bucket of ``key``, ``order``).  Only the sums of the buckets meet in one window per ``by``; rows are
    sorted per (by, bucket), so that a ``by`` with a third of all rows is spread over as many tasks as it has buckets.
    """
    df = df.withColumn("_value", value).withColumn("_bucket", bucket_of(key, chunks))
    before = Window.partitionBy("_by").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = df.groupBy(F.col(by).alias("_by"), F.col("_bucket").alias("_b")).agg(
        F.sum("_value").alias("_sum"), F.count(F.lit(1)).alias("_rows"))
    starts = starts.select(
        "_by", "_b", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_row"))
    inside = Window.partitionBy(by, "_bucket").orderBy(*order)
    placed = df.join(starts, (F.col(by) == F.col("_by")) & (F.col("_bucket") == F.col("_b")))
    return placed.select(
        "*",
        (F.col("_start") + F.sum("_value").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_value"))
        .cast("long").alias(total),
        (F.col("_row") + F.row_number().over(inside) - 1).cast("long").alias(row),
    ).drop("_value", "_bucket", "_by", "_b", "_start", "_row")
