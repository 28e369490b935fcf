"""Delimited files, period-filtered sources and text exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from pricemill.session import cut_lineage


CORRUPT = "_corrupt_record"


def _delimited(spark: SparkSession, path: str | list[str], columns: list[str], sep: str) -> DataFrame:
    schema = ", ".join(f"`{c}` string" for c in [*columns, CORRUPT])
    reader = spark.read.schema(schema).option("header", "true").option("sep", sep).option("enforceSchema", "false")
    # without pruning, or a query of a few columns would not see that a line has too many or too few
    reader = reader.option("mode", "PERMISSIVE").option("columnPruning", "false")
    return reader.option("columnNameOfCorruptRecord", CORRUPT).csv(path)


def bad_lines(spark: SparkSession, path: str | list[str], *, columns: list[str], sep: str = "|") -> DataFrame:
    """Lines with more or fewer fields than the columns: file, first field and line."""
    rows = _delimited(spark, path, columns, sep)
    return rows.filter(F.col(CORRUPT).isNotNull()).select(
        F.col("_metadata.file_name").alias("file_nm"), F.col(f"`{columns[0]}`").alias("key"), F.col(CORRUPT).alias("line")
    )


def read_delimited(
    spark: SparkSession, path: str | list[str], *, columns: list[str], sep: str = "|"
) -> DataFrame:
    """All columns of one or several files as text.

    A line that does not fit the columns fails the read, and the error names its file and its content; a header that names
    other columns fails it, too.
    """
    rows, first = _delimited(spark, path, columns, sep), F.coalesce(F.col(f"`{columns[0]}`"), F.lit(""))
    message = F.concat(
        F.lit("a line does not fit its columns: file "), F.col("_metadata.file_name"), F.lit(", key "), first, F.lit(", line "), F.col(CORRUPT)
    )
    fits = F.when(F.col(CORRUPT).isNull(), True).otherwise(F.raise_error(message).cast("boolean"))
    return rows.filter(fits).select(*[F.col(f"`{c}`") for c in columns])


def typed(raw: DataFrame, schema: dict[str, str]) -> DataFrame:
    """Cast an all-text frame to the types of its target table."""
    return raw.select(*[F.col(c).cast(t).alias(c) for c, t in schema.items()])


def read_typed(spark: SparkSession, path: str, *, schema: str | None = None, sep: str = ",") -> DataFrame:
    """A comma file with a header; types come from ``schema``, or are inferred without one."""
    reader = (
        spark.read.option("header", "true")
        .option("sep", sep)
        .option("mode", "FAILFAST")
    )
    reader = reader.schema(schema) if schema else reader.option("inferSchema", "true")
    return reader.csv(path)


def read_reference_files(
    spark: SparkSession, folder: str, schemas: dict[str, dict[str, str]]
) -> dict[str, DataFrame]:
    """Typed frames of the reference files, by name; each is a file ``name.csv`` or a folder of that name with several files."""
    return {
        name: typed(
            read_delimited(spark, f"{folder}/{name}.csv", columns=list(schema)), schema
        )
        for name, schema in schemas.items()
    }


def load_period(df: DataFrame, period: str, *, columns: list[str], name: str = "period") -> DataFrame:
    """One period of a source: filter and projection reach the scan of any pushdown-capable source."""
    return df.filter(F.col(name) == period).select(*columns)


def load_periods(df: DataFrame, periods: DataFrame, *, columns: list[str], name: str = "period") -> DataFrame:
    """The periods that a table lists: with a source partitioned by period, their files are chosen when the query runs."""
    wanted = periods.select(F.col(name).alias("_wanted")).distinct()
    return df.join(wanted, F.col(name) == F.col("_wanted"), "left_semi").select(*columns)


def numbered(df: DataFrame, order: list[str], name: str = "row_no") -> DataFrame:
    """Gapless numbers 0, 1, ... in the order of ``order``, without one task that sees all rows.

    Rows are sorted over ranges and kept once, so that each has a fixed place in its part; the rows of the parts before it
    are a running sum over one number per part.
    """
    place = F.monotonically_increasing_id()  # the part in the upper bits, the place in it in the lower 33
    placed = cut_lineage(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumns({"_part": F.shiftright(place, 33), "_at": place.bitwiseAND(F.lit((1 << 33) - 1))})
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows")).select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    )
    return placed.join(starts, "_part").select(*df.columns, (F.col("_start") + F.col("_at")).alias(name))


def write_chunks(lines: DataFrame, path: str, *, max_lines: int) -> None:
    """One text column in files of exactly ``max_lines`` lines, the last one shorter, whatever its partitions.

    The lines are sorted; chunk n is the one file of the folder ``chunk=n``, counted from 0.
    """
    column = lines.columns[0]
    rows = numbered(lines, [column]).withColumn("chunk", F.floor(F.col("row_no") / max_lines))
    (
        rows.repartition("chunk").sortWithinPartitions("chunk", "row_no").select(column, "chunk")
        .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("chunk").text(path)
    )


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").csv(path)
