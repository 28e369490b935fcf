"""Raw purchase lines that arrive as files, loaded month by month as the batch run loads them."""

from __future__ import annotations

import re
from collections import Counter
from urllib.parse import unquote

from pyspark.sql import DataFrame, functions as F

from pricemill.functions.tables import write_periods
from pricemill.operators.buys import normalise_buys
from pricemill.plans.monthly import PriceStore
from pricemill.session import shuffles_dropped

LANDED = "raw_lines"
BATCH = "batch_no"
FEW_FILES = 64  # landed files of a month


def land(store: PriceStore, lines: DataFrame, number: int) -> list[str]:
    """Write one batch of raw lines by month and batch number; the months in it.

    A batch that is processed again after a failure has the same number and the same files, and replaces what it had written.
    """
    with shuffles_dropped(store.spark):
        (
            lines.withColumn(BATCH, F.lit(number)).hint("rebalance", "period_dt").write.mode("overwrite").option("compression", "zstd")
            .option("partitionOverwriteMode", "dynamic").partitionBy("period_dt", BATCH).parquet(store.path(LANDED))
        )
    written = landed(store, lines).filter(F.col(BATCH) == number)
    return sorted(r[0] for r in written.select("period_dt").distinct().collect())


def landed(store: PriceStore, like: DataFrame) -> DataFrame:
    """All landed raw lines, with the number of the batch that brought them."""
    schema = like.limit(0).withColumn(BATCH, F.lit(0)).schema
    return store.spark.read.schema(schema).parquet(store.path(LANDED))


def load_months(store: PriceStore, like: DataFrame, months: list[str], provider_factors: DataFrame, *, batch_id: str) -> None:
    """Replace the normalised lines of the months by those of all their landed lines, early and late ones.

    Landed files hold one month each, so lines are dealt by month again only where a month has come in many files.
    """
    if months:
        all_raw = landed(store, like).drop(BATCH)
        files = Counter(unquote(found[1]) for file in all_raw.inputFiles() if (found := re.search("/period_dt=([^/]*)/", file)))
        raw = all_raw.filter(F.col("period_dt").isin(months))
        lines = normalise_buys(raw, provider_factors, period_from=months[0], period_to=months[-1], batch_id=batch_id)
        write_periods(lines, store.path("buys"), gathered=max(files[month] for month in months) <= FEW_FILES)


def load_arrived(
    store: PriceStore, arriving: DataFrame, provider_factors: DataFrame, *, batch_id: str, checkpoint: str
) -> list[str]:
    """Load all files that have arrived since the last call; the months that changed.

    ``arriving`` is a file stream with the columns of the raw lines.  Each batch lands first and then replaces its months
    as a whole.  The batch's number and files are fixed before it is processed (in ``checkpoint``), so a run that stops in
    the middle of a batch is repeated with the same result by the next call.
    """
    changed: set[str] = set()

    def load(lines: DataFrame, number: int) -> None:
        months = land(store, lines, number)
        load_months(store, lines, months, provider_factors, batch_id=batch_id)
        changed.update(months)

    query = (
        arriving.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return sorted(changed)
