"""Carry-forward, back-filling and rewriting of price histories.

Windows here run over the months of one product: at most one row per month.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pricemill.functions.bounded import times_all
from pricemill.functions.numbers import dbl, price, price_from_double
from pricemill.functions.periods import (
    in_range,
    month_number,
    month_text,
    months_ending,
    shift,
    with_months,
)
from pricemill.functions.tables import delete_join, update_join
from pricemill.operators.buys import flag

CARRIED_STEPS = (1, 2, 50, 51)
ESTIMATE_STEP = 100


def carry_forward(
    national: DataFrame,
    *,
    period_from: str,
    period_to: str,
    steps: tuple[int, ...] = CARRIED_STEPS,
) -> DataFrame:
    """Rows (step 2) for months without a price that follow a priced month.

    Every row with a carried step fills the gap up to the product's next row, so the month-by-month
    loop becomes one window over the product's rows.  A null price counts as missing.
    """
    first = shift(period_from, -1)
    stale = in_range(period_from, period_to) & (F.col("step_cd") == 2)
    rows = national.filter(
        in_range(first, period_to) & ~stale & F.col("ppp_prc_amt").isNotNull()
    ).select("pcmdty_id", "ppp_prc_amt", "step_cd", month_number("period_cd").alias("_month"))
    last = F.lit(int(period_to[:4]) * 12 + int(period_to[4:6]) - 1)
    following = F.lead("_month").over(Window.partitionBy("pcmdty_id").orderBy("_month"))
    gaps = (
        rows.withColumn("_until", F.coalesce(following - 1, last))
        .filter(F.col("step_cd").isin(*steps) & (F.col("_until") > F.col("_month")))
        .select(
            "pcmdty_id", "ppp_prc_amt",
            F.explode(F.sequence(F.col("_month") + 1, F.col("_until"))).alias("_month"),
        )
    )
    return gaps.select(
        "pcmdty_id", "ppp_prc_amt", F.lit(2).alias("step_cd"), month_text(F.col("_month")).alias("period_cd")
    )


def clear_carried(table: DataFrame, *, period_from: str, period_to: str) -> DataFrame:
    """Drop earlier carry-forward rows of the range before a rerun."""
    return table.filter(~(in_range(period_from, period_to) & (F.col("step_cd") == 2)))


def backfill_first_real(national: DataFrame, *, period: str, months: int = 60) -> DataFrame:
    """Products whose only price is this month's real one: the price for all earlier months (step 53)."""
    only = (
        national.groupBy("pcmdty_id")
        .agg(
            F.count(F.lit(1)).alias("_n"), F.max("ppp_prc_amt").alias("ppp_prc_amt"),
            F.max(flag((F.col("period_cd") == period) & (F.col("step_cd") == 1))).alias("_real"),
        )
        .filter((F.col("_n") == 1) & (F.col("_real") == 1))
    )
    return _copies(only, period, months, 53)


def backfill_estimates(national: DataFrame, *, period: str, months: int = 60) -> DataFrame:
    """Estimated products without any earlier price: the estimate for all earlier months (step 54)."""
    current = (
        national.filter((F.col("period_cd") == period) & (F.col("step_cd") >= ESTIMATE_STEP))
        .select("pcmdty_id", "ppp_prc_amt")
        .distinct()
    )
    earlier = national.filter(F.col("period_cd") < period).select("pcmdty_id").distinct()
    return _copies(current.join(earlier, "pcmdty_id", "left_anti"), period, months, 54)


def _copies(prices: DataFrame, period: str, months: int, step: int) -> DataFrame:
    earlier = months_ending(period, months)[:-1]
    return with_months(prices.select("pcmdty_id", "ppp_prc_amt"), earlier).select(
        "pcmdty_id", "ppp_prc_amt", F.lit(step).alias("step_cd"), "period_cd"
    )


def backfill_geo(copies: DataFrame, geo: DataFrame, *, latest_product_only: bool = False) -> DataFrame:
    """The copied prices for every geo that occurs among the copied products.

    ``latest_product_only`` takes the geos of the largest product id, as for estimates.
    """
    ids = copies.select("pcmdty_id").distinct()
    if latest_product_only:
        ids = ids.agg(F.max("pcmdty_id").alias("pcmdty_id"))
    geos = geo.join(ids, "pcmdty_id", "left_semi").select("geo_lvl_cd")
    return times_all(copies, geos, "geo_lvl_cd").select(
        "pcmdty_id", "geo_lvl_cd", "ppp_prc_amt", F.lit(0).cast("decimal(22,0)").alias("wgt_units_qty"),
        "step_cd", F.lit(0).cast("decimal(22,0)").alias("sales_units_qty"), "period_cd",
    )


def current_real_prices(
    national: DataFrame, geo: DataFrame, list_l: DataFrame, *, period: str
) -> DataFrame:
    """Products with a real price and units this month, with their L price."""
    sold = geo.filter((F.col("period_cd") == period) & (F.col("wgt_units_qty") > 0))
    lists = list_l.filter(F.col("period_cd") == period).select(
        "pcmdty_id", price("prc_amt").alias("cur_l_prc")
    )
    return (
        national.filter((F.col("period_cd") == period) & (F.col("step_cd") == 1))
        .join(sold.select("pcmdty_id"), "pcmdty_id", "left_semi")
        .join(lists, "pcmdty_id", "left")
        .select("pcmdty_id", F.col("ppp_prc_amt").alias("cur_prc"), "cur_l_prc")
        .distinct()
    )


def last_real_month(
    geo: DataFrame, current: DataFrame, *, period: str, min_period: str
) -> DataFrame:
    """Latest earlier month with real units or a manual price, and the units of all such months."""
    real = (F.col("step_cd").isin(1, 2, 51) & (F.col("wgt_units_qty") > 0)) | (F.col("step_cd") == 50)
    return (
        geo.filter(in_range(min_period, shift(period, -1)) & real)
        .join(current.select("pcmdty_id"), "pcmdty_id", "left_semi")
        .groupBy("pcmdty_id")
        .agg(F.max("period_cd").alias("last_period"), F.sum("wgt_units_qty").alias("wgt_units_qty"))
    )


def history_changes(
    national: DataFrame, last_real: DataFrame, *, period: str, max_change: float
) -> DataFrame:
    """Months after the last real one with their change; ``big_change`` marks jumps.

    The first month has no predecessor inside the window and counts as unchanged.
    """
    previous = F.lag("ppp_prc_amt").over(Window.partitionBy("pcmdty_id").orderBy("period_cd"))
    # Compared on exact decimals: |p - prev| > limit * |prev|.
    jump = (F.col("prev_price") != 0) & (
        F.abs(F.col("ppp_prc_amt") - F.col("prev_price"))
        > F.abs("prev_price") * F.lit(max_change).cast("decimal(9,4)")
    )
    return (
        national.join(last_real, "pcmdty_id", "inner")
        .filter((F.col("period_cd") > F.col("last_period")) & (F.col("period_cd") <= shift(period, -1)))
        .withColumn("prev_price", previous)
        .select(
            "pcmdty_id", "period_cd", "step_cd", "ppp_prc_amt", "prev_price", "wgt_units_qty",
            flag(jump).alias("big_change"),
        )
    )


def _new_prices(
    national: DataFrame, geo: DataFrame, products: DataFrame, list_l: DataFrame, *, period: str, min_period: str, max_change: float
) -> DataFrame:
    """The months to rewrite with ``new_price``, which is null where none can be computed."""
    current = current_real_prices(national, geo, list_l, period=period)
    last_real = last_real_month(geo, current, period=period, min_period=min_period)
    months = history_changes(national, last_real, period=period, max_change=max_change)
    lists = list_l.select("pcmdty_id", "period_cd", price("prc_amt").alias("l_prc"))
    distance = F.when(
        F.col("cur_l_prc").isNotNull(),
        (F.try_divide(dbl("cur_prc"), dbl("cur_l_prc")) - 1) * F.lit(100.0),
    ).otherwise(F.lit(0.0))
    medicine = price_from_double(dbl("l_prc") + dbl("l_prc") * distance / F.lit(100.0))
    new_price = F.when(F.col("pck_is_medcn_ind") == 1, medicine).otherwise(F.col("cur_prc"))
    return (
        months.filter(F.col("big_change") == 0)
        .filter(F.col("period_cd") >= min_period)
        .join(current, "pcmdty_id", "inner")
        .join(products.select("pcmdty_id", "pck_is_medcn_ind"), "pcmdty_id", "inner")
        .join(lists, ["pcmdty_id", "period_cd"], "left")
        .select("pcmdty_id", "period_cd", "step_cd", "ppp_prc_amt", "cur_prc", new_price.alias("new_price"))
    )


def rewrite_history(
    national: DataFrame,
    geo: DataFrame,
    products: DataFrame,
    list_l: DataFrame,
    *,
    period: str,
    min_period: str,
    max_change: float = 0.15,
) -> DataFrame:
    """New prices (step 52) for the months from ``min_period`` on, between the last and the current real price.

    Others take the current price; medicines keep the current distance to their L price.  A medicine
    month without an L price has no computable price and is left as it is (``rewrite_skipped``).
    """
    found = _new_prices(national, geo, products, list_l, period=period, min_period=min_period, max_change=max_change)
    return found.filter(F.col("new_price").isNotNull()).select(
        "pcmdty_id", "period_cd", F.col("new_price").alias("ppp_prc_amt"), F.lit(52).alias("step_cd")
    )


def rewrite_skipped(
    national: DataFrame,
    geo: DataFrame,
    products: DataFrame,
    list_l: DataFrame,
    *,
    period: str,
    min_period: str,
    max_change: float = 0.15,
) -> DataFrame:
    """Months that ``rewrite_history`` leaves as they are, as no new price can be computed for them."""
    found = _new_prices(national, geo, products, list_l, period=period, min_period=min_period, max_change=max_change)
    return found.filter(F.col("new_price").isNull()).select(
        "pcmdty_id", "period_cd", "step_cd", "ppp_prc_amt", "cur_prc", F.lit(period).alias("prod_period_cd")
    )


def apply_rewrite(table: DataFrame, rewritten: DataFrame) -> DataFrame:
    """The national or sub-national table with the rewritten months."""
    return update_join(table, rewritten, ["pcmdty_id", "period_cd"], ["ppp_prc_amt", "step_cd"])


def rewrite_audit(
    national: DataFrame,
    geo: DataFrame,
    list_l: DataFrame,
    *,
    period: str,
    min_period: str,
    max_change: float = 0.15,
) -> DataFrame:
    """What was not rewritten: manual prices without units (type 1) and big changes (type 2)."""
    current = current_real_prices(national, geo, list_l, period=period)
    last_real = last_real_month(geo, current, period=period, min_period=min_period)
    months = history_changes(national, last_real, period=period, max_change=max_change)

    def log(kind: str, previous: Column) -> list[Column]:
        return [
            F.lit(kind).alias("step_typ_id"), F.col("pcmdty_id"), F.col("step_cd"),
            previous.alias("prev_price"), F.col("ppp_prc_amt"), F.col("wgt_units_qty"),
            F.lit(period).alias("prod_period_cd"), F.col("period_cd"),
        ]

    manual = (
        national.filter(F.col("step_cd") == 50)
        .join(
            last_real.select("pcmdty_id", F.col("last_period").alias("period_cd"), "wgt_units_qty"),
            ["pcmdty_id", "period_cd"], "inner",
        )
        .filter(F.col("wgt_units_qty") <= 0)
    )
    jumps = months.filter(F.col("big_change") == 1)
    return manual.select(*log("1", F.lit(None).cast("decimal(18,4)"))).unionByName(
        jumps.select(*log("2", F.col("prev_price")))
    )


# ---- the journal: what earlier months were before a run changed them ------------------------------------------------

PRODUCT_MONTH = ["pcmdty_id", "period_cd"]


def before_images(table: DataFrame, changed: DataFrame, *, name: str, run: str) -> DataFrame:
    """All rows that ``table`` has now for the changed (product, month) pairs, and a row that marks each pair.

    Columns: those of ``table``, ``existed`` (0 for the mark), ``table_nm`` and ``run_cd``.
    """
    pairs = changed.select(*PRODUCT_MONTH).distinct()
    rows = table.join(pairs, PRODUCT_MONTH, "left_semi").withColumn("existed", F.lit(1))
    marks = pairs.withColumn("existed", F.lit(0))
    return rows.unionByName(marks, allowMissingColumns=True).withColumns(
        {"table_nm": F.lit(name), "run_cd": F.lit(run)}
    )


def first_images(journal: DataFrame) -> DataFrame:
    """Of each (product, month), the images of the earliest run: what it was before any of the runs."""
    first = journal.groupBy(*PRODUCT_MONTH).agg(F.min("run_cd").alias("run_cd"))
    return journal.join(first, [*PRODUCT_MONTH, "run_cd"], "left_semi")


def undo(table: DataFrame, images: DataFrame) -> DataFrame:
    """The table as it was: pairs in ``images`` get their old rows back, and lose them where they had none."""
    kept = delete_join(table, images.filter("existed = 0"), PRODUCT_MONTH)
    return kept.unionByName(images.filter("existed = 1").select(*table.columns))
