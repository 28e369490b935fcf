"""Estimated prices for products without transactions: a hierarchy of group means."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pricemill.functions.bounded import times_geos
from pricemill.functions.numbers import MEAN, PRICE, mean, price
from pricemill.functions.periods import add_months, in_range, months_between_list, with_months
from pricemill.operators.buys import MIN_PRICE

# Step code -> product attributes that define the group, most specific first.
NON_MEDICINE_LEVELS = {
    102: ("manuf_cd", "prod_cd", "nec4_cd", "app1_cd"),
    103: ("manuf_cd", "prod_cd", "nec4_cd"),
    104: ("manuf_cd", "prod_cd", "nec3_cd", "app1_cd"),
    105: ("manuf_cd", "prod_cd", "nec3_cd"),
    106: ("manuf_cd", "prod_cd", "nec2_cd", "app1_cd"),
    107: ("manuf_cd", "prod_cd", "nec2_cd"),
    108: ("nec4_cd", "app1_cd"),
    109: ("nec4_cd",),
    110: ("nec3_cd", "app1_cd"),
    111: ("nec3_cd",),
    112: ("nec2_cd", "app1_cd"),
    113: ("nec2_cd",),
    114: ("nec1_cd", "app1_cd"),
    115: ("nec1_cd",),
    116: ("mseg3_cd",),
}
MEDICINE_LEVELS = {
    202: ("manuf_cd", "prod_cd", "atc4_cd", "app1_cd", "mseg3_cd"),
    203: ("manuf_cd", "prod_cd", "atc4_cd", "mseg3_cd"),
    204: ("manuf_cd", "prod_cd", "atc4_cd"),
    205: ("manuf_cd", "atc3_cd", "app1_cd", "mseg3_cd"),
    206: ("manuf_cd", "atc3_cd", "mseg3_cd"),
    207: ("atc4_cd", "app1_cd", "mseg3_cd"),
    208: ("atc4_cd", "mseg3_cd"),
    209: ("atc4_cd", "app1_cd"),
    210: ("atc3_cd", "app1_cd", "mseg3_cd"),
    211: ("atc3_cd", "mseg3_cd"),
    212: ("atc3_cd", "app1_cd"),
    213: ("atc4_cd",),
    214: ("app1_cd", "mseg3_cd"),
    215: ("mseg3_cd",),
    216: ("atc2_cd", "app1_cd"),
    217: ("atc3_cd",),
    218: ("atc2_cd",),
    219: ("mseg3_cd",),
}
LEVELS = {0: NON_MEDICINE_LEVELS, 1: MEDICINE_LEVELS}
MISSING_LIST_PRICE = "0.01"


def _at_every_level(df: DataFrame, levels: dict[int, dict[int, tuple[str, ...]]]) -> DataFrame:
    """One row per level of the row's medicine flag, keyed by (step_cd, level_key).

    A level with a null attribute never matches another product, so it is left out.
    """

    def entries(of_flag: dict[int, tuple[str, ...]]) -> Column:
        return F.array(
            *[
                F.struct(
                    F.lit(step).alias("step_cd"),
                    F.array(*[F.col(c).cast("string") for c in keys]).alias("level_key"),
                )
                for step, keys in of_flag.items()
            ]
        )

    by_flag = F.when(F.col("pck_is_medcn_ind") == 1, entries(levels[1])).when(
        F.col("pck_is_medcn_ind") == 0, entries(levels[0])
    )
    exploded = df.select("*", F.explode(by_flag).alias("_level"))
    return (
        exploded.select("*", "_level.step_cd", "_level.level_key")
        .drop("_level")
        .filter(~F.exists("level_key", lambda k: k.isNull()))
    )


def _attributes(products: DataFrame, levels: dict[int, dict[int, tuple[str, ...]]]) -> DataFrame:
    used = sorted({c for of_flag in levels.values() for keys in of_flag.values() for c in keys})
    return products.select("pcmdty_id", "pck_is_medcn_ind", *used)


def _prior_list(list_d: DataFrame, min_list: float) -> DataFrame:
    """D prices under the month that follows theirs."""
    return list_d.filter(F.col("prc_amt") > F.lit(min_list)).select(
        "pcmdty_id",
        add_months("period_cd", 1).alias("period_cd"),
        price("prc_amt").alias("d_prc"),
    )


def level_averages(
    national: DataFrame,
    products: DataFrame,
    list_l: DataFrame,
    list_d: DataFrame,
    *,
    period_from: str,
    period_to: str,
    levels: dict[int, dict[int, tuple[str, ...]]] = LEVELS,
    min_list: float = MIN_PRICE,
) -> DataFrame:
    """Mean price and mean ratio to the D and L price for all levels in one aggregation.

    Estimates never feed estimates (only steps below 100 count), so no level depends on another.
    """
    lists = list_l.select("pcmdty_id", "period_cd", price("prc_amt").alias("l_prc"))
    paid = F.col("ppp_prc_amt")
    rows = (
        national.filter(in_range(period_from, period_to) & (F.col("step_cd") < 100))
        .select("pcmdty_id", "period_cd", price("ppp_prc_amt").alias("ppp_prc_amt"))
        .join(_prior_list(list_d, min_list), ["pcmdty_id", "period_cd"], "inner")
        .join(lists, ["pcmdty_id", "period_cd"], "left")
        .join(_attributes(products, levels), "pcmdty_id", "inner")
        .withColumn(
            "c_ratio",
            F.when((paid <= F.col("d_prc")) & (paid != 0),
                   F.try_divide(paid, F.col("d_prc")).cast(MEAN)),
        )
        .withColumn(
            "l_ratio",
            F.try_divide(paid, F.coalesce("l_prc", F.lit(MISSING_LIST_PRICE).cast(PRICE))).cast(MEAN),
        )
    )
    return (
        _at_every_level(rows, levels)
        .groupBy("period_cd", "step_cd", "level_key")
        .agg(
            mean("ppp_prc_amt").alias("avg_prc"),
            F.avg("c_ratio").cast(PRICE).alias("c_disc_rt"),
            mean("l_ratio").alias("l_disc_rt"),
        )
    )


def uncovered(
    products: DataFrame, national: DataFrame, *, period_from: str, period_to: str
) -> DataFrame:
    """Products without a price in a month of the range that has prices."""
    priced = national.filter(in_range(period_from, period_to)).select("pcmdty_id", "period_cd")
    every = with_months(products.select("pcmdty_id"), months_between_list(period_from, period_to))
    every = every.join(priced.select("period_cd").distinct(), "period_cd", "left_semi")
    return every.join(priced, ["pcmdty_id", "period_cd"], "left_anti").select("pcmdty_id", "period_cd")


def estimate(
    averages: DataFrame,
    missing: DataFrame,
    products: DataFrame,
    list_l: DataFrame,
    list_d: DataFrame,
    *,
    levels: dict[int, dict[int, tuple[str, ...]]] = LEVELS,
    min_list: float = MIN_PRICE,
) -> DataFrame:
    """Price of every uncovered product from the lowest step whose group has prices.

    Medicines: mean L ratio times the product's L price, at most that L price.  Others: mean D ratio
    times last month's D price.  Without a list price the group's mean price.
    """
    candidates = _at_every_level(missing.join(_attributes(products, levels), "pcmdty_id"), levels)
    best = (
        candidates.join(averages, ["period_cd", "step_cd", "level_key"], "inner")
        .groupBy("pcmdty_id", "period_cd", "pck_is_medcn_ind")
        .agg(F.min(F.struct("step_cd", "avg_prc", "c_disc_rt", "l_disc_rt")).alias("_best"))
        .select("pcmdty_id", "period_cd", "pck_is_medcn_ind", "_best.*")
    )
    lists = list_l.filter(F.col("prc_amt") > F.lit(min_list)).select(
        "pcmdty_id", "period_cd", price("prc_amt").alias("l_prc")
    )
    by_ratio = (F.col("l_disc_rt") * F.col("l_prc")).cast(MEAN)
    by_l = (
        F.when(F.col("l_prc").isNull(), F.col("avg_prc"))
        .when(by_ratio > F.col("l_prc"), F.col("l_prc"))
        .otherwise(by_ratio)
    )
    by_d = F.when(F.col("d_prc").isNull(), F.col("avg_prc")).otherwise(
        (F.col("c_disc_rt") * F.col("d_prc")).cast(MEAN)
    )
    value = F.when(F.col("pck_is_medcn_ind") == 1, by_l).otherwise(F.coalesce(by_d, F.col("avg_prc")))
    return (
        best.join(lists, ["pcmdty_id", "period_cd"], "left")
        .join(_prior_list(list_d, min_list), ["pcmdty_id", "period_cd"], "left")
        .select("pcmdty_id", value.cast(PRICE).alias("ppp_prc_amt"), "step_cd", "period_cd")
    )


def clear_estimates(national: DataFrame, *, period_from: str, period_to: str) -> DataFrame:
    """Drop earlier estimates of the range, so that a rerun sees no stale levels."""
    return national.filter(~(in_range(period_from, period_to) & (F.col("step_cd") >= 100)))


def explode_to_geo(
    national: DataFrame, states: DataFrame, *, period_from: str, period_to: str, above_step: int = 100
) -> DataFrame:
    """Estimated national prices copied to every state and channel, with 0 units."""
    estimates = national.filter(in_range(period_from, period_to) & (F.col("step_cd") > above_step))
    return geo_rows(estimates, states)


def geo_rows(prices: DataFrame, states: DataFrame) -> DataFrame:
    """Sub-national rows without units for national prices."""
    return times_geos(prices, states).select(
        "pcmdty_id", "geo_lvl_cd", "ppp_prc_amt", F.lit(0).cast("decimal(22,0)").alias("wgt_units_qty"),
        "step_cd", F.lit(0).cast("decimal(22,0)").alias("sales_units_qty"), "period_cd",
    )
