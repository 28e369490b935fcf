"""Provider priority, list-price band and interquartile outliers of tax-adjusted prices."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from pricemill.functions.bounded import one_value
from pricemill.functions.numbers import PRICE, price
from pricemill.functions.periods import add_months, in_range, months_between_list, shift, with_months
from pricemill.functions.quantiles import group_quantiles
from pricemill.operators.buys import MIN_PRICE, flag
from pricemill.session import Keep, write_out

PRODUCT_MONTH = ["period_cd", "pcmdty_id"]
CHANNEL_MONTH = ["period_cd", "pcmdty_id", "buyer_is_otlt_chain_ind"]
LIMIT = "decimal(38,12)"
SHARE = "decimal(22,12)"  # leaves room for the products below

CLEAN = [
    "dsupp_proc_id", "trans_dt", "seller_otlt_cd", "buyer_otlt_cd", "buyer_is_otlt_chain_ind",
    "pcmdty_id", "ppp_prc_amt", "buyer_st_cd", "buyer_is_pharmy_ind", "pck_is_medcn_ind", "period_cd",
]


def provider_priority(tax_calc: DataFrame) -> DataFrame:
    """Per (buyer, product, day): lines of non-distributors if there are any, else all lines.

    Only distributor lines and the distinct keys of the others are shuffled; a day that holds a large
    share of the lines is combined before the shuffle on one side and split by AQE on the other.
    """
    keys = ["buyer_otlt_cd", "pcmdty_id", "trans_dt"]
    direct = tax_calc.filter(F.col("dsupp_is_distr_ind") == 0)
    relayed = tax_calc.filter(F.col("dsupp_is_distr_ind") == 1)
    covered = direct.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
    same_key = reduce(
        lambda a, b: a & b, [relayed[k].eqNullSafe(covered[f"_{k}"]) for k in keys]
    )
    return direct.unionByName(relayed.join(covered, same_key, "left_anti"))


def with_band(
    df: DataFrame,
    list_d: DataFrame,
    band: DataFrame,
    *,
    month_shift: int = -1,
    min_list: float = MIN_PRICE,
) -> DataFrame:
    """Lines with ``_in_band``: strictly inside (D * min %, D * max %) of an earlier month's D price, or without a usable one.

    The list is shifted instead of the lines.
    """
    lists = list_d.select(
        "pcmdty_id",
        add_months("period_cd", -month_shift).alias("period_cd"),
        price("prc_amt").alias("_list"),
    )
    joined = (
        df.join(lists, PRODUCT_MONTH, "left")
        .withColumn("_list", F.coalesce("_list", F.lit(0).cast(PRICE)))
        .withColumn("_min", one_value(band, "cpp_min_pct").cast("decimal(9,4)"))
        .withColumn("_max", one_value(band, "cpp_max_pct").cast("decimal(9,4)"))
    )
    percent = F.col("ppp_prc_amt") * 100
    inside = (percent > F.col("_list") * F.col("_min")) & (percent < F.col("_list") * F.col("_max"))
    return joined.select(*df.columns, ((F.col("_list") <= F.lit(min_list)) | inside).alias("_in_band"))


def price_band_filter(
    df: DataFrame,
    list_d: DataFrame,
    band: DataFrame,
    *,
    month_shift: int = -1,
    min_list: float = MIN_PRICE,
) -> DataFrame:
    """Keep lines strictly inside (D * min %, D * max %) of an earlier month's D price.

    Lines without a usable D price are kept.
    """
    banded = with_band(df, list_d, band, month_shift=month_shift, min_list=min_list)
    return banded.filter("_in_band").select(*df.columns)


def groups_with_min_rows(df: DataFrame, keys: list[str] = CHANNEL_MONTH, n: int = 5) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") >= n)


def standardise_price(df: DataFrame, keys: list[str] = PRODUCT_MONTH) -> DataFrame:
    """Price as a share of the largest price of the product and month."""
    top = df.groupBy(*keys).agg(F.max("ppp_prc_amt").alias("_max"))
    share = F.try_divide(F.col("ppp_prc_amt"), F.col("_max")).cast(SHARE)
    return df.join(top, keys, "inner").select(*df.columns, share.alias("stdzn_prc"))


def iqr_limits(df: DataFrame, *, min_rows: int = 5, k: float = 1.5) -> DataFrame:
    """Quartiles and limits of the standardised price per (period, product, channel).

    Dividing by the largest price of a product and month keeps the order of its prices, so the
    quartiles are taken on the stored decimals and only the quartiles are divided.
    """
    by_channel = group_quantiles(
        df, CHANNEL_MONTH, "ppp_prc_amt", [0.25, 0.75, 1.0], names=["_q1", "_q3", "_top"],
        count_name="n_rows",
    )
    # The two channels of a product and month.
    both = Window.partitionBy(*PRODUCT_MONTH)
    quartiles = by_channel.withColumn("max_prc", F.max("_top").over(both)).filter(
        (F.col("n_rows") >= min_rows) & (F.col("max_prc") > 0)
    )

    def share(name: str):
        return F.try_divide(F.col(name), F.col("max_prc")).cast(SHARE)

    spread = (F.col("p075_prc") - F.col("p025_prc")) * F.lit(k).cast("decimal(4,2)")
    return (
        quartiles.withColumn("p025_prc", share("_q1"))
        .withColumn("p075_prc", share("_q3"))
        .select(
            *CHANNEL_MONTH, "n_rows", "max_prc", "p025_prc", "p075_prc",
            (F.col("p025_prc") - spread).cast(LIMIT).alias("li"),
            (F.col("p075_prc") + spread).cast(LIMIT).alias("ls"),
        )
    )


def iqr_outliers(df: DataFrame, limits: DataFrame) -> DataFrame:
    """Lines outside their limits: both sides for non-medicines, the lower one for medicines."""
    share = F.try_divide(F.col("ppp_prc_amt"), F.col("max_prc")).cast(SHARE)
    joined = df.join(limits, CHANNEL_MONTH, "inner").withColumn("stdzn_prc", share)
    too_low = F.col("stdzn_prc") < F.col("li")
    too_high = (F.col("stdzn_prc") > F.col("ls")) & (F.col("pck_is_medcn_ind") == 0)
    return joined.filter(flag(too_low | too_high) == 1).select(*df.columns, "stdzn_prc", "li", "ls")


def remove_outliers(df: DataFrame, outliers: DataFrame) -> DataFrame:
    ids = outliers.select("buys_trans_line_id").distinct()
    return df.join(ids, "buys_trans_line_id", "left_anti").select(*CLEAN)


def replicate_period(df: DataFrame, *, source_period: str, target_periods: list[str]) -> DataFrame:
    """Rows of one month re-dated to each of several other months."""
    rows = df.filter(F.col("period_cd") == source_period).drop("period_cd")
    return with_months(rows, target_periods).select(*df.columns)


def replicate_next_period(clean: DataFrame, *, period: str, months: int = 3) -> DataFrame:
    """Replace a month and the ones before it by copies of the month after it."""
    first = shift(period, 1 - months)
    kept = clean.filter(~in_range(first, period))
    copies = replicate_period(
        clean, source_period=shift(period, 1), target_periods=months_between_list(first, period)
    )
    return kept.unionByName(copies)


def clean_transactions(
    tax_calc: DataFrame, list_d: DataFrame, band: DataFrame, *, keep: Keep = write_out
) -> DataFrame:
    """The whole filter from tax-adjusted lines to the lines that are averaged.

    The lines in band are read three times, so they are kept once.
    """
    in_band = keep(price_band_filter(provider_priority(tax_calc), list_d, band))
    return remove_outliers(in_band, iqr_outliers(in_band, iqr_limits(in_band)))
