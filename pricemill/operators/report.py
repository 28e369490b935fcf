"""Quality-control report: processing funnel, reference prices and price validation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from pricemill.functions.numbers import MEAN, PRICE, dbl, mean
from pricemill.functions.periods import in_range, months_between_list, months_ending, shift
from pricemill.functions.quantiles import group_quantiles
from pricemill.operators.buys import flag
from pricemill.operators.outliers import with_band

FUNNEL = ("layout", "bridged", "mapped", "tax", "dupp", "cpp", "out")
PRIORITY_REVENUE = 10_000


def qc_funnel(
    buys: DataFrame,
    filtered: DataFrame,
    tax_calc: DataFrame,
    clean: DataFrame,
    products: DataFrame,
    providers: DataFrame,
    list_d: DataFrame,
    band: DataFrame,
    *,
    period: str,
) -> DataFrame:
    """Lines per provider and medicine flag after every processing stage."""
    keys = ["dsupp_proc_id", "pck_is_medcn_ind"]

    def month(df: DataFrame) -> DataFrame:
        return df.filter(F.col("period_cd") == period)

    raw = month(buys).join(products.select("pcmdty_id", "pck_is_medcn_ind"), "pcmdty_id", "inner")
    # Raw lines give two stages in one pass; every stage is counted before it is combined.
    bridged = F.sum(flag(F.col("prod_brdg_stat_cd") == "Bridged-ok"))
    first = raw.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("layout"), F.when(bridged > 0, bridged).alias("bridged")
    )
    later = [
        month(filtered).groupBy(*keys).agg(F.count(F.lit(1)).alias("mapped")),
        _taxed_stages(month(tax_calc), list_d, band, keys),
        month(clean).groupBy(*keys).agg(F.count(F.lit(1)).alias("out")),
    ]
    counts = reduce(lambda a, b: a.join(b, keys, "left"), later, first)
    provider = providers.select(
        F.col("wholesaler_code").alias("dsupp_proc_id"), "ppp_dsupp_typ_cd", "oac_nm"
    )

    def change(after: str, before: str) -> Column:
        return F.try_divide(dbl(after), dbl(before)) - 1

    return counts.join(provider, "dsupp_proc_id", "left").select(
        "dsupp_proc_id", "ppp_dsupp_typ_cd", "oac_nm", "pck_is_medcn_ind", *FUNNEL,
        change("bridged", "layout").alias("diff1_bridge"),
        change("mapped", "bridged").alias("diff2_list_price"),
    )


def _taxed_stages(taxed: DataFrame, list_d: DataFrame, band: DataFrame, keys: list[str]) -> DataFrame:
    """Taxed lines, those left by the provider priority and those of them in band, from one reading of the lines.

    Lines are counted per purchase, provider and stage before they are shuffled.  The priority looks at these counts: a
    purchase (buyer, product, day) has at most two per provider, whatever its lines.
    """
    purchase = ["buyer_otlt_cd", "pcmdty_id", "trans_dt"]
    counted = (
        with_band(taxed, list_d, band).groupBy(*purchase, *keys, "dsupp_is_distr_ind")
        .agg(F.count(F.lit(1)).alias("_lines"), F.sum(flag(F.col("_in_band"))).alias("_banded"))
        .withColumn("_first", F.min("dsupp_is_distr_ind").over(Window.partitionBy(*purchase)))
    )
    ranked = F.col("dsupp_is_distr_ind") == F.col("_first")
    dupp, cpp = F.sum(F.when(ranked, F.col("_lines"))), F.sum(F.when(ranked, F.col("_banded")))
    return counted.groupBy(*keys).agg(
        F.sum("_lines").alias("tax"), dupp.alias("dupp"), F.when(cpp > 0, cpp).alias("cpp")
    )


def reference_price(clean: DataFrame, *, period: str) -> DataFrame:
    """Mean over providers of their median price, per product."""
    medians = group_quantiles(
        clean.filter(F.col("period_cd") == period),
        ["dsupp_proc_id", "pcmdty_id", "period_cd"], "ppp_prc_amt", [0.5], names=["median"],
        interpolate=True,
    )
    return medians.groupBy("pcmdty_id", "period_cd").agg(
        F.avg("median").cast("decimal(38,2)").alias("ref_price")
    )


def pivot_by_period(
    df: DataFrame, value: str, periods: list[str], *, aggregate=F.avg, keys: tuple[str, ...] = ("pcmdty_id",)
) -> DataFrame:
    """One column per month of a literal list, so that no extra job looks for the months."""
    return df.groupBy(*keys).pivot("period_cd", periods).agg(aggregate(value))


def previous_units(geo: DataFrame, *, period_to: str) -> DataFrame:
    return (
        geo.filter(F.col("period_cd") == shift(period_to, -1))
        .groupBy("pcmdty_id")
        .agg(F.sum("sales_units_qty").alias("total_prev_sales_units"))
    )


def price_pivot(national: DataFrame, *, period_to: str, months: int = 31) -> DataFrame:
    periods = months_ending(period_to, months)
    rows = national.filter(in_range(periods[0], period_to))
    return pivot_by_period(rows, "ppp_prc_amt", periods, aggregate=lambda c: F.round(F.avg(c), 4).cast(PRICE))


def list_price_pivot(list_l: DataFrame, *, period_to: str, months: int = 3) -> DataFrame:
    periods = months_ending(period_to, months)
    rows = list_l.filter(in_range(periods[0], period_to))
    return pivot_by_period(rows, "prc_amt", periods, aggregate=lambda c: F.round(F.avg(c), 4).cast(PRICE))


def discount_pivot(
    national: DataFrame, list_l: DataFrame, *, period_to: str, months: int = 3
) -> DataFrame:
    """Distance to the L price in percent, by month."""
    periods = months_ending(period_to, months)
    lists = list_l.filter(in_range(periods[0], period_to)).select("pcmdty_id", "period_cd", "prc_amt")
    distance = (F.try_divide(dbl("ppp_prc_amt"), dbl("prc_amt")) - 1) * F.lit(100.0)
    rows = (
        national.filter(in_range(periods[0], period_to))
        .join(lists, ["pcmdty_id", "period_cd"], "inner")
        .select("pcmdty_id", "period_cd", distance.alias("disc"))
    )
    return pivot_by_period(rows, "disc", periods, aggregate=lambda c: F.round(F.avg(c), 0))


def step_pivot(national: DataFrame, *, period_to: str, months: int = 3) -> DataFrame:
    """Step codes by month, for products with a price in the last ``months + 2`` months."""
    rows = national.filter(in_range(shift(period_to, -(months + 1)), period_to))
    return pivot_by_period(
        rows, "step_cd", months_ending(period_to, months), aggregate=lambda c: F.avg(c).cast("int")
    )


def price_changes(prices: DataFrame, *, period_to: str, distance: int, suffix: str) -> DataFrame:
    """Relative change of the last three months against ``distance`` months before, 0 if unknown."""

    def change(period: str) -> Column:
        ratio = F.try_divide(dbl(F.col(period)), dbl(F.col(shift(period, -distance))))
        return F.coalesce(ratio - 1, F.lit(0.0)).alias(f"{period}_{suffix}")

    return prices.select("pcmdty_id", *[change(p) for p in months_ending(period_to, 3)])


def mean_of_provider_means(clean: DataFrame, *, period_to: str) -> DataFrame:
    return (
        clean.filter(F.col("period_cd") == period_to)
        .groupBy("pcmdty_id", "period_cd", "dsupp_proc_id")
        .agg(mean("ppp_prc_amt").alias("mean_1"))
        .groupBy("pcmdty_id", "period_cd")
        .agg(F.round(F.avg("mean_1").cast(MEAN), 2).cast("decimal(22,2)").alias("media_ppp"))
    )


def current_products(
    national: DataFrame, geo: DataFrame, product_view: DataFrame, ext: DataFrame, *, period_to: str
) -> DataFrame:
    """Products priced this month with last month's units and revenue at the current price."""
    present = geo.filter(F.col("period_cd") == period_to).select("pcmdty_id")
    return (
        national.filter(F.col("period_cd") == period_to)
        .select("pcmdty_id", "ppp_prc_amt")
        .join(present, "pcmdty_id", "left_semi")
        .join(previous_units(geo, period_to=period_to), "pcmdty_id", "inner")
        .join(product_view, "pcmdty_id", "inner")
        .join(ext.select("pcmdty_id", F.col("pck_mkt_seg_class_3").alias("seg_mkt_3")), "pcmdty_id", "inner")
        .select(
            "pcmdty_id", F.col("pri_org_short_nm").alias("corp_cd"),
            F.col("pri_org_nm").alias("manufacturer"), F.col("stdiz_pcmdty_nm").alias("pack"),
            F.coalesce("gmrs_cd", F.lit("-")).alias("gmrs_cd"),
            F.concat("atc1_cd", F.lit(" - "), "atc1_nm").alias("ct1"), "seg_mkt_3",
            F.col("total_prev_sales_units").alias("prev_units"),
            (dbl("total_prev_sales_units") * dbl("ppp_prc_amt")).alias("revenue"),
        )
        .distinct()
    )


def qc_price_validation(
    national: DataFrame,
    geo: DataFrame,
    clean: DataFrame,
    list_l: DataFrame,
    product_view: DataFrame,
    ext: DataFrame,
    *,
    period_to: str,
    months: int = 31,
) -> DataFrame:
    """One wide row per product: price history, steps, discounts, changes, deviation, adjustments."""
    last3 = months_ending(period_to, 3)
    prices = price_pivot(national, period_to=period_to, months=months)
    history = months_ending(period_to, months)

    def named(df: DataFrame, periods: list[str], suffix: str) -> DataFrame:
        return df.select(
            "pcmdty_id",
            *[F.coalesce(dbl(F.col(p)), F.lit(0.0)).alias(f"{p}_{suffix}") for p in periods],
        )

    def renamed(df: DataFrame, suffix: str) -> DataFrame:
        return df.select(
            "pcmdty_id",
            *[F.round(F.col(f"{p}_{suffix}") * 100, 0).alias(f"{p}_{suffix}") for p in last3],
            *[F.col(f"{p}_{suffix}").alias(f"_{p}_{suffix}") for p in last3],
        )

    diff1 = price_changes(prices, period_to=period_to, distance=1, suffix="diff")
    diff2 = price_changes(prices, period_to=period_to, distance=2, suffix="diff_2")
    reference = reference_price(clean, period=period_to).select("pcmdty_id", "ref_price")
    media = mean_of_provider_means(clean, period_to=period_to).select("pcmdty_id", "media_ppp")
    parts = [
        named(prices, history, "PPP"),
        named(step_pivot(national, period_to=period_to), last3, "STEP"),
        named(list_price_pivot(list_l, period_to=period_to), last3, "PF"),
        named(discount_pivot(national, list_l, period_to=period_to), last3, "DESC"),
        renamed(diff1, "diff"),
        renamed(diff2, "diff_2"),
    ]
    wide = current_products(national, geo, product_view, ext, period_to=period_to)
    for part in parts:
        wide = wide.join(part, "pcmdty_id", "inner")
    wide = wide.join(reference, "pcmdty_id", "left")
    return suggest_adjustment(wide, period_to=period_to).join(media, "pcmdty_id", "left")


def suggest_adjustment(wide: DataFrame, *, period_to: str) -> DataFrame:
    """Deviation flags and suggested prices.

    Last month is adjusted if it jumped although it is in line with two months before; this month
    if it is out of line with both its history and the adjusted last month.
    """
    third, second, last = months_ending(period_to, 3)
    fourth = shift(period_to, -3)

    def ppp(p: str) -> Column:
        return F.col(f"{p}_PPP")

    def known(p: str) -> Column:
        """The price, null where the pivot had none (shown as 0)."""
        return F.when(ppp(p) != 0, ppp(p))

    ref = dbl("ref_price")

    def to_reference(p: str) -> Column:
        return F.round((F.try_divide(known(p), ref) - 1) * F.lit(100.0), 0)

    df = wide.withColumn("priority", flag(F.col("revenue") > PRIORITY_REVENUE))
    for p in (third, second, last):
        df = df.withColumn(f"diff_ref_{p}", to_reference(p))
    for p in (second, last):
        df = df.withColumn(f"prev20_{p}", flag(F.abs(F.col(f"_{p}_diff_2")) > 0.2)).withColumn(
            f"ref20_{p}", flag(F.abs(F.col(f"diff_ref_{p}")) > 0.2)
        )
    df = df.withColumn(f"month15_{second}", flag(F.abs(F.col(f"_{second}_diff")) > 0.15))
    jumped = (F.col(f"prev20_{second}") == 0) & (F.col(f"month15_{second}") == 1)
    df = df.withColumn(
        f"adjust_{second}",
        F.when(jumped, (ppp(fourth) + ppp(third) + ppp(last)) / F.lit(3.0)).otherwise(0.0),
    )
    df = df.withColumn(
        f"new_{second}",
        F.when(F.col(f"adjust_{second}") == 0, ppp(second)).otherwise(F.col(f"adjust_{second}")),
    )
    against_new = F.try_divide(ppp(last), F.col(f"new_{second}")) - 1
    df = df.withColumn("against_new15", flag(F.abs(against_new) > 0.15))
    out_of_line = (
        (F.col(f"prev20_{last}") == 1) & (F.col("against_new15") == 1) & (F.col(f"ref20_{last}") == 0)
    )
    df = df.withColumn(
        f"adjust_{last}_1",
        F.when(out_of_line, (ref + ppp(third) + ppp(second) + ppp(last)) / F.lit(4.0)).otherwise(0.0),
    )
    second_choice = (F.col("against_new15") == 1) & (F.col(f"adjust_{last}_1") == 0)
    df = df.withColumn(
        f"adjust_{last}_2",
        F.when(second_choice, (ppp(third) + ppp(last)) / F.lit(2.0)).otherwise(0.0),
    )
    return df.drop(*[c for c in df.columns if c.startswith("_")])


def listed_products_pivot(
    national: DataFrame, listed: DataFrame, value: str, *, period_from: str, period_to: str
) -> DataFrame:
    """Mean of a column by month for a list of products."""
    rows = national.filter(in_range(period_from, period_to)).join(
        listed.select("pcmdty_id").distinct(), "pcmdty_id", "left_semi"
    )
    return pivot_by_period(rows, value, months_between_list(period_from, period_to))


def distinct_periods(national: DataFrame) -> DataFrame:
    return national.select("period_cd").distinct()


def listed_products(products: DataFrame, listed: DataFrame) -> DataFrame:
    return products.join(listed.select("pcmdty_id").distinct(), "pcmdty_id", "left_semi")
