"""Rows to publish and fixed-width exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pricemill.functions.numbers import cents
from pricemill.functions.periods import in_range, months_ending, shift

# Fixed values -------------------------------------------------------------------------------------
SPECIAL_CLASS = "Z98A2"
EXCLUDED_MANUFACTURERS = ("4581", "4580")
REAL_STEPS = (1, 50, 51)
CHUNK_LINES = 29_500
PRICE_WIDTH = 8  # digits of the price in a line of the full export


def _month_start(period: str) -> Column:
    return F.to_timestamp(F.concat(F.col(period), F.lit("01")), "yyyyMMdd")


def publish_weekly(
    national: DataFrame, products: DataFrame, *, period_from: str, period_to: str, ahead: int = 2
) -> DataFrame:
    """Prices in cents; the last month is repeated for the following ``ahead`` months."""
    repeated = F.array(*[F.lit(shift(period_to, i)) for i in range(ahead + 1)])
    months = F.when(F.col("period_cd") == period_to, repeated).otherwise(F.array("period_cd"))
    regular = products.filter(F.col("atc4_cd") != SPECIAL_CLASS).select("pcmdty_id")
    return (
        national.filter(in_range(period_from, period_to))
        .join(regular, "pcmdty_id", "inner")
        .select(
            F.col("pcmdty_id").alias("fcc"), cents("ppp_prc_amt").alias("price"),
            F.lit("C").alias("price_type"), F.explode(months).alias("period"),
        )
        .withColumn("date", _month_start("period"))
        .distinct()
    )


def publish_monthly(
    national: DataFrame, products: DataFrame, *, period_to: str, months: int = 60
) -> DataFrame:
    """Prices of the month and the ``months`` before it; the special class is published as 'J'."""
    kind = F.when(F.col("atc4_cd") == SPECIAL_CLASS, "J").otherwise("C")
    return (
        national.filter(in_range(shift(period_to, -months), period_to))
        .join(products.select("pcmdty_id", "atc4_cd"), "pcmdty_id", "inner")
        .select(
            F.col("pcmdty_id").alias("fcc"), cents("ppp_prc_amt").alias("price"),
            kind.alias("price_type"), F.col("period_cd").alias("period"),
            _month_start("period_cd").alias("date"),
        )
        .distinct()
    )


def publish_sub_national(geo: DataFrame, *, period_to: str, months: int = 60) -> DataFrame:
    """Sub-national prices in cents of the last ``months`` months."""
    return geo.filter(in_range(shift(period_to, 1 - months), period_to)).select(
        F.col("pcmdty_id").alias("fcc"), "geo_lvl_cd", cents("ppp_prc_amt").alias("price"), "step_cd",
        F.lit("C").alias("price_type"), F.col("period_cd").alias("period"),
    )


def zero_padded(value: Column, width: int) -> Column:
    """Left-padded with zeros; a longer value is kept whole."""
    text = value.cast("string")
    return F.concat(F.repeat(F.lit("0"), F.greatest(F.lit(width) - F.length(text), F.lit(0))), text)


def overlong_values(prices: DataFrame, *, width: int) -> DataFrame:
    """Prices whose cents do not fit the field, which would shift the rest of the line."""
    return prices.filter(F.length(cents("ppp_prc_amt").cast("string")) > width)


def _exported(
    national: DataFrame, products: DataFrame, packs: DataFrame, *, periods: list[str], any_case: bool
) -> DataFrame:
    class_code = F.lower("atc4_cd") if any_case else F.col("atc4_cd")
    special = SPECIAL_CLASS.lower() if any_case else SPECIAL_CLASS
    product = products.filter(
        (class_code != special) & ~F.col("manuf_cd").isin(*EXCLUDED_MANUFACTURERS)
    ).join(packs.select("pack_cd").distinct(), "pack_cd", "left_semi")
    return (
        national.filter(F.col("period_cd").isin(*periods) & (F.col("ppp_prc_amt") != 0))
        .join(product.select("pcmdty_id", "pack_cd"), "pcmdty_id", "inner")
        .select("pack_cd", cents("ppp_prc_amt").alias("cents"), "period_cd")
    )


def _blanks(n: int) -> Column:
    return F.lit(" " * n)


def fixed_width_full(
    national: DataFrame, products: DataFrame, packs: DataFrame, *, period: str
) -> DataFrame:
    """One 80-character line per pack for the month."""
    line = F.concat(
        zero_padded(F.col("pack_cd"), 7), _blanks(1), F.lit("Z1L"), _blanks(51),
        zero_padded(F.col("cents"), PRICE_WIDTH), _blanks(6), F.lit("BR"), _blanks(2),
    )
    rows = _exported(national, products, packs, periods=[period], any_case=True)
    return rows.select(line.alias("z1l")).distinct().filter(F.col("z1l").isNotNull())


def fixed_width_history(
    national: DataFrame, products: DataFrame, packs: DataFrame, *, period: str, months: int = 60
) -> DataFrame:
    """One card per pack, price and month of the last ``months`` months."""
    month = F.substring("period_cd", 5, 2)
    year = F.substring("period_cd", 3, 2)
    card = F.concat(
        F.lit("PIMS0000"), zero_padded(F.col("pack_cd"), 7), _blanks(1), month, year, month, year,
        _blanks(2), zero_padded(F.col("cents"), 11), _blanks(39), F.lit("BR"), _blanks(2),
    )
    rows = _exported(
        national, products, packs, periods=months_ending(period, months), any_case=False
    )
    return rows.select(card.alias("pcards")).distinct().filter(F.col("pcards").isNotNull())


def publish_legacy(national: DataFrame, product_view: DataFrame, *, period: str) -> DataFrame:
    """Products of the month, labelled by whether their price is real or derived."""
    label = F.when(F.col("step_cd").isin(*REAL_STEPS), "REAL").otherwise("STEP")
    regular = product_view.filter(F.col("atc4_cd") != SPECIAL_CLASS).select(
        "pcmdty_id", "stdiz_pcmdty_nm"
    )
    return (
        national.filter(F.col("period_cd") == period)
        .join(regular, "pcmdty_id", "inner")
        .select(
            F.col("period_cd").alias("Periodo"), F.col("pcmdty_id").alias("FCC"),
            F.col("stdiz_pcmdty_nm").alias("Des_Longa"), label.alias("Instancia"),
        )
    )
