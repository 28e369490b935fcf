"""Outlet prices, imputation of outlets without transactions, weighted geo and national prices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pricemill.functions.bounded import code_list, times
from pricemill.functions.numbers import MEAN, PRICE, UNITS, mean, ratio_or_zero
from pricemill.session import Keep, write_out

PRODUCT = ["period_cd", "pcmdty_id"]
STATE_CHANNEL = ["period_cd", "pcmdty_id", "st_cd", "is_otlt_chain_ind"]
TRANS = [
    "period_cd", "pcmdty_id", "buyer_otlt_cd", "buyer_st_cd", "buyer_is_otlt_chain_ind",
    "buyer_is_pharmy_ind", "ppp_prc_amt",
]


def zero() -> Column:
    return F.lit(0).cast(MEAN)


def _outlet_columns(outlets: DataFrame, code: str) -> DataFrame:
    return outlets.select(
        F.col("outlet_code").alias(code), "cnpj_cd", "cnpj_root_cd", "st_cd", "is_otlt_chain_ind",
        "ppp_fisc_actvty_class_cd",
    )


def missing_outlets(sales: DataFrame, trans: DataFrame, outlets: DataFrame) -> DataFrame:
    """(period, product, outlet) sold by an outlet that has no transaction at all in the month.

    Sold rows are dealt by outlet, once for all steps: an outlet brings the list of its months with transactions.
    """
    active = trans.groupBy(F.col("buyer_otlt_cd").alias("outlet_code")).agg(F.collect_set("period_cd").alias("_active"))
    sold = sales.select("period_cd", F.col("fcc").alias("pcmdty_id"), "outlet_code").repartition("outlet_code").distinct()
    return (
        sold.join(active, "outlet_code", "left")
        .filter(~F.coalesce(F.array_contains("_active", F.col("period_cd")), F.lit(False)))
        .drop("_active")
        .join(_outlet_columns(outlets, "outlet_code").drop("ppp_fisc_actvty_class_cd"), "outlet_code")
    )


def root_prices(trans: DataFrame, outlets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Mean of outlet means per (tax root, state), and the mean of those per tax root."""
    outlet = _outlet_columns(outlets, "buyer_otlt_cd").select(
        "buyer_otlt_cd", "cnpj_cd", "cnpj_root_cd", "st_cd"
    )
    # Dealt by root, the means of all three levels and their lists need no further exchange.
    by_outlet = (
        trans.select(*PRODUCT, "buyer_otlt_cd", "buyer_is_pharmy_ind", "ppp_prc_amt").join(outlet, "buyer_otlt_cd", "inner")
        .repartition(*PRODUCT, "cnpj_root_cd")
        .groupBy(*PRODUCT, "cnpj_cd", "cnpj_root_cd", "st_cd", "buyer_is_pharmy_ind")
        .agg(mean("ppp_prc_amt").alias("ppp_prc"))
    )
    by_state = by_outlet.groupBy(*PRODUCT, "cnpj_root_cd", "st_cd", "buyer_is_pharmy_ind").agg(mean("ppp_prc").alias("ppp_prc"))
    return by_state, root_price(by_state, "cnpj_root_cd")


def root_price(by_state: DataFrame, owner: str) -> DataFrame:
    return by_state.groupBy(*PRODUCT, owner, "buyer_is_pharmy_ind").agg(
        mean("ppp_prc").alias("ppp_prc")
    )


def provider_prices(
    trans: DataFrame, providers: DataFrame, outlets: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Mean price per (delivery provider, buyer state), and the mean of those per provider."""
    delivering = providers.filter(F.col("is_whs_dlvry_ind") == 1).select(
        F.col("wholesaler_code").alias("dsupp_proc_id")
    )
    outlet = outlets.select(F.col("outlet_code").alias("buyer_otlt_cd"), "st_cd")
    by_state = (
        trans.join(delivering, "dsupp_proc_id", "inner")
        .join(outlet, "buyer_otlt_cd", "inner")
        .groupBy(
            *PRODUCT, F.col("dsupp_proc_id").alias("wholesaler_code"), "st_cd", "buyer_is_pharmy_ind"
        )
        .agg(mean("ppp_prc_amt").alias("ppp_prc"))
    )
    return by_state, root_price(by_state, "wholesaler_code")


def delivery_outlets(
    sales: DataFrame, providers: DataFrame, outlets: DataFrame, *, prefix: str = "BN"
) -> DataFrame:
    """Sales of delivery outlets, recognised by their tax id prefix."""
    outlet = outlets.filter(F.col("cnpj_cd").startswith(prefix)).select(
        "outlet_code", "st_cd", "is_otlt_chain_ind"
    )
    return (
        sales.join(outlet, "outlet_code", "inner")
        .join(providers.select("wholesaler_code"), "wholesaler_code", "left_semi")
        .select(
            "period_cd", F.col("fcc").alias("pcmdty_id"), "wholesaler_code", "outlet_code", "st_cd",
            "is_otlt_chain_ind",
        )
    )


def impute_price(
    missing: DataFrame, by_state: DataFrame, overall: DataFrame, owner: str
) -> DataFrame:
    """Price of the owner (root or provider) in the state, else anywhere, else 0.

    Both prices of an owner are listed in one row (one entry per state and indicator), so that one join on the owner serves them.
    """
    keys = [*PRODUCT, owner]
    # Both tables are dealt by owner already: listed together, they keep that, which a full join would not.
    entry = F.struct("st_cd", F.col("buyer_is_pharmy_ind").alias("ind"), F.col("ppp_prc").alias("prc"))
    prices = by_state.select(*keys, F.lit(True).alias("_in_state"), entry.alias("_prc")).unionByName(
        overall.withColumn("st_cd", F.lit(None).cast(by_state.schema["st_cd"].dataType)).select(*keys, F.lit(False).alias("_in_state"), entry.alias("_prc"))
    )
    lists = prices.groupBy(*keys).agg(
        F.collect_list(F.when(F.col("_in_state"), F.col("_prc"))).alias("_near"),
        F.collect_list(F.when(~F.col("_in_state"), F.col("_prc"))).alias("_far"),
    )
    found = missing.join(lists, keys, "left").select(
        "period_cd", "pcmdty_id", "outlet_code", "st_cd", "is_otlt_chain_ind", "_far",
        F.explode_outer(F.filter("_near", lambda entry: entry["st_cd"] == F.col("st_cd"))).alias("_1"),
    )
    # The fallback is only looked up where the first price is missing.
    return (
        found.withColumn("_2", F.explode_outer(F.when(F.col("_1.prc").isNull(), F.col("_far"))))
        .select(
            "period_cd", "pcmdty_id", "outlet_code", "st_cd", "is_otlt_chain_ind",
            F.coalesce("_1.ind", "_2.ind").alias("buyer_is_pharmy_ind"),
            F.coalesce("_1.prc", "_2.prc", zero()).alias("ppp_prc_amt"),
        )
        .distinct()
    )


def all_transactions(imputed: DataFrame, delivery: DataFrame, trans: DataFrame) -> DataFrame:
    """Imputed, delivery and real prices; equal rows collapse, so a price counts once per outlet."""

    def derived(df: DataFrame) -> DataFrame:
        return df.filter(F.col("ppp_prc_amt") > 0).select(
            "period_cd", "pcmdty_id", F.col("outlet_code").alias("buyer_otlt_cd"),
            F.col("st_cd").alias("buyer_st_cd"),
            F.col("is_otlt_chain_ind").alias("buyer_is_otlt_chain_ind"), "buyer_is_pharmy_ind",
            F.col("ppp_prc_amt").cast(MEAN).alias("ppp_prc_amt"),
        )

    real = trans.select(*TRANS).withColumn("ppp_prc_amt", F.col("ppp_prc_amt").cast(MEAN))
    return derived(imputed).unionByName(derived(delivery)).unionByName(real).distinct()


def geo_grid(states: DataFrame, product_periods: DataFrame) -> DataFrame:
    """Every (product, period) for every state and channel flag."""
    pairs = product_periods.select("pcmdty_id", "period_cd").distinct()
    by_state = times(pairs, code_list(states, "state_abbrev"), "st_cd")
    return times(by_state, F.array(F.lit(0), F.lit(1)), "is_otlt_chain_ind")


def sold_units(sales: DataFrame, outlets: DataFrame) -> DataFrame:
    return (
        sales.filter(F.col("sum_units") > 0)
        .join(_outlet_columns(outlets, "outlet_code"), "outlet_code", "inner")
        .select(
            "period_cd", F.col("fcc").alias("pcmdty_id"), "outlet_code", "cnpj_root_cd", "st_cd",
            "is_otlt_chain_ind", F.col("sum_units").cast(UNITS).alias("units"),
        )
    )


def outlet_price_fallback(trans: DataFrame, sales: DataFrame, outlets: DataFrame, *, sold: DataFrame | None = None) -> DataFrame:
    """Price of every sold outlet: its own mean, else its root's in the state, else its root's, else 0.

    Sold outlets (``sold``, if `sold_units` was kept) and transactions learn their root and are then dealt once, by product, month and
    root, where all prices that they may take meet.  Windows hold the outlets of a root in one product and month.
    """
    outlet = outlets.select(F.col("outlet_code").alias("buyer_otlt_cd"), "cnpj_root_cd", "st_cd")
    paid = trans.select(
        *PRODUCT, "buyer_otlt_cd", "buyer_is_otlt_chain_ind", "buyer_st_cd", F.col("ppp_prc_amt").cast(MEAN).alias("_prc")
    ).join(outlet, "buyer_otlt_cd", "inner")
    rows = (sold_units(sales, outlets) if sold is None else sold).withColumn("_sold", F.lit(True)).unionByName(
        paid.withColumnsRenamed({"buyer_otlt_cd": "outlet_code", "buyer_is_otlt_chain_ind": "_chain", "buyer_st_cd": "_st"})
        .withColumn("_sold", F.lit(False)),
        allowMissingColumns=True,
    )

    def average(*keys: str) -> Column:
        over = Window.partitionBy(*PRODUCT, "cnpj_root_cd", *keys)
        return F.try_divide(F.sum("_prc").over(over), F.count("_prc").over(over).cast(UNITS)).cast(MEAN)

    # An outlet has a mean for each state and channel in which its transactions are; each is a row of its own.
    # Windows put nulls together, but a sold outlet without a month, product, root or state takes no price by it.
    own = F.collect_set(F.when(~F.col("_sold"), F.struct("_chain", "_st", F.col("_own").alias("prc"))))
    has_product = F.col("period_cd").isNotNull() & F.col("pcmdty_id").isNotNull()
    has_root = has_product & F.col("cnpj_root_cd").isNotNull()
    return (
        rows.repartition(*PRODUCT, "cnpj_root_cd")
        .withColumn("_own", average("outlet_code", "_sold", "_chain", "_st"))
        .withColumn("_outlet", F.when(has_product, own.over(Window.partitionBy(*PRODUCT, "cnpj_root_cd", "outlet_code"))))
        .withColumn("_root_prc", F.when(has_root, average()))
        .withColumn("_state_prc", F.when(has_root & F.col("st_cd").isNotNull(), average("st_cd")))
        .filter("_sold")
        .withColumn("_outlet", F.explode_outer("_outlet"))
        .select(
            *PRODUCT, "outlet_code", "cnpj_root_cd", "st_cd", "is_otlt_chain_ind", "units",
            F.coalesce("_outlet.prc", "_state_prc", "_root_prc", zero()).alias("prc_final"),
        )
    )


def weighted_channel_price(priced: DataFrame, grid: DataFrame, units: DataFrame) -> DataFrame:
    """Unit-weighted price per (product, state, channel) on the complete grid, with total units.

    Priced rows, grid cells and sold units are three kinds of contributions to one aggregation, in
    place of a union with the grid followed by a join with the totals.  ``units`` is `sold_units`.
    """
    nothing = F.lit(0).cast(UNITS)
    rows = priced.filter(F.col("prc_final") != 0).distinct()
    contributions = (
        rows.select(
            *STATE_CHANNEL, (F.col("prc_final") * F.col("units")).alias("_value"),
            F.col("units").alias("_units"), nothing.alias("_total"), F.lit(1).alias("_cell"),
        )
        .unionByName(
            grid.select(
                *STATE_CHANNEL, F.lit(0).cast("decimal(35,8)").alias("_value"), nothing.alias("_units"),
                nothing.alias("_total"), F.lit(1).alias("_cell"),
            )
        )
        .unionByName(
            units.select(
                *STATE_CHANNEL, F.lit(0).cast("decimal(35,8)").alias("_value"), nothing.alias("_units"),
                F.col("units").alias("_total"), F.lit(0).alias("_cell"),
            )
        )
    )
    summed = contributions.groupBy(*STATE_CHANNEL).agg(
        F.sum("_value").alias("_value"), F.sum("_units").alias("units"),
        F.sum("_total").alias("units_total"), F.max("_cell").alias("_cell"),
    )
    return summed.filter(F.col("_cell") == 1).select(
        *STATE_CHANNEL, "units", ratio_or_zero(F.col("_value"), F.col("units")).alias("prc_st_chnl"),
        "units_total", F.when(F.col("units") == 0, 0).otherwise(1).alias("units_ind"),
    )


def borrow_other_channel(df: DataFrame) -> DataFrame:
    """A channel without a price takes the price and indicator of the state's other channel.

    The window holds the two channels of one state.
    """
    pair = Window.partitionBy("period_cd", "pcmdty_id", "st_cd")
    priced = F.col("prc_st_chnl") != 0
    other = F.max(F.when(priced, F.struct("prc_st_chnl", "units_ind"))).over(pair)
    return (
        df.withColumn("_other", other)
        .withColumn(
            "units_ind",
            F.when((F.col("units_ind") == 0) & F.col("_other").isNotNull(), F.col("_other.units_ind"))
            .otherwise(F.col("units_ind")),
        )
        .withColumn(
            "prc_st_chnl",
            F.when(~priced & F.col("_other").isNotNull(), F.col("_other.prc_st_chnl"))
            .otherwise(F.col("prc_st_chnl")),
        )
        .drop("_other")
    )


def _national(df: DataFrame, price_column: str, name: str) -> DataFrame:
    weight = (F.col("units_ind") * F.col("units_total")).cast(UNITS)
    value = F.sum(F.col(price_column).cast(MEAN) * weight)
    return df.groupBy(*PRODUCT).agg(ratio_or_zero(value, F.sum(weight)).alias(name))


def national_weighted(df: DataFrame) -> DataFrame:
    """National price per product and month from the channel prices of states with units."""
    return _national(df, "prc_st_chnl", "prc_national")


def with_national(df: DataFrame) -> DataFrame:
    """The national price next to every channel price.

    A window over the states and channels of one product and month (a few dozen rows): no second
    reading of the channel prices and no join.
    """
    product = Window.partitionBy(*PRODUCT)
    weight = (F.col("units_ind") * F.col("units_total")).cast(UNITS)
    value = F.sum(F.col("prc_st_chnl").cast(MEAN) * weight).over(product)
    return df.withColumn("prc_national", ratio_or_zero(value, F.sum(weight).over(product)))


def fill_state_from_national(df: DataFrame) -> DataFrame:
    """States without a price take the national one; what is still 0 is dropped."""
    filled = F.when(F.col("prc_st_chnl") == 0, F.col("prc_national")).otherwise(F.col("prc_st_chnl"))
    channel = F.when(F.col("is_otlt_chain_ind") == 0, "I").otherwise("R")
    return df.select(
        *PRODUCT, F.concat("st_cd", channel).alias("geo_lvl_cd"), "units", "units_total", "units_ind",
        filled.alias("fnl_wgt_prc"),
    ).filter(F.col("fnl_wgt_prc") != 0)


def step1_geo(filled: DataFrame) -> DataFrame:
    """Rows of the sub-national price table."""
    return filled.select(
        "pcmdty_id", "geo_lvl_cd", F.col("fnl_wgt_prc").cast(PRICE).alias("ppp_prc_amt"),
        F.col("units").alias("wgt_units_qty"), F.lit(1).alias("step_cd"),
        F.col("units_total").alias("sales_units_qty"), "period_cd",
    )


def step1_national(filled: DataFrame) -> DataFrame:
    """Rows of the national price table."""
    return _national(filled, "fnl_wgt_prc", "_prc").select(
        "pcmdty_id", F.col("_prc").cast(PRICE).alias("ppp_prc_amt"), F.lit(1).alias("step_cd"),
        "period_cd",
    )


def channel_prices(
    clean: DataFrame, sales: DataFrame, outlets: DataFrame, providers: DataFrame, states: DataFrame,
    *, keep: Keep = write_out,
) -> DataFrame:
    """From clean transactions and sales to a price per product, state and channel."""
    by_state, overall = root_prices(clean, outlets)
    imputed = impute_price(missing_outlets(sales, clean, outlets), by_state, overall, "cnpj_root_cd")
    whs_state, whs = provider_prices(clean, providers, outlets)
    delivery = impute_price(
        delivery_outlets(sales, providers, outlets), whs_state, whs, "wholesaler_code"
    )
    trans = keep(all_transactions(imputed, delivery, clean))
    sold = write_out(sold_units(sales, outlets))
    priced = outlet_price_fallback(trans, sales, outlets, sold=sold)
    weighted = weighted_channel_price(priced, geo_grid(states, trans), sold)
    # All later steps work within one product and month: one shuffle serves them.
    return borrow_other_channel(weighted.repartition(*PRODUCT))


def step1_prices(
    clean: DataFrame, sales: DataFrame, outlets: DataFrame, providers: DataFrame, states: DataFrame,
    *, keep: Keep = write_out,
) -> DataFrame:
    """Weighted prices of all geos, ready for `step1_geo` and `step1_national`."""
    channels = channel_prices(clean, sales, outlets, providers, states, keep=keep)
    return fill_state_from_national(with_national(channels))
