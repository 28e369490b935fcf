"""Purchase transactions: normalisation, counterparties, unit prices and cleaning."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from pricemill.functions.numbers import MEAN, PRICE, price
from pricemill.functions.periods import in_range, shift
from pricemill.session import write_out

MIN_PRICE = 0.05
UNKNOWN_PRODUCT = 999999  # ids outside (0, UNKNOWN_PRODUCT) are not bridged to a product

# The columns that identify a cleaned purchase.
FILTERED = [
    "is_buyer_chain_ind", "buyer_ppp_typ_cd", "seller_ppp_typ_cd", "trans_is_intra_st_ind",
    "seller_st_cd", "buyer_st_cd", "seller_is_manuf_ind", "buyer_is_pharmy_ind", "line_id",
    "dsupp_proc_id", "trans_dt", "icms_typ_cd", "pcmdty_id", "pur_prc_amt", "icms_tax_pct",
    "prc_disc_pct", "buyer_otlt_cd", "seller_otlt_cd", "dsupp_is_assc_ind", "pck_is_medcn_ind",
    "ppp_dsupp_typ_cd", "dsupp_is_distr_ind", "period_cd",
]


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or null."""
    return F.when(condition, 1).otherwise(0)


def net_price(amount: str = "pur_prc_amt", discount: str = "prc_disc_pct") -> Column:
    """Price after the percentage discount."""
    off = (price(amount) * F.col(discount).cast("decimal(9,4)") * F.expr("0.01BD")).cast(MEAN)
    return (price(amount) - off).cast(MEAN)


def normalise_buys(
    raw: DataFrame,
    provider_factors: DataFrame,
    *,
    period_from: str,
    period_to: str,
    batch_id: str,
) -> DataFrame:
    """Typed purchase lines; the provider's quantity factor overrides the one of the line."""
    factors = provider_factors.select(
        F.col("dsupp_proc_id").alias("_provider"),
        price("pcmdty_qty_mult_fct").alias("_factor"),
    )
    lines = raw.filter(in_range(period_from, period_to, "period_dt"))
    joined = lines.join(factors, lines["dsupp_proc_id"] == factors["_provider"], "left")

    def text(name: str, alias: str | None = None) -> Column:
        return F.col(name).cast("string").alias(alias or name)

    return joined.select(
        F.lower(F.col("line_id").cast("string")).alias("line_id"),
        F.col("dsupp_proc_id").cast("int").alias("dsupp_proc_id"),
        text("trans_dt"),
        text("store_cd"),
        text("origin_cnpj_fiscal_id", "orig_cnpj_fiscal_id"),
        text("icms_typ_cd"),
        text("invc_nbr"),
        text("origin_dsupp_prod_cd", "orig_dsupp_prod_cd"),
        F.col("pcmdty_id").cast("int").alias("pcmdty_id"),
        price("units_qty").alias("units_qty"),
        F.coalesce("_factor", price("pcmdty_qty_mult_fct")).alias("pcmdty_qty_mult_fct"),
        price("purchase_prc_amt").alias("pur_prc_amt"),
        price("icms_tax_pct").alias("icms_tax_pct"),
        price("icms_tax_amt").alias("icms_tax_amt"),
        price("price_discount_pct").alias("prc_disc_pct"),
        price("discount_amt").alias("disc_amt"),
        text("destination_cnpj_fiscal_id", "dest_cnpj_fiscal_id"),
        text("destination_dsupp_prod_cd", "dest_dsupp_prod_cd"),
        text("destination_dsupp_prod_ean_cd", "dest_dsupp_prod_ean_cd"),
        flag(F.col("SupplierType") == 2).alias("dsupp_is_assc_ind"),
        F.col("proc_eff_ts").cast("timestamp").alias("proc_eff_ts"),
        F.lit(batch_id).alias("btch_id"),
        text("bridge_type", "prod_brdg_stat_cd"),
        F.col("origin_whlslr_id").alias("orig_whlslr_id"),
        F.col("period_dt").alias("period_cd"),
    )


def is_bridged() -> Column:
    return (F.col("pcmdty_id") > 0) & (F.col("pcmdty_id") < UNKNOWN_PRODUCT)


FACTOR_KEY = ["orig_cnpj_fiscal_id", "pcmdty_id"]


def qty_factor_state(lines: DataFrame) -> DataFrame:
    """Per seller and product the latest month with its quantity factor (the largest on a tie)."""
    own = lines.filter((F.col("dsupp_is_assc_ind") == 0) & is_bridged())
    return own.groupBy(*FACTOR_KEY).agg(F.max(F.struct("period_cd", "pcmdty_qty_mult_fct")).alias("latest"))


def merge_qty_factors(state: DataFrame, lines: DataFrame) -> DataFrame:
    """The state after further lines: only those are read, whatever the history, and they may be late ones."""
    both = state.select(*FACTOR_KEY, "latest").unionByName(qty_factor_state(lines))
    return both.groupBy(*FACTOR_KEY).agg(F.max("latest").alias("latest"))


def qty_factors(state: DataFrame, dim_provider: DataFrame, provider_class: str = "PHARMACY") -> DataFrame:
    """The state's factors of selling providers of a class."""
    sellers = (
        dim_provider.filter(F.col("ppp_dsupp_typ_cd") == provider_class)
        .select("wholesaler_CGC").distinct()
    )
    return state.join(sellers, state["orig_cnpj_fiscal_id"] == sellers["wholesaler_CGC"], "inner").select(
        "wholesaler_CGC", "pcmdty_id", F.col("latest")["pcmdty_qty_mult_fct"].alias("pcmdty_qty_mult_fct")
    )


def latest_qty_factor(
    buys: DataFrame, dim_provider: DataFrame, provider_class: str = "PHARMACY"
) -> DataFrame:
    """Most recent quantity factor per selling provider and product (largest on a tie)."""
    return qty_factors(qty_factor_state(buys), dim_provider, provider_class)


def impute_missing_providers(raw: DataFrame, provider_list: DataFrame, *, period: str) -> DataFrame:
    """Lines for listed providers that delivered nothing this month: last month's, re-dated."""
    delivered = raw.filter(F.col("period_dt") == period).select("dsupp_proc_id").distinct()
    silent = provider_list.select("dsupp_proc_id").join(delivered, "dsupp_proc_id", "left_anti")
    previous = raw.filter(F.col("period_dt") == shift(period, -1))
    return (
        previous.join(silent, "dsupp_proc_id", "inner")
        .select(*raw.columns)
        .withColumn("src_sys_cd", F.lit("IMPUTE"))
        .withColumn("period_dt", F.lit(period))
    )


def _sides(outlets: DataFrame, providers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What is known of an outlet that buys, if it is in scope, and of one that sells."""
    buyer = outlets.filter(F.col("ppp_incl_calc_ind") == 1).select(
        F.col("outlet_code").alias("buyer_otlt_cd"),
        F.col("is_otlt_chain_ind").alias("is_buyer_chain_ind"),
        F.col("ppp_fisc_actvty_class_cd").alias("_buyer_class"),
        F.col("st_cd").alias("buyer_st_cd"),
        F.col("cnpj_cd").alias("_buyer_cnpj"),
    )
    seller = outlets.select(
        F.col("outlet_code").alias("seller_otlt_cd"),
        F.col("ppp_fisc_actvty_class_cd").alias("seller_ppp_typ_cd"),
        F.col("st_cd").alias("seller_st_cd"),
    )
    # Resolved on the dimension: the provider class that goes with the buyer's tax id.
    reporting = providers.filter(F.col("wholesaler_type") != 2).select(
        F.col("wholesaler_CGC").alias("_buyer_cnpj"), F.col("ppp_dsupp_typ_cd").alias("_reports_as")
    )
    return buyer.join(reporting, "_buyer_cnpj", "left").drop("_buyer_cnpj"), seller


SIDES = ("_as_buyer", "_as_seller")


def with_sides(outlets: DataFrame, providers: DataFrame) -> DataFrame:
    """Outlets with what `unit_price` asks of them as buyer and as seller, written once.

    `resolve_counterparties` then hands both on with the outlets, so that lines need not meet the outlets again.  They are
    arrays: an outlet that is listed twice counts twice, one out of scope has no buyers.
    """
    buyer, seller = _sides(outlets, providers)
    sides = [
        side.filter(F.col(code).isNotNull()).groupBy(F.col(code).alias("outlet_code"))
        .agg(F.collect_list(F.struct(*[c for c in side.columns if c != code])).alias(name))
        for side, code, name in ((buyer, "buyer_otlt_cd", SIDES[0]), (seller, "seller_otlt_cd", SIDES[1]))
    ]
    return write_out(outlets.select("cnpj_cd", "outlet_code").join(sides[0], "outlet_code", "left").join(sides[1], "outlet_code", "left"))


def resolve_counterparties(
    buys: DataFrame,
    products: DataFrame,
    providers: DataFrame,
    outlets: DataFrame,
    factors: DataFrame,
    *,
    period_from: str,
    period_to: str,
    pharmacy_class: str = "PHARMACY",
    distributor_class: str = "DISTRIBUTOR",
) -> DataFrame:
    """Buying and selling outlet of every line.

    Association lines: destination buys from origin.  Otherwise a pharmacy provider reports its own
    purchases and a distributor provider its own sales; the origin is the other side.
    The provider's own outlet is resolved on the dimension, before the lines are touched.  Lines are read twice, for those of
    associations and the others.  Of outlets that come from `with_sides`, the sides are handed on to `unit_price`.
    """
    sides = [c for c in SIDES if c in outlets.columns]

    def outlet(key: str, role: str) -> DataFrame:
        return outlets.select(
            F.col("cnpj_cd").alias(key), F.col("outlet_code").alias(f"{role}_outlet"), *[F.col(c).alias(role + c) for c in sides]
        )

    # Written, so that the lines know that it is small.
    provider = write_out(
        providers.join(outlet("wholesaler_CGC", "_own"), "wholesaler_CGC", "inner")
        .select(F.col("wholesaler_code").alias("dsupp_proc_id"), "ppp_dsupp_typ_cd", "_own_outlet", *[f"_own{c}" for c in sides])
    )
    seller_factor = factors.select(
        F.col("wholesaler_CGC").alias("orig_cnpj_fiscal_id"),
        "pcmdty_id",
        F.col("pcmdty_qty_mult_fct").alias("_seller_factor"),
    )
    lines = buys.filter(is_bridged() & in_range(period_from, period_to)).select(
        "line_id", "dsupp_proc_id", "trans_dt", "icms_typ_cd", "pcmdty_id", "pcmdty_qty_mult_fct", "pur_prc_amt", "icms_tax_pct",
        "prc_disc_pct", "dsupp_is_assc_ind", "period_cd", "orig_cnpj_fiscal_id", "dest_cnpj_fiscal_id",
    )
    # Only association lines ask for the seller's factor; the others are not dealt for it.
    with_factor = lines.filter("dsupp_is_assc_ind <=> 1").join(seller_factor, ["orig_cnpj_fiscal_id", "pcmdty_id"], "left")
    without = lines.filter("NOT dsupp_is_assc_ind <=> 1").withColumn(
        "_seller_factor", F.lit(None).cast(seller_factor.schema["_seller_factor"].dataType)
    )
    # The origin comes last of the joins that deal the lines: it brings the most.
    destination = outlet("dest_cnpj_fiscal_id", "_dest").drop("_dest_as_seller")
    joined = with_factor.unionByName(without).join(destination, "dest_cnpj_fiscal_id", "left").drop("dest_cnpj_fiscal_id")
    for c in ("_dest_outlet", "_dest_as_buyer"):
        if c in joined.columns:
            joined = joined.withColumn(c, F.when(F.col("dsupp_is_assc_ind") == 1, F.col(c)))
    joined = (
        joined.join(outlet("orig_cnpj_fiscal_id", "_origin"), "orig_cnpj_fiscal_id", "inner")
        .join(products.select("pcmdty_id", "pck_is_medcn_ind"), "pcmdty_id", "inner")
        .join(provider, "dsupp_proc_id", "inner")
    )
    associated = F.col("dsupp_is_assc_ind") == 1
    from_pharmacy = F.col("ppp_dsupp_typ_cd") == pharmacy_class
    from_distributor = F.col("ppp_dsupp_typ_cd") == distributor_class

    def bought(what: str) -> Column:
        return (
            F.when(associated, F.col(f"_dest{what}")).when(from_pharmacy, F.col(f"_own{what}")).otherwise(F.col(f"_origin{what}"))
        )

    def sold(what: str) -> Column:
        return F.when(~associated & from_distributor, F.col(f"_own{what}")).otherwise(F.col(f"_origin{what}"))

    def never_zero(name: str) -> Column:
        return F.when(F.col(name) == 0, F.lit(1).cast(PRICE)).otherwise(F.col(name))

    return joined.select(
        "line_id", "dsupp_proc_id", "trans_dt", "icms_typ_cd", "pcmdty_id",
        never_zero("pcmdty_qty_mult_fct").alias("pcmdty_qty_mult_fct"),
        never_zero("_seller_factor").alias("seller_qty_mult_fct"),
        "pur_prc_amt", "icms_tax_pct", "prc_disc_pct",
        bought("_outlet").alias("buyer_otlt_cd"), sold("_outlet").alias("seller_otlt_cd"),
        "dsupp_is_assc_ind", "pck_is_medcn_ind", "ppp_dsupp_typ_cd",
        F.when(from_pharmacy | associated, 0).otherwise(1).alias("dsupp_is_distr_ind"),
        "period_cd", *([bought(SIDES[0]).alias(SIDES[0]), sold(SIDES[1]).alias(SIDES[1])] if sides else []),
    )


def unit_price(resolved: DataFrame, outlets: DataFrame, providers: DataFrame) -> DataFrame:
    """Outlet attributes of both sides and the price per unit; only outlets in scope buy.

    Lines that bring the sides of their outlets (`with_sides`) do not meet the outlets again.
    """
    is_pharmacy_provider = (F.col("_buyer_class") != "PHARMACY") & (F.col("_reports_as") == "PHARMACY")
    use_seller_factor = (
        (F.col("dsupp_is_distr_ind") == 0)
        & (F.col("dsupp_is_assc_ind") == 0)
        & F.col("seller_qty_mult_fct").isNotNull()
    )
    factor = F.when(use_seller_factor, F.col("seller_qty_mult_fct")).otherwise(
        F.col("pcmdty_qty_mult_fct")
    )
    if set(SIDES) <= set(resolved.columns):
        lines = resolved.select("*", F.inline(SIDES[0])).select("*", F.inline(SIDES[1]))
    else:
        buyer, seller = _sides(outlets, providers)
        lines = resolved.join(buyer, "buyer_otlt_cd", "inner").join(seller, "seller_otlt_cd", "inner")
    return (
        lines.withColumn(
            "buyer_ppp_typ_cd",
            F.when(is_pharmacy_provider, "PHARMACY").otherwise(F.col("_buyer_class")),
        )
        .withColumn("trans_is_intra_st_ind", flag(F.col("buyer_st_cd") == F.col("seller_st_cd")))
        .withColumn("seller_is_manuf_ind", flag(F.col("seller_ppp_typ_cd") == "MANUFACTURER"))
        .withColumn("buyer_is_pharmy_ind", flag(F.col("_buyer_class") == "PHARMACY"))
        .withColumn("pur_prc_amt", F.try_divide("pur_prc_amt", factor).cast(PRICE))
        .select(*FILTERED)
    )


LINE_KEY = "_line"


def line_key() -> Column:
    """What lines are dealt by: their id, and the group of those that have none."""
    return F.coalesce("line_id", F.concat_ws("|", "pcmdty_id", "period_cd", "dsupp_proc_id"))


def drop_low_price_groups(
    df: DataFrame, *, threshold: float = MIN_PRICE, max_pct: float = 60.0, population: DataFrame | None = None, dealt: bool = False
) -> DataFrame:
    """Drop whole (product, period, provider) groups in which ``max_pct`` % of lines are near 0.

    ``population`` is the set of lines whose shares count, if ``df`` has only some of them.  With ``dealt``, lines are dealt by
    `LINE_KEY`, which is added, for a step that follows on it: only the columns of the groups are dealt by group.
    """
    keys = ["pcmdty_id", "period_cd", "dsupp_proc_id"]
    counted = df if population is None else population

    def share(over: Callable[[Column], Column] = lambda c: c) -> Column:
        low = over(F.sum(flag(F.col("pur_prc_amt") <= F.lit(threshold))))
        return F.round(low * F.lit(100.0) / over(F.count(F.lit(1))), 2)

    if not dealt:
        bad = counted.groupBy(*keys).agg(share().alias("_pct")).filter(F.col("_pct") >= max_pct).select(*keys)
        return df.join(bad, keys, "left_anti").select(*df.columns)
    # A group without one of its keys is never dropped.  The others hold the lines of a product, month and provider.
    narrow = counted.select(line_key().alias("_of"), *keys, "pur_prc_amt").dropna(subset=keys)
    group = Window.partitionBy(*keys)
    low = narrow.withColumn("_pct", share(lambda c: c.over(group))).filter(F.col("_pct") >= max_pct)
    by_line = low.groupBy("_of").agg(F.collect_set(F.struct(*keys)).alias("_low"))
    lines = df.withColumn(LINE_KEY, line_key())
    lines = lines.join(by_line, lines[LINE_KEY] == by_line["_of"], "left")
    its_group = F.exists("_low", lambda g: (g["pcmdty_id"] == F.col("pcmdty_id")) & (g["period_cd"] == F.col("period_cd")) & (g["dsupp_proc_id"] == F.col("dsupp_proc_id")))
    return lines.filter(~F.coalesce(its_group, F.lit(False))).select(*df.columns, LINE_KEY)


def drop_duplicate_lines(
    df: DataFrame, *, population: DataFrame | None = None, buyer_class: str = "WHOLESALER", dealt: bool = False
) -> DataFrame:
    """Where a line id occurs more than once, drop its rows bought by ``buyer_class``.

    ``population`` is the set in which ids are counted; the monthly plan counts before the low-price
    groups are dropped.  Only lines of the class are dealt by id, and ``df`` is read twice; with ``dealt``, all lines are
    dealt by id, or by `LINE_KEY` if they have it, in one reading, for a step that follows on it.
    """
    counted = df if population is None else population
    repeated = (
        counted.groupBy("line_id").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
        .select(F.col("line_id").alias("_id"))
    )
    of_class = F.col("buyer_ppp_typ_cd") == buyer_class
    if dealt:
        # a line without an id is no repetition, whatever its key
        key = df[LINE_KEY if LINE_KEY in df.columns else "line_id"]
        drop = (key == repeated["_id"]) & df["line_id"].isNotNull() & (df["buyer_ppp_typ_cd"] == buyer_class)
        return df.join(repeated, drop, "left_anti")
    checked = df.filter(of_class)
    checked = checked.join(repeated, checked["line_id"] == repeated["_id"], "left_anti")
    return df.filter(~F.coalesce(of_class, F.lit(False))).unionByName(checked)


def flag_list_price_outliers(
    df: DataFrame,
    list_l: DataFrame,
    products: DataFrame,
    bands: DataFrame,
    *,
    min_list: float = MIN_PRICE,
) -> DataFrame:
    """Add ``outlier_ind``: a medicine whose net price is above list price or outside the class band.

    Lines without a usable list price, and all non-medicines, get 0.
    """
    band = products.select("pcmdty_id", "pck_gmrs_class_cd").join(bands, "pck_gmrs_class_cd", "left")
    band = band.select(
        "pcmdty_id",
        F.coalesce("gmrs_max_pct", F.lit(0)).cast("decimal(9,4)").alias("_max"),
        F.coalesce("gmrs_min_pct", F.lit(0)).cast("decimal(9,4)").alias("_min"),
    )
    lists = list_l.select("pcmdty_id", "period_cd", price("prc_amt").alias("_list"))
    listed = F.coalesce("_list", F.lit(0).cast(PRICE))
    gap = F.abs(net_price() - listed) * 100
    outside = (net_price() > listed) | (gap > F.col("_max") * listed) | (gap < F.col("_min") * listed)
    is_outlier = (F.col("pck_is_medcn_ind") == 1) & (listed > F.lit(min_list)) & outside
    return (
        df.join(lists, ["pcmdty_id", "period_cd"], "left")
        .join(band, "pcmdty_id", "left")
        .select(*df.columns, flag(is_outlier).alias("outlier_ind"))
    )


def clean_buys(flagged: DataFrame) -> DataFrame:
    """Non-medicines and in-band medicines, each distinct row once.

    Both kinds come from the same frame, so one filter and one distinct replace the union.
    """
    kept = (F.col("pck_is_medcn_ind") == 0) | (
        (F.col("pck_is_medcn_ind") == 1) & (F.col("outlier_ind") == 0)
    )
    return flagged.filter(kept).drop("outlier_ind").distinct()


def min_price_filter(df: DataFrame, *, min_price: float = MIN_PRICE) -> DataFrame:
    return df.filter(F.col("pur_prc_amt") >= F.lit(min_price))


def filtered_buys(
    priced: DataFrame, list_l: DataFrame, products: DataFrame, bands: DataFrame
) -> DataFrame:
    """All cleaning steps from unit prices to the lines that enter the tax step.

    Flags depend on their row only, and groups and duplicate ids are counted in ``priced``: lines are dealt once, by line id, for
    all steps, after those that no flag lets pass are gone.  The distinct rows then need no further exchange.
    """
    flagged = min_price_filter(flag_list_price_outliers(priced, list_l, products, bands))
    kept = drop_low_price_groups(flagged, population=priced, dealt=True)
    return clean_buys(drop_duplicate_lines(kept, population=priced, dealt=True)).drop(LINE_KEY)
