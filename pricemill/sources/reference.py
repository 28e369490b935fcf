"""Dimensions, price lists and other reference loads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pricemill.functions.numbers import PRICE
from pricemill.functions.periods import in_range
from pricemill.functions.tables import update_join
from pricemill.operators.buys import flag

# Fixed values -------------------------------------------------------------------------------------
OUTLET_OFFSET = 1_000_000
ACTIVITY_CLASS = {
    "PHARMACY": ("FN", "A2", "FA", "FW", "J"),
    "MANUFACTURER": ("T",),
    "WHOLESALER": ("B6", "B7"),
}
IN_SCOPE = ("FN", "A2", "T", "FA", "FW", "B6", "B7", "J")
EXCLUDED_PROVIDERS = (260, 261, 1261)
DELIVERY_TYPE = "41"


def sales_units(
    raw_sales: DataFrame, outlet_view: DataFrame, id_merge: DataFrame, *, period_from: str, period_to: str
) -> DataFrame:
    """Units sold by retail outlets per period, current product id, provider and outlet."""
    retail = outlet_view.filter(F.substring("outlet_type", -1, 1) == "1").select(
        (F.col("outlet_code") - OUTLET_OFFSET).cast("int").alias("outlet")
    )
    ids = id_merge.select(F.col("pcmdty_id_old").alias("fcc"), F.col("pcmdty_id_new").alias("_new"))
    return (
        raw_sales.filter(in_range(period_from, period_to, "period"))
        .join(retail, "outlet", "inner")
        .join(ids, "fcc", "inner")
        .groupBy(
            F.col("period").alias("period_cd"), F.col("_new").alias("fcc"),
            F.col("whs").alias("wholesaler_code"), F.col("outlet").alias("outlet_code"),
        )
        .agg(F.sum("units").alias("_units"))
        .filter(F.col("_units") > 0)
        .select("period_cd", "fcc", "wholesaler_code", "outlet_code", F.col("_units").cast("int").alias("sum_units"))
    )


def dim_outlet(outlet_view: DataFrame, *, id_offset: int = OUTLET_OFFSET) -> DataFrame:
    activity = F.col("outlet_fiscal_activity_code")
    activity_class: Column = F.lit("OUTROS")
    for name, codes in ACTIVITY_CLASS.items():
        activity_class = F.when(activity.isin(*codes), name).otherwise(activity_class)
    delivery = F.col("cnpj").startswith("BN") & (F.col("outlet_type") == DELIVERY_TYPE)
    return outlet_view.select(
        (F.col("outlet_code") - id_offset).cast("int").alias("outlet_code"),
        "outlet_type",
        F.col("cnpj").alias("cnpj_cd"),
        F.substring("cnpj", 1, 8).alias("cnpj_root_cd"),
        F.col("new_type_code").alias("outlet_new_type_code"),
        F.when(F.col("other4") == "I", 0).otherwise(1).alias("is_otlt_chain_ind"),
        activity.alias("fisc_actvty_cd"),
        flag(activity.isin(*IN_SCOPE)).alias("ppp_incl_calc_ind"),
        activity_class.alias("ppp_fisc_actvty_class_cd"),
        F.col("st_shrt_nm").alias("st_cd"),
        flag(delivery).alias("is_otlt_delivery_ind"),
    )


def states(outlet_view: DataFrame) -> DataFrame:
    return outlet_view.select(
        F.col("st_cd").alias("state_code"), F.col("st_nm").alias("state_desc"),
        F.col("st_shrt_nm").alias("state_abbrev"),
    ).distinct()


def dim_provider(
    provider_view: DataFrame, *, excluded_ids: tuple[int, ...] = EXCLUDED_PROVIDERS
) -> DataFrame:
    """Providers with their class; a blank first flag counts as missing."""
    first = F.col("flag1").isNotNull() & (F.col("flag1") != " ")
    pharmacy = first | (F.col("flag2") == "D") | (F.col("flag5") == "F")
    flags = [f"flag{i}" for i in range(1, 9)]
    return provider_view.filter(~F.col("wholesaler_code").isin(*excluded_ids)).select(
        "wholesaler_code", "wholesaler_CGC", "wholesaler_type", "distribution_center", *flags,
        F.when(pharmacy, "PHARMACY").when(F.col("flag4") == "W", "WHOLESALER").otherwise("N/C")
        .alias("ppp_dsupp_typ_cd"),
        flag(F.col("flag2") == "D").alias("is_whs_dlvry_ind"),
        "oac_nm",
    )


def tax_bridge(ncm_attr: DataFrame, products: DataFrame, federal: DataFrame) -> DataFrame:
    """Distinct (tax code, product) with the federal rates of the code."""
    return (
        ncm_attr.join(products.select("pcmdty_id", "nec4_cd", "nfc3_cd"), ["nec4_cd", "nfc3_cd"], "left")
        .join(federal, "ncm_cd", "left")
        .select("ncm_cd", "pcmdty_id", "ipi_pct", "pis_cofins_typ_cd", "pis_cofins_pct")
        .distinct()
    )


def dim_product(
    products: DataFrame,
    ext: DataFrame,
    bridge: DataFrame,
    ncm_file: DataFrame,
    pnn: DataFrame,
    ncm_attr: DataFrame,
    ncm_exc: DataFrame,
) -> DataFrame:
    """Product dimension: every lookup is reduced to its key before it is joined."""
    by_bridge = bridge.groupBy("pcmdty_id").agg(
        F.min("ncm_cd").alias("_bridge_ncm"), F.min("ipi_pct").alias("ipi_pct"),
        F.min("pis_cofins_typ_cd").alias("pis_cofins_typ_cd"),
        F.min("pis_cofins_pct").alias("pis_cofins_pct"),
    )
    by_file = ncm_file.select("pcmdty_id", F.col("ncm_cd").alias("_file_ncm")).distinct()
    by_pnn = pnn.groupBy("pcmdty_id").agg(F.max("pack_pnn_flag_cd").alias("_pnn"))
    exclusion = ncm_exc.groupBy("ncm_cd", "is_ncm_exclu_ind").agg(F.max("cst_cd").alias("_cst"))
    by_class = (
        ncm_attr.groupBy("nec4_cd", "nfc3_cd").agg(F.max("ncm_cd").alias("ncm_cd"))
        .join(exclusion, "ncm_cd", "inner")
        .select("nec4_cd", "nfc3_cd", "is_ncm_exclu_ind", "_cst")
    )
    attributes = ext.select(
        "pcmdty_id", F.col("pck_mkt_seg_class_3").alias("mseg3_cd"), "pck_medicine_ind",
        F.col("pck_gmrs_class_cd").alias("_gmrs"),
    )
    return (
        products.join(attributes, "pcmdty_id", "left")
        .join(by_bridge, "pcmdty_id", "left")
        .join(by_pnn, "pcmdty_id", "left")
        .join(by_class, ["nec4_cd", "nfc3_cd"], "left")
        .join(by_file, "pcmdty_id", "left")
        .select(
            "pcmdty_id", F.col("prod_brand_nm").alias("prod_desc"), F.col("pack_code").alias("pack_cd"),
            "prod_cd", F.col("lab_cd").alias("manuf_cd"), "atc4_cd", "atc3_cd", "atc2_cd", "atc1_cd",
            "nec4_cd", "nec3_cd", "nec2_cd", "nec1_cd", F.col("nfc1_cd").alias("app1_cd"),
            (F.col("std_unit") / F.lit(100.0)).alias("std_factor"), "mseg3_cd",
            flag(F.col("pck_medicine_ind") == "MEDICAMENTO").alias("pck_is_medcn_ind"),
            F.upper("_gmrs").alias("pck_gmrs_class_cd"),
            F.coalesce("_bridge_ncm", "_file_ncm").alias("ncm_cd"),
            "ipi_pct", "pis_cofins_typ_cd", "pis_cofins_pct",
            F.upper("_pnn").alias("pack_pnn_flag_cd"), F.col("mkt_seg_cd").alias("otc_seg_cd"),
            F.coalesce("_cst", F.lit(0)).alias("cst_cd"),
            flag(F.col("is_ncm_exclu_ind") == "NOMEDICAMENTO").alias("is_ncm_exclu_ind"),
        )
    )


def price_list(feed: DataFrame, price_type: str, *, from_date: str = "20190101") -> DataFrame:
    """One list of the price feed (D, M or L): cents to money, date to month."""
    return feed.filter((F.col("price_type") == price_type) & (F.col("price_date") >= from_date)).select(
        (F.col("price").cast("decimal(16,0)") * F.expr("0.01BD")).cast(PRICE).alias("prc_amt"),
        F.col("fcc").alias("pcmdty_id"),
        F.substring("price_date", 1, 6).alias("period_cd"),
    )


def rekeyed_ids(id_merge: DataFrame, products: DataFrame, national: DataFrame, *, period: str) -> DataFrame:
    """(old, new) ids where the old one is retired and the new one's only price is this month's real one."""
    only = (
        national.groupBy("pcmdty_id")
        .agg(
            F.count(F.lit(1)).alias("cnt"),
            F.max(flag((F.col("step_cd") == 1) & (F.col("period_cd") == period))).alias("_real"),
        )
        .filter((F.col("cnt") == 1) & (F.col("_real") == 1))
        .select(F.col("pcmdty_id").alias("pcmdty_id_new"))
    )
    known = products.select(F.col("pcmdty_id").alias("pcmdty_id_old")).distinct()
    return (
        id_merge.filter(F.col("pcmdty_id_old") != F.col("pcmdty_id_new"))
        .select("pcmdty_id_old", "pcmdty_id_new")
        .join(known, "pcmdty_id_old", "left_anti")
        .join(only, "pcmdty_id_new", "left_semi")
        .select("pcmdty_id_old", "pcmdty_id_new")
    )


def rekey_products(
    id_merge: DataFrame, products: DataFrame, national: DataFrame, geo: DataFrame, *, period: str
) -> tuple[DataFrame, DataFrame]:
    """National and sub-national prices with retired product ids replaced."""
    ids = rekeyed_ids(id_merge, products, national, period=period)

    def rekey(table: DataFrame) -> DataFrame:
        pairs = ids.select(F.col("pcmdty_id_old").alias("_old"), F.col("pcmdty_id_new").alias("_id"))
        keyed = table.withColumn("_old", F.col("pcmdty_id"))
        renamed = pairs.select("_old", F.col("_id").alias("pcmdty_id"))
        return update_join(keyed, renamed, ["_old"], ["pcmdty_id"]).select(*table.columns)

    return rekey(national), rekey(geo)
