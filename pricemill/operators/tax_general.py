"""Tax-adjusted price of non-medicines: product class lookups, rates, and two tax regimes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pricemill.functions.numbers import dbl, price, price_from_double
from pricemill.functions.periods import add_months, in_range
from pricemill.operators.buys import net_price
from pricemill.operators.tax_medicine import SOUTH_SOUTHEAST

# Fixed values -------------------------------------------------------------------------------------
CLASS_LEVELS = ("nec1_cd", "nec2_cd", "nec3_cd", "nec4_cd")  # least to most specific
NO_CODE = "Carga Média"
NO_EXEMPTION = "NAO"
SINGLE_PHASE = "Monofásico"
DOMESTIC_ORIGINS = (0, 4, 5, 6, 7)
# Reduction by (federal rate, operation rate) for single-phase products.
SINGLE_PHASE_REDUCTION = {
    0.125: {0.12: 0.1049, 0.07: 0.099, 0.04: 0.0959},
    0.12: {0.12: 0.099, 0.07: 0.0934, 0.04: 0.0904},
}


def most_specific_match(
    products: DataFrame,
    lookup: DataFrame,
    value: str,
    *,
    levels: tuple[str, ...] = CLASS_LEVELS,
    code: str = "ncm_cd",
    level_code: str = "nec_lvl_cd",
) -> DataFrame:
    """Lookup rows of the most specific class level at which a product has any match.

    All levels are tried in one join; the highest level found wins.
    """
    tried = products.select(
        "pcmdty_id", code,
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(i).alias("rank"), F.col(c).alias(level_code))
                    for i, c in enumerate(levels, 1)
                ]
            )
        ).alias("_level"),
    ).select("pcmdty_id", code, "_level.rank", f"_level.{level_code}")
    rows = lookup.select(code, level_code, value).distinct()
    matches = tried.join(rows, [code, level_code], "inner")
    best = matches.groupBy("pcmdty_id").agg(F.max("rank").alias("rank"))
    return matches.join(best, ["pcmdty_id", "rank"], "left_semi").select(
        "pcmdty_id", code, level_code, value
    )


def first_per_key(df: DataFrame, keys: list[str], order_by: list[Column]) -> DataFrame:
    """The first row per key; every other column breaks ties, so the choice is deterministic."""
    others = [c for c in df.columns if c not in keys]
    order = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order_by)], F.struct(*others))
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*others), order).alias("_row"))
    return best.select(*keys, "_row.*").select(*df.columns)


def first_icms_rate(icms: DataFrame) -> DataFrame:
    """First rate row per (state, tax code) by exception code."""
    return first_per_key(icms, ["state_cd", "ncm_cd"], [F.col("cest_cd")])


def first_federal_rate(federal: DataFrame) -> DataFrame:
    """Federal row with the highest rate per tax code."""
    return first_per_key(federal, ["ncm_cd"], [F.coalesce(-dbl("ipi_pct"), F.lit(float("inf")))])


def nonmed_base(
    buys: DataFrame,
    products: DataFrame,
    exemptions: DataFrame,
    *,
    period_from: str,
    period_to: str,
) -> DataFrame:
    """Non-medicine lines with product class, exemption code and net price."""
    exemption = exemptions.select("pcmdty_id", "tipi_excl_cd").distinct()
    product = products.select("pcmdty_id", "ncm_cd", "cst_cd").join(exemption, "pcmdty_id", "left")
    return (
        buys.filter((F.col("pck_is_medcn_ind") == 0) & in_range(period_from, period_to))
        .join(product, "pcmdty_id", "inner")
        .select(
            *buys.columns,
            F.coalesce("ncm_cd", F.lit(NO_CODE)).alias("ncm_cd"),
            F.coalesce("tipi_excl_cd", F.lit(NO_EXEMPTION)).alias("ex_na_tipi"),
            "cst_cd",
            net_price().alias("net_prc"),
        )
    )


def nonmed_rates(
    base: DataFrame, cest: DataFrame, icms: DataFrame, federal: DataFrame
) -> DataFrame:
    """State and federal rates of a line; the state row applies if its exception code is the line's."""
    product_cest = cest.select("pcmdty_id", F.col("cest_cd").alias("_product_cest")).distinct()
    state = first_icms_rate(icms).select(
        F.col("state_cd").alias("buyer_st_cd"), "ncm_cd", F.col("cest_cd").alias("_state_cest"),
        F.col("icms_typ_cd").alias("regime"), "icms_pct", "mva_ori_op_intra_st_pct",
        "mva_adj_op_inter_st_12_pct", "mva_adj_op_inter_st_7_pct", "mva_adj_op_inter_st_4_pct",
        "intr_red_pct", "mva_reductor_pct", F.lit(1).alias("_found"),
    )
    fed = first_federal_rate(federal).select(
        F.col("ncm_cd").alias("_fed_code"), "ipi_pct", "pis_cofins_typ_cd", "pis_cofins_pct"
    )
    state_cest = F.coalesce("_state_cest", F.lit("-"))
    found = F.col("_found") == 1
    wanted = F.coalesce("_product_cest", F.when(found, state_cest).otherwise("-"))
    code = F.when(
        F.col("ex_na_tipi") != NO_EXEMPTION, F.concat_ws(" - ", "ncm_cd", "ex_na_tipi")
    ).otherwise(F.col("ncm_cd"))
    joined = (
        base.join(product_cest, "pcmdty_id", "left")
        .join(state, ["buyer_st_cd", "ncm_cd"], "left")
        .withColumn("calc_cest", wanted)
        .withColumn("_applies", F.when(found & (state_cest == wanted), 1).otherwise(0))
        .withColumn("_code", code)
    )
    joined = joined.join(fed, joined["_code"] == fed["_fed_code"], "left")

    def applied(name: str) -> Column:
        return F.when(F.col("_applies") == 1, F.col(name))

    manufacturer = F.col("seller_is_manuf_ind") == 1
    return joined.select(
        *base.columns,
        "calc_cest",
        F.when(F.col("cst_cd").isin(*DOMESTIC_ORIGINS), 1).otherwise(0).alias("pck_is_natl_ind"),
        F.when(manufacturer, F.coalesce(dbl("ipi_pct"), F.lit(0.0))).otherwise(0.0).alias("ipi_rt"),
        "pis_cofins_typ_cd",
        F.when(manufacturer, dbl("pis_cofins_pct")).otherwise(0.0).alias("pis_rt"),
        applied("regime").alias("regime"),
        F.coalesce(dbl(applied("icms_pct")), F.lit(0.0)).alias("icms_rt"),
        *[
            dbl(applied(c)).alias(c)
            for c in (
                "mva_ori_op_intra_st_pct", "mva_adj_op_inter_st_12_pct", "mva_adj_op_inter_st_7_pct",
                "mva_adj_op_inter_st_4_pct", "intr_red_pct",
            )
        ],
        F.coalesce(dbl(applied("mva_reductor_pct")), F.lit(0.0)).alias("mva_reductor_pct"),
    )


def nonmed_op_rate(rated: DataFrame) -> DataFrame:
    """Operation rate: the state's own inside, 4 % imported, 7 % from the south-east, else 12 %."""
    from_south = F.col("seller_st_cd").isin(*SOUTH_SOUTHEAST) & ~F.col("buyer_st_cd").isin(
        *SOUTH_SOUTHEAST
    )
    rate = (
        F.when(F.col("trans_is_intra_st_ind") == 1, F.col("icms_rt"))
        .when(F.col("pck_is_natl_ind") == 0, 0.04)
        .when(from_south, 0.07)
        .otherwise(0.12)
    )
    return rated.withColumn("icms_ops", rate)


def _single_phase_reduction() -> Column:
    reduction = F.lit(0.0)
    for federal, by_rate in SINGLE_PHASE_REDUCTION.items():
        inner = F.lit(0.0)
        for rate, value in by_rate.items():
            inner = F.when(F.col("icms_ops") == rate, value).otherwise(inner)
        reduction = F.when(F.col("pis_rt") == federal, inner).otherwise(reduction)
    return reduction


def nonmed_price(operated: DataFrame, list_d: DataFrame) -> DataFrame:
    """Price under the substitution regime ('ST') or the debit/credit regime."""
    ops, net = F.col("icms_ops"), dbl("net_prc")
    substituted = F.col("regime") == "ST"
    inside = F.col("trans_is_intra_st_ind") == 1
    single_phase = (
        (F.col("seller_is_manuf_ind") == 1) & ~inside & (F.col("pis_cofins_typ_cd") == SINGLE_PHASE)
    )
    margin = (
        F.when(ops == 0.12, F.col("mva_adj_op_inter_st_12_pct"))
        .when(ops == 0.07, F.col("mva_adj_op_inter_st_7_pct"))
        .when(ops == 0.04, F.col("mva_adj_op_inter_st_4_pct"))
        .otherwise(F.col("mva_ori_op_intra_st_pct"))
    )
    reduction = F.when(single_phase, _single_phase_reduction()).when(
        inside, F.coalesce("intr_red_pct", F.lit(0.0))
    ).otherwise(0.0)
    prior_d = list_d.select(
        "pcmdty_id", add_months("period_cd", 1).alias("period_cd"), price("prc_amt").alias("_d")
    )
    paid_before = substituted & (F.col("icms_typ_cd") == "2") & inside
    debit_credit = F.col("regime") == "D/C"
    df = (
        operated.join(prior_d, ["pcmdty_id", "period_cd"], "left")
        .withColumn("_net", net)
        .withColumn("_margin", F.coalesce(margin, F.lit(0.0)))
        .withColumn("_ipi", net * F.col("ipi_rt"))
        .withColumn("_pis", F.when(F.col("pis_cofins_typ_cd") == "D/C", F.col("pis_rt")).otherwise(0.0))
        .withColumn("_icms", ops * (F.lit(1.0) - reduction))
        .withColumn("_credit", F.col("_net") * F.col("_pis"))
        .withColumn("_own", F.when(paid_before, 0.0).otherwise(F.col("_net") * F.col("_icms")))
        .withColumn(
            "_base",
            F.when(
                substituted,
                (F.col("_net") + F.col("_ipi"))
                * (F.lit(1.0) + F.col("_margin"))
                * (F.lit(1.0) - F.col("mva_reductor_pct")),
            ).otherwise(0.0),
        )
        .withColumn("_debit", F.when(paid_before, 0.0).otherwise(F.col("_base") * F.col("icms_rt")))
        .withColumn(
            "_st",
            F.when(~F.coalesce(substituted, F.lit(False)) | paid_before, 0.0)
            .when(F.col("_own") > F.col("_debit"), 0.0)
            .otherwise(F.col("_debit") - F.col("_own")),
        )
        .withColumn(
            "_resale",
            F.coalesce(
                dbl("_d") * (F.col("_pis") + F.when(debit_credit, F.col("icms_rt")).otherwise(0.0)),
                F.lit(0.0),
            ),
        )
    )
    gross, credits = F.col("_net") + F.col("_ipi"), F.col("_credit") + F.col("_own")
    value = (
        F.when(substituted, gross + F.col("_st") - F.col("_credit"))
        .when(F.col("_resale") <= credits, gross)
        .otherwise(gross - F.col("_credit") - F.col("_own") + F.col("_resale"))
    )
    return df.select(
        F.upper("line_id").alias("buys_trans_line_id"), "dsupp_proc_id", "trans_dt", "seller_otlt_cd",
        "buyer_otlt_cd", F.col("is_buyer_chain_ind").alias("buyer_is_otlt_chain_ind"), "pcmdty_id",
        "seller_is_manuf_ind", "buyer_is_pharmy_ind", "dsupp_is_distr_ind",
        price_from_double(value).alias("ppp_prc_amt"), "period_cd", "buyer_st_cd", "pck_is_medcn_ind",
    )


def tax_price_nonmed(
    buys: DataFrame,
    products: DataFrame,
    tipi: DataFrame,
    cest: DataFrame,
    icms: DataFrame,
    federal: DataFrame,
    list_d: DataFrame,
    *,
    period_from: str,
    period_to: str,
) -> DataFrame:
    """Tax-adjusted price of every non-medicine line."""
    exemptions = most_specific_match(products, tipi, "tipi_excl_cd")
    exceptions = most_specific_match(products, cest, "cest_cd")
    base = nonmed_base(buys, products, exemptions, period_from=period_from, period_to=period_to)
    return nonmed_price(nonmed_op_rate(nonmed_rates(base, exceptions, icms, federal)), list_d)
