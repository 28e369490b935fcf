"""Tax-adjusted price of medicines: one pass over the lines for all states.

Every state follows the same chain - operation rate, own tax, margin, substitution base, substitution
tax, price - and differs in a few branches.  The branches are sets of states below; each step of the
chain is a ``when`` over those sets, evaluated inside one projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pricemill.functions.numbers import dbl, mean, price, price_from_double
from pricemill.functions.periods import add_months, in_range, shift
from pricemill.operators.buys import net_price

# Fixed values -------------------------------------------------------------------------------------
SOUTH_SOUTHEAST = ("SP", "SC", "RS", "RJ", "PR", "MG")
LISTED_PNN = ("P", "N", "T")
LISTED_CLASSES = ("R", "S", "G", "M")
PIS_COFINS = 0.0925
REDUCTION_BY_RATE = {0.12: 0.099, 0.07: 0.0934, 0.04: 0.0904}

STATES = (
    "AC", "AL", "AM", "AP", "BA", "CE", "DF", "ES", "GO", "MA", "MG", "MS", "MT", "PA", "PB", "PE",
    "PI", "PR", "RJ", "RN", "RO", "RR", "RS", "SC", "SE", "SP", "TO",
)
# States that need no maximum consumer price for the line's month.
NO_CEILING = ("AC", "CE", "ES", "GO", "RS", "SC", "SP")
# Internal rate by class: generics 12 %, others the given rate.
GENERIC_RATE = {"MG": 0.18, "SP": 0.18, "GO": 0.17, "SC": 0.17}
# Operation rate 12 % inside the state.
INSIDE_12 = ("PR", "RS", "SC")
# Operation rate 12 % from every other state.
OUTSIDE_12 = ("RJ", "MG", "PR", "RS", "SC", "SP")
# The margin falls back to the original one instead of 0.
MARGIN_FALLBACK = ("MG", "ES", "RO")
# Margin reduction in the calculated base.
REDUCED_MARGIN = ("AL", "DF", "SE", "TO", "AP", "RO", "RN", "ES", "PA")
# Substitution base = calculated base when a distributor sells inside the state.
CALCULATED_INSIDE = ("PE", "RJ", "PA", "RN")

LINE = [
    "buys_trans_line_id", "dsupp_proc_id", "trans_dt", "seller_otlt_cd", "buyer_otlt_cd",
    "buyer_is_otlt_chain_ind", "pcmdty_id", "seller_is_manuf_ind", "buyer_is_pharmy_ind",
    "dsupp_is_distr_ind", "ppp_prc_amt", "period_cd", "buyer_st_cd", "pck_is_medcn_ind",
]


def reference_price(sub_national: DataFrame) -> DataFrame:
    """Mean sub-national price of the independent channel, under the month that follows it."""
    return (
        sub_national.filter(F.substring("geo_lvl_cd", -1, 1) == "I")
        .groupBy(F.col("fcc").alias("pcmdty_id"), add_months("period", 1).alias("period_cd"))
        .agg(mean(price("price")).alias("ref_prc"))
    )


def _pct(name: str) -> Column:
    """A percentage of the tax table as a fraction."""
    return dbl(name) / F.lit(100.0)


def _in(*states: str) -> Column:
    return F.col("buyer_st_cd").isin(*states)


def tax_inputs(
    buys: DataFrame,
    products: DataFrame,
    tax_table: DataFrame,
    list_m: DataFrame,
    list_d: DataFrame,
    sub_national: DataFrame,
    *,
    period_from: str,
    period_to: str,
) -> DataFrame:
    """Medicine lines with their tax row, ceiling, prior-month D price and reference price.

    The three price lookups share the key (product, month) and are joined among themselves first, so
    the lines are joined once on that key; product attributes and tax rows are small dimensions.
    """
    key = ["pcmdty_id", "period_cd"]
    medicine = products.filter(F.col("pck_is_medcn_ind") == 1).select(
        "pcmdty_id", "pack_pnn_flag_cd", "pck_gmrs_class_cd"
    )
    rates = tax_table.select(
        F.col("st_cd").alias("buyer_st_cd"), F.col("pnn_cd").alias("pack_pnn_flag_cd"),
        F.col("gmrs_cd").alias("pck_gmrs_class_cd"), "icms_int_pct", "mva_orig_pct", "mva_12_pct",
        "mva_7_pct", "mva_4_pct", "red_mva_pct", "pcm_red_pct", "trava_pct",
    )
    # Each list is cut to its own months before the joins, so that a partitioned list is not read whole.
    before = shift(period_from, -1), shift(period_to, -1)
    ceiling = list_m.filter(in_range(period_from, period_to)).select(*key, price("prc_amt").alias("ceiling"))
    prior_d = list_d.filter(in_range(*before)).select(
        "pcmdty_id", add_months("period_cd", 1).alias("period_cd"), price("prc_amt").alias("d_prc")
    )
    reference = reference_price(sub_national.filter(in_range(*before, "period")))
    prices = ceiling.join(prior_d, key, "full").join(reference, key, "full")
    return (
        buys.drop("pck_is_medcn_ind").filter(in_range(period_from, period_to) & _in(*STATES))
        .join(medicine, "pcmdty_id", "inner")
        .join(rates, ["buyer_st_cd", "pack_pnn_flag_cd", "pck_gmrs_class_cd"], "inner")
        .join(prices, key, "left")
        .filter(F.col("ceiling").isNotNull() | _in(*NO_CEILING))
    )


def _rates(df: DataFrame) -> DataFrame:
    """Internal rate, operation rate and its reduction."""
    generic = F.col("pack_pnn_flag_cd").isin(*LISTED_PNN) & (F.col("pck_gmrs_class_cd") == "G")
    listed = F.col("pack_pnn_flag_cd").isin(*LISTED_PNN) & F.col("pck_gmrs_class_cd").isin(
        *LISTED_CLASSES
    )
    internal = F.when(_in("AC"), F.when(listed, 0.17).otherwise(0.0))
    for state, rate in GENERIC_RATE.items():
        internal = internal.when(_in(state), F.when(generic, 0.12).otherwise(rate))
    operation = (
        F.when(F.col("inside") & _in(*INSIDE_12), 0.12)
        .when(F.col("inside"), F.col("intr"))
        .when(_in(*OUTSIDE_12), 0.12)
        .when(F.col("seller_st_cd").isin(*SOUTH_SOUTHEAST), 0.07)
        .otherwise(0.12)
    )
    by_rate = F.lit(0.0)
    for rate, reduction in REDUCTION_BY_RATE.items():
        by_rate = F.when(F.col("rate") == rate, reduction).otherwise(by_rate)
    reduction = (
        F.when((F.col("seller_is_manuf_ind") == 1) & ~F.col("inside")
               & (F.col("pack_pnn_flag_cd") == "N"), by_rate)
        .when(_in("RJ") & F.col("dist_inside"), 0.35)
        .otherwise(0.0)
    )
    return (
        df.withColumn("listed", listed)
        .withColumn("intr", internal.otherwise(_pct("icms_int_pct")))
        .withColumn("rate", operation)
        .withColumn("rho", reduction)
    )


def _own_tax(df: DataFrame) -> DataFrame:
    rate = F.col("rate") * (F.lit(1.0) - F.col("rho"))
    kept_share = F.when(F.col("dist_inside"), 1.0 - 0.52941).otherwise(1.0 - 0.2941)
    rate = F.when(_in("PA"), rate * kept_share).otherwise(rate)
    exempt = F.col("replaced") & ~_in("GO", "SC")
    return df.withColumn("own", F.when(exempt, 0.0).otherwise(F.col("net") * rate))


def _margin(df: DataFrame) -> DataFrame:
    def pct(name: str) -> Column:
        # One state reads missing margins as 0.
        return F.when(_in("RS"), F.coalesce(_pct(name), F.lit(0.0))).otherwise(_pct(name))

    original = F.when(_in("PA") & F.col("dist_inside"), 0.40).when(
        _in("PA"), dbl("mva_orig_pct")  # read as a fraction in this state
    ).otherwise(pct("mva_orig_pct"))
    by_rate = (
        F.when(F.col("rate") == 0.12, pct("mva_12_pct"))
        .when(F.col("rate") == 0.07, pct("mva_7_pct"))
        .when(F.col("rate") == 0.04, pct("mva_4_pct"))
    )
    margin = (
        F.when(_in("PE") & F.col("dist_inside"), 0.2294)
        .when(_in("MT"), original)
        .when((F.col("intr") == F.col("rate")) & ~_in("AM"), original)
        .when(F.col("rate").isin(0.12, 0.07, 0.04), by_rate)
        .when(_in(*MARGIN_FALLBACK, "AM"), original)
        .otherwise(0.0)
    )
    reduction = (
        F.when(_in("PA") & F.col("dist_inside"), 0.5294)
        .when(_in(*REDUCED_MARGIN), _pct("red_mva_pct"))
        .when(_in("RS"), F.when(F.col("listed"), _pct("red_mva_pct")).otherwise(0.0))
        .otherwise(0.0)
    )
    return df.withColumn("margin", margin).withColumn(
        "calc", F.col("net") * (F.lit(1.0) + F.col("margin")) * (F.lit(1.0) - reduction)
    )


def _base(df: DataFrame) -> DataFrame:
    """Base of the substitution tax."""
    m, ref, calc = F.col("m"), F.col("ref"), F.col("calc")
    reduced_m = m - m * F.coalesce(_pct("pcm_red_pct"), F.lit(0.0))
    no_m = m == 0
    ceiling_or_calc = F.when(no_m, calc).otherwise(reduced_m)
    lock = ref * F.try_divide(
        _pct("trava_pct") * (F.lit(1.0) - F.col("intr")), F.lit(1.0) - F.col("rate")
    )
    capped = F.when(no_m | (calc <= m), calc).otherwise(m)
    lower_of = F.when(no_m | (ref <= m), ref).otherwise(m)
    base = (
        F.when(_in(*CALCULATED_INSIDE) & F.col("dist_inside"), calc)
        .when(_in("RO"), calc)
        .when(_in("RS", "ES"), F.when(ref == 0, calc).otherwise(ref))
        .when(
            _in("SP"),
            F.when((ref == 0) & no_m, calc)
            .when(F.col("net") >= lock, capped)
            .otherwise(lower_of),
        )
        .when(_in("AP"), F.when(F.col("dist_outside"), reduced_m).otherwise(calc))
        .when(_in("MG"), F.when(F.col("dist_outside"), m).otherwise(calc))
        .when(_in("PE"), F.when(no_m, calc).otherwise(m))
        # The reference price of this state is not maintained (0).
        .when(_in("RR"), F.when(no_m, calc).otherwise(0.0))
        .otherwise(ceiling_or_calc)
    )
    return df.withColumn("base", base).withColumn("reduced_m", m - m * _pct("pcm_red_pct"))


def _substitution_tax(df: DataFrame) -> DataFrame:
    own, net, m = F.col("own"), F.col("net"), F.col("m")
    debit = F.when(_in("RN") & F.col("dist_inside"), 0.0).otherwise(F.col("base") * F.col("intr"))
    above_own = F.when(own > debit, 0.0).otherwise(debit - own)
    floor = m * F.lit(0.056)
    ba_debit = F.col("reduced_m") * F.col("intr")
    ba_first = F.when(own > ba_debit, 0.0).otherwise(ba_debit - own)
    ba_rate, ba_share = net * F.lit(0.16), m * F.lit(0.03)
    ba_second = F.when(ba_rate > ba_share, ba_rate).otherwise(ba_share)
    tax = (
        F.when(F.col("replaced") | _in("GO", "SC"), 0.0)
        .when(_in("BA"), F.when((m != 0) & (ba_second > ba_first), ba_first).otherwise(ba_second))
        .when(_in("CE"), net * F.lit(1.0 + 0.3305) * F.col("margin"))
        .when(_in("AC", "AM"), net * F.col("margin"))
        .when(_in("PR") & (F.col("base") == 0) & (debit - own < floor), floor)
        .when(_in("RN") & F.col("dist_inside") & (own <= debit), net * F.lit(0.04))
        .otherwise(above_own)
    )
    return df.withColumn("st", tax)


def tax_price(
    buys: DataFrame,
    products: DataFrame,
    tax_table: DataFrame,
    list_m: DataFrame,
    list_d: DataFrame,
    sub_national: DataFrame,
    *,
    period_from: str,
    period_to: str,
) -> DataFrame:
    """Tax-adjusted price of every medicine line, for all states at once."""
    inside = F.col("trans_is_intra_st_ind") == 1
    distributor = F.col("seller_is_manuf_ind") == 0
    lines = tax_inputs(
        buys, products, tax_table, list_m, list_d, sub_national,
        period_from=period_from, period_to=period_to,
    )
    ref = F.coalesce(dbl("ref_prc"), F.lit(0.0))
    start = (
        lines.withColumn("net", dbl(net_price()))
        .withColumn("m", F.coalesce(dbl("ceiling"), F.lit(0.0)))
        .withColumn("ref", F.when(_in("ES"), ref).otherwise(ref / F.lit(100.0)))
        .withColumn("inside", inside)
        .withColumn("dist_inside", distributor & inside)
        .withColumn("dist_outside", distributor & ~inside)
        .withColumn("replaced", (F.col("icms_typ_cd") == "2") & inside)
        .withColumn(
            "pis", F.col("net") * F.when(F.col("pack_pnn_flag_cd") == "T", PIS_COFINS).otherwise(0.0)
        )
    )
    taxed = _substitution_tax(_base(_margin(_own_tax(_rates(start)))))
    credit = F.lit(0.17) * F.coalesce(dbl("d_prc"), F.lit(0.0))
    value = F.when(
        _in("GO", "SC"), F.col("net") - F.col("own") - F.col("pis") + credit
    ).otherwise(F.col("net") + F.col("st") - F.col("pis"))
    return taxed.select(
        F.upper("line_id").alias("buys_trans_line_id"), "dsupp_proc_id", "trans_dt", "seller_otlt_cd",
        "buyer_otlt_cd", F.col("is_buyer_chain_ind").alias("buyer_is_otlt_chain_ind"), "pcmdty_id",
        "seller_is_manuf_ind", "buyer_is_pharmy_ind", "dsupp_is_distr_ind",
        price_from_double(value).alias("ppp_prc_amt"), "period_cd", "buyer_st_cd",
        F.lit(1).alias("pck_is_medcn_ind"),
    )
