"""Smoothing of sub-national prices and manual corrections, with audit rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pricemill.functions.bounded import times_geos
from pricemill.functions.numbers import MEAN, PRICE, UNITS, dbl, mean, price
from pricemill.functions.periods import in_range, shift
from pricemill.functions.quantiles import group_quantiles
from pricemill.functions.tables import delete_join, update_join
from pricemill.operators.buys import flag
from pricemill.session import Keep, same_frame

GEO_KEY = ["period_cd", "pcmdty_id", "geo_lvl_cd"]
PRODUCT_KEY = ["period_cd", "pcmdty_id"]
SMOOTHED, MANUAL = 51, 50
MONTH_PATTERN = "^20[0-9][0-9]((0[1-9])|(1[0-2]))$"


def state_of(geo: str = "geo_lvl_cd") -> Column:
    return F.substring(geo, 1, 2)


def _state_pair() -> Window:
    """The two channels of one state."""
    return Window.partitionBy("period_cd", "pcmdty_id", state_of())


def channel_flags(
    geo: DataFrame, national: DataFrame, *, period_from: str, period_to: str, k: float = 1.5
) -> DataFrame:
    """Geo prices outside mean +/- k standard deviations of the product's geos, with a replacement.

    Geos that equal the national price do not enter the statistics.  A flagged geo takes the price of
    the unflagged other channel of its state (``flag_updated``).
    """
    universe = geo.filter(in_range(period_from, period_to)).join(
        national.select(*PRODUCT_KEY, F.col("ppp_prc_amt").alias("prc_national")), PRODUCT_KEY, "inner"
    )
    stats = (
        universe.filter(F.col("ppp_prc_amt") != F.col("prc_national"))
        .groupBy(*PRODUCT_KEY)
        .agg(
            mean("ppp_prc_amt").cast("double").alias("_avg"),
            F.stddev_samp(dbl("ppp_prc_amt")).alias("_std"),
        )
    )
    far = (dbl("ppp_prc_amt") > F.col("_avg") + F.lit(k) * F.col("_std")) | (
        dbl("ppp_prc_amt") < F.col("_avg") - F.lit(k) * F.col("_std")
    )
    other = F.max(F.when(F.col("flag_smooth") == 0, F.col("ppp_prc_amt"))).over(_state_pair())
    return (
        universe.join(stats, PRODUCT_KEY, "inner")
        .withColumn("flag_smooth", flag(far))
        .withColumn("_other", other)
        .filter(F.col("flag_smooth") == 1)
        .select(
            *GEO_KEY, "ppp_prc_amt", F.coalesce("_other", "ppp_prc_amt").alias("ppp_prc_amt_new"),
            "flag_smooth", flag(F.col("_other").isNotNull()).alias("flag_updated"), "step_cd",
        )
    )


def geo_audit(changes: DataFrame, reason: str, batch_id: str) -> DataFrame:
    """Audit rows with the price before a change."""
    return changes.select(
        "pcmdty_id", "geo_lvl_cd", "ppp_prc_amt", "step_cd", F.lit(batch_id).alias("batch_id"),
        F.lit(reason).alias("replmnt_rsn_cd"), "period_cd",
    )


def _apply(table: DataFrame, changes: DataFrame, keys: list[str], step: int) -> DataFrame:
    new = changes.select(*keys, F.col("ppp_prc_amt_new").alias("ppp_prc_amt"), F.lit(step).alias("step_cd"))
    return update_join(table, new, keys, ["ppp_prc_amt", "step_cd"])


def _apply_to_geos(geo: DataFrame, changes: DataFrame, step: int) -> DataFrame:
    """The changed geos of a product and month meet its rows as one map (of one entry per geo at most).

    So the join is on (month, product), by which the table may be stored in buckets, and only the changes are shuffled.
    """
    price_of = F.struct(F.max("ppp_prc_amt_new").cast(geo.schema["ppp_prc_amt"].dataType).alias("price"))
    entries = F.collect_list(F.struct("geo_lvl_cd", "_price"))
    new = changes.groupBy(*GEO_KEY).agg(price_of.alias("_price")).groupBy(*PRODUCT_KEY).agg(F.map_from_entries(entries).alias("_new"))
    found = F.try_element_at(F.col("_new"), F.col("geo_lvl_cd"))
    joined = geo.join(new, PRODUCT_KEY, "left").withColumn("_found", found)
    values = {
        "ppp_prc_amt": F.when(F.col("_found").isNotNull(), F.col("_found.price")).otherwise(F.col("ppp_prc_amt")),
        "step_cd": F.when(F.col("_found").isNotNull(), F.lit(step).cast(geo.schema["step_cd"].dataType)).otherwise(F.col("step_cd")),
    }
    return joined.select(*[values[c].alias(c) if c in values else F.col(c) for c in geo.columns])


def smooth_channel(
    geo: DataFrame, national: DataFrame, *, period_from: str, period_to: str, k: float = 1.5,
    batch_id: str = "", keep: Keep = same_frame,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """First smoothing pass -> (geo, audit, flagged).

    ``keep`` stores the few changed rows that all results read.
    """
    flagged = keep(channel_flags(geo, national, period_from=period_from, period_to=period_to, k=k))
    changes = flagged.filter(F.col("flag_updated") == 1)
    return (
        _apply_to_geos(geo, changes, SMOOTHED),
        geo_audit(changes, "Prices-Smooth-Step-1.1", batch_id),
        flagged,
    )


def both_channel_changes(
    geo: DataFrame, flagged: DataFrame, *, period_from: str, period_to: str
) -> DataFrame:
    """Geos still flagged: unit-weighted mean of the unflagged geos in states with units.

    Only products with a flagged geo are looked at.  Everything is keyed by (month, product): one shuffle of the table, and
    none if it is stored in buckets of these columns.
    """
    left = flagged.filter(F.col("flag_updated") == 0).groupBy(*PRODUCT_KEY).agg(F.collect_set("geo_lvl_cd").alias("_geos"))
    universe = (
        geo.filter(in_range(period_from, period_to))
        .join(left, PRODUCT_KEY, "inner")
        .withColumn("_left", flag(F.array_contains("_geos", F.col("geo_lvl_cd"))))
        .withColumn("_ind", flag(F.sum("wgt_units_qty").over(_state_pair()) > 0))
    )
    weight = F.when(F.col("_left") == 0, (F.col("sales_units_qty") * F.col("_ind")).cast(UNITS))
    value = F.sum(F.col("ppp_prc_amt").cast(MEAN) * weight)
    # One aggregation also tells which products have flagged and unflagged geos.
    replacement = (
        universe.groupBy(*PRODUCT_KEY)
        .agg(
            value.alias("_value"), F.sum(weight).alias("_weight"),
            F.max("_left").alias("_any"), F.min("_left").alias("_all"),
        )
        .filter((F.col("_any") == 1) & (F.col("_all") == 0))
        .select(
            *PRODUCT_KEY,
            F.when(F.col("_weight") == 0, F.lit(0).cast(MEAN))
            .otherwise(F.try_divide("_value", "_weight").cast(MEAN))
            .alias("_new"),
        )
    )
    return (
        universe.filter(F.col("_left") == 1)
        .join(replacement, PRODUCT_KEY, "inner")
        .select(*GEO_KEY, "ppp_prc_amt", F.col("_new").cast(PRICE).alias("ppp_prc_amt_new"), "step_cd")
    )


def smooth_both_channels(
    geo: DataFrame, flagged: DataFrame, *, period_from: str, period_to: str, batch_id: str = "",
    keep: Keep = same_frame,
) -> tuple[DataFrame, DataFrame]:
    """Second smoothing pass on the result of the first -> (geo, audit)."""
    changes = keep(both_channel_changes(geo, flagged, period_from=period_from, period_to=period_to))
    return (
        _apply_to_geos(geo, changes, SMOOTHED),
        geo_audit(changes, "Prices-Smooth-Step-1.2", batch_id),
    )


def history_deviations(
    geo: DataFrame, products: DataFrame, *, period: str, months: int = 3
) -> DataFrame:
    """Relative distance of this month's geo price from the mean of the months before."""
    history = (
        geo.filter(in_range(shift(period, -months), shift(period, -1)))
        .groupBy("pcmdty_id", "geo_lvl_cd")
        .agg(mean("ppp_prc_amt").alias("prc_avg"))
    )
    distance = F.abs(dbl("ppp_prc_amt") - dbl("prc_avg"))
    return (
        geo.filter(F.col("period_cd") == period)
        .join(products.select("pcmdty_id", "pck_is_medcn_ind", "otc_seg_cd"), "pcmdty_id", "inner")
        .join(history, ["pcmdty_id", "geo_lvl_cd"], "inner")
        .withColumn(
            "deviation",
            F.when(F.col("prc_avg") == 0, F.lit(0.0)).otherwise(F.try_divide(distance, dbl("prc_avg"))),
        )
    )


def history_changes(
    geo: DataFrame, products: DataFrame, *, period: str, months: int = 3, pct: float = 0.95,
    keep: Keep = same_frame,
) -> DataFrame:
    """Geo prices whose deviation exceeds the percentile of their medicine flag and segment.

    There are only a handful of segments, so each holds a large share of the month's prices.
    """
    segment = ["period_cd", "pck_is_medcn_ind", "otc_seg_cd"]
    deviations = keep(history_deviations(geo, products, period=period, months=months))
    limits = group_quantiles(deviations, segment, "deviation", [pct], names=["_limit"])
    return (
        deviations.join(limits, segment, "inner")
        .filter(F.col("deviation") > F.col("_limit"))
        .select(
            *GEO_KEY, "ppp_prc_amt", F.col("prc_avg").cast(PRICE).alias("ppp_prc_amt_new"), "step_cd"
        )
    )


def smooth_history(
    geo: DataFrame, products: DataFrame, *, period: str, months: int = 3, pct: float = 0.95,
    batch_id: str = "", keep: Keep = same_frame,
) -> tuple[DataFrame, DataFrame]:
    """Replace extreme moves by the mean of the months before -> (geo, audit)."""
    changes = keep(
        history_changes(geo, products, period=period, months=months, pct=pct, keep=keep)
    )
    return (
        _apply_to_geos(geo, changes, SMOOTHED), geo_audit(changes, "Prices-Smooth-Step-2", batch_id)
    )


def national_changes(geo: DataFrame, national: DataFrame, *, period: str) -> DataFrame:
    """National prices that no longer equal the mean of their geos.

    Plain mean without units, else the sales-weighted mean over states with units.
    """
    rows = geo.filter(F.col("period_cd") == period).withColumn(
        "_ind", flag(F.sum("wgt_units_qty").over(_state_pair()) > 0)
    )
    weight = (F.col("sales_units_qty") * F.col("_ind")).cast(UNITS)
    recalculated = rows.groupBy(*PRODUCT_KEY).agg(
        F.when(F.sum("wgt_units_qty") == 0, mean("ppp_prc_amt"))
        .when(F.sum("sales_units_qty") == 0, F.lit(0).cast(MEAN))
        .otherwise(
            F.try_divide(F.sum(F.col("ppp_prc_amt").cast(MEAN) * weight), F.sum(weight)).cast(MEAN)
        )
        .cast(PRICE)
        .alias("ppp_prc_amt_new")
    )
    return (
        national.join(recalculated, PRODUCT_KEY, "inner")
        .filter(F.col("ppp_prc_amt_new") != F.col("ppp_prc_amt"))
        .select(*PRODUCT_KEY, "ppp_prc_amt", "ppp_prc_amt_new", "step_cd")
    )


def recalc_national(
    geo: DataFrame, national: DataFrame, *, period: str, batch_id: str = ""
) -> tuple[DataFrame, DataFrame]:
    """National table after smoothing -> (national, audit)."""
    changes = national_changes(geo, national, period=period)
    audit = changes.select(
        "pcmdty_id", "ppp_prc_amt", "step_cd", F.lit(batch_id).alias("batch_id"),
        F.lit("Prices-Smooth").alias("replmnt_rsn_cd"), "period_cd",
    )
    return _apply(national, changes, PRODUCT_KEY, SMOOTHED), audit


def invalid_months(corrections: DataFrame) -> DataFrame:
    """Corrections whose month is not written as 20yyMM; the load stops if there are any."""
    return corrections.filter(~F.col("period_cd").rlike(MONTH_PATTERN))


def _with_reasons(
    corrections: DataFrame, products: DataFrame, *, period: str, months: int
) -> DataFrame:
    known = products.select("pcmdty_id").distinct().withColumn("_known", F.lit(1))
    repeated = (
        corrections.groupBy("period_cd", "pcmdty_id").agg(F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1").select("period_cd", "pcmdty_id", F.lit(1).alias("_repeated"))
    )
    missing = F.col("pcmdty_id").isNull()
    reasons = [
        (missing, "FCC is NULL"),
        (~missing & F.col("_known").isNull(), "FCC is Invalid"),
        (F.col("_repeated") == 1, "Duplicated FCC"),
        (F.col("prc_amt") < 0, "Price is Negative"),
        (F.col("prc_amt").isNull(), "Price is Null"),
        (
            F.col("period_cd").isNull() | (F.col("period_cd") > period)
            | (F.col("period_cd") < shift(period, -months)),
            "Period is Invalid",
        ),
    ]
    return (
        corrections.join(known, "pcmdty_id", "left")
        .join(repeated, ["period_cd", "pcmdty_id"], "left")
        .select(
            "period_cd", "pcmdty_id", price("prc_amt").alias("prc_amt"),
            F.array_compact(F.array(*[F.when(c, F.lit(text)) for c, text in reasons])).alias("reasons"),
        )
    )


def validate_corrections(
    corrections: DataFrame, products: DataFrame, *, period: str, months: int = 60, batch_id: str = ""
) -> tuple[DataFrame, DataFrame]:
    """Check all rules in one pass -> (valid, errors with one row per broken rule)."""
    checked = _with_reasons(corrections, products, period=period, months=months)
    valid = checked.filter(F.size("reasons") == 0).drop("reasons")
    errors = checked.select(
        "period_cd", "pcmdty_id", "prc_amt", F.explode("reasons").alias("error_desc"),
        F.lit(batch_id).alias("batch_id"),
    )
    return valid, errors


def apply_corrections(
    valid: DataFrame, national: DataFrame, geo: DataFrame, states: DataFrame, *, batch_id: str = ""
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Manual prices (step 50) -> (national, geo, national audit, geo snapshot).

    The geo rows of a corrected month are replaced by the full grid at the manual price; units come
    back from the snapshot.
    """
    audit = national.join(valid.select(*PRODUCT_KEY), PRODUCT_KEY, "left_semi").select(
        "pcmdty_id", "ppp_prc_amt", "step_cd", F.lit(batch_id).alias("batch_id"), "period_cd"
    )
    manual = valid.select(
        "pcmdty_id", F.col("prc_amt").alias("ppp_prc_amt"), F.lit(MANUAL).alias("step_cd"), "period_cd"
    )
    new_national = delete_join(national, valid, PRODUCT_KEY).unionByName(manual.select(*national.columns))
    snapshot = geo.join(valid.select(*PRODUCT_KEY), PRODUCT_KEY, "left_semi").withColumn(
        "batch_id", F.lit(batch_id)
    )
    units = snapshot.select(*GEO_KEY, "wgt_units_qty", "sales_units_qty")
    grid = times_geos(manual, states).join(units, GEO_KEY, "left")
    filled = grid.select(
        "pcmdty_id", "geo_lvl_cd", "ppp_prc_amt",
        F.coalesce("wgt_units_qty", F.lit(0)).cast(geo.schema["wgt_units_qty"].dataType).alias("wgt_units_qty"),
        "step_cd",
        F.coalesce("sales_units_qty", F.lit(0)).cast(geo.schema["sales_units_qty"].dataType).alias("sales_units_qty"),
        "period_cd",
    )
    new_geo = delete_join(geo, valid, PRODUCT_KEY).unionByName(filled.select(*geo.columns))
    return new_national, new_geo, audit, snapshot
