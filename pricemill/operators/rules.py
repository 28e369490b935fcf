"""Data-quality rules: each is a frame of violations, evaluated into one results table."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from pricemill.functions.bounded import one_value
from pricemill.functions.numbers import cents
from pricemill.functions.periods import in_range, shift
from pricemill.operators.buys import MIN_PRICE, UNKNOWN_PRODUCT


@dataclass(frozen=True)
class Rule:
    """``rows`` are violations, or with ``must_exist`` the rows whose absence is the violation.

    ``min_rows`` is the number of rows from which the condition counts as met.  A rule on single rows has ``table``
    and ``condition`` in place of ``rows`` (``row_rule``).
    """

    number: int
    name: str
    description: str
    rows: DataFrame | None = None
    must_exist: bool = False
    min_rows: int = 1
    table: DataFrame | None = None
    condition: Column | None = None


def row_rule(
    number: int, name: str, description: str, table: DataFrame, condition: Column, *, must_exist: bool = False, min_rows: int = 1
) -> Rule:
    return Rule(number, name, description, None, must_exist, min_rows, table, condition)


def evaluate(rules: list[Rule], *, period: str, executed_at: str) -> DataFrame:
    """One result row per rule.

    All rules on single rows of a table are counted in one scan of it.  A rule with rows of its own (duplicates, coverage,
    comparisons) stops reading once it has seen ``min_rows`` of them.
    """

    def result(rule: Rule, count: Column) -> Column:
        met = count >= rule.min_rows
        return F.struct(
            F.lit(rule.name).alias("rule_name"), F.lit(rule.description).alias("rule_desc"),
            F.lit(rule.number).alias("rule_number"), F.lit(executed_at).alias("exec_timestamp"),
            F.lit(period).alias("period_cd"),
            F.when(met if rule.must_exist else ~met, "PASSED").otherwise("FAILED").alias("result_cd"),
        )

    tables = list({id(rule.table): rule.table for rule in rules if rule.table is not None}.values())
    results = []
    for table in tables:
        own = [rule for rule in rules if rule.table is table]
        counts = table.agg(*[F.count_if(rule.condition).alias(f"_{rule.number}") for rule in own])
        results.append(counts.select(F.inline(F.array(*[result(rule, F.col(f"_{rule.number}")) for rule in own]))))
    for rule in rules:
        if rule.rows is not None:
            seen = rule.rows.select(F.lit(1)).limit(rule.min_rows).agg(F.count(F.lit(1)).alias("_n"))
            results.append(seen.select(F.inline(F.array(result(rule, F.col("_n"))))))
    return reduce(DataFrame.unionByName, results)


def assert_passed(results: DataFrame) -> None:
    failed = results.filter(F.col("result_cd") == "FAILED").select("rule_name").collect()
    if failed:
        raise AssertionError("rules failed: " + ", ".join(row.rule_name for row in failed))


def _groups(df: DataFrame, keys: list[str], more_than: int) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")).filter(F.col("cnt") > more_than)


def is_fed(*, period: str, price_type: str) -> Column:
    """Rules 3 and 4: prices of a type must exist for the month."""
    return (F.substring("price_date", 1, 6) == period) & (F.col("price_type") == price_type)


def price_feed_rows(feed: DataFrame, *, period: str, price_type: str) -> DataFrame:
    return _groups(feed.filter(is_fed(period=period, price_type=price_type)), ["price_type"], 0)


def is_unbridged() -> Column:
    """Rule 103: product ids outside the valid range."""
    return (F.col("pcmdty_id") < 0) | (F.col("pcmdty_id") > UNKNOWN_PRODUCT)


def unbridged_lines(buys: DataFrame) -> DataFrame:
    return buys.filter(is_unbridged())


def outside_band(
    national: DataFrame, list_d: DataFrame, band: DataFrame, *, period: str, min_list: float = MIN_PRICE
) -> DataFrame:
    """Rule 110: prices outside the band around the D price of the same month."""
    lists = list_d.filter(F.col("prc_amt") > F.lit(min_list)).select(
        "pcmdty_id", "period_cd", F.col("prc_amt").alias("price_cpp")
    )
    percent = F.col("ppp_prc_amt") * 100

    def bound(name: str) -> Column:
        return F.col("price_cpp") * one_value(band, name).cast("decimal(9,4)")

    return (
        national.filter(F.col("period_cd") == period)
        .join(lists, ["pcmdty_id", "period_cd"], "inner")
        .withColumn("_low", bound("cpp_min_pct"))
        .withColumn("_high", bound("cpp_max_pct"))
        .filter((percent < F.col("_low")) | (percent > F.col("_high")))
        .select("pcmdty_id", F.col("ppp_prc_amt").alias("price_ppp"), "price_cpp", "period_cd")
    )


def duplicates(df: DataFrame, keys: list[str], *, period_from: str | None = None, period_to: str | None = None) -> DataFrame:
    """Rules 116, 101 and 109: keys that occur more than once."""
    rows = df if period_from is None else df.filter(in_range(period_from, period_to))
    return _groups(rows, keys, 1)


def products_without_price(
    products: DataFrame, national: DataFrame, *, period_from: str, period_to: str
) -> DataFrame:
    """Rule 115: products of the dimension without a price."""
    priced = national.filter(in_range(period_from, period_to)).select("pcmdty_id").distinct()
    return products.select("pcmdty_id").distinct().join(priced, "pcmdty_id", "left_anti")


def above_list_price(
    national: DataFrame, products: DataFrame, list_l: DataFrame, *, period_from: str, period_to: str,
    carried: bool, min_list: float = MIN_PRICE,
) -> DataFrame:
    """Rules 111 and 108: medicines above their L price, without or with only step 2."""
    step = F.col("step_cd") == 2 if carried else F.col("step_cd") != 2
    medicine = products.filter(F.col("pck_is_medcn_ind") == 1).select("pcmdty_id")
    lists = list_l.filter(F.col("prc_amt") > F.lit(min_list)).select(
        "pcmdty_id", "period_cd", F.col("prc_amt").alias("l_price")
    )
    return (
        national.filter(in_range(period_from, period_to) & step)
        .join(medicine, "pcmdty_id", "left_semi")
        .join(lists, ["pcmdty_id", "period_cd"], "inner")
        .filter(F.col("l_price") < F.col("ppp_prc_amt"))
        .select("period_cd", "step_cd", "pcmdty_id", "l_price", "ppp_prc_amt")
        .distinct()
    )


def has_negative_units(*, period_from: str, period_to: str) -> Column:
    """Rule 112."""
    return in_range(period_from, period_to) & (F.col("sales_units_qty") < 0)


def negative_units(geo: DataFrame, *, period_from: str, period_to: str) -> DataFrame:
    return geo.filter(has_negative_units(period_from=period_from, period_to=period_to))


def is_low_price(*, period_from: str, period_to: str, step: int | None = 1, at_most: float = MIN_PRICE) -> Column:
    """Rules 104, 105 (step 1, 0.05), 113, 114 (any step, 0), 106 and 107 (step 2, 0)."""
    low = in_range(period_from, period_to) & (F.col("ppp_prc_amt") <= F.lit(at_most))
    return low if step is None else low & (F.col("step_cd") == step)


def low_prices(
    table: DataFrame, *, period_from: str, period_to: str, step: int | None = 1, at_most: float = MIN_PRICE
) -> DataFrame:
    return table.filter(is_low_price(period_from=period_from, period_to=period_to, step=step, at_most=at_most))


def is_null_price(*, period_from: str, period_to: str) -> Column:
    """Rules 117 and 118."""
    return in_range(period_from, period_to) & F.col("ppp_prc_amt").isNull()


def null_prices(table: DataFrame, *, period_from: str, period_to: str) -> DataFrame:
    return table.filter(is_null_price(period_from=period_from, period_to=period_to))


def price_rules(national: DataFrame, geo: DataFrame, *, period_from: str, period_to: str) -> list[Rule]:
    """The rules on single rows of the two price tables."""
    months, zero = {"period_from": period_from, "period_to": period_to}, {"at_most": 0}
    units, null = has_negative_units(**months), is_null_price(**months)
    least, positive = is_low_price(**months), is_low_price(step=None, **zero, **months)
    carried = is_low_price(step=2, **zero, **months)
    return [
        row_rule(112, "Units", "no negative units", geo, units, min_rows=2),
        row_rule(104, "Minimum geo", "step 1 above 0.05", geo, least, min_rows=2),
        row_rule(105, "Minimum national", "step 1 above 0.05", national, least, min_rows=2),
        row_rule(117, "Null geo", "no null price", geo, null, min_rows=2),
        row_rule(118, "Null national", "no null price", national, null, min_rows=2),
        row_rule(113, "Positive geo", "above 0", geo, positive, min_rows=2),
        row_rule(114, "Positive national", "above 0", national, positive, min_rows=2),
        row_rule(106, "Step 2 geo", "above 0", geo, carried, min_rows=2),
        row_rule(107, "Step 2 national", "above 0", national, carried, min_rows=2),
    ]


def feed_rules(feed: DataFrame, *, period: str) -> list[Rule]:
    return [
        row_rule(3, "CPP exists", "prices of type C in the month", feed, is_fed(period=period, price_type="C"), must_exist=True),
        row_rule(4, "PMC exists", "prices of type M in the month", feed, is_fed(period=period, price_type="M"), must_exist=True),
    ]


def units_kept(sales: DataFrame, *, period: str, tolerance: str = "1.4") -> DataFrame:
    """Rule 1: one row if this month's units times the tolerance exceed last month's."""
    now = F.sum(F.when(F.col("period_cd") == period, F.col("sum_units")))
    before = F.sum(F.when(F.col("period_cd") == shift(period, -1), F.col("sum_units")))
    return (
        sales.filter(F.col("period_cd").isin(period, shift(period, -1)))
        .agg(now.alias("units"), before.alias("units_before"))
        .filter(F.col("units") * F.lit(tolerance).cast("decimal(6,2)") > F.col("units_before"))
    )


def units_present(sales: DataFrame, *, period_from: str, period_to: str) -> DataFrame:
    """Rule 102: months with more than one sales row."""
    return _groups(sales.filter(in_range(period_from, period_to)), ["period_cd"], 1)


def published_differences(
    national: DataFrame, feed: DataFrame, *, period_from: str, period_to: str
) -> DataFrame:
    """Rule 2: prices that differ from the published feed up to the month before."""
    published = feed.filter(F.col("price_type").isin("J", "C")).select(
        F.col("fcc").alias("pcmdty_id"), F.substring("price_date", 1, 6).alias("period_cd"), "price"
    )
    return (
        national.filter(in_range(period_from, shift(period_to, -1)))
        .join(published, ["pcmdty_id", "period_cd"], "inner")
        .select("pcmdty_id", cents("ppp_prc_amt").alias("ppp_prc_amt"), "price", "period_cd")
        .filter(F.col("ppp_prc_amt") != F.col("price"))
    )


def too_few_rows(df: DataFrame, *, expected: int = 1) -> DataFrame:
    """One row if a table has fewer than ``expected`` rows (an empty table by default)."""
    seen = df.select(F.lit(1)).limit(expected).agg(F.count(F.lit(1)).alias("n_rows"))
    return seen.filter(F.col("n_rows") < expected)
