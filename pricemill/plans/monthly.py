"""The monthly run: stage tables by period, each written before the next stage reads it."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from pricemill.functions.periods import shift
from pricemill.functions.tables import write_period, write_periods
from pricemill.operators import buys, corrections, estimates, history, outliers, publish, rules, weighting
from pricemill.operators.tax_general import tax_price_nonmed
from pricemill.operators.tax_medicine import tax_price
from pricemill.session import Keep, configure, cut_lineage, write_out
from pricemill.sources.files import write_chunks
from pricemill.sources.reference import rekey_products, rekeyed_ids


def taxed_lines(
    lines: DataFrame, products: DataFrame, tax_medicine: DataFrame, list_m: DataFrame, list_d: DataFrame,
    sub_national: DataFrame, tipi: DataFrame, cest: DataFrame, icms: DataFrame, federal: DataFrame,
    *, period_from: str, period_to: str,
) -> DataFrame:
    """Tax-adjusted lines of medicines and of all other products."""
    period = {"period_from": period_from, "period_to": period_to}
    medicine = tax_price(lines, products, tax_medicine, list_m, list_d, sub_national, **period)
    other = tax_price_nonmed(lines, products, tipi, cest, icms, federal, list_d, **period)
    return medicine.unionByName(other)


def step1_from_buys(
    lines: DataFrame, products: DataFrame, tax_medicine: DataFrame, list_m: DataFrame, list_d: DataFrame,
    sub_national: DataFrame, tipi: DataFrame, cest: DataFrame, icms: DataFrame, federal: DataFrame,
    band: DataFrame, sales: DataFrame, outlets: DataFrame, providers: DataFrame, states: DataFrame,
    *, period_from: str, period_to: str, keep: Keep = write_out,
) -> tuple[DataFrame, DataFrame]:
    """National and sub-national step 1 prices of cleaned purchase lines."""
    taxed = taxed_lines(
        lines, products, tax_medicine, list_m, list_d, sub_national, tipi, cest, icms, federal,
        period_from=period_from, period_to=period_to,
    )
    clean = keep(outliers.clean_transactions(keep(taxed), list_d, band, keep=keep))
    filled = weighting.step1_prices(clean, sales, outlets, providers, states, keep=keep)
    return weighting.step1_national(filled), weighting.step1_geo(filled)


class PriceStore:
    """Parquet tables under one folder, partitioned by period.

    A stage table is the lineage cut between stages: a lost executor costs the current stage only, and
    rerunning a month replaces exactly that month.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = configure(spark)
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str, like: DataFrame | None = None) -> DataFrame:
        """A table; period codes stay text.  ``like`` gives the schema of a table not written yet."""
        if like is not None:
            try:
                return self.spark.read.schema(like.schema).parquet(self.path(name))
            except AnalysisException as error:
                if error.getCondition() != "PATH_NOT_FOUND":
                    raise
                return like.limit(0)
        table = self.spark.read.parquet(self.path(name))
        return table.withColumns({c: F.col(c).cast("string") for c in ("period_cd", RUN) if c in table.columns})

    def replace(self, name: str, df: DataFrame, period: str, by: str = "period_cd") -> DataFrame:
        """Write one month (or what one run made, ``by`` run) and read it back."""
        write_period(df, self.path(name), period, by)
        return self.read(name, like=df).filter(F.col(by) == period)

    def stage(self, name: str, period: str) -> Keep:
        """Keeps a frame of the month as a stage table: columnar, and read by its columns, unlike a checkpoint."""
        return lambda df: self.replace(name, df, period)

    def merge(self, name: str, df: DataFrame, months: Collection[str]) -> None:
        """Overwrite ``months`` with ``df``, which may have been read from this table."""
        df = cut_lineage(df)
        write_periods(df, self.path(name))
        left = {r[0] for r in df.select("period_cd").distinct().collect()}
        for month in sorted(set(months) - left):  # dynamic overwrite leaves a month alone that has no rows any more
            write_period(df.limit(0), self.path(name), month)


RUN = "run_cd"
HISTORIES = ("national_price", "geo_price")


def _months(df: DataFrame, column: str = "period_cd") -> list[str]:
    """At most one value per month of the history: literals, so that only the partitions of these months are read."""
    return sorted(r[0] for r in df.select(column).distinct().collect())


def undo_runs(store: PriceStore, period: str, journal_like: DataFrame) -> list[str]:
    """Give earlier months back what the runs of ``period`` and later ones changed in them; the runs undone.

    Each run writes its journal before it changes a table, and the journal goes last here.  So this may be
    repeated, also after a run that failed between its changes: a pair restored twice, or never changed, is the same.
    """
    journal = store.read("journal", like=journal_like).filter(F.col(RUN) >= period)
    runs = _months(journal, RUN)
    for name in HISTORIES if runs else ():
        images = cut_lineage(history.first_images(journal.filter(F.col("table_nm") == name)))
        if months := _months(images):
            table = store.read(name).filter(F.col("period_cd").isin(months))
            store.merge(name, history.undo(table, images), months)
    for run in runs:
        write_period(journal.limit(0), store.path("journal"), run, RUN)
    return runs


def month_rules(
    store: PriceStore, i: Mapping[str, DataFrame], national: DataFrame, geo: DataFrame, *, period: str
) -> list[rules.Rule]:
    """The data-quality rules of a finished month; those of the published feed only if ``price_feed`` is given."""
    month = {"period_from": period, "period_to": period}
    lines = store.read("buys").filter(F.col("period_cd") == period)
    found = [
        *rules.price_rules(national, geo, **month),
        rules.row_rule(103, "Bridged", "product ids in range", lines, rules.is_unbridged()),
        rules.Rule(110, "CPP threshold", "prices in band", rules.outside_band(national, i["list_d"], i["band"], period=period)),
        rules.Rule(116, "Duplicate national", "one price per product and month", rules.duplicates(national, ["pcmdty_id", "period_cd"])),
        rules.Rule(101, "Duplicate product", "one row per product", rules.duplicates(i["products"], ["pcmdty_id"])),
        rules.Rule(115, "Coverage", "every product has a price", rules.products_without_price(i["products"], national, **month)),
        rules.Rule(111, "Maximum price", "medicines below L", rules.above_list_price(national, i["products"], i["list_l"], carried=False, **month)),
        rules.Rule(108, "Maximum carried price", "carried medicines below L", rules.above_list_price(national, i["products"], i["list_l"], carried=True, **month)),
        rules.Rule(109, "Duplicate step", "one row per key", rules.duplicates(geo, ["pcmdty_id", "geo_lvl_cd", "period_cd", "step_cd"])),
        rules.Rule(102, "Units exist", "sales in the month", rules.units_present(i["sales"], **month), must_exist=True),
    ]
    if "price_feed" in i:
        found += rules.feed_rules(i["price_feed"], period=period)
    return found


def run_month(
    store: PriceStore, inputs: Mapping[str, DataFrame], *, period: str, batch_id: str, min_period: str,
    executed_at: str = "", must_pass: Collection[int] = (),
) -> list[str]:
    """Everything from raw purchases to published prices of one month; histories are rewritten from ``min_period`` on.

    ``inputs`` holds raw_buys, provider_factors, products, providers, outlets, states, list_d, list_l,
    list_m, class_bands, band, tax_medicine, sub_national, tipi, cest, icms, federal and sales.  Optional are
    provider_list (listed providers that delivered nothing get last month's lines), id_merge (retired product ids),
    corrections (manual prices), price_feed (rules 3 and 4) and packs (the fixed-width export).

    A month may be run again, also after a failure: what it and later runs had changed in earlier months is undone first.
    Returned are those later months; they have to be run again.  Rules named in ``must_pass`` stop the run before
    anything is published if they fail; ``rule_results`` has the results of all rules.
    """
    i = dict(inputs)
    if "corrections" in i and (wrong := corrections.invalid_months(i["corrections"]).limit(10).collect()):
        raise ValueError(f"corrections of months that are no months: {[r.period_cd for r in wrong]}")
    month = {"period_from": period, "period_to": period}
    undone = undo_runs(store, period, journal_like(store.spark))
    raw = i["raw_buys"]
    if "provider_list" in i:
        raw = raw.unionByName(buys.impute_missing_providers(raw, i["provider_list"], period=period))
    lines = store.replace(
        "buys", buys.normalise_buys(raw, i["provider_factors"], batch_id=batch_id, **month), period
    )
    factors = buys.qty_factors(_factor_state(store, lines, period), i["providers"])
    resolved = buys.resolve_counterparties(
        lines, i["products"], i["providers"], i["outlets"], factors, **month
    )
    priced = store.replace("unit_prices", buys.unit_price(resolved, i["outlets"], i["providers"]), period)
    filtered = store.replace(
        "buys_filtered", buys.filtered_buys(priced, i["list_l"], i["products"], i["class_bands"]), period
    )
    taxed = store.replace(
        "tax_calc",
        taxed_lines(
            filtered, i["products"], i["tax_medicine"], i["list_m"], i["list_d"], i["sub_national"],
            i["tipi"], i["cest"], i["icms"], i["federal"], **month,
        ),
        period,
    )
    clean = store.replace(
        "tax_calc_clean",
        outliers.clean_transactions(taxed, i["list_d"], i["band"], keep=store.stage("tax_calc_in_band", period)), period
    )
    sales = i["sales"].filter(F.col("period_cd") == period)
    filled = store.replace(
        "step1_filled",
        weighting.step1_prices(
            clean, sales, i["outlets"], i["providers"], i["states"], keep=store.stage("step1_transactions", period)
        ),
        period,
    )
    geo_month = store.replace("step1_geo", weighting.step1_geo(filled), period)
    national_month = store.replace("step1_national", weighting.step1_national(filled), period)
    complete_month(store, i, national_month, geo_month, period=period, batch_id=batch_id)
    complete_history(store, i, period=period, batch_id=batch_id, min_period=min_period)
    publish_month(store, i, period=period, executed_at=executed_at, must_pass=must_pass)
    return [run for run in undone if run > period]


def _factor_state(store: PriceStore, lines: DataFrame, period: str) -> DataFrame:
    """The quantity factors as of this month: the last month's state and this month's lines."""
    empty = buys.qty_factor_state(lines.limit(0)).withColumn("period_cd", F.lit(period))
    states = store.read("qty_factors", like=empty).filter(F.col("period_cd") < period)
    last = states.agg(F.max("period_cd")).first()[0]
    before = states.filter(F.col("period_cd") == last) if last else empty
    merged = buys.merge_qty_factors(before, lines).withColumn("period_cd", F.lit(period))
    return store.replace("qty_factors", merged, period)


def complete_month(
    store: PriceStore, i: Mapping[str, DataFrame], national_month: DataFrame, geo_month: DataFrame,
    *, period: str, batch_id: str,
) -> None:
    """Carry forward, smooth and estimate the month, then write it to the price tables."""
    month = {"period_from": period, "period_to": period}
    earlier = F.col("period_cd") < period
    past_national = store.read("national_price", like=national_month).filter(earlier)
    past_geo = store.read("geo_price", like=geo_month).filter(earlier)
    previous = past_national.filter(F.col("period_cd") == shift(period, -1))
    carried = history.carry_forward(previous.unionByName(national_month), **month)
    carried = cut_lineage(carried.select(*national_month.columns))
    national = national_month.unionByName(carried)
    geo = geo_month.unionByName(estimates.geo_rows(carried, i["states"]).select(*geo_month.columns))

    geo, audit_1, flagged = corrections.smooth_channel(
        cut_lineage(geo), national, batch_id=batch_id, keep=cut_lineage, **month
    )
    geo, audit_2 = corrections.smooth_both_channels(
        cut_lineage(geo), flagged, batch_id=batch_id, keep=cut_lineage, **month
    )
    recent = past_geo.filter(F.col("period_cd") >= shift(period, -3))
    geo, audit_3 = corrections.smooth_history(
        cut_lineage(recent.unionByName(geo)), i["products"], period=period, batch_id=batch_id, keep=cut_lineage
    )
    geo = cut_lineage(geo.filter(F.col("period_cd") == period))
    national, national_audit = corrections.recalc_national(geo, national, period=period, batch_id=batch_id)
    store.replace("geo_audit", reduce(DataFrame.unionByName, [audit_1, audit_2, audit_3]), period)
    store.replace("national_audit", national_audit, period)

    national = cut_lineage(national)
    averages = estimates.level_averages(national, i["products"], i["list_l"], i["list_d"], **month)
    missing = estimates.uncovered(i["products"], national, **month)
    estimated = estimates.estimate(averages, missing, i["products"], i["list_l"], i["list_d"])
    estimated = cut_lineage(estimated.select(*national.columns))
    national = national.unionByName(estimated)
    geo = geo.unionByName(estimates.explode_to_geo(estimated, i["states"], **month).select(*geo.columns))
    store.replace("national_price", national, period)
    store.replace("geo_price", geo, period)


JOURNAL = """pcmdty_id int, geo_lvl_cd string, ppp_prc_amt decimal(18,4), step_cd int, wgt_units_qty decimal(22,0),
    sales_units_qty decimal(22,0), period_cd string, existed int, table_nm string, run_cd string"""


def journal_like(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], JOURNAL)


def complete_history(
    store: PriceStore, i: Mapping[str, DataFrame], *, period: str, batch_id: str, min_period: str
) -> None:
    """Merge ids, back-fill, rewrite and correct earlier months; the journal is written before the tables change."""
    old_national, old_geo = store.read("national_price"), store.read("geo_price")
    all_national, all_geo, moved = old_national, old_geo, None
    if "id_merge" in i:
        ids = cut_lineage(rekeyed_ids(i["id_merge"], i["products"], old_national, period=period))
        all_national, all_geo = (cut_lineage(t) for t in rekey_products(i["id_merge"], i["products"], old_national, old_geo, period=period))
        moved = old_national.join(ids.withColumnRenamed("pcmdty_id_old", "pcmdty_id"), "pcmdty_id", "inner")
        moved = moved.select(F.explode(F.array("pcmdty_id", "pcmdty_id_new")).alias("pcmdty_id"), "period_cd")
    rewrite = {"period": period, "min_period": min_period}
    first_real = cut_lineage(history.backfill_first_real(all_national, period=period))
    late = cut_lineage(history.backfill_estimates(all_national, period=period))
    rewritten = cut_lineage(history.rewrite_history(all_national, all_geo, i["products"], i["list_l"], **rewrite))
    store.replace(
        "rewrite_audit",
        history.rewrite_audit(all_national, all_geo, i["list_l"], **rewrite).withColumn(RUN, F.lit(period)), period, RUN,
    )
    store.replace(
        "rewrite_skipped",
        history.rewrite_skipped(all_national, all_geo, i["products"], i["list_l"], **rewrite).withColumn(RUN, F.lit(period)), period, RUN,
    )
    copies = first_real.unionByName(late).select(*all_national.columns)
    geo_copies = history.backfill_geo(first_real, all_geo).unionByName(
        history.backfill_geo(late, all_geo, latest_product_only=True)
    )
    valid = None
    if "corrections" in i:
        valid, errors = corrections.validate_corrections(i["corrections"], i["products"], period=period, batch_id=batch_id)
        valid = cut_lineage(valid)
        store.replace("correction_errors", errors.withColumn(RUN, F.lit(period)), period, RUN)
    changes = [copies, rewritten, *(c for c in (moved, valid) if c is not None)]
    changed = cut_lineage(reduce(DataFrame.unionByName, [c.select(*history.PRODUCT_MONTH) for c in changes]).distinct())
    months = _months(changed)
    touched = F.col("period_cd").isin(months)  # only months that change are read and written again
    journal = [
        history.before_images(table.filter(touched), changed, name=name, run=period)
        for name, table in zip(HISTORIES, (old_national, old_geo), strict=True)
    ]
    like = journal_like(store.spark)
    store.replace(
        "journal", reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), journal, like).select(*[F.col(f.name).cast(f.dataType) for f in like.schema]), period, RUN
    )
    national = history.apply_rewrite(all_national.filter(touched), rewritten).unionByName(copies)
    geo = history.apply_rewrite(all_geo.filter(touched), rewritten).unionByName(geo_copies.select(*all_geo.columns))
    if valid is not None:
        national, geo, audit, snapshot = corrections.apply_corrections(
            valid, cut_lineage(national), cut_lineage(geo), i["states"], batch_id=batch_id
        )
        store.replace("correction_audit", audit.withColumn(RUN, F.lit(period)), period, RUN)
        store.replace("correction_snapshot", snapshot.withColumn(RUN, F.lit(period)), period, RUN)
    if months:
        store.merge("national_price", national, months)
        store.merge("geo_price", geo, months)


def publish_month(
    store: PriceStore, i: Mapping[str, DataFrame], *, period: str, executed_at: str, must_pass: Collection[int] = ()
) -> None:
    """Check the rules, then write the prices to publish and, with ``packs``, the fixed-width export in chunks."""
    national, geo = store.read("national_price"), store.read("geo_price")
    this = F.col("period_cd") == period
    found = month_rules(store, i, national.filter(this), geo.filter(this), period=period)
    results = store.replace("rule_results", rules.evaluate(found, period=period, executed_at=executed_at), period)
    rules.assert_passed(results.filter(F.col("rule_number").isin(*must_pass)) if must_pass else results.limit(0))
    for name, rows in (
        ("published_monthly", publish.publish_monthly(national, i["products"], period_to=period)),
        ("published_geo", publish.publish_sub_national(geo, period_to=period)),
    ):
        store.replace(name, rows.withColumn(RUN, F.lit(period)), period, RUN)
    if "packs" in i:
        wide = publish.overlong_values(national.filter(this), width=publish.PRICE_WIDTH).select("pcmdty_id").limit(10).collect()
        if wide:
            raise ValueError(f"prices of products {[r.pcmdty_id for r in wide]} do not fit the fixed-width line")
        lines = publish.fixed_width_full(national.filter(this), i["products"], i["packs"], period=period)
        write_chunks(lines, store.path(f"export/{period}"), max_lines=publish.CHUNK_LINES)
