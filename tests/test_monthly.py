"""The monthly run on stored tables: completeness, provenance of prices, reruns and failures."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from checks.domain import Domain
from pricemill.operators import buys
from pricemill.plans import monthly
from pricemill.plans.monthly import PriceStore, complete_history, run_month, undo_runs


def inputs(spark, sf_dir):
    d = Domain(spark, sf_dir)
    return {
        "raw_buys": d.raw_buys, "provider_factors": d.provider_factors, "products": d.products,
        "providers": d.providers, "outlets": d.outlets, "states": d.states, "list_d": d.price_list("D"),
        "list_l": d.price_list("L"), "list_m": d.price_list("M"), "class_bands": d.class_bands, "band": d.band,
        "tax_medicine": d.tax_medicine, "sub_national": d.sub_national_cpp, "tipi": d.tipi, "cest": d.cest,
        "icms": d.icms, "federal": d.federal, "sales": d.sales,
    }


def content(store, name):
    table = store.read(name)
    return sorted(map(str, table.select(sorted(table.columns)).collect()))


def test_two_months_and_a_rerun(spark, sf_dir, tmp_path):
    store, tables = PriceStore(spark, str(tmp_path)), inputs(spark, sf_dir)
    listed = [r[0] for r in tables["products"].select("pcmdty_id").orderBy("pcmdty_id").limit(3).collect()]
    tables["corrections"] = spark.createDataFrame(
        [("200106", listed[0], Decimal("7.5")), ("200105", listed[1], Decimal("8.25")), ("200104", listed[2], Decimal("9")),
         ("200105", -1, Decimal("1"))], "period_cd string, pcmdty_id int, prc_amt decimal(18,4)")
    # the pattern of a correction's month asks for 20yyMM
    tables["provider_list"] = tables["providers"].select(F.col("wholesaler_code").cast("string").alias("dsupp_proc_id"))
    first = {k: v for k, v in tables.items() if k != "corrections"}
    assert run_month(store, first, period="200105", batch_id="b1", min_period="199901") == []
    names = ("buys", "buys_filtered", "tax_calc", "tax_calc_clean", "national_price", "geo_price", "qty_factors", "rule_results")
    after_first = {name: content(store, name) for name in ("national_price", "geo_price")}
    run_month(store, tables, period="200106", batch_id="b1", min_period="199901")
    national = store.read("national_price")
    month = national.filter(F.col("period_cd") == "200106")
    assert month.count() == month.select("pcmdty_id").distinct().count()
    steps = {r.step_cd for r in month.select("step_cd").distinct().collect()}
    assert 1 in steps and 2 in steps and 50 in steps
    # Histories were completed for products that appeared for the first time.
    assert national.filter("step_cd in (53, 54)").count() > 0
    geos = store.read("geo_price").filter("period_cd = '200106'").groupBy("pcmdty_id").count()
    assert geos.agg(F.min("count")).first()[0] == 50
    manual = {(r.pcmdty_id, r.period_cd): r.ppp_prc_amt for r in national.filter("step_cd = 50 and pcmdty_id in ({}, {}, {})".format(*listed)).collect()}
    assert manual[listed[0], "200106"] == Decimal("7.5") and manual[listed[1], "200105"] == Decimal("8.25")
    assert manual[listed[2], "200104"] == 9
    assert [r.error_desc for r in store.read("correction_errors").collect()] == ["FCC is Invalid"]
    # Quantity factors come from the state, which equals the scan of all months.
    state = buys.qty_factors(store.read("qty_factors").filter("period_cd = '200106'"), tables["providers"])
    scan = buys.latest_qty_factor(store.read("buys"), tables["providers"])
    assert sorted(map(str, state.collect())) == sorted(map(str, scan.collect()))
    assert store.read("published_monthly").filter("run_cd = '200106'").count() > 0

    before = {name: content(store, name) for name in names}
    run_month(store, tables, period="200106", batch_id="b1", min_period="199901")
    for name in names:
        assert content(store, name) == before[name], name
    # A rule that has to pass stops the run.
    results = {r.rule_number: r.result_cd for r in store.read("rule_results").filter("period_cd = '200106'").collect()}
    assert set(results.values()) == {"PASSED", "FAILED"}
    with pytest.raises(AssertionError, match="rules failed"):
        monthly.publish_month(
            store, tables, period="200106", executed_at="", must_pass=[n for n, result in results.items() if result == "FAILED"])
    # Undoing the second month gives the earlier months back as the first one left them.
    assert undo_runs(store, "200106", monthly.journal_like(spark)) == ["200106"]
    for name, rows in after_first.items():
        table = store.read(name).filter("period_cd < '200106'")
        assert sorted(map(str, table.select(sorted(table.columns)).collect())) == rows, name

NATIONAL = "pcmdty_id int, ppp_prc_amt decimal(18,4), step_cd int, period_cd string"
GEO = """pcmdty_id int, geo_lvl_cd string, ppp_prc_amt decimal(18,4), wgt_units_qty decimal(22,0), step_cd int,
    sales_units_qty decimal(22,0), period_cd string"""
HISTORY = [("200101", 10.0, 1), ("200102", 10.5, 2), ("200103", 20.0, 2), ("200104", 20.5, 2), ("200105", 19.0, 1)]


@pytest.fixture
def stored(spark, tmp_path):
    """Prices 10, 10.5, 20, 20.5 and a current one of 19; product 2 has its first price now, product 3 an estimate."""
    store = PriceStore(spark, str(tmp_path / "store"))
    rows = [(1, Decimal(str(p)), step, m) for m, p, step in HISTORY] + [
        (2, Decimal("5"), 1, "200105"), (3, Decimal("6"), 105, "200105"), (9, Decimal("3"), 1, "200103")]
    geos = [
        (i, g, p, Decimal(4 if step == 1 else 0), step, Decimal(4 if step == 1 else 0), m)
        for i, p, step, m in rows for g in ("SPR", "RJI")
    ]
    for name, data, schema in (("national_price", rows, NATIONAL), ("geo_price", geos, GEO)):
        for month in sorted({r[-1] for r in data}):
            store.replace(name, spark.createDataFrame([r for r in data if r[-1] == month], schema), month)
    products = spark.createDataFrame([(1, 0), (2, 0), (3, 0), (9, 0), (8, 0)], "pcmdty_id int, pck_is_medcn_ind int")
    lists = spark.createDataFrame([], "pcmdty_id int, period_cd string, prc_amt decimal(18,4)")
    states = spark.createDataFrame([("SP",), ("RJ",)], "state_abbrev string")
    return store, {"products": products, "list_l": lists, "states": states}


def prices(store, product):
    return {r.period_cd: (float(r.ppp_prc_amt), r.step_cd) for r in store.read("national_price").filter(f"pcmdty_id = {product}").collect()}


def complete(store, tables):
    undo_runs(store, "200105", monthly.journal_like(store.spark))
    complete_history(store, tables, period="200105", batch_id="b", min_period="200101")


def test_a_month_run_twice_gives_the_same_prices(stored):
    store, tables = stored
    start = {name: content(store, name) for name in monthly.HISTORIES}
    complete(store, tables)
    # 10.5 and 20.5 take the current price, 20 is a jump from 10.5 and stays
    assert prices(store, 1) == {"200101": (10.0, 1), "200102": (19.0, 52), "200103": (20.0, 2), "200104": (19.0, 52), "200105": (19.0, 1)}
    assert len(prices(store, 2)) == len(prices(store, 3)) == 60
    once = {name: content(store, name) for name in (*monthly.HISTORIES, "rewrite_audit", "journal")}
    complete(store, tables)
    for name, rows in once.items():
        assert content(store, name) == rows, name
    undo_runs(store, "200105", monthly.journal_like(store.spark))
    assert {name: content(store, name) for name in monthly.HISTORIES} == start


@pytest.mark.parametrize("failing", monthly.HISTORIES)
def test_a_run_after_a_failure_between_the_tables(stored, monkeypatch, failing):
    store, tables = stored
    complete(store, tables)
    expected = {name: content(store, name) for name in monthly.HISTORIES}
    undo_runs(store, "200105", monthly.journal_like(store.spark))
    merge = PriceStore.merge

    def fails(self, name, df, months):
        if name == failing:
            raise RuntimeError("lost")
        merge(self, name, df, months)

    for step in (complete, complete):  # once while the tables change, and once while the change is undone
        monkeypatch.setattr(PriceStore, "merge", fails)
        with pytest.raises(RuntimeError, match="lost"):
            step(store, tables)
        monkeypatch.setattr(PriceStore, "merge", merge)
    complete(store, tables)
    assert {name: content(store, name) for name in monthly.HISTORIES} == expected


def test_an_earlier_month_undoes_the_later_ones(stored, spark):
    store, tables = stored
    start = {name: content(store, name) for name in monthly.HISTORIES}
    complete(store, tables)
    for name in monthly.HISTORIES:
        new = store.read(name).filter("period_cd = '200105' and pcmdty_id = 1")
        store.replace(name, new.withColumns({"period_cd": F.lit("200106"), "pcmdty_id": F.lit(10)}), "200106")
    complete_history(store, tables, period="200106", batch_id="b", min_period="200101")
    assert undo_runs(store, "200105", monthly.journal_like(spark)) == ["200105", "200106"]
    for name, rows in start.items():
        table = store.read(name).filter("period_cd <= '200105'")
        assert sorted(map(str, table.select(sorted(table.columns)).collect())) == rows
    assert undo_runs(store, "200105", monthly.journal_like(spark)) == []


def test_merged_ids_and_manual_prices_are_undone(stored, spark):
    store, tables = stored
    start = {name: content(store, name) for name in monthly.HISTORIES}
    tables["id_merge"] = spark.createDataFrame([(9, 2)], "pcmdty_id_old int, pcmdty_id_new int")
    tables["products"] = tables["products"].filter("pcmdty_id <> 9")
    tables["corrections"] = spark.createDataFrame(
        [("200102", 1, Decimal("11")), ("200105", 8, Decimal("4"))], "period_cd string, pcmdty_id int, prc_amt decimal(18,4)")
    for _ in range(2):
        complete(store, tables)
        assert prices(store, 9) == {} and prices(store, 2) == {"200103": (3.0, 1), "200105": (5.0, 1)}
        assert prices(store, 1)["200102"] == (11.0, 50) and prices(store, 8) == {"200105": (4.0, 50)}
        assert store.read("geo_price").filter("pcmdty_id = 8").count() == 4
    undo_runs(store, "200105", monthly.journal_like(spark))
    assert {name: content(store, name) for name in monthly.HISTORIES} == start


def test_corrections_of_no_month_stop_the_run(stored, spark):
    store, tables = stored
    tables["corrections"] = spark.createDataFrame([("200113", 1, Decimal("1"))], "period_cd string, pcmdty_id int, prc_amt decimal(18,4)")
    with pytest.raises(ValueError, match="200113"):
        run_month(store, tables, period="200105", batch_id="b", min_period="200101")
