"""Small fixtures computed by hand or by brute force."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from pricemill.functions.periods import months_between_list, shift
from pricemill.operators import buys, corrections, estimates, history, outliers, weighting
from pricemill.operators.tax_medicine import STATES, tax_price

D = Decimal


def national(spark, rows):
    return spark.createDataFrame(
        [(p, D(str(v)) if v is not None else None, s, m) for p, v, s, m in rows],
        "pcmdty_id int, ppp_prc_amt decimal(18,4), step_cd int, period_cd string",
    )


def carry_loop(rows, first, last):
    """The month-by-month definition."""
    table = {(p, m): (v, s) for p, v, s, m in rows if not (s == 2 and first <= m <= last)}
    made = {}
    for month in months_between_list(first, last):
        for product in {p for p, _ in table}:
            before = table.get((product, shift(month, -1)))
            if (product, month) not in table and before and before[1] in (1, 2, 50, 51):
                table[product, month] = made[product, month] = (before[0], 2)
    return {(p, m, v) for (p, m), (v, _) in made.items()}


def test_carry_forward_equals_the_loop(spark):
    rng = random.Random(7)
    months = months_between_list("200001", "200012")
    rows = [
        (p, rng.randint(1, 99), rng.choice([1, 1, 2, 50, 51, 53, 105]), m)
        for p in range(150) for m in months if rng.random() < 0.4
    ]
    got = history.carry_forward(national(spark, rows), period_from="200003", period_to="200011").collect()
    assert {(r.pcmdty_id, r.period_cd, int(r.ppp_prc_amt)) for r in got} == carry_loop(rows, "200003", "200011")


def test_carry_forward_again_adds_nothing(spark):
    rows = [(1, 5, 1, "200001"), (2, 7, 105, "200001"), (3, 9, 50, "200002")]
    table = national(spark, rows)
    months = {"period_from": "200002", "period_to": "200004"}
    once = table.unionByName(history.carry_forward(table, **months))
    again = history.clear_carried(once, **months).unionByName(history.carry_forward(once, **months))
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, again.collect()))


LINE = {
    "line_id": "a-1", "dsupp_proc_id": 1, "trans_dt": "20200105", "icms_typ_cd": "1", "pcmdty_id": 1,
    "pur_prc_amt": D("100"), "prc_disc_pct": D("10"), "seller_st_cd": "BA", "buyer_st_cd": "AL",
    "is_buyer_chain_ind": 0, "seller_is_manuf_ind": 0, "buyer_is_pharmy_ind": 1, "period_cd": "202001",
    "trans_is_intra_st_ind": 0, "dsupp_is_distr_ind": 1, "buyer_otlt_cd": 1, "seller_otlt_cd": 2,
    "pck_is_medcn_ind": 1,
}


def tax(spark, state, *, m="200", ref=None, d=None, gmrs="G", pnn="P", **line):
    """Price of one line: 100 less 10 %, margins 30/35/40/45 %, reductions 10 % and 20 %, rate 18 %."""
    row = {**LINE, "buyer_st_cd": state, **line}
    lines = spark.createDataFrame([row], ", ".join(
        f"{k} {'int' if isinstance(v, int) else 'decimal(18,4)' if isinstance(v, D) else 'string'}"
        for k, v in row.items()))
    products = spark.createDataFrame(
        [(1, 1, pnn, gmrs)], "pcmdty_id int, pck_is_medcn_ind int, pack_pnn_flag_cd string, pck_gmrs_class_cd string")
    rates = spark.createDataFrame(
        [(s, pnn, gmrs, 18.0, 30.0, 35.0, 40.0, 45.0, 10.0, 20.0, 80.0) for s in STATES],
        "st_cd string, pnn_cd string, gmrs_cd string, icms_int_pct double, mva_orig_pct double, mva_12_pct double,"
        "mva_7_pct double, mva_4_pct double, red_mva_pct double, pcm_red_pct double, trava_pct double")
    prices = "pcmdty_id int, period_cd string, prc_amt double"
    list_m = spark.createDataFrame([(1, "202001", float(m))] if m else [], prices)
    list_d = spark.createDataFrame([(1, "201912", float(d))] if d else [], prices)
    sub = spark.createDataFrame(
        [(1, "201912", "SPI", float(ref)), (1, "201912", "SPR", 1.0)] if ref else [],
        "fcc int, period string, geo_lvl_cd string, price double")
    got = tax_price(lines, products, rates, list_m, list_d, sub, period_from="202001", period_to="202001").collect()
    return float(got[0].ppp_prc_amt) if got else None


# net 90; outside rate 0.12 (seller BA), own 10.8, margin 0.35; M 200, reduced M 160.
@pytest.mark.parametrize("state, options, expected", [
    ("AL", {}, 90 + 160 * 0.18 - 10.8),
    ("AL", {"m": "0"}, 90 + 90 * 1.35 * 0.9 * 0.18 - 10.8),
    ("AL", {"seller_st_cd": "SP"}, 90 + 160 * 0.18 - 90 * 0.07),
    ("AL", {"pnn": "T"}, 90 + 160 * 0.18 - 10.8 - 90 * 0.0925),
    ("AL", {"pnn": "N", "seller_is_manuf_ind": 1}, 90 + 160 * 0.18 - 90 * 0.12 * (1 - 0.099)),
    ("AL", {"trans_is_intra_st_ind": 1, "icms_typ_cd": "2"}, 90),
    ("AL", {"m": None}, None),
    ("MA", {"m": "0"}, 90 + 90 * 1.35 * 0.18 - 10.8),
    ("AP", {}, 90 + 160 * 0.18 - 10.8),
    ("AP", {"seller_is_manuf_ind": 1}, 90 + 90 * 1.35 * 0.9 * 0.18 - 10.8),
    ("MT", {"m": "0"}, 90 + 90 * 1.30 * 0.18 - 10.8),
    ("PE", {}, 90 + 200 * 0.18 - 10.8),
    ("PE", {"trans_is_intra_st_ind": 1}, 90 + 90 * 1.2294 * 0.18 - 90 * 0.18),
    ("RR", {}, 90),
    ("RR", {"m": "0"}, 90 + 90 * 1.35 * 0.18 - 10.8),
    ("RJ", {"seller_st_cd": "SP"}, 90 + 160 * 0.18 - 10.8),
    ("RJ", {"trans_is_intra_st_ind": 1}, 90 + 90 * 1.3 * 0.18 - 90 * 0.18 * 0.65),
    ("MG", {}, 90 + 200 * 0.12 - 10.8),
    ("MG", {"gmrs": "R", "seller_is_manuf_ind": 1}, 90 + 90 * 1.35 * 0.18 - 10.8),
    ("PR", {"trans_is_intra_st_ind": 1}, 90 + 160 * 0.18 - 10.8),
    ("RS", {"m": None}, 90 + 90 * 1.35 * 0.9 * 0.18 - 10.8),
    ("RS", {"ref": "15000"}, 90 + 150 * 0.18 - 10.8),
    ("ES", {"ref": "150"}, 90 + 150 * 0.18 - 10.8),
    ("SP", {"m": None, "gmrs": "R"}, 90 + 90 * 1.35 * 0.18 - 10.8),
    ("SP", {"ref": "15000", "gmrs": "R"}, 90 + 150 * 0.18 - 10.8),  # 90 below 150 * 0.8 * 0.82 / 0.88
    ("SP", {"ref": "10000", "m": "110", "gmrs": "R"}, 90 + 110 * 0.18 - 10.8),  # above the lock: capped at M
    ("PA", {}, 90 + 160 * 0.18 - 10.8 * (1 - 0.2941)),
    ("PA", {"trans_is_intra_st_ind": 1}, 90 + 90 * 1.4 * (1 - 0.5294) * 0.18 - 90 * 0.18 * (1 - 0.52941)),
    ("RN", {}, 90 + 160 * 0.18 - 10.8),
    ("RN", {"trans_is_intra_st_ind": 1}, 90),
    ("RO", {}, 90 + 90 * 1.35 * 0.9 * 0.18 - 10.8),
    ("BA", {}, 90 + min(160 * 0.18 - 10.8, max(14.4, 6))),
    ("BA", {"m": "0"}, 90 + 14.4),
    ("CE", {"m": None}, 90 + 90 * 1.3305 * 0.35),
    ("AC", {"m": None}, 90 + 90 * 0.35),
    ("AM", {"trans_is_intra_st_ind": 1}, 90 + 90 * 0.30),
    ("GO", {"m": None, "d": "100", "seller_st_cd": "SP"}, 90 - 6.3 + 17),
    ("SC", {"m": None, "d": "100", "seller_st_cd": "SP"}, 90 - 10.8 + 17),
    ("SC", {"m": None, "trans_is_intra_st_ind": 1, "icms_typ_cd": "2"}, 90 - 10.8),
])
def test_state_rules(spark, state, options, expected):
    got = tax(spark, state, **options)
    assert got == (None if expected is None else pytest.approx(expected, abs=1e-4))


def test_estimate_takes_the_most_specific_level(spark):
    columns = ["manuf_cd", "prod_cd", "nec4_cd", "nec3_cd", "nec2_cd", "nec1_cd", "atc4_cd", "atc3_cd", "atc2_cd",
               "app1_cd", "mseg3_cd"]
    base = dict.fromkeys(columns, "x")

    def product(i, med=0, **change):
        return (i, med, *{**base, **change}.values())

    products = spark.createDataFrame(
        [product(1), product(2, manuf_cd="y"), product(3, app1_cd=None), product(4, nec1_cd="q", nec2_cd="q",
         nec3_cd="q", nec4_cd="q", manuf_cd="q", mseg3_cd="x"), product(5, mseg3_cd=None, nec1_cd=None, nec2_cd=None,
         nec3_cd=None, nec4_cd=None)],
        "pcmdty_id int, pck_is_medcn_ind int, " + ", ".join(f"{c} string" for c in columns))
    prices = national(spark, [(1, 50, 1, "202001")])
    lists = "pcmdty_id int, period_cd string, prc_amt decimal(18,4)"
    list_d = spark.createDataFrame([(1, "201912", D(100)), (2, "201912", D(40))], lists)
    list_l = spark.createDataFrame([], lists)
    month = {"period_from": "202001", "period_to": "202001"}
    averages = estimates.level_averages(prices, products, list_l, list_d, **month)
    missing = estimates.uncovered(products, prices, **month)
    got = {r.pcmdty_id: (r.step_cd, float(r.ppp_prc_amt))
           for r in estimates.estimate(averages, missing, products, list_l, list_d).collect()}
    # 2: another manufacturer, half of its own D price; 3: no application code; 4: same segment only; 5: nothing.
    assert got == {2: (108, 20.0), 3: (103, 50.0), 4: (116, 50.0)}


def test_missing_outlet_prices_are_means_of_means(spark):
    outlets = spark.createDataFrame(
        [(i, f"c{i}", "root", "SP", 0, "PHARMACY") for i in (1, 2, 3)],
        "outlet_code int, cnpj_cd string, cnpj_root_cd string, st_cd string, is_otlt_chain_ind int,"
        "ppp_fisc_actvty_class_cd string")
    trans = spark.createDataFrame(
        [("202001", 1, 1, "SP", 0, 1, D(v)) for v in ("10", "20", "30")] + [("202001", 1, 2, "SP", 0, 1, D("60"))],
        "period_cd string, pcmdty_id int, buyer_otlt_cd int, buyer_st_cd string, buyer_is_otlt_chain_ind int,"
        "buyer_is_pharmy_ind int, ppp_prc_amt decimal(18,4)")
    sales = spark.createDataFrame(
        [("202001", 1, 7, o, u) for o, u in ((1, 1), (2, 1), (3, 2))],
        "period_cd string, fcc int, wholesaler_code int, outlet_code int, sum_units int")
    missing = weighting.missing_outlets(sales, trans, outlets)
    imputed = weighting.impute_price(missing, *weighting.root_prices(trans, outlets), "cnpj_root_cd").collect()
    assert [(r.outlet_code, float(r.ppp_prc_amt)) for r in imputed] == [(3, 40.0)]  # (20 + 60) / 2, not 30


def test_equal_purchases_count_once(spark):
    row = ("202001", 1, 1, "SP", 0, 1, D("10"))
    schema = ("period_cd string, pcmdty_id int, buyer_otlt_cd int, buyer_st_cd string, buyer_is_otlt_chain_ind int,"
              "buyer_is_pharmy_ind int, ppp_prc_amt decimal(18,4)")
    trans = spark.createDataFrame([row, row, (*row[:6], D("20"))], schema)
    none = spark.createDataFrame([], "period_cd string, pcmdty_id int, outlet_code int, st_cd string,"
                                 "is_otlt_chain_ind int, buyer_is_pharmy_ind int, ppp_prc_amt decimal(22,8)")
    assert weighting.all_transactions(none, none, trans).count() == 2


def test_hot_group_is_filtered_exactly(spark):
    """One buyer, product and day holds most lines; copies share a line id."""
    rows = [(f"h{i}", 1, 1, "20200101", i % 2, D(i % 100)) for i in range(3000)]
    rows += [(f"c{i}", i, i % 7, "20200102", 1, D(5)) for i in range(500)]
    df = spark.createDataFrame(
        rows, "buys_trans_line_id string, buyer_otlt_cd int, pcmdty_id int, trans_dt string, dsupp_is_distr_ind int,"
        "ppp_prc_amt decimal(18,4)")
    got = outliers.provider_priority(df)
    assert got.count() == 1500 + 500
    assert got.filter("buyer_otlt_cd = 1 and trans_dt = '20200101' and dsupp_is_distr_ind = 1").count() == 0


def test_duplicate_lines_are_counted_before_groups_are_dropped(spark):
    rows = [("a", "WHOLESALER", 1), ("a", "PHARMACY", 2), ("b", "WHOLESALER", 1)]
    df = spark.createDataFrame(rows, "line_id string, buyer_ppp_typ_cd string, x int")
    kept = df.filter("x = 1")
    assert {r.line_id for r in buys.drop_duplicate_lines(kept).collect()} == {"a", "b"}
    assert {r.line_id for r in buys.drop_duplicate_lines(kept, population=df).collect()} == {"b"}


def test_corrections_report_every_broken_rule(spark):
    rows = [("202001", 1, D(5)), ("202001", 2, D(5)), ("202001", 2, D(6)), (None, None, None), ("201001", 9, D(-1))]
    corr = spark.createDataFrame(rows, "period_cd string, pcmdty_id int, prc_amt decimal(18,4)")
    products = spark.createDataFrame([(1,), (2,)], "pcmdty_id int")
    valid, errors = corrections.validate_corrections(corr, products, period="202001")
    assert [tuple(r) for r in valid.collect()] == [("202001", 1, D("5.0000"))]
    got = sorted((r.pcmdty_id or 0, r.error_desc) for r in errors.collect())
    assert got == [
        (0, "FCC is NULL"), (0, "Period is Invalid"), (0, "Price is Null"), (2, "Duplicated FCC"), (2, "Duplicated FCC"),
        (9, "FCC is Invalid"), (9, "Period is Invalid"), (9, "Price is Negative"),
    ]


def test_smoothing_replaces_only_the_flagged_channel(spark):
    states = ["AC", "AL", "AM", "AP", "BA", "CE"]
    rows = [(1, f"{s}{c}", D(100 + i), 10, 1, 10, "202001") for i, s in enumerate(states) for c in "RI"]
    rows[0] = (1, "ACR", D(900), 10, 1, 10, "202001")
    geo = spark.createDataFrame(rows, "pcmdty_id int, geo_lvl_cd string, ppp_prc_amt decimal(18,4), wgt_units_qty int,"
                                "step_cd int, sales_units_qty int, period_cd string")
    month = {"period_from": "202001", "period_to": "202001"}
    smoothed, audit, _ = corrections.smooth_channel(geo, national(spark, [(1, 1, 1, "202001")]), **month)
    changed = smoothed.filter(F.col("step_cd") == 51).collect()
    assert [(r.geo_lvl_cd, float(r.ppp_prc_amt)) for r in changed] == [("ACR", 100.0)]
    assert [float(r.ppp_prc_amt) for r in audit.collect()] == [900.0]
    assert smoothed.count() == len(rows)


def test_tax_reads_only_the_months_of_each_price_list(spark, sf_dir, tmp_path):
    from checks.domain import domain

    d = domain(spark, sf_dir, "name")
    lists = {}
    for name, df, month in (
        ("m", d.price_list("M"), "period_cd"), ("d", d.price_list("D"), "period_cd"), ("s", d.sub_national_cpp, "period"),
    ):
        df.write.partitionBy(month).parquet(f"{tmp_path}/{name}")
        lists[name] = spark.read.schema(df.schema).parquet(f"{tmp_path}/{name}")
    taxed = tax_price(
        d.buys_filtered, d.products, d.tax_medicine, lists["m"], lists["d"], lists["s"], period_from="199803", period_to="199803"
    )
    plan = taxed._jdf.queryExecution().executedPlan().toString()
    for month, first in (("period_cd", "199803"), ("period_cd", "199802"), ("period", "199802")):
        assert any(
            "PartitionFilters" in line and f"{month}#" in line.split("PartitionFilters")[1] and first in line.split("PartitionFilters")[1]
            for line in plan.splitlines()
        ), (month, first)
