"""Rules, publications and the quality-control report."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from checks.base_sql import avg8, avg_at
from checks.domain import FIRST, LAST
from checks.registry import add
from pricemill.functions.periods import months_between_list, months_ending, shift
from pricemill.operators import buys, corrections, publish, report, rules
from checks.q_reference import scratch
from pricemill.sources.files import numbered, write_chunks, write_csv

P = {"period_from": FIRST, "period_to": LAST}
CUR = "200107"
NATIONAL = "pcmdty_id:i, ppp_prc_amt:d, step_cd:i, period_cd:s"
GEO = "pcmdty_id:i, geo_lvl_cd:s, ppp_prc_amt:d, wgt_units_qty:i, step_cd:i, sales_units_qty:i, period_cd:s"


# ---- rules: price tables with defects ------------------------------------------------------------

BAD = """
bad_natl AS (
  SELECT pcmdty_id, CASE WHEN pcmdty_id % 53 = 0 THEN NULL WHEN pcmdty_id % 59 = 0 THEN CAST(0 AS DECIMAL(18,4))
      WHEN pcmdty_id % 61 = 0 THEN CAST(0.04 AS DECIMAL(18,4)) ELSE ppp_prc_amt END AS ppp_prc_amt,
    CASE WHEN pcmdty_id % 118 = 0 THEN 2 ELSE step_cd END AS step_cd, period_cd FROM national),
bad_geo AS (
  SELECT pcmdty_id, geo_lvl_cd, CASE WHEN pcmdty_id % 53 = 0 THEN NULL WHEN pcmdty_id % 59 = 0 THEN CAST(0 AS DECIMAL(18,4))
      WHEN pcmdty_id % 61 = 0 THEN CAST(0.04 AS DECIMAL(18,4)) ELSE ppp_prc_amt END AS ppp_prc_amt, wgt_units_qty,
    CASE WHEN pcmdty_id % 118 = 0 THEN 2 ELSE step_cd END AS step_cd,
    CASE WHEN pcmdty_id % 67 = 0 THEN -sales_units_qty ELSE sales_units_qty END AS sales_units_qty, period_cd FROM geo)"""


def _defects(table: DataFrame) -> DataFrame:
    i = F.col("pcmdty_id")
    value = (
        F.when(i % 59 == 0, F.lit(0).cast("decimal(18,4)"))
        .when(i % 61 == 0, F.lit("0.04").cast("decimal(18,4)"))
        .otherwise(F.col("ppp_prc_amt"))
    )
    df = table.withColumn("ppp_prc_amt", F.when(i % 53 != 0, value)).withColumn(
        "step_cd", F.when(i % 118 == 0, 2).otherwise(F.col("step_cd"))
    )
    if "sales_units_qty" in table.columns:
        units = F.col("sales_units_qty")
        df = df.withColumn("sales_units_qty", F.when(i % 67 == 0, -units).otherwise(units))
    return df


def _natl(d):
    return _defects(d.stored("national"))


def _geo(d):
    return _defects(d.stored("geo"))


def v(key, columns, run, select):
    add(key, columns, run, select, ctes=BAD, grain="pack")


for _key, _type in (("rule_price_feed_c", "C"), ("rule_price_feed_m", "M")):
    v(_key, "price_type:s, cnt:i", lambda d, t=_type: rules.price_feed_rows(d.price_feed, period=CUR, price_type=t),
      f"SELECT price_type, count(*) AS cnt FROM price_feed WHERE price_date[1:6] = '{CUR}' AND price_type = '{_type}' GROUP BY ALL")


def _unmapped(d):
    """Association lines of the last line number were not bridged."""
    lost = (F.col("dsupp_is_assc_ind") == 1) & (F.col("prod_brdg_stat_cd") == "Pending")
    return d.buys.withColumn("pcmdty_id", F.when(lost, 1_000_000).otherwise(F.col("pcmdty_id")))


v("rule_bridge", "line_id:s, pcmdty_id:i, period_cd:s", lambda d: rules.unbridged_lines(_unmapped(d)),
  "SELECT line_id, 1000000 AS pcmdty_id, period_cd FROM buys WHERE dsupp_is_assc_ind = 1 AND prod_brdg_stat_cd = 'Pending'")
v("rule_cpp_band", "pcmdty_id:i, price_ppp:d, price_cpp:d, period_cd:s",
  lambda d: rules.outside_band(_natl(d), d.price_list("D"), d.band, period=CUR),
  f"""SELECT n.pcmdty_id, n.ppp_prc_amt AS price_ppp, c.prc_amt AS price_cpp, n.period_cd FROM bad_natl n
      JOIN list_d c ON c.pcmdty_id = n.pcmdty_id AND c.period_cd = n.period_cd
      WHERE n.period_cd = '{CUR}' AND c.prc_amt > 0.05 AND (n.ppp_prc_amt * 100 < c.prc_amt * 20 OR n.ppp_prc_amt * 100 > c.prc_amt * 180)""")


def _repeated(d):
    return d.national.unionByName(d.national.filter("step_cd = 102"))


v("rule_dup_national", "pcmdty_id:i, period_cd:s, cnt:i",
  lambda d: rules.duplicates(_repeated(d), ["pcmdty_id", "period_cd"], **P),
  """SELECT pcmdty_id, period_cd, count(*) AS cnt FROM (SELECT * FROM national UNION ALL SELECT * FROM national WHERE step_cd = 102)
     GROUP BY ALL HAVING count(*) > 1""")
v("rule_dup_dim", "pcmdty_id:i, cnt:i",
  lambda d: rules.duplicates(d.products.unionByName(d.products.filter("atc1_cd = 'E'")), ["pcmdty_id"]),
  "SELECT pcmdty_id, count(*) AS cnt FROM (SELECT * FROM products UNION ALL SELECT * FROM products WHERE atc1_cd = 'E') GROUP BY ALL HAVING count(*) > 1")
v("rule_dup_step", "pcmdty_id:i, geo_lvl_cd:s, period_cd:s, step_cd:i, cnt:i",
  lambda d: rules.duplicates(d.geo.unionByName(d.geo.filter("step_cd = 50")), ["pcmdty_id", "geo_lvl_cd", "period_cd", "step_cd"]),
  """SELECT pcmdty_id, geo_lvl_cd, period_cd, step_cd, count(*) AS cnt
     FROM (SELECT * FROM geo UNION ALL SELECT * FROM geo WHERE step_cd = 50) GROUP BY ALL HAVING count(*) > 1""")
v("rule_coverage", "pcmdty_id:i",
  lambda d: rules.products_without_price(d.products, d.national, period_from=CUR, period_to=LAST),
  f"SELECT pcmdty_id FROM products WHERE pcmdty_id NOT IN (SELECT pcmdty_id FROM national WHERE period_cd BETWEEN '{CUR}' AND '{LAST}')")
for _key, _carried, _cond in (("rule_max_med", False, "<>"), ("rule_max_med_s2", True, "=")):
    v(_key, "period_cd:s, step_cd:i, pcmdty_id:i, l_price:d, ppp_prc_amt:d",
      lambda d, c=_carried: rules.above_list_price(d.national, d.products, d.price_list("L"), carried=c, **P),
      f"""SELECT DISTINCT n.period_cd, n.step_cd, n.pcmdty_id, l.prc_amt AS l_price, n.ppp_prc_amt FROM national n
          JOIN products a ON a.pcmdty_id = n.pcmdty_id AND a.pck_is_medcn_ind = 1
          JOIN list_l l ON l.pcmdty_id = n.pcmdty_id AND l.period_cd = n.period_cd
          WHERE l.prc_amt < n.ppp_prc_amt AND l.prc_amt > 0.05 AND n.step_cd {_cond} 2""")
v("rule_neg_units", GEO, lambda d: rules.negative_units(_geo(d), **P), "SELECT * FROM bad_geo WHERE sales_units_qty < 0")
v("rule_min_geo", GEO, lambda d: rules.low_prices(_geo(d), **P), "SELECT * FROM bad_geo WHERE ppp_prc_amt <= 0.05 AND step_cd = 1")
v("rule_min_natl", NATIONAL, lambda d: rules.low_prices(_natl(d), **P), "SELECT * FROM bad_natl WHERE ppp_prc_amt <= 0.05 AND step_cd = 1")
v("rule_null_geo", GEO, lambda d: rules.null_prices(_geo(d), **P), "SELECT * FROM bad_geo WHERE ppp_prc_amt IS NULL")
v("rule_null_natl", NATIONAL, lambda d: rules.null_prices(_natl(d), **P), "SELECT * FROM bad_natl WHERE ppp_prc_amt IS NULL")
v("rule_pos_geo", GEO, lambda d: rules.low_prices(_geo(d), step=None, at_most=0, **P), "SELECT * FROM bad_geo WHERE ppp_prc_amt <= 0")
v("rule_pos_natl", NATIONAL, lambda d: rules.low_prices(_natl(d), step=None, at_most=0, **P), "SELECT * FROM bad_natl WHERE ppp_prc_amt <= 0")
v("rule_s2_geo", GEO, lambda d: rules.low_prices(_geo(d), step=2, at_most=0, **P), "SELECT * FROM bad_geo WHERE ppp_prc_amt <= 0 AND step_cd = 2")
v("rule_s2_natl", NATIONAL, lambda d: rules.low_prices(_natl(d), step=2, at_most=0, **P), "SELECT * FROM bad_natl WHERE ppp_prc_amt <= 0 AND step_cd = 2")
v("rule_units_drop", "units:i, units_before:i", lambda d: rules.units_kept(d.sales, period=CUR),
  f"""SELECT a.u AS units, b.u AS units_before FROM (SELECT sum(sum_units) AS u FROM sales WHERE period_cd = '{CUR}') a,
      (SELECT sum(sum_units) AS u FROM sales WHERE period_cd = '200106') b WHERE a.u * 1.4 > b.u""")
v("rule_units_exist", "period_cd:s, cnt:i", lambda d: rules.units_present(d.sales, **P),
  "SELECT period_cd, count(*) AS cnt FROM sales GROUP BY ALL HAVING count(*) > 1")
v("rule_same_price", "pcmdty_id:i, ppp_prc_amt:i, price:i, period_cd:s",
  lambda d: rules.published_differences(d.national, d.price_feed, **P),
  f"""SELECT * FROM (SELECT n.pcmdty_id, CAST(CAST(n.ppp_prc_amt AS DECIMAL(18,2)) * 100 AS INT) AS ppp_prc_amt, f.price, n.period_cd FROM national n
      JOIN price_feed f ON f.fcc = n.pcmdty_id AND f.price_date[1:6] = n.period_cd AND f.price_type IN ('J', 'C')
      WHERE n.period_cd <= '{CUR}') WHERE ppp_prc_amt <> price""")


def _misdated(d):
    bad = F.col("prc_amt") < 0
    return d.corrections.withColumn(
        "period_cd", F.when(bad, F.concat(F.substring("period_cd", 1, 4), F.lit("13"))).otherwise(F.col("period_cd"))
    )


v("rule_month_regex", "period_cd:s, pcmdty_id:i, prc_amt:d", lambda d: corrections.invalid_months(_misdated(d)),
  """SELECT * FROM (SELECT CASE WHEN prc_amt < 0 THEN period_cd[1:4] || '13' ELSE period_cd END AS period_cd, pcmdty_id, prc_amt FROM corrections)
     WHERE NOT regexp_full_match(period_cd, '20[0-9][0-9]((0[1-9])|(1[0-2]))')""")
v("rule_non_empty", "n_rows:i", lambda d: rules.too_few_rows(d.states, expected=27),
  "SELECT * FROM (SELECT count(*) AS n_rows FROM states) WHERE n_rows < 27")


def _all_rules(d) -> list[rules.Rule]:
    d = d.on_kept_lines()
    Rule, natl, geo = rules.Rule, _natl(d), _geo(d)
    return [
        *rules.feed_rules(d.price_feed, period=CUR),
        *rules.price_rules(natl, geo, **P),
        rules.row_rule(103, "Bridged", "product ids in range", d.buys, rules.is_unbridged()),
        Rule(110, "CPP threshold", "prices in band", rules.outside_band(natl, d.price_list("D"), d.band, period=CUR)),
        Rule(116, "Duplicate national", "one price per product and month", rules.duplicates(natl, ["pcmdty_id", "period_cd"])),
        Rule(101, "Duplicate product", "one row per product", rules.duplicates(d.products, ["pcmdty_id"])),
        Rule(115, "Coverage", "every product has a price", rules.products_without_price(d.products, natl, **P)),
        Rule(111, "Maximum price", "medicines below L", rules.above_list_price(natl, d.products, d.price_list("L"), carried=False, **P)),
        Rule(108, "Maximum carried price", "carried medicines below L", rules.above_list_price(natl, d.products, d.price_list("L"), carried=True, **P)),
        Rule(109, "Duplicate step", "one row per key", rules.duplicates(geo, ["pcmdty_id", "geo_lvl_cd", "period_cd", "step_cd"])),
        Rule(1, "Units kept", "no drop", rules.units_kept(d.sales, period=CUR), must_exist=True),
        Rule(102, "Units exist", "sales in the range", rules.units_present(d.sales, **P), must_exist=True),
        Rule(2, "Same prices", "as published", rules.published_differences(natl, d.price_feed, **P)),
    ]


def _result(number: int, condition: str, rows: str, passes_if: str = "false") -> str:
    """One rule in SQL: the condition on the count of rows, and the result if it holds."""
    return (
        f"SELECT {number} AS rule_number, CASE WHEN (SELECT count(*) FROM ({rows})) {condition} "
        f"THEN '{'PASSED' if passes_if == 'true' else 'FAILED'}' ELSE '{'FAILED' if passes_if == 'true' else 'PASSED'}' END AS result_cd"
    )


_ABOVE = """SELECT 1 FROM bad_natl n JOIN products a ON a.pcmdty_id = n.pcmdty_id AND a.pck_is_medcn_ind = 1
            JOIN list_l l ON l.pcmdty_id = n.pcmdty_id AND l.period_cd = n.period_cd WHERE l.prc_amt < n.ppp_prc_amt AND n.step_cd {} 2"""
_UNITS = f"""SELECT 1 WHERE (SELECT sum(sum_units) FROM sales WHERE period_cd = '{CUR}') * 1.4 > (SELECT sum(sum_units) FROM sales WHERE period_cd = '200106')"""
RULE_SQL = " UNION ALL ".join(
    [
        _result(3, "> 0", f"SELECT 1 FROM price_feed WHERE price_date[1:6] = '{CUR}' AND price_type = 'C'", "true"),
        _result(4, "> 0", f"SELECT 1 FROM price_feed WHERE price_date[1:6] = '{CUR}' AND price_type = 'M'", "true"),
        _result(103, "> 0", "SELECT 1 FROM buys WHERE pcmdty_id < 0 OR pcmdty_id > 999999"),
        _result(110, "> 0", f"""SELECT 1 FROM bad_natl n JOIN list_d c ON c.pcmdty_id = n.pcmdty_id AND c.period_cd = n.period_cd
            WHERE n.period_cd = '{CUR}' AND (n.ppp_prc_amt * 100 < c.prc_amt * 20 OR n.ppp_prc_amt * 100 > c.prc_amt * 180)"""),
        _result(116, "> 0", "SELECT 1 FROM bad_natl GROUP BY pcmdty_id, period_cd HAVING count(*) > 1"),
        _result(101, "> 0", "SELECT 1 FROM products GROUP BY pcmdty_id HAVING count(*) > 1"),
        _result(115, "> 0", "SELECT 1 FROM products WHERE pcmdty_id NOT IN (SELECT pcmdty_id FROM bad_natl)"),
        _result(111, "> 0", _ABOVE.format("<>")),
        _result(108, "> 0", _ABOVE.format("=")),
        _result(112, "> 1", "SELECT 1 FROM bad_geo WHERE sales_units_qty < 0"),
        _result(104, "> 1", "SELECT 1 FROM bad_geo WHERE ppp_prc_amt <= 0.05 AND step_cd = 1"),
        _result(105, "> 1", "SELECT 1 FROM bad_natl WHERE ppp_prc_amt <= 0.05 AND step_cd = 1"),
        _result(117, "> 1", "SELECT 1 FROM bad_geo WHERE ppp_prc_amt IS NULL"),
        _result(118, "> 1", "SELECT 1 FROM bad_natl WHERE ppp_prc_amt IS NULL"),
        _result(113, "> 1", "SELECT 1 FROM bad_geo WHERE ppp_prc_amt <= 0"),
        _result(114, "> 1", "SELECT 1 FROM bad_natl WHERE ppp_prc_amt <= 0"),
        _result(106, "> 1", "SELECT 1 FROM bad_geo WHERE ppp_prc_amt <= 0 AND step_cd = 2"),
        _result(107, "> 1", "SELECT 1 FROM bad_natl WHERE ppp_prc_amt <= 0 AND step_cd = 2"),
        _result(109, "> 0", "SELECT 1 FROM bad_geo GROUP BY pcmdty_id, geo_lvl_cd, period_cd, step_cd HAVING count(*) > 1"),
        _result(1, "> 0", _UNITS, "true"),
        _result(102, "> 0", "SELECT 1 FROM sales GROUP BY period_cd HAVING count(*) > 1", "true"),
        _result(2, "> 0", f"""SELECT 1 FROM bad_natl n JOIN price_feed f ON f.fcc = n.pcmdty_id AND f.price_date[1:6] = n.period_cd
            AND f.price_type IN ('J', 'C') WHERE n.period_cd <= '{CUR}' AND CAST(CAST(n.ppp_prc_amt AS DECIMAL(18,2)) * 100 AS INT) <> f.price"""),
    ]
)
v("rule_engine", "rule_number:i, period_cd:s, result_cd:s",
  lambda d: rules.evaluate(_all_rules(d), period=CUR, executed_at="2001-08-01 00:00:00"),
  f"SELECT *, '{CUR}' AS period_cd FROM ({RULE_SQL})")

# ---- publications --------------------------------------------------------------------------------

CENTS = "CAST(CAST(n.ppp_prc_amt AS DECIMAL(18,2)) * 100 AS INT)"
PUBLISHED = "fcc:i, price:i, price_type:s, period:s, date:s"


def p(key, columns, run, select, ctes=""):
    add(key, columns, run, select, ctes=ctes, grain="pack")


def _dated(df: DataFrame) -> DataFrame:
    return df.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


DAY = "strftime(strptime(period || '01', '%Y%m%d'), '%Y-%m-%d') AS date"
p("publish_weekly", PUBLISHED,
  lambda d: _dated(publish.publish_weekly(d.national, d.products, period_from="200101", period_to=CUR)),
  f"""SELECT DISTINCT *, {DAY} FROM (
        SELECT n.pcmdty_id AS fcc, {CENTS} AS price, 'C' AS price_type, n.period_cd AS period FROM national n JOIN products USING (pcmdty_id)
          WHERE n.period_cd BETWEEN '200101' AND '{CUR}' AND atc4_cd <> 'Z98A2'
        UNION ALL SELECT n.pcmdty_id, {CENTS}, 'C', m FROM national n JOIN products USING (pcmdty_id), (SELECT unnest(['200108', '200109']) AS m)
          WHERE n.period_cd = '{CUR}' AND atc4_cd <> 'Z98A2')""")
p("publish_monthly", PUBLISHED,
  lambda d: _dated(publish.publish_monthly(d.national, d.products, period_to=CUR)),
  f"""SELECT DISTINCT *, {DAY} FROM (
        SELECT n.pcmdty_id AS fcc, {CENTS} AS price, CASE WHEN atc4_cd = 'Z98A2' THEN 'J' ELSE 'C' END AS price_type, n.period_cd AS period
        FROM national n JOIN products USING (pcmdty_id) WHERE n.period_cd BETWEEN '199607' AND '{CUR}')""")
p("publish_sub_national", "fcc:i, geo_lvl_cd:s, price:i, step_cd:i, price_type:s, period:s",
  lambda d: publish.publish_sub_national(d.geo, period_to=CUR),
  f"""SELECT pcmdty_id AS fcc, geo_lvl_cd, {CENTS} AS price, step_cd, 'C' AS price_type, period_cd AS period FROM geo n
      WHERE period_cd BETWEEN '199608' AND '{CUR}'""")


def _packs(d):
    return d.products.filter(F.col("pack_cd").cast("int") % 5 != 0).select("pack_cd")


EXPORT = f"""
exported AS (
  SELECT a.pack_cd, CAST({CENTS} AS VARCHAR) AS c, n.period_cd FROM national n JOIN products a ON a.pcmdty_id = n.pcmdty_id
  WHERE n.ppp_prc_amt <> 0 AND lower(a.atc4_cd) <> 'z98a2' AND a.manuf_cd NOT IN ('4581', '4580') AND CAST(a.pack_cd AS INT) % 5 <> 0)"""
Z1L = (
    "repeat('0', greatest(7 - length(pack_cd), 0)) || pack_cd || ' ' || 'Z1L' || repeat(' ', 51) || "
    "repeat('0', greatest(8 - length(c), 0)) || c || repeat(' ', 6) || 'BR' || '  '"
)


def _full(d):
    return publish.fixed_width_full(d.national, d.products, _packs(d), period=CUR)


def _history_cards(d):
    return publish.fixed_width_history(d.national, d.products, _packs(d), period=CUR)


def _chunked(d):
    path = scratch(d, "cards")
    write_chunks(_history_cards(d), path, max_lines=publish.CHUNK_LINES)
    return d.spark.read.text(path).withColumnRenamed("value", "pcards")


CARDS = """SELECT DISTINCT 'PIMS0000' || repeat('0', greatest(7 - length(pack_cd), 0)) || pack_cd || ' ' || period_cd[5:6] || period_cd[3:4]
        || period_cd[5:6] || period_cd[3:4] || '  ' || repeat('0', greatest(11 - length(c), 0)) || c || repeat(' ', 39) || 'BR' || '  ' AS pcards
      FROM exported WHERE period_cd BETWEEN '199608' AND '{}'""".format(CUR)
p("export_fixed_width_full", "z1l:s", _full, f"SELECT DISTINCT {Z1L} AS z1l FROM exported WHERE period_cd = '{CUR}'", EXPORT)
p("export_chunked", "pcards:s, chunk:i", _chunked,
  f"SELECT pcards, (row_number() OVER (ORDER BY pcards) - 1) // {publish.CHUNK_LINES} AS chunk FROM ({CARDS})", EXPORT)
p("row_numbers", "pcards:s, row_no:i", lambda d: numbered(_history_cards(d), ["pcards"]),
  f"SELECT pcards, row_number() OVER (ORDER BY pcards) - 1 AS row_no FROM ({CARDS})", EXPORT)
p("export_fixed_width_hist", "pcards:s", _history_cards, CARDS, EXPORT)


def _legacy(d):
    path = scratch(d, "legacy")
    write_csv(publish.publish_legacy(d.national, d.product_view, period=CUR), path)
    return d.spark.read.schema("Periodo string, FCC int, Des_Longa string, Instancia string").option("header", "true").csv(path)


p("publish_legacy", "Periodo:s, FCC:i, Des_Longa:s, Instancia:s", _legacy,
  f"""SELECT n.period_cd AS Periodo, n.pcmdty_id AS FCC, v.stdiz_pcmdty_nm AS Des_Longa,
        CASE WHEN n.step_cd IN (1, 50, 51) THEN 'REAL' ELSE 'STEP' END AS Instancia
      FROM national n JOIN product_view v ON v.pcmdty_id = n.pcmdty_id WHERE n.period_cd = '{CUR}' AND v.atc4_cd <> 'Z98A2'""")

# ---- report --------------------------------------------------------------------------------------

FUNNEL = f"""
raw1 AS (SELECT b.*, p.pck_is_medcn_ind FROM buys b LEFT JOIN products p ON p.pcmdty_id = b.pcmdty_id WHERE b.period_cd = '{CUR}'),
mapped1 AS (SELECT * FROM priced WHERE period_cd = '{CUR}' AND pur_prc_amt >= 0.05),
tax1 AS (SELECT * FROM tax_calc WHERE period_cd = '{CUR}'),
dup1 AS (SELECT * FROM (SELECT *, dense_rank() OVER (PARTITION BY buyer_otlt_cd, pcmdty_id, trans_dt ORDER BY dsupp_is_distr_ind) AS r FROM tax1) WHERE r = 1),
cpp1 AS (SELECT a.* FROM dup1 a LEFT JOIN list_d b ON b.pcmdty_id = a.pcmdty_id AND b.period_cd = '200106'
         WHERE b.prc_amt IS NULL OR (a.ppp_prc_amt * 100 > b.prc_amt * 20 AND a.ppp_prc_amt * 100 < b.prc_amt * 180)),
out1 AS (SELECT * FROM clean WHERE period_cd = '{CUR}')"""


def _stage(name: str, table: str, cond: str = "true") -> str:
    return (
        f"LEFT JOIN (SELECT dsupp_proc_id, pck_is_medcn_ind, count(*) AS {name} FROM {table} WHERE {cond} GROUP BY ALL) {name}_t "
        f"ON {name}_t.dsupp_proc_id = f.dsupp_proc_id AND {name}_t.pck_is_medcn_ind = f.pck_is_medcn_ind"
    )


add(
    "qc_funnel",
    "dsupp_proc_id:i, ppp_dsupp_typ_cd:s, oac_nm:s, pck_is_medcn_ind:i, layout:i, bridged:i, mapped:i, tax:i, dupp:i, cpp:i, out:i,"
    "diff1_bridge:d, diff2_list_price:d",
    lambda d: report.qc_funnel(
        d.buys, buys.min_price_filter(d.priced), d.stored("tax_calc"), d.clean, d.products, d.providers, d.price_list("D"), d.band, period=CUR
    ),
    f"""SELECT f.dsupp_proc_id, w.ppp_dsupp_typ_cd, w.oac_nm, f.pck_is_medcn_ind, layout, bridged, mapped, tax, dupp, cpp, "out",
          bridged::DOUBLE / layout - 1 AS diff1_bridge, mapped::DOUBLE / bridged - 1 AS diff2_list_price
        FROM (SELECT dsupp_proc_id, pck_is_medcn_ind, count(*) AS layout FROM raw1 WHERE pck_is_medcn_ind IS NOT NULL GROUP BY ALL) f
        LEFT JOIN providers w ON w.wholesaler_code = f.dsupp_proc_id
        {_stage('bridged', 'raw1', "prod_brdg_stat_cd = 'Bridged-ok'")} {_stage('mapped', 'mapped1')} {_stage('tax', 'tax1')}
        {_stage('dupp', 'dup1')} {_stage('cpp', 'cpp1')} {_stage('"out"', 'out1').replace('"out"_t', 'out_t')}""",
    ctes=FUNNEL,
)

MEDIAN = f"""
med AS (SELECT dsupp_proc_id, pcmdty_id, period_cd, quantile_cont(ppp_prc_amt::DOUBLE, 0.5) AS q FROM clean WHERE period_cd = '{CUR}' GROUP BY ALL),
ref_price AS (SELECT pcmdty_id, period_cd, {avg_at('CAST(q AS DECIMAL(22,8))', 2)} AS ref_price FROM med GROUP BY ALL),
media AS (SELECT pcmdty_id, period_cd, {avg_at('m1', 2)} AS media_ppp FROM (
  SELECT pcmdty_id, period_cd, dsupp_proc_id, {avg8('ppp_prc_amt')} AS m1 FROM clean WHERE period_cd = '{CUR}' GROUP BY ALL) GROUP BY ALL)"""
p("qc_reference_price", "pcmdty_id:i, period_cd:s, ref_price:d", lambda d: report.reference_price(d.clean, period=CUR),
  "SELECT * FROM ref_price", MEDIAN)
p("mean_of_provider_means", "pcmdty_id:i, period_cd:s, media_ppp:d", lambda d: report.mean_of_provider_means(d.clean, period_to=CUR),
  "SELECT * FROM media", MEDIAN)

ALL31, LAST3 = months_ending(CUR, 31), months_ending(CUR, 3)


def cols(periods: list[str], suffix: str = "", kind: str = "d") -> str:
    return ", ".join(f"{m}{suffix}:{kind}" for m in periods)


def pivot(value: str, periods: list[str], suffix: str = "") -> str:
    return ", ".join(f"{value.format(m=m)} AS \"{m}{suffix}\"" for m in periods)


VALUE = "max(CASE WHEN n.period_cd = '{m}' THEN {x} END)"
PIVOTS = f"""
price_pivot AS (SELECT pcmdty_id, {pivot(VALUE.replace('{x}', 'n.ppp_prc_amt'), ALL31)} FROM national n
  WHERE period_cd BETWEEN '{ALL31[0]}' AND '{CUR}' GROUP BY pcmdty_id),
l_pivot AS (SELECT pcmdty_id, {pivot(VALUE.replace('{x}', 'n.prc_amt'), LAST3)} FROM list_l n
  WHERE period_cd BETWEEN '{LAST3[0]}' AND '{CUR}' GROUP BY pcmdty_id),
disc_pivot AS (SELECT n.pcmdty_id, {pivot(VALUE.replace('{x}', 'round((n.ppp_prc_amt::DOUBLE / l.prc_amt::DOUBLE - 1) * 100, 0)'), LAST3)}
  FROM national n JOIN list_l l ON l.pcmdty_id = n.pcmdty_id AND l.period_cd = n.period_cd
  WHERE n.period_cd BETWEEN '{LAST3[0]}' AND '{CUR}' GROUP BY n.pcmdty_id),
step_pivot AS (SELECT pcmdty_id, {pivot(VALUE.replace('{x}', 'n.step_cd'), LAST3)} FROM national n
  WHERE period_cd BETWEEN '{shift(CUR, -4)}' AND '{CUR}' GROUP BY pcmdty_id),
units_before AS (SELECT pcmdty_id, sum(sales_units_qty) AS total_prev_sales_units FROM geo WHERE period_cd = '{LAST3[1]}' GROUP BY pcmdty_id)"""


def diff(distance: int, suffix: str) -> str:
    return ", ".join(
        f'coalesce("{m}"::DOUBLE / "{shift(m, -distance)}"::DOUBLE - 1, 0) AS "{m}_{suffix}"' for m in LAST3
    )


p("qc_prev_units", "pcmdty_id:i, total_prev_sales_units:i", lambda d: report.previous_units(d.geo, period_to=CUR),
  "SELECT * FROM units_before", PIVOTS)
p("pivot_price", "pcmdty_id:i, " + cols(ALL31), lambda d: report.price_pivot(d.national, period_to=CUR), "SELECT * FROM price_pivot", PIVOTS)
p("pivot_list_price", "pcmdty_id:i, " + cols(LAST3), lambda d: report.list_price_pivot(d.price_list("L"), period_to=CUR),
  "SELECT * FROM l_pivot", PIVOTS)
p("pivot_discount", "pcmdty_id:i, " + cols(LAST3), lambda d: report.discount_pivot(d.national, d.price_list("L"), period_to=CUR),
  "SELECT * FROM disc_pivot", PIVOTS)
p("pivot_step", "pcmdty_id:i, " + cols(LAST3, "", "i"), lambda d: report.step_pivot(d.national, period_to=CUR), "SELECT * FROM step_pivot", PIVOTS)
p("mom_change", "pcmdty_id:i, " + cols(LAST3, "_diff") + ", " + cols(LAST3, "_diff_2"),
  lambda d: report.price_changes(report.price_pivot(d.national, period_to=CUR), period_to=CUR, distance=1, suffix="diff").join(
      report.price_changes(report.price_pivot(d.national, period_to=CUR), period_to=CUR, distance=2, suffix="diff_2"), "pcmdty_id"),
  f"SELECT pcmdty_id, {diff(1, 'diff')}, {diff(2, 'diff_2')} FROM price_pivot", PIVOTS)

T, S, L = LAST3
F4 = shift(CUR, -3)
WIDE = f"""
chg AS (SELECT pcmdty_id, {diff(1, 'd1')}, {diff(2, 'd2')} FROM price_pivot),
cur_units AS (
  SELECT DISTINCT n.pcmdty_id, v.pri_org_short_nm AS corp_cd, v.pri_org_nm AS manufacturer, v.stdiz_pcmdty_nm AS pack, coalesce(v.gmrs_cd, '-') AS gmrs_cd,
    v.atc1_cd || ' - ' || v.atc1_nm AS ct1, e.pck_mkt_seg_class_3 AS seg_mkt_3, u.total_prev_sales_units AS prev_units,
    u.total_prev_sales_units::DOUBLE * n.ppp_prc_amt::DOUBLE AS revenue
  FROM national n JOIN geo g ON g.pcmdty_id = n.pcmdty_id AND g.period_cd = n.period_cd JOIN units_before u ON u.pcmdty_id = n.pcmdty_id
  JOIN product_view v ON v.pcmdty_id = n.pcmdty_id JOIN product_ext e ON e.pcmdty_id = n.pcmdty_id WHERE n.period_cd = '{CUR}'),
w1 AS (
  SELECT u.*, {', '.join(f'coalesce(p."{m}"::DOUBLE, 0) AS "{m}_PPP"' for m in ALL31)},
    {', '.join(f'coalesce(s."{m}"::DOUBLE, 0) AS "{m}_STEP", coalesce(l."{m}"::DOUBLE, 0) AS "{m}_PF", coalesce(x."{m}"::DOUBLE, 0) AS "{m}_DESC"' for m in LAST3)},
    {', '.join(f'round(c."{m}_d1" * 100, 0) AS "{m}_diff", round(c."{m}_d2" * 100, 0) AS "{m}_diff_2"' for m in LAST3)},
    r.ref_price::DOUBLE AS ref_price, CASE WHEN revenue > 10000 THEN 1 ELSE 0 END AS priority,
    {', '.join(f'round((p."{m}"::DOUBLE / r.ref_price::DOUBLE - 1) * 100, 0) AS "diff_ref_{m}"' for m in LAST3)},
    CASE WHEN abs(c."{S}_d2") > 0.2 THEN 1 ELSE 0 END AS "prev20_{S}", CASE WHEN abs(c."{L}_d2") > 0.2 THEN 1 ELSE 0 END AS "prev20_{L}",
    CASE WHEN abs(c."{S}_d1") > 0.15 THEN 1 ELSE 0 END AS "month15_{S}"
  FROM cur_units u JOIN price_pivot p ON p.pcmdty_id = u.pcmdty_id JOIN step_pivot s ON s.pcmdty_id = u.pcmdty_id JOIN l_pivot l ON l.pcmdty_id = u.pcmdty_id
  JOIN disc_pivot x ON x.pcmdty_id = u.pcmdty_id JOIN chg c ON c.pcmdty_id = u.pcmdty_id LEFT JOIN ref_price r ON r.pcmdty_id = u.pcmdty_id),
w2 AS (SELECT *, {', '.join(f'CASE WHEN abs("diff_ref_{m}") > 0.2 THEN 1 ELSE 0 END AS "ref20_{m}"' for m in (S, L))},
  CASE WHEN "prev20_{S}" = 0 AND "month15_{S}" = 1 THEN ("{F4}_PPP" + "{T}_PPP" + "{L}_PPP") / 3 ELSE 0 END AS "adjust_{S}" FROM w1),
w3 AS (SELECT *, CASE WHEN "adjust_{S}" = 0 THEN "{S}_PPP" ELSE "adjust_{S}" END AS "new_{S}" FROM w2),
w4 AS (SELECT *, CASE WHEN "new_{S}" <> 0 AND abs("{L}_PPP" / "new_{S}" - 1) > 0.15 THEN 1 ELSE 0 END AS against_new15 FROM w3),
w5 AS (SELECT *, CASE WHEN "prev20_{L}" = 1 AND against_new15 = 1 AND "ref20_{L}" = 0 THEN (ref_price + "{T}_PPP" + "{S}_PPP" + "{L}_PPP") / 4 ELSE 0 END AS "adjust_{L}_1" FROM w4),
w6 AS (SELECT *, CASE WHEN against_new15 = 1 AND "adjust_{L}_1" = 0 THEN ("{T}_PPP" + "{L}_PPP") / 2 ELSE 0 END AS "adjust_{L}_2" FROM w5)"""
ADJUST = f"adjust_{S}:d, new_{S}:d, against_new15:i, adjust_{L}_1:d, adjust_{L}_2:d"
FLAGS = f"prev20_{S}:i, prev20_{L}:i, month15_{S}:i, ref20_{S}:i, ref20_{L}:i"
REPORT = (
    "pcmdty_id:i, corp_cd:s, manufacturer:s, pack:s, gmrs_cd:s, ct1:s, seg_mkt_3:s, prev_units:i, revenue:d, "
    + ", ".join([cols(ALL31, "_PPP"), cols(LAST3, "_STEP"), cols(LAST3, "_PF"), cols(LAST3, "_DESC"), cols(LAST3, "_diff"),
                 cols(LAST3, "_diff_2"), "ref_price:d, priority:i", ", ".join(f"diff_ref_{m}:d" for m in LAST3), FLAGS, ADJUST, "media_ppp:d"])
)


def _report(d):
    d = d.on_kept_lines()
    return report.qc_price_validation(
        d.stored("national"), d.stored("geo"), d.clean, d.price_list("L"), d.product_view, d.product_ext, period_to=CUR
    )


p("qc_price_validation", REPORT, _report,
  "SELECT w6.*, m.media_ppp FROM w6 LEFT JOIN media m ON m.pcmdty_id = w6.pcmdty_id", MEDIAN + "," + PIVOTS + "," + WIDE)
p("suggest_adjustment", "pcmdty_id:i, " + FLAGS + ", " + ADJUST, _report, "SELECT * FROM w6", MEDIAN + "," + PIVOTS + "," + WIDE)

Q4 = months_between_list("200101", "200106")
AVG = "avg(CASE WHEN n.period_cd = '{m}' THEN {x} END)"


def _listed(d):
    return d.products.filter(F.col("pck_gmrs_class_cd") == "G")


LISTED = "pcmdty_id IN (SELECT pcmdty_id FROM products WHERE pck_gmrs_class_cd = 'G')"
for _key, _value in (("qc_pivot_by_step", "step_cd"), ("qc_pivot_price", "ppp_prc_amt")):
    p(_key, "pcmdty_id:i, " + cols(Q4),
      lambda d, c=_value: report.listed_products_pivot(d.national, _listed(d), c, period_from=Q4[0], period_to=Q4[-1]),
      f"""SELECT pcmdty_id, {pivot(AVG.replace('{x}', 'n.' + _value), Q4)} FROM national n
          WHERE period_cd BETWEEN '{Q4[0]}' AND '{Q4[-1]}' AND {LISTED} GROUP BY pcmdty_id""")
p("qc_distinct_periods", "period_cd:s", lambda d: report.distinct_periods(d.national), "SELECT DISTINCT period_cd FROM national")
p("qc_listed_products", "pcmdty_id:i, prod_desc:s, manuf_cd:s, atc4_cd:s", lambda d: report.listed_products(d.products, _listed(d)),
  f"SELECT * FROM products WHERE {LISTED}")
p("month_list", "period_cd:s, n:i",
  lambda d: d.tx.filter(F.col("period_cd").isin(months_between_list("199911", "200102"))).groupBy("period_cd").agg(F.count("*").alias("n")),
  "SELECT period_cd, count(*) AS n FROM tx WHERE period_cd BETWEEN '199911' AND '200102' GROUP BY ALL")

