"""Purchase transactions and outliers."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base_sql import NET, SUPPLIER_ID, pm, share12
from checks.domain import FIRST, LAST
from checks.q_reference import scratch
from checks.registry import add
from pricemill.operators import buys, outliers
from pricemill.plans.monthly import PriceStore
from pricemill.session import cut_lineage, shuffles_dropped
from pricemill.streaming.buys import load_arrived

P = {"period_from": FIRST, "period_to": LAST}

BUYS = (
    "line_id:s, dsupp_proc_id:i, trans_dt:s, store_cd:s, orig_cnpj_fiscal_id:s, icms_typ_cd:s, invc_nbr:s,"
    "pcmdty_id:i, units_qty:d, pcmdty_qty_mult_fct:d, pur_prc_amt:d, icms_tax_pct:d, prc_disc_pct:d,"
    "dest_cnpj_fiscal_id:s, dsupp_is_assc_ind:i, prod_brdg_stat_cd:s, orig_whlslr_id:s, period_cd:s, orig_dsupp_prod_cd:s, icms_tax_amt:d, disc_amt:d,"
    "dest_dsupp_prod_cd:s, dest_dsupp_prod_ean_cd:s, proc_eff_ts:s, btch_id:s"
)
add("buys_normalise", BUYS, lambda d: d.buys, "SELECT * FROM buys")


def _arrived(d):
    """The same lines as files that arrive, loaded as a stream."""
    folder, raw = scratch(d, "arriving"), d.raw_buys
    # Two halves arrive one after the other, each in as many files as the lines have partitions.
    with shuffles_dropped(d.spark):
        halves = raw.withColumn("half", F.pmod(F.hash("line_id"), F.lit(2)))
        halves.write.option("compression", "zstd").partitionBy("half").parquet(f"{folder}/in")
    half = len(d.spark.read.schema(raw.schema).parquet(f"{folder}/in").inputFiles()) + 1 >> 1
    stream = d.spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", half).parquet(f"{folder}/in").select(*raw.columns)
    store = PriceStore(d.spark, f"{folder}/store")
    load_arrived(store, stream, d.provider_factors, batch_id="b1", checkpoint=f"{folder}/state")
    return store.read("buys")


add("stream_raw_buys", BUYS, _arrived, "SELECT * FROM buys")

LATEST_FACTORS = """
  SELECT orig_cnpj_fiscal_id AS wholesaler_CGC, pcmdty_id, max({'month': period_cd, 'factor': pcmdty_qty_mult_fct}).factor AS pcmdty_qty_mult_fct
  FROM buys SEMI JOIN (SELECT wholesaler_CGC AS orig_cnpj_fiscal_id FROM providers WHERE ppp_dsupp_typ_cd = 'PHARMACY') USING (orig_cnpj_fiscal_id)
  WHERE dsupp_is_assc_ind = 0 AND pcmdty_id BETWEEN 1 AND 999998 GROUP BY ALL"""
add(
    "qty_factor_latest",
    "wholesaler_CGC:s, pcmdty_id:i, pcmdty_qty_mult_fct:d",
    lambda d: buys.latest_qty_factor(d.buys, d.providers),
    LATEST_FACTORS,
)

add(
    "qty_factor_merged",
    "wholesaler_CGC:s, pcmdty_id:i, pcmdty_qty_mult_fct:d",
    lambda d: buys.qty_factors(
        buys.merge_qty_factors(
            buys.merge_qty_factors(
                buys.qty_factor_state(d.buys.filter("period_cd < '199906'")), d.buys.filter("period_cd >= '200001'")),
            d.buys.filter("period_cd >= '199906' AND period_cd < '200001'")),  # late lines
        d.providers),
    LATEST_FACTORS,
)


def _provider_list(d):
    return d.provider_view.select(F.col("wholesaler_code").cast("string").alias("dsupp_proc_id"))


add(
    "impute_missing_provider",
    "line_id:s, dsupp_proc_id:s, trans_dt:s, pcmdty_id:i, purchase_prc_amt:d, src_sys_cd:s, period_dt:s",
    lambda d: buys.impute_missing_providers(
        d.raw_buys.filter((F.col("period_dt") != "200107") | (F.col("bridge_type") == "Pending")),
        _provider_list(d), period="200107",
    ),
    """SELECT r.line_id, r.dsupp_proc_id, r.trans_dt, r.pcmdty_id, r.purchase_prc_amt, 'IMPUTE' AS src_sys_cd,
         '200107' AS period_dt
       FROM raw_buys r WHERE r.period_dt = '200106'
         AND EXISTS (SELECT 1 FROM provider_view v WHERE CAST(v.wholesaler_code AS VARCHAR) = r.dsupp_proc_id)
         AND NOT EXISTS (SELECT 1 FROM raw_buys c WHERE c.period_dt = '200107' AND c.bridge_type = 'Pending'
                         AND c.dsupp_proc_id = r.dsupp_proc_id)""",
)

# Whose tax id buys and sells, by the part that the reporting provider plays; 'own' is the provider itself.
RESOLVED_CTES = f"""
part_played (played, buys_as, sells_as, is_distr) AS (
  VALUES ('association', 'dest', 'orig', 0), ('PHARMACY', 'own', 'orig', 0), ('WHOLESALER', 'orig', 'own', 1), ('N/C', 'orig', 'orig', 1)),
tax_id AS (SELECT cnpj_cd AS id, outlet_code FROM outlets),
reported AS (
  SELECT b.*, p.ppp_dsupp_typ_cd, pck_is_medcn_ind, CASE dsupp_is_assc_ind WHEN 1 THEN 'association' ELSE p.ppp_dsupp_typ_cd END AS played,
    map {{'dest': dest_cnpj_fiscal_id, 'orig': orig_cnpj_fiscal_id, 'own': p.wholesaler_CGC}} AS ids
  FROM buys b JOIN providers p ON p.wholesaler_code = b.dsupp_proc_id JOIN products USING (pcmdty_id) WHERE b.pcmdty_id BETWEEN 1 AND 999998),
seller_factor AS (SELECT wholesaler_CGC AS orig_cnpj_fiscal_id, pcmdty_id, 1 AS dsupp_is_assc_ind, pcmdty_qty_mult_fct AS seller_factor FROM ({LATEST_FACTORS})),
resolved AS (
  SELECT r.line_id, r.dsupp_proc_id, r.trans_dt, r.icms_typ_cd, r.pcmdty_id, if(r.pcmdty_qty_mult_fct = 0, 1, r.pcmdty_qty_mult_fct) AS pcmdty_qty_mult_fct,
    if(seller_factor = 0, 1, seller_factor) AS seller_qty_mult_fct, r.pur_prc_amt, r.icms_tax_pct, r.prc_disc_pct,
    buyer.outlet_code AS buyer_otlt_cd, seller.outlet_code AS seller_otlt_cd, r.dsupp_is_assc_ind, r.pck_is_medcn_ind, r.ppp_dsupp_typ_cd,
    part_played.is_distr AS dsupp_is_distr_ind, r.period_cd
  FROM reported r JOIN part_played USING (played)
  SEMI JOIN tax_id known_origin ON known_origin.id = ids['orig'] SEMI JOIN tax_id known_own ON known_own.id = ids['own']
  LEFT JOIN tax_id buyer ON buyer.id = ids[buys_as] LEFT JOIN tax_id seller ON seller.id = ids[sells_as]
  LEFT JOIN seller_factor f ON f.orig_cnpj_fiscal_id = r.orig_cnpj_fiscal_id AND f.pcmdty_id = r.pcmdty_id AND f.dsupp_is_assc_ind = r.dsupp_is_assc_ind)"""


def _resolved(d, outlets=None):
    d = d.on_kept_lines()
    return buys.resolve_counterparties(
        d.buys, d.stored("products"), d.providers, d.outlets if outlets is None else outlets,
        buys.latest_qty_factor(d.buys, d.providers), distributor_class="WHOLESALER", **P,
    )


RESOLVED = (
    "line_id:s, dsupp_proc_id:i, trans_dt:s, icms_typ_cd:s, pcmdty_id:i, pcmdty_qty_mult_fct:d,"
    "seller_qty_mult_fct:d, pur_prc_amt:d, icms_tax_pct:d, prc_disc_pct:d, buyer_otlt_cd:i, seller_otlt_cd:i,"
    "dsupp_is_assc_ind:i, pck_is_medcn_ind:i, ppp_dsupp_typ_cd:s, dsupp_is_distr_ind:i, period_cd:s"
)
add("resolve_counterparties", RESOLVED, _resolved, "SELECT * FROM resolved", ctes=RESOLVED_CTES)

FILTERED = (
    "is_buyer_chain_ind:i, buyer_ppp_typ_cd:s, seller_ppp_typ_cd:s, trans_is_intra_st_ind:i, seller_st_cd:s,"
    "buyer_st_cd:s, seller_is_manuf_ind:i, buyer_is_pharmy_ind:i, line_id:s, dsupp_proc_id:i, trans_dt:s,"
    "icms_typ_cd:s, pcmdty_id:i, pur_prc_amt:d, icms_tax_pct:d, prc_disc_pct:d, buyer_otlt_cd:i,"
    "seller_otlt_cd:i, dsupp_is_assc_ind:i, pck_is_medcn_ind:i, ppp_dsupp_typ_cd:s, dsupp_is_distr_ind:i, period_cd:s"
)
add(
    "unit_price",
    FILTERED,
    lambda d: buys.unit_price(_resolved(d, buys.with_sides(d.outlets, d.providers)), d.outlets, d.providers),
    """SELECT b.is_otlt_chain_ind AS is_buyer_chain_ind,
         CASE WHEN b.ppp_fisc_actvty_class_cd <> 'PHARMACY' AND r.ppp_dsupp_typ_cd = 'PHARMACY' THEN 'PHARMACY'
              ELSE b.ppp_fisc_actvty_class_cd END AS buyer_ppp_typ_cd,
         s.ppp_fisc_actvty_class_cd AS seller_ppp_typ_cd, CASE WHEN b.st_cd = s.st_cd THEN 1 ELSE 0 END AS trans_is_intra_st_ind,
         s.st_cd AS seller_st_cd, b.st_cd AS buyer_st_cd,
         CASE WHEN s.ppp_fisc_actvty_class_cd = 'MANUFACTURER' THEN 1 ELSE 0 END AS seller_is_manuf_ind,
         CASE WHEN b.ppp_fisc_actvty_class_cd = 'PHARMACY' THEN 1 ELSE 0 END AS buyer_is_pharmy_ind,
         t.* REPLACE (CAST(floor(pur_prc_amt::DOUBLE / (CASE WHEN dsupp_is_distr_ind = 0 AND dsupp_is_assc_ind = 0
             AND seller_qty_mult_fct IS NOT NULL THEN seller_qty_mult_fct ELSE pcmdty_qty_mult_fct END)::DOUBLE * 10000 + 0.5) / 10000 AS DECIMAL(18,4)) AS pur_prc_amt)
       FROM resolved t JOIN outlets b ON b.outlet_code = t.buyer_otlt_cd JOIN outlets s ON s.outlet_code = t.seller_otlt_cd
       LEFT JOIN providers r ON r.wholesaler_CGC = b.cnpj_cd AND r.wholesaler_type <> 2
       WHERE b.ppp_incl_calc_ind = 1""",
    ctes=RESOLVED_CTES,
)

LOW = """
low AS (
  SELECT pcmdty_id, period_cd, dsupp_proc_id FROM priced GROUP BY ALL
  HAVING round(100.0 * sum(CASE WHEN pur_prc_amt <= 0.05 THEN 1 ELSE 0 END) / count(*), 2) >= 60),
kept AS (
  SELECT p.* FROM priced p WHERE NOT EXISTS (SELECT 1 FROM low l WHERE l.pcmdty_id = p.pcmdty_id
    AND l.period_cd = p.period_cd AND l.dsupp_proc_id = p.dsupp_proc_id)),
once AS (
  SELECT * FROM kept WHERE NOT (buyer_ppp_typ_cd = 'WHOLESALER' AND line_id IN
    (SELECT line_id FROM priced GROUP BY line_id HAVING count(*) > 1)))"""
add("drop_low_price_groups", FILTERED, lambda d: buys.drop_low_price_groups(d.stored("priced")), "SELECT * FROM kept", ctes=LOW)
add(
    "drop_duplicate_lines",
    FILTERED,
    lambda d: buys.drop_duplicate_lines(
        buys.drop_low_price_groups(d.stored("priced")), population=d.stored("priced")
    ),
    "SELECT * FROM once",
    ctes=LOW,
)

FLAGGED = f"""
flagged AS (
  SELECT t.*, CASE WHEN t.pck_is_medcn_ind = 1 AND coalesce(l.prc_amt, 0) > 0.05 AND (
      {NET} > l.prc_amt
      OR abs({NET} - l.prc_amt) * 100 > coalesce(g.gmrs_max_pct, 0) * l.prc_amt
      OR abs({NET} - l.prc_amt) * 100 < coalesce(g.gmrs_min_pct, 0) * l.prc_amt) THEN 1 ELSE 0 END AS outlier_ind
  FROM priced t LEFT JOIN list_l l ON l.pcmdty_id = t.pcmdty_id AND l.period_cd = t.period_cd
  LEFT JOIN products c ON c.pcmdty_id = t.pcmdty_id LEFT JOIN class_bands g ON g.pck_gmrs_class_cd = c.pck_gmrs_class_cd)"""


def _flagged(d):
    return buys.flag_list_price_outliers(d.priced, d.price_list("L"), d.products, d.class_bands)


add("medicine_list_price_outliers", FILTERED + ", outlier_ind:i", _flagged, "SELECT * FROM flagged", ctes=FLAGGED)
_FILTERED_NAMES = ", ".join(c.split(":")[0].strip() for c in FILTERED.split(","))
UNION = f"""
cleaned AS (
  SELECT {_FILTERED_NAMES} FROM flagged WHERE pck_is_medcn_ind = 0
  UNION SELECT {_FILTERED_NAMES} FROM flagged WHERE pck_is_medcn_ind = 1 AND outlier_ind = 0)"""
add("union_clean_buys", FILTERED, lambda d: buys.clean_buys(_flagged(d)), "SELECT * FROM cleaned", ctes=FLAGGED + "," + UNION)
add(
    "min_price_filter",
    FILTERED,
    lambda d: buys.min_price_filter(buys.clean_buys(_flagged(d))),
    "SELECT * FROM cleaned WHERE pur_prc_amt >= 0.05",
    ctes=FLAGGED + "," + UNION,
)
add(
    "filtered_buys",
    FILTERED,
    lambda d: buys.filtered_buys(d.stored("priced"), d.stored_list("L"), d.stored("products"), d.class_bands),
    "SELECT * FROM cleaned WHERE pur_prc_amt >= 0.05",
    ctes=LOW + "," + FLAGGED.replace("FROM priced t", "FROM once t") + "," + UNION,
)

# ---- outliers ------------------------------------------------------------------------------------

LINE = (
    "buys_trans_line_id:s, dsupp_proc_id:i, trans_dt:s, seller_otlt_cd:i, buyer_otlt_cd:i, buyer_is_otlt_chain_ind:i,"
    "pcmdty_id:i, buyer_is_pharmy_ind:i, ppp_prc_amt:d, period_cd:s, buyer_st_cd:s, pck_is_medcn_ind:i"
)
CLEAN = (
    "dsupp_proc_id:i, trans_dt:s, seller_otlt_cd:i, buyer_otlt_cd:i, buyer_is_otlt_chain_ind:i, pcmdty_id:i,"
    "ppp_prc_amt:d, buyer_st_cd:s, buyer_is_pharmy_ind:i, pck_is_medcn_ind:i, period_cd:s"
)
OUT = f"""
ranked AS (
  SELECT * FROM (SELECT *, dense_rank() OVER (PARTITION BY buyer_otlt_cd, pcmdty_id, trans_dt ORDER BY dsupp_is_distr_ind) AS r
                 FROM tax_calc) WHERE r = 1),
inband AS (
  SELECT a.* FROM ranked a LEFT JOIN list_d b ON a.pcmdty_id = b.pcmdty_id AND b.period_cd = {pm('a.period_cd', -1)}
  WHERE CASE WHEN coalesce(b.prc_amt, 0) > 0.05
             THEN a.ppp_prc_amt * 100 > b.prc_amt * 20 AND a.ppp_prc_amt * 100 < b.prc_amt * 180 ELSE true END),
tops AS (SELECT period_cd, pcmdty_id, max(ppp_prc_amt) AS max_prc FROM inband GROUP BY ALL),
std AS (SELECT i.*, t.max_prc, {share12('ppp_prc_amt', 'max_prc')} AS stdzn_prc
        FROM inband i JOIN tops t ON t.period_cd = i.period_cd AND t.pcmdty_id = i.pcmdty_id),
quart AS (
  SELECT period_cd, pcmdty_id, buyer_is_otlt_chain_ind, count(*) AS n_rows, max(max_prc) AS max_prc,
    quantile_disc(stdzn_prc, 0.25) AS p025_prc, quantile_disc(stdzn_prc, 0.75) AS p075_prc
  FROM std GROUP BY ALL HAVING count(*) >= 5),
limits AS (SELECT *, CAST(p025_prc - 1.5 * (p075_prc - p025_prc) AS DECIMAL(30,12)) AS li,
           CAST(p075_prc + 1.5 * (p075_prc - p025_prc) AS DECIMAL(30,12)) AS ls FROM quart),
outs AS (
  SELECT s.*, li, ls FROM std s JOIN limits l ON l.period_cd = s.period_cd AND l.pcmdty_id = s.pcmdty_id
    AND l.buyer_is_otlt_chain_ind = s.buyer_is_otlt_chain_ind
  WHERE stdzn_prc < li OR (pck_is_medcn_ind = 0 AND stdzn_prc > ls))"""


def _in_band(d):
    return outliers.price_band_filter(
        outliers.provider_priority(d.stored("tax_calc")), d.price_list("D"), d.band
    )


add("provider_priority", LINE, lambda d: outliers.provider_priority(d.tax_calc), "SELECT * FROM ranked", ctes=OUT)
add("cpp_band_outliers", LINE, _in_band, "SELECT * FROM inband", ctes=OUT)
KEY = "period_cd:s, pcmdty_id:i, buyer_is_otlt_chain_ind:i"
add(
    "valid_groups", KEY + ", n_rows:i", lambda d: outliers.groups_with_min_rows(_in_band(d)),
    "SELECT * FROM quart", ctes=OUT,
)
add(
    "standardise_price", LINE + ", stdzn_prc:d", lambda d: outliers.standardise_price(cut_lineage(_in_band(d))),
    "SELECT * FROM std", ctes=OUT,
)
add(
    "iqr_limits", KEY + ", n_rows:i, max_prc:d, p025_prc:d, p075_prc:d, li:d, ls:d",
    lambda d: outliers.iqr_limits(_in_band(d)), "SELECT * FROM limits", ctes=OUT,
)


def _outliers(d):
    rows = cut_lineage(_in_band(d))
    return outliers.iqr_outliers(rows, outliers.iqr_limits(rows))


add("iqr_flag", LINE + ", stdzn_prc:d, li:d, ls:d", _outliers, "SELECT * FROM outs", ctes=OUT)
add(
    "remove_outliers", CLEAN,
    lambda d: outliers.clean_transactions(d.stored("tax_calc"), d.price_list("D"), d.band),
    "SELECT * FROM inband WHERE buys_trans_line_id NOT IN (SELECT buys_trans_line_id FROM outs)", ctes=OUT,
)
add(
    "replicate_next_period", CLEAN, lambda d: outliers.replicate_next_period(d.clean, period="200106"),
    """SELECT * FROM clean WHERE period_cd NOT BETWEEN '200104' AND '200106'
       UNION ALL SELECT * REPLACE (p AS period_cd) FROM clean, (SELECT unnest(['200104','200105','200106']) AS p)
       WHERE period_cd = '200107'""".replace("SELECT * REPLACE (p AS period_cd) FROM clean, (SELECT unnest(['200104','200105','200106']) AS p)",
    "SELECT clean.* REPLACE (p AS period_cd) FROM clean, (SELECT unnest(['200104','200105','200106']) AS p) m"),
)
