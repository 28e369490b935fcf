"""Sources, dimensions and price lists."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from checks.domain import FIRST, LAST
from checks.registry import add
from pricemill.functions.tables import replace_period, write_period, write_periods
from pricemill.session import checkpoint_dir
from pricemill.sources import files, reference

P = {"period_from": FIRST, "period_to": LAST}


def scratch(d, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{checkpoint_dir(d.spark)}/checks-{name}-{uuid.uuid4().hex}"


PART = {"p_partkey": "bigint", "p_name": "string", "p_brand": "string", "p_type": "string", "p_size": "int"}


SUPPLIER = {"s_suppkey": "bigint", "s_name": "string", "s_nationkey": "int", "s_acctbal": "double"}


def _delivery(d) -> dict[str, DataFrame]:
    """Reference files as they are delivered: a folder of several files for each table."""
    folder = scratch(d, "refs")
    for name, schema in (("part", PART), ("supplier", SUPPLIER)):
        rows = d.table(name).select(*schema).repartitionByRange(3, next(iter(schema)))
        rows.write.option("header", "true").option("sep", "|").csv(f"{folder}/{name}.csv")
    return files.read_reference_files(d.spark, folder, {"part": PART, "supplier": SUPPLIER})


def _csv_typed(d) -> DataFrame:
    path = scratch(d, "typed")
    d.table("customer").write.option("header", "true").csv(path)
    return files.read_typed(d.spark, path)


def period_source(d) -> DataFrame:
    """Raw sales as a source of files by period."""
    path = scratch(d, "sales")
    rows = d.raw_sales.select("whs", "fcc", "outlet", "units", "period")
    rows.repartition("period").sortWithinPartitions("period", "whs").write.partitionBy("period").parquet(path)
    return d.spark.read.schema(rows.schema).parquet(path)


SALES = ["period", "whs", "fcc", "outlet", "units"]
TX_SALES = "SELECT period_cd AS period, dsupp_proc_id AS whs, pcmdty_id AS fcc, buyer_otlt_cd AS outlet, units FROM tx"

add("src_csv_refs", "p_partkey:i, p_name:s, p_brand:s, p_type:s, p_size:i", lambda d: _delivery(d)["part"],
    f"SELECT {', '.join(PART)} FROM part")
add("src_csv_refs_supplier", "s_suppkey:i, s_name:s, s_nationkey:i, s_acctbal:d", lambda d: _delivery(d)["supplier"],
    f"SELECT {', '.join(SUPPLIER)} FROM supplier")
add("src_csv_inferred", "c_custkey:i, c_name:s, c_nationkey:i, c_acctbal:d, c_mktsegment:s", _csv_typed, "SELECT * FROM customer")
add(
    "src_pushdown_period", "period:s, whs:i, fcc:i, outlet:i, units:i",
    lambda d: files.load_period(period_source(d), "200012", columns=SALES), f"{TX_SALES} WHERE period_cd = '200012'",
)
add(
    "src_pushdown_periods", "period:s, whs:i, fcc:i, outlet:i, units:i",
    lambda d: files.load_periods(
        period_source(d), d.price_list("D").filter("prc_amt > 1500").select(F.col("period_cd").alias("period")), columns=SALES),
    f"{TX_SALES} WHERE period_cd IN (SELECT period_cd FROM list_d WHERE prc_amt > 1500)",
)


def _id_merge(d) -> DataFrame:
    """Half of the products are re-keyed to the product whose id is one higher in the list of ids."""
    return d.products.select(
        F.col("pcmdty_id").alias("pcmdty_id_old"),
        (F.col("pcmdty_id") + F.col("pcmdty_id") % 2 * 100000).alias("pcmdty_id_new"),
    )


add(
    "ref_sales_units", "period_cd:s, fcc:i, wholesaler_code:i, outlet_code:i, sum_units:i",
    lambda d: reference.sales_units(d.raw_sales, d.outlet_view, _id_merge(d), **P),
    """SELECT t.period_cd, t.pcmdty_id + t.pcmdty_id % 2 * 100000 AS fcc, dsupp_proc_id AS wholesaler_code, buyer_otlt_cd AS outlet_code,
         sum(units) AS sum_units
       FROM tx t JOIN outlet_view o ON o.outlet_code - 1000000 = t.buyer_otlt_cd WHERE right(o.outlet_type, 1) = '1'
       GROUP BY ALL HAVING sum(units) > 0""",
)
RAW = (
    "line_id:s, dsupp_proc_id:s, trans_dt:s, store_cd:s, origin_whlslr_id:s, origin_cnpj_fiscal_id:s, icms_typ_cd:s, invc_nbr:s,"
    "origin_dsupp_prod_cd:s, pcmdty_id:i, units_qty:d, pcmdty_qty_mult_fct:d, purchase_prc_amt:d, icms_tax_pct:d, icms_tax_amt:d,"
    "price_discount_pct:d, discount_amt:d, destination_cnpj_fiscal_id:s, destination_dsupp_prod_cd:s,"
    "destination_dsupp_prod_ean_cd:s, SupplierType:i, bridge_type:s, proc_eff_ts:s, src_sys_cd:s, period_dt:s"
)


def _raw_replaced(d) -> DataFrame:
    """A written table, with all its columns, whose last month is replaced by a later delivery."""
    path, rows = scratch(d, "raw"), d.raw_buys
    write_periods(rows, path, "period_dt")
    later = rows.filter((F.col("period_dt") == LAST) & (F.col("purchase_prc_amt") > 50000))
    write_period(later.withColumn("src_sys_cd", F.lit("LATE")), path, LAST, "period_dt")
    return d.spark.read.schema(rows.schema).parquet(path)


add(
    "ref_raw_buys", RAW, _raw_replaced,
    """SELECT * REPLACE (CASE WHEN period_dt = '200108' THEN 'LATE' ELSE src_sys_cd END AS src_sys_cd) FROM raw_buys
       WHERE period_dt <> '200108' OR purchase_prc_amt > 50000""",
)
add(
    "replace_period", "pcmdty_id:i, ppp_prc_amt:d, step_cd:i, period_cd:s",
    lambda d: replace_period(
        d.national, d.national.filter("step_cd = 1").withColumn("step_cd", F.lit(50)),
        period_from="200001", period_to="200112",
    ),
    """SELECT * FROM national WHERE period_cd < '200001'
       UNION ALL SELECT * REPLACE (50 AS step_cd) FROM national WHERE step_cd = 1""",
)
add(
    "ref_dim_outlet",
    "outlet_code:i, outlet_type:s, cnpj_cd:s, cnpj_root_cd:s, outlet_new_type_code:s, is_otlt_chain_ind:i,"
    "fisc_actvty_cd:s, ppp_incl_calc_ind:i, ppp_fisc_actvty_class_cd:s, st_cd:s, is_otlt_delivery_ind:i",
    lambda d: d.outlets, "SELECT * FROM outlets",
)
add(
    "ref_states", "state_code:s, state_desc:s, state_abbrev:s", lambda d: reference.states(d.outlet_view),
    "SELECT DISTINCT st_cd AS state_code, 'State ' || st_shrt_nm AS state_desc, st_shrt_nm AS state_abbrev FROM outlet_view",
)
add(
    "ref_dim_provider",
    "wholesaler_code:i, wholesaler_CGC:s, wholesaler_type:i, distribution_center:s, flag1:s, flag2:s, flag4:s, flag5:s,"
    "ppp_dsupp_typ_cd:s, is_whs_dlvry_ind:i, oac_nm:s",
    lambda d: d.providers, "SELECT * FROM providers",
)


def _bridge(d) -> DataFrame:
    return reference.tax_bridge(d.ncm_attr, d.product_view, d.federal)


BRIDGE = """
bridge AS (
  SELECT DISTINCT a.ncm_cd, p.pcmdty_id, r.ipi_pct, r.pis_cofins_typ_cd, r.pis_cofins_pct
  FROM ncm_attr a LEFT JOIN product_view p ON p.nec4_cd = a.nec4_cd AND p.nfc3_cd = a.nfc3_cd LEFT JOIN federal r ON r.ncm_cd = a.ncm_cd)"""
add(
    "ref_tax_bridge", "ncm_cd:s, pcmdty_id:i, ipi_pct:d, pis_cofins_typ_cd:s, pis_cofins_pct:d", _bridge,
    "SELECT * FROM bridge", ctes=BRIDGE, grain="pack",
)


def _dim_product(d) -> DataFrame:
    view = d.product_view
    ncm_file = view.select("pcmdty_id", F.concat(F.lit("F"), F.col("pcmdty_id") % 5).alias("ncm_cd"))
    pnn = d.products.select("pcmdty_id", F.lower("pack_pnn_flag_cd").alias("pack_pnn_flag_cd"))
    exclusion = d.ncm_attr.select("ncm_cd").distinct().select(
        "ncm_cd", F.when(F.col("ncm_cd") == "N3", "NOMEDICAMENTO").otherwise("X").alias("is_ncm_exclu_ind"),
        F.substring("ncm_cd", 2, 1).cast("int").alias("cst_cd"),
    )
    return reference.dim_product(view, d.product_ext, _bridge(d), ncm_file, pnn, d.ncm_attr, exclusion)


add(
    "ref_dim_product",
    "pcmdty_id:i, prod_desc:s, pack_cd:s, prod_cd:s, manuf_cd:s, atc4_cd:s, nec4_cd:s, app1_cd:s, std_factor:d, mseg3_cd:s,"
    "pck_is_medcn_ind:i, pck_gmrs_class_cd:s, ncm_cd:s, ipi_pct:d, pis_cofins_typ_cd:s, pis_cofins_pct:d, pack_pnn_flag_cd:s,"
    "otc_seg_cd:s, cst_cd:i, is_ncm_exclu_ind:i",
    _dim_product,
    """SELECT p.pcmdty_id, p.prod_brand_nm AS prod_desc, p.pack_code AS pack_cd, p.prod_cd, p.lab_cd AS manuf_cd, p.atc4_cd, p.nec4_cd,
         p.nfc1_cd AS app1_cd, p.std_unit / 100 AS std_factor, ea.pck_mkt_seg_class_3 AS mseg3_cd,
         CASE WHEN ea.pck_medicine_ind = 'MEDICAMENTO' THEN 1 ELSE 0 END AS pck_is_medcn_ind, upper(ea.pck_gmrs_class_cd) AS pck_gmrs_class_cd,
         CASE WHEN n.ncm_cd IS NULL THEN 'F' || (p.pcmdty_id % 5) ELSE n.ncm_cd END AS ncm_cd, n.ipi_pct, n.pis_cofins_typ_cd, n.pis_cofins_pct,
         x.pack_pnn_flag_cd, p.mkt_seg_cd AS otc_seg_cd, coalesce(CAST(c.ncm_cd[2:2] AS INT), 0) AS cst_cd,
         CASE WHEN c.ncm_cd = 'N3' THEN 1 ELSE 0 END AS is_ncm_exclu_ind
       FROM product_view p LEFT JOIN product_ext ea ON ea.pcmdty_id = p.pcmdty_id LEFT JOIN products x ON x.pcmdty_id = p.pcmdty_id
       LEFT JOIN (SELECT pcmdty_id, min(ncm_cd) AS ncm_cd, min(ipi_pct) AS ipi_pct, min(pis_cofins_typ_cd) AS pis_cofins_typ_cd,
                    min(pis_cofins_pct) AS pis_cofins_pct FROM bridge GROUP BY ALL) n ON n.pcmdty_id = p.pcmdty_id
       LEFT JOIN (SELECT max(ncm_cd) AS ncm_cd, nec4_cd, nfc3_cd FROM ncm_attr GROUP BY ALL) c ON c.nec4_cd = p.nec4_cd AND c.nfc3_cd = p.nfc3_cd""",
    ctes=BRIDGE, grain="pack",
)
add(
    "ref_price_lists", "prc_amt:d, pcmdty_id:i, period_cd:s, list:s",
    lambda d: reference.price_list(d.price_feed, "D", from_date="19970101").withColumn("list", F.lit("D"))
    .unionByName(reference.price_list(d.price_feed, "M", from_date="19970101").withColumn("list", F.lit("M")))
    .unionByName(reference.price_list(d.price_feed, "L", from_date="19970101").withColumn("list", F.lit("L"))),
    """SELECT CAST(price AS DECIMAL(18,4)) / 100 AS prc_amt, fcc AS pcmdty_id, price_date[1:6] AS period_cd, price_type AS list
       FROM price_feed WHERE price_type IN ('D', 'M', 'L') AND price_date >= '19970101'""",
)


def _retired(d) -> tuple[DataFrame, DataFrame]:
    """Products with even ids lose their first years, so that some new ids have one price only."""
    stored = d.stored("national")
    last = stored.groupBy("pcmdty_id").agg(F.max("period_cd").alias("_last"))
    national = (
        stored.join(last, "pcmdty_id")
        .filter((F.col("pcmdty_id") % 2 == 1) | (F.col("period_cd") == F.col("_last"))).drop("_last")
    )
    # Each product with an odd id is retired in favour of the next product with an even id.
    pairs = d.products.select(F.col("pcmdty_id").alias("pcmdty_id_old"), (F.col("pcmdty_id") + 1).alias("pcmdty_id_new"))
    return national, pairs.filter(F.col("pcmdty_id_old") % 2 == 1)


def _rekeyed(d) -> tuple[DataFrame, DataFrame]:
    national, pairs = _retired(d)
    current = d.products.filter(F.col("pcmdty_id") % 2 == 0)
    return reference.rekey_products(pairs, current, national, d.geo, period=LAST)


REKEY = """
cur_natl AS (
  SELECT n.* FROM national n JOIN (SELECT pcmdty_id, max(period_cd) AS last FROM national GROUP BY ALL) m ON m.pcmdty_id = n.pcmdty_id
  WHERE n.pcmdty_id % 2 = 1 OR n.period_cd = m.last),
pairs AS (
  SELECT p.pcmdty_id AS o, p.pcmdty_id + 1 AS nw FROM products p WHERE p.pcmdty_id % 2 = 1
  AND p.pcmdty_id NOT IN (SELECT pcmdty_id FROM products WHERE pcmdty_id % 2 = 0)
  AND p.pcmdty_id + 1 IN (SELECT pcmdty_id FROM cur_natl WHERE step_cd = 1 AND period_cd = '200108')
  AND p.pcmdty_id + 1 IN (SELECT pcmdty_id FROM cur_natl GROUP BY pcmdty_id HAVING count(*) = 1))"""
add(
    "ref_id_merge", "pcmdty_id:i, ppp_prc_amt:d, step_cd:i, period_cd:s", lambda d: _rekeyed(d)[0],
    "SELECT n.* REPLACE (coalesce(p.nw, n.pcmdty_id) AS pcmdty_id) FROM cur_natl n LEFT JOIN pairs p ON p.o = n.pcmdty_id",
    ctes=REKEY, grain="pack",
)
add(
    "ref_id_merge_geo", "pcmdty_id:i, geo_lvl_cd:s, ppp_prc_amt:d, wgt_units_qty:i, step_cd:i, sales_units_qty:i, period_cd:s",
    lambda d: _rekeyed(d)[1],
    "SELECT n.* REPLACE (coalesce(p.nw, n.pcmdty_id) AS pcmdty_id) FROM geo n LEFT JOIN pairs p ON p.o = n.pcmdty_id",
    ctes=REKEY, grain="pack",
)
