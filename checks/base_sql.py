"""The domain tables as DuckDB common table expressions, written independently of the Spark code."""

from __future__ import annotations

STATES = (
    "AL DF SE MA MS PB AP MT PE RR RJ MG PR RS ES SP PA RN RO BA CE AC AM GO SC".split()
)


def state(expr: str) -> str:
    return "(['" + "','".join(STATES) + f"'])[CAST({expr} AS INT) + 1]"


def pm(period: str, n: int) -> str:
    """Month shift."""
    return f"strftime(strptime({period} || '01', '%Y%m%d') + INTERVAL ({n}) MONTH, '%Y%m')"


def i8(x: str) -> str:
    """A decimal as an integer number of 1e-8."""
    return f"CAST(CAST({x} AS DECIMAL(22,8)) * 100000000 AS HUGEINT)"


def div8(num: str, den: str) -> str:
    """Exact half-up quotient of integers, in units of 1e-8."""
    return f"CAST(((2 * ({num}) + ({den})) // (2 * ({den})))::DOUBLE / 1e8 AS DECIMAL(22,8))"


def avg8(x: str) -> str:
    return div8(f"sum({i8(x)})", f"count({x})")


def avg_at(x: str, digits: int) -> str:
    """Mean of 8-digit decimals, rounded half-up to fewer digits."""
    unit = 10 ** (8 - digits)
    return (
        f"CAST(((2 * sum({i8(x)}) + count({x}) * {unit}) // (2 * count({x}) * {unit}))::DOUBLE"
        f" / {10 ** digits} AS DECIMAL(22,{digits}))"
    )


def wavg8(p: str, u: str) -> str:
    """Weighted mean, 0 without weight."""
    den = f"CAST(sum({u}) AS HUGEINT)"
    return (
        f"CASE WHEN sum({u}) = 0 THEN CAST(0 AS DECIMAL(22,8)) ELSE "
        + div8(f"sum({i8(p)} * CAST({u} AS HUGEINT))", den)
        + " END"
    )


def ratio8(a: str, b: str) -> str:
    """Half-up quotient of two 4-digit decimals, to 8 digits; null if the divisor is 0."""
    x = f"CAST(CAST({a} AS DECIMAL(18,4)) * 10000 AS HUGEINT)"
    y = f"CAST(CAST({b} AS DECIMAL(18,4)) * 10000 AS HUGEINT)"
    return f"CASE WHEN {b} = 0 THEN NULL ELSE " + div8(f"{x} * 100000000", y) + " END"


def share12(a: str, b: str) -> str:
    """Half-up quotient of two 4-digit decimals, to 12 digits."""
    x = f"CAST(CAST({a} AS DECIMAL(18,4)) * 10000 AS HUGEINT)"
    y = f"CAST(CAST({b} AS DECIMAL(18,4)) * 10000 AS HUGEINT)"
    num = f"(2 * {x} * 1000000000000 + {y})"
    return f"CAST(CAST({num} // (2 * {y}) AS DECIMAL(38,0)) * CAST(0.000000000001 AS DECIMAL(12,12)) AS DECIMAL(30,12))"


def money4(x: str) -> str:
    return f"CAST(floor(({x}) * 10000 + 0.5) / 10000 AS DECIMAL(18,4))"


NET = (
    "CAST(pur_prc_amt - CAST(pur_prc_amt * CAST(prc_disc_pct AS DECIMAL(9,4)) * 0.01 AS DECIMAL(22,8))"
    " AS DECIMAL(22,8))"
)

CUSTOMER_ID = (
    "(CASE WHEN {k} % 10 = 7 THEN 'BN' || lpad(CAST({k} // 100 AS VARCHAR), 6, '0') "
    "ELSE 'C' || lpad(CAST({k} // 100 AS VARCHAR), 7, '0') END "
    "|| lpad(CAST({k} % 100 AS VARCHAR), 6, '0'))"
)
SUPPLIER_ID = "('S' || lpad(CAST({k} AS VARCHAR), 7, '0') || '000100')"


def class_of(key: str) -> str:
    return (
        f"CASE {key} % 8 WHEN 5 THEN 'WHOLESALER' WHEN 6 THEN 'OUTROS' ELSE 'PHARMACY' END"
    )


def base(grain: str = "name") -> str:
    keys = "p_name" if grain == "name" else "p_name, p_type"
    on = "p.p_name = f.p_name" + ("" if grain == "name" else " AND p.p_type = f.kind")
    national_price = f"CAST({wavg8('pur_prc_amt', 'units')} AS DECIMAL(18,4))"
    return f"""
first_parts AS (
  SELECT p_name, min(p_partkey) AS pk, arg_min(p_brand, p_partkey) AS brand,
         arg_min(p_type, p_partkey) AS kind, arg_min(p_size, p_partkey) AS size,
         arg_min(p_retailprice, p_partkey) AS retail
  FROM part GROUP BY {keys}),
products AS (
  SELECT CAST(pk + 1 AS INT) AS pcmdty_id, p_name AS prod_desc, CAST(pk + 1 AS VARCHAR) AS pack_cd,
    p_name AS prod_cd, CASE WHEN brand = 'Brand#1' THEN '4581' ELSE brand END AS manuf_cd,
    CASE WHEN size % 50 = 0 THEN 'Z98A2' ELSE kind || '-' || size END AS atc4_cd,
    kind || '-' || (size // 10) AS atc3_cd, kind AS atc2_cd, kind[1] AS atc1_cd,
    CASE WHEN size % 50 = 0 THEN 'Z98A2' ELSE kind || '-' || size END AS nec4_cd,
    kind || '-' || (size // 10) AS nec3_cd, kind AS nec2_cd, kind[1] AS nec1_cd,
    CASE WHEN size % 17 <> 0 THEN CAST(size % 5 AS VARCHAR) END AS app1_cd,
    CAST(size % 3 AS VARCHAR) AS mseg3_cd, CASE WHEN size <= 25 THEN 1 ELSE 0 END AS pck_is_medcn_ind,
    (['G','M','R','S'])[CAST(pk % 4 AS INT) + 1] AS pck_gmrs_class_cd,
    (['P','N','T'])[CAST(pk % 3 AS INT) + 1] AS pack_pnn_flag_cd,
    CAST(size % 2 AS VARCHAR) AS otc_seg_cd,
    CASE WHEN pk % 11 <> 0 THEN 'N' || (pk % 7) END AS ncm_cd, CAST(pk % 9 AS INT) AS cst_cd,
    CAST(retail AS DECIMAL(18,4)) AS retail
  FROM first_parts),
part_ids AS (
  SELECT p.p_partkey, CAST(f.pk + 1 AS INT) AS pcmdty_id,
         CASE WHEN f.size <= 25 THEN 1 ELSE 0 END AS pck_is_medcn_ind
  FROM part p JOIN first_parts f ON {on}),
outlet_view AS (
  SELECT c_custkey + 1000001 AS outlet_code, CASE WHEN c_custkey % 10 = 7 THEN '41' ELSE '11' END AS outlet_type,
    {CUSTOMER_ID.format(k='c_custkey')} AS cnpj,
    CASE WHEN c_mktsegment IN ('BUILDING','AUTOMOBILE') THEN 'R' ELSE 'I' END AS other4,
    (['FN','A2','FA','FW','J','B6','ZZ','FN'])[CAST(c_custkey % 8 AS INT) + 1] AS outlet_fiscal_activity_code,
    CAST(c_nationkey AS VARCHAR) AS st_cd, {state('c_nationkey')} AS st_shrt_nm
  FROM customer
  UNION ALL
  SELECT s_suppkey + 1001000000, '32', {SUPPLIER_ID.format(k='s_suppkey')}, 'R',
    CASE WHEN s_suppkey % 3 = 0 THEN 'T' ELSE 'B7' END, CAST(s_nationkey AS VARCHAR), {state('s_nationkey')}
  FROM supplier),
-- fixed values: the classes of fiscal activity codes
activity_class (code, class) AS (
  VALUES ('A2', 'PHARMACY'), ('FA', 'PHARMACY'), ('FN', 'PHARMACY'), ('FW', 'PHARMACY'), ('J', 'PHARMACY'),
    ('T', 'MANUFACTURER'), ('B6', 'WHOLESALER'), ('B7', 'WHOLESALER')),
outlets AS (
  SELECT outlet_code - 1000000 AS outlet_code, outlet_type, cnpj AS cnpj_cd, cnpj[1:8] AS cnpj_root_cd,
    'T' || other4 AS outlet_new_type_code, CASE WHEN other4 = 'I' THEN 0 ELSE 1 END AS is_otlt_chain_ind,
    outlet_fiscal_activity_code AS fisc_actvty_cd, CAST(class IS NOT NULL AS INT) AS ppp_incl_calc_ind,
    coalesce(class, 'OUTROS') AS ppp_fisc_actvty_class_cd,
    st_shrt_nm AS st_cd, CASE WHEN cnpj[1:2] = 'BN' AND outlet_type = '41' THEN 1 ELSE 0 END AS is_otlt_delivery_ind
  FROM outlet_view LEFT JOIN activity_class ON activity_class.code = outlet_fiscal_activity_code),
states AS (SELECT {state('n_nationkey')} AS state_abbrev FROM nation),
provider_view AS (
  SELECT CAST(s_suppkey AS INT) AS wholesaler_code,
    CASE WHEN s_suppkey % 3 = 1 THEN {CUSTOMER_ID.format(k='s_suppkey')} ELSE {SUPPLIER_ID.format(k='s_suppkey')} END AS wholesaler_CGC,
    CAST(s_suppkey % 2 + 1 AS INT) AS wholesaler_type, CAST(s_suppkey % 4 AS VARCHAR) AS distribution_center,
    CASE WHEN s_suppkey % 3 = 1 AND s_suppkey % 2 = 0 THEN 'P' ELSE ' ' END AS flag1,
    CASE WHEN s_suppkey % 6 = 1 THEN 'D' ELSE ' ' END AS flag2,
    CASE WHEN s_suppkey % 7 <> 0 THEN 'W' ELSE ' ' END AS flag4,
    CASE WHEN s_suppkey % 3 = 1 AND s_suppkey % 6 <> 1 THEN 'F' ELSE ' ' END AS flag5, s_name AS oac_nm
  FROM supplier),
providers AS (
  SELECT wholesaler_code, wholesaler_CGC, wholesaler_type, distribution_center, flag1, flag2, flag4, flag5,
    -- fixed values: what the first flag that is set says of a provider
    coalesce((['PHARMACY', 'PHARMACY', 'PHARMACY', 'WHOLESALER'])[list_position([flag5 = 'F', flag2 = 'D', flag1 <> ' ', flag4 = 'W'], true)],
      'N/C') AS ppp_dsupp_typ_cd,
    CASE WHEN flag2 = 'D' THEN 1 ELSE 0 END AS is_whs_dlvry_ind, oac_nm
  FROM provider_view WHERE wholesaler_code NOT IN (260, 261, 1261)),
months AS (
  SELECT strftime(d, '%Y%m') AS period_cd, month(d) - 1 AS m
  FROM generate_series(TIMESTAMP '1994-12-01', TIMESTAMP '2001-08-01', INTERVAL 1 MONTH) g(d)),
list_d AS (SELECT pcmdty_id, period_cd, CAST(retail * 60 + m * 10 AS DECIMAL(18,4)) AS prc_amt
           FROM products, months WHERE pcmdty_id % 13 <> 0),
list_l AS (SELECT pcmdty_id, period_cd, CAST(retail * 100 + m * 10 AS DECIMAL(18,4)) AS prc_amt
           FROM products, months WHERE pcmdty_id % 17 <> 1),
list_m AS (SELECT pcmdty_id, period_cd,
             CAST(CASE WHEN pcmdty_id % 10 = 0 THEN 0 ELSE retail * 110 + m * 10 END AS DECIMAL(18,4)) AS prc_amt
           FROM products, months),
class_bands AS (SELECT * FROM (VALUES ('G', 1, 95), ('M', 1, 90), ('R', 1, 85)) t(pck_gmrs_class_cd, gmrs_min_pct, gmrs_max_pct)),
tax_medicine AS (
  SELECT {state('n')} AS st_cd, (['P','N','T'])[i + 1] AS pnn_cd, (['G','M','R','S'])[j + 1] AS gmrs_cd,
    CAST(12 + (n + j) % 7 AS DOUBLE) AS icms_int_pct, CAST(30 + n + i * 3 AS DOUBLE) AS mva_orig_pct,
    CAST(35 + n + j AS DOUBLE) AS mva_12_pct, CAST(40 + n + j AS DOUBLE) AS mva_7_pct,
    CAST(45 + n + j AS DOUBLE) AS mva_4_pct, CAST(CASE WHEN j = 3 THEN 0 ELSE 10 + i END AS DOUBLE) AS red_mva_pct,
    CAST(CASE WHEN i <> 2 THEN j * 5 END AS DOUBLE) AS pcm_red_pct, CAST(80 + i * 2 AS DOUBLE) AS trava_pct
  FROM (SELECT CAST(n_nationkey AS INT) AS n FROM nation), (SELECT unnest([0,1,2]) AS i), (SELECT unnest([0,1,2,3]) AS j)),
tx AS (
  SELECT l_orderkey || '-' || l_linenumber AS line_id, CAST(l_suppkey AS INT) AS dsupp_proc_id,
    strftime(l_shipdate, '%Y%m%d') AS trans_dt, strftime(o_orderdate, '%Y%m') AS period_cd, pcmdty_id, pck_is_medcn_ind,
    CAST(l_extendedprice AS DECIMAL(18,4)) AS pur_prc_amt, CAST(l_discount * 100 AS DECIMAL(18,4)) AS prc_disc_pct,
    CAST(l_tax * 100 AS DECIMAL(18,4)) AS icms_tax_pct, CAST(l_quantity AS INT) AS units,
    CASE WHEN l_linestatus = 'O' THEN '2' ELSE '1' END AS icms_typ_cd, CAST(o_custkey + 1 AS INT) AS buyer_otlt_cd,
    CAST(l_suppkey + 1000000000 AS INT) AS seller_otlt_cd, {state('c_nationkey')} AS buyer_st_cd,
    {state('s_nationkey')} AS seller_st_cd,
    CASE WHEN c_mktsegment IN ('BUILDING','AUTOMOBILE') THEN 1 ELSE 0 END AS is_buyer_chain_ind,
    {class_of('o_custkey')} AS buyer_ppp_typ_cd,
    CASE WHEN l_suppkey % 3 = 0 THEN 'MANUFACTURER' ELSE 'WHOLESALER' END AS seller_ppp_typ_cd,
    CASE WHEN l_suppkey % 3 = 0 THEN 1 ELSE 0 END AS seller_is_manuf_ind,
    CASE WHEN o_custkey % 8 NOT IN (5, 6) THEN 1 ELSE 0 END AS buyer_is_pharmy_ind,
    CASE WHEN c_nationkey = s_nationkey THEN 1 ELSE 0 END AS trans_is_intra_st_ind,
    CASE WHEN l_suppkey % 5 = 0 THEN 1 ELSE 0 END AS dsupp_is_assc_ind,
    CASE WHEN l_suppkey % 2 = 0 THEN 1 ELSE 0 END AS dsupp_is_distr_ind,
    CASE WHEN l_suppkey % 2 = 0 THEN 'WHOLESALER' ELSE 'PHARMACY' END AS ppp_dsupp_typ_cd,
    l_returnflag, l_linenumber, o_custkey, l_suppkey, l_orderkey
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
  JOIN supplier ON s_suppkey = l_suppkey JOIN part_ids ON p_partkey = l_partkey),
priced AS (SELECT * REPLACE (CASE WHEN icms_tax_pct >= 8 THEN CAST(0.04 AS DECIMAL(18,4)) ELSE pur_prc_amt END AS pur_prc_amt) FROM tx),
tax_calc AS (SELECT line_id AS buys_trans_line_id, is_buyer_chain_ind AS buyer_is_otlt_chain_ind,
             CAST({NET} AS DECIMAL(18,4)) AS ppp_prc_amt, tx.* FROM tx),
clean AS (SELECT * FROM tax_calc WHERE l_returnflag <> 'R'),
sales AS (SELECT period_cd, pcmdty_id AS fcc, dsupp_proc_id AS wholesaler_code, buyer_otlt_cd AS outlet_code,
            CAST(sum(units) AS INT) AS sum_units FROM tx GROUP BY ALL),
raw_buys AS (
  SELECT upper('L' || line_id) AS line_id, CAST(dsupp_proc_id AS VARCHAR) AS dsupp_proc_id, trans_dt,
    CAST(o_custkey AS VARCHAR) AS store_cd, CAST(l_suppkey AS VARCHAR) AS origin_whlslr_id,
    CASE WHEN dsupp_is_assc_ind = 1 OR l_suppkey % 3 = 1 THEN {SUPPLIER_ID.format(k='l_suppkey')} ELSE {CUSTOMER_ID.format(k='o_custkey')} END AS origin_cnpj_fiscal_id,
    icms_typ_cd, CAST(l_orderkey AS VARCHAR) AS invc_nbr, CAST(pcmdty_id AS VARCHAR) AS origin_dsupp_prod_cd, pcmdty_id,
    CAST(units AS DECIMAL(18,4)) AS units_qty, CAST(0 AS DECIMAL(18,4)) AS icms_tax_amt, CAST(0 AS DECIMAL(18,4)) AS discount_amt,
    CAST(pcmdty_id AS VARCHAR) AS destination_dsupp_prod_cd, CAST(pcmdty_id AS VARCHAR) AS destination_dsupp_prod_ean_cd,
    '2001-08-01 00:00:00' AS proc_eff_ts,
    CAST(l_linenumber % 3 AS DECIMAL(18,4)) AS pcmdty_qty_mult_fct, pur_prc_amt AS purchase_prc_amt, icms_tax_pct,
    prc_disc_pct AS price_discount_pct, {CUSTOMER_ID.format(k='o_custkey')} AS destination_cnpj_fiscal_id,
    dsupp_is_assc_ind + 1 AS SupplierType, CASE WHEN l_linenumber = 7 THEN 'Pending' ELSE 'Bridged-ok' END AS bridge_type,
    'LOAD' AS src_sys_cd, period_cd AS period_dt
  FROM tx),
provider_factors AS (SELECT CAST(s_suppkey AS VARCHAR) AS dsupp_proc_id, CAST(s_suppkey % 3 + 1 AS DECIMAL(18,4)) AS pcmdty_qty_mult_fct
                     FROM supplier WHERE s_suppkey % 9 = 0),
buys AS (
  SELECT lower(r.line_id) AS line_id, CAST(r.dsupp_proc_id AS INT) AS dsupp_proc_id, trans_dt, store_cd,
    origin_cnpj_fiscal_id AS orig_cnpj_fiscal_id, icms_typ_cd, invc_nbr, pcmdty_id, units_qty,
    coalesce(f.pcmdty_qty_mult_fct, r.pcmdty_qty_mult_fct) AS pcmdty_qty_mult_fct, purchase_prc_amt AS pur_prc_amt,
    icms_tax_pct, price_discount_pct AS prc_disc_pct, destination_cnpj_fiscal_id AS dest_cnpj_fiscal_id,
    CASE WHEN SupplierType = 2 THEN 1 ELSE 0 END AS dsupp_is_assc_ind, bridge_type AS prod_brdg_stat_cd,
    origin_whlslr_id AS orig_whlslr_id, origin_dsupp_prod_cd AS orig_dsupp_prod_cd, icms_tax_amt, discount_amt AS disc_amt,
    destination_dsupp_prod_cd AS dest_dsupp_prod_cd, destination_dsupp_prod_ean_cd AS dest_dsupp_prod_ean_cd, proc_eff_ts,
    'b1' AS btch_id, period_dt AS period_cd
  FROM raw_buys r LEFT JOIN provider_factors f ON r.dsupp_proc_id = f.dsupp_proc_id),
national AS (
  SELECT pcmdty_id, {national_price} AS ppp_prc_amt,
    CASE WHEN count(*) >= 2 THEN 1 WHEN max(l_linenumber) = 1 THEN 50 WHEN max(l_linenumber) = 2 THEN 51
         WHEN max(l_linenumber) = 3 THEN 102 WHEN max(l_linenumber) = 4 THEN 2 ELSE 1 END AS step_cd, period_cd
  FROM tx GROUP BY pcmdty_id, period_cd),
geo AS (
  SELECT pcmdty_id, buyer_st_cd || CASE WHEN is_buyer_chain_ind = 1 THEN 'R' ELSE 'I' END AS geo_lvl_cd,
    {national_price} AS ppp_prc_amt, CAST(sum(CASE WHEN l_returnflag <> 'R' THEN units ELSE 0 END) AS BIGINT) AS wgt_units_qty,
    CASE WHEN count(*) = 1 AND max(l_linenumber) = 1 THEN 50 ELSE 1 END AS step_cd,
    CAST(sum(units) AS BIGINT) AS sales_units_qty, period_cd
  FROM tx GROUP BY ALL),
price_feed AS (
  SELECT CAST(prc_amt * 100 AS INT) AS price, pcmdty_id AS fcc, period_cd || '01' AS price_date, 'D' AS price_type FROM list_d
  UNION ALL SELECT CAST(prc_amt * 100 AS INT), pcmdty_id, period_cd || '01', 'M' FROM list_m
  UNION ALL SELECT CAST(prc_amt * 100 AS INT), pcmdty_id, period_cd || '01', 'L' FROM list_l
  UNION ALL SELECT CAST(CAST(ppp_prc_amt AS DECIMAL(18,2)) * 100 + CASE WHEN pcmdty_id % 5 = 0 THEN 1 ELSE 0 END AS INT), pcmdty_id,
    period_cd || '01', CASE WHEN pcmdty_id % 4 = 0 THEN 'J' ELSE 'C' END FROM national),
product_view AS (
  SELECT pcmdty_id, prod_desc AS prod_brand_nm, pack_cd AS pack_code, prod_cd, manuf_cd AS lab_cd, atc4_cd, atc3_cd, atc2_cd,
    atc1_cd, nec4_cd, nec3_cd, nec2_cd, nec1_cd, app1_cd AS nfc1_cd, mseg3_cd AS nfc3_cd, pcmdty_id % 40 + 1 AS std_unit,
    otc_seg_cd AS mkt_seg_cd, 'PACK ' || prod_desc AS stdiz_pcmdty_nm, manuf_cd[1:5] AS pri_org_short_nm, manuf_cd AS pri_org_nm,
    CASE WHEN pcmdty_id % 6 <> 0 THEN pck_gmrs_class_cd END AS gmrs_cd, 'Class ' || atc1_cd AS atc1_nm
  FROM products),
product_ext AS (
  SELECT pcmdty_id, mseg3_cd AS pck_mkt_seg_class_3, CASE WHEN pck_is_medcn_ind = 1 THEN 'MEDICAMENTO' ELSE 'NAO' END AS pck_medicine_ind,
    lower(pck_gmrs_class_cd) AS pck_gmrs_class_cd FROM products),
ncm_attr AS (SELECT DISTINCT ncm_cd, nec4_cd, mseg3_cd AS nfc3_cd FROM products WHERE ncm_cd IS NOT NULL),
class_levels AS (
  SELECT pcmdty_id, ncm_cd, 1 AS n, nec1_cd AS c FROM products UNION ALL SELECT pcmdty_id, ncm_cd, 2, nec2_cd FROM products
  UNION ALL SELECT pcmdty_id, ncm_cd, 3, nec3_cd FROM products UNION ALL SELECT pcmdty_id, ncm_cd, 4, nec4_cd FROM products),
tipi AS (SELECT DISTINCT ncm_cd, c AS nec_lvl_cd, 'EX' || n AS tipi_excl_cd FROM class_levels WHERE ncm_cd IS NOT NULL AND (pcmdty_id + n) % 3 = 0),
cest AS (SELECT DISTINCT ncm_cd, c AS nec_lvl_cd, 'K' || n AS cest_cd FROM class_levels WHERE ncm_cd IS NOT NULL AND (pcmdty_id + n) % 2 = 0),
icms AS (
  SELECT {state('n')} AS state_cd, 'N' || c AS ncm_cd, CASE WHEN (c + r) % 4 <> 0 THEN 'K' || ((c + r) % 4) END AS cest_cd,
    CASE WHEN (n + c + r) % 2 = 0 THEN 'ST' ELSE 'D/C' END AS icms_typ_cd, (12 + (n + c) % 7) / 100 AS icms_pct,
    (30 + n) / 100 AS mva_ori_op_intra_st_pct, (40 + n) / 100 AS mva_adj_op_inter_st_12_pct,
    (50 + n) / 100 AS mva_adj_op_inter_st_7_pct, (60 + n) / 100 AS mva_adj_op_inter_st_4_pct,
    CASE WHEN c <> 3 THEN c * 2 / 100 END AS intr_red_pct, CASE WHEN c <> 5 THEN c / 100 END AS mva_reductor_pct
  FROM (SELECT CAST(n_nationkey AS INT) AS n FROM nation), (SELECT unnest([0,1,2,3,4,5,6]) AS c), (SELECT unnest([0,1]) AS r)
  WHERE r = 0 OR n % 2 = 0),
federal AS (
  SELECT 'N' || c || CASE WHEN x = 1 THEN ' - EX2' ELSE '' END AS ncm_cd, (5 + c + x) / 100 AS ipi_pct,
    (['D/C','Monofásico','Outro'])[(c + x) % 3 + 1] AS pis_cofins_typ_cd,
    CAST(CASE WHEN (c + x) % 3 = 1 THEN CASE WHEN c % 2 = 0 THEN 0.125 ELSE 0.12 END ELSE 0.0925 END AS DOUBLE) AS pis_cofins_pct
  FROM (SELECT unnest([0,1,2,3,4,5]) AS c), (SELECT unnest([0,1,0]) AS x)),
sub_national_cpp AS (
  SELECT pcmdty_id AS fcc, period_cd AS period, g AS geo_lvl_cd,
    CAST(prc_amt * 100 + CASE WHEN g = 'RJI' THEN 700 ELSE 0 END AS DECIMAL(18,4)) AS price
  FROM list_d, (SELECT unnest(['SPI','RJI','SPR']) AS g) WHERE pcmdty_id % 3 <> 0),
corrections AS (
  SELECT CASE WHEN p_partkey % 31 = 0 THEN '199001' WHEN p_partkey % 37 = 0 THEN NULL
              ELSE '200' || (p_partkey % 2) || lpad(CAST(p_partkey % 7 + 1 AS VARCHAR), 2, '0') END AS period_cd,
    CASE WHEN p_partkey % 41 <> 0 THEN CAST(p_partkey % 500 + 1 AS INT) END AS pcmdty_id,
    CAST(CASE WHEN p_partkey % 43 = 0 THEN -p_retailprice WHEN p_partkey % 47 <> 0 THEN p_retailprice END AS DECIMAL(18,4)) AS prc_amt
  FROM part)"""
