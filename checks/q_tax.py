"""Tax-adjusted prices.  The SQL spells out every state family on its own."""

from __future__ import annotations


from pyspark.sql import functions as F

from checks.base_sql import NET, avg8, money4, pm
from checks.domain import FIRST, LAST
from checks.registry import QUERIES, add
from pricemill.operators import tax_general as general
from pricemill.operators.tax_medicine import tax_price

P = {"period_from": FIRST, "period_to": LAST}
LINE = (
    "buys_trans_line_id:s, dsupp_proc_id:i, trans_dt:s, seller_otlt_cd:i, buyer_otlt_cd:i, buyer_is_otlt_chain_ind:i,"
    "pcmdty_id:i, seller_is_manuf_ind:i, buyer_is_pharmy_ind:i, dsupp_is_distr_ind:i, ppp_prc_amt:d, period_cd:s,"
    "buyer_st_cd:s, pck_is_medcn_ind:i"
)
LINE_SQL = (
    "upper(line_id) AS buys_trans_line_id, dsupp_proc_id, trans_dt, seller_otlt_cd, buyer_otlt_cd,"
    "is_buyer_chain_ind AS buyer_is_otlt_chain_ind, pcmdty_id, seller_is_manuf_ind, buyer_is_pharmy_ind,"
    "dsupp_is_distr_ind, period_cd, buyer_st_cd"
)
D = "::DOUBLE"
SIX = "('SP','SC','RS','RJ','PR','MG')"
SELLER_RATE = f"CASE WHEN seller_st_cd IN {SIX} THEN 0.07{D} ELSE 0.12{D} END"
GENERIC = "pnn IN ('P','N','T') AND gmrs = 'G'"
LISTED = "pnn IN ('P','N','T') AND gmrs IN ('R','S','G','M')"
INTERNAL = "icms_int_pct / 100"
RHO = (
    f"CASE WHEN manuf = 1 AND intra = 0 AND pnn = 'N' THEN CASE rate WHEN 0.12{D} THEN 0.099{D} WHEN 0.07{D} THEN 0.0934{D}"
    f" WHEN 0.04{D} THEN 0.0904{D} ELSE 0{D} END ELSE {{other}} END"
)


def margin(other: str = "0", original: str = "mva_orig_pct") -> str:
    return (
        f"(CASE WHEN intr = rate THEN {original} WHEN rate = 0.12{D} THEN mva_12_pct WHEN rate = 0.07{D} THEN mva_7_pct"
        f" WHEN rate = 0.04{D} THEN mva_4_pct ELSE {other} END) / 100"
    )


NO_RED = "net * (1 + mva)"
RED = "net * (1 + mva) * (1 - red_mva_pct / 100)"
RM = "m - m * (coalesce(pcm_red_pct, 0) / 100)"
RM_OR_CALC = f"CASE WHEN m = 0 THEN calc ELSE {RM} END"
DIST_IN, DIST_OUT = "manuf = 0 AND intra = 1", "manuf = 0 AND intra = 0"
REF = "ref"
ST = "CASE WHEN exempt THEN 0 WHEN own > st_db THEN 0 ELSE st_db - own END"


FAMILIES: list[str] = []  # keys of all state families


def family(
    key: str,
    states: list[str],
    *,
    intr: str = INTERNAL,
    inside: str = "intr",
    outside: str = SELLER_RATE,
    rho: str = f"0{D}",
    own: str = "CASE WHEN exempt THEN 0 ELSE net * (rate * (1 - rho)) END",
    mva: str = margin(),
    calc: str = NO_RED,
    base: str = RM_OR_CALC,
    st_db: str = "base * intr",
    st: str = ST,
    price: str = "net + st - pis",
    needs_m: bool = True,
    ref: str = "coalesce(ref0, 0)",
) -> None:
    FAMILIES.append(key)
    names = ",".join(f"'{s}'" for s in states)
    m_join = "JOIN" if needs_m else "LEFT JOIN"
    ctes = f"""
refs AS (SELECT fcc, {pm('period', 1)} AS period_cd, {avg8('price')}::DOUBLE AS ref0 FROM sub_national_cpp
         WHERE right(geo_lvl_cd, 1) = 'I' GROUP BY ALL),
s1 AS (
  SELECT t.*, p.pack_pnn_flag_cd AS pnn, p.pck_gmrs_class_cd AS gmrs, t.seller_is_manuf_ind AS manuf, t.trans_is_intra_st_ind AS intra,
    r.icms_int_pct, r.mva_orig_pct, r.mva_12_pct, r.mva_7_pct, r.mva_4_pct, r.red_mva_pct, r.pcm_red_pct, r.trava_pct,
    coalesce(pm.prc_amt, 0)::DOUBLE AS m, coalesce(pd.prc_amt, 0)::DOUBLE AS d, f.ref0, ({NET})::DOUBLE AS net,
    icms_typ_cd = '2' AND t.trans_is_intra_st_ind = 1 AS exempt
  FROM tx t JOIN products p ON p.pcmdty_id = t.pcmdty_id AND p.pck_is_medcn_ind = 1
  JOIN tax_medicine r ON r.pnn_cd = p.pack_pnn_flag_cd AND r.gmrs_cd = p.pck_gmrs_class_cd AND r.st_cd = t.buyer_st_cd
  {m_join} list_m pm ON pm.pcmdty_id = t.pcmdty_id AND pm.period_cd = t.period_cd
  LEFT JOIN list_d pd ON pd.pcmdty_id = t.pcmdty_id AND pd.period_cd = {pm('t.period_cd', -1)}
  LEFT JOIN refs f ON f.fcc = t.pcmdty_id AND f.period_cd = t.period_cd
  WHERE t.buyer_st_cd IN ({names})),
s2 AS (SELECT *, {intr} AS intr, {ref} AS ref, net * CASE WHEN pnn = 'T' THEN 0.0925{D} ELSE 0{D} END AS pis FROM s1),
s3 AS (SELECT *, CASE WHEN intra = 1 THEN {inside} ELSE {outside} END AS rate FROM s2),
s4 AS (SELECT *, {RHO.format(other=rho)} AS rho, {mva} AS mva FROM s3),
s5 AS (SELECT *, {own} AS own, {calc} AS calc FROM s4),
s6 AS (SELECT *, {base} AS base FROM s5),
s7 AS (SELECT *, CASE WHEN exempt THEN 0 ELSE {st_db} END AS st_db FROM s6),
s8 AS (SELECT *, {st} AS st FROM s7)"""
    add(
        key, LINE, lambda d: _family(d, states),
        f"SELECT {LINE_SQL}, {money4(price)} AS ppp_prc_amt, 1 AS pck_is_medcn_ind FROM s8", ctes=ctes,
    )


def _taxed(d):
    return tax_price(
        d.buys_filtered, d.products, d.tax_medicine, d.price_list("M"), d.price_list("D"), d.sub_national_cpp, **P
    )


def _family(d, states):
    return _taxed(d).filter(F.col("buyer_st_cd").isin(*states))


family("tax_reduced_mva", ["AL", "DF", "SE", "TO"], calc=RED)
family("tax_plain_mva", ["MA", "MS", "PB", "PI"])
family("tax_ap", ["AP"], calc=RED, base=f"CASE WHEN {DIST_OUT} THEN {RM} ELSE calc END")
family("tax_mt", ["MT"], mva="mva_orig_pct / 100")
family(
    "tax_pe", ["PE"], mva=f"CASE WHEN {DIST_IN} THEN 0.2294{D} ELSE {margin()} END",
    base=f"CASE WHEN {DIST_IN} THEN calc WHEN m = 0 THEN calc ELSE m END",
)
family("tax_rr", ["RR"], base="CASE WHEN m = 0 THEN calc ELSE 0 END")
family(
    "tax_rj", ["RJ"], outside=f"0.12{D}", rho=f"CASE WHEN {DIST_IN} THEN 0.35{D} ELSE 0{D} END",
    base=f"CASE WHEN {DIST_IN} THEN calc ELSE {RM_OR_CALC} END",
)
family(
    "tax_mg", ["MG"], intr=f"CASE WHEN {GENERIC} THEN 0.12{D} ELSE 0.18{D} END", outside=f"0.12{D}",
    mva=margin("mva_orig_pct"), base=f"CASE WHEN {DIST_OUT} THEN m ELSE calc END",
)
family(
    "tax_pr", ["PR"], inside=f"0.12{D}", outside=f"0.12{D}",
    st=f"""CASE WHEN exempt THEN 0 WHEN base = 0 AND st_db - own < m * 0.056{D} THEN m * 0.056{D}
           WHEN own > st_db THEN 0 ELSE st_db - own END""",
)
family(
    "tax_rs", ["RS"], inside=f"0.12{D}", outside=f"0.12{D}", ref="coalesce(ref0, 0) / 100",
    calc=f"net * (1 + mva) * (1 - CASE WHEN {LISTED} THEN red_mva_pct / 100 ELSE 0 END)",
    base="CASE WHEN ref = 0 THEN calc ELSE ref END", needs_m=False,
)
family(
    "tax_es", ["ES"], mva=margin("mva_orig_pct"), calc=RED, base="CASE WHEN ref = 0 THEN calc ELSE ref END",
    needs_m=False,
)
family(
    "tax_sp", ["SP"], intr=f"CASE WHEN {GENERIC} THEN 0.12{D} ELSE 0.18{D} END", outside=f"0.12{D}",
    ref="coalesce(ref0, 0) / 100", needs_m=False,
    base="""CASE WHEN ref = 0 AND m = 0 THEN calc
              WHEN net >= ref * (trava_pct / 100 * (1 - intr) / (1 - rate)) THEN CASE WHEN m = 0 THEN calc WHEN calc > m THEN m ELSE calc END
              WHEN m = 0 THEN ref WHEN ref > m THEN m ELSE ref END""",
)
family(
    "tax_pa", ["PA"],
    mva=f"""CASE WHEN intr = rate THEN CASE WHEN {DIST_IN} THEN 0.40{D} ELSE mva_orig_pct END WHEN rate = 0.12{D} THEN mva_12_pct / 100
            WHEN rate = 0.07{D} THEN mva_7_pct / 100 WHEN rate = 0.04{D} THEN mva_4_pct / 100 ELSE 0 END""",
    own=f"CASE WHEN exempt THEN 0 ELSE net * (rate * (1 - rho) * (1{D} - CASE WHEN {DIST_IN} THEN 0.52941{D} ELSE 0.2941{D} END)) END",
    calc=f"net * (1 + mva) * (1 - CASE WHEN {DIST_IN} THEN 0.5294{D} ELSE red_mva_pct / 100 END)",
    base=f"CASE WHEN {DIST_IN} THEN calc ELSE {RM_OR_CALC} END",
)
family(
    "tax_rn", ["RN"], calc=RED, base=f"CASE WHEN {DIST_IN} THEN calc ELSE {RM_OR_CALC} END",
    st_db=f"CASE WHEN {DIST_IN} THEN 0 ELSE base * intr END",
    st=f"CASE WHEN exempt THEN 0 WHEN own > st_db THEN 0 WHEN {DIST_IN} THEN net * 0.04{D} ELSE st_db - own END",
)
family("tax_ro", ["RO"], mva=margin("mva_orig_pct"), calc=RED, base="calc")
family(
    "tax_ba", ["BA"], base="m - m * (pcm_red_pct / 100)", st_db="base * intr",
    st=f"""CASE WHEN exempt THEN 0
             WHEN m = 0 THEN greatest(net * 0.16{D}, m * 0.03{D})
             WHEN greatest(net * 0.16{D}, m * 0.03{D}) > (CASE WHEN own > st_db THEN 0 ELSE st_db - own END)
               THEN (CASE WHEN own > st_db THEN 0 ELSE st_db - own END)
             ELSE greatest(net * 0.16{D}, m * 0.03{D}) END""",
)
family("tax_ce", ["CE"], needs_m=False, st=f"CASE WHEN exempt THEN 0 ELSE net * (1{D} + 0.3305{D}) * mva END")
family(
    "tax_ac", ["AC"], needs_m=False, intr=f"CASE WHEN {LISTED} THEN 0.17{D} ELSE 0{D} END",
    st="CASE WHEN exempt THEN 0 ELSE net * mva END",
)
family(
    "tax_am", ["AM"],
    mva=f"""(CASE rate WHEN 0.12{D} THEN mva_12_pct WHEN 0.07{D} THEN mva_7_pct WHEN 0.04{D} THEN mva_4_pct ELSE mva_orig_pct END) / 100""",
    st="CASE WHEN exempt THEN 0 ELSE net * mva END",
)
GO_SC = {
    "intr": f"CASE WHEN {GENERIC} THEN 0.12{D} ELSE 0.17{D} END", "needs_m": False,
    "own": "net * (rate * (1 - rho))", "price": f"net - own - pis + 0.17{D} * d",
}
family(
    "tax_go_sc", ["GO", "SC"],
    inside=f"CASE WHEN buyer_st_cd = 'SC' THEN 0.12{D} ELSE intr END",
    outside=f"CASE WHEN buyer_st_cd = 'SC' THEN 0.12{D} ELSE {SELLER_RATE} END", **GO_SC,
)

# ---- non-medicines -------------------------------------------------------------------------------


def hierarchy(table: str, value: str) -> str:
    def level(n: int, above: str) -> str:
        cond = f"AND dp.pcmdty_id NOT IN (SELECT pcmdty_id FROM {above})" if above else ""
        return (
            f"SELECT DISTINCT dp.pcmdty_id, t.ncm_cd, t.nec_lvl_cd, t.{value} FROM products dp "
            f"JOIN {table} t ON t.ncm_cd = dp.ncm_cd AND t.nec_lvl_cd = dp.nec{n}_cd WHERE true {cond}"
        )

    p = table
    return f"""
{p}_4 AS ({level(4, '')}), {p}_3 AS ({level(3, f'{p}_4')}),
{p}_43 AS (SELECT * FROM {p}_4 UNION ALL SELECT * FROM {p}_3), {p}_2 AS ({level(2, f'{p}_43')}),
{p}_432 AS (SELECT * FROM {p}_43 UNION ALL SELECT * FROM {p}_2), {p}_1 AS ({level(1, f'{p}_432')}),
{p}_all AS (SELECT DISTINCT * FROM (SELECT * FROM {p}_432 UNION ALL SELECT * FROM {p}_1))"""


N = f"""{hierarchy('tipi', 'tipi_excl_cd')},{hierarchy('cest', 'cest_cd')},
icms1 AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY state_cd, ncm_cd ORDER BY cest_cd ASC NULLS FIRST, icms_typ_cd, icms_pct,
            mva_ori_op_intra_st_pct) AS rn FROM icms) WHERE rn = 1),
fed1 AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY ncm_cd ORDER BY ipi_pct DESC NULLS LAST, pis_cofins_typ_cd, pis_cofins_pct) AS rn
          FROM federal) WHERE rn = 1),
nbase AS (
  SELECT t.* EXCLUDE (pck_is_medcn_ind), t.pck_is_medcn_ind, coalesce(p.ncm_cd, 'Carga Média') AS ncm_cd, coalesce(x.tipi_excl_cd, 'NAO') AS ex_na_tipi, p.cst_cd, {NET} AS net_prc
  FROM tx t JOIN products p ON p.pcmdty_id = t.pcmdty_id
  LEFT JOIN (SELECT DISTINCT pcmdty_id, tipi_excl_cd FROM tipi_all) x ON x.pcmdty_id = t.pcmdty_id WHERE t.pck_is_medcn_ind = 0),
ncest AS (
  SELECT b.*, CASE WHEN c.cest_cd IS NOT NULL THEN c.cest_cd WHEN i.ncm_cd = b.ncm_cd THEN coalesce(i.cest_cd, '-') ELSE '-' END AS calc_cest
  FROM nbase b LEFT JOIN (SELECT DISTINCT pcmdty_id, cest_cd FROM cest_all) c ON c.pcmdty_id = b.pcmdty_id
  LEFT JOIN icms1 i ON i.state_cd = b.buyer_st_cd AND i.ncm_cd = b.ncm_cd),
nrate AS (
  SELECT c.*, CASE WHEN cst_cd IN (0, 4, 5, 6, 7) THEN 1 ELSE 0 END AS pck_is_natl_ind,
    CASE WHEN seller_is_manuf_ind = 0 THEN 0 ELSE coalesce(f.ipi_pct, 0) END AS ipi_rt, f.pis_cofins_typ_cd,
    CASE WHEN seller_is_manuf_ind = 0 THEN 0 ELSE f.pis_cofins_pct END AS pis_rt, i.icms_typ_cd AS regime, coalesce(i.icms_pct, 0) AS icms_rt,
    i.mva_ori_op_intra_st_pct, i.mva_adj_op_inter_st_12_pct, i.mva_adj_op_inter_st_7_pct, i.mva_adj_op_inter_st_4_pct, i.intr_red_pct,
    coalesce(i.mva_reductor_pct, 0) AS mva_reductor_pct
  FROM ncest c
  LEFT JOIN icms1 i ON i.state_cd = c.buyer_st_cd AND i.ncm_cd = c.ncm_cd AND coalesce(i.cest_cd, '-') = c.calc_cest
  LEFT JOIN fed1 f ON f.ncm_cd = CASE WHEN ex_na_tipi <> 'NAO' THEN c.ncm_cd || ' - ' || ex_na_tipi ELSE c.ncm_cd END),
nops AS (
  SELECT *, CASE WHEN trans_is_intra_st_ind = 1 THEN icms_rt WHEN pck_is_natl_ind = 0 THEN 0.04{D}
    WHEN seller_st_cd IN {SIX} AND buyer_st_cd NOT IN {SIX} THEN 0.07{D} ELSE 0.12{D} END AS icms_ops FROM nrate),
n3 AS (
  SELECT *, net_prc::DOUBLE AS net, coalesce(CASE WHEN icms_ops = 0.12{D} THEN mva_adj_op_inter_st_12_pct WHEN icms_ops = 0.07{D} THEN mva_adj_op_inter_st_7_pct
      WHEN icms_ops = 0.04{D} THEN mva_adj_op_inter_st_4_pct ELSE mva_ori_op_intra_st_pct END, 0) AS mva,
    CASE WHEN seller_is_manuf_ind = 1 AND trans_is_intra_st_ind = 0 AND pis_cofins_typ_cd = 'Monofásico' THEN
      CASE WHEN pis_rt = 0.125{D} THEN CASE WHEN icms_ops = 0.12{D} THEN 0.1049{D} WHEN icms_ops = 0.07{D} THEN 0.099{D} WHEN icms_ops = 0.04{D} THEN 0.0959{D} ELSE 0{D} END
           WHEN pis_rt = 0.12{D} THEN CASE WHEN icms_ops = 0.12{D} THEN 0.099{D} WHEN icms_ops = 0.07{D} THEN 0.0934{D} WHEN icms_ops = 0.04{D} THEN 0.0904{D} ELSE 0{D} END
           ELSE 0{D} END
      WHEN trans_is_intra_st_ind = 1 THEN coalesce(intr_red_pct, 0) ELSE 0{D} END AS red,
    CASE WHEN pis_cofins_typ_cd = 'D/C' THEN pis_rt ELSE 0 END AS pis FROM nops),
n4 AS (SELECT *, net * ipi_rt AS ipi, icms_ops * (1 - red) AS icms_redu, net * pis AS credit,
         coalesce(regime = 'ST', false) AS is_st, icms_typ_cd = '2' AND trans_is_intra_st_ind = 1 AS ex FROM n3),
n5 AS (SELECT *, CASE WHEN ex AND is_st THEN 0 ELSE net * icms_redu END AS own,
         CASE WHEN is_st THEN (net + ipi) * (1 + mva) * (1 - mva_reductor_pct) ELSE 0 END AS b FROM n4),
n6 AS (SELECT *, CASE WHEN is_st AND ex THEN 0 ELSE b * icms_rt END AS db FROM n5),
n7 AS (SELECT *, CASE WHEN is_st THEN CASE WHEN ex THEN 0 WHEN own > db THEN 0 ELSE db - own END ELSE 0 END AS st FROM n6),
n8 AS (SELECT n7.*, coalesce(l.prc_amt::DOUBLE * (pis + CASE WHEN regime = 'D/C' THEN icms_rt ELSE 0 END), 0) AS resale
       FROM n7 LEFT JOIN list_d l ON l.pcmdty_id = n7.pcmdty_id AND l.period_cd = {pm('n7.period_cd', -1)}),
n9 AS (SELECT *, CASE WHEN is_st THEN net + ipi + st - credit WHEN resale <= credit + own THEN net + ipi ELSE net + ipi - credit - own + resale END AS p FROM n8)"""


def n(key, columns, run, select):
    add(key, columns, run, select, ctes=N, grain="pack")


def _tipi(d):
    return general.most_specific_match(d.products, d.tipi, "tipi_excl_cd")


def _cest(d):
    return general.most_specific_match(d.products, d.cest, "cest_cd")


def _base(d):
    return general.nonmed_base(d.buys_filtered, d.products, _tipi(d), **P)


def _rates(d):
    return general.nonmed_rates(_base(d), _cest(d), d.icms, d.federal)


MATCH = "pcmdty_id:i, ncm_cd:s, nec_lvl_cd:s, "
BASE = "line_id:s, pcmdty_id:i, period_cd:s, buyer_st_cd:s, pur_prc_amt:d, ncm_cd:s, ex_na_tipi:s, cst_cd:i, net_prc:d"
RATES = (
    "line_id:s, pcmdty_id:i, period_cd:s, pur_prc_amt:d, calc_cest:s, pck_is_natl_ind:i, ipi_rt:d, pis_cofins_typ_cd:s, pis_rt:d, regime:s,"
    "icms_rt:d, mva_ori_op_intra_st_pct:d, mva_adj_op_inter_st_12_pct:d, mva_adj_op_inter_st_7_pct:d,"
    "mva_adj_op_inter_st_4_pct:d, intr_red_pct:d, mva_reductor_pct:d"
)
n("hier_lookup_tipi", MATCH + "tipi_excl_cd:s", _tipi, "SELECT * FROM tipi_all")
n("hier_lookup_cest", MATCH + "cest_cd:s", _cest, "SELECT * FROM cest_all")
n("first_rate_per_key", "state_cd:s, ncm_cd:s, cest_cd:s, icms_typ_cd:s, icms_pct:d, mva_reductor_pct:d",
  lambda d: general.first_icms_rate(d.icms), "SELECT * FROM icms1")
n("first_federal_rate", "ncm_cd:s, ipi_pct:d, pis_cofins_typ_cd:s, pis_cofins_pct:d",
  lambda d: general.first_federal_rate(
      d.federal.join(
          d.products.select(F.col("ncm_cd").alias("_ncm")).distinct(),
          F.split("ncm_cd", " - ")[0] == F.col("_ncm"), "left_semi")),
  "SELECT * FROM fed1 WHERE split_part(ncm_cd, ' - ', 1) IN (SELECT ncm_cd FROM products)")
n("nonmed_base", BASE, _base, "SELECT * FROM nbase")
n("nonmed_rates", RATES, _rates, "SELECT * FROM nrate")
n("nonmed_op_rate", RATES + ", icms_ops:d", lambda d: general.nonmed_op_rate(_rates(d)), "SELECT * FROM nops")
n("nonmed_price", LINE,
  lambda d: general.tax_price_nonmed(
      d.buys_filtered, d.products, d.tipi, d.cest, d.icms, d.federal, d.price_list("D"), **P),
  f"SELECT {LINE_SQL}, {money4('p')} AS ppp_prc_amt, pck_is_medcn_ind FROM n9")
