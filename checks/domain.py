"""The domain tables, derived from the star-schema tables of a test data folder.

Two product grains: ``name`` (dense: many lines per product and month) and ``pack`` (name and type:
sparse histories with gaps).  Everything is computed from all rows of the given tables.
"""

from __future__ import annotations

from functools import cached_property, lru_cache

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pricemill.functions.bounded import times
from pricemill.functions.numbers import PRICE, weighted_mean
from pricemill.functions.periods import month_number, months_between_list, with_months
from pricemill.operators.buys import flag
from pricemill.session import configure, write_out

# State of each nation key.
STATES = (
    "AL", "DF", "SE", "MA", "MS", "PB", "AP", "MT", "PE", "RR", "RJ", "MG", "PR", "RS", "ES", "SP",
    "PA", "RN", "RO", "BA", "CE", "AC", "AM", "GO", "SC",
)
FIRST, LAST = "199501", "200108"
SUPPLIER_OUTLETS = 1_000_000_000
ACTIVITIES = ("FN", "A2", "FA", "FW", "J", "B6", "ZZ", "FN")
CLASSES = ("PHARMACY", "PHARMACY", "PHARMACY", "PHARMACY", "PHARMACY", "WHOLESALER", "OUTROS", "PHARMACY")

# What clean lines and sales need of the lines.
TRADED = (
    "period_cd", "pcmdty_id", "dsupp_proc_id", "buyer_otlt_cd", "units", "trans_dt", "seller_otlt_cd", "is_buyer_chain_ind",
    "pur_prc_amt", "prc_disc_pct", "buyer_st_cd", "buyer_is_pharmy_ind", "pck_is_medcn_ind", "l_returnflag",
)


def pick(values: tuple, index: Column) -> Column:
    return F.element_at(F.split(F.lit(",".join(values)), ","), index.cast("int") + 1)


def text(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


_DOMAINS: dict[tuple[str, str, str], "Domain"] = {}


def domain(spark: SparkSession, sf_dir: str, grain: str) -> "Domain":
    """The domain of a folder; its lazy frames are built once per application, its stored ones per query."""
    key = (spark.sparkContext.applicationId, sf_dir, grain)
    if key not in _DOMAINS:
        _DOMAINS[key] = Domain(spark, sf_dir, grain)
    _DOMAINS[key].forget_stored()
    return _DOMAINS[key]


class Domain:
    def __init__(self, spark: SparkSession, sf_dir: str, grain: str = "name"):
        self.spark = configure(spark)
        self.sf_dir = sf_dir
        self.grain = grain
        self._stored: dict[str, DataFrame] = {}
        self._derived: dict[str, Domain] = {}
        self._tables: dict[str, DataFrame] = {}
        self.product_keys = ["p_name"] if grain == "name" else ["p_name", "p_type"]

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    def forget_stored(self) -> None:
        self._stored, self._derived = {}, {}

    def stored(self, name: str) -> DataFrame:
        """A domain table as it would be read from storage: written once, then read by all branches."""
        if name not in self._stored:
            self._stored[name] = write_out(getattr(self, name))
        return self._stored[name]

    def stored_list(self, kind: str) -> DataFrame:
        """A price list as it would be read from storage, with its own size instead of that of the parts behind it."""
        if kind not in self._stored:
            self._stored[kind] = write_out(self.price_list(kind))
        return self._stored[kind]

    def both_sides(self) -> tuple[DataFrame, DataFrame]:
        """Clean lines and sales, from lines that are written once for both."""
        if "both" not in self._stored:
            self._stored["both"] = write_out(self.tx.select(*TRADED))
            self._stored["clean"] = self._clean_lines(self._stored["both"])
            self._stored["sales"] = write_out(self._sold(self._stored["both"]))
        return self._stored["clean"], self._stored["sales"]

    def filtered_and_sold(self) -> tuple[DataFrame, DataFrame]:
        """Cleaned purchase lines and sales, from lines that are written once for both."""
        from pricemill.operators.buys import FILTERED

        if "filtered" not in self._stored:
            lines = write_out(self.tx.select(*FILTERED, "units"))
            self._stored["filtered"] = lines.select(*FILTERED)
            self._stored["sales"] = write_out(self._sold(lines))
        return self._stored["filtered"], self._stored["sales"]

    # ---- dimensions ------------------------------------------------------------------------------

    @cached_property
    def _first_parts(self) -> DataFrame:
        """The part with the smallest key stands for its product."""
        row = F.min(F.struct("p_partkey", "p_brand", "p_type", "p_size", "p_retailprice"))
        return self.table("part").groupBy(*[F.col(k).alias(f"k_{k}") for k in self.product_keys]).agg(
            row.alias("r")
        )

    @cached_property
    def products(self) -> DataFrame:
        size, key = F.col("r.p_size"), F.col("r.p_partkey")
        kind = F.col("r.p_type")
        return self._first_parts.select(
            (key + 1).cast("int").alias("pcmdty_id"),
            F.col("k_p_name").alias("prod_desc"),
            text(key + 1).alias("pack_cd"),
            F.col("k_p_name").alias("prod_cd"),
            F.when(F.col("r.p_brand") == "Brand#1", "4581").otherwise(F.col("r.p_brand")).alias("manuf_cd"),
            *[
                c.alias(f"{prefix}{level}_cd")
                for prefix in ("atc", "nec")
                for level, c in (
                    (4, F.when(size % 50 == 0, "Z98A2").otherwise(F.concat_ws("-", kind, text(size)))),
                    (3, F.concat_ws("-", kind, text(F.floor(size / 10)))),
                    (2, kind),
                    (1, F.substring(kind, 1, 1)),
                )
            ],
            F.when(size % 17 != 0, text(size % 5)).alias("app1_cd"),
            text(size % 3).alias("mseg3_cd"),
            flag(size <= 25).alias("pck_is_medcn_ind"),
            pick(("G", "M", "R", "S"), key % 4).alias("pck_gmrs_class_cd"),
            pick(("P", "N", "T"), key % 3).alias("pack_pnn_flag_cd"),
            text(size % 2).alias("otc_seg_cd"),
            F.when(key % 11 != 0, F.concat(F.lit("N"), text(key % 7))).alias("ncm_cd"),
            (key % 9).cast("int").alias("cst_cd"),
            F.col("r.p_retailprice").cast(PRICE).alias("retail"),
        )

    @cached_property
    def part_ids(self) -> DataFrame:
        part = self.table("part").select(
            F.col("p_partkey").alias("l_partkey"), *[F.col(k).alias(f"k_{k}") for k in self.product_keys]
        )
        ids = self._first_parts.select(
            *[f"k_{k}" for k in self.product_keys], (F.col("r.p_partkey") + 1).cast("int").alias("pcmdty_id"),
            flag(F.col("r.p_size") <= 25).alias("pck_is_medcn_ind"),
        )
        return part.join(ids, [f"k_{k}" for k in self.product_keys]).select(
            "l_partkey", "pcmdty_id", "pck_is_medcn_ind"
        )

    @cached_property
    def outlet_view(self) -> DataFrame:
        """Customers and suppliers as outlets, in the layout of the source view."""
        key = F.col("c_custkey")
        delivery = key % 10 == 7
        root = F.floor(key / 100)
        customers = self.table("customer").select(
            (key + 1 + 1_000_000).cast("int").alias("outlet_code"),
            F.when(delivery, "41").otherwise("11").alias("outlet_type"),
            F.when(delivery, F.concat(F.lit("BN"), F.lpad(text(root), 6, "0")))
            .otherwise(F.concat(F.lit("C"), F.lpad(text(root), 7, "0"))).alias("_root"),
            F.lpad(text(key % 100), 6, "0").alias("_branch"),
            F.when(F.col("c_mktsegment").isin("BUILDING", "AUTOMOBILE"), "R").otherwise("I").alias("other4"),
            pick(ACTIVITIES, key % 8).alias("outlet_fiscal_activity_code"),
            F.col("c_nationkey").alias("_nation"),
        )
        key = F.col("s_suppkey")
        suppliers = self.table("supplier").select(
            (key + SUPPLIER_OUTLETS + 1_000_000).cast("int").alias("outlet_code"),
            F.lit("32").alias("outlet_type"),
            F.concat(F.lit("S"), F.lpad(text(key), 7, "0")).alias("_root"),
            F.lit("000100").alias("_branch"),
            F.lit("R").alias("other4"),
            F.when(key % 3 == 0, "T").otherwise("B7").alias("outlet_fiscal_activity_code"),
            F.col("s_nationkey").alias("_nation"),
        )
        return customers.unionByName(suppliers).select(
            "outlet_code", "outlet_type", F.concat("_root", "_branch").alias("cnpj"),
            F.concat(F.lit("T"), F.col("other4")).alias("new_type_code"), "other4",
            "outlet_fiscal_activity_code", text("_nation").alias("st_cd"),
            F.concat(F.lit("State "), pick(STATES, F.col("_nation"))).alias("st_nm"),
            pick(STATES, F.col("_nation")).alias("st_shrt_nm"),
        )

    @cached_property
    def outlets(self) -> DataFrame:
        from pricemill.sources.reference import dim_outlet

        return dim_outlet(self.outlet_view)

    @cached_property
    def states(self) -> DataFrame:
        return self.table("nation").select(pick(STATES, F.col("n_nationkey")).alias("state_abbrev"))

    @cached_property
    def provider_view(self) -> DataFrame:
        """Every third provider reports as a pharmacy, with the tax id of a customer."""
        key = F.col("s_suppkey")
        pharmacy = key % 3 == 1
        own = F.concat(F.lit("S"), F.lpad(text(key), 7, "0"), F.lit("000100"))
        customer = F.concat(
            F.when(key % 10 == 7, F.concat(F.lit("BN"), F.lpad(text(F.floor(key / 100)), 6, "0")))
            .otherwise(F.concat(F.lit("C"), F.lpad(text(F.floor(key / 100)), 7, "0"))),
            F.lpad(text(key % 100), 6, "0"),
        )
        return self.table("supplier").select(
            key.cast("int").alias("wholesaler_code"),
            F.when(pharmacy, customer).otherwise(own).alias("wholesaler_CGC"),
            (key % 2 + 1).cast("int").alias("wholesaler_type"),
            text(key % 4).alias("distribution_center"),
            F.when(pharmacy & (key % 2 == 0), "P").otherwise(" ").alias("flag1"),
            F.when(key % 6 == 1, "D").otherwise(" ").alias("flag2"),
            F.lit(" ").alias("flag3"),
            F.when(key % 7 != 0, "W").otherwise(" ").alias("flag4"),
            F.when(pharmacy & (key % 6 != 1), "F").otherwise(" ").alias("flag5"),
            *[F.lit(" ").alias(f"flag{i}") for i in (6, 7, 8)],
            F.col("s_name").alias("oac_nm"),
        )

    @cached_property
    def providers(self) -> DataFrame:
        from pricemill.sources.reference import dim_provider

        return dim_provider(self.provider_view)

    # ---- price lists and parameters --------------------------------------------------------------

    @lru_cache
    def price_list(self, kind: str) -> DataFrame:
        """D, L and M prices of every month; a few products lack D or L, a few have M = 0."""
        factor, skip = {"D": (60, (13, 0)), "L": (100, (17, 1)), "M": (110, (1, 1))}[kind]
        months = months_between_list("199412", LAST)
        rows = with_months(self.products.filter(F.col("pcmdty_id") % skip[0] != skip[1]), months)
        value = F.col("retail") * factor + month_number("period_cd") % 12 * 10
        if kind == "M":
            value = F.when(F.col("pcmdty_id") % 10 == 0, 0).otherwise(value)
        return rows.select("pcmdty_id", "period_cd", value.cast(PRICE).alias("prc_amt"))

    @cached_property
    def band(self) -> DataFrame:
        return self.spark.sql(f"select cast(20 as {PRICE}) cpp_min_pct, cast(180 as {PRICE}) cpp_max_pct")

    @cached_property
    def class_bands(self) -> DataFrame:
        return self.spark.sql(
            f"select k pck_gmrs_class_cd, cast(1 as {PRICE}) gmrs_min_pct, cast(m as {PRICE}) gmrs_max_pct "
            "from values ('G', 95), ('M', 90), ('R', 85) as t(k, m)"
        )

    @cached_property
    def tax_medicine(self) -> DataFrame:
        """Rates per state, flag and class, generated from the nation key."""
        nations = self.table("nation").select(F.col("n_nationkey").alias("n"))
        pnn = times(nations, F.array(*[F.lit(i) for i in range(3)]), "i")
        rows = times(pnn, F.array(*[F.lit(i) for i in range(4)]), "j")

        def pct(c: Column) -> Column:
            return c.cast(PRICE)

        n, i, j = F.col("n"), F.col("i"), F.col("j")
        return rows.select(
            pick(STATES, n).alias("st_cd"), pick(("P", "N", "T"), i).alias("pnn_cd"),
            pick(("G", "M", "R", "S"), j).alias("gmrs_cd"),
            pct(12 + (n + j) % 7).alias("icms_int_pct"),
            pct(30 + n + i * 3).alias("mva_orig_pct"), pct(35 + n + j).alias("mva_12_pct"),
            pct(40 + n + j).alias("mva_7_pct"), pct(45 + n + j).alias("mva_4_pct"),
            pct(F.when(j == 3, 0).otherwise(10 + i)).alias("red_mva_pct"),
            pct(F.when(i != 2, j * 5)).alias("pcm_red_pct"), pct(80 + i * 2).alias("trava_pct"),
        )

    # ---- transactions ----------------------------------------------------------------------------

    @cached_property
    def joined(self) -> DataFrame:
        """Line items with what their part, order, customer and supplier say of them."""
        customers = self.table("customer").select(
            F.col("c_custkey").alias("o_custkey"), pick(STATES, F.col("c_nationkey")).alias("buyer_st_cd"),
            flag(F.col("c_mktsegment").isin("BUILDING", "AUTOMOBILE")).alias("is_buyer_chain_ind"),
            pick(CLASSES, F.col("c_custkey") % 8).alias("buyer_ppp_typ_cd"),
        )
        # Orders meet their customers before the lines, and lines are dealt by part while they are narrow.
        orders = self.table("orders").select(
            F.col("o_orderkey").alias("l_orderkey"), "o_custkey",
            F.date_format("o_orderdate", "yyyyMM").alias("period_cd"),
        ).join(customers, "o_custkey")
        suppliers = self.table("supplier").select(
            F.col("s_suppkey").alias("l_suppkey"), pick(STATES, F.col("s_nationkey")).alias("seller_st_cd")
        )
        return (
            self.table("lineitem")
            .join(self.part_ids, "l_partkey")
            .join(orders, "l_orderkey")
            .join(suppliers, "l_suppkey")
            .select(
                "l_orderkey", "l_linenumber", "l_suppkey", F.date_format("l_shipdate", "yyyyMMdd").alias("trans_dt"),
                "period_cd", "pcmdty_id", "pck_is_medcn_ind", "l_extendedprice", "l_discount", "l_tax", "l_quantity",
                "l_returnflag", "l_linestatus", "o_custkey", "buyer_st_cd", "is_buyer_chain_ind", "buyer_ppp_typ_cd", "seller_st_cd",
            )
        )

    def on_kept_lines(self) -> "Domain":
        """The same tables over lines that are joined and written once, for queries that read the lines in several branches."""
        if "kept" not in self._derived:
            self._derived["kept"] = Domain(self.spark, self.sf_dir, self.grain)
            self._derived["kept"].joined = write_out(self.joined)
        return self._derived["kept"]

    @cached_property
    def tx(self) -> DataFrame:
        """One row per line item with the attributes of both sides."""
        key = F.col("l_suppkey")
        return self.joined.select(
            F.concat_ws("-", text("l_orderkey"), text("l_linenumber")).alias("line_id"),
            key.cast("int").alias("dsupp_proc_id"), "trans_dt",
            "period_cd", "pcmdty_id", "pck_is_medcn_ind",
            F.col("l_extendedprice").cast(PRICE).alias("pur_prc_amt"),
            (F.col("l_discount") * 100).cast(PRICE).alias("prc_disc_pct"),
            (F.col("l_tax") * 100).cast(PRICE).alias("icms_tax_pct"),
            F.col("l_quantity").cast("int").alias("units"),
            F.when(F.col("l_linestatus") == "O", "2").otherwise("1").alias("icms_typ_cd"),
            (F.col("o_custkey") + 1).cast("int").alias("buyer_otlt_cd"),
            (key + SUPPLIER_OUTLETS).cast("int").alias("seller_otlt_cd"),
            "buyer_st_cd", "seller_st_cd", "is_buyer_chain_ind", "buyer_ppp_typ_cd",
            F.when(key % 3 == 0, "MANUFACTURER").otherwise("WHOLESALER").alias("seller_ppp_typ_cd"),
            flag(key % 3 == 0).alias("seller_is_manuf_ind"),
            flag(F.col("buyer_ppp_typ_cd") == "PHARMACY").alias("buyer_is_pharmy_ind"),
            flag(F.col("buyer_st_cd") == F.col("seller_st_cd")).alias("trans_is_intra_st_ind"),
            flag(key % 5 == 0).alias("dsupp_is_assc_ind"),
            flag(key % 2 == 0).alias("dsupp_is_distr_ind"),
            F.when(key % 2 == 0, "WHOLESALER").otherwise("PHARMACY").alias("ppp_dsupp_typ_cd"),
            "l_returnflag", "l_linenumber", "o_custkey", "l_suppkey", "l_orderkey",
        )

    @cached_property
    def buys_filtered(self) -> DataFrame:
        from pricemill.operators.buys import FILTERED

        return self.tx.select(*FILTERED)

    @cached_property
    def priced(self) -> DataFrame:
        """Unit prices in which lines with the highest tax are nearly free."""
        low = F.when(F.col("icms_tax_pct") >= 8, F.lit("0.04").cast(PRICE)).otherwise(F.col("pur_prc_amt"))
        return self.buys_filtered.withColumn("pur_prc_amt", low)

    @cached_property
    def tax_calc(self) -> DataFrame:
        """Net prices as tax-adjusted lines."""
        from pricemill.operators.buys import net_price
        from pricemill.operators.tax_medicine import LINE

        return (
            self.tx.withColumn("ppp_prc_amt", net_price().cast(PRICE))
            .withColumnRenamed("line_id", "buys_trans_line_id")
            .withColumnRenamed("is_buyer_chain_ind", "buyer_is_otlt_chain_ind")
            .select(*LINE)
        )

    @cached_property
    def clean(self) -> DataFrame:
        """Transactions that were not returned."""
        return self._clean_lines(self.tx)

    def _clean_lines(self, tx: DataFrame) -> DataFrame:
        from pricemill.operators.buys import net_price
        from pricemill.operators.outliers import CLEAN

        return (
            tx.filter(F.col("l_returnflag") != "R")
            .withColumn("ppp_prc_amt", net_price().cast(PRICE))
            .withColumnRenamed("is_buyer_chain_ind", "buyer_is_otlt_chain_ind")
            .select(*CLEAN)
        )

    @cached_property
    def raw_sales(self) -> DataFrame:
        return self.tx.select(
            F.col("period_cd").alias("period"), F.col("pcmdty_id").alias("fcc"),
            F.col("dsupp_proc_id").alias("whs"), F.col("buyer_otlt_cd").alias("outlet"), "units",
        )

    @cached_property
    def sales(self) -> DataFrame:
        return self._sold(self.tx)

    def _sold(self, tx: DataFrame) -> DataFrame:
        return (
            tx.groupBy(
                "period_cd", F.col("pcmdty_id").alias("fcc"),
                F.col("dsupp_proc_id").alias("wholesaler_code"), F.col("buyer_otlt_cd").alias("outlet_code"),
            )
            .agg(F.sum("units").cast("int").alias("sum_units"))
        )

    @cached_property
    def raw_buys(self) -> DataFrame:
        """The layout of the raw transaction table."""
        key = F.col("l_suppkey")
        pharmacy = key % 3 == 1
        supplier_id = F.concat(F.lit("S"), F.lpad(text(key), 7, "0"), F.lit("000100"))
        c = F.col("o_custkey")
        customer_id = F.concat(
            F.when(c % 10 == 7, F.concat(F.lit("BN"), F.lpad(text(F.floor(c / 100)), 6, "0")))
            .otherwise(F.concat(F.lit("C"), F.lpad(text(F.floor(c / 100)), 7, "0"))),
            F.lpad(text(c % 100), 6, "0"),
        )
        sold_by_supplier = (F.col("dsupp_is_assc_ind") == 1) | pharmacy
        return self.tx.select(
            F.upper(F.concat(F.lit("L"), F.col("line_id"))).alias("line_id"),
            text("dsupp_proc_id").alias("dsupp_proc_id"), "trans_dt", text("o_custkey").alias("store_cd"),
            text("l_suppkey").alias("origin_whlslr_id"),
            F.when(sold_by_supplier, supplier_id).otherwise(customer_id).alias("origin_cnpj_fiscal_id"),
            "icms_typ_cd", text("l_orderkey").alias("invc_nbr"), text("pcmdty_id").alias("origin_dsupp_prod_cd"),
            "pcmdty_id", F.col("units").cast(PRICE).alias("units_qty"),
            (F.col("l_linenumber") % 3).cast(PRICE).alias("pcmdty_qty_mult_fct"),
            F.col("pur_prc_amt").alias("purchase_prc_amt"), "icms_tax_pct",
            F.lit(0).cast(PRICE).alias("icms_tax_amt"), F.col("prc_disc_pct").alias("price_discount_pct"),
            F.lit(0).cast(PRICE).alias("discount_amt"), customer_id.alias("destination_cnpj_fiscal_id"),
            text("pcmdty_id").alias("destination_dsupp_prod_cd"),
            text("pcmdty_id").alias("destination_dsupp_prod_ean_cd"),
            (F.col("dsupp_is_assc_ind") + 1).alias("SupplierType"),
            F.when(F.col("l_linenumber") == 7, "Pending").otherwise("Bridged-ok").alias("bridge_type"),
            F.lit("2001-08-01 00:00:00").cast("timestamp").alias("proc_eff_ts"),
            F.lit("LOAD").alias("src_sys_cd"), F.col("period_cd").alias("period_dt"),
        )

    @cached_property
    def provider_factors(self) -> DataFrame:
        key = F.col("s_suppkey")
        return self.table("supplier").filter(key % 9 == 0).select(
            text("s_suppkey").alias("dsupp_proc_id"), (key % 3 + 1).cast(PRICE).alias("pcmdty_qty_mult_fct")
        )

    @cached_property
    def buys(self) -> DataFrame:
        from pricemill.operators.buys import normalise_buys

        return normalise_buys(
            self.raw_buys, self.provider_factors, period_from=FIRST, period_to=LAST, batch_id="b1"
        )

    # ---- price tables ----------------------------------------------------------------------------

    @cached_property
    def national(self) -> DataFrame:
        """Unit-weighted price per product and month; the step depends on the month's lines."""
        n, line = F.col("n"), F.col("line")
        step = (
            F.when(n >= 2, 1).when(line == 1, 50).when(line == 2, 51).when(line == 3, 102)
            .when(line == 4, 2).otherwise(1)
        )
        return (
            self.tx.groupBy("pcmdty_id", "period_cd")
            .agg(
                weighted_mean("pur_prc_amt", "units").cast(PRICE).alias("ppp_prc_amt"),
                F.count(F.lit(1)).alias("n"), F.max("l_linenumber").alias("line"),
            )
            .select("pcmdty_id", "ppp_prc_amt", step.alias("step_cd"), "period_cd")
        )

    @cached_property
    def geo(self) -> DataFrame:
        """Unit-weighted price per product, month, state and channel."""
        channel = F.when(F.col("is_buyer_chain_ind") == 1, "R").otherwise("I")
        kept = F.when(F.col("l_returnflag") != "R", F.col("units")).otherwise(0)
        return (
            self.tx.groupBy("pcmdty_id", "period_cd", F.concat("buyer_st_cd", channel).alias("geo_lvl_cd"))
            .agg(
                weighted_mean("pur_prc_amt", "units").cast(PRICE).alias("ppp_prc_amt"),
                F.sum(kept).cast("decimal(22,0)").alias("wgt_units_qty"),
                F.sum("units").cast("decimal(22,0)").alias("sales_units_qty"),
                F.count(F.lit(1)).alias("n"), F.max("l_linenumber").alias("line"),
            )
            .select(
                "pcmdty_id", "geo_lvl_cd", "ppp_prc_amt", "wgt_units_qty",
                F.when((F.col("n") == 1) & (F.col("line") == 1), 50).otherwise(1).alias("step_cd"),
                "sales_units_qty", "period_cd",
            )
        )

    @cached_property
    def price_feed(self) -> DataFrame:
        """Published prices in cents, by type."""
        first = F.concat("period_cd", F.lit("01"))
        lists = [
            self.price_list(kind).select(
                (F.col("prc_amt") * 100).cast("int").alias("price"), F.col("pcmdty_id").alias("fcc"),
                first.alias("price_date"), F.lit(kind).alias("price_type"),
            )
            for kind in ("D", "M", "L")
        ]
        published = self.national.select(
            (F.round("ppp_prc_amt", 2) * 100 + flag(F.col("pcmdty_id") % 5 == 0)).cast("int").alias("price"),
            F.col("pcmdty_id").alias("fcc"), first.alias("price_date"),
            F.when(F.col("pcmdty_id") % 4 == 0, "J").otherwise("C").alias("price_type"),
        )
        return lists[0].unionByName(lists[1]).unionByName(lists[2]).unionByName(published)

    @cached_property
    def product_view(self) -> DataFrame:
        """The wide product view behind the dimension."""
        i = F.col("pcmdty_id")
        return self.products.select(
            "pcmdty_id", F.col("prod_desc").alias("prod_brand_nm"), F.col("pack_cd").alias("pack_code"),
            "prod_cd", F.col("manuf_cd").alias("lab_cd"),
            *[f"{p}{n}_cd" for p in ("atc", "nec") for n in (4, 3, 2, 1)],
            F.col("app1_cd").alias("nfc1_cd"), F.col("mseg3_cd").alias("nfc3_cd"),
            (i % 40 + 1).cast("double").alias("std_unit"), F.col("otc_seg_cd").alias("mkt_seg_cd"),
            F.concat(F.lit("PACK "), F.col("prod_desc")).alias("stdiz_pcmdty_nm"),
            F.substring("manuf_cd", 1, 5).alias("pri_org_short_nm"), F.col("manuf_cd").alias("pri_org_nm"),
            F.when(i % 6 != 0, F.col("pck_gmrs_class_cd")).alias("gmrs_cd"),
            F.concat(F.lit("Class "), F.col("atc1_cd")).alias("atc1_nm"),
        )

    @cached_property
    def product_ext(self) -> DataFrame:
        return self.products.select(
            "pcmdty_id", F.col("mseg3_cd").alias("pck_mkt_seg_class_3"),
            F.when(F.col("pck_is_medcn_ind") == 1, "MEDICAMENTO").otherwise("NAO").alias("pck_medicine_ind"),
            F.lower("pck_gmrs_class_cd").alias("pck_gmrs_class_cd"),
        )

    @cached_property
    def ncm_attr(self) -> DataFrame:
        """Tax codes of product classes; some classes have two."""
        rows = self.products.select("nec4_cd", F.col("mseg3_cd").alias("nfc3_cd"), "ncm_cd")
        return rows.filter(F.col("ncm_cd").isNotNull()).distinct().select("ncm_cd", "nec4_cd", "nfc3_cd")

    @cached_property
    def tipi(self) -> DataFrame:
        """Exemptions at every class level, for some tax codes."""
        return self._class_codes("tipi_excl_cd", "EX", 3)

    @cached_property
    def cest(self) -> DataFrame:
        return self._class_codes("cest_cd", "K", 2)

    def _class_codes(self, name: str, prefix: str, every: int) -> DataFrame:
        levels = F.array(*[F.struct(F.lit(n).alias("n"), F.col(f"nec{n}_cd").alias("c")) for n in (1, 2, 3, 4)])
        rows = self.products.filter(F.col("ncm_cd").isNotNull()).select("pcmdty_id", "ncm_cd", F.explode(levels).alias("l"))
        kept = rows.filter((F.col("pcmdty_id") + F.col("l.n")) % every == 0)
        return kept.select(
            "ncm_cd", F.col("l.c").alias("nec_lvl_cd"),
            F.concat(F.lit(prefix), text(F.col("l.n"))).alias(name),
        ).distinct()

    @cached_property
    def icms(self) -> DataFrame:
        """State rates of non-medicines: two rows for even nations, to be ranked."""
        nations = self.table("nation").select(F.col("n_nationkey").alias("n"))
        codes = times(nations, F.array(*[F.lit(i) for i in range(7)]), "c")
        rows = times(codes, F.array(F.lit(0), F.lit(1)), "r").filter((F.col("r") == 0) | (F.col("n") % 2 == 0))
        n, c, r = F.col("n"), F.col("c"), F.col("r")

        def share(value: Column) -> Column:
            return (value * F.expr("0.01BD")).cast(PRICE)

        return rows.select(
            pick(STATES, n).alias("state_cd"), F.concat(F.lit("N"), text(c)).alias("ncm_cd"),
            F.when((c + r) % 4 != 0, F.concat(F.lit("K"), text((c + r) % 4))).alias("cest_cd"),
            F.when((n + c + r) % 2 == 0, "ST").otherwise("D/C").alias("icms_typ_cd"),
            share(12 + (n + c) % 7).alias("icms_pct"),
            share(30 + n).alias("mva_ori_op_intra_st_pct"),
            share(40 + n).alias("mva_adj_op_inter_st_12_pct"),
            share(50 + n).alias("mva_adj_op_inter_st_7_pct"),
            share(60 + n).alias("mva_adj_op_inter_st_4_pct"),
            F.when(c != 3, share(c * 2)).alias("intr_red_pct"),
            F.when(c != 5, share(c)).alias("mva_reductor_pct"),
        )

    @cached_property
    def federal(self) -> DataFrame:
        return self.spark.sql(
            f"""select concat('N', c, if(x = 1, ' - EX2', '')) ncm_cd,
                cast((5 + c + x) * 0.01BD as {PRICE}) ipi_pct,
                element_at(array('D/C', 'Monofásico', 'Outro'), cast((c + x) % 3 + 1 as int)) pis_cofins_typ_cd,
                cast(case (c + x) % 3 when 1 then if(c % 2 = 0, 0.125BD, 0.12BD) else 0.0925BD end as {PRICE}) pis_cofins_pct
                from (select explode(sequence(0, 5)) c) lateral view explode(array(0, 1, 0)) t as x"""
        )

    @cached_property
    def sub_national_cpp(self) -> DataFrame:
        """Sub-national D prices in cents, for products that have one."""
        rows = self.price_list("D").filter(F.col("pcmdty_id") % 3 != 0)
        geos = times(rows, F.array(F.lit("SPI"), F.lit("RJI"), F.lit("SPR")), "geo_lvl_cd")
        extra = F.when(F.col("geo_lvl_cd") == "RJI", 700).otherwise(0)
        return geos.select(
            F.col("pcmdty_id").alias("fcc"), F.col("period_cd").alias("period"), "geo_lvl_cd",
            (F.col("prc_amt") * 100 + extra).cast(PRICE).alias("price"),
        )

    @cached_property
    def corrections(self) -> DataFrame:
        """Corrections derived from the parts: most are valid, each rule is broken by some."""
        k = F.col("p_partkey")
        month = F.when(k % 31 == 0, "199001").when(k % 37 == 0, F.lit(None)).otherwise(
            F.concat(F.lit("200"), text(k % 2), F.lpad(text(k % 7 + 1), 2, "0"))
        )
        return self.table("part").select(
            month.alias("period_cd"),
            F.when(k % 41 != 0, (k % 500 + 1).cast("int")).alias("pcmdty_id"),
            F.when(k % 43 == 0, -F.col("p_retailprice")).when(k % 47 != 0, F.col("p_retailprice"))
            .cast(PRICE).alias("prc_amt"),
        )


__all__ = ["Domain", "FIRST", "LAST", "STATES", "domain"]
