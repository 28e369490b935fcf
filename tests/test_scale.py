"""What plans and files of the line queries look like, whatever the number of lines."""

import re
import time

import pytest
from pyspark.sql import functions as F

from checks.domain import domain
from pricemill.operators import buys, weighting
from pricemill.session import DROP_SHUFFLES, write_out


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_lines_meet_orders_that_already_know_their_customer(spark, sf_dir):
    """Lines take part in one join fewer: customers are joined to orders."""
    optimized = domain(spark, sf_dir, "name").tx._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.index("Relation [l_orderkey") < optimized.index("Relation [o_orderkey") < optimized.index("Relation [c_custkey")
    assert optimized.index("Relation [p_partkey") < optimized.index("Relation [o_orderkey")


def test_kept_lines_are_read_by_column(spark):
    kept = write_out(spark.range(10).select("id", F.lit("x").alias("wide")))
    assert sorted(r[0] for r in kept.select("id").collect()) == list(range(10))
    assert "ReadSchema: struct<id:bigint>" in plan(kept.select("id"))


PRICES = "period_cd string, pcmdty_id int, cnpj_root_cd string"


def test_prices_of_an_owner_are_looked_up_once(spark):
    missing = spark.createDataFrame(
        [("200001", 1, 7, "r", "SP", 0), ("200001", 1, 8, "r", "RJ", 1), ("200001", 1, 9, "q", None, 1), ("200001", 1, 6, "r", None, 0),
         ("200001", 1, 5, "r", "MG", 0)],
        "period_cd string, pcmdty_id int, outlet_code int, cnpj_root_cd string, st_cd string, is_otlt_chain_ind int",
    )
    near = spark.createDataFrame(
        [("200001", 1, "r", "SP", 0, 2.0), ("200001", 1, "r", "SP", 1, 3.0), ("200001", 1, "r", "MG", 5, None)],
        PRICES + ", st_cd string, buyer_is_pharmy_ind int, ppp_prc double",
    ).withColumn("ppp_prc", F.col("ppp_prc").cast("decimal(22,8)"))
    far = spark.createDataFrame([("200001", 1, "r", 1, 4.0)], PRICES + ", buyer_is_pharmy_ind int, ppp_prc double")
    far = far.withColumn("ppp_prc", F.col("ppp_prc").cast("decimal(22,8)"))
    found = weighting.impute_price(missing, near, far, "cnpj_root_cd")
    rows = sorted((r.outlet_code, r.buyer_is_pharmy_ind, float(r.ppp_prc_amt)) for r in found.filter("outlet_code <> 9").collect())
    assert rows == [(5, 5, 4.0), (6, 1, 4.0), (7, 0, 2.0), (7, 1, 3.0), (8, 1, 4.0)]
    last = found.filter("outlet_code = 9").collect()
    assert [(r.buyer_is_pharmy_ind, float(r.ppp_prc_amt)) for r in last] == [(None, 0.0)]
    # The missing rows take part in one join, the price lists of an owner in another.
    assert len(re.findall(r"LeftOuter|RightOuter", plan(found))) == 1


def test_distinct_lines_need_no_exchange_of_their_own(spark, sf_dir):
    d = domain(spark, sf_dir, "name")
    priced = d.stored("priced")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cleaned = buys.filtered_buys(priced, d.stored_list("L"), d.stored("products"), d.class_bands)
        text = plan(cleaned)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    by_all = [row for row in text.splitlines() if "Exchange hashpartitioning(is_buyer_chain_ind" in row]
    assert not by_all


def test_arriving_lines_are_not_dealt_to_a_fixed_number_of_files(spark, sf_dir, monkeypatch):
    """As many files as partitions of the lines, in two batches."""
    from checks import q_buys

    seen = {}

    def load(store, stream, factors, *, batch_id, checkpoint):
        numbers = []
        folder = checkpoint.rsplit("/", 1)[0] + "/in"
        seen["files"] = len(spark.read.parquet(folder).inputFiles())
        stream.writeStream.foreachBatch(lambda lines, number: numbers.append(number)).option(
            "checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
        seen["batches"] = len(numbers)
        store.spark.read.parquet(folder).limit(0).withColumn("period_cd", F.lit("x")).write.parquet(store.path("buys"))

    d = domain(spark, sf_dir, "name")
    monkeypatch.setattr(q_buys, "load_arrived", load)
    monkeypatch.setattr(d, "raw_buys", d.raw_buys.repartition(6))
    q_buys._arrived(d)
    assert seen["files"] == 12 and seen["batches"] == 2


@pytest.mark.parametrize("key", ["unit_price", "rule_engine", "drop_low_price_groups", "suggest_adjustment"])
def test_lines_are_joined_once_for_all_branches(spark, sf_dir, monkeypatch, key):
    from checks import domain as tables
    from checks.queries import QUERIES

    written = []

    def kept(df):
        written.append(plan(df))
        return write_out(df)

    monkeypatch.setattr(tables, "write_out", kept)
    result = plan(QUERIES[key].spark(spark, sf_dir))
    assert sum(text.count("FileScan parquet [l_orderkey") for text in written) == 1
    assert "l_partkey" not in result


def test_only_lines_of_the_class_are_dealt_by_id(spark):
    lines = spark.createDataFrame(
        [("a", "WHOLESALER"), ("a", "PHARMACY"), ("b", "WHOLESALER"), ("c", None), ("c", None), (None, "WHOLESALER"), (None, "WHOLESALER")],
        "line_id string, buyer_ppp_typ_cd string",
    )
    kept = buys.drop_duplicate_lines(lines)
    rows = sorted((str(r.line_id), str(r.buyer_ppp_typ_cd)) for r in kept.collect())
    assert rows == [("None", "WHOLESALER")] * 2 + [("a", "PHARMACY"), ("b", "WHOLESALER"), ("c", "None"), ("c", "None")]
    assert sorted(map(str, buys.drop_duplicate_lines(lines, dealt=True).collect())) == sorted(map(str, kept.collect()))
    assert "Union" in plan(kept) and "Union" not in plan(buys.drop_duplicate_lines(lines, dealt=True))


def test_lines_bring_the_sides_of_their_outlets(spark):
    """Outlets listed twice, out of scope, without a code or unknown count as they do in a join by their code."""
    outlets = spark.createDataFrame(
        [("o1", 1, 0, 1, "PHARMACY", "SP"), ("o1", 1, 0, 1, "PHARMACY", "SP"), ("o2", 2, 1, 1, "WHOLESALER", "RJ"), ("o3", 3, 1, 0, "OUTROS", None),
         ("o4", None, 0, 1, "MANUFACTURER", "MG"), (None, 5, 0, 1, "MANUFACTURER", "MG"), ("o6", 2, 0, 1, "OUTROS", "PR")],
        "cnpj_cd string, outlet_code int, is_otlt_chain_ind int, ppp_incl_calc_ind int, ppp_fisc_actvty_class_cd string, st_cd string",
    )
    providers = spark.createDataFrame(
        [(10, "o1", 1, "PHARMACY"), (11, "o2", 1, "WHOLESALER"), (12, "o6", 1, "PHARMACY"), (13, "o6", 2, "N/C"), (14, "o9", 1, "PHARMACY")],
        "wholesaler_code int, wholesaler_CGC string, wholesaler_type int, ppp_dsupp_typ_cd string",
    )
    ids = ["o1", "o2", "o3", "o4", "o6", "o9", None]
    rows = [
        (f"l{i}", 10 + i % 5, "20010101", "1", 1 + i % 2, 2.0, 8.0, 1.0, 0.0, [1, 0, None][i % 3], "200101", ids[i % 7], ids[i // 7 % 7])
        for i in range(420)
    ]
    lines = spark.createDataFrame(
        rows, "line_id string, dsupp_proc_id int, trans_dt string, icms_typ_cd string, pcmdty_id int, pcmdty_qty_mult_fct double,"
        "pur_prc_amt double, icms_tax_pct double, prc_disc_pct double, dsupp_is_assc_ind int, period_cd string,"
        "orig_cnpj_fiscal_id string, dest_cnpj_fiscal_id string",
    ).withColumns({c: F.col(c).cast("decimal(18,4)") for c in ("pcmdty_qty_mult_fct", "pur_prc_amt", "icms_tax_pct", "prc_disc_pct")})
    products = spark.createDataFrame([(1, 1), (2, 0)], "pcmdty_id int, pck_is_medcn_ind int")
    factors = spark.createDataFrame([("o1", 1, 4.0), ("o2", 2, 0.0), ("o2", 2, 5.0)], "wholesaler_CGC string, pcmdty_id int, pcmdty_qty_mult_fct double")
    factors = factors.withColumn("pcmdty_qty_mult_fct", F.col("pcmdty_qty_mult_fct").cast("decimal(18,4)"))

    def resolved(table):
        return buys.resolve_counterparties(
            lines, products, providers, table, factors, period_from="200101", period_to="200112", distributor_class="WHOLESALER"
        )

    plain = resolved(outlets)
    brought = resolved(buys.with_sides(outlets, providers))
    assert sorted(map(str, brought.drop(*buys.SIDES).collect())) == sorted(map(str, plain.collect()))
    # Only lines of associations have a seller's factor.
    assert {r.dsupp_is_assc_ind for r in plain.filter("seller_qty_mult_fct IS NOT NULL").collect()} == {1}
    before, after = buys.unit_price(plain, outlets, providers), buys.unit_price(brought, outlets, providers)
    assert before.count() > 0 and sorted(map(str, after.collect())) == sorted(map(str, before.collect()))

    def joins(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("Join ")

    assert joins(after) == joins(brought) == joins(before) - 3


def test_shuffle_files_go_with_the_write_that_made_them(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles() -> set[str]:
        blocks = manager.getAllBlocks()
        return {name for i in range(blocks.size()) if (name := blocks.apply(i).name()).startswith("shuffle_")}

    before = shuffles()
    kept = write_out(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    for _ in range(50):  # files go in the background
        if not shuffles() - before:
            break
        time.sleep(0.1)
    assert not shuffles() - before
    assert kept.count() == 7
    assert spark.conf.get(DROP_SHUFFLES, None) in (None, "false")


LINES = [  # line_id, product, period, provider, price, buyer's class
    ("a", 1, "200001", 7, 0.01, "PHARMACY"), ("a", 1, "200001", 7, 9.0, "WHOLESALER"), ("a", 2, "200001", 7, 9.0, "WHOLESALER"),
    ("b", 1, "200001", 7, 0.02, "PHARMACY"), ("c", 2, "200001", 7, 8.0, "PHARMACY"), (None, 1, "200001", 7, 7.0, "WHOLESALER"),
    (None, 2, "200001", 7, 6.0, "WHOLESALER"), (None, None, "200001", 7, 0.01, "WHOLESALER"), ("d", None, "200001", 7, 5.0, "PHARMACY"),
    ("e", 3, "200001", 7, None, "PHARMACY"), ("f", 1, "200001", 7, 0.03, "PHARMACY"), ("f", 1, "200001", 7, 0.03, "PHARMACY"),
    ("1|200001|7", 2, "200001", 7, 4.0, "PHARMACY"), ("1|200001|7", 2, "200001", 7, 4.0, "WHOLESALER"), (None, 1, "200001", 7, 3.0, "PHARMACY"),
]


def test_low_groups_by_line_are_those_by_group(spark):
    lines = spark.createDataFrame(LINES, "line_id string, pcmdty_id int, period_cd string, dsupp_proc_id int, pur_prc_amt double, buyer_ppp_typ_cd string")
    some = lines.filter("coalesce(pur_prc_amt, 1) > 0.015")
    for pct in (40.0, 50.0, 60.0, 0.0):
        kept = buys.drop_low_price_groups(some, max_pct=pct, population=lines)
        dealt = buys.drop_low_price_groups(some, max_pct=pct, population=lines, dealt=True)
        assert sorted(map(str, dealt.drop(buys.LINE_KEY).collect())) == sorted(map(str, kept.collect()))
        once = buys.drop_duplicate_lines(dealt, population=lines, dealt=True).drop(buys.LINE_KEY)
        assert sorted(map(str, once.collect())) == sorted(map(str, buys.drop_duplicate_lines(kept, population=lines).collect()))


def without_broadcast(spark, make) -> str:
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return plan(make())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_cleaned_lines_are_dealt_by_group_without_their_other_columns(spark, sf_dir):
    d = domain(spark, sf_dir, "name")
    priced, lists, products = d.stored("priced"), d.stored_list("L"), d.stored("products")
    text = without_broadcast(spark, lambda: buys.filtered_buys(priced, lists, products, d.class_bands))
    by_group = re.findall(r"Exchange hashpartitioning\(pcmdty_id#\d+, period_cd#\d+, dsupp_proc_id#\d+", text)
    assert len(by_group) == 1 and "LeftAnti" in text and text.count("LeftAnti") == 1
    assert len(re.findall(r"Exchange hashpartitioning\(_line#", text)) == 1


def test_sold_outlets_meet_all_prices_of_their_root_in_one_exchange(spark, sf_dir):
    d = domain(spark, sf_dir, "name")
    clean, sales = d.both_sides()
    outlets = write_out(d.outlets)
    text = without_broadcast(spark, lambda: weighting.outlet_price_fallback(clean, sales, outlets))
    # outlets twice, sales and transactions by outlet, and both by root
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 5
    text = without_broadcast(spark, lambda: weighting.missing_outlets(sales, clean, outlets))
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 3


def test_prices_of_outlets_listed_twice_or_without_root(spark):
    """Own mean of each state and channel, else the root's in the state, else the root's, else 0."""
    outlets = spark.createDataFrame(
        [(1, "c1", "r", "SP", 0), (1, "c1", "r", "SP", 0), (2, "c2", "r", "SP", 0), (3, "c3", "r", "RJ", 1), (4, "c4", None, "SP", 0),
         (5, "c5", None, "SP", 0), (6, "c6", "q", "MG", 0), (7, "c7", "r", None, 0)],
        "outlet_code int, cnpj_cd string, cnpj_root_cd string, st_cd string, is_otlt_chain_ind int",
    ).withColumn("ppp_fisc_actvty_class_cd", F.lit("PHARMACY"))
    sales = spark.createDataFrame([("200001", 9, 1, o, 10) for o in range(1, 9)], "period_cd string, fcc int, wholesaler_code int, outlet_code int, sum_units int")
    trans = spark.createDataFrame(
        [("200001", 9, 1, "SP", 0, 2.0), ("200001", 9, 1, "SP", 0, 4.0), ("200001", 9, 1, "RJ", 0, 9.0), ("200001", 9, 4, "SP", 0, 7.0)],
        "period_cd string, pcmdty_id int, buyer_otlt_cd int, buyer_st_cd string, buyer_is_otlt_chain_ind int, ppp_prc_amt double",
    ).withColumn("ppp_prc_amt", F.col("ppp_prc_amt").cast("decimal(22,8)"))
    found = sorted((r.outlet_code, float(r.prc_final)) for r in weighting.outlet_price_fallback(trans, sales, outlets).collect())
    assert found == [(1, 3.0), (1, 3.0), (1, 9.0), (1, 9.0), (2, 5.0), (3, 5.0), (4, 7.0), (5, 0.0), (6, 0.0), (7, 5.0)]
    # neither sales nor transactions of an unknown month or product meet
    for column, code in (("period_cd", "period_cd"), ("fcc", "pcmdty_id")):
        lost = weighting.outlet_price_fallback(trans.withColumn(code, F.lit(None).cast(trans.schema[code].dataType)),
                                               sales.withColumn(column, F.lit(None).cast(sales.schema[column].dataType)), outlets)
        assert [float(r.prc_final) for r in lost.collect()] == [0.0] * 8
