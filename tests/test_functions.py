import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from pricemill.functions import periods, tables
from pricemill.functions.bounded import code_list, one_value, times, times_all
from pricemill.functions.numbers import cents, price_from_double, weighted_mean
from pricemill.functions.quantiles import group_quantiles


def test_months(spark):
    df = spark.createDataFrame([("200001",), ("199912",), ("201106",)], "p string")
    for n in (-25, -12, -1, 0, 1, 11, 12, 59):
        got = [r[0] for r in df.select(periods.add_months("p", n)).collect()]
        assert got == [periods.shift(p, n) for p in ("200001", "199912", "201106")]
    assert periods.shift("200001", -1) == "199912"
    assert periods.months_between_list("199911", "200002") == ["199911", "199912", "200001", "200002"]
    assert len(periods.months_ending("200107", 60)) == 60


def test_money(spark):
    df = spark.createDataFrame([("1.15",), ("0.29",), ("10.005",)], "p string").select(
        F.col("p").cast("decimal(18,4)").alias("p")
    )
    # On doubles 1.15 * 100 truncates to 114.
    assert [r[0] for r in df.select(cents("p")).collect()] == [115, 29, 1001]
    row = spark.sql("select 1.00005D x").select(price_from_double(F.col("x"))).first()
    assert row[0] == Decimal("1.0001")


def test_weighted_mean_is_within_its_inputs_and_guards_zero(spark):
    df = spark.createDataFrame([(1, 10.0, 1), (1, 20.0, 3), (2, 5.0, 0)], "k int, p double, u int")
    df = df.withColumn("p", F.col("p").cast("decimal(18,4)"))
    got = {r[0]: r[1] for r in df.groupBy("k").agg(weighted_mean("p", "u")).collect()}
    assert got[1] == Decimal("17.5") and got[2] == 0


def test_update_join_sets_nulls_and_keeps_rows(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    updates = spark.createDataFrame([(2, None), (3, "z"), (9, "y")], "k int, v string")
    rows = sorted(tuple(r) for r in tables.update_join(target, updates, ["k"], ["v"]).collect())
    assert rows == [(1, "a"), (2, None), (3, "z")]


def test_replace_period_and_writes_are_idempotent(spark, tmp_path):
    old = spark.createDataFrame([(1, "200001"), (2, "200002"), (3, "200003")], "k int, period_cd string")
    new = spark.createDataFrame([(9, "200002")], "k int, period_cd string")
    replaced = tables.replace_period(old, new, period_from="200002", period_to="200003")
    assert sorted(r.k for r in replaced.collect()) == [1, 9]
    path = str(tmp_path / "t")
    for _ in range(2):
        tables.write_periods(old, path)
        tables.write_period(new, path, "200002")
        tables.write_period(new, path, "200003")  # no rows: the month becomes empty
    got = spark.read.schema("k int, period_cd string").parquet(path).collect()
    assert sorted((r.k, r.period_cd) for r in got) == [(1, "200001"), (9, "200002")]


def test_bounded_lists_refuse_long_ones(spark):
    df = spark.range(3)
    codes = spark.createDataFrame([("x",), ("y",), ("x",)], "c string")
    assert times(df, code_list(codes, "c"), "code").count() == 6
    with pytest.raises(Exception, match="more than 1 values"):
        times(df, code_list(codes, "c", limit=1), "code").collect()
    with pytest.raises(Exception):
        df.select(one_value(codes, "c")).collect()


def test_codes_of_the_data_may_be_many(spark):
    codes = spark.range(1001).selectExpr("concat('g', id) AS c").unionByName(spark.createDataFrame([("g0",)], "c string"))
    grid = times_all(spark.range(3), codes, "c")
    assert grid.count() == grid.distinct().count() == 3 * 1001
    assert times_all(spark.range(3), codes.limit(0), "c").count() == 0
    assert "NestedLoop" not in grid._jdf.queryExecution().executedPlan().toString()


def test_weights_above_a_trillion(spark):
    rows = [(Decimal("10.5"), Decimal(10**13)), (Decimal("20.5"), Decimal(3 * 10**13))]
    df = spark.createDataFrame(rows, "p decimal(18,4), w decimal(22,0)")
    assert df.agg(weighted_mean("p", "w").alias("m")).first().m == Decimal("18")


def test_quantiles_against_brute_force(spark):
    """Group 0 holds a third of all rows; group 3 is made of copies of two values."""
    rng = random.Random(1)
    rows = [(0, rng.randint(-50, 500) / 100) for _ in range(400)]
    rows += [(rng.randint(10, 150), rng.randint(1, 10**6) / 100) for _ in range(700)]
    rows += [(3, v) for v in [1.5] * 60 + [2.5] * 40] + [(None, 4.0), (None, 6.0), (5, None)]
    df = spark.createDataFrame(rows, "k int, v double").withColumn("v", F.col("v").cast("decimal(18,4)"))
    groups: dict = {}
    for k, v in rows:
        if v is not None:
            groups.setdefault(k, []).append(v)
    got = group_quantiles(
        df, ["k"], "v", [0.25, 0.75, 0.95], names=["a", "b", "c"], count_name="n"
    ).collect()
    assert {r.k for r in got} == set(groups)
    for r in got:
        values = sorted(groups[r.k])
        n = len(values)
        assert r.n == n
        expected = [values[max(-(-n * p // 100), 1) - 1] for p in (25, 75, 95)]
        assert [float(r.a), float(r.b), float(r.c)] == pytest.approx(expected)
    medians = group_quantiles(df, ["k"], "v", [0.5], names=["m"], interpolate=True)
    for r in medians.collect():
        values = sorted(groups[r.k])
        n = len(values)
        assert float(r.m) == pytest.approx((values[(n - 1) // 2] + values[n // 2]) / 2)


def test_quantiles_shuffle_the_input_once(spark, tmp_path):
    spark.range(1000).selectExpr("cast(id % 7 as int) k", "cast(id as decimal(18,4)) v").write.parquet(f"{tmp_path}/v")
    found = group_quantiles(spark.read.parquet(f"{tmp_path}/v"), ["k"], "v", [0.5], names=["m"])
    assert found.count() == 7
    found.collect()
    final = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1 and "ReusedExchange" in final
