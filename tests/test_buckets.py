"""Price tables that are stored in buckets of month and product are smoothed without an exchange of their rows."""

import uuid

import pytest
from pyspark.sql import functions as F

from checks.domain import FIRST, LAST, Domain
from pricemill.functions.tables import store_in_buckets
from pricemill.operators import corrections

P = {"period_from": FIRST, "period_to": LAST}


def exchanges_above(df, table: str) -> list[str]:
    """The exchanges of the plan that have a scan of the table below them."""
    found, open_ = [], []
    for line in df._jdf.queryExecution().executedPlan().toString().split("\n"):
        depth = len(line) - len(line.lstrip(" :+-"))
        open_ = [(d, e) for d, e in open_ if d < depth]
        if "Exchange" in line:
            open_.append((depth, line.strip()))
        if "FileScan" in line and table in line:
            found += [e for _, e in open_]
    return found


@pytest.fixture(scope="module")
def tables(spark, sf_dir, tmp_path_factory):
    d, path = Domain(spark, sf_dir), tmp_path_factory.mktemp("buckets")
    stored = {}
    for name, df in (("geo", d.geo), ("national", d.national)):
        table = f"{name}_{uuid.uuid4().hex}"
        stored[name] = table, store_in_buckets(df, table, str(path / name), keys=corrections.PRODUCT_KEY, buckets=8)
    yield stored
    for table, _ in stored.values():
        spark.sql(f"DROP TABLE {table}")


@pytest.fixture
def joined_by_sorting(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_no_exchange_of_the_table(spark, tables, joined_by_sorting):
    (geo_name, geo), (national_name, national) = tables["geo"], tables["national"]
    flagged = corrections.channel_flags(geo, national, **P)
    few = spark.createDataFrame(flagged.limit(5).collect(), flagged.schema)
    smoothed, _ = corrections.smooth_both_channels(geo, few, batch_id="b", **P)
    changes = corrections.both_channel_changes(geo, few, **P)
    assert exchanges_above(changes, geo_name) == []
    stored_changes = spark.createDataFrame(changes.collect(), changes.schema)
    assert exchanges_above(corrections._apply_to_geos(geo, stored_changes, 51), geo_name) == []
    recalculated, _ = corrections.recalc_national(geo, national, period="200101")
    assert exchanges_above(corrections.national_changes(geo, national, period="200101"), geo_name) == []
    assert exchanges_above(recalculated, national_name) == [] == exchanges_above(recalculated, geo_name)
    # the check itself sees an exchange where there is one
    assert exchanges_above(geo.groupBy("geo_lvl_cd").count(), geo_name)
    assert smoothed.count() == geo.count()


def test_a_null_price_may_be_applied(spark):
    geo = spark.createDataFrame([("200101", 1, "SPR", 1.0, 1), ("200101", 1, "SPI", 2.0, 1)], "period_cd string, pcmdty_id int, geo_lvl_cd string, ppp_prc_amt double, step_cd int")
    changes = geo.filter("geo_lvl_cd = 'SPR'").withColumn("ppp_prc_amt_new", F.lit(None).cast("double"))
    rows = {r.geo_lvl_cd: (r.ppp_prc_amt, r.step_cd) for r in corrections._apply_to_geos(geo, changes, 51).collect()}
    assert rows == {"SPR": (None, 51), "SPI": (2.0, 1)}
