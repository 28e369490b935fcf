"""Lines that arrive as files give the tables of the batch run, also after a stop in the middle of a batch."""

import pytest
from pyspark.sql import functions as F

from checks.domain import FIRST, LAST, Domain
from pricemill.operators.buys import normalise_buys
from pricemill.plans.monthly import PriceStore
from pricemill.streaming import buys as streaming


@pytest.fixture
def arriving(spark, sf_dir, tmp_path):
    """Two deliveries, the second with lines that are late; one file is a batch."""
    d = Domain(spark, sf_dir)
    raw, folder = d.raw_buys, str(tmp_path / "in")
    months = raw.filter(F.col("period_dt").between("200101", "200103"))
    late = F.crc32("line_id") % 4 == 0
    stream = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 1)

    def deliver(rows):
        rows.coalesce(1).write.mode("append").parquet(folder)

    expected = sorted(map(str, normalise_buys(months, d.provider_factors, period_from=FIRST, period_to=LAST, batch_id="b").collect()))
    return {
        "deliver": deliver, "stream": lambda: stream.parquet(folder), "factors": d.provider_factors, "expected": expected,
        "store": PriceStore(spark, str(tmp_path / "store")), "checkpoint": str(tmp_path / "state"),
        "parts": (months.filter(~late), months.filter(late & (F.col("period_dt") != "200103")), months.filter(late & (F.col("period_dt") == "200103"))),
    }


def load(a):
    return streaming.load_arrived(a["store"], a["stream"](), a["factors"], batch_id="b", checkpoint=a["checkpoint"])


def loaded(a):
    table = a["store"].read("buys")
    order = normalise_columns(a)
    return sorted(map(str, table.select(*order).collect()))


def normalise_columns(a):
    raw = a["parts"][0]
    return normalise_buys(raw, a["factors"], period_from=FIRST, period_to=LAST, batch_id="b").columns


def test_arrived_lines_equal_the_batch_run(arriving):
    first, second, third = arriving["parts"]
    arriving["deliver"](first)
    assert load(arriving) == ["200101", "200102", "200103"]
    arriving["deliver"](second)
    arriving["deliver"](third)
    assert load(arriving) == ["200101", "200102", "200103"]
    assert loaded(arriving) == arriving["expected"]
    assert load(arriving) == []  # nothing new arrived


@pytest.mark.parametrize("stage", ["land", "load_months"])
def test_a_stop_in_the_middle_of_a_batch(arriving, monkeypatch, stage):
    for part in arriving["parts"]:
        arriving["deliver"](part)
    done, calls = getattr(streaming, stage), []

    def stops(*args, **options):
        calls.append(1)
        result = done(*args, **options)
        if len(calls) == 2:
            raise RuntimeError("stopped")
        return result

    monkeypatch.setattr(streaming, stage, stops)
    with pytest.raises(Exception, match="stopped"):
        load(arriving)
    assert len(calls) == 2
    load(arriving)
    assert loaded(arriving) == arriving["expected"]


@pytest.mark.parametrize("few", [64, 0])
def test_months_of_few_landed_files_are_not_dealt_again(arriving, monkeypatch, few):
    """Landed files hold one month each; only a month of many files is gathered anew."""
    done, seen = streaming.write_periods, []
    monkeypatch.setattr(streaming, "FEW_FILES", few)
    monkeypatch.setattr(streaming, "write_periods", lambda df, path, **options: (seen.append(options), done(df, path, **options)))
    for part in arriving["parts"]:
        arriving["deliver"](part)
    load(arriving)
    assert seen == [{"gathered": few > 0}] * 3
    assert loaded(arriving) == arriving["expected"]
