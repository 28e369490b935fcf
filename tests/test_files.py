"""Sources and sinks: bad lines, pruned periods, exact chunks."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks.domain import Domain
from checks.q_reference import SALES, period_source
from pricemill.sources import files


def write(folder: Path, **lines: str) -> str:
    folder.mkdir()
    for name, text in lines.items():
        (folder / f"{name}.csv").write_text(text)
    return str(folder)


def test_a_bad_line_fails_with_its_file_and_content(spark, tmp_path):
    path = write(tmp_path / "d.csv", a="k|v\n1|x\n2|y\n", b="k|v\n3|z\n4|too|many\n", c="k|v\n5\n6|ok\n")
    found = {(r.file_nm, r.line) for r in files.bad_lines(spark, path, columns=["k", "v"]).collect()}
    assert found == {("b.csv", "4|too|many"), ("c.csv", "5")}
    frames = files.read_reference_files(spark, str(tmp_path), {"d": {"k": "int", "v": "string"}})
    for use in (lambda df: df.collect(), lambda df: df.count(), lambda df: df.select("v").collect()):
        with pytest.raises(Exception, match=r"file [bc]\.csv, key \d, line (4\|too\|many|5)"):
            use(frames["d"])


def test_a_delivery_of_several_files(spark, tmp_path):
    write(tmp_path / "d.csv", a="k|v\n1|x\n", b="k|v\n2|\n", c="k|v\n")
    rows = files.read_reference_files(spark, str(tmp_path), {"d": {"k": "int", "v": "string"}})["d"]
    assert sorted(tuple(r) for r in rows.collect()) == [(1, "x"), (2, None)]
    assert rows.count() == 2


def test_other_headers_fail(spark, tmp_path):
    path = write(tmp_path / "d.csv", a="k|other\n1|x\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_delimited(spark, path, columns=["k", "v"]).collect()


def scan_of(df) -> str:
    plan = df._jdf.queryExecution().explainString(spark_mode(df, "formatted"))
    return next(part for part in plan.split("\n\n") if "Scan parquet" in part and "PartitionFilters" in part)


def spark_mode(df, mode):
    return df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)


def files_read(df) -> int:
    """Number of files that the executed scan chose."""
    df._jdf.queryExecution().toRdd().count()
    plan = df._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert "FileScan" in text or "Scan parquet" in text
    return df.select(F.input_file_name().alias("f")).distinct().count()


def test_periods_are_pruned(spark, sf_dir):
    source = period_source(Domain(spark, sf_dir))
    all_files = source.select(F.input_file_name().alias("f")).distinct().count()
    one = files.load_period(source, "200012", columns=SALES).filter("units > 20")
    scan = scan_of(one)
    assert "(period" in scan.split("PartitionFilters")[1] and "200012" in scan.split("PartitionFilters")[1].split("\n")[0]
    assert "GreaterThan(units,20" in scan.split("PushedFilters")[1].split("\n")[0]
    assert files_read(one) == 1 < all_files
    wanted = spark.createDataFrame([("200012", 1), ("200101", 1), ("200101", 2)], "period string, n int").filter("n > 0")
    several = files.load_periods(source, wanted.hint("broadcast"), columns=SALES)
    assert "dynamicpruning" in several._jdf.queryExecution().explainString(spark_mode(several, "formatted")).lower()
    assert {r.period for r in several.select("period").distinct().collect()} == {"200012", "200101"}


@pytest.mark.parametrize("parts", [1, 7])
def test_chunks_are_exact_and_ordered(spark, tmp_path, parts):
    lines = [f"{n:07d}" for n in range(1050)] + ["dup"] * 3
    random.Random(1).shuffle(lines)
    df = spark.createDataFrame([(line,) for line in lines], "line string").repartition(parts)
    path = str(tmp_path / "chunks")
    files.write_chunks(df, path, max_lines=100)
    found = {int(f.parent.name.split("=")[1]): f.read_text().split("\n")[:-1] for f in Path(path).glob("chunk=*/*.txt")}
    assert len(list(Path(path).glob("chunk=*/*.txt"))) == len(found) == 11
    assert [len(found[n]) for n in range(11)] == [100] * 10 + [53]
    assert [line for n in range(11) for line in found[n]] == sorted(lines)
    files.write_chunks(df.limit(50), path, max_lines=100)  # a shorter export leaves no old chunk behind
    assert len(list(Path(path).glob("chunk=*/*.txt"))) == 1


def test_row_numbers_of_hot_and_empty_tables(spark):
    df = spark.range(5000).select((F.col("id") % 2).alias("k"), "id").repartition(9)
    numbers = sorted((r.row_no, r.k) for r in files.numbered(df, ["k", "id"]).collect())
    assert [n for n, _ in numbers] == list(range(5000)) and [k for _, k in numbers] == [0] * 2500 + [1] * 2500
    assert files.numbered(df.limit(0), ["k"]).count() == 0
