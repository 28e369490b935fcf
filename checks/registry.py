"""Registered queries: a Spark callable, its output columns, and the SQL that must agree."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks.base_sql import base
from checks.domain import Domain, domain

SPARK_TYPES = {"i": "bigint", "d": "double", "s": "string"}
SQL_TYPES = {"i": "BIGINT", "d": "DOUBLE", "s": "VARCHAR"}


@dataclass(frozen=True)
class Query:
    key: str
    columns: list[tuple[str, str]]
    run: Callable[[Domain], DataFrame]
    select: str | None
    ctes: str
    grain: str

    def spark(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = self.run(domain(spark, sf_dir, self.grain))
        return df.select(*[F.col(f"`{c}`").cast(SPARK_TYPES[t]).alias(c) for c, t in self.columns])

    @property
    def sql(self) -> str | None:
        if self.select is None:
            return None
        casts = ", ".join(f'CAST("{c}" AS {SQL_TYPES[t]}) AS "{c}"' for c, t in self.columns)
        return f"WITH RECURSIVE {base(self.grain)}{self.ctes},\nresult AS ({self.select})\nSELECT {casts} FROM result"


QUERIES: dict[str, Query] = {}


def add(
    key: str,
    columns: str,
    run: Callable[[Domain], DataFrame],
    select: str | None = None,
    *,
    ctes: str = "",
    grain: str = "name",
) -> None:
    """``columns`` is a comma list of ``name:type`` with type i, d or s."""
    pairs = [tuple(c.strip().rsplit(":", 1)) for c in columns.split(",") if c.strip()]
    assert key not in QUERIES, key
    extra = f",\n{ctes}" if ctes else ""
    QUERIES[key] = Query(key, pairs, run, select, extra, grain)
