"""Registry helpers shared by the query modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acrewise.fixtures import table, view, with_ctes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add


def over(ctes: str, body: str) -> str:
    """Oracle text over the named views; ``body`` is a SELECT, or starts with further ``, name AS (...)``."""
    return f"{with_ctes(*ctes.split())} {body}"


def listings(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "listings")


def units(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "units")


def flats(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "flats")


def r(c: Column | str, digits: int = 6) -> Column:
    """Round half away from zero by scaling, the way the oracle's ``round`` does."""
    value, scale = F.col(c) if isinstance(c, str) else c, float(10**digits)
    return F.signum(value) * F.floor(F.abs(value) * scale + 0.5) / scale


def rounded(df: DataFrame, cols: dict[str, int]) -> DataFrame:
    return df.withColumns({c: r(c, n) for c, n in cols.items()})


__all__ = ["ORACLES", "QUERIES", "flats", "listings", "over", "query", "r", "rounded", "table", "units", "view"]
