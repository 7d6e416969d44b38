"""Interquartile-range outlier treatment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acrewise.functions.features import fix_small_area, rate_from_area
from acrewise.scale import quantile_values


def iqr_bounds(df: DataFrame, cols: list[str], k: float = 1.5) -> dict[str, tuple[float, float] | None]:
    """Fences per column, all from one pass; None where the range is empty or zero."""
    bounds = {}
    for c, (q1, q3) in quantile_values(df, cols, [0.25, 0.75]).items():
        spread = None if q1 is None else q3 - q1
        bounds[c] = (q1 - k * spread, q3 + k * spread) if spread is not None and spread > 0 else None
    return bounds


def remove_outliers_iqr(df: DataFrame, cols: list[str], k: float = 1.5) -> DataFrame:
    """Filter column by column, each fence computed on the rows the previous columns kept.

    The fences are driver scalars, so the returned plan is a plain chain of literal filters.
    """
    for c in cols:
        fence = iqr_bounds(df, [c], k)[c]
        if fence is not None:
            df = df.where(F.col(c).between(*fence))
    return df


def iqr_mask(df: DataFrame, cols: list[str], k: float = 1.5) -> Column:
    """One condition over all columns, fences and medians taken on the same frame; gaps count as the median."""
    found = quantile_values(df, cols, [0.5])
    filled = df.select(*[F.coalesce(F.col(c), F.lit(found[c][0]).cast("double")).alias(c) for c in cols])
    keep = F.lit(True)
    for c, fence in iqr_bounds(filled, cols, k).items():
        if fence is not None:
            keep = keep & F.coalesce(F.col(c), F.lit(found[c][0]).cast("double")).between(*fence)
    return keep


def outside(c: str, fence: tuple[float, float]) -> Column:
    return (F.col(c) < fence[0]) | (F.col(c) > fence[1])


def iqr_outliers(df: DataFrame, col: str, k: float = 1.5) -> DataFrame:
    fence = iqr_bounds(df, [col], k)[col]
    return df.where(outside(col, fence)) if fence is not None else df.limit(0)


def iqr_report(df: DataFrame, col: str, k: float = 1.5) -> DataFrame:
    """Fences and summary statistics of the rows outside them."""
    fence = iqr_bounds(df, [col], k)[col] or (None, None)
    rows = iqr_outliers(df, col, k)
    q25, q50, q75 = quantile_values(rows, [col], [0.25, 0.5, 0.75])[col]
    value = F.col(col)
    return rows.agg(
        F.lit(fence[0]).cast("double").alias("lower"),
        F.lit(fence[1]).cast("double").alias("upper"),
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.lit(q25).cast("double").alias("q25"),
        F.lit(q50).cast("double").alias("q50"),
        F.lit(q75).cast("double").alias("q75"),
        F.max(value).alias("max"),
    )


def top_outliers(df: DataFrame, col: str, key: str, n: int = 20, k: float = 1.5) -> DataFrame:
    return iqr_outliers(df, col, k).orderBy(F.desc(col), key).limit(n)


def repair_rate_outliers(df: DataFrame, k: float = 1.5) -> DataFrame:
    """On rate outliers, read small areas as square yards and recompute the rate; known results replace the row's."""
    fence = iqr_bounds(df, ["price_per_sqft"], k)["price_per_sqft"]
    if fence is None:
        return df
    hit = F.coalesce(outside("price_per_sqft", fence), F.lit(False))
    area = fix_small_area("area")
    rate = rate_from_area("price", area)
    return df.withColumns(
        {
            "area": F.when(hit, F.coalesce(area, F.col("area"))).otherwise(F.col("area")),
            "price_per_sqft": F.when(hit, F.coalesce(rate, F.col("price_per_sqft"))).otherwise(F.col("price_per_sqft")),
        }
    )
