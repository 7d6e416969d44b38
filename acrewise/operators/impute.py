"""Filling of missing values and hand corrections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acrewise.functions.features import round_even
from acrewise.scale import lookup_join, medians

MEDIAN_FILLED = ["bathrooms", "latitude", "longitude", "lot_size", "year_built"]

# Super built-up and carpet area relative to built-up area.
SUPER_RATIO, CARPET_RATIO = 1.105, 0.9


def fill_medians(df: DataFrame, cols: list[str] = MEDIAN_FILLED) -> DataFrame:
    """Fill gaps with each column's exact global median; all medians come from one pass."""
    found = {c: v for c, v in medians(df, cols).items() if v is not None}
    return df.fillna(found) if found else df


def learned_ratios(df: DataFrame) -> DataFrame:
    """Median super/built-up and carpet/built-up ratio over rows that have all three areas."""
    full = df.dropna(subset=["super_built_up_area", "built_up_area", "carpet_area"]).select(
        F.try_divide("super_built_up_area", "built_up_area").alias("super_ratio"),
        F.try_divide("carpet_area", "built_up_area").alias("carpet_ratio"),
    )
    found = medians(full, ["super_ratio", "carpet_ratio"])
    return df.sparkSession.createDataFrame(
        [(found["super_ratio"], found["carpet_ratio"])], "super_ratio double, carpet_ratio double"
    )


def impute_built_up(df: DataFrame, ratios: str = "fixed") -> DataFrame:
    """Built-up area from the super built-up and carpet areas, whichever are known."""
    if ratios == "learned":
        sup_ratio, carpet_ratio = learned_ratios(df).first()
    else:
        sup_ratio, carpet_ratio = SUPER_RATIO, CARPET_RATIO
    sup, carpet = F.col("super_built_up_area") / sup_ratio, F.col("carpet_area") / carpet_ratio
    guess = (
        F.when(sup.isNotNull() & carpet.isNotNull(), round_even((sup + carpet) / 2))
        .when(sup.isNotNull(), round_even(sup))
        .otherwise(round_even(carpet))
    )
    return df.withColumn("built_up_area", F.coalesce(F.col("built_up_area"), guess))


def overlay(df: DataFrame, condition: Column, col: str, value: Column) -> DataFrame:
    """Replace ``col`` where the condition holds and the new value is known."""
    return df.withColumn(col, F.when(condition, F.coalesce(value, F.col(col))).otherwise(F.col(col)))


def fix_small_built_up(df: DataFrame) -> DataFrame:
    """Expensive units with a small built-up area take the derived area instead."""
    return overlay(df, (F.col("built_up_area") < 2000) & (F.col("price") > 2.5), "built_up_area", F.col("area"))


def group_mode(df: DataFrame, col: str, keys: list[str], out: str) -> DataFrame:
    """Most frequent value per key, ties to the smallest; rows with a missing key or value are left out."""
    known = df.dropna(subset=[*keys, col])
    counts = known.groupBy(*keys, col).agg(F.count(F.lit(1)).alias("__n"))
    best = F.min(F.struct((-F.col("__n")).alias("n"), F.col(col).alias("v")))
    return counts.groupBy(*keys).agg(best.alias("__best")).select(*keys, F.col("__best.v").alias(out))


def impute_mode_hierarchy(
    df: DataFrame,
    col: str = "agePossession",
    sentinel: str = "Undefined",
    levels: tuple[tuple[str, ...], ...] = (("sector", "property_type"), ("sector",), ("property_type",)),
) -> DataFrame:
    """Replace ``sentinel`` by the group mode, level after level; each pass sees the previous one's result.

    A sentinel row whose key is missing, or whose group has no mode, becomes NULL.
    """
    for level in levels:
        modes = group_mode(df, col, list(level), "__mode")
        df = lookup_join(df, modes, list(level))
        df = df.withColumn(col, F.when(F.col(col) == sentinel, F.col("__mode")).otherwise(F.col(col))).drop("__mode")
    return df


def apply_corrections(df: DataFrame, corrections: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Overlay hand corrections given as (key, column, value text) rows."""
    wide = corrections.groupBy(key).agg(
        *[F.max(F.when(F.col("column") == c, F.col("value"))).alias(f"__new_{c}") for c in cols]
    )
    joined = lookup_join(df, wide, [key])
    types = dict(df.dtypes)
    return joined.withColumns(
        {c: F.coalesce(F.col(f"__new_{c}").try_cast(types[c]), F.col(c)) for c in cols}
    ).drop(*[f"__new_{c}" for c in cols])
