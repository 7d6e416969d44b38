"""Row filters and category slices."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acrewise.functions.text import street_of
from acrewise.scale import lookup_join

CORE_COLUMNS = ["price", "sqft", "bedrooms"]


def require(df: DataFrame, cols: list[str] = CORE_COLUMNS) -> DataFrame:
    return df.dropna(subset=cols)


def in_band(c: Column | str, lo: float, hi: float) -> Column:
    """Strictly between ``lo`` and ``hi``."""
    value = F.col(c) if isinstance(c, str) else c
    return (value > lo) & (value < hi)


def in_region(
    state: Column | str = "state",
    location: Column | str = "location",
    states: tuple[str, ...] = ("TX", "TEXAS"),
    city: str = "houston",
) -> Column:
    """State is listed, or the location mentions the city in any case; missing values do not match."""
    st = F.col(state) if isinstance(state, str) else state
    loc = F.col(location) if isinstance(location, str) else location
    return F.coalesce(st.isin(*states), F.lit(False)) | F.coalesce(F.lower(loc).contains(city.lower()), F.lit(False))


def differs(c: Column | str, value) -> Column:
    """Not equal, where a missing value counts as different."""
    return ~(F.col(c) if isinstance(c, str) else c).eqNullSafe(F.lit(value))


def cap_domains(df: DataFrame) -> DataFrame:
    """Caps of the unit cleaner: rate up to 50 000, area up to 10 000, at most ten bedrooms; NULLs are dropped."""
    return df.where(
        (F.col("price_per_sqft") <= 50_000)
        & (F.col("area") < 100_000)
        & (F.col("area") <= 10_000)
        & (F.col("bedRoom") <= 10)
    )


def drop_above(df: DataFrame, c: str, limit: float) -> DataFrame:
    """Drop rows over ``limit`` and keep rows where the value is missing."""
    return df.where(~F.coalesce(F.col(c) > limit, F.lit(False)))


def min_frequency(df: DataFrame, key: str, n: int = 3) -> DataFrame:
    """Rows whose key occurs at least ``n`` times."""
    frequent = df.where(F.col(key).isNotNull()).groupBy(key).count().where(F.col("count") >= n).select(key)
    return lookup_join(df, frequent, [key], how="left_semi")


def top_categories(df: DataFrame, col: str, n: int) -> DataFrame:
    """The ``n`` most frequent values; ties go to the smaller value."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("count"), col).limit(n)


def top_n_categories(df: DataFrame, col: str, n: int) -> DataFrame:
    """Rows belonging to the ``n`` most frequent values; the broadcast side has at most ``n`` rows."""
    return df.join(F.broadcast(top_categories(df, col, n).select(col)), col, "left_semi")


@dataclass(frozen=True)
class ListingFilter:
    """Dashboard slice; ``None`` means no restriction. ``bedrooms`` of ``"5+"`` means five or more."""

    location: str | None = None
    cluster: int | None = None
    street: str | None = None
    bedrooms: str | None = None
    property_type: str | None = None
    min_price: float | None = None
    max_price: float | None = None

    def predicate(self) -> Column:
        cond = F.lit(True)
        if self.location is not None:
            cond = cond & (F.col("location") == self.location)
        if self.cluster is not None:
            cond = cond & (F.col("location_cluster") == self.cluster)
        if self.street is not None:
            cond = cond & (street_of("address") == self.street)
        if self.bedrooms is not None:
            exact = F.col("bedrooms") >= 5 if self.bedrooms == "5+" else F.col("bedrooms") == int(self.bedrooms)
            cond = cond & exact
        if self.property_type is not None:
            cond = cond & (F.col("property_type") == self.property_type)
        if self.min_price is not None:
            cond = cond & (F.col("price") >= self.min_price)
        if self.max_price is not None:
            cond = cond & (F.col("price") <= self.max_price)
        return cond


def slice_listings(df: DataFrame, listing_filter: ListingFilter) -> DataFrame:
    return df.where(listing_filter.predicate())


# Thresholds that mark a unit row as suspicious.
UNIT_ANOMALIES = {
    "tiny_rooms": ("area / bedRoom", "<", 183),
    "rate_over_42k": ("price_per_sqft", ">", 42_000),
    "rate_over_50k": ("price_per_sqft", ">", 50_000),
    "rate_over_100k": ("price_per_sqft", ">", 100_000),
    "area_over_10k": ("area", ">", 10_000),
    "area_over_100k": ("area", ">", 100_000),
    "super_area_over_6k": ("super_built_up_area", ">", 6_000),
    "built_area_over_10k": ("built_up_area", ">", 10_000),
    "carpet_area_over_10k": ("carpet_area", ">", 10_000),
    "over_10_bedrooms": ("bedRoom", ">", 10),
    "over_10_bathrooms": ("bathroom", ">", 10),
}


def anomalies(df: DataFrame, rules: dict[str, tuple[str, str, float]] = UNIT_ANOMALIES) -> DataFrame:
    """Rows breaking at least one rule, with the names of the broken rules; one pass for all rules."""
    marks = [F.when(F.expr(f"{value} {op} {limit}"), F.lit(name)) for name, (value, op, limit) in rules.items()]
    return df.withColumn("anomalies", F.array_compact(F.array(*marks))).where(F.size("anomalies") > 0)
