"""Regional subset of a national table, cleaning of page rows, and the source gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acrewise.scale import first_per_key
from acrewise.schema import LISTING_SCHEMA, coerce_numerics, ensure_columns, standardize_columns

# Columns of the two outputs.
REGION_COLUMNS = [
    "price", "bedrooms", "bathrooms", "sqft", "lot_size", "property_type", "year_built", "location", "latitude",
    "longitude", "description", "state", "zipcode",
]

# Towns whose listings are kept.
TOWNS = ["houston", "katy", "sugar land", "bellaire", "pearland", "cypress", "spring"]
PAGE_COLUMNS = [
    "price", "bedrooms", "bathrooms", "built_up_area", "property_type", "address", "locality", "latitude", "longitude",
    "listing_url", "source",
]


def subset_region(
    df: DataFrame,
    states: tuple[str, ...] = ("TX", "TEXAS"),
    words: tuple[str, ...] = ("TEXAS", "HOUSTON"),
    label: str = "TX",
) -> DataFrame:
    """Regional listings of a national table, in the canonical names, with plausible prices."""
    df = ensure_columns(standardize_columns(df), LISTING_SCHEMA)
    place = F.coalesce(F.upper(F.col("location").cast("string")), F.lit(""))
    cond = F.coalesce(F.upper(F.col("state").cast("string")).isin(*states), F.lit(False))
    for word in words:
        cond = cond | place.contains(word)
    price = F.col("price").try_cast("double")
    kept = df.where(cond & (price > 20_000) & (price < 20_000_000))
    return kept.withColumn("state", F.lit(label)).select(*REGION_COLUMNS)


def clean_scraped(
    df: DataFrame,
    towns: list[str] = TOWNS,
    lo: float = 300,
    hi: float = 25e6,
    order: tuple[Column | str, ...] = ("page_id",),
) -> DataFrame:
    """Typed page rows of the given towns with plausible prices, one per (url, address, price)."""
    for name in PAGE_COLUMNS:
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast("string"))
    df = coerce_numerics(df, ["price", "bedrooms", "bathrooms", "built_up_area", "latitude", "longitude"])
    df = df.withColumn("locality", F.trim(F.coalesce("locality", F.lit("Houston"))))
    kept = df.where(F.lower("locality").rlike("|".join(towns)) & (F.col("price") > lo) & (F.col("price") < hi))
    return first_per_key(kept, ["listing_url", "address", "price"], list(order))


def source_gate(df: DataFrame, min_sources: int = 2, min_rows: int = 10_000, col: str = "source") -> DataFrame:
    """Rows per source; raises when there are too few sources or rows."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("rows"))
    sources = counts.agg(F.count(F.lit(1)).alias("sources")).first()["sources"]
    if sources < min_sources:
        raise RuntimeError(f"only {sources} sources, need {min_sources}")
    rows = df.count()
    if rows < min_rows:
        raise RuntimeError(f"only {rows} rows, need {min_rows}")
    return counts
