"""Canonical listing schema and the column-level clean-up that produces it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Canonical listing columns, in output order.
LISTING_SCHEMA = T.StructType(
    [
        T.StructField("price", T.DoubleType()),
        T.StructField("bedrooms", T.DoubleType()),
        T.StructField("bathrooms", T.DoubleType()),
        T.StructField("sqft", T.DoubleType()),
        T.StructField("lot_size", T.DoubleType()),
        T.StructField("property_type", T.StringType()),
        T.StructField("year_built", T.DoubleType()),
        T.StructField("location", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("description", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("zipcode", T.StringType()),
        T.StructField("address", T.StringType()),
        T.StructField("listing_url", T.StringType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("data_tier", T.StringType()),
        T.StructField("is_synthetic_augment", T.BooleanType()),
    ]
)
LISTING_COLUMNS = LISTING_SCHEMA.fieldNames()
NUMERIC_COLUMNS = [f.name for f in LISTING_SCHEMA if isinstance(f.dataType, T.DoubleType)]

# Source spellings of the canonical columns.
COLUMN_SYNONYMS = {
    "bed": "bedrooms",
    "beds": "bedrooms",
    "bath": "bathrooms",
    "baths": "bathrooms",
    "sqft_living": "sqft",
    "house_size": "sqft",
    "acre_lot": "lot_size",
    "lot": "lot_size",
    "type": "property_type",
    "city": "location",
}


def standardize_columns(df: DataFrame) -> DataFrame:
    """Rename known synonyms; ``zip_code`` becomes ``zipcode`` only when that name is free."""
    renames = {c: COLUMN_SYNONYMS[c] for c in df.columns if c in COLUMN_SYNONYMS}
    if "zip_code" in df.columns and "zipcode" not in df.columns:
        renames["zip_code"] = "zipcode"
    return df.withColumnsRenamed(renames) if renames else df


def ensure_columns(df: DataFrame, schema: T.StructType = LISTING_SCHEMA) -> DataFrame:
    """Add every column of ``schema`` that is absent as a typed NULL; boolean flags default to false."""
    added = {f.name: F.lit(None).cast(f.dataType) for f in schema if f.name not in df.columns}
    if added:
        df = df.withColumns(added)
    flags = {
        f.name: F.coalesce(F.col(f.name).cast("boolean"), F.lit(False))
        for f in schema
        if isinstance(f.dataType, T.BooleanType)
    }
    return df.withColumns(flags) if flags else df


def to_numeric(c: Column | str) -> Column:
    """Coerce to double; anything unreadable, and NaN, becomes NULL."""
    value = (F.col(c) if isinstance(c, str) else c).try_cast("double")
    return F.when(~F.isnan(value), value)


def coerce_numerics(df: DataFrame, cols: list[str] = NUMERIC_COLUMNS) -> DataFrame:
    return df.withColumns({c: to_numeric(c) for c in cols if c in df.columns})


def fill_defaults(df: DataFrame) -> DataFrame:
    """Text defaults of the listing cleaner."""
    return df.withColumns(
        {
            "location": F.trim(F.coalesce(F.col("location"), F.lit("unknown"))),
            "description": F.coalesce(F.col("description"), F.lit("")),
            "state": F.upper(F.coalesce(F.col("state"), F.lit("TX"))),
        }
    )


def missing_columns(available: list[str], wanted: list[str]) -> list[str]:
    """Columns of ``wanted`` that ``available`` lacks, sorted."""
    return sorted(set(wanted) - set(available))


def ordered_unique(*groups: list[str]) -> list[str]:
    """Concatenate column lists, keeping the first occurrence of each name."""
    return list(dict.fromkeys(name for group in groups for name in group))
