"""Adapters from vendor export layouts to the canonical listing columns."""

from __future__ import annotations

import ast
import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acrewise.functions.features import CENTER_LAT, CENTER_LON
from acrewise.functions.property_type import normalize_property_type
from acrewise.functions.text import digits_to_number, parse_money, parse_sqft
from acrewise.operators.sampling import gaussian
from acrewise.schema import to_numeric

# Site prefix and source name of the nested-record export.
BLOB_SITE = "https://www.zillow.com"
BLOB_SOURCE = "zillow_property_blob"

# Canonical column to candidate columns of the wide export, first present one wins.
WIDE_CANDIDATES = {
    "bedrooms": ["hdpData/homeInfo/bedrooms", "beds"],
    "bathrooms": ["hdpData/homeInfo/bathrooms", "baths"],
    "sqft": ["hdpData/homeInfo/livingArea", "area"],
    "lot_size": ["hdpData/homeInfo/lotAreaValue"],
    "property_type": ["hdpData/homeInfo/homeType"],
    "year_built": ["hdpData/homeInfo/yearBuilt"],
    "location": ["addressCity", "city"],
    "latitude": ["latLong/latitude", "hdpData/homeInfo/latitude"],
    "longitude": ["latLong/longitude", "hdpData/homeInfo/longitude"],
    "state": ["addressState"],
    "zipcode": ["addressZipcode", "zipcode"],
    "address": ["address"],
    "listing_url": ["detailUrl", "url"],
}

# The same for the semicolon export.
SEMICOLON_CANDIDATES = {
    "bedrooms": ["beds"],
    "bathrooms": ["baths"],
    "sqft": ["area"],
    "lot_size": [],
    "property_type": ["homeType"],
    "year_built": ["yearBuilt"],
    "location": ["city"],
    "latitude": ["latitude"],
    "longitude": ["longitude"],
    "description": ["description"],
    "state": ["state"],
    "zipcode": ["zipcode"],
    "address": ["fullAddress", "street"],
    "listing_url": ["url"],
}

# Canonical column to header fragments of the listing export, tried in order.
EXPORT_FRAGMENTS = {
    "price": ["pricing"],
    "sqft": ["living_area", "living area"],
    "bedrooms": ["number_of_bedrooms", "bedroom"],
    "bathrooms": ["number_of_bathrooms", "bathroom"],
    "location": ["city"],
    "state": ["state"],
    "zipcode": ["zipcode", "zip"],
    "address": ["street_address", "street"],
    "year_built": ["built_year", "built"],
    "description": ["description"],
    "listing_url": ["listing_url", "listing"],
    "property_type": ["property_type", "home_type", "hometype", "type"],
}

RAW_COLUMNS = [
    "price", "bedrooms", "bathrooms", "sqft", "lot_size", "property_type", "year_built", "location", "latitude",
    "longitude", "description", "state", "zipcode", "address", "listing_url", "source_file",
]
_NUMERIC = {"bedrooms", "bathrooms", "sqft", "lot_size", "year_built", "latitude", "longitude"}
# Defaults of absent columns.
_DEFAULTS = {"property_type": "unknown", "location": "Houston", "state": "TX", "description": "", "address": "", "listing_url": ""}


def _raw(df: DataFrame, found: dict[str, str | None]) -> dict[str, Column]:
    """Typed canonical columns from resolved source columns; absent ones take their default or NULL."""
    types = {f.name: f.dataType for f in df.schema}
    out: dict[str, Column] = {}
    for name in RAW_COLUMNS:
        source = found.get(name)
        if source is None:
            default = _DEFAULTS.get(name)
            out[name] = F.lit(default) if default is not None else F.lit(None).cast("double" if name in _NUMERIC else "string")
            continue
        value = F.col(f"`{source}`")
        if name == "price":
            out[name] = parse_money(value, types[source])
        elif name in _NUMERIC:
            out[name] = to_numeric(value)
        elif name == "property_type":
            out[name] = normalize_property_type(value)
        elif name == "state":
            out[name] = F.upper(value.cast("string"))
        elif name == "description":
            out[name] = F.coalesce(value.cast("string"), F.lit(""))
        else:
            out[name] = value.cast("string")
    return out


def _first_present(df: DataFrame, candidates: dict[str, list[str]]) -> dict[str, str | None]:
    return {name: next((c for c in options if c in df.columns), None) for name, options in candidates.items()}


def _emit(df: DataFrame, columns: dict[str, Column], keep: list[str]) -> DataFrame:
    return df.select(*[c.alias(name) for name, c in columns.items()], *keep)


def _passthrough(df: DataFrame, keep: tuple[str, ...]) -> list[str]:
    return [c for c in keep if c in df.columns]


def from_wide(df: DataFrame, min_price: float = 10_000, keep: tuple[str, ...] = ()) -> DataFrame:
    """Wide export: for every canonical column the first existing alternative; low prices are dropped."""
    found = _first_present(df, WIDE_CANDIDATES)
    if "price" not in df.columns or found["listing_url"] is None:
        return _empty(df)
    found |= {"price": "price", "source_file": "source_file" if "source_file" in df.columns else None}
    return _emit(df, _raw(df, found), _passthrough(df, keep)).where(F.col("price") >= min_price)


def from_semicolon(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Semicolon export: any row with a readable price."""
    if not {"price", "city"} <= set(df.columns):
        return _empty(df)
    found = _first_present(df, SEMICOLON_CANDIDATES)
    found |= {"price": "price", "source_file": "source_file" if "source_file" in df.columns else None}
    return _emit(df, _raw(df, found), _passthrough(df, keep)).where(F.col("price").isNotNull())


def resolve_headers(columns: list[str]) -> dict[str, str | None]:
    """Map canonical names to listing-export headers by fragment: fragment order first, then column order."""
    normal = {c.lower().replace(" ", "_"): c for c in columns}

    def pick(fragments: list[str]) -> str | None:
        return next((v for f in fragments for k, v in normal.items() if f in k), None)

    return {name: pick(fragments) for name, fragments in EXPORT_FRAGMENTS.items()}


def from_listing_export(
    df: DataFrame, min_price: float = 10_000, jitter_geo: bool = True, seed: int = 42, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Listing export: columns found by header fragment, priced rows of the region only, jittered coordinates."""
    data_columns = [c for c in df.columns if c not in ("source_file", *keep)]
    if "listing url" not in [c.lower() for c in data_columns]:
        return _empty(df)
    found = resolve_headers(data_columns)
    if found["price"] is None:
        return _empty(df)
    found |= {"source_file": "source_file" if "source_file" in df.columns else None}
    columns = _raw(df, found)
    if found["sqft"] is not None:
        columns["sqft"] = parse_sqft(F.col(f"`{found['sqft']}`"))
    rows = _emit(df, columns, _passthrough(df, keep)).where(F.col("price") >= min_price)
    region = F.coalesce(F.col("state").contains("TX"), F.lit(False)) | F.coalesce(
        F.lower("location").contains("houston"), F.lit(False)
    )
    rows = rows.where(region)
    if not jitter_geo:
        return rows
    key = F.xxhash64("listing_url", "address", "price", "zipcode")
    return jitter_missing_geo(rows, key, seed)


def jitter_missing_geo(
    df: DataFrame, key: Column, seed: int = 42, sd_lat: float = 0.08, sd_lon: float = 0.10
) -> DataFrame:
    """Place rows without coordinates around the centre; the noise depends on the row key only."""
    missing = F.col("latitude").isNull() | F.col("longitude").isNull()
    return df.withColumns(
        {
            "latitude": F.when(missing, CENTER_LAT + sd_lat * gaussian(key, seed, 0)).otherwise(F.col("latitude")),
            "longitude": F.when(missing, CENTER_LON + sd_lon * gaussian(key, seed, 1)).otherwise(F.col("longitude")),
        }
    )


_BLOB_SCHEMA = """
price STRING, bedrooms STRING, bathrooms STRING, livingArea STRING, propertyType STRING, yearBuilt STRING,
lotSizeWithUnit STRUCT<lotSize: STRING>, location STRUCT<latitude: STRING, longitude: STRING>,
address STRUCT<streetAddress: STRING, city: STRING, state: STRING, zipcode: STRING>, hdpView STRUCT<hdpUrl: STRING>
"""


@F.pandas_udf(T.StringType())
def python_literal_to_json(texts: pd.Series) -> pd.Series:
    """Rewrite Python dict literals as JSON; unreadable text becomes NULL. Spark parses the result."""

    def rewrite(text: str | None) -> str | None:
        if text is None or not text.strip().startswith("{"):
            return None
        try:
            value = ast.literal_eval(text.strip())
            return json.dumps(value) if isinstance(value, dict) else None
        except (SyntaxError, ValueError, TypeError, MemoryError, RecursionError):
            return None

    return texts.map(rewrite, na_action="ignore")


# or the filter on prices, pushed below it, would have every cell parsed twice, and before its rows are dealt out
python_literal_to_json = python_literal_to_json.asNondeterministic()


def from_blob(df: DataFrame, col: str = "property", literal: str = "python", keep: tuple[str, ...] = ()) -> DataFrame:
    """Nested-record export: one dict per cell, as a Python literal or as JSON; prices under 1 000 are dropped."""
    if col not in df.columns:
        return _empty(df)
    text = F.trim(F.col(col))
    doc = python_literal_to_json(text) if literal == "python" else F.when(text.startswith("{"), text)
    rows = df.where(F.col(col).isNotNull()).select(F.from_json(doc, _BLOB_SCHEMA).alias("j"), *_passthrough(df, keep))
    price_text = F.when(F.col("j.price").startswith("{"), F.get_json_object("j.price", "$.value")).otherwise(F.col("j.price"))
    zipcode = F.col("j.address.zipcode")
    city = _filled(F.col("j.address.city"), "Houston")
    url = F.col("j.hdpView.hdpUrl")
    columns = {
        "price": F.coalesce(price_text.try_cast("double"), digits_to_number(price_text)),
        "bedrooms": to_numeric(F.col("j.bedrooms")),
        "bathrooms": to_numeric(F.col("j.bathrooms")),
        "sqft": to_numeric(F.col("j.livingArea")),
        "lot_size": to_numeric(F.col("j.lotSizeWithUnit.lotSize")),
        "property_type": normalize_property_type(_filled(F.col("j.propertyType"), "unknown")),
        "year_built": to_numeric(F.col("j.yearBuilt")),
        "location": F.trim(city),
        "latitude": to_numeric(F.col("j.location.latitude")),
        "longitude": to_numeric(F.col("j.location.longitude")),
        "description": F.lit(""),
        "state": F.upper(_filled(F.col("j.address.state"), "TX")),
        "zipcode": zipcode,
        "address": F.trim(
            F.concat(_filled(F.col("j.address.streetAddress"), ""), F.lit(", "), city, F.lit(", TX "), _filled(zipcode, ""))
        ),
        "listing_url": F.when(url.startswith("/"), F.concat(F.lit(BLOB_SITE), url)).otherwise(url),
        "source_file": F.lit(BLOB_SOURCE),
    }
    return _emit(rows, columns, _passthrough(df, keep)).where(F.col("price") >= 1_000)


def _filled(c: Column, default: str) -> Column:
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(default))


def _empty(df: DataFrame) -> DataFrame:
    columns = {n: F.lit(None).cast("double" if n in _NUMERIC or n == "price" else "string") for n in RAW_COLUMNS}
    return df.limit(0).select(*[c.alias(n) for n, c in columns.items()])
