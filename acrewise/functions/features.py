"""Derived listing features: ratios, geography, amenities, luxury score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acrewise.scale import group_medians, lookup_join, medians, quantile_values

# Earth radius and city centre of the distances.
EARTH_RADIUS_MILES = 3958.7613
CENTER_LAT, CENTER_LON = 29.7604, -95.3698

# Amenity flag to description pattern, in column order.
AMENITY_PATTERNS = {
    "has_pool": r"\bpool\b",
    "has_garage": r"\bgarage\b",
    "has_gym": r"\bgym\b",
    "has_garden": r"\bgarden\b",
    "has_security": r"\bsecurity|gated\b",
    "has_fireplace": r"\bfireplace\b",
    "has_office": r"\boffice\b",
}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(num: Column | str, den: Column | str) -> Column:
    """num / den, NULL when the denominator is 0 or missing."""
    return F.try_divide(_col(num), _col(den))


def with_ratios(df: DataFrame, specs: dict[str, tuple[str, str]]) -> DataFrame:
    """Add ratio columns, their gaps filled with the column's exact median (one pass for all of them)."""
    df = df.withColumns({out: ratio(num, den) for out, (num, den) in specs.items()})
    middle = medians(df, list(specs))
    return df.withColumns({out: F.coalesce(F.col(out), F.lit(middle[out]).cast("double")) for out in specs})


def property_age(c: Column | str, as_of_year: int) -> Column:
    return clip(F.lit(as_of_year) - _col(c), lo=0.0)


def clip(c: Column | str, lo: float | None = None, hi: float | None = None) -> Column:
    """Bound a value, leaving NULL alone (``greatest``/``least`` would skip it)."""
    value = _col(c)
    out = value
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    if hi is not None:
        out = F.least(out, F.lit(hi))
    return F.when(value.isNotNull(), out)


def haversine_miles(lat: Column | str, lon: Column | str, lat0: Column | float, lon0: Column | float) -> Column:
    """Great-circle distance in miles."""
    a1, b1 = F.radians(_col(lat)), F.radians(_col(lon))
    a2 = F.radians(F.lit(lat0) if isinstance(lat0, (int, float)) else lat0)
    b2 = F.radians(F.lit(lon0) if isinstance(lon0, (int, float)) else lon0)
    h = F.pow(F.sin((a2 - a1) / 2), 2) + F.cos(a1) * F.cos(a2) * F.pow(F.sin((b2 - b1) / 2), 2)
    bounded = F.when(h.isNotNull(), F.least(F.greatest(h, F.lit(0.0)), F.lit(1.0)))
    return 2 * EARTH_RADIUS_MILES * F.asin(F.sqrt(bounded))


def dist_to_center(df: DataFrame, key: str = "location", out: str = "dist_to_location_center_mi") -> DataFrame:
    """Distance to the median point of the row's group; missing coordinates use the global median first."""
    mid = medians(df, ["latitude", "longitude"])
    centers = group_medians(df.where(F.col(key).isNotNull()), {"__clat": "latitude", "__clon": "longitude"}, [key])
    lat = F.coalesce(F.col("latitude"), F.lit(mid["latitude"]).cast("double"))
    lon = F.coalesce(F.col("longitude"), F.lit(mid["longitude"]).cast("double"))
    joined = lookup_join(df, centers, [key])
    return joined.withColumn(out, haversine_miles(lat, lon, F.col("__clat"), F.col("__clon"))).drop("__clat", "__clon")


def amenity_flags(c: Column | str) -> dict[str, Column]:
    text = F.lower(F.coalesce(_col(c), F.lit("")))
    return {name: text.rlike(pattern).cast("int") for name, pattern in AMENITY_PATTERNS.items()}


def with_amenities(df: DataFrame, c: str = "description") -> DataFrame:
    df = df.withColumns(amenity_flags(c))
    total = F.lit(0)
    for name in AMENITY_PATTERNS:
        total = total + F.col(name)
    return df.withColumn("amenity_count", total)


def luxury_score(df: DataFrame, out: str = "luxury_score") -> DataFrame:
    """Mean of relative size, relative price per sqft and amenity share, times ten."""
    mid = medians(df, ["sqft", "price_per_sqft"])
    raw = (
        F.try_divide(F.col("sqft"), F.lit(mid["sqft"]).cast("double"))
        + F.try_divide(F.col("price_per_sqft"), F.lit(mid["price_per_sqft"]).cast("double"))
        + F.col("amenity_count") / len(AMENITY_PATTERNS)
    ) / 3
    return df.withColumn(out, round_even(raw * 10, 2))


def luxury_x_sqft(score: Column | str = "luxury_score", sqft: Column | str = "sqft") -> Column:
    return _col(score) * F.log1p(clip(sqft, lo=0.0))


def luxury_segment(df: DataFrame, q: float = 0.8, score: str = "luxury_score", out: str = "is_luxury_segment") -> DataFrame:
    floor = quantile_values(df, [score], [q])[score][0]
    return df.withColumn(out, F.coalesce((F.col(score) >= F.lit(floor).cast("double")).cast("int"), F.lit(0)))


def type_rarity(df: DataFrame, key: str = "property_type", out: str = "property_type_rarity") -> DataFrame:
    """One minus the share of the row's category; a missing category counts as its own value."""
    counts = df.groupBy(F.col(key)).agg(F.count(F.lit(1)).alias("__n"))
    total = df.count()
    joined = lookup_join(df, counts, [key], null_safe=True)
    return joined.withColumn(out, 1 - F.col("__n") / F.lit(total)).drop("__n")


def round_even(c: Column, digits: int = 0) -> Column:
    """Array-library rounding: scale, round half to even, scale back."""
    scale = float(10**digits)
    return F.rint(c * scale) / scale


def area_from_rate(price_crore: Column | str, rate: Column | str) -> Column:
    return round_even(F.try_divide(_col(price_crore) * 1e7, _col(rate)))


def rate_from_area(price_crore: Column | str, area: Column | str, digits: int = 0) -> Column:
    return round_even(F.try_divide(_col(price_crore) * 1e7, _col(area)), digits)


def fix_small_area(c: Column | str, below: float = 1000, factor: float = 9) -> Column:
    """Areas under ``below`` were entered in square yards."""
    return F.when(_col(c) < below, _col(c) * factor).otherwise(_col(c))


def log_target(c: Column | str) -> Column:
    return F.log1p(_col(c))


def from_log_target(c: Column | str) -> Column:
    return F.expm1(_col(c))
