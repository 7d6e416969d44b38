"""Enrichment joins, radius joins and group lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acrewise.functions.features import EARTH_RADIUS_MILES, haversine_miles
from acrewise.scale import first_per_key, group_medians, lookup_join, medians


def fill_from(df: DataFrame, other: DataFrame, left: str, right: str, col: str, value: str, order: str) -> DataFrame:
    """Fill missing ``col`` with ``value`` of the matching row in ``other``, names compared in lower case.

    ``other`` is reduced to its first row per name, so the join cannot multiply rows.
    """
    lookup = other.select(F.lower(F.col(right)).alias("__name"), F.col(value).alias("__value"), F.col(order).alias("__o"))
    lookup = first_per_key(lookup.where(F.col("__name").isNotNull()), ["__name"], ["__o"]).drop("__o")
    joined = lookup_join(df.withColumn("__name", F.lower(F.col(left))), lookup, ["__name"])
    return joined.withColumn(col, F.coalesce(F.col(col), F.col("__value"))).drop("__name", "__value")


def target_encode(df: DataFrame, key: str = "location", target: str = "price", out: str = "location_target_enc") -> DataFrame:
    """Median target of the row's group; rows without a group value take the global median."""
    per_group = group_medians(df.where(F.col(key).isNotNull()), {"__enc": target}, [key])
    overall = medians(df, [target])[target]
    joined = lookup_join(df, per_group, [key])
    return joined.withColumn(out, F.coalesce(F.col("__enc"), F.lit(overall).cast("double"))).drop("__enc")


def target_encode_out_of_fold(
    df: DataFrame,
    id_col: str,
    key: str = "location",
    target: str = "price",
    folds: int = 5,
    seed: int = 42,
    out: str = "location_target_enc",
) -> DataFrame:
    """Target encoding that never sees the row's own fold."""
    fold = F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(folds)).cast("int")
    tagged = df.withColumn("__fold", fold)
    # every row trains the encoding of the other folds
    others = F.array_remove(F.sequence(F.lit(0), F.lit(folds - 1)), F.col("__fold"))
    train = tagged.select(key, target, F.explode(others).alias("__fold"))
    per_group = group_medians(train.where(F.col(key).isNotNull()), {"__enc": target}, [key, "__fold"])
    per_fold = group_medians(train, {"__all": target}, ["__fold"])
    joined = lookup_join(lookup_join(tagged, per_group, [key, "__fold"]), per_fold, ["__fold"])
    return joined.withColumn(out, F.coalesce("__enc", "__all")).drop("__enc", "__all", "__fold")


def group_share(df: DataFrame, key: str, out: str) -> DataFrame:
    """Share of the row's category among rows that have one."""
    known = df.where(F.col(key).isNotNull())
    shares = known.groupBy(key).agg((F.count(F.lit(1)) / F.lit(known.count())).alias(out))
    return lookup_join(df, shares, [key])


def within_radius(
    df: DataFrame, lat0: float, lon0: float, miles: float, lat: str = "latitude", lon: str = "longitude"
) -> DataFrame:
    """Rows at most ``miles`` from one point, with ``distance_mi``; a latitude band is filtered first."""
    band = miles / EARTH_RADIUS_MILES * 57.29577951308232 + 1e-9
    near = df.where(F.col(lat).between(lat0 - band, lat0 + band))
    return near.withColumn("distance_mi", haversine_miles(lat, lon, lat0, lon0)).where(F.col("distance_mi") <= miles)


def radius_join(
    df: DataFrame,
    centers: DataFrame,
    miles: float,
    center_cols: tuple[str, str, str] = ("center_id", "center_lat", "center_lon"),
    lat: str = "latitude",
    lon: str = "longitude",
    on: Sequence[str] = (),
) -> DataFrame:
    """Listings within ``miles`` of each center; ``on`` are columns of both in which they must agree.

    Both sides meet on grid cells: a center is listed under every cell its bounding box touches, a listing
    under its own cell only, so each pair is tested once. Longitude cells wrap at the date line.
    """
    cid, clat, clon = center_cols
    delta = miles / EARTH_RADIUS_MILES
    degrees = delta * 57.29577951308232
    lon_cells = max(1, int(360.0 / max(degrees, 1e-6)))
    size = 360.0 / lon_cells

    def cell(value: Column) -> Column:
        return F.floor(value / size).cast("bigint")

    # widest longitude offset of a circle around the center; the whole ring when a pole is inside
    reach = F.when(
        F.abs(clat) + degrees < 89.999,
        F.degrees(F.asin(F.least(F.lit(1.0), F.sin(F.lit(delta)) / F.cos(F.radians(clat))))),
    ).otherwise(F.lit(180.0))
    pad = 1e-9
    boxes = centers.select(
        cid,
        clat,
        clon,
        *on,
        F.explode(
            F.sequence(cell(F.col(clat) - degrees - pad), cell(F.col(clat) + degrees + pad))
        ).alias("__cy"),
        F.when(
            reach * 2 + size >= 360.0, F.sequence(F.lit(0).cast("bigint"), F.lit(lon_cells - 1).cast("bigint"))
        )
        .otherwise(F.sequence(cell(F.col(clon) - reach - pad), cell(F.col(clon) + reach + pad)))
        .alias("__cxs"),
    )
    boxes = boxes.withColumn("__cx", F.explode("__cxs")).withColumn("__cx", F.pmod("__cx", F.lit(lon_cells))).drop("__cxs")
    cells = df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull()).withColumns(
        {"__cy": cell(F.col(lat)), "__cx": F.pmod(cell(F.col(lon)), F.lit(lon_cells))}
    )
    joined = lookup_join(cells, boxes, [*on, "__cy", "__cx"], how="inner").drop("__cy", "__cx")
    distance = haversine_miles(lat, lon, F.col(clat), F.col(clon))
    return joined.withColumn("distance_mi", distance).where(F.col("distance_mi") <= miles)


def radius_counts(
    df: DataFrame,
    centers: DataFrame,
    miles: float,
    center_cols: tuple[str, str, str] = ("center_id", "center_lat", "center_lon"),
    lat: str = "latitude",
    lon: str = "longitude",
) -> DataFrame:
    """Per center the number ``n`` of listings within ``miles`` and the distance ``nearest`` of the closest; none: no row.

    Listings at one place, and centers at one place, meet once with their counts, so the pairs grow with the places and not
    with the product of the rows.
    """
    cid, clat, clon = center_cols
    places = df.groupBy(lat, lon).agg(F.count(F.lit(1)).alias("__n"))
    spots = centers.groupBy(clat, clon).agg(F.min(cid).alias("__spot"))
    pairs = radius_join(places, spots, miles, ("__spot", clat, clon), lat, lon)
    found = pairs.groupBy(clat, clon).agg(F.sum("__n").alias("n"), F.min("distance_mi").alias("nearest"))
    rows = lookup_join(centers.select(cid, clat, clon), found, [clat, clon], how="inner")
    return rows.groupBy(cid).agg(F.sum("n").alias("n"), F.min("nearest").alias("nearest"))
