"""Unit jobs: clean the flat and house exports, merge them, parse the text columns, repair and impute."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acrewise.functions.features import area_from_rate, rate_from_area
from acrewise.functions.text import (
    age_category,
    alias_cascade,
    balcony_count,
    clean_society,
    contains_flags,
    floor_number,
    furnishing_count,
    furnishing_terms,
    leading_int,
    parse_list,
    parse_rate,
    price_to_crore,
    sector_of,
    weighted_score,
    with_areas,
)
from acrewise.functions.unit_values import AMENITY_WEIGHTS, ROOM_KINDS, SECTOR_ALIASES, SECTOR_ALIASES_AFTER
from acrewise.operators.encode import cluster
from acrewise.operators.filters import cap_domains, differs, min_frequency
from acrewise.operators.impute import apply_corrections, fix_small_built_up, impute_built_up, impute_mode_hierarchy
from acrewise.operators.joins import fill_from
from acrewise.operators.outliers import repair_rate_outliers
from acrewise.operators.sampling import concat_tables
from acrewise.scale import stage


def _clean_units(df: DataFrame, kind: str, missing_society: str | None) -> DataFrame:
    """Columns both exports share: numbers out of texts, text defaults, derived area."""
    rows = df.where(F.col("bedRoom").isNotNull()).drop("link")
    rows = rows.withColumns(
        {
            "property_type": F.lit(kind),
            "society": clean_society("society", missing_society),
            "price": price_to_crore("price"),
            "price_per_sqft": parse_rate("price_per_sqft"),
            "bedRoom": leading_int("bedRoom"),
            "bathroom": leading_int("bathroom"),
            "balcony": balcony_count("balcony"),
            "additionalRoom": F.lower(F.coalesce("additionalRoom", F.lit("not available"))),
            "facing": F.coalesce("facing", F.lit("NA")),
        }
    )
    return rows.withColumn("area", area_from_rate("price", "price_per_sqft"))


def clean_flats(df: DataFrame) -> DataFrame:
    """Flat export; ``rate`` holds the price per sqft and floors may be named."""
    rows = df.withColumnRenamed("rate", "price_per_sqft")
    return _clean_units(rows, "flat", None).withColumn("floorNum", floor_number("floorNum"))


def clean_houses(df: DataFrame) -> DataFrame:
    """House export: repeated rows and unpriced rows are dropped, ``noOfFloor`` is the floor number."""
    rows = df.distinct().where(differs("price", "Price on Request"))
    rows = rows.withColumnsRenamed({"rate": "price_per_sqft", "noOfFloor": "floorNum"})
    return _clean_units(rows, "house", "independent").withColumn("floorNum", leading_int("floorNum"))


def with_sectors(df: DataFrame, min_rows: int = 3) -> DataFrame:
    """Sector from the title, spellings unified, sectors with fewer than ``min_rows`` rows dropped."""
    rows = stage(df.withColumn("sector", alias_cascade(sector_of("property_name"), SECTOR_ALIASES)), "sectors")
    rows = min_frequency(rows, "sector", min_rows)
    return rows.withColumn("sector", alias_cascade("sector", SECTOR_ALIASES_AFTER)).drop("property_name")


def parse_units(df: DataFrame, facilities: DataFrame | None = None, facility_order: str = "facility_id") -> DataFrame:
    """Areas, room flags, possession age and amenity score out of the text columns."""
    rows = contains_flags(with_areas(df), "additionalRoom", ROOM_KINDS)
    rows = rows.withColumn("agePossession", age_category("agePossession"))
    if facilities is not None:
        rows = fill_from(rows, facilities, "society", "PropertyName", "features", "TopFacilities", facility_order)
    rows = rows.withColumn("luxury_score", weighted_score(parse_list("features"), AMENITY_WEIGHTS))
    return rows.drop("features", "additionalRoom")


def furnishing_type(df: DataFrame, terms: list[str], n_init: int = 10) -> DataFrame:
    """Three furnishing levels from the item counts, 0 for the emptiest homes."""
    names = [f"__f{i}" for i in range(len(terms))]
    counted = df.withColumns({n: furnishing_count("furnishDetails", t) for n, t in zip(names, terms, strict=True)})
    labelled = cluster(counted, names, 3, "furnishing_type", n_init, scale=True, order_by="total")
    return labelled.drop(*names)


def treat_units(df: DataFrame) -> DataFrame:
    """Outlier repair and caps, area and possession-age imputation.

    The parsed rows are staged once: the fences and the three mode passes read columns, not texts.
    """
    rows = cap_domains(repair_rate_outliers(stage(df.distinct(), "units")))
    rows = rows.withColumn("price_per_sqft", rate_from_area("price", "area"))
    rows = fix_small_built_up(impute_built_up(rows))
    rows = rows.drop("areaWithType", "super_built_up_area", "carpet_area", "facing", "area")
    rows = rows.withColumn("floorNum", F.coalesce(F.col("floorNum").cast("double"), F.lit(2.0)))
    return impute_mode_hierarchy(rows)


def clean_units(
    flats: DataFrame,
    houses: DataFrame,
    facilities: DataFrame | None = None,
    corrections: DataFrame | None = None,
    key: str = "property_id",
    furnishing: bool = True,
    n_init: int = 10,
) -> DataFrame:
    """Both exports to the treated unit table, with the furnishing level of each unit.

    ``corrections`` are hand corrections as (key, column, value) rows, applied to the parsed columns before the treatment.
    The furnishing names are the few dozen that the details use; they become columns of the clustering.
    """
    merged = concat_tables(clean_flats(flats), clean_houses(houses))
    parsed = parse_units(with_sectors(merged), facilities)
    if corrections is not None:
        named = [r[0] for r in corrections.select("column").distinct().collect()]
        parsed = apply_corrections(parsed, corrections, key, [c for c in parsed.columns if c in named])
    if furnishing:
        parsed = stage(parsed, "parsed")
        terms = sorted(r["term"] for r in furnishing_terms(parsed, "furnishDetails").collect())
        parsed = furnishing_type(parsed, terms, n_init) if terms else parsed.withColumn("furnishing_type", F.lit(0))
    return treat_units(parsed.drop("furnishDetails"))
