"""Listing jobs: collect raw exports, clean them, derive the feature table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acrewise.functions.property_type import resolve_property_type
from acrewise.operators.dedupe import dedupe_listings
from acrewise.operators.feature_state import FEATURE_COLUMNS, RATIOS, FeatureState
from acrewise.operators.filters import in_band, in_region, require
from acrewise.operators.impute import fill_medians
from acrewise.operators.outliers import remove_outliers_iqr
from acrewise.scale import distinct_rows, stage
from acrewise.schema import LISTING_COLUMNS, coerce_numerics, ensure_columns, fill_defaults
from acrewise.sources.augment import bootstrap_augment
from acrewise.sources.folder import ingest_folder
from acrewise.sources.regional import subset_region

IQR_COLUMNS = ["price", "sqft", "bedrooms", "bathrooms"]


def collect(
    spark: SparkSession, path: str, target_rows: int | None = None, fallback: DataFrame | None = None, seed: int = 42
) -> DataFrame:
    """Raw listings of a folder of exports in the canonical 18 columns.

    With no usable file the ``fallback`` national table is cut to the region instead. ``target_rows`` adds
    noisy resampled rows up to that size.
    """
    raw = ingest_folder(spark, path)
    if "ingest_seq" in raw.columns and not raw.isEmpty():
        rows = dedupe_listings(raw, ("address", "price"), ("ingest_seq",)).drop("ingest_seq")
    elif fallback is not None:
        rows = subset_region(fallback).withColumns(
            {"address": F.col("location"), "data_tier": F.lit("supplemental_kaggle")}
        )
    else:
        raise RuntimeError(f"no listing files in {path} and no fallback table")
    rows = resolve_property_type(ensure_columns(rows))
    if target_rows is None:
        return ensure_columns(rows).select(*LISTING_COLUMNS).distinct()
    # deduplicated rows differ in some column, so all columns together order them; they are read several times
    rows = stage(rows, "collected")
    rows = ensure_columns(bootstrap_augment(rows, target_rows, rows.columns, seed)).select(*LISTING_COLUMNS)
    # a real row equals no drawn one; the real rows are stored, so reading them twice is cheaper than shuffling them
    drawn = F.col("is_synthetic_augment")
    return distinct_rows(rows.where(~drawn)).unionByName(rows.where(drawn).distinct())


def preprocess(df: DataFrame, order: tuple[Column | str, ...] = ("listing_id",)) -> DataFrame:
    """Clean listings: types and defaults, core columns, medians, price band, IQR fences, region, dedupe.

    The steps depend on their order. Typed rows are staged once, medians and fences are driver scalars of
    one-row aggregates over the columns they need; ``order`` decides which duplicate is kept.
    """
    rows = resolve_property_type(require(fill_defaults(coerce_numerics(ensure_columns(df)))))
    rows = fill_medians(stage(rows, "listings")).where(in_band("price", 30_000, 20_000_000))
    rows = remove_outliers_iqr(rows, IQR_COLUMNS).where(in_region())
    return dedupe_listings(rows, ("address", "price", "sqft"), order)


def engineer_features(df: DataFrame, as_of_year: int, clusters: bool = True, n_init: int = 10) -> DataFrame:
    """The feature table: the listing columns plus the derived ones, by a state learned from the same rows.

    To give new rows the same features, keep the state: ``FeatureState(...).fit(clean)``, see ``operators/feature_state.py``.
    """
    rows = stage(df, "clean")
    return FeatureState(as_of_year, 8 if clusters else 0, n_init).fit(rows).transform(rows)
