"""Similarity scores, similar listings and nearby recommendations."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acrewise.functions.features import haversine_miles
from acrewise.functions.text import street_of
from acrewise.operators.filters import top_categories
from acrewise.operators.text_features import has_text, tfidf
from acrewise.scale import medians

# Columns of the blocks and of the results below.
NUMERIC_BLOCK = ["bedrooms", "bathrooms", "sqft", "price_per_sqft", "luxury_score", "amenity_count"]
CATEGORY_BLOCK = ["location", "property_type"]
GEO_BLOCK = ["latitude", "longitude"]

# Block weights (numeric, categorical, geographic, text).
WEIGHTS = (0.5, 0.8, 1.0, 0.35)
RESULT_COLUMNS = ["price", "bedrooms", "bathrooms", "sqft", "location", "property_type", "listing_url"]
PREVIEW_COLUMNS = ["price", "bedrooms", "bathrooms", "sqft", "location", "street", "property_type", "listing_url"]


def standardized(df: DataFrame, cols: list[str]) -> dict[str, Column]:
    """Median-filled, zero-mean, unit-deviation (population) form of each column; constant columns give 0."""
    mid = medians(df, cols)
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(mid[c]).cast("double")) for c in cols}
    row = df.agg(*[f(v).alias(f"{p}_{c}") for c, v in filled.items() for p, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    out = {}
    for c, value in filled.items():
        mean, sd = row[f"m_{c}"], row[f"s_{c}"]
        out[c] = (value - F.lit(mean)) / F.lit(sd) if sd else (F.lit(0.0) if mean is None else value - F.lit(mean))
    return out


def similarity_blocks(df: DataFrame) -> DataFrame:
    """Add the encoded blocks: ``sim_num`` and ``sim_geo`` arrays and ``sim_cat`` texts.

    A missing category counts as a value of its own. A block without columns is NULL.
    """
    num = [c for c in NUMERIC_BLOCK if c in df.columns]
    cat = [c for c in CATEGORY_BLOCK if c in df.columns]
    geo = GEO_BLOCK if set(GEO_BLOCK) <= set(df.columns) else []
    scaled = standardized(df, num + geo) if num or geo else {}
    return df.withColumns(
        {
            "sim_num": F.array(*[scaled[c] for c in num]) if num else F.array(F.lit(0.0)),
            "sim_cat": F.array(*[F.coalesce(F.col(c).cast("string"), F.lit("nan")) for c in cat])
            if cat
            else F.lit(None).cast("array<string>"),
            "sim_geo": F.array(*[scaled[c] for c in geo]) if geo else F.lit(None).cast("array<double>"),
        }
    )


def block_norm(c: str, size: int) -> Column:
    total = F.lit(0.0)
    for i in range(size):
        total = total + F.get(c, F.lit(i)) * F.get(c, F.lit(i))
    return F.sqrt(total)


def _cosine(c: str, anchor: list[float]) -> Column:
    """Cosine with a fixed vector; 0 when either vector is zero."""
    dot = F.lit(0.0)
    for i, v in enumerate(anchor):
        dot = dot + F.get(c, F.lit(i)) * F.lit(float(v))
    length = math.sqrt(sum(v * v for v in anchor))
    return F.coalesce(F.try_divide(dot, block_norm(c, len(anchor)) * F.lit(length)), F.lit(0.0))


def blended_score(blocks: DataFrame, anchor, weights: tuple[float, ...], text: Column | None = None) -> Column:
    """Weighted mean of the block cosines against one anchor row."""
    w_num, w_cat, w_geo, w_text = weights
    total = w_num * _cosine("sim_num", anchor["sim_num"])
    if anchor["sim_cat"]:
        matches = F.lit(0)
        for i, v in enumerate(anchor["sim_cat"]):
            matches = matches + (F.get("sim_cat", F.lit(i)) == F.lit(v)).cast("int")
        total = total + w_cat * (matches / F.lit(len(anchor["sim_cat"])))
    else:
        total = total + F.lit(w_cat)
    total = total + (w_geo * _cosine("sim_geo", anchor["sim_geo"]) if anchor["sim_geo"] else F.lit(w_geo))
    weight = w_num + w_cat + w_geo
    if text is not None:
        total, weight = total + w_text * text, weight + w_text
    return total / F.lit(weight)


def scores_for(
    df: DataFrame,
    anchor_id,
    key: str = "listing_id",
    weights: tuple[float, ...] = WEIGHTS,
    text_col: str | None = "description",
    stop_words: list[str] | None = None,
) -> DataFrame:
    """Blended similarity of every row to one anchor row, the anchor itself scored -1.

    The anchor is one row of literals, so scoring is a projection over the table without any join. Where the table has
    ``text_col`` and it holds words, rows sharing a weighted term with the anchor are joined by id (None: leave texts out).
    """
    blocks = similarity_blocks(df)
    anchor = blocks.where(F.col(key) == anchor_id).select("sim_num", "sim_cat", "sim_geo").first()
    if anchor is None:
        raise ValueError(f"no row with {key} = {anchor_id}")
    text = None
    if text_col is not None and text_col in df.columns and has_text(df, text_col):
        terms = tfidf(df, key, text_col, stop_words=stop_words)
        # the anchor has at most as many terms as the vocabulary
        mine = {r["term"]: r["weight"] for r in terms.where(F.col(key) == anchor_id).collect()}
        pairs = F.create_map(*[F.lit(x) for kv in mine.items() for x in kv]) if mine else None
        if pairs is None:
            text = F.lit(0.0)
        else:
            weight = F.try_element_at(pairs, F.col("term"))
            cos = terms.where(F.col("term").isin(list(mine))).groupBy(key).agg(F.sum(F.col("weight") * weight).alias("__text"))
            blocks = blocks.join(cos, key, "left")
            text = F.coalesce(F.col("__text"), F.lit(0.0))
    score = blended_score(blocks, anchor, weights, text)
    scored = blocks.withColumn("similarity", F.when(F.col(key) == anchor_id, F.lit(-1.0)).otherwise(score))
    return scored.drop("sim_num", "sim_cat", "sim_geo", "__text")


def similar_listings(df: DataFrame, anchor_id, k: int = 5, key: str = "listing_id", **options) -> DataFrame:
    """The ``k`` rows most similar to the anchor; ties by key."""
    columns = [c for c in RESULT_COLUMNS if c in df.columns]
    scored = scores_for(df, anchor_id, key, **options)
    return scored.orderBy(F.desc(F.round("similarity", 9)), key).limit(k).select(key, *columns, "similarity")


# nearby --------------------------------------------------------------------------------------------------


def micro_of(col: str, df: DataFrame) -> Column:
    """The micro area of a row as text; a missing one has a name of its own."""
    value = street_of("address") if col == "street" and "street" not in df.columns else F.col(col)
    return F.coalesce(value.cast("string"), F.lit("(unknown)"))


def micro_areas(df: DataFrame, location: str, micro: str, n: int = 100) -> DataFrame:
    """Most frequent streets, zip codes or clusters inside a location."""
    inside = df.where(F.col("location") == location).select(micro_of(micro, df).alias(micro))
    return top_categories(inside, micro, n)


def recommend_nearby(
    df: DataFrame,
    location: str,
    micro: str,
    value: str,
    miles: float,
    k: int = 8,
    key: str = "listing_id",
    **options,
) -> DataFrame:
    """Listings around a micro area, ranked by similarity to the one nearest its median centre.

    Fewer than two hits in the micro area widen the search to the location, then to every listing in reach. An area without
    listings or coordinates, and a radius without listings, give no rows.
    """
    inside = df.where((F.col("location") == location) & (micro_of(micro, df) == value))
    center = medians(inside, GEO_BLOCK)
    distance = haversine_miles("latitude", "longitude", *[F.lit(center[c]).cast("double") for c in GEO_BLOCK])
    ranged = df.withColumns({"distance_mi": distance, "street": street_of("address")})
    near = F.coalesce(F.col("distance_mi") <= miles, F.lit(False))
    same = F.coalesce(F.col("location") == location, F.lit(False))
    tiers = [near & same & (micro_of(micro, df) == value), near & same, near]
    counts = ranged.agg(*[F.count_if(t).alias(f"t{i}") for i, t in enumerate(tiers)]).first()
    tier = next((t for t, n in zip(tiers[:2], counts, strict=False) if n >= 2), tiers[2])
    anchor = ranged.where(tier).agg(F.min_by(key, F.struct(F.round("distance_mi", 6), key))).first()[0]
    columns = [c for c in PREVIEW_COLUMNS if c in ranged.columns]
    if anchor is None:
        return ranged.where(F.lit(False)).select(key, *columns, F.lit(0.0).alias("similarity"), "distance_mi")
    # encodings are fitted on the whole table, only rows in reach are ranked
    scored = scores_for(ranged, anchor, key, **options).where(tier & (F.col(key) != anchor))
    top = scored.orderBy(F.desc(F.round("similarity", 9)), key).limit(k)
    return top.select(key, *columns, "similarity", "distance_mi")


def vector_topk(df: DataFrame, anchor_id, col: str = "embedding", k: int = 10, key: str = "vec_id") -> DataFrame:
    """The ``k`` rows whose vector has the highest cosine with the anchor's."""
    row = df.where(F.col(key) == anchor_id).select(F.col(col).cast("array<double>").alias("v")).first()
    if row is None:
        raise ValueError(f"no row with {key} = {anchor_id}")
    target = F.array(*[F.lit(v) for v in row["v"]])
    vector = F.col(col).cast("array<double>")
    dot = F.aggregate(F.zip_with(vector, target, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, v: s + v * v))
    length = math.sqrt(sum(v * v for v in row["v"]))
    scored = df.where(F.col(key) != anchor_id).select(
        key, F.coalesce(F.try_divide(dot, norm * F.lit(length)), F.lit(0.0)).alias("similarity")
    )
    return scored.orderBy(F.desc(F.round("similarity", 9)), key).limit(k)
