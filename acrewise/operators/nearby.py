"""Nearby recommendations for a table of requests, in a fixed number of jobs however many requests there are."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acrewise.functions.text import street_of
from acrewise.operators.joins import radius_join
from acrewise.operators.similarity import GEO_BLOCK, PREVIEW_COLUMNS, WEIGHTS, block_norm, micro_of, similarity_blocks
from acrewise.operators.text_features import has_text, packed_terms
from acrewise.scale import lookup_join, quantiles, settle, stage

_MISS = 2  # fewer hits than this widen a request


def _dot(a: str, b: str, size: int) -> Column:
    total = F.lit(0.0)
    for i in range(size):
        total = total + F.get(a, F.lit(i)) * F.get(b, F.lit(i))
    return total


def _cosine(a: str, b: str, size: int) -> Column:
    return F.coalesce(F.try_divide(_dot(a, b, size), block_norm(a, size) * block_norm(b, size)), F.lit(0.0))


def _blend(sizes: dict[str, int], weights: tuple[float, ...], texts: bool) -> Column:
    """Weighted mean of the block cosines of a row and its request's anchor (columns ``a_...``)."""
    w_num, w_cat, w_geo, w_text = weights
    total = w_num * _cosine("sim_num", "a_sim_num", sizes["sim_num"])
    if sizes["sim_cat"]:
        same = F.lit(0)
        for i in range(sizes["sim_cat"]):
            same = same + (F.get("sim_cat", F.lit(i)) == F.get("a_sim_cat", F.lit(i))).cast("int")
        total = total + w_cat * (same / F.lit(sizes["sim_cat"]))
    else:
        total = total + F.lit(w_cat)
    total = total + (w_geo * _cosine("sim_geo", "a_sim_geo", sizes["sim_geo"]) if sizes["sim_geo"] else F.lit(w_geo))
    weight = w_num + w_cat + w_geo
    if texts:
        # texts are unit vectors, so their cosine is the sum over shared terms
        theirs = F.map_from_arrays("a_ti", "a_tw")
        shared = F.zip_with("ti", "tw", lambda i, w: w * F.coalesce(F.try_element_at(theirs, i), F.lit(0.0)))
        total, weight = total + w_text * F.aggregate(shared, F.lit(0.0), lambda s, x: s + x), weight + w_text
    return total / F.lit(weight)


def _in_reach(rows: DataFrame, placed: DataFrame, key: str, on: Sequence[str]) -> DataFrame:
    """Listings in the reach of each request that agree with its area in the columns ``on``: key, request_id, distance_mi."""
    place = ["__location", "__micro", "__latitude", "__longitude"]
    found = rows.join(placed, F.lit(False)).select(key, "request_id", F.lit(0.0).alias("distance_mi"))
    # a class per doubling of the radius, a few dozen at most
    for r in placed.select("__class").distinct().orderBy("__class").collect():
        of_class = placed.where(F.col("__class") == r["__class"]).withColumnsRenamed({"__of": "__location", "__value": "__micro"})
        centers = of_class.select("request_id", "__clat", "__clon", *on)
        near = radius_join(rows.select(key, *place), centers, math.ldexp(1.0, r["__class"]), ("request_id", "__clat", "__clon"), "__latitude", "__longitude", on)
        near = lookup_join(near.select(key, "request_id", "distance_mi"), of_class.select("request_id", "__miles"), ["request_id"], how="inner")
        found = found.unionByName(near.where(F.col("distance_mi") <= F.col("__miles")).drop("__miles"))
    return found


def recommend_nearby_many(
    df: DataFrame,
    requests: DataFrame,
    micro: str,
    k: int = 8,
    key: str = "listing_id",
    weights: tuple[float, ...] = WEIGHTS,
    text_col: str | None = "description",
    stop_words: Sequence[str] | None = None,
) -> DataFrame:
    """For each request (request_id, location, value, miles) what :func:`recommend_nearby` gives for it, with its request_id.

    * Centres are medians by area, of the areas asked for only.
    * Listings meet centres on a grid, once per class of radii (a doubling each), and keep those in the request's own reach.
    * Tiers are searched from the narrowest: listings of a request's area, then its location, then all, each meeting only the
      requests with too few hits so far. So a request meets no listings of a tier it does not need; the nearest hit is the anchor.
    * Rows carry their encoded blocks, so scoring against the anchor is a projection; ``k`` best by a limit that is pushed
      below the shuffle, so a request that reaches a third of all listings sends ``k`` rows per task.

    ``request_id`` identifies a request. Areas without listings or coordinates, and requests that reach nothing but their
    anchor, give no rows. Radii must be positive.
    """
    sizes = {}
    blocks = similarity_blocks(df)
    texts = text_col is not None and text_col in df.columns and has_text(df, text_col)
    if texts:
        blocks, _ = packed_terms(blocks, df, key, text_col, 1.0, stop_words)
    carried = ["sim_num", "sim_cat", "sim_geo", *(["ti", "tw"] if texts else [])]
    preview = [c for c in PREVIEW_COLUMNS if c in [*df.columns, "street"] and c != key]
    rows = blocks.withColumn("street", street_of("address") if "address" in df.columns else F.lit(None).cast("string"))
    rows = rows.withColumn("__micro", micro_of(micro, df))
    rows = stage(rows.select(F.col(key), *[F.col(c) for c in preview], *[F.col(c).alias(f"__{c}") for c in GEO_BLOCK], F.col("location").alias("__location"), "__micro", *carried), "rows")
    for c in ("sim_num", "sim_cat", "sim_geo"):
        first = rows.select(F.size(c)).where(F.col(c).isNotNull()).first()
        sizes[c] = first[0] if first else 0

    asked = stage(requests.select("request_id", F.col("location").alias("__of"), F.col("value").cast("string").alias("__value"), F.col("miles").cast("double").alias("__miles")), "requests")
    areas = asked.select(F.col("__of").alias("__location"), F.col("__value").alias("__micro")).distinct()
    inside = lookup_join(rows.select("__location", "__micro", "__latitude", "__longitude"), areas, ["__location", "__micro"], how="inner")
    middle = quantiles(inside, ["__latitude", "__longitude"], [0.5], ["__location", "__micro"])
    middle = middle.select(F.col("__location").alias("__of"), F.col("__micro").alias("__value"), F.col("__latitude")[0].alias("__clat"), F.col("__longitude")[0].alias("__clon"))
    placed = lookup_join(asked, middle.where("__clat is not null and __clon is not null"), ["__of", "__value"], how="inner")
    placed = stage(placed.withColumn("__class", F.ceil(F.log2("__miles")).cast("int")), "placed")

    # a wider tier is searched for those requests only that the narrower ones leave without enough hits
    taken, rest = [], placed
    for on in (["__location", "__micro"], ["__location"], []):
        found = stage(_in_reach(rows, rest, key, on), "found")
        if not on:
            taken.append(found)
            break
        enough = settle(found.groupBy("request_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= _MISS).select("request_id"))
        taken.append(lookup_join(found, enough, ["request_id"], how="inner"))
        rest = settle(rest.join(enough, "request_id", "left_anti"))
        if rest.isEmpty():
            break
    reach = stage(reduce(DataFrame.unionByName, taken), "reach")
    anchors = reach.groupBy("request_id").agg(F.min_by(key, F.struct(F.round("distance_mi", 6), key)).alias("__anchor"))
    encoded = rows.select(F.col(key).alias("__anchor"), *[F.col(c).alias(f"a_{c}") for c in carried])
    anchors = anchors.join(encoded, "__anchor")

    pairs = reach.join(rows.select(key, *preview, *carried), key)
    scored = lookup_join(pairs, anchors, ["request_id"], how="inner").where(F.col(key) != F.col("__anchor"))
    scored = scored.withColumn("similarity", _blend(sizes, weights, texts))
    best = Window.partitionBy("request_id").orderBy(F.desc(F.round("similarity", 9)), key)
    top = scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return top.select("request_id", "rank", key, *preview, "similarity", "distance_mi")
