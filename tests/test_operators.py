"""Order-dependent rules, missing-value rules and brute-force checks of the operators."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from acrewise.operators import dedupe as dd
from acrewise.operators import filters as fl
from acrewise.operators import impute as im
from acrewise.operators import joins as jn
from acrewise.operators import outliers as ol
from acrewise.operators import sampling as sm
from acrewise.operators import similarity as sy
from acrewise.operators import stats as st
from acrewise.operators.neighbours import similarity_edges
from acrewise.operators.text_features import tfidf
from acrewise.queries.similar import similar_rows


def test_url_less_rows_do_not_collapse(spark):
    rows = [(1, None, "a", 1.0), (2, "", "b", 1.0), (3, "nan", "a", 1.0), (4, "u", "c", 2.0), (5, "u", "d", 3.0)]
    df = spark.createDataFrame(rows, "listing_id int, listing_url string, address string, price double")
    assert sorted(r["listing_id"] for r in dd.dedupe_listings(df).collect()) == [1, 2, 4]


def test_mode_hierarchy_traps(spark):
    rows = [
        (1, "s1", "flat", "Undefined"), (2, "s1", "flat", "b"), (3, "s1", "flat", "a"), (4, None, "flat", "Undefined"),
        (5, "s2", "house", "Undefined"), (6, "s3", "house", "Undefined"), (7, "s3", "flat", "c"), (8, "s3", "flat", "c"),
    ]
    df = spark.createDataFrame(rows, "id int, sector string, property_type string, agePossession string")
    got = {r["id"]: r["agePossession"] for r in im.impute_mode_hierarchy(df).collect()}
    # a tie goes to the smallest text, which for row 1 is the sentinel itself until the type pass
    assert got[4] is None
    assert got[6] == "c"
    assert got[2] == "b" and got[3] == "a"


def test_sequential_fences_differ_from_simultaneous(listings):
    cols = ["price", "sqft", "bedrooms", "bathrooms"]
    rows = fl.require(listings)
    chained = ol.remove_outliers_iqr(rows, cols)
    masked = rows.where(ol.iqr_mask(rows, cols))
    assert 0 < chained.count() <= rows.count() and masked.count() <= rows.count()
    for c in cols[:1]:
        fence = ol.iqr_bounds(rows, [c])[c]
        assert chained.where(ol.outside(c, fence)).count() == 0


def test_constant_column_has_no_fence(spark):
    df = spark.createDataFrame([(1.0,)] * 5 + [(9.0,)], "v double")
    assert ol.remove_outliers_iqr(df, ["v"]).count() == 6


def test_missing_values_in_filters(spark):
    df = spark.createDataFrame([("a",), (None,), ("x",)], "v string")
    assert df.where(fl.differs("v", "x")).count() == 2
    assert df.where(fl.in_region(F.col("v"), F.col("v"))).count() == 0


def test_radius_join_equals_brute_force_across_the_date_line(spark):
    points = [(i, -89.0 + (i * 37) % 178, -180.0 + (i * 53) % 360) for i in range(400)]
    df = spark.createDataFrame(points, "listing_id int, latitude double, longitude double")
    centers = spark.createDataFrame([(0, 0.0, 179.9), (1, 88.5, 10.0), (2, -45.0, -179.5), (3, 30.0, -95.0)], "center_id int, center_lat double, center_lon double")
    got = {(r["center_id"], r["listing_id"]) for r in jn.radius_join(df, centers, 600.0).collect()}

    def miles(a, b, c, d):
        a, b, c, d = map(math.radians, (a, b, c, d))
        h = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
        return 2 * 3958.7613 * math.asin(math.sqrt(min(1.0, h)))

    want = {
        (c["center_id"], i)
        for c in centers.collect()
        for i, lat, lon in points
        if miles(lat, lon, c["center_lat"], c["center_lon"]) <= 600.0
    }
    assert got == want and want


def brute_edges(df, k, text_col="description"):
    rows = sy.similarity_blocks(df).select("listing_id", "sim_num", "sim_cat", "sim_geo").orderBy("listing_id").collect()
    ids = [r["listing_id"] for r in rows]

    def unit(name):
        m = np.array([r[name] for r in rows])
        n = np.linalg.norm(m, axis=1, keepdims=True)
        return np.divide(m, n, out=np.zeros_like(m), where=n > 0)

    num, geo = unit("sim_num"), unit("sim_geo")
    cat = np.array([[a == b for a, b in zip(x["sim_cat"], y["sim_cat"], strict=True)] for x in rows for y in rows])
    cat = cat.reshape(len(rows), len(rows), -1).mean(axis=2)
    total, weight = 0.5 * num @ num.T + 0.8 * cat + 1.0 * geo @ geo.T, 2.3
    if text_col:
        words = {}
        for r in tfidf(df, "listing_id", text_col).collect():
            words.setdefault(r["term"], {})[r["listing_id"]] = r["weight"]
        text = np.array([[at.get(i, 0.0) for at in words.values()] for i in ids])
        total, weight = total + 0.35 * text @ text.T, 2.65
    sims = np.round(total / weight, 7)
    out = {}
    for i, src in enumerate(ids):
        order = sorted((j for j in range(len(ids)) if j != i), key=lambda j: (-sims[i, j], ids[j]))[:k]
        out[src] = [sims[i, j] for j in order]
    return out


@pytest.mark.parametrize("options", [{}, {"rows_per_cell": 8, "chunk": 16, "fanout": 4}, {"rows_per_cell": 40, "fanout": 3, "text_col": None}])
def test_similarity_edges_equal_brute_force(spark, sf, options):
    rows = similar_rows(spark, sf).where("listing_id < 260")
    # a third of the rows are copies of one listing
    first = rows.where("listing_id = 5").drop("listing_id")
    copies = spark.range(1000, 1130).select(F.col("id").alias("listing_id")).join(F.broadcast(first))
    rows = rows.unionByName(copies).cache()
    want = brute_edges(rows, 4, options.get("text_col", "description"))
    got = {}
    for r in similarity_edges(rows, 4, **options).orderBy("src_id", "rank").collect():
        assert r["src_id"] != r["dst_id"]
        got.setdefault(r["src_id"], []).append(r["similarity"])
    assert got.keys() == want.keys()
    for src, sims in want.items():
        assert got[src] == pytest.approx(sims, abs=1e-6)


def test_edges_of_a_tiny_table(spark):
    df = spark.createDataFrame([(1, 2.0, "a"), (2, 3.0, "a")], "listing_id long, sqft double, location string")
    got = sorted((r["src_id"], r["dst_id"], r["rank"]) for r in similarity_edges(df, 5).collect())
    assert got == [(1, 2, 1), (2, 1, 1)]


def test_scores_without_a_block(spark):
    df = spark.createDataFrame([(1, 2.0, "a"), (2, 4.0, "a"), (3, 9.0, "b")], "listing_id long, sqft double, location string")
    got = {r["listing_id"]: r["similarity"] for r in sy.scores_for(df, 1).collect()}
    # no coordinates: that block counts as equal; numeric cosine of one column is its sign
    assert got[1] == -1.0 and got[2] == pytest.approx((0.5 + 0.8 + 1.0) / 2.3) and got[3] == pytest.approx((-0.5 + 0 + 1.0) / 2.3)
    with pytest.raises(ValueError):
        sy.scores_for(df, 99)


def test_sampling_does_not_depend_on_partitioning(listings):
    a = {r["listing_id"] for r in sm.sample_n(listings, 50, 3, "listing_id").collect()}
    b = {r["listing_id"] for r in sm.sample_n(listings.repartition(13), 50, 3, "listing_id").collect()}
    assert a == b and len(a) == 50
    train, test = sm.hash_split(listings, "listing_id")
    assert train.count() + test.count() == listings.count()
    assert 0.1 < test.count() / listings.count() < 0.3


def test_constant_column_statistics(spark):
    df = spark.createDataFrame([(1.0, 2.0)] * 5, "a double, b double")
    assert [r["corr"] for r in st.corr_matrix(df, ["a", "b"]).collect()] == [None] * 4
    row = df.agg(st.skew("a").alias("s"), st.kurt("a").alias("k")).first()
    assert (row["s"], row["k"]) == (0.0, 0.0)
    assert df.limit(2).agg(st.skew("a")).first()[0] is None


def test_rank_correlation_with_a_hot_value(spark):
    df = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, 5.0).otherwise((F.col("id") * 7919 % 701).cast("double")).alias("x"),
        (F.col("id") * 31 % 97).cast("double").alias("y"),
    )
    got = st.rank_correlation(df, "y", ["x"]).first()["spearman"]
    pdf = df.toPandas()
    assert got == pytest.approx(pdf["x"].rank().corr(pdf["y"].rank()), abs=1e-9)


def test_histogram_keeps_the_maximum_in_the_last_bin(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (10.0,)], "v double")
    assert {r["bin"]: r["n"] for r in st.histogram(df, "v", 2).collect()} == {0: 1, 1: 2}


def test_radius_counts_meet_places_once_and_count_every_row(spark):
    spots = [(29.7, -95.4), (29.72, -95.41), (30.4, -95.0), (None, -95.4)]
    rows = spark.createDataFrame([spots[i % 4] for i in range(400)], "latitude double, longitude double")
    centers = spark.createDataFrame([(1, 29.7, -95.4), (2, 29.7, -95.4), (2, 30.4, -95.0), (3, 0.0, 0.0), (None, 29.71, -95.4)], "center_id int, center_lat double, center_lon double")
    pairs = jn.radius_join(rows, centers, 3.0).groupBy("center_id").agg(F.count(F.lit(1)).alias("n"), F.min("distance_mi").alias("nearest"))
    found = sorted(jn.radius_counts(rows, centers, 3.0).collect(), key=repr)
    assert found == sorted(pairs.collect(), key=repr)
    assert {r["center_id"]: r["n"] for r in found} == {1: 200, 2: 300, None: 200}
