"""Feature table, encoders and models against closed forms and invariants."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from acrewise.operators import encode as en
from acrewise.operators import models as md
from acrewise.operators import selection as sl
from acrewise.plans import listings as lp
from acrewise.plans import units as up


@pytest.fixture(scope="module")
def features(listings):
    return lp.engineer_features(lp.preprocess(listings), 2026, n_init=1).cache()


def test_feature_table_has_39_columns(features):
    assert len(features.drop("listing_id").columns) == 39
    row = features.agg(F.max("location_cluster"), F.min("property_age"), F.count_if(F.col("luxury_score").isNull())).first()
    assert row[0] == 7 and row[1] >= 0 and row[2] == 0
    share = features.agg(F.avg("is_luxury_segment")).first()[0]
    assert 0.15 < share < 0.3


def test_cleaned_columns_have_no_gaps(listings):
    rows = lp.preprocess(listings)
    cols = ["price", "sqft", "bedrooms", "bathrooms", "latitude", "longitude", "lot_size", "year_built"]
    assert rows.where(" OR ".join(f"{c} IS NULL" for c in cols)).count() == 0


@pytest.fixture(scope="module")
def design(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 3)) * [1.0, 2.0, 0.5]
    y = x @ [1.5, -0.7, 0.0] + 4 + rng.normal(scale=0.3, size=300)
    df = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y, strict=True)], "a double, b double, c double, label double")
    return x, y, VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df).cache()


def test_ridge_equals_closed_form(design):
    x, y, df = design
    alpha = 2.0
    xc, yc = x - x.mean(axis=0), y - y.mean()
    want = np.linalg.solve(xc.T @ xc + alpha * np.eye(3), xc.T @ yc)
    got = md.linear(alpha, label_sd=float(y.std()), rows=len(y), kind="ridge").fit(df).coefficients.toArray()
    assert got == pytest.approx(want, abs=1e-6)


def test_lasso_and_elastic_net_meet_their_optimality_conditions(design):
    x, y, df = design
    xc = x - x.mean(axis=0)
    for alpha, ratio, model in [
        (0.1, 1.0, md.linear(0.1, kind="lasso")),
        (0.1, 0.5, md.linear(0.1, 0.5, label_sd=float(y.std()), kind="elastic_net")),
    ]:
        w = model.fit(df).coefficients.toArray()
        gradient = xc.T @ ((y - y.mean()) - xc @ w) / len(y) - alpha * (1 - ratio) * w
        for g, v in zip(gradient, w, strict=True):
            if abs(v) > 1e-8:
                assert g == pytest.approx(alpha * ratio * np.sign(v), abs=1e-4)
            else:
                assert abs(g) <= alpha * ratio + 1e-4


def test_elbow_falls_and_labels_repeat(listings):
    rows = listings.select("listing_id", F.coalesce("sqft", F.lit(0.0)).alias("sqft"), F.coalesce("bedrooms", F.lit(0.0)).alias("bedrooms"))
    cost = [r["wcss"] for r in en.elbow(rows, ["sqft", "bedrooms"], range(1, 5)).orderBy("k").collect()]
    assert cost == sorted(cost, reverse=True) and cost[0] == pytest.approx(2 * rows.count())
    a = en.cluster(rows, ["sqft"], 3, "label", n_init=2, order_by="total")
    b = en.cluster(rows, ["sqft"], 3, "label", n_init=2, order_by="total")
    assert a.exceptAll(b).count() == 0
    means = [r[1] for r in a.groupBy("label").agg(F.avg("sqft")).orderBy("label").collect()]
    assert means == sorted(means)


def test_unseen_categories_become_zeros(spark):
    train = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "k string, v double")
    model = en.build_preprocessor([], ["k"]).fit(train)
    seen = model.transform(train).first()["features"]
    unseen = model.transform(spark.createDataFrame([("z", 1.0)], "k string, v double")).first()["features"]
    assert seen.toArray().sum() == 1 and len(seen) == 2 and unseen.toArray().sum() == 0


def test_selection_report(features):
    report = sl.select_features(features, trees=4, depth=4)
    assert {"location", "property_type"} <= set(report["selected_features"])
    order = [c for c in sl.CANDIDATES if c in report["selected_features"]]
    assert report["selected_features"] == order
    reduced = sl.reduced_table(features, order)
    assert reduced.columns[0] == "price" and len(reduced.columns) == len(set(reduced.columns))
    leak_free = sl.select_features(features, trees=3, depth=3, drop_leaky=True)["selected_features"]
    assert not set(leak_free) & set(sl.LEAKY)


def test_feature_list_rules(features):
    candidates = ["sqft", "bedrooms", "location", "year_built", "nope"]
    assert sl.feature_list(features, ["sqft", "location"], candidates) == candidates[:4]
    assert sl.feature_list(features, candidates[::-1], candidates) == ["year_built", "location", "bedrooms", "sqft"]


def test_training_and_scoring(features):
    names = ["sqft", "bedrooms", "location", "price_per_sqft"]
    models = {"ols": (md.linear(), {}), "forest": (md.forest(4, 5), {"maxDepth": [3, 6]})}
    best, name, metrics = md.train_models(features, models=models, folds=2, features=names)
    rows = metrics.collect()
    assert rows[0]["model"] == name and rows[0]["r2"] >= rows[-1]["r2"]
    scored = md.score(best, features)
    assert scored.where("predicted_price > 0").count() == features.count()


def test_failing_model_keeps_its_row_with_the_reason(features):
    models = {"ols": md.linear(), "broken": md.forest(2, 2).setParams(featuresCol="absent")}
    table, fitted = md.compare_models(features, folds=2, features=["sqft", "bedrooms", "lot_size", "year_built"], models=models)
    ols, broken = table.collect()
    assert (ols["model"], ols["reason"], list(fitted)) == ("ols", None, ["ols"])
    assert broken["model"] == "broken" and broken["test_r2"] is None and "absent" in broken["reason"]


def test_out_of_fold_encoding_ignores_own_row(spark):
    from acrewise.operators.joins import target_encode_out_of_fold

    df = spark.createDataFrame([(i, "only" if i == 0 else "many", 1000.0 if i == 0 else float(i)) for i in range(40)], "id long, location string, price double")
    got = {r["id"]: r["location_target_enc"] for r in target_encode_out_of_fold(df, "id").collect()}
    assert got[0] < 100 and len(got) == 40


def test_furnishing_levels(spark, sf):
    from acrewise.fixtures import view

    rows = up.furnishing_type(view(spark, sf, "flats"), ["Fan", "AC", "Sofa"], n_init=1)
    levels = rows.groupBy("furnishing_type").count().collect()
    assert {r["furnishing_type"] for r in levels} == {0, 1, 2}


def test_k_means_passes_over_different_points_only(spark):
    # 20,000 rows at six places: the fit sees six weighted points, and its cost counts every row
    rows = spark.range(20_000).select((F.col("id") % 3).cast("double").alias("a"), F.when(F.col("id") % 2 == 0, 0.0).otherwise(9.0).alias("b"))
    points = en.weighted_points(rows, ["a", "b"])
    assert points.count() == 6 and points.agg(F.sum("__weight")).first()[0] == 20_000
    assert en.cluster_centers(rows, ["a", "b"], 2, n_init=2) == [pytest.approx([1.0, 0.0], abs=1e-3), pytest.approx([1.0, 9.0], abs=1e-3)]
    cost = {r["k"]: r["wcss"] for r in en.elbow(rows, ["a", "b"], range(1, 4), scale=False).collect()}
    spread = rows.agg(F.var_pop("a"), F.var_pop("b")).first()
    assert cost[1] == pytest.approx(20_000 * (spread[0] + spread[1])) and cost[2] == pytest.approx(20_000 * spread[0], rel=1e-4)


def test_folds_learn_fills_for_columns_with_gaps_only(spark, monkeypatch):
    rows = spark.range(60).select("id", (F.col("id") % 3).cast("int").alias("fold"), F.when(F.col("id") % 4 > 0, F.col("id") * 1.5).alias("a"), (F.col("id") % 7).cast("double").alias("b"), F.lit("x").alias("t"), F.col("id").cast("double").alias("label"))
    prepare, asked, medians = en.build_preprocessor(["a", "b"], ["t"]), [], en.medians
    monkeypatch.setattr(en, "medians", lambda df, cols: asked.append(cols) or medians(df, cols))
    own, others = [sorted(str(r) for r in part.select("features", "label").collect()) for part in md.prepared_folds(prepare, rows, 1)[0][::-1]]
    assert asked == [["a"]]
    plain = prepare.fit(rows.where("fold <> 0")).transform(rows)
    assert asked[1:] == [["a", "b"]]
    assert own == sorted(str(r) for r in plain.where("fold = 0").select("features", "label").collect())
    assert others == sorted(str(r) for r in plain.where("fold <> 0").select("features", "label").collect())


def test_registered_grid_and_comparison_are_whole(spark, sf, monkeypatch):
    # t03 searches the operator's grids, t08 fits its candidates; their shared rows come from all ten starts of the clusters
    from acrewise.queries import ml

    asked, starts = {}, []
    monkeypatch.setattr(ml, "model_rows", lambda spark, sf: "rows")
    monkeypatch.setattr(md, "train_models", lambda df, **given: (None, "", asked.update(t03=(df, given))))
    monkeypatch.setattr(md, "compare_models", lambda df, **given: (asked.update(t08=(df, given)), {}))
    ml.t03(spark, sf), ml.t08(spark, sf)
    assert asked == {"t03": ("rows", {}), "t08": ("rows", {})}
    monkeypatch.undo()

    def engineered(clean, year, clusters=True, n_init=10):
        starts.append(n_init)
        return spark.range(1)

    monkeypatch.setattr(ml, "_stored", {})
    monkeypatch.setattr(ml, "engineer_features", engineered)
    ml.model_rows(spark, sf)
    assert starts == [10]
