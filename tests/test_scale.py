"""The distributed paths give the same rows as the simple ones."""

import pytest
from pyspark.sql import functions as F

from acrewise import scale as sc


def rows_of(df):
    return sorted(map(str, df.collect()))


PROBS = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]


@pytest.mark.parametrize("by", [[], ["location"], ["location", "property_type"]])
def test_quantiles_equal_builtin(listings, by):
    points = F.array(*[F.lit(p) for p in PROBS])
    simple = listings.groupBy(*by).agg(*[F.percentile(F.col(c).cast("double"), points).alias(c) for c in ("price", "bedrooms")])
    assert rows_of(sc.quantiles(listings, ["price", "bedrooms"], PROBS, by)) == rows_of(simple)


def test_quantiles_of_empty_and_missing_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", None)], "k string, v double")
    got = {r["k"]: r["v"] for r in sc.quantiles(df, ["v"], [0.5], ["k"]).collect()}
    assert got == {"a": [2.0], "b": None}
    assert sc.quantile_values(df.limit(0), ["v"], [0.5]) == {"v": [None]}
    assert sc.quantile_values(df.withColumn("none", F.lit(None)), ["none", "v"], [0.5]) == {"none": [None], "v": [2.0]}


def test_quantiles_of_uneven_and_infinite_values(spark):
    values = [float("-inf"), -1e300, 0.0, 1e-300, 5.0, 5.0, 7.0, 1e300, float("inf")]
    df = spark.createDataFrame([(v, 3.0) for v in values], "v double, same double")
    got = sc.quantile_values(df, ["v", "same"], [0.0, 0.5, 0.75, 1.0])
    assert got == {"v": [values[0], values[4], values[6], values[8]], "same": [3.0] * 4}


def test_quantiles_with_one_value_holding_most_rows(spark):
    df = spark.range(40_000).select(F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.col("id") * 1.5).alias("v"))
    probs = [0.1, 0.33, 0.5, 0.77]
    want = df.agg(F.percentile("v", F.array(*[F.lit(p) for p in probs]))).first()[0]
    assert sc.quantile_values(df, ["v"], probs) == {"v": pytest.approx(want)}


def test_many_quantiles_store_a_cell_for_each_value_once(spark, monkeypatch):
    # fifteen wanted ranks: a value is counted in one zone, not once for each bracket above it
    df = spark.range(30_000).select(F.sqrt(F.col("id") * 7 % 30_000).alias("v"), F.when(F.col("id") % 5 > 0, F.col("id") % 11).alias("few"))
    probs = [i / 16 for i in range(1, 16)]
    stored, stage = [], sc.stage
    monkeypatch.setattr(sc, "stage", lambda rows, name="stage": stored.append(stage(rows, name)) or stored[-1])
    points = F.array(*[F.lit(p) for p in probs])
    want = df.agg(*[F.percentile(c, points).alias(c) for c in df.columns]).first()
    got = sc.quantile_values(df, df.columns, probs)
    assert all(got[c] == pytest.approx(want[c]) for c in df.columns)
    cells = [rows for rows in stored if {"i", "c"} <= set(rows.columns)]
    assert cells[0].groupBy("i").agg(F.sum("c").alias("n")).orderBy("i").collect() == [(0, 30_000), (1, 24_000)]


def test_quantiles_with_values_that_are_no_numbers(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (None,)], "v double")
    low, middle, high = sc.quantile_values(df, ["v"], [0.0, 0.5, 1.0])["v"]
    assert (low, middle) == (1.0, 3.0) and high != high


def test_running_sum_in_order_and_by_group(spark):
    df = spark.range(500).select((F.col("id") % 3).alias("g"), F.col("id"), (F.col("id") % 7).alias("w"))
    got = {(r["g"], r["id"]): r["cum"] for r in sc.running_sum(df, "w", ["id"], "cum", ["g"]).collect()}
    totals = {}
    for i in range(500):
        totals[i % 3] = totals.get(i % 3, 0) + i % 7
        assert got[(i % 3, i)] == totals[i % 3]


def test_dense_index_numbers_every_row(spark):
    df = spark.range(0, 3000, 3).withColumnRenamed("id", "k")
    got = sc.dense_index(df, ["k"], "ix")
    assert got.where("ix <> k / 3").count() == 0 and got.count() == 1000


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_lookup_join_paths_agree_on_hot_and_missing_keys(spark, how, null_safe):
    left = spark.range(9000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 500)).alias("k"),
    )
    right = left.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    assert sc.hot_keys(left, ["k"], sample=0.5) is not None
    small = sc.lookup_join(left, right, ["k"], how, null_safe)
    big = sc.lookup_join(left, right, ["k"], how, null_safe, max_rows=1)
    assert rows_of(small) == rows_of(big)


def test_lookup_join_does_not_broadcast_past_the_limit(spark):
    left = spark.range(2000).withColumn("k", F.col("id") % 100)
    right = left.groupBy("k").count()
    plan = sc.lookup_join(left, right, ["k"], max_rows=10)._jdf.queryExecution().sparkPlan().toString()
    assert "__salt" in plan or "SortMergeJoin" in plan


def test_first_per_key_keeps_the_first_and_groups_nulls(spark):
    df = spark.createDataFrame([(3, "a", 1), (1, "a", 2), (2, None, 3), (4, None, 4)], "id int, k string, v int")
    assert rows_of(sc.first_per_key(df, ["k"], ["id"])) == rows_of(df.where("id in (1, 2)"))


def test_checkpoint_folder_comes_from_the_session(spark):
    sc.ensure_checkpoint_dir(spark)
    assert spark.sparkContext.getCheckpointDir() in sc.shared_folder(spark, "x")


def test_shuffle_files_do_not_outlive_a_stage(spark):
    import time
    from pathlib import Path

    folders = [Path(str(d)) for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    held = lambda: {f.name for d in folders for f in d.rglob("shuffle_*.data")}
    before = held()
    stored = sc.stage(spark.range(200_000).repartition(3, "id"), "shuffled")
    until = time.time() + 20
    while held() - before and time.time() < until:
        time.sleep(0.2)
    assert not held() - before and stored.count() == 200_000
    assert spark.conf.get(sc._CLEAN_UP) == "false"


def test_discard_deletes_staged_tables_only(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/kept")
    kept = spark.read.parquet(f"{tmp_path}/kept")
    staged = sc.stage(kept, "short")
    folder = staged.inputFiles()[0].rsplit("/", 1)[0]
    sc.discard(staged.select("id").join(kept, "id"))
    assert not sc.exists(spark, folder) and kept.count() == 3


def test_dense_index_shuffles_whole_rows_once(spark, monkeypatch):
    # places and offsets are stored numbers: no window runs over the rows
    df = spark.range(500).select((F.col("id") * 37 % 500).alias("k"), F.when(F.col("id") % 7 > 0, F.col("id") % 3).alias("g"))
    got = sc.dense_index(df, ["g", "k"], "ix")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan
    rows = sorted(df.collect(), key=lambda r: (r["g"] is not None, r["g"] or 0, r["k"]))
    assert [(r["g"], r["k"]) for r in sorted(got.collect(), key=lambda r: r["ix"])] == [(r["g"], r["k"]) for r in rows]
    assert sorted(r["ix"] for r in got.collect()) == list(range(500))


def test_distinct_rows_equal_distinct(spark):
    rows = [(1, "a", None), (1, "a", None), (None, None, None), (None, None, None), (2, "b", 0.5), (3, "c", -0.0), (3, "c", 0.0)]
    df = spark.createDataFrame(rows, "n int, `odd name` string, v double")
    assert rows_of(sc.distinct_rows(df)) == rows_of(df.distinct())
    alone = df.where("n = 2")
    assert rows_of(sc.distinct_rows(alone)) == rows_of(alone)
    assert sc.distinct_rows(df.limit(0)).collect() == []
