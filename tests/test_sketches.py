"""Profiles from mergeable sketches against the exact ones."""

import bisect

from pyspark.sql import functions as F

from acrewise.operators import profile as pf
from acrewise.operators import sketches as sk
from acrewise.operators import stats as st

COLUMNS = ["price", "sqft", "bedrooms", "location", "state", "listing_url"]


def _close(exact, found, values):
    """Exact parts equal, estimated parts inside the stated bounds."""
    exact, found = ({r["column"]: r for r in t.collect()} for t in (exact, found))
    assert set(exact) == set(found)
    for c, want in exact.items():
        got = found[c]
        assert got["dtype"] == want["dtype"] and abs(got["missing_rate"] - want["missing_rate"]) < 1e-12
        assert abs(got["n_unique"] - want["n_unique"]) <= 3 * sk.DISTINCT_ERROR * want["n_unique"] + 1
        if want["skew"] is None:
            assert got["skew"] is None and got["p50"] is None
        else:
            assert abs(got["skew"] - want["skew"]) < 1e-6
        for name, p in (("p01", 0.01), ("p50", 0.5), ("p99", 0.99)):
            if want[name] is not None:
                have = values[c]
                low, high = bisect.bisect_left(have, got[name]) / len(have), bisect.bisect_right(have, got[name]) / len(have)
                assert low - sk.RANK_ERROR - 1e-9 <= p <= high + sk.RANK_ERROR + 1e-9, (c, name)


def _sorted_values(df, cols):
    return {c: sorted(r[0] for r in df.where(F.col(c).isNotNull()).select(c).collect()) for c in cols}


def test_approx_profile_is_inside_its_bounds(spark, listings):
    rows = listings.select(*COLUMNS)
    exact, found = pf.profile_columns(rows), pf.profile_columns(rows, approx=True)
    assert exact.columns == found.columns
    _close(exact, found, _sorted_values(rows, COLUMNS[:3]))
    tops = [{r["column"]: r["top_values"] for r in t.where("column in ('location', 'state')").collect()} for t in (exact, found)]
    assert tops[0] == tops[1]


def test_large_skewed_column_keeps_the_bounds(spark):
    hot = F.when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise(F.exp(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) / (1 << 17)))
    rows = spark.range(300_000).select(hot.alias("v"), (F.col("id") % 50).cast("string").alias("source_file"))
    files = sk.column_sketches(rows)
    assert files.count() == 50
    _close(pf.profile_columns(rows.select("v")), sk.profile(files), _sorted_values(rows, ["v"]))


def test_new_files_are_merged_and_known_files_are_not_read_again(spark, listings, tmp_path):
    rows = listings.select("source_file", *COLUMNS)
    store = str(tmp_path / "store")
    sk.append_sketches(rows.where("source_file < 'export_2.csv'"), store)
    before = spark.read.parquet(store).count()
    sk.append_sketches(rows, store)
    assert before == 2 * len(COLUMNS) and spark.read.parquet(store).count() == 4 * len(COLUMNS)
    sk.append_sketches(rows, store)
    assert spark.read.parquet(store).count() == 4 * len(COLUMNS)
    _close(pf.profile_columns(rows.drop("source_file")), sk.stored_profile(spark, store), _sorted_values(rows, COLUMNS[:3]))


def test_odd_columns(spark, tmp_path):
    odd = spark.createDataFrame(
        [("a", None, 1, True, None, "x"), (None, None, 1, None, None, ""), ("a", None, 1, False, None, None)],
        "source_file string, none double, same int, flag boolean, notext string, text string",
    )
    found = {r["column"]: r for r in sk.profile(sk.column_sketches(odd)).collect()}
    assert (found["none"]["n_unique"], found["none"]["p50"], found["none"]["skew"], found["none"]["missing_rate"]) == (0, None, None, 1.0)
    assert (found["same"]["n_unique"], found["same"]["p50"], found["same"]["skew"]) == (1, 1.0, 0.0)
    assert found["flag"]["p50"] in (0.0, 1.0) and found["notext"]["top_values"] == "nan:3"
    assert found["text"]["top_values"] == ":1; nan:1; x:1" and found["text"]["n_unique"] == 2
    store = str(tmp_path / "odd")
    for _ in range(2):  # rows without a file name are one file
        sk.append_sketches(odd, store)
    assert spark.read.parquet(store).count() == 10
    assert sk.profile(sk.column_sketches(odd.limit(0))).count() == 0


def test_describe_from_sketches(spark, listings):
    exact, found = (st.describe(listings, ["sqft"], approx=x).first() for x in (False, True))
    values = _sorted_values(listings, ["sqft"])["sqft"]
    assert [found[c] for c in ("count", "mean", "min", "max", "std")] == [exact[c] for c in ("count", "mean", "min", "max", "std")]
    assert abs(bisect.bisect_right(values, found["p50"]) / len(values) - 0.5) <= sk.RANK_ERROR + 1 / len(values) + 2e-3


def test_crosstab_is_long_unless_its_columns_are_named(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 3.0), ("a", "x", 2.0), ("b", None, 4.0)], "a string, b string, v double")
    assert sorted(map(tuple, st.crosstab(df, "a", "b").collect())) == [("a", "x", 2), ("a", "y", 1)]
    assert sorted(map(tuple, st.pivot_mean(df, "a", "b", "v").collect())) == [("a", "x", 1.5), ("a", "y", 3.0)]
    assert [tuple(r) for r in st.crosstab(df, "a", "b", ["x", "z"]).collect()] == [("a", 2, 0)]
