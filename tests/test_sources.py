"""Reading export files, page rows, augmentation and writers."""

import pytest
from pyspark.sql import functions as F

from acrewise import schema as sc
from acrewise.operators.encode import build_preprocessor
from acrewise.plans import listings as lp
from acrewise.sources import adapters as ad
from acrewise.sources import augment as ag
from acrewise.sources import folder as fd
from acrewise.sources import regional as rg
from acrewise.sources import sinks


@pytest.fixture
def exports(tmp_path):
    (tmp_path / "a_blob.csv").write_text(
        "id,property\n"
        "1,\"{'price': {'value': 250000}, 'bedrooms': 3, 'livingArea': None, 'hdpView': {'hdpUrl': '/x/1'}, 'address': {'city': 'Katy', 'state': 'tx'}}\"\n"
        "2,\"{'price': 999}\"\n3,not a dict\n4,\"{'price': '$1,500', 'flag': True}\"\n"
    )
    (tmp_path / "b_wide.csv").write_text(
        'price,detailUrl,beds,hdpData/homeInfo/livingArea,addressCity\n"$300,000",https://e/1,3,1500,Houston\n"$9,000",https://e/2,1,400,Houston\n'
    )
    (tmp_path / "c_semi.csv").write_text(
        "price;city;beds;baths;area;homeType;yearBuilt;latitude;longitude;url\n5000;Spring;2;1;900;CONDO;1990;29.9;-95.4;https://s/1\nbad;Spring;2;1;900;CONDO;1990;29.9;-95.4;https://s/2\n"
    )
    (tmp_path / "d_export.csv").write_text(
        'Pricing,Living Area,Number of Bedrooms,City,State,Listing URL\n"$410,000","2,100 sqft",4,Houston,Texas,https://l/1\n"$420,000","1,100 sqft",4,Tulsa,OK,https://l/2\n'
    )
    (tmp_path / "e_fallback.csv").write_text("price,url,city\n77000,https://f/1,Cypress\n")
    (tmp_path / "Metro_zhvi.csv").write_text("price,url\n1000000,https://m/1\n")
    (tmp_path / "b_wide (1).csv").write_text("price,detailUrl\n555555,https://copy\n")
    return str(tmp_path)


def test_ingest_folder_families(spark, exports):
    rows = {r["listing_url"]: r for r in fd.ingest_folder(spark, exports).collect()}
    assert set(rows) == {"https://www.zillow.com/x/1", None, "https://e/1", "https://s/1", "https://l/1", "https://f/1"}
    blob = rows["https://www.zillow.com/x/1"]
    assert (blob["price"], blob["sqft"], blob["state"], blob["address"]) == (250000.0, None, "TX", ", Katy, TX")
    assert rows[None]["price"] == 1500.0 and rows[None]["location"] == "Houston"
    assert rows["https://s/1"]["property_type"] == "condo" and rows["https://s/1"]["price"] == 5000.0
    export = rows["https://l/1"]
    assert export["sqft"] == 2100.0 and 29.0 < export["latitude"] < 30.5
    assert {r["data_tier"] for r in rows.values()} == {"real_raw"}


def test_line_breaks_in_quoted_cells_stay_in_their_record(spark, tmp_path):
    (tmp_path / "w.csv").write_text('note,price,detailUrl\n"line one\n7,https://false/1,x",90000,https://t/1\nplain,80000,https://t/2\n')
    (tmp_path / "long.csv").write_text("price,detailUrl," + ",".join(f"c{i:06d}" for i in range(30_000)) + "\n50000,https://t/3\n")
    rows = {r["listing_url"]: r["price"] for r in fd.ingest_folder(spark, str(tmp_path / "w.csv")).collect()}
    assert rows == {"https://t/1": 90000.0, "https://t/2": 80000.0}
    assert len(fd.list_exports(spark, str(tmp_path))[0][1]) > 200_000


def test_collect_is_repeatable_and_reaches_the_target(spark, exports):
    rows = lp.collect(spark, exports, target_rows=40)
    assert rows.columns == sc.LISTING_COLUMNS
    again = lp.collect(spark, exports, target_rows=40)
    assert rows.count() == 40 and rows.exceptAll(again).count() == 0
    assert rows.where("is_synthetic_augment").count() == 34


def test_collect_fallback_and_empty_folder(spark, tmp_path):
    national = spark.createDataFrame([(90000.0, "TX", "Dallas"), (90000.0, "OK", "Tulsa")], "price double, state string, city string")
    (tmp_path / "zhvi.csv").write_text("a\n1\n")
    assert lp.collect(spark, str(tmp_path), fallback=national).count() == 1
    with pytest.raises(RuntimeError):
        lp.collect(spark, str(tmp_path))


def test_skip_rules_and_families():
    assert fd.is_skipped("metro_x.csv") and fd.is_skipped("a zhvi.csv") and fd.is_skipped("a (2).csv")
    assert not fd.is_skipped("a.csv")
    assert fd.families_of("property,x") == ["blob"]
    assert fd.families_of(";".join("abcdefghijk")) == ["semicolon", "wide"]
    assert fd.families_of("price,hdpData/homeInfo/x") == ["wide"]
    assert fd.families_of("Listing URL,Pricing") == ["export"]


def test_header_resolution_prefers_fragment_order():
    got = ad.resolve_headers(["Zip Area", "Zipcode", "Lot", "Street Address"])
    assert got["zipcode"] == "Zipcode" and got["address"] == "Street Address" and got["price"] is None


def test_augment_errors_and_bounds(spark, listings):
    rows = sc.ensure_columns(listings)
    with pytest.raises(ValueError):
        ag.bootstrap_augment(rows.limit(0), 10, ["listing_id"])
    assert ag.bootstrap_augment(rows, 5, ["listing_id"]).count() == rows.count()
    out = ag.bootstrap_augment(rows, 1600, ["listing_id"]).where("is_synthetic_augment")
    assert out.count() == 100
    bad = out.where("price < 25000 OR price > 18000000 OR sqft < 400 OR bathrooms > 8 OR year_built > 2026 OR listing_url IS NOT NULL")
    assert bad.count() == 0 and out.where(~F.col("address").endswith("[aug]")).count() == 0


def test_source_gate(spark):
    df = spark.createDataFrame([("a",), ("a",)], "source string")
    with pytest.raises(RuntimeError):
        rg.source_gate(df, 2, 1)
    with pytest.raises(RuntimeError):
        rg.source_gate(df, 1, 5)
    assert rg.source_gate(df, 1, 2).first()["rows"] == 2


def test_writers_and_model_store(spark, listings, tmp_path):
    sinks.write_table(listings.select("listing_id", "price"), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == listings.count()
    fitted = build_preprocessor(["sqft", "bedrooms"], ["location"]).fit(listings)
    sinks.save_model(fitted, str(tmp_path / "m"))
    loaded = sinks.load_model(str(tmp_path / "m"))
    a = fitted.transform(listings).select("listing_id", F.col("features").cast("string"))
    b = loaded.transform(listings).select("listing_id", F.col("features").cast("string"))
    assert a.exceptAll(b).count() == 0


def test_collect_parses_exports_once_before_it_augments(spark, exports, monkeypatch):
    seen = []
    monkeypatch.setattr(lp, "bootstrap_augment", lambda df, *a: seen.append(df.inputFiles()) or ag.bootstrap_augment(df, *a))
    assert lp.collect(spark, exports, target_rows=12).count() == 12
    assert seen[0] and all(f.endswith(".parquet") for f in seen[0])


def test_rows_of_one_export_are_parsed_in_several_tasks_and_once(spark, exports):
    plan = fd.ingest_folder(spark, f"{exports}/a_blob.csv")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert plan.index("ArrowEvalPython") < plan.index("Exchange hashpartitioning(__file") < plan.index("csv")


def test_augmented_collect_leaves_no_exports_behind(spark, sf):
    import os

    from acrewise.queries import QUERIES
    from acrewise.scale import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    exported = lambda: {f for d in os.listdir(folder) if d.startswith("exports-") for f in os.listdir(f"{folder}/{d}")}
    os.makedirs(folder, exist_ok=True)
    before = exported()
    rows = QUERIES["c01_collect_augmented"](spark, sf)
    assert not any(f.startswith("part-") for f in exported() - before)
    assert rows.count() == 4 * 1500 and rows.distinct().count() == 4 * 1500
