"""Incremental ingest against one batch run over the same files."""

import shutil

import pytest
from pyspark.sql import functions as F

from acrewise.operators.dedupe import dedupe_listings
from acrewise.schema import LISTING_COLUMNS, ensure_columns
from acrewise.sources.folder import ingest_folder
from acrewise.streaming import ingest as si

WIDE = "price,detailUrl,beds,hdpData/homeInfo/livingArea,addressCity,address\n"


@pytest.fixture
def folders(tmp_path):
    exports = tmp_path / "exports"
    exports.mkdir()
    return exports, str(tmp_path / "table"), str(tmp_path / "stream")


def _run(spark, exports, table, checkpoint, **options):
    query = si.ingest_stream(spark, str(exports), table, checkpoint, **options)
    query.awaitTermination()
    assert query.exception() is None


def _batch(spark, exports):
    paths = sorted(map(str, exports.rglob("*.csv")))
    rows = dedupe_listings(ensure_columns(ingest_folder(spark, paths)), ("address", "price"), ("ingest_seq",))
    return rows.select(*LISTING_COLUMNS)


def _same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_micro_batches_give_the_rows_of_one_batch_run(spark, folders):
    exports, table, checkpoint = folders
    (exports / "b.csv").write_text(WIDE + "300000,https://e/1,3,1500,Houston,1 A St\n200000,,2,900,Houston,2 A St\n")
    (exports / "c.csv").write_text("Pricing,Living Area,City,State,Listing URL,Street Address\n410000,2100 sqft,Houston,Texas,https://l/1,9 L St\n")
    (exports / "metro_x.csv").write_text(WIDE + "999999,https://m/1,3,1500,Houston,1 M St\n")
    _run(spark, exports, table, checkpoint)
    first = si.ingested(spark, table).count()
    # later: an earlier name wins its key, a key without url, another layout, and deliveries of known files
    (exports / "a.csv").write_text(WIDE + "310000,https://e/1,3,1500,Houston,1 A St\n200000,,5,900,Houston,2 A St\n50000,https://e/3,1,500,Katy,3 A St\n")
    (exports / "d.csv").write_text("price,url,city\n77000,https://f/1,Cypress\n")
    (exports / "again").mkdir()
    shutil.copy(exports / "b.csv", exports / "again" / "b.csv")
    _run(spark, exports, table, checkpoint)
    rows = si.ingested(spark, table)
    assert (first, rows.count()) == (3, 7) and rows.select("batch").distinct().count() == 2
    assert _same(si.current_listings(spark, table), _batch(spark, exports))
    by_url = {r["listing_url"]: r["price"] for r in si.current_listings(spark, table).collect()}
    assert by_url["https://e/1"] == 310000.0 and len(by_url) == 5
    _run(spark, exports, table, checkpoint)
    assert si.ingested(spark, table).count() == 7


def test_changed_file_under_a_known_name_passes(spark, folders):
    exports, table, checkpoint = folders
    (exports / "a.csv").write_text(WIDE + "300000,https://e/1,3,1500,Houston,1 A St\n")
    _run(spark, exports, table, checkpoint)
    (exports / "day2").mkdir()
    (exports / "day2" / "a.csv").write_text(WIDE + "300000,https://e/2,3,1500,Houston,1 A St\n")
    _run(spark, exports, table, checkpoint)
    assert {r["listing_url"] for r in si.current_listings(spark, table).collect()} == {"https://e/1", "https://e/2"}


def test_one_file_at_a_time_and_a_repeated_batch(spark, folders):
    exports, table, checkpoint = folders
    for i in range(4):
        (exports / f"f{i} (x).csv").write_text(WIDE + f"{100000 + i},https://e/{i},3,1500,Houston,{i} A St\n")
    (exports / "empty.csv").write_text("")
    _run(spark, exports, table, checkpoint, max_files=1)
    assert si.ingested(spark, table).count() == 4
    # a stream that starts anew runs its batches again over the same folders
    _run(spark, exports, table, checkpoint + "-2", max_files=1)
    assert si.current_listings(spark, table).count() == 4


def test_shared_header_takes_one_job_for_each_layout(spark, tmp_path):
    for i in range(6):
        (tmp_path / f"x {i}%.csv").write_text(f"price,url,city\n{70000 + i},https://f/{i},Cypress\n")
    rows = ingest_folder(spark, str(tmp_path))
    assert rows.count() == 6 and "__path" not in rows.columns
    assert sorted(r[0] for r in rows.select(F.col("ingest_seq.__file")).collect())[0].startswith("x")
