"""Parsers against plain statements of their rules, and the order-dependent cases."""

import math
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as some
from pyspark.sql import functions as F

from acrewise.functions import features as ft
from acrewise.functions import property_type as pt
from acrewise.functions import text as tx

SLOW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
TEXTS = some.lists(some.text(alphabet="0123456789., $abcsqftlot/()-+", max_size=18), min_size=40, max_size=40)


def apply(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["o"] for r in df.select("i", expr(F.col("v")).alias("o")).orderBy("i").collect()]


def number(text):
    try:
        return float(text) if text else None
    except ValueError:
        return None


@SLOW
@given(TEXTS)
def test_parse_money_rule(spark, values):
    assert apply(spark, values, tx.parse_money) == [number(re.sub(r"[^\d.]", "", v)) for v in values]


@SLOW
@given(TEXTS)
def test_parse_sqft_rule(spark, values):
    def rule(v):
        v = v.lower().replace(",", "")
        hit = re.search(r"([\d.]+)\s*sq", v) or re.search(r"([\d.]+)", v)
        return number(hit.group(1)) if hit else None

    assert apply(spark, values, tx.parse_sqft) == [rule(v) for v in values]


@SLOW
@given(some.lists(some.integers(0, 99_999), min_size=60, max_size=60))
def test_lac_prices_round_like_python(spark, cents):
    texts = [f"{c / 10} Lac" for c in cents]
    want = [round(float(t.split()[0]) / 100, 2) for t in texts]
    assert apply(spark, texts, tx.price_to_crore) == want


def test_price_to_crore_forms(spark):
    texts = ["1.8 Crore", "29.99 Lac", "45 lakh", "50 Lacs", "10.8", "Price on Request", None, "35.5 Lac"]
    assert apply(spark, texts, tx.price_to_crore) == [1.8, 0.3, 0.45, 0.5, 10.8, None, None, 0.35]


def test_text_samples(spark):
    assert apply(spark, ["₹ 10,500/sq.ft.", None], tx.parse_rate) == [10500.0, None]
    assert apply(spark, ["3 Bedrooms", "x", None], tx.leading_int) == [3, None, None]
    assert apply(spark, ["No Balcony", "3+ Balconies"], tx.balcony_count) == ["0", "3+"]
    floors = ["Ground of 3", "Basement of 2", "Lower Ground of 4", "5 (Out of 12)", None]
    assert apply(spark, floors, tx.floor_number) == [0, 1, 0, 5, None]
    assert apply(spark, floors, lambda c: tx.floor_number(c, True)) == [0, -1, 0, 5, None]
    names = ["society 4.2 ★", "Nandan Heights", None, "nan"]
    assert apply(spark, names, tx.clean_society) == ["society", "nandan heights", "independent", "independent"]
    titles = ["2 BHK Flat in Sector 12 Gurgaon", "House in DLF Phase 1", "Flat in Sainik Farm Gurgaon", "none"]
    assert apply(spark, titles, tx.sector_of) == ["sector 12", "dlf phase 1", "sa", None]
    ages = ["May 2024", "By Dec", "0 to 1 Year Old", "later", None]
    want = ["Under Construction", "Under Construction", "New Property", "Undefined", "Undefined"]
    assert apply(spark, ages, tx.age_category) == want
    items = ["['Park', \"Children's Play Area\"]", "Power", None, "[]"]
    assert apply(spark, items, tx.parse_list) == [["Park", "Children's Play Area"], [], [], []]
    counts = ["['3 Fan', 'No AC']", "['Fan']", "[]", None]
    assert apply(spark, counts, lambda c: tx.furnishing_count(c, "Fan")) == [3, 1, 0, 0]
    assert apply(spark, counts, lambda c: tx.furnishing_count(c, "AC")) == [0, 0, 0, 0]


def test_alias_order_matters(spark):
    pairs = [("sohna", "sohna road"), ("sohna road road", "sohna road")]
    assert apply(spark, ["sohna", "sohna road"], lambda c: tx.alias_cascade(c, pairs)) == ["sohna road", "sohna road"]


def test_square_metres_win_over_the_number(spark):
    text = ["Super Built up area 1200(111.48 sq.m.)", "Super Built up area 900.5 (80 sq.m.)", "Super Built up area 70", None]
    plain = apply(spark, text, lambda c: tx.area_of(c, "super_built_up"))
    assert plain[:2] == pytest.approx([111.48 * 10.7639, 80 * 10.7639]) and plain[2:] == [70.0, None]
    strict = apply(spark, text, lambda c: tx.area_of(c, "super_built_up", sqm_strict=True))
    assert strict[0] == 1200.0 and strict[1] == pytest.approx(80 * 10.7639)


def test_property_type_cases(spark):
    values = ["row townhouses", "Town  Home", "SFR", "Yurt", "n/a", None, " Mfd/Mobile Home", "lot"]
    want = ["single_family", "townhouse", "single_family", "yurt", "unknown", "unknown", "mobile", "land"]
    assert apply(spark, values, pt.normalize_property_type) == want
    texts = ["condo next to a duplex", "Apt. 4", "detached home", "", None, "carpool"]
    assert apply(spark, texts, pt.infer_type_from_text) == ["condo", "apartment", "single_family", None, None, None]


def test_normalised_types_are_stable(spark):
    labels = sorted(set(pt.TYPE_ALIASES.values()))
    assert apply(spark, labels, pt.normalize_property_type) == labels


def test_amenity_word_boundaries(spark):
    flags = ft.amenity_flags(F.col("v"))
    assert apply(spark, ["investigated", "carpool", "Pool!", None], lambda c: flags["has_security"]) == [1, 0, 0, 0]
    assert apply(spark, ["investigated", "carpool", "Pool!", None], lambda c: flags["has_pool"]) == [0, 0, 1, 0]


def test_haversine_and_clip(spark):
    miles = apply(spark, [29.7604, None], lambda c: ft.haversine_miles(c, F.lit(-95.3698), 30.2672, -97.7431), "double")
    assert miles[0] == pytest.approx(146.0, abs=1.5) and miles[1] is None
    assert apply(spark, [5.0, -1.0, None], lambda c: ft.clip(c, lo=0.0, hi=3.0), "double") == [3.0, 0.0, None]


def test_ratio_and_numbers_under_ansi(spark):
    df = spark.createDataFrame([(1.0, 0.0), (4.0, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(ft.ratio("a", "b")).collect()] == [None, 2.0]
    keys = apply(spark, ["sector 12", "manesar"], tx.sector_number)
    assert keys[0] == 12.0 and math.isinf(keys[1])
