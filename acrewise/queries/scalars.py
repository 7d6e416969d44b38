"""X and M rows: text parsing and derived scalars."""

from __future__ import annotations

from pyspark.sql import functions as F

from acrewise.functions import features as ft
from acrewise.functions import property_type as pt
from acrewise.functions import text as tx
from acrewise.functions.unit_values import (
    AGE_LABELS,
    AMENITY_WEIGHTS,
    ROOM_KINDS,
    SECTOR_ALIASES,
    SECTOR_ALIASES_AFTER,
)
from acrewise.queries.registry import flats, listings, over, query, r, units


def _lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# text derived from the listings, the same expression in both engines
_MONEY = """CASE listing_id % 6 WHEN 0 THEN '$' || CAST(100 + listing_id AS STRING) || ',500' WHEN 1 THEN '1.2.3'
 WHEN 2 THEN NULL WHEN 3 THEN 'call us' WHEN 4 THEN 'USD ' || CAST(listing_id AS STRING) || '.75/mo' ELSE '.' END"""
_SQFT = """CASE listing_id % 5 WHEN 0 THEN CAST(1 + listing_id % 9 AS STRING) || ',' || CAST(100 + listing_id % 900 AS STRING) || ' Sq Ft'
 WHEN 1 THEN 'lot 3, ' || CAST(900 + listing_id % 700 AS STRING) || 'sqft' WHEN 2 THEN 'about ' || CAST(listing_id AS STRING) || '.5 feet'
 WHEN 3 THEN 'n/a' ELSE NULL END"""


@query(
    "x01_parse_money",
    over("listings", f"SELECT listing_id, TRY_CAST(NULLIF(regexp_replace({_MONEY}, '[^0-9.]', '', 'g'), '') AS DOUBLE) AS amount FROM listings"),
)
def x01(spark, sf):
    return listings(spark, sf).select("listing_id", tx.parse_money(F.expr(_MONEY)).alias("amount"))


@query(
    "x02_parse_sqft",
    over(
        "listings",
        f""", t AS (SELECT listing_id, replace(lower({_SQFT}), ',', '') AS s FROM listings)
        SELECT listing_id, TRY_CAST(coalesce(NULLIF(regexp_extract(s, '([0-9.]+)\\s*sq', 1), ''), NULLIF(regexp_extract(s, '([0-9.]+)', 1), '')) AS DOUBLE) AS sqft FROM t""",
    ),
)
def x02(spark, sf):
    return listings(spark, sf).select("listing_id", tx.parse_sqft(F.expr(_SQFT)).alias("sqft"))


@query(
    "x03_price_to_crore",
    over(
        "flats",
        r""", t AS (SELECT property_id, trim(lower(price)) AS p, TRY_CAST(NULLIF(regexp_extract(price, '(\d+\.?\d*)', 1), '') AS DOUBLE) AS n FROM flats)
        SELECT property_id, round_even(CASE WHEN contains(p, 'crore') THEN n WHEN contains(p, 'lac') OR contains(p, 'lakh') THEN n / 100
               ELSE TRY_CAST(p AS DOUBLE) END, 2) AS crore FROM t""",
    ),
)
def x03(spark, sf):
    return flats(spark, sf).select("property_id", tx.price_to_crore("price").alias("crore"))


@query(
    "x04_parse_rate",
    over("flats", "SELECT property_id, TRY_CAST(trim(replace(replace(split_part(rate, '/', 1), '₹', ''), ',', '')) AS DOUBLE) AS rate FROM flats"),
)
def x04(spark, sf):
    return flats(spark, sf).select("property_id", tx.parse_rate("rate").alias("rate"))


@query(
    "x05_leading_int",
    over(
        "flats",
        """SELECT property_id, TRY_CAST(split_part(bedRoom, ' ', 1) AS INTEGER) AS bedrooms, TRY_CAST(split_part(bathroom, ' ', 1) AS INTEGER) AS bathrooms,
        replace(split_part(balcony, ' ', 1), 'No', '0') AS balconies FROM flats""",
    ),
)
def x05(spark, sf):
    return flats(spark, sf).select(
        "property_id",
        tx.leading_int("bedRoom").alias("bedrooms"),
        tx.leading_int("bathroom").alias("bathrooms"),
        tx.balcony_count("balcony").alias("balconies"),
    )


@query(
    "x06_floor_number",
    over(
        "flats",
        r""", t AS (SELECT property_id, replace(replace(CASE WHEN split_part(floorNum, ' ', 1) = 'Ground' THEN '0' ELSE split_part(floorNum, ' ', 1) END, 'Basement', '-1'), 'Lower', '0') AS f FROM flats)
        SELECT property_id, TRY_CAST(NULLIF(regexp_extract(f, '(\d+)', 1), '') AS INTEGER) AS floor,
               TRY_CAST(NULLIF(regexp_extract(f, '(-?\d+)', 1), '') AS INTEGER) AS signed_floor FROM t""",
    ),
)
def x06(spark, sf):
    return flats(spark, sf).select(
        "property_id",
        tx.floor_number("floorNum").alias("floor"),
        tx.floor_number("floorNum", basement_sign=True).alias("signed_floor"),
    )


@query(
    "x07_clean_society",
    over("flats", r"SELECT property_id, coalesce(lower(trim(regexp_replace(society, '\d+(\.\d+)?\s?★', '', 'g'))), 'independent') AS society FROM flats"),
)
def x07(spark, sf):
    return flats(spark, sf).select("property_id", tx.clean_society("society").alias("society"))


_SECTOR = "lower(trim(replace(string_split(property_name, 'in')[2], 'Gurgaon', '')))"


@query("x08_sector_of", over("flats", f"SELECT property_id, {_SECTOR} AS sector FROM flats"))
def x08(spark, sf):
    return flats(spark, sf).select("property_id", tx.sector_of("property_name").alias("sector"))


def _nested_replace(expr: str, pairs: list[tuple[str, str]]) -> str:
    for old, new in pairs:
        expr = f"replace({expr}, {_lit(old)}, {_lit(new)})"
    return expr


@query(
    "x09_alias_cascade",
    over(
        "flats",
        f"SELECT property_id, {_nested_replace(_SECTOR, SECTOR_ALIASES + SECTOR_ALIASES_AFTER)} AS sector FROM flats",
    ),
)
def x09(spark, sf):
    pairs = SECTOR_ALIASES + SECTOR_ALIASES_AFTER
    return flats(spark, sf).select("property_id", tx.alias_cascade(tx.sector_of("property_name"), pairs).alias("sector"))


def _area(pattern: str, group: int = 1) -> str:
    return f"TRY_CAST(NULLIF(regexp_extract(areaWithType, '{pattern}', {group}), '') AS DOUBLE)"


_NUM = r"(\d+\.?\d*)"


@query(
    "x10_area_extract",
    over(
        "flats",
        f"""SELECT property_id, {_area("Super Built up area " + _NUM)} AS super_built_up, {_area("Built Up area" + chr(92) + "s*:" + chr(92) + "s*" + _NUM)} AS built_up,
        {_area("Carpet area" + chr(92) + "s*:" + chr(92) + "s*" + _NUM)} AS carpet, {_area("Plot area " + _NUM)} AS plot FROM flats""",
    ),
)
def x10(spark, sf):
    kinds = ["super_built_up", "built_up", "carpet", "plot"]
    return flats(spark, sf).select(
        "property_id", *[tx.area_of("areaWithType", k, sqm=False).alias(k) for k in kinds]
    )


_SQM = r"\d+\.?\d*\s*\((\d+\.?\d*) sq\.m\.\)"
_SUPER = f"coalesce({_area('Super Built up area ' + _SQM)} * 10.7639, {_area('Super Built up area ' + _NUM)})"
_BUILT = rf"coalesce({_area('Built Up area' + chr(92) + 's*:' + chr(92) + 's*' + _SQM)} * 10.7639, {_area('Built Up area' + chr(92) + 's*:' + chr(92) + 's*' + _NUM)})"
_CARPET = rf"coalesce({_area('Carpet area' + chr(92) + 's*:' + chr(92) + 's*' + _SQM)} * 10.7639, {_area('Carpet area' + chr(92) + 's*:' + chr(92) + 's*' + _NUM)})"


@query(
    "x11_area_sqm",
    over("flats", f"SELECT property_id, round({_SUPER}, 6) AS super_built_up, round({_CARPET}, 6) AS carpet FROM flats"),
)
def x11(spark, sf):
    return flats(spark, sf).select(
        "property_id",
        r(tx.area_of("areaWithType", "super_built_up"), 6).alias("super_built_up"),
        r(tx.area_of("areaWithType", "carpet"), 6).alias("carpet"),
    )


@query(
    "x12_area_fallback",
    over(
        "flats",
        f""", t AS (SELECT property_id, {_SUPER} AS s, {_BUILT} AS b, {_CARPET} AS c, {_area("Plot area " + _NUM)} AS p FROM flats)
        SELECT property_id, round(s, 6) AS super_built_up_area, round(CASE WHEN s IS NULL AND b IS NULL AND c IS NULL THEN p ELSE b END, 6) AS built_up_area,
               round(c, 6) AS carpet_area FROM t""",
    ),
)
def x12(spark, sf):
    cols = ["super_built_up_area", "built_up_area", "carpet_area"]
    return tx.with_areas(flats(spark, sf)).select("property_id", *[r(c, 6).alias(c) for c in cols])


@query(
    "x13_contains_flags",
    over(
        "flats",
        """SELECT property_id, CAST(contains(lower(coalesce(additionalRoom, 'not available')), 'study room') AS INTEGER) AS study_room,
        CAST(contains(lower(coalesce(additionalRoom, 'not available')), 'servant room') AS INTEGER) AS servant_room,
        CAST(contains(lower(coalesce(additionalRoom, 'not available')), 'store room') AS INTEGER) AS store_room,
        CAST(contains(lower(coalesce(additionalRoom, 'not available')), 'pooja room') AS INTEGER) AS pooja_room,
        CAST(contains(lower(coalesce(additionalRoom, 'not available')), 'others') AS INTEGER) AS others FROM flats""",
    ),
)
def x13(spark, sf):
    rows = flats(spark, sf).withColumn("rooms", F.lower(F.coalesce("additionalRoom", F.lit("not available"))))
    flagged = tx.contains_flags(rows, "rooms", ROOM_KINDS)
    return flagged.select("property_id", *[F.col(f"`{k}`").alias(k.replace(" ", "_")) for k in ROOM_KINDS])


_AGE = """CASE WHEN agePossession IS NULL THEN 'Undefined'
 WHEN contains(agePossession, '0 to 1 Year Old') OR contains(agePossession, 'Within 6 months') OR contains(agePossession, 'Within 3 months') THEN 'New Property'
 WHEN contains(agePossession, '1 to 5 Year Old') THEN 'Relatively New' WHEN contains(agePossession, '5 to 10 Year Old') THEN 'Moderately Old'
 WHEN contains(agePossession, '10+ Year Old') THEN 'Old Property'
 WHEN contains(agePossession, 'Under Construction') OR contains(agePossession, 'By') THEN 'Under Construction'
 WHEN regexp_matches(agePossession, '(^| )[0-9]+$') THEN 'Under Construction' ELSE 'Undefined' END"""


@query("x14_age_category", over("flats", f"SELECT property_id, {_AGE} AS age FROM flats"))
def x14(spark, sf):
    return flats(spark, sf).select("property_id", tx.age_category("agePossession").alias("age"))


@query(
    "x15_map_or_default",
    over(
        "flats",
        "SELECT property_id, CASE "
        + " ".join(f"WHEN agePossession = {_lit(k)} THEN {_lit(v)}" for k, v in AGE_LABELS.items())
        + " ELSE 'Undefined' END AS age FROM flats",
    ),
)
def x15(spark, sf):
    return flats(spark, sf).select("property_id", tx.map_or_default("agePossession", AGE_LABELS, "Undefined").alias("age"))


_TERMS = ["Fan", "AC", "Sofa", "Light", "Bed", "Modular Kitchen"]


def _count_sql(t: str) -> str:
    return (
        f"CASE WHEN furnishDetails IS NULL OR contains(furnishDetails, 'No {t}') THEN 0 "
        f"WHEN regexp_matches(furnishDetails, '\\d+ {t}') THEN CAST(regexp_extract(furnishDetails, '(\\d+) {t}', 1) AS INTEGER) "
        f"WHEN contains(furnishDetails, '{t}') THEN 1 ELSE 0 END AS {t.lower().replace(' ', '_')}"
    )


@query("x16_furnishing_count", over("flats", f"SELECT property_id, {', '.join(_count_sql(t) for t in _TERMS)} FROM flats"))
def x16(spark, sf):
    return flats(spark, sf).select(
        "property_id", *[tx.furnishing_count("furnishDetails", t).alias(t.lower().replace(" ", "_")) for t in _TERMS]
    )


@query(
    "x17_furnishing_terms",
    over(
        "flats",
        r""", t AS (SELECT unnest(string_split(replace(replace(replace(furnishDetails, '[', ''), ']', ''), chr(39), ''), ', ')) AS item FROM flats WHERE furnishDetails IS NOT NULL)
        SELECT DISTINCT trim(regexp_replace(item, 'No |\d+', '', 'g')) AS term FROM t WHERE trim(regexp_replace(item, 'No |\d+', '', 'g')) <> ''""",
    ),
)
def x17(spark, sf):
    return tx.furnishing_terms(flats(spark, sf), "furnishDetails")


_ITEMS = """CASE WHEN starts_with(features, '[') THEN list_transform(regexp_extract_all(features, '''[^'']*''|"[^"]*"'), lambda x: substr(x, 2, length(x) - 2)) ELSE [] END"""


@query("x18_parse_list", over("flats", f"SELECT property_id, array_to_string({_ITEMS}, '|') AS items, len({_ITEMS}) AS n FROM flats"))
def x18(spark, sf):
    items = tx.parse_list("features")
    return flats(spark, sf).select("property_id", F.array_join(items, "|").alias("items"), F.size(items).cast("bigint").alias("n"))


_VOCABULARY = ["Swimming Pool", "Park", "Club House", "Golf Course", "Helipad"]


@query(
    "x19_binarize",
    over(
        "flats",
        "SELECT property_id, "
        + ", ".join(f"CAST(list_contains({_ITEMS}, '{v}') AS INTEGER) AS {v.lower().replace(' ', '_')}" for v in _VOCABULARY)
        + " FROM flats",
    ),
)
def x19(spark, sf):
    rows = tx.binarize(flats(spark, sf).withColumn("items", tx.parse_list("features")), "items", _VOCABULARY)
    return rows.select("property_id", *[F.col(f"`{v}`").alias(v.lower().replace(" ", "_")) for v in _VOCABULARY])


_WEIGHTS_SQL = ", ".join(f"({_lit(k)}, {v})" for k, v in AMENITY_WEIGHTS.items())


@query(
    "x20_weighted_score",
    over(
        "flats",
        f""", w(term, weight) AS (VALUES {_WEIGHTS_SQL}), i AS (SELECT property_id, unnest(list_distinct({_ITEMS})) AS term FROM flats)
        SELECT f.property_id, CAST(coalesce(sum(w.weight), 0) AS INTEGER) AS score FROM flats f LEFT JOIN i ON f.property_id = i.property_id
        LEFT JOIN w ON i.term = w.term GROUP BY f.property_id""",
    ),
)
def x20(spark, sf):
    return flats(spark, sf).select(
        "property_id", tx.weighted_score(tx.parse_list("features"), AMENITY_WEIGHTS).alias("score")
    )


def _normal_sql(expr: str) -> str:
    raw = rf"regexp_replace(lower(trim(coalesce({expr}, ''))), '\s+', ' ', 'g')"
    unknown = ", ".join(_lit(t) for t in pt.UNKNOWN_TYPES)
    exact = " ".join(f"WHEN {raw} = {_lit(a)} THEN {_lit(v)}" for a, v in pt.TYPE_ALIASES.items())
    inside = " ".join(f"WHEN contains({raw}, {_lit(a)}) THEN {_lit(v)}" for a, v in pt.TYPE_ALIASES.items())
    return f"CASE WHEN {raw} IN ({unknown}) THEN 'unknown' {exact} {inside} ELSE {raw} END"


_INFER_TEXT = (
    "CASE "
    + " ".join(f"WHEN regexp_matches(lower(coalesce(description, '')), {_lit(p)}) THEN {_lit(v)}" for p, v in pt.TYPE_PATTERNS)
    + " END"
)
_INFER = f"coalesce({_INFER_TEXT}, CASE WHEN sqft < 1100 AND bedrooms <= 2 THEN 'condo' ELSE 'single_family' END)"
RESOLVED_TYPE = f"CASE WHEN {_normal_sql('property_type')} = 'unknown' THEN {_INFER} ELSE {_normal_sql('property_type')} END"


@query("x21_normalize_property_type", over("listings", f"SELECT listing_id, {_normal_sql('property_type')} AS type FROM listings"))
def x21(spark, sf):
    return listings(spark, sf).select("listing_id", pt.normalize_property_type("property_type").alias("type"))


@query("x22_infer_type_from_text", over("listings", f"SELECT listing_id, {_INFER_TEXT} AS type FROM listings"))
def x22(spark, sf):
    return listings(spark, sf).select("listing_id", pt.infer_type_from_text("description").alias("type"))


@query("x23_infer_type", over("listings", f"SELECT listing_id, {_INFER} AS type FROM listings"))
def x23(spark, sf):
    return listings(spark, sf).select("listing_id", pt.infer_type("description", "sqft", "bedrooms").alias("type"))


@query("x24_resolve_property_type", over("listings", f"SELECT listing_id, {RESOLVED_TYPE} AS property_type FROM listings"))
def x24(spark, sf):
    return pt.resolve_property_type(listings(spark, sf)).select("listing_id", "property_type")


FLAG_SQL = {n: f"CAST(regexp_matches(lower(coalesce(description, '')), '{p}') AS INTEGER)" for n, p in ft.AMENITY_PATTERNS.items()}


@query(
    "x25_amenity_flags",
    over(
        "listings",
        "SELECT listing_id, "
        + ", ".join(f"{e} AS {n}" for n, e in FLAG_SQL.items())
        + ", "
        + " + ".join(FLAG_SQL.values())
        + " AS amenity_count FROM listings",
    ),
)
def x25(spark, sf):
    return ft.with_amenities(listings(spark, sf)).select("listing_id", *ft.AMENITY_PATTERNS, "amenity_count")


@query(
    "x26_sector_number",
    over("units", r"SELECT listing_id, coalesce(TRY_CAST(NULLIF(regexp_extract(coalesce(sector, 'manesar'), '(\d+)', 1), '') AS DOUBLE), CAST('inf' AS DOUBLE)) AS n FROM units"),
)
def x26(spark, sf):
    return units(spark, sf).select("listing_id", tx.sector_number(F.coalesce("sector", F.lit("manesar"))).alias("n"))


@query(
    "x27_digits_to_number",
    over("flats", "SELECT property_id, TRY_CAST(NULLIF(regexp_replace(rate, '[^0-9.]', '', 'g'), '') AS DOUBLE) AS n FROM flats"),
)
def x27(spark, sf):
    return flats(spark, sf).select("property_id", tx.digits_to_number("rate").alias("n"))


@query("x28_fix_zip", over("listings", r"SELECT listing_id, regexp_replace(zipcode, '\.0$', '') AS zipcode FROM listings"))
def x28(spark, sf):
    return listings(spark, sf).select("listing_id", tx.fix_zip("zipcode").alias("zipcode"))


_ADDRESS = "CASE listing_id % 10 WHEN 0 THEN NULL WHEN 1 THEN ' , Houston' ELSE address END"


@query(
    "x29_street_of",
    over("listings", f"SELECT listing_id, CASE WHEN trim(split_part(coalesce({_ADDRESS}, ''), ',', 1)) = '' THEN '(no address)' ELSE trim(split_part({_ADDRESS}, ',', 1)) END AS street FROM listings"),
)
def x29(spark, sf):
    return listings(spark, sf).select("listing_id", tx.street_of(F.expr(_ADDRESS)).alias("street"))


@query(
    "x30_bedroom_label",
    over(
        "listings",
        """SELECT listing_id, CASE WHEN bedrooms >= 5 THEN '5+ BHK' WHEN bedrooms IS NOT NULL THEN CAST(CAST(bedrooms AS BIGINT) AS STRING) || ' BHK' ELSE 'Unknown' END AS bhk,
        CAST(CAST(least(greatest(coalesce(bedrooms, -1), 0), 8) AS BIGINT) AS STRING) || ' BR' AS br,
        CASE WHEN bedrooms >= 5 THEN '5+' ELSE CAST(CAST(coalesce(bedrooms, -1) AS BIGINT) AS STRING) END AS diagnostic FROM listings""",
    ),
)
def x30(spark, sf):
    return listings(spark, sf).select(
        "listing_id", *[tx.bedroom_label("bedrooms", s).alias(s) for s in ("bhk", "br", "diagnostic")]
    )


@query(
    "x31_key_groups",
    over("listings", "SELECT address, price, count(*) AS n FROM listings GROUP BY address, price"),
)
def x31(spark, sf):
    keyed = listings(spark, sf).groupBy(tx.key_of("address", "price").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return keyed.select(F.col("k.k0").alias("address"), F.col("k.k1").alias("price"), "n")


# derived scalars -----------------------------------------------------------------------------------------


@query(
    "m01_price_per_sqft",
    over(
        "listings",
        """, p AS (SELECT listing_id, price / NULLIF(sqft, 0) AS v FROM listings)
        SELECT listing_id, round(coalesce(v, (SELECT median(v) FROM p)), 4) AS price_per_sqft FROM p""",
    ),
)
def m01(spark, sf):
    rows = ft.with_ratios(listings(spark, sf), {"price_per_sqft": ("price", "sqft")})
    return rows.select("listing_id", r("price_per_sqft", 4).alias("price_per_sqft"))


@query("m02_property_age", over("listings", "SELECT listing_id, CASE WHEN year_built IS NOT NULL THEN greatest(2020 - year_built, 0) END AS age FROM listings"))
def m02(spark, sf):
    return listings(spark, sf).select("listing_id", ft.property_age("year_built", 2020).alias("age"))


@query(
    "m03_ratios",
    over(
        "listings",
        """, p AS (SELECT listing_id, bedrooms / NULLIF(bathrooms, 0) AS a, sqft / NULLIF(bedrooms, 0) AS b, bathrooms / NULLIF(bedrooms, 0) AS c FROM listings),
        m AS (SELECT median(a) AS ma, median(b) AS mb, median(c) AS mc FROM p)
        SELECT listing_id, round(coalesce(a, ma), 6) AS bed_bath_ratio, round(coalesce(b, mb), 6) AS sqft_per_bedroom, round(coalesce(c, mc), 6) AS bath_per_bedroom FROM p, m""",
    ),
)
def m03(spark, sf):
    specs = {
        "bed_bath_ratio": ("bedrooms", "bathrooms"),
        "sqft_per_bedroom": ("sqft", "bedrooms"),
        "bath_per_bedroom": ("bathrooms", "bedrooms"),
    }
    return ft.with_ratios(listings(spark, sf), specs).select("listing_id", *[r(c).alias(c) for c in specs])


def haversine_sql(lat: str, lon: str, lat0: str, lon0: str) -> str:
    h = (
        f"pow(sin((radians({lat0}) - radians({lat})) / 2), 2) + cos(radians({lat})) * cos(radians({lat0})) * "
        f"pow(sin((radians({lon0}) - radians({lon})) / 2), 2)"
    )
    return f"(2 * 3958.7613 * asin(sqrt(CASE WHEN {h} > 1 THEN 1 WHEN {h} < 0 THEN 0 ELSE {h} END)))"


@query(
    "m04_haversine",
    over("listings", f"SELECT listing_id, round({haversine_sql('latitude', 'longitude', '30.2', '-97.7')}, 6) AS miles FROM listings"),
)
def m04(spark, sf):
    return listings(spark, sf).select("listing_id", r(ft.haversine_miles("latitude", "longitude", 30.2, -97.7)).alias("miles"))


@query(
    "m05_dist_to_city",
    over("listings", f"SELECT listing_id, round({haversine_sql('latitude', 'longitude', '29.7604', '-95.3698')}, 6) AS miles FROM listings"),
)
def m05(spark, sf):
    miles = ft.haversine_miles("latitude", "longitude", ft.CENTER_LAT, ft.CENTER_LON)
    return listings(spark, sf).select("listing_id", r(miles).alias("miles"))


@query(
    "m06_dist_to_group_center",
    over(
        "listings",
        f""", g AS (SELECT median(latitude) AS mlat, median(longitude) AS mlon FROM listings),
        c AS (SELECT location, median(latitude) AS clat, median(longitude) AS clon FROM listings GROUP BY location)
        SELECT l.listing_id, round({haversine_sql('coalesce(l.latitude, g.mlat)', 'coalesce(l.longitude, g.mlon)', 'c.clat', 'c.clon')}, 6) AS miles
        FROM listings l JOIN c ON l.location = c.location, g""",
    ),
)
def m06(spark, sf):
    rows = ft.dist_to_center(listings(spark, sf), "location", "miles")
    return rows.select("listing_id", r("miles").alias("miles"))


_SCORED = f""", p AS (SELECT *, coalesce(price / NULLIF(sqft, 0), (SELECT median(price / NULLIF(sqft, 0)) FROM listings)) AS pps, {' + '.join(FLAG_SQL.values())} AS am FROM listings),
 m AS (SELECT median(sqft) AS ms, median(pps) AS mp FROM p),
 s AS (SELECT p.*, round_even((sqft / ms + pps / mp + am / 7.0::DOUBLE) / 3 * 10, 2) AS luxury_score FROM p, m)"""


def _scored(spark, sf):
    rows = ft.with_ratios(listings(spark, sf), {"price_per_sqft": ("price", "sqft")})
    return ft.luxury_score(ft.with_amenities(rows))


@query("m07_luxury_score", over("listings", _SCORED + " SELECT listing_id, luxury_score FROM s"))
def m07(spark, sf):
    return _scored(spark, sf).select("listing_id", "luxury_score")


@query("m08_luxury_x_sqft", over("listings", _SCORED + " SELECT listing_id, round(luxury_score * ln(1 + greatest(sqft, 0)), 4) AS luxury_x_sqft FROM s"))
def m08(spark, sf):
    return _scored(spark, sf).select("listing_id", r(ft.luxury_x_sqft(), 4).alias("luxury_x_sqft"))


@query(
    "m09_luxury_segment",
    over("listings", _SCORED + " SELECT listing_id, CASE WHEN luxury_score >= (SELECT quantile_cont(luxury_score, 0.8) FROM s) THEN 1 ELSE 0 END AS is_luxury_segment FROM s"),
)
def m09(spark, sf):
    return ft.luxury_segment(_scored(spark, sf)).select("listing_id", "is_luxury_segment")


@query(
    "m10_type_rarity",
    over(
        "listings",
        """, c AS (SELECT property_type, count(*) AS n FROM listings GROUP BY property_type)
        SELECT l.listing_id, round(1 - c.n / (SELECT count(*) FROM listings), 6) AS rarity FROM listings l JOIN c ON l.property_type IS NOT DISTINCT FROM c.property_type""",
    ),
)
def m10(spark, sf):
    return ft.type_rarity(listings(spark, sf), out="rarity").select("listing_id", r("rarity").alias("rarity"))


@query(
    "m11_area_and_rate",
    over(
        "units",
        """SELECT listing_id, round_even(price * 1e7 / NULLIF(price_per_sqft, 0), 0) AS derived_area,
        round_even(price * 1e7 / NULLIF(area, 0), 0) AS derived_rate FROM units""",
    ),
)
def m11(spark, sf):
    return units(spark, sf).select(
        "listing_id",
        ft.area_from_rate("price", "price_per_sqft").alias("derived_area"),
        ft.rate_from_area("price", "area").alias("derived_rate"),
    )


@query("m12_log_target", over("listings", "SELECT listing_id, round(ln(1 + price), 9) AS log_price, round(exp(ln(1 + price)) - 1, 3) AS price FROM listings"))
def m12(spark, sf):
    logged = ft.log_target("price")
    return listings(spark, sf).select("listing_id", r(logged, 9).alias("log_price"), r(ft.from_log_target(logged), 3).alias("price"))


@query("m13_clip", over("listings", "SELECT listing_id, CASE WHEN price IS NOT NULL THEN least(greatest(price, 25000), 400000) END AS price FROM listings"))
def m13(spark, sf):
    return listings(spark, sf).select("listing_id", ft.clip("price", 25_000.0, 400_000.0).alias("price"))


@query("m14_fix_small_area", over("units", "SELECT listing_id, CASE WHEN area < 1000 THEN area * 9 ELSE area END AS area FROM units"))
def m14(spark, sf):
    return units(spark, sf).select("listing_id", ft.fix_small_area("area").alias("area"))


