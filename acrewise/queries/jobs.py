"""C rows and the file-based S rows: whole jobs over the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from acrewise.functions.features import AMENITY_PATTERNS
from acrewise.functions.unit_values import AMENITY_WEIGHTS, SECTOR_ALIASES, SECTOR_ALIASES_AFTER
from acrewise.operators import profile as pf
from acrewise.operators.feature_state import FeatureState, FeatureStateModel
from acrewise.plans import listings as lp
from acrewise.plans import units as up
from acrewise.queries.registry import flats, listings, over, query, r, rounded, view
from acrewise.queries.scalars import (
    _AGE,
    _BUILT,
    _CARPET,
    _ITEMS,
    _NUM,
    _SUPER,
    _WEIGHTS_SQL,
    FLAG_SQL,
    RESOLVED_TYPE,
    _area,
    _nested_replace,
    haversine_sql,
)
from acrewise.queries.tables import _BUILT as IMPUTED_BUILT
from acrewise.queries.tables import dedupe_sql, iqr_chain_sql, mode_pass_sql
from acrewise.scale import discard, shared_folder, stage
from acrewise.sources.folder import ingest_folder, is_skipped, sniff_exports
from acrewise.sources.sinks import write_report, write_table
from acrewise.streaming.ingest import current_listings, ingest_stream

# files ---------------------------------------------------------------------------------------------------

_WIDE = """SELECT 'line one,\n"line two"\n' || CAST(listing_id AS STRING) AS note, CAST(price AS STRING) AS price, 'https://ex.com/w/' || CAST(listing_id AS STRING) AS detailUrl, CAST(bedrooms AS STRING) AS beds, CAST(bathrooms AS STRING) AS baths,
 CAST(sqft AS STRING) AS area, location AS addressCity, state AS addressState, zipcode AS addressZipcode, address FROM listings WHERE price IS NOT NULL"""
_BLOB = """SELECT '{"price": {"value": ' || CAST(price AS STRING) || '}, "bedrooms": None, "livingArea": ' || coalesce(CAST(sqft AS STRING), 'None') || ', "address": {"city": "' || location || '"}, "hdpView": {"hdpUrl": "/b/'
 || CAST(listing_id AS STRING) || '"}}' AS property, 'x' AS note FROM listings WHERE price IS NOT NULL"""
_EXPORT = """SELECT CAST(price AS STRING) AS `Pricing`, CAST(sqft AS STRING) || ' sq ft' AS `Living Area`, location AS `City`, 'TX' AS `State`, 'https://ex.com/e/' || CAST(listing_id AS STRING) AS `Listing URL`,
 address AS `Street Address` FROM listings WHERE price IS NOT NULL"""
_RAW = """, a AS (SELECT price, sqft, location, 'https://ex.com/w/' || CAST(listing_id AS STRING) AS listing_url FROM listings WHERE price >= 10000
 UNION ALL SELECT price, sqft, location, 'https://www.zillow.com/b/' || CAST(listing_id AS STRING) FROM listings WHERE price >= 1000
 UNION ALL SELECT price, sqft, location, 'https://ex.com/e/' || CAST(listing_id AS STRING) FROM listings WHERE price >= 10000)"""


def _export_folder(spark, sf) -> str:
    """The listings written as three export layouts into one shared folder."""
    listings(spark, sf).createOrReplaceTempView("listings")
    path = shared_folder(spark, "exports")
    for sql in (_WIDE, _BLOB, _EXPORT):
        spark.sql(sql).write.mode("append").option("header", True).option("escape", '"').csv(path)
    return path


@query("s02_ingest_folder", over("listings", _RAW + " SELECT price, sqft, location, listing_url, 'real_raw' AS data_tier FROM a"))
def s02(spark, sf):
    return ingest_folder(spark, _export_folder(spark, sf)).select("price", "sqft", "location", "listing_url", "data_tier")


@query("s02_ingest_stream", over("listings", _RAW + " SELECT price, sqft, location, listing_url, 'real_raw' AS data_tier FROM a"))
def s02_stream(spark, sf):
    # every file is a micro-batch of its own or shares one with others, as the stream finds them
    folder = _export_folder(spark, sf)
    table = shared_folder(spark, "ingested")
    ingest_stream(spark, folder, f"{table}/rows", f"{table}/stream", max_files=2).awaitTermination()
    return current_listings(spark, f"{table}/rows").select("price", "sqft", "location", "listing_url", "data_tier")


_NAMES = "SELECT DISTINCT unnest([source_file, replace(source_file, '.csv', ' (1).csv'), 'metro_' || source_file]) AS item FROM listings"


@query(
    "s03_skip_and_sniff",
    over("listings", f"""SELECT item, starts_with(item, 'metro_') OR contains(item, ' (1)') AS skipped, '' AS families FROM ({_NAMES})
     UNION ALL SELECT 'header', false, families FROM (VALUES ('wide'), ('blob'), ('export')) f(families) WHERE EXISTS (SELECT 1 FROM listings WHERE price IS NOT NULL)"""),
)
def s03(spark, sf):
    # names derived from the listings' source files, and the headers of the files that were really written
    file = F.col("source_file")
    names = listings(spark, sf).select(F.explode(F.array(file, F.replace(file, F.lit(".csv"), F.lit(" (1).csv")), F.concat(F.lit("metro_"), file))).alias("item"))

    def decide(batches):
        for b in batches:
            yield b.assign(skipped=b["item"].map(is_skipped), families="")

    decided = names.distinct().mapInPandas(decide, "item string, skipped boolean, families string")
    sniffed = sniff_exports(spark, _export_folder(spark, sf)).select(F.lit("header").alias("item"), "skipped", "families").distinct()
    return decided.unionByName(sniffed)


@query("c01_collect", over("listings", _RAW + " SELECT price, sqft, location, listing_url, 'real_raw' AS data_tier, false AS is_synthetic_augment FROM a"))
def c01(spark, sf):
    rows = lp.collect(spark, _export_folder(spark, sf))
    return rows.select("price", "sqft", "location", "listing_url", "data_tier", "is_synthetic_augment")


@query("c01_collect_augmented")
def c01_augmented(spark, sf):
    folder = _export_folder(spark, sf)
    rows = lp.collect(spark, folder, target_rows=4 * listings(spark, sf).count())
    # what was collected is stored; the exports made for it are not read again
    discard(spark.read.text(folder))
    return rows


@query("s15_table_roundtrip", over("listings", "SELECT listing_id, price, location FROM listings"))
def s15(spark, sf):
    path = shared_folder(spark, "table")
    rows = listings(spark, sf).select("listing_id", "price", "location")
    write_table(rows, f"{path}/csv", "csv")
    return spark.read.schema(rows.schema).option("header", True).csv(f"{path}/csv")


@query("s16_report_roundtrip", over("listings", "SELECT 'price' AS \"column\", round(avg(CASE WHEN price IS NULL THEN 1.0::DOUBLE ELSE 0 END), 9) AS missing_rate, count(DISTINCT price) AS n_unique FROM listings"))
def s16(spark, sf):
    path = shared_folder(spark, "report")
    write_report(pf.profile_columns(listings(spark, sf).select("price")), path)
    found = spark.read.schema("column string, missing_rate double, n_unique bigint").json(path)
    return rounded(found, {"missing_rate": 9})


# listings ------------------------------------------------------------------------------------------------

CLEAN = f""", d AS (SELECT * REPLACE (trim(coalesce(location, 'unknown')) AS location, coalesce(description, '') AS description, upper(coalesce(state, 'TX')) AS state) FROM listings
  WHERE price IS NOT NULL AND sqft IS NOT NULL AND bedrooms IS NOT NULL),
 t AS (SELECT * REPLACE ({RESOLVED_TYPE} AS property_type) FROM d),
 md AS (SELECT median(bathrooms) AS b, median(latitude) AS la, median(longitude) AS lo, median(lot_size) AS ls, median(year_built) AS y FROM t),
 k AS (SELECT * FROM (SELECT t.* REPLACE (coalesce(bathrooms, b) AS bathrooms, coalesce(latitude, la) AS latitude, coalesce(longitude, lo) AS longitude, coalesce(lot_size, ls) AS lot_size, coalesce(year_built, y) AS year_built) FROM t, md)
  WHERE price > 30000 AND price < 20000000),
 {iqr_chain_sql('k', ['price', 'sqft', 'bedrooms', 'bathrooms'])},
 g AS (SELECT * FROM i3 WHERE state IN ('TX', 'TEXAS') OR contains(lower(location), 'houston')),
 clean AS ({dedupe_sql('g', ['address', 'price', 'sqft'])})"""


@query(
    "c02_preprocess",
    over("listings", CLEAN + """ SELECT listing_id, price, bedrooms, bathrooms, sqft, lot_size, property_type, year_built, location, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude, description, state,
    zipcode, address, listing_url, source_file, data_tier, false AS is_synthetic_augment FROM clean"""),
)
def c02(spark, sf):
    return rounded(lp.preprocess(listings(spark, sf)), {"latitude": 6, "longitude": 6})


_DIST = haversine_sql("f.latitude", "f.longitude", "29.7604", "-95.3698")
_LOCAL = haversine_sql("f.latitude", "f.longitude", "c.clat", "c.clon")
FEATURES = (
    CLEAN
    + f""", q AS (SELECT *, price / NULLIF(sqft, 0) AS r0, bedrooms / NULLIF(bathrooms, 0) AS r1, sqft / NULLIF(bedrooms, 0) AS r2, bathrooms / NULLIF(bedrooms, 0) AS r3, {', '.join(f'{e} AS {n}' for n, e in FLAG_SQL.items())},
  {' + '.join(FLAG_SQL.values())} AS amenity_count FROM clean),
 qm AS (SELECT median(r0) AS m0, median(r1) AS m1, median(r2) AS m2, median(r3) AS m3, median(sqft) AS ms FROM q),
 f AS (SELECT q.*, coalesce(r0, m0) AS price_per_sqft, coalesce(r1, m1) AS bed_bath_ratio, coalesce(r2, m2) AS sqft_per_bedroom, coalesce(r3, m3) AS bath_per_bedroom,
  round_even((sqft / ms + coalesce(r0, m0) / m0 + amenity_count / 7.0::DOUBLE) / 3 * 10, 2) AS luxury_score FROM q, qm),
 c AS (SELECT location, median(price) AS enc, median(latitude) AS clat, median(longitude) AS clon FROM q GROUP BY location),
 pt AS (SELECT property_type, count(*) AS n FROM q GROUP BY property_type)
 SELECT f.listing_id, round(price_per_sqft, 6) AS price_per_sqft, greatest(2026 - year_built, 0) AS property_age, round(bed_bath_ratio, 6) AS bed_bath_ratio, round(sqft_per_bedroom, 6) AS sqft_per_bedroom,
  round(bath_per_bedroom, 6) AS bath_per_bedroom, round(c.enc, 4) AS location_target_enc, round({_DIST}, 6) AS dist_to_houston_mi, round({_LOCAL}, 6) AS dist_to_location_center_mi,
  {', '.join(AMENITY_PATTERNS)}, amenity_count, luxury_score, round(luxury_score * ln(1 + sqft), 4) AS luxury_x_sqft,
  CASE WHEN luxury_score >= (SELECT quantile_cont(luxury_score, 0.8) FROM f) THEN 1 ELSE 0 END AS is_luxury_segment, round(1 - pt.n / (SELECT count(*) FROM q), 6) AS property_type_rarity
 FROM f JOIN c ON f.location = c.location JOIN pt ON f.property_type = pt.property_type"""
)


def _features(spark, sf, clusters):
    return lp.engineer_features(lp.preprocess(listings(spark, sf)), 2026, clusters=clusters)


_DIGITS = {
    "price_per_sqft": 6, "bed_bath_ratio": 6, "sqft_per_bedroom": 6, "bath_per_bedroom": 6, "location_target_enc": 4, "dist_to_houston_mi": 6,
    "dist_to_location_center_mi": 6, "luxury_x_sqft": 4, "property_type_rarity": 6,
}


@query("c03_engineer_features", over("listings", FEATURES))
def c03(spark, sf):
    rows = _features(spark, sf, clusters=False)
    return rounded(rows.select("listing_id", *[c for c in lp.FEATURE_COLUMNS if c != "location_cluster"]), _DIGITS)


# features of rows that were not learned from: every raw listing with its price hidden, by the state of the clean listings
_NEW = (
    FEATURES[: FEATURES.rindex(" SELECT f.listing_id")]
    + f""", learned AS (SELECT median(price) AS mp, median(latitude) AS mlat, median(longitude) AS mlon, (SELECT quantile_cont(luxury_score, 0.8) FROM f) AS luxury_floor, count(*) AS total FROM q),
 fresh AS (SELECT l.listing_id, l.location, l.property_type, l.year_built, l.sqft, coalesce(l.latitude, mlat) AS latitude, coalesce(l.longitude, mlon) AS longitude, m0 AS price_per_sqft,
  coalesce(bedrooms / NULLIF(bathrooms, 0), m1) AS bed_bath_ratio, coalesce(sqft / NULLIF(bedrooms, 0), m2) AS sqft_per_bedroom, coalesce(bathrooms / NULLIF(bedrooms, 0), m3) AS bath_per_bedroom,
  {', '.join(f'{e} AS {n}' for n, e in FLAG_SQL.items())}, {' + '.join(FLAG_SQL.values())} AS amenity_count, ms, mp, luxury_floor, total FROM listings l, qm, learned),
 scored AS (SELECT *, round_even((sqft / ms + 1.0::DOUBLE + amenity_count / 7.0::DOUBLE) / 3 * 10, 2) AS luxury_score FROM fresh)
 SELECT f.listing_id, round(price_per_sqft, 6) AS price_per_sqft, CASE WHEN year_built IS NOT NULL THEN greatest(2026 - year_built, 0) END AS property_age, round(bed_bath_ratio, 6) AS bed_bath_ratio, round(sqft_per_bedroom, 6) AS sqft_per_bedroom,
  round(bath_per_bedroom, 6) AS bath_per_bedroom, round(coalesce(c.enc, mp), 4) AS location_target_enc, round({_DIST}, 6) AS dist_to_houston_mi, round({_LOCAL}, 6) AS dist_to_location_center_mi,
  {', '.join(AMENITY_PATTERNS)}, amenity_count, luxury_score, round(luxury_score * ln(1 + sqft), 4) AS luxury_x_sqft,
  CASE WHEN luxury_score >= luxury_floor THEN 1 ELSE 0 END AS is_luxury_segment, round(1 - coalesce(pt.n / total, 0), 6) AS property_type_rarity
 FROM scored f LEFT JOIN c ON f.location = c.location LEFT JOIN pt ON f.property_type = pt.property_type"""
)


@query("t10_new_row_features", over("listings", _NEW))
def t10_new_rows(spark, sf):
    clean = stage(lp.preprocess(listings(spark, sf)), "clean")
    path = shared_folder(spark, "features")
    FeatureState(2026, clusters=0).fit(clean).save(path)
    rows = FeatureStateModel.load(path).transform(listings(spark, sf).drop("price"))
    return rounded(rows.select("listing_id", *[c for c in lp.FEATURE_COLUMNS if c != "location_cluster"]), _DIGITS)


@query("c03_feature_table")
def c03_full(spark, sf):
    return _features(spark, sf, clusters=True)


# units ---------------------------------------------------------------------------------------------------

_SOCIETY = r"lower(trim(regexp_replace(society, '\d+(\.\d+)?\s?★', '', 'g')))"
_SHARED = r"""round_even(CASE WHEN contains(lower(price), 'crore') THEN pn WHEN contains(lower(price), 'lac') OR contains(lower(price), 'lakh') THEN pn / 100 ELSE TRY_CAST(price AS DOUBLE) END, 2) AS price,
 TRY_CAST(trim(replace(replace(split_part(rate, '/', 1), '₹', ''), ',', '')) AS DOUBLE) AS price_per_sqft, TRY_CAST(split_part(bedRoom, ' ', 1) AS INTEGER) AS bedRoom, TRY_CAST(split_part(bathroom, ' ', 1) AS INTEGER) AS bathroom,
 replace(split_part(balcony, ' ', 1), 'No', '0') AS balcony, lower(coalesce(additionalRoom, 'not available')) AS rooms, areaWithType, agePossession, features, property_id, property_name"""
_PN = r"TRY_CAST(NULLIF(regexp_extract(price, '(\d+\.?\d*)', 1), '') AS DOUBLE) AS pn"
_FLOOR = r"TRY_CAST(NULLIF(regexp_extract(replace(replace(CASE WHEN split_part(floorNum, ' ', 1) = 'Ground' THEN '0' ELSE split_part(floorNum, ' ', 1) END, 'Basement', '-1'), 'Lower', '0'), '(\d+)', 1), '') AS INTEGER)"
MERGED = f""", fl AS (SELECT 'flat' AS property_type, {_SOCIETY} AS society, {_FLOOR} AS floorNum, {_SHARED} FROM (SELECT *, {_PN} FROM flats) WHERE bedRoom IS NOT NULL),
 ho AS (SELECT 'house' AS property_type, coalesce({_SOCIETY}, 'independent') AS society, TRY_CAST(split_part(noOfFloor, ' ', 1) AS INTEGER) AS floorNum, {_SHARED} FROM (SELECT DISTINCT *, {_PN} FROM houses)
  WHERE bedRoom IS NOT NULL AND price IS DISTINCT FROM 'Price on Request'),
 al AS (SELECT *, round_even(price * 1e7 / NULLIF(price_per_sqft, 0), 0) AS area, {_nested_replace("lower(trim(replace(string_split(property_name, 'in')[2], 'Gurgaon', '')))", SECTOR_ALIASES)} AS sec FROM (SELECT * FROM fl UNION ALL SELECT * FROM ho)),
 mg AS (SELECT *, {_nested_replace('sec', SECTOR_ALIASES_AFTER)} AS sector FROM al WHERE sec IN (SELECT sec FROM al GROUP BY sec HAVING count(*) >= 3))"""


@query("c04_merged_units", over("flats houses", MERGED + " SELECT property_id, property_type, society, sector, price, price_per_sqft, area, bedRoom, bathroom, balcony, floorNum FROM mg"))
def c04_merged(spark, sf):
    rows = up.concat_tables(up.clean_flats(flats(spark, sf)), up.clean_houses(view(spark, sf, "houses")))
    cols = ["property_id", "property_type", "society", "sector", "price", "price_per_sqft", "area", "bedRoom", "bathroom", "balcony", "floorNum"]
    return up.with_sectors(rows).select(*cols)


_AREAS = f"""ar AS (SELECT *, CASE WHEN s0 IS NULL AND b0 IS NULL AND c0 IS NULL THEN {_area("Plot area " + _NUM)} ELSE b0 END AS built0 FROM (SELECT *, {_SUPER} AS s0, {_BUILT} AS b0, {_CARPET} AS c0 FROM mg))"""
UNITS = (
    MERGED
    + f""", {_AREAS}, w(term, weight) AS (VALUES {_WEIGHTS_SQL}),
 fa AS (SELECT lower(PropertyName) AS name, TopFacilities AS v, row_number() OVER (PARTITION BY lower(PropertyName) ORDER BY facility_id) AS rn FROM facilities),
 ff AS (SELECT ar.* REPLACE (coalesce(ar.features, fa.v) AS features) FROM ar LEFT JOIN fa ON lower(ar.society) = fa.name AND fa.rn = 1),
 lx AS (SELECT property_id, CAST(sum(coalesce(w.weight, 0)) AS INTEGER) AS score FROM (SELECT property_id, unnest(list_distinct({_ITEMS})) AS term FROM ff) i LEFT JOIN w ON i.term = w.term GROUP BY property_id),
 un AS (SELECT ff.*, {_AGE} AS age, coalesce(lx.score, 0) AS luxury_score FROM ff LEFT JOIN lx ON ff.property_id = lx.property_id),
 q AS (SELECT quantile_cont(price_per_sqft, 0.25) AS q1, quantile_cont(price_per_sqft, 0.75) AS q3 FROM un),
 h AS (SELECT un.*, coalesce(price_per_sqft < q1 - 1.5 * (q3 - q1) OR price_per_sqft > q3 + 1.5 * (q3 - q1), false) AS hit, CASE WHEN area < 1000 THEN area * 9 ELSE area END AS na FROM un, q),
 rp AS (SELECT * REPLACE (CASE WHEN hit THEN coalesce(na, area) ELSE area END AS area, CASE WHEN hit THEN coalesce(round_even(price * 1e7 / NULLIF(na, 0), 0), price_per_sqft) ELSE price_per_sqft END AS price_per_sqft) FROM h),
 cp AS (SELECT * FROM rp WHERE price_per_sqft <= 50000 AND area < 100000 AND area <= 10000 AND bedRoom <= 10),
 bu AS (SELECT *, coalesce(built0, {IMPUTED_BUILT.format(s='1.105::DOUBLE', c='0.9::DOUBLE').replace('super_built_up_area', 's0').replace('carpet_area', 'c0')}) AS built1 FROM cp),
 u0 AS (SELECT property_id, property_type, society, sector, price, round_even(price * 1e7 / NULLIF(area, 0), 0) AS price_per_sqft, CASE WHEN built1 < 2000 AND price > 2.5 THEN coalesce(area, built1) ELSE built1 END AS built_up_area,
  bedRoom, coalesce(CAST(floorNum AS DOUBLE), 2.0) AS floorNum, age AS agePossession, luxury_score FROM bu),
 {mode_pass_sql('u0', ['sector', 'property_type'], 'u1')}, {mode_pass_sql('u1', ['sector'], 'u2')}, {mode_pass_sql('u2', ['property_type'], 'u3')}
 SELECT property_id, property_type, society, sector, price, price_per_sqft, round(built_up_area, 4) AS built_up_area, bedRoom, floorNum, agePossession, luxury_score FROM u3"""
)


@query("c04_clean_units", over("flats houses facilities", UNITS))
def c04(spark, sf):
    rows = up.clean_units(flats(spark, sf), view(spark, sf, "houses"), view(spark, sf, "facilities"), furnishing=False)
    cols = ["property_id", "property_type", "society", "sector", "price", "price_per_sqft", "bedRoom", "floorNum", "agePossession", "luxury_score"]
    return rows.select(*cols, r("built_up_area", 4).alias("built_up_area"))


@query("c04_clean_units_furnished")
def c04_furnished(spark, sf):
    return up.clean_units(flats(spark, sf), view(spark, sf, "houses"), view(spark, sf, "facilities"))
