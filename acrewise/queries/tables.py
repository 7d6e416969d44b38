"""S, P, F, I, J, W, O and U rows: sources, projections, filters, imputation, joins, dedupe, ordering."""

from __future__ import annotations

from pyspark.sql import functions as F

from acrewise import schema as sc
from acrewise.functions import text as tx
from acrewise.operators import dedupe as dd
from acrewise.operators import filters as fl
from acrewise.operators import impute as im
from acrewise.operators import joins as jn
from acrewise.operators import outliers as ol
from acrewise.operators import sampling as sm
from acrewise.queries.registry import flats, listings, over, query, r, table, units, view
from acrewise.queries.scalars import _normal_sql as normal_type_sql
from acrewise.queries.scalars import haversine_sql
from acrewise.sources import adapters as ad
from acrewise.sources import augment as ag
from acrewise.sources import pages as pg
from acrewise.sources import regional as rg

# sources -------------------------------------------------------------------------------------------------


@query(
    "s01_read_table",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders",
)
def s01(spark, sf):
    names = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    return table(spark, sf, "orders").select(*names)


_WIDE = """SELECT listing_id, CASE listing_id % 3 WHEN 0 THEN '$' || CAST(9000 + listing_id * 7 AS STRING) WHEN 1 THEN CAST(floor(price) AS STRING) ELSE 'n/a' END AS price,
 'https://ex.com/w/' || CAST(listing_id AS STRING) AS `detailUrl`, CAST(bedrooms AS STRING) AS `hdpData/homeInfo/bedrooms`, '9' AS beds, CAST(bathrooms AS STRING) AS baths,
 CASE WHEN listing_id % 4 = 0 THEN '--' ELSE CAST(sqft AS STRING) END AS area, location AS `addressCity`, state AS `addressState`, zipcode AS `addressZipcode`, address,
 property_type AS `hdpData/homeInfo/homeType`, CAST(latitude AS STRING) AS `latLong/latitude` FROM listings"""


@query(
    "s04_from_wide",
    over(
        "listings",
        f""", w AS ({_WIDE.replace('`', '"')}), t AS (SELECT *, TRY_CAST(NULLIF(regexp_replace(price, '[^0-9.]', '', 'g'), '') AS DOUBLE) AS p FROM w)
        SELECT listing_id, p AS price, TRY_CAST("hdpData/homeInfo/bedrooms" AS DOUBLE) AS bedrooms, TRY_CAST(baths AS DOUBLE) AS bathrooms, TRY_CAST(area AS DOUBLE) AS sqft,
        {normal_type_sql('"hdpData/homeInfo/homeType"')} AS property_type, "addressCity" AS location, upper("addressState") AS state, "addressZipcode" AS zipcode, address,
        "detailUrl" AS listing_url, round(TRY_CAST("latLong/latitude" AS DOUBLE), 6) AS latitude FROM t WHERE p >= 10000""",
    ),
)
def s04(spark, sf):
    listings(spark, sf).createOrReplaceTempView("listings")
    out = ad.from_wide(spark.sql(_WIDE), keep=("listing_id",))
    cols = ["price", "bedrooms", "bathrooms", "sqft", "property_type", "location", "state", "zipcode", "address", "listing_url"]
    return out.select("listing_id", *cols, r("latitude").alias("latitude"))


_SEMI = """SELECT listing_id, CASE WHEN listing_id % 4 = 0 THEN 'ask' ELSE CAST(listing_id AS STRING) || ' USD' END AS price, location AS city,
 CAST(bedrooms AS STRING) AS beds, CAST(sqft AS STRING) AS area, property_type AS homeType, description, state, address AS street FROM listings"""


@query(
    "s05_from_semicolon",
    over(
        "listings",
        f""", w AS ({_SEMI}), t AS (SELECT *, TRY_CAST(NULLIF(regexp_replace(price, '[^0-9.]', '', 'g'), '') AS DOUBLE) AS p FROM w)
        SELECT listing_id, p AS price, city AS location, TRY_CAST(beds AS DOUBLE) AS bedrooms, TRY_CAST(area AS DOUBLE) AS sqft, {normal_type_sql('homeType')} AS property_type,
        coalesce(description, '') AS description, upper(state) AS state, street AS address FROM t WHERE p IS NOT NULL""",
    ),
)
def s05(spark, sf):
    listings(spark, sf).createOrReplaceTempView("listings")
    out = ad.from_semicolon(spark.sql(_SEMI), keep=("listing_id",))
    return out.select("listing_id", "price", "location", "bedrooms", "sqft", "property_type", "description", "state", "address")


_EXPORT = """SELECT listing_id, '$' || CAST(5000 + listing_id * 3 AS STRING) AS `Pricing`, CAST(sqft AS STRING) || ' sq ft' AS `Living Area`, CAST(bedrooms AS STRING) AS `Number of Bedrooms`,
 CAST(bathrooms AS STRING) AS `Number of Bathrooms`, location AS `City`, state AS `State`, zipcode AS `Zipcode`, address AS `Street Address`, CAST(year_built AS STRING) AS `Built Year`,
 description AS `Description`, listing_url AS `Listing URL`, property_type AS `Home Type` FROM listings"""
_EXPORT_ORACLE = f""", w AS ({_EXPORT.replace('`', '"')}), t AS (SELECT *, TRY_CAST(regexp_replace("Pricing", '[^0-9.]', '', 'g') AS DOUBLE) AS p FROM w)
 SELECT listing_id, p AS price, TRY_CAST(NULLIF(regexp_extract("Living Area", '([0-9.]+)', 1), '') AS DOUBLE) AS sqft, TRY_CAST("Number of Bedrooms" AS DOUBLE) AS bedrooms,
 TRY_CAST("Built Year" AS DOUBLE) AS year_built, "City" AS location, upper("State") AS state, "Street Address" AS address, "Listing URL" AS listing_url, {normal_type_sql('"Home Type"')} AS property_type
 FROM t WHERE p >= 10000 AND (coalesce(contains(upper("State"), 'TX'), false) OR coalesce(contains(lower("City"), 'houston'), false))"""


@query("s06_from_listing_export", over("listings", _EXPORT_ORACLE))
def s06(spark, sf):
    listings(spark, sf).createOrReplaceTempView("listings")
    out = ad.from_listing_export(spark.sql(_EXPORT), jitter_geo=False, keep=("listing_id",))
    cols = ["price", "sqft", "bedrooms", "year_built", "location", "state", "address", "listing_url", "property_type"]
    return out.select("listing_id", *cols)


@query("s07_jitter_missing_geo")
def s07(spark, sf):
    rows = ad.jitter_missing_geo(listings(spark, sf), F.col("listing_id"))
    return rows.select("listing_id", "latitude", "longitude")


_BLOB_JSON = """SELECT listing_id, to_json(named_struct('price', named_struct('value', price), 'bedrooms', bedrooms, 'livingArea', sqft, 'propertyType', property_type,
 'yearBuilt', year_built, 'address', named_struct('streetAddress', address, 'city', CASE WHEN listing_id % 5 = 0 THEN NULL ELSE location END, 'state', state, 'zipcode', zipcode),
 'location', named_struct('latitude', latitude), 'hdpView', named_struct('hdpUrl', CASE WHEN listing_id % 2 = 0 THEN '/home/' || CAST(listing_id AS STRING) ELSE listing_url END))) AS property FROM listings"""


@query(
    "s08_from_blob",
    over(
        "listings",
        f"""SELECT listing_id, price, bedrooms, sqft, {normal_type_sql("coalesce(property_type, 'unknown')")} AS property_type, year_built,
        CASE WHEN listing_id % 5 = 0 THEN 'Houston' ELSE location END AS location, upper(coalesce(state, 'TX')) AS state,
        trim(address || ', ' || (CASE WHEN listing_id % 5 = 0 THEN 'Houston' ELSE location END) || ', TX ' || zipcode) AS address,
        CASE WHEN listing_id % 2 = 0 THEN 'https://www.zillow.com/home/' || CAST(listing_id AS STRING) ELSE listing_url END AS listing_url
        FROM listings WHERE price >= 1000""",
    ),
)
def s08(spark, sf):
    listings(spark, sf).createOrReplaceTempView("listings")
    out = ad.from_blob(spark.sql(_BLOB_JSON), literal="json", keep=("listing_id",))
    cols = ["price", "bedrooms", "sqft", "property_type", "year_built", "location", "state", "address", "listing_url"]
    return out.select("listing_id", *cols)


_SCRIPTS = r"""unnest(regexp_extract_all(html, '(?is)<script[^>]*type="application/ld\+json"[^>]*>(.*?)</script>', 1))"""


def _j(path: str, doc: str = "j") -> str:
    return f"json_extract_string({doc}, '$.{path}')"


def _digits(expr: str) -> str:
    return f"TRY_CAST(NULLIF(regexp_replace({expr}, '[^0-9.]', '', 'g'), '') AS DOUBLE)"


_ITEMS = f""", b AS (SELECT page_id, {_SCRIPTS} AS txt FROM ld_pages), v AS (SELECT page_id, txt FROM b WHERE json_valid(txt)),
 i AS (SELECT page_id, CAST(txt AS JSON) AS j, false AS is_list FROM v WHERE json_type(txt) = 'OBJECT'
       UNION ALL SELECT page_id, unnest(CAST(json_extract(txt, '$[*]') AS JSON[])), true FROM v WHERE json_type(txt) = 'ARRAY')"""


@query(
    "s09_extract_jsonld",
    over(
        "ld_pages",
        _ITEMS
        + f""" SELECT page_id, {_digits(f"coalesce({_j('offers.price')}, {_j('price')})")} AS price, {_digits(f"coalesce({_j('numberOfRooms')}, {_j('numberOfBedrooms')})")} AS bedrooms,
        {_digits(_j('floorSize.value'))} AS built_up_area, {_j('"@type"')} AS property_type, {_j('address.streetAddress')} AS address,
        coalesce({_j('address.addressLocality')}, 'Houston') AS locality, {_digits(_j('geo.latitude'))} AS latitude, {_digits(_j('geo.longitude'))} AS longitude, {_j('url')} AS listing_url
        FROM i WHERE {_j('"@type"')} IN ('SingleFamilyResidence', 'Apartment', 'House', 'Residence')""",
    ),
)
def s09(spark, sf):
    return pg.extract_jsonld(view(spark, sf, "ld_pages")).drop("bathrooms", "source")


@query(
    "s09_extract_item_list",
    over(
        "ld_pages",
        _ITEMS
        + f""", e AS (SELECT page_id, unnest(CAST(json_extract(j, '$.itemListElement[*].item') AS JSON[])) AS k FROM i WHERE NOT is_list AND {_j('"@type"')} = 'ItemList')
        SELECT page_id, {_digits(_j('offers.price', 'k'))} AS price, {_digits(_j('numberOfRooms', 'k'))} AS bedrooms, coalesce({_j('"@type"', 'k')}, 'Apartment') AS property_type,
        coalesce({_j('address.streetAddress', 'k')}, {_j('name', 'k')}) AS address, coalesce({_j('address.addressLocality', 'k')}, 'Houston') AS locality, {_j('url', 'k')} AS listing_url FROM e""",
    ),
)
def s09_list(spark, sf):
    out = pg.extract_jsonld(view(spark, sf, "ld_pages"), item_list=True)
    return out.select("page_id", "price", "bedrooms", "property_type", "address", "locality", "listing_url")


@query(
    "s10_extract_blocks",
    over(
        "ld_pages",
        """, b AS (SELECT page_id, unnest(regexp_extract_all(html, '(?s)<div class="quote">(.*?)</div>', 1)) AS t FROM ld_pages)
        SELECT page_id, regexp_extract(t, '<small class="author">(.*?)</small>', 1) AS "Author", regexp_extract(t, '<span class="text">(.*?)</span>', 1) AS "Quote" FROM b""",
    ),
)
def s10(spark, sf):
    return pg.extract_blocks(view(spark, sf, "ld_pages")).drop("pos")


_NATIONAL = """SELECT price, bedrooms AS bed, bathrooms AS bath, sqft AS house_size, lot_size AS acre_lot, location AS city,
 CASE WHEN listing_id % 7 = 0 THEN 'Texas' ELSE state END AS state, zipcode AS zip_code FROM listings"""


@query(
    "s11_subset_region",
    over(
        "listings",
        f""", n AS ({_NATIONAL}) SELECT price, bed AS bedrooms, bath AS bathrooms, house_size AS sqft, acre_lot AS lot_size, CAST(NULL AS STRING) AS property_type, CAST(NULL AS DOUBLE) AS year_built,
        city AS location, CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude, CAST(NULL AS STRING) AS description, 'TX' AS state, zip_code AS zipcode FROM n
        WHERE (coalesce(upper(state), '') IN ('TX', 'TEXAS') OR contains(coalesce(upper(city), ''), 'TEXAS') OR contains(coalesce(upper(city), ''), 'HOUSTON')) AND price > 20000 AND price < 20000000""",
    ),
)
def s11(spark, sf):
    listings(spark, sf).createOrReplaceTempView("listings")
    return rg.subset_region(spark.sql(_NATIONAL))


_SCRAPED = """SELECT listing_id AS page_id, CAST(price AS STRING) AS price, CAST(bedrooms AS STRING) AS bedrooms, CAST(sqft AS STRING) AS built_up_area, property_type, address,
 CASE listing_id % 4 WHEN 0 THEN NULL WHEN 1 THEN ' Katy ' WHEN 2 THEN location ELSE 'Sugar Land' END AS locality, listing_url, CASE WHEN listing_id % 3 = 0 THEN 'a' ELSE 'b' END AS source FROM listings"""
_CLEANED = f""", s AS ({_SCRAPED}), t AS (SELECT * REPLACE (TRY_CAST(price AS DOUBLE) AS price, TRY_CAST(bedrooms AS DOUBLE) AS bedrooms, TRY_CAST(built_up_area AS DOUBLE) AS built_up_area, trim(coalesce(locality, 'Houston')) AS locality) FROM s),
 u AS (SELECT *, row_number() OVER (PARTITION BY listing_url, address, price ORDER BY page_id) AS rn FROM t
       WHERE regexp_matches(lower(locality), 'houston|katy|sugar land|bellaire|pearland|cypress|spring') AND price > 300 AND price < 25000000)"""


def _cleaned(spark, sf):
    listings(spark, sf).createOrReplaceTempView("listings")
    return rg.clean_scraped(spark.sql(_SCRAPED))


@query("s12_clean_scraped", over("listings", _CLEANED + " SELECT page_id, price, bedrooms, built_up_area, property_type, address, locality, listing_url, source FROM u WHERE rn = 1"))
def s12(spark, sf):
    return _cleaned(spark, sf).drop("latitude", "longitude", "bathrooms")


@query("s13_source_gate", over("listings", _CLEANED + " SELECT source, count(*) AS rows FROM u WHERE rn = 1 GROUP BY source"))
def s13(spark, sf):
    return rg.source_gate(_cleaned(spark, sf), 2, 100)


@query("s14_bootstrap_augment")
def s14(spark, sf):
    rows = sc.ensure_columns(listings(spark, sf))
    return ag.bootstrap_augment(rows, 2 * table(spark, sf, "orders").count() + 17, ["listing_id"])


# projections ---------------------------------------------------------------------------------------------


@query(
    "p01_standardize_columns",
    over("listings", f"SELECT price, bed AS bedrooms, bath AS bathrooms, house_size AS sqft, acre_lot AS lot_size, city AS location, state, zip_code AS zipcode FROM ({_NATIONAL})"),
)
def p01(spark, sf):
    listings(spark, sf).createOrReplaceTempView("listings")
    return sc.standardize_columns(spark.sql(_NATIONAL))


@query(
    "p02_ensure_columns",
    over(
        "listings",
        "SELECT listing_id, price, zipcode, CAST(NULL AS STRING) AS source_file, CAST(NULL AS DOUBLE) AS sqft, CASE WHEN listing_id % 3 = 0 THEN true ELSE false END AS is_synthetic_augment FROM listings",
    ),
)
def p02(spark, sf):
    flag = F.when(F.col("listing_id") % 3 == 0, F.lit(True))
    rows = listings(spark, sf).select("listing_id", "price", "zipcode", flag.alias("is_synthetic_augment"))
    return sc.ensure_columns(rows).select("listing_id", "price", "zipcode", "source_file", "sqft", "is_synthetic_augment")


_MESSY = "CASE listing_id % 5 WHEN 0 THEN 'abc' WHEN 1 THEN CAST(listing_id AS STRING) || '.25' WHEN 2 THEN 'NaN' WHEN 3 THEN NULL ELSE ' 7 ' END"


@query(
    "p03_to_numeric",
    over("listings", f"SELECT listing_id, CASE WHEN NOT isnan(TRY_CAST({_MESSY} AS DOUBLE)) THEN TRY_CAST({_MESSY} AS DOUBLE) END AS value FROM listings"),
)
def p03(spark, sf):
    return listings(spark, sf).select("listing_id", sc.to_numeric(F.expr(_MESSY)).alias("value"))


@query("p04_project", over("listings", "SELECT 'listing' AS kind, listing_id, location, price, sqft FROM listings"))
def p04(spark, sf):
    return listings(spark, sf).withColumn("kind", F.lit("listing")).select("kind", "listing_id", "location", "price", "sqft")


@query(
    "p05_fill_defaults",
    over("listings", "SELECT listing_id, trim(coalesce(location, 'unknown')) AS location, coalesce(description, '') AS description, upper(coalesce(state, 'TX')) AS state FROM listings"),
)
def p05(spark, sf):
    return sc.fill_defaults(listings(spark, sf)).select("listing_id", "location", "description", "state")


@query("p06_column_difference")
def p06(spark, sf):
    rows = listings(spark, sf)
    names = sc.ordered_unique(sc.missing_columns(rows.columns, sc.LISTING_COLUMNS), rows.columns)
    return rows.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.array(*[F.lit(n) for n in names]))


# filters -------------------------------------------------------------------------------------------------


@query("f01_require", over("listings", "SELECT listing_id, price, sqft, bedrooms FROM listings WHERE price IS NOT NULL AND sqft IS NOT NULL AND bedrooms IS NOT NULL"))
def f01(spark, sf):
    return fl.require(listings(spark, sf)).select("listing_id", "price", "sqft", "bedrooms")


@query("f02_in_band", over("listings", "SELECT listing_id, price FROM listings WHERE price > 30000 AND price < 20000000"))
def f02(spark, sf):
    return listings(spark, sf).where(fl.in_band("price", 30_000, 20_000_000)).select("listing_id", "price")


@query(
    "f03_in_region",
    over("listings", "SELECT listing_id, state, location FROM listings WHERE coalesce(state IN ('TX', 'TEXAS'), false) OR coalesce(contains(lower(location), 'houston'), false)"),
)
def f03(spark, sf):
    return listings(spark, sf).where(fl.in_region()).select("listing_id", "state", "location")


@query("f04_sentinel_filter", over("flats", "SELECT property_id, price, bedRoom FROM flats WHERE price IS DISTINCT FROM 'Price on Request' AND bedRoom IS NOT NULL"))
def f04(spark, sf):
    rows = flats(spark, sf).where(fl.differs("price", "Price on Request") & F.col("bedRoom").isNotNull())
    return rows.select("property_id", "price", "bedRoom")


@query("f05_cap_domains", over("units", "SELECT listing_id, price_per_sqft, area, bedRoom FROM units WHERE price_per_sqft <= 50000 AND area < 100000 AND area <= 10000 AND bedRoom <= 10"))
def f05(spark, sf):
    return fl.cap_domains(units(spark, sf)).select("listing_id", "price_per_sqft", "area", "bedRoom")


@query("f05_drop_above", over("units", "SELECT listing_id, carpet_area FROM units WHERE NOT coalesce(carpet_area > 1500, false)"))
def f05_drop(spark, sf):
    return fl.drop_above(units(spark, sf), "carpet_area", 1500).select("listing_id", "carpet_area")


@query(
    "f06_min_frequency",
    over("flats", """, s AS (SELECT property_id, lower(trim(replace(string_split(property_name, 'in')[2], 'Gurgaon', ''))) AS sector FROM flats)
    SELECT property_id, sector FROM s WHERE sector IN (SELECT sector FROM s GROUP BY sector HAVING count(*) >= 3)"""),
)
def f06(spark, sf):
    rows = flats(spark, sf).select("property_id", tx.sector_of("property_name").alias("sector"))
    return fl.min_frequency(rows, "sector", 3)


@query(
    "f07_slice_listings",
    over("listings", "SELECT listing_id, location, bedrooms, price FROM listings WHERE location = 'Houston' AND bedrooms >= 5 AND price >= 50000 AND price <= 400000"),
)
def f07(spark, sf):
    cut = fl.ListingFilter(location="Houston", bedrooms="5+", min_price=50_000, max_price=400_000)
    return fl.slice_listings(listings(spark, sf), cut).select("listing_id", "location", "bedrooms", "price")


@query(
    "f08_top_n_categories",
    over("listings", "SELECT listing_id, location FROM listings WHERE location IN (SELECT location FROM listings GROUP BY location ORDER BY count(*) DESC, location LIMIT 8)"),
)
def f08(spark, sf):
    return fl.top_n_categories(listings(spark, sf), "location", 8).select("listing_id", "location")


def _anomaly_sql() -> str:
    cases = [f"CASE WHEN {v} {op} {limit} THEN '{name},' ELSE '' END" for name, (v, op, limit) in fl.UNIT_ANOMALIES.items()]
    return f"SELECT * FROM (SELECT listing_id, rtrim({' || '.join(cases)}, ',') AS anomalies FROM units) WHERE anomalies <> ''"


@query("f09_anomalies", over("units", _anomaly_sql()))
def f09(spark, sf):
    return fl.anomalies(units(spark, sf)).select("listing_id", F.array_join("anomalies", ",").alias("anomalies"))


# imputation and outliers ---------------------------------------------------------------------------------


@query(
    "i01_fill_medians",
    over(
        "listings",
        """, k AS (SELECT * FROM listings WHERE price IS NOT NULL AND sqft IS NOT NULL AND bedrooms IS NOT NULL),
        m AS (SELECT median(bathrooms) AS b, median(latitude) AS la, median(longitude) AS lo, median(lot_size) AS ls, median(year_built) AS y FROM k)
        SELECT listing_id, coalesce(bathrooms, b) AS bathrooms, round(coalesce(latitude, la), 6) AS latitude, round(coalesce(longitude, lo), 6) AS longitude,
        coalesce(lot_size, ls) AS lot_size, coalesce(year_built, y) AS year_built FROM k, m""",
    ),
)
def i01(spark, sf):
    rows = im.fill_medians(fl.require(listings(spark, sf)))
    return rows.select("listing_id", "bathrooms", r("latitude").alias("latitude"), r("longitude").alias("longitude"), "lot_size", "year_built")


_BUILT = """CASE WHEN super_built_up_area IS NOT NULL AND carpet_area IS NOT NULL THEN round_even((super_built_up_area / {s} + carpet_area / {c}) / 2, 0)
 WHEN super_built_up_area IS NOT NULL THEN round_even(super_built_up_area / {s}, 0) ELSE round_even(carpet_area / {c}, 0) END"""


@query("i02_impute_built_up", over("units", f"SELECT listing_id, coalesce(built_up_area, {_BUILT.format(s='1.105::DOUBLE', c='0.9::DOUBLE')}) AS built_up_area FROM units"))
def i02(spark, sf):
    return im.impute_built_up(units(spark, sf)).select("listing_id", "built_up_area")


@query(
    "i03_learned_ratios",
    over("units", """SELECT round(median(super_built_up_area / built_up_area), 9) AS super_ratio, round(median(carpet_area / built_up_area), 9) AS carpet_ratio FROM units
    WHERE super_built_up_area IS NOT NULL AND built_up_area IS NOT NULL AND carpet_area IS NOT NULL"""),
)
def i03(spark, sf):
    return im.learned_ratios(units(spark, sf)).select(r("super_ratio", 9).alias("super_ratio"), r("carpet_ratio", 9).alias("carpet_ratio"))


@query("i04_overlay", over("units", "SELECT listing_id, CASE WHEN built_up_area < 2000 AND price > 2.5 THEN coalesce(area, built_up_area) ELSE built_up_area END AS built_up_area FROM units"))
def i04(spark, sf):
    return im.fix_small_built_up(units(spark, sf)).select("listing_id", "built_up_area")


def mode_pass_sql(source: str, keys: list[str], name: str) -> str:
    """Two CTEs: the modes per key of ``source``, and ``name`` with sentinels replaced."""
    cols = ", ".join(keys)
    match = " AND ".join(f"t.{k} = m.{k}" for k in keys)
    known = " AND ".join(f"{k} IS NOT NULL" for k in [*keys, "agePossession"])
    return f"""{name}_m AS (SELECT {cols}, agePossession AS v FROM (SELECT {cols}, agePossession, row_number() OVER (PARTITION BY {cols} ORDER BY count(*) DESC, agePossession) AS rn
 FROM {source} WHERE {known} GROUP BY {cols}, agePossession) WHERE rn = 1),
 {name} AS (SELECT t.* REPLACE (CASE WHEN t.agePossession = 'Undefined' THEN m.v ELSE t.agePossession END AS agePossession) FROM {source} t LEFT JOIN {name}_m m ON {match})"""


MODE_PASSES = ", ".join(
    [
        mode_pass_sql("units", ["sector", "property_type"], "u1"),
        mode_pass_sql("u1", ["sector"], "u2"),
        mode_pass_sql("u2", ["property_type"], "u3"),
    ]
)


@query("i05_impute_mode_hierarchy", over("units", f", {MODE_PASSES} SELECT listing_id, sector, property_type, agePossession FROM u3"))
def i05(spark, sf):
    return im.impute_mode_hierarchy(units(spark, sf)).select("listing_id", "sector", "property_type", "agePossession")


def iqr_chain_sql(source: str, cols: list[str]) -> str:
    """CTEs i0..ik filtering ``source`` column by column; the last one is named after the last index."""
    parts, prev = [], source
    for n, c in enumerate(cols):
        parts.append(
            f"""b{n} AS (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM {prev}),
 i{n} AS (SELECT t.* FROM {prev} t, b{n} WHERE q3 - q1 <= 0 OR {c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))"""
        )
        prev = f"i{n}"
    return ", ".join(parts)


@query(
    "i06_iqr_sequential",
    over("listings", f""", k AS (SELECT * FROM listings WHERE price IS NOT NULL AND sqft IS NOT NULL AND bedrooms IS NOT NULL), {iqr_chain_sql('k', ['price', 'sqft', 'bedrooms', 'bathrooms'])}
    SELECT listing_id, price, sqft, bedrooms, bathrooms FROM i3"""),
)
def i06(spark, sf):
    cols = ["price", "sqft", "bedrooms", "bathrooms"]
    return ol.remove_outliers_iqr(fl.require(listings(spark, sf)), cols).select("listing_id", *cols)


def _fence_sql(c: str) -> str:
    return f"(q3_{c} - q1_{c} <= 0 OR coalesce({c}, m_{c}) BETWEEN q1_{c} - 1.5 * (q3_{c} - q1_{c}) AND q3_{c} + 1.5 * (q3_{c} - q1_{c}))"


_MASKED = ["price", "sqft", "bedrooms", "bathrooms"]


@query(
    "i07_iqr_mask",
    over(
        "listings",
        ", m AS (SELECT "
        + ", ".join(f"median({c}) AS m_{c}" for c in _MASKED)
        + " FROM listings), q AS (SELECT "
        + ", ".join(f"quantile_cont(coalesce({c}, m_{c}), {p}) AS q{n}_{c}" for c in _MASKED for n, p in ((1, 0.25), (3, 0.75)))
        + f" FROM listings, m) SELECT listing_id FROM listings, m, q WHERE {' AND '.join(_fence_sql(c) for c in _MASKED)}",
    ),
)
def i07(spark, sf):
    rows = listings(spark, sf)
    return rows.where(ol.iqr_mask(rows, _MASKED)).select("listing_id")


_VALUE_FENCE = """WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events), f AS (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q),
 o AS (SELECT e.*, lo, hi FROM events e, f WHERE value < lo OR value > hi)"""


@query(
    "i08_iqr_report",
    _VALUE_FENCE
    + """ SELECT round((SELECT lo FROM f), 6) AS lower, round((SELECT hi FROM f), 6) AS upper, count(value) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, min(value) AS min,
    round(quantile_cont(value, 0.25), 6) AS q25, round(median(value), 6) AS q50, round(quantile_cont(value, 0.75), 6) AS q75, max(value) AS max FROM o""",
)
def i08(spark, sf):
    report = ol.iqr_report(table(spark, sf, "events"), "value")
    return report.select(*[r(c).alias(c) if t == "double" else F.col(c) for c, t in report.dtypes])


@query("i08_top_outliers", _VALUE_FENCE + " SELECT event_id, value FROM o ORDER BY value DESC, event_id LIMIT 20")
def i08_top(spark, sf):
    return ol.top_outliers(table(spark, sf, "events"), "value", "event_id").select("event_id", "value")


REPAIRED = """q AS (SELECT quantile_cont(price_per_sqft, 0.25) AS q1, quantile_cont(price_per_sqft, 0.75) AS q3 FROM units),
 h AS (SELECT units.*, coalesce(price_per_sqft < q1 - 1.5 * (q3 - q1) OR price_per_sqft > q3 + 1.5 * (q3 - q1), false) AS hit, CASE WHEN area < 1000 THEN area * 9 ELSE area END AS na FROM units, q),
 repaired AS (SELECT * EXCLUDE (hit, na) REPLACE (CASE WHEN hit THEN coalesce(na, area) ELSE area END AS area,
   CASE WHEN hit THEN coalesce(round_even(price * 1e7 / NULLIF(na, 0), 0), price_per_sqft) ELSE price_per_sqft END AS price_per_sqft) FROM h)"""


@query("i09_repair_rate_outliers", over("units", f", {REPAIRED} SELECT listing_id, area, price_per_sqft FROM repaired"))
def i09(spark, sf):
    return ol.repair_rate_outliers(units(spark, sf)).select("listing_id", "area", "price_per_sqft")


_FIXES = """SELECT listing_id, 'sector' AS `column`, 'sector ' || CAST(90 + listing_id % 9 AS STRING) AS value FROM units WHERE listing_id % 101 = 0
 UNION ALL SELECT listing_id, 'area', CAST(1000 + listing_id % 800 AS STRING) FROM units WHERE listing_id % 67 = 0"""


@query(
    "i10_apply_corrections",
    over(
        "units",
        f""", c AS ({_FIXES.replace('`', '"')}) SELECT u.listing_id, coalesce((SELECT max(value) FROM c WHERE c.listing_id = u.listing_id AND "column" = 'sector'), u.sector) AS sector,
        coalesce((SELECT CAST(max(value) AS DOUBLE) FROM c WHERE c.listing_id = u.listing_id AND "column" = 'area'), u.area) AS area FROM units u""",
    ),
)
def i10(spark, sf):
    rows = units(spark, sf)
    rows.createOrReplaceTempView("units")
    return im.apply_corrections(rows, spark.sql(_FIXES), "listing_id", ["sector", "area"]).select("listing_id", "sector", "area")


# joins ---------------------------------------------------------------------------------------------------


@query(
    "j01_fill_from",
    over(
        "flats facilities",
        """, d AS (SELECT lower(PropertyName) AS name, TopFacilities AS v, row_number() OVER (PARTITION BY lower(PropertyName) ORDER BY facility_id) AS rn FROM facilities)
        SELECT f.property_id, coalesce(f.features, d.v) AS features FROM flats f LEFT JOIN d ON lower(f.society) = d.name AND d.rn = 1""",
    ),
)
def j01(spark, sf):
    other = view(spark, sf, "facilities")
    filled = jn.fill_from(flats(spark, sf), other, "society", "PropertyName", "features", "TopFacilities", "facility_id")
    return filled.select("property_id", "features")


@query(
    "j02_group_lookup",
    over(
        "listings",
        """, m AS (SELECT location, median(price) AS v FROM listings GROUP BY location), s AS (SELECT property_type, count(*) / (SELECT count(*) FROM listings WHERE property_type IS NOT NULL) AS share FROM listings WHERE property_type IS NOT NULL GROUP BY property_type)
        SELECT l.listing_id, round(coalesce(m.v, (SELECT median(price) FROM listings)), 4) AS enc, round(s.share, 9) AS share FROM listings l LEFT JOIN m ON l.location = m.location LEFT JOIN s ON l.property_type = s.property_type""",
    ),
)
def j02(spark, sf):
    rows = jn.target_encode(listings(spark, sf), out="enc")
    rows = jn.group_share(rows, "property_type", "share")
    return rows.select("listing_id", r("enc", 4).alias("enc"), r("share", 9).alias("share"))


@query("j03_same_row_overlay", over("units", "SELECT listing_id, CASE WHEN area < 1000 THEN coalesce(super_built_up_area, area) ELSE area END AS area FROM units"))
def j03(spark, sf):
    return im.overlay(units(spark, sf), F.col("area") < 1000, "area", F.col("super_built_up_area")).select("listing_id", "area")


@query(
    "j04_semi_join",
    over("units", "SELECT listing_id, society FROM units WHERE society IN (SELECT society FROM units WHERE society IS NOT NULL GROUP BY society ORDER BY count(*) DESC, society LIMIT 15)"),
)
def j04(spark, sf):
    return fl.top_n_categories(units(spark, sf), "society", 15).select("listing_id", "society")


@query(
    "j07_within_radius",
    over("listings", f"SELECT * FROM (SELECT listing_id, round({haversine_sql('latitude', 'longitude', '29.9', '-95.4')}, 6) AS distance_mi FROM listings) WHERE distance_mi <= 5"),
)
def j07(spark, sf):
    return jn.within_radius(listings(spark, sf), 29.9, -95.4, 5.0).select("listing_id", r("distance_mi").alias("distance_mi"))


# one center per supplier: the work grows with both tables
_CENTERS = """SELECT s_suppkey AS center_id, 29.5 + CAST((s_suppkey * 137) % 1000 AS DOUBLE) / 1000 AS center_lat,
 -95.8 + CAST((s_suppkey * 311) % 1000 AS DOUBLE) / 1000 AS center_lon FROM supplier"""


@query(
    "j07_radius_join",
    over(
        "listings",
        f""", c AS ({_CENTERS}), d AS (SELECT center_id, listing_id, round({haversine_sql('latitude', 'longitude', 'center_lat', 'center_lon')}, 6) AS miles FROM listings, c)
        SELECT center_id, count(*) AS n, round(min(miles), 6) AS nearest FROM d WHERE miles <= 3 GROUP BY center_id""",
    ),
)
def j07_many(spark, sf):
    table(spark, sf, "supplier").createOrReplaceTempView("supplier")
    return jn.radius_counts(listings(spark, sf), spark.sql(_CENTERS), 3.0).withColumn("nearest", r("nearest"))


# dedupe, ordering, sets ----------------------------------------------------------------------------------

URL = "NULLIF(NULLIF(NULLIF(trim(listing_url), ''), 'nan'), 'None')"


def dedupe_sql(source: str, fallback: list[str]) -> str:
    keys = ", ".join([URL] + [f"CASE WHEN {URL} IS NULL THEN {c} END" for c in fallback])
    return f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY listing_id) AS rn FROM {source}) WHERE rn = 1"


@query("w01_dedupe_url_price", over("listings", f"SELECT listing_id, listing_url, address, price FROM ({dedupe_sql('listings', ['address', 'price'])})"))
def w01(spark, sf):
    return dd.dedupe_listings(listings(spark, sf)).select("listing_id", "listing_url", "address", "price")


@query("w02_dedupe_url_price_sqft", over("listings", f"SELECT listing_id, listing_url, address, price, sqft FROM ({dedupe_sql('listings', ['address', 'price', 'sqft'])})"))
def w02(spark, sf):
    rows = dd.dedupe_listings(listings(spark, sf), ("address", "price", "sqft"))
    return rows.select("listing_id", "listing_url", "address", "price", "sqft")


@query("w03_dedupe_rows", over("houses", "SELECT DISTINCT * FROM houses"))
def w03(spark, sf):
    return dd.dedupe_rows(view(spark, sf, "houses"))


@query(
    "w04_duplicate_counts",
    """SELECT 'orderkey_linenumber' AS "check", CAST(sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS BIGINT) AS members, CAST(sum(n - 1) AS BIGINT) AS extras
    FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
)
def w04(spark, sf):
    counted = dd.duplicate_counts(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])
    return counted.withColumn("check", F.lit("orderkey_linenumber"))


@query("o01_top_k", over("listings", "SELECT listing_id, price FROM listings ORDER BY price DESC NULLS LAST, listing_id LIMIT 20"))
def o01(spark, sf):
    return sm.top_k(listings(spark, sf), "price", 20, "listing_id").select("listing_id", "price")


@query(
    "o02_argmin_argmax",
    over("listings", """SELECT location, arg_min(listing_id, (price, listing_id)) AS cheapest, arg_max(listing_id, (price, listing_id)) AS dearest FROM listings WHERE price IS NOT NULL GROUP BY location"""),
)
def o02(spark, sf):
    order = F.struct("price", "listing_id")
    rows = listings(spark, sf).where(F.col("price").isNotNull())
    return rows.groupBy("location").agg(
        F.min_by("listing_id", order).alias("cheapest"), F.max_by("listing_id", order).alias("dearest")
    )


@query("o03_sample_n")
def o03(spark, sf):
    return sm.sample_n(listings(spark, sf), 3500, 7, "listing_id").select("listing_id", "price")


@query("o04_shuffle")
def o04(spark, sf):
    return sm.shuffled(listings(spark, sf), 7, "listing_id").select("listing_id")


@query(
    "u01_concat_tables",
    over("flats houses", """SELECT property_id, price, floorNum, CAST(NULL AS STRING) AS noOfFloor FROM flats UNION ALL SELECT property_id, price, NULL, noOfFloor FROM houses"""),
)
def u01(spark, sf):
    a = flats(spark, sf).select("property_id", "price", "floorNum")
    return sm.concat_tables(a, view(spark, sf, "houses").select("property_id", "price", "noOfFloor"))


