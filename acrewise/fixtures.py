"""Listing-shaped views over the supplied tables, as SQL text that Spark and DuckDB both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

LISTINGS = """
SELECT o.o_orderkey AS listing_id,
       CASE WHEN o.o_orderkey % 97 = 0 THEN NULL WHEN o.o_orderkey % 50 = 1 THEN o.o_totalprice * 8 ELSE o.o_totalprice END AS price,
       CASE WHEN o.o_orderkey % 89 = 0 THEN NULL ELSE CAST(1 + o.o_orderkey % 6 AS DOUBLE) END AS bedrooms,
       CASE WHEN o.o_orderkey % 13 = 0 THEN NULL ELSE CAST(1 + o.o_orderkey % 4 AS DOUBLE) / 2 END AS bathrooms,
       CASE WHEN o.o_orderkey % 83 = 0 THEN NULL ELSE CAST(400 + (o.o_orderkey * 7919) % 4600 AS DOUBLE) END AS sqft,
       CASE WHEN o.o_orderkey % 7 = 0 THEN NULL ELSE CAST(600 + (o.o_orderkey * 104729) % 14400 AS DOUBLE) END AS lot_size,
       CASE WHEN o.o_orderkey % 17 = 0 THEN NULL ELSE CAST(1930 + (o.o_orderkey * 31) % 96 AS DOUBLE) END AS year_built,
       CASE WHEN n.n_nationkey = 3 THEN 'Houston' WHEN n.n_nationkey = 4 THEN 'South houston' ELSE n.n_name END AS location,
       CASE o.o_orderkey % 11 WHEN 0 THEN 'SINGLE_FAMILY' WHEN 1 THEN 'Condo' WHEN 2 THEN 'Town  Home'
            WHEN 3 THEN 'unknown' WHEN 4 THEN NULL WHEN 5 THEN 'row townhouses' WHEN 6 THEN 'Duplex'
            WHEN 7 THEN 'Mfd/Mobile Home' WHEN 8 THEN 'lot' WHEN 9 THEN 'Yurt' ELSE 'APARTMENTS' END AS property_type,
       CASE WHEN o.o_orderkey % 19 = 0 THEN NULL ELSE 29.5 + CAST((o.o_custkey * 37) % 1000 AS DOUBLE) / 1000 END AS latitude,
       CASE WHEN o.o_orderkey % 19 = 0 THEN NULL ELSE -95.8 + CAST((o.o_custkey * 91) % 1000 AS DOUBLE) / 1000 END AS longitude,
       CASE o.o_orderkey % 9 WHEN 0 THEN 'Pool and two car garage' WHEN 1 THEN 'Gated community, gym'
            WHEN 2 THEN 'garden view condo near office park' WHEN 3 THEN 'investigated by security team'
            WHEN 4 THEN 'Fireplace; carpool lane' WHEN 5 THEN NULL WHEN 6 THEN '' WHEN 7 THEN 'duplex, detached home'
            ELSE 'townhome with pool and garden' END AS description,
       CASE o.o_orderkey % 5 WHEN 0 THEN 'TX' WHEN 1 THEN 'Texas' WHEN 2 THEN 'tx' WHEN 3 THEN NULL ELSE 'OK' END AS state,
       CAST(77000 + o.o_custkey % 90 AS STRING) || '.0' AS zipcode,
       CAST(o.o_custkey AS STRING) || ' Main St, Houston, TX' AS address,
       CASE WHEN o.o_orderkey % 3 = 0 THEN NULL WHEN o.o_orderkey % 3 = 1 THEN ''
            ELSE 'https://ex.com/' || CAST(o.o_orderkey % 4000 AS STRING) END AS listing_url,
       'export_' || CAST(o.o_custkey % 4 AS STRING) || '.csv' AS source_file,
       CASE WHEN o.o_orderkey % 31 = 0 THEN NULL WHEN o.o_orderkey % 3 = 0 THEN 'synthetic_augmented' ELSE 'real_raw' END AS data_tier
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
"""

# '~' stands for a single quote, '^' for a double quote; both are put in with replace()
_AREA_NAME = """CASE o.o_orderkey % 23 WHEN 0 THEN 'Sector 12' WHEN 1 THEN 'DLF Phase 1' WHEN 2 THEN 'Sohna' WHEN 3 THEN 'Sohna Road'
            WHEN 4 THEN 'Ashok Vihar Phase 3 Extension' WHEN 5 THEN 'Sushant Lok Phase 2' WHEN 6 THEN 'Sector 95A' WHEN 7 THEN 'Palam Vihar'
            WHEN 8 THEN 'New Colony' WHEN 9 THEN 'Sector 36 Sohna Road' WHEN 10 THEN 'Sainik Farm' WHEN 11 THEN 'A Block Sector 43'
            WHEN 12 THEN 'Sector 3A' WHEN 13 THEN 'Ashok Vihar' WHEN 14 THEN 'IMT Manesar' WHEN 15 THEN 'Sector 1 Manesar'
            WHEN 16 THEN 'Mehrauli  Road' ELSE 'Sector ' || CAST(o.o_orderkey % 113 AS STRING) END"""

_UNIT_TEXT = """
       CASE o.o_orderkey % 13 WHEN 0 THEN 'Tulip Violet 4.2 ★' WHEN 1 THEN ' Nandan Heights ' WHEN 2 THEN NULL WHEN 3 THEN 'The Aralias 3★'
            WHEN 4 THEN 'independent' ELSE 'Society ' || CAST(o.o_orderkey % 300 AS STRING) END AS society,
       CASE o.o_orderkey % 9 WHEN 0 THEN 'Price on Request' WHEN 1 THEN CAST(20 + o.o_orderkey % 70 AS STRING) || '.99 Lac' WHEN 2 THEN NULL
            WHEN 3 THEN CAST(1 + o.o_orderkey % 8 AS STRING) || ' Crore' WHEN 4 THEN CAST(30 + o.o_orderkey % 60 AS STRING) || ' Lacs'
            WHEN 5 THEN CAST(30 + o.o_orderkey % 60 AS STRING) || ' lakh' WHEN 6 THEN CAST(1 + o.o_orderkey % 30 AS STRING) || '.' || CAST(o.o_orderkey % 10 AS STRING)
            ELSE CAST(1 + o.o_orderkey % 7 AS STRING) || '.' || CAST(10 + o.o_custkey % 90 AS STRING) || ' Crore' END AS price,
       CASE WHEN o.o_orderkey % 47 = 0 THEN NULL WHEN o.o_orderkey % 101 = 0 THEN '₹ ' || CAST(60 + o.o_custkey % 20 AS STRING) || ',000/sq.ft.'
            ELSE '₹ ' || CAST(5 + o.o_custkey % 20 AS STRING) || ',' || CAST(100 + o.o_orderkey % 900 AS STRING) || '/sq.ft.' END AS rate,
       CASE o.o_orderkey % 10
            WHEN 0 THEN 'Super Built up area ' || CAST(800 + o.o_custkey % 2000 AS STRING) || '(111.48 sq.m.)Built Up area: ' || CAST(700 + o.o_custkey % 1900 AS STRING) || ' sq.ft.Carpet area: ' || CAST(600 + o.o_custkey % 1700 AS STRING)
            WHEN 1 THEN 'Super Built up area ' || CAST(800 + o.o_custkey % 2000 AS STRING) || ' (' || CAST(90 + o.o_orderkey % 80 AS STRING) || '.5 sq.m.)'
            WHEN 2 THEN 'Carpet area: ' || CAST(600 + o.o_custkey % 1700 AS STRING) || ' (' || CAST(60 + o.o_orderkey % 80 AS STRING) || ' sq.m.)'
            WHEN 3 THEN 'Plot area ' || CAST(100 + o.o_custkey % 400 AS STRING) || '(83.61 sq.m.)'
            WHEN 4 THEN 'Built Up area: ' || CAST(700 + o.o_custkey % 1900 AS STRING) || '.5 sq.ft.'
            WHEN 5 THEN 'Super Built up area ' || CAST(800 + o.o_custkey % 2000 AS STRING) || ' Carpet area : ' || CAST(600 + o.o_custkey % 1700 AS STRING) || '.25'
            WHEN 6 THEN NULL WHEN 7 THEN 'Built Up area 900'
            ELSE 'Super Built up area ' || CAST(800 + o.o_custkey % 2000 AS STRING) END AS areaWithType,
       CASE WHEN o.o_orderkey % 53 = 0 THEN NULL ELSE CAST(1 + o.o_orderkey % 12 AS STRING) || ' Bedrooms' END AS bedRoom,
       CASE WHEN o.o_orderkey % 59 = 0 THEN NULL ELSE CAST(1 + o.o_orderkey % 5 AS STRING) || ' Bathrooms' END AS bathroom,
       CASE o.o_orderkey % 5 WHEN 0 THEN 'No Balcony' WHEN 1 THEN '1 Balcony' WHEN 2 THEN '3+ Balconies' WHEN 3 THEN NULL ELSE '2 Balconies' END AS balcony,
       CASE o.o_orderkey % 6 WHEN 0 THEN NULL WHEN 1 THEN 'Study Room' WHEN 2 THEN 'Pooja Room,Store Room' WHEN 3 THEN 'Servant Room,Others'
            WHEN 4 THEN 'Store Room' ELSE 'Study Room,Servant Room,Pooja Room' END AS additionalRoom,
       CASE o.o_orderkey % 7 WHEN 0 THEN 'Ground of 3' WHEN 1 THEN 'Basement of 2' WHEN 2 THEN 'Lower Ground of 4' WHEN 3 THEN NULL
            ELSE CAST(1 + o.o_orderkey % 29 AS STRING) || ' (Out of 30 Floors)' END AS floorNum,
       CASE o.o_orderkey % 4 WHEN 0 THEN 'North-East' WHEN 1 THEN NULL WHEN 2 THEN 'East' ELSE 'South' END AS facing,
       CASE o.o_orderkey % 12 WHEN 0 THEN '0 to 1 Year Old' WHEN 1 THEN '1 to 5 Year Old' WHEN 2 THEN '5 to 10 Year Old' WHEN 3 THEN '10+ Year Old'
            WHEN 4 THEN 'Under Construction' WHEN 5 THEN 'Within 6 months' WHEN 6 THEN 'Within 3 months' WHEN 7 THEN 'May 2024' WHEN 8 THEN 'By Dec 2025'
            WHEN 9 THEN NULL WHEN 10 THEN 'undefined' ELSE 'Jul 2024' END AS agePossession,
       replace(CASE o.o_orderkey % 8 WHEN 0 THEN '[~3 Fan~, ~1 AC~, ~No Sofa~]' WHEN 1 THEN '[]' WHEN 2 THEN NULL WHEN 3 THEN '[~1 Water Purifier~, ~12 Light~, ~Sofa~]'
            WHEN 4 THEN '[~No AC~, ~5 Wardrobe~, ~Modular Kitchen~]' WHEN 5 THEN '[~' || CAST(1 + o.o_orderkey % 9 AS STRING) || ' Fan~, ~1 Bed~]'
            WHEN 6 THEN '[~2 Geyser~, ~1 TV~, ~1 Sofa~, ~No Bed~]' ELSE '[~4 AC~, ~' || CAST(1 + o.o_custkey % 20 AS STRING) || ' Light~]' END, '~', chr(39)) AS furnishDetails,
       replace(replace(CASE o.o_orderkey % 7 WHEN 0 THEN '[~Swimming Pool~, ~Park~, ^Children~s Play Area^]' WHEN 1 THEN NULL WHEN 2 THEN '[~Club House~, ~Club House~, ~Helipad~]'
            WHEN 3 THEN 'Power Backup' WHEN 4 THEN '[~Golf Course~, ~Spa~, ~ATM~, ~Bar/Chill-Out Lounge~]' WHEN 5 THEN '[]'
            ELSE '[~24/7 Water Supply~, ~Park~]' END, '~', chr(39)), '^', chr(34)) AS features"""

FLATS = f"""
SELECT o.o_orderkey AS property_id, 'https://ex.com/flat/' || CAST(o.o_orderkey AS STRING) AS link,
       CASE WHEN o.o_orderkey % 41 = 0 THEN NULL WHEN o.o_orderkey % 211 = 1 THEN '2 BHK Flat in Colony ' || CAST(o.o_orderkey AS STRING) || ' Gurgaon'
            ELSE CAST(1 + o.o_orderkey % 5 AS STRING) || ' BHK Flat in ' || {_AREA_NAME} || ' Gurgaon' END AS property_name,{_UNIT_TEXT}
FROM orders o
"""

# the house export names two columns differently and repeats some rows
HOUSES = f"""
WITH h AS (SELECT o.o_orderkey + 10000000000 AS property_id, 'https://ex.com/house/' || CAST(o.o_orderkey AS STRING) AS link,
             CASE WHEN o.o_orderkey % 43 = 0 THEN NULL ELSE CAST(2 + o.o_orderkey % 4 AS STRING) || ' Bedroom House for sale in ' || {_AREA_NAME} || ' Gurgaon' END AS property_name,
             CASE WHEN o.o_orderkey % 6 = 0 THEN '5 Floors' WHEN o.o_orderkey % 6 = 1 THEN NULL ELSE CAST(1 + o.o_orderkey % 4 AS STRING) || ' Floors' END AS noOfFloor,{_UNIT_TEXT}
      FROM orders o),
twice AS (SELECT * FROM h UNION ALL SELECT * FROM h WHERE property_id % 2 = 1)
SELECT property_id, link, property_name, society, price, rate, areaWithType, bedRoom, bathroom, balcony, additionalRoom,
       noOfFloor, facing, agePossession, furnishDetails, features
FROM twice
"""

FACILITIES = """
SELECT 'Society ' || CAST(p.p_partkey % 250 AS STRING) AS PropertyName,
       replace(CASE p.p_partkey % 3 WHEN 0 THEN '[~Park~, ~Spa~]' WHEN 1 THEN '[~Swimming Pool~, ~ATM~, ~Library~]' ELSE '[~Gymnasium~]' END, '~', chr(39)) AS TopFacilities,
       p.p_partkey AS facility_id
FROM part p
"""

# cleaned-unit table: numeric columns derived from the orders table
UNITS = f"""
SELECT o.o_orderkey AS listing_id,
       CASE WHEN o.o_orderkey % 3 = 0 THEN 'house' ELSE 'flat' END AS property_type,
       CASE WHEN o.o_orderkey % 37 = 0 THEN NULL WHEN o.o_custkey % 3 = 0 THEN 'sector 1' ELSE 'sector ' || CAST(o.o_custkey % 104 AS STRING) END AS sector,
       CASE WHEN o.o_orderkey % 13 = 4 THEN 'independent' WHEN o.o_orderkey % 61 = 0 THEN NULL ELSE 'society ' || CAST((o.o_orderkey * 7) % 600 AS STRING) END AS society,
       CASE WHEN o.o_orderkey % 71 = 0 THEN NULL ELSE CAST(floor(o.o_totalprice / 200) AS DOUBLE) / 100 END AS price,
       CASE WHEN o.o_orderkey % 29 = 0 THEN CAST(90 + o.o_custkey % 60 AS DOUBLE) ELSE CAST(500 + (o.o_orderkey * 7919) % 4500 AS DOUBLE) END AS area,
       CASE WHEN o.o_orderkey % 71 = 0 THEN NULL WHEN o.o_orderkey % 29 = 0 THEN CAST(60000 + (o.o_orderkey * 131) % 90000 AS DOUBLE) ELSE CAST(3000 + (o.o_orderkey * 31) % 15000 AS DOUBLE) END AS price_per_sqft,
       CAST(1 + o.o_orderkey % 12 AS DOUBLE) AS bedRoom,
       CAST(1 + o.o_custkey % 5 AS DOUBLE) AS bathroom,
       CASE WHEN o.o_orderkey % 23 = 0 THEN NULL ELSE CAST(o.o_custkey % 20 AS DOUBLE) END AS floorNum,
       CASE WHEN o.o_orderkey % 4 = 0 THEN 'Undefined' WHEN o.o_custkey % 5 = 0 THEN 'New Property' WHEN o.o_custkey % 5 < 3 THEN 'Relatively New'
            WHEN o.o_custkey % 5 = 3 THEN 'Moderately Old' ELSE 'Old Property' END AS agePossession,
       CASE WHEN o.o_orderkey % 10 IN (0, 1, 5, 8) THEN CAST(800 + o.o_custkey % 2000 AS DOUBLE) END AS super_built_up_area,
       CASE WHEN o.o_orderkey % 10 IN (0, 3, 4) THEN CAST(700 + o.o_custkey % 1900 AS DOUBLE) END AS built_up_area,
       CASE WHEN o.o_orderkey % 10 IN (0, 2, 5) THEN CAST(600 + o.o_custkey % 1700 AS DOUBLE) END AS carpet_area,
       CAST(o.o_custkey % 3 AS INTEGER) AS furnishing_type,
       CAST((o.o_orderkey * 13) % 175 AS DOUBLE) AS luxury_score
FROM orders o
"""

# pages carrying residence JSON-LD, one per listing; page_id is the listing id
LD_PAGES = f"""
SELECT l.listing_id AS page_id,
       replace(CASE l.listing_id % 5
         WHEN 0 THEN '<html><script type=^application/ld+json^>{{^@type^:^House^,^url^:^https://ex.com/p/' || CAST(l.listing_id AS STRING) || '^,^offers^:{{^price^:^$' || CAST(100000 + l.listing_id AS STRING) || '^}},^numberOfRooms^:' || CAST(1 + l.listing_id % 6 AS STRING) || ',^floorSize^:{{^value^:^' || CAST(500 + l.listing_id % 3000 AS STRING) || ' sqft^}},^address^:{{^streetAddress^:^' || l.address || '^,^addressLocality^:^Katy^}},^geo^:{{^latitude^:29.75,^longitude^:-95.5}}}}</script></html>'
         WHEN 1 THEN '<html><script type=^application/ld+json^>[{{^@type^:^Residence^,^price^:' || CAST(200000 + l.listing_id AS STRING) || ',^numberOfBedrooms^:3,^numberOfBathroomsTotal^:2}},{{^@type^:^Person^,^price^:1}}]</script><script type=^application/ld+json^>{{^@type^:^Apartment^,^offers^:{{^price^:' || CAST(900 + l.listing_id % 500 AS STRING) || '}}}}</script></html>'
         WHEN 2 THEN '<html><script type=^application/ld+json^>{{^@type^:^ItemList^,^itemListElement^:[{{^item^:{{^@type^:^Apartment^,^name^:^Unit ' || CAST(l.listing_id AS STRING) || '^,^offers^:{{^price^:1500}},^url^:^/u^}}}},{{^item^:{{^name^:^Loft^,^numberOfRooms^:2,^address^:{{^streetAddress^:^9 Elm^,^addressLocality^:^Spring^}}}}}}]}}</script></html>'
         WHEN 3 THEN '<html><script type=^application/ld+json^>{{broken json</script><script>var x=1;</script></html>'
         ELSE '<html><div class=^quote^><span class=^text^>Listing ' || CAST(l.listing_id AS STRING) || '</span><small class=^author^>Agent ' || CAST(l.listing_id % 7 AS STRING) || '</small></div><div class=^quote^><span class=^text^>Second</span><small class=^author^>Other</small></div></html>' END, '^', chr(34)) AS html
FROM listings l
"""

CTES = {
    "listings": LISTINGS,
    "flats": FLATS,
    "houses": HOUSES,
    "facilities": FACILITIES,
    "units": UNITS,
    "ld_pages": LD_PAGES,
}
_NEEDS = {"ld_pages": ["listings"]}


def with_ctes(*names: str) -> str:
    """``WITH a AS (...), b AS (...)`` prefix for the oracle SQL."""
    ordered: list[str] = []
    for name in names:
        for dep in [*_NEEDS.get(name, []), name]:
            if dep not in ordered:
                ordered.append(dep)
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in ordered)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the views above as a lazy DataFrame over the parquet tables in ``sf_dir``."""
    for source in ("orders", "customer", "nation", "part"):
        table(spark, sf_dir, source).createOrReplaceTempView(source)
    return spark.sql(f"{with_ctes(name)} SELECT * FROM {name}")
