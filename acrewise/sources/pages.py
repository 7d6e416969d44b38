"""Extraction of listing rows from stored web pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acrewise.functions.text import digits_to_number
from acrewise.schema import to_numeric

# Schema.org types that describe a residence.
RESIDENCE_TYPES = ["SingleFamilyResidence", "Apartment", "House", "Residence"]
_SCRIPT = r'(?is)<script[^>]*type="application/ld\+json"[^>]*>(.*?)</script>'
_RESIDENCE = """`@type`: STRING, price: STRING, url: STRING, name: STRING, numberOfRooms: STRING, numberOfBedrooms: STRING,
numberOfBathroomsTotal: STRING, numberOfBathrooms: STRING, floorSize: STRUCT<value: STRING>,
address: STRUCT<streetAddress: STRING, addressLocality: STRING>, geo: STRUCT<latitude: STRING, longitude: STRING>,
offers: STRUCT<price: STRING>"""
_SCHEMA = f"ARRAY<STRUCT<{_RESIDENCE}, itemListElement: ARRAY<STRUCT<item: STRUCT<{_RESIDENCE}>>>>>"


def _truthy(c: Column) -> Column:
    """Text that is neither empty nor zero."""
    return F.when(~c.isin("", "0", "0.0", "false"), c)


def extract_jsonld(
    pages: DataFrame,
    types: list[str] = RESIDENCE_TYPES,
    item_list: bool = False,
    source: str = "pages",
    signed_geo: bool = False,
) -> DataFrame:
    """Residence rows from the JSON-LD script blocks of each page.

    Plain form: an object or a list of objects of the given types. ``item_list``: the entries of an ItemList.
    Blocks that are not valid JSON are skipped. Coordinates lose their sign unless ``signed_geo``.
    """
    # the outer form keeps Spark from running the regex in a second, repeated filter
    found = F.explode_outer(F.regexp_extract_all("html", F.lit(_SCRIPT), F.lit(1)))
    blocks = pages.select("page_id", found.alias("text")).where(F.col("text").isNotNull())
    text = F.trim("text")
    whole = F.when(text.startswith("["), text).otherwise(F.concat(F.lit("["), text, F.lit("]")))
    items = blocks.select("page_id", text.startswith("[").alias("is_list"), F.inline(F.from_json(whole, _SCHEMA)))
    if item_list:
        items = items.where((F.col("`@type`") == "ItemList") & ~F.col("is_list"))
        items = items.select("page_id", F.explode("itemListElement").alias("e")).select("page_id", "e.item.*")
        price, rooms, baths = F.col("offers.price"), F.col("numberOfRooms"), F.col("numberOfBathroomsTotal")
        kind = F.coalesce(F.nullif("`@type`", F.lit("")), F.lit("Apartment"))
        address = F.coalesce(F.nullif("address.streetAddress", F.lit("")), F.col("name"))
    else:
        items = items.where(F.col("`@type`").isin(types))
        price = F.coalesce(_truthy(F.col("offers.price")), F.col("price"))
        rooms = F.coalesce(_truthy(F.col("numberOfRooms")), F.col("numberOfBedrooms"))
        baths = F.coalesce(_truthy(F.col("numberOfBathroomsTotal")), F.col("numberOfBathrooms"))
        kind, address = F.col("`@type`"), F.col("address.streetAddress")
    number = to_numeric if signed_geo else digits_to_number
    return items.select(
        "page_id",
        digits_to_number(price).alias("price"),
        digits_to_number(rooms).alias("bedrooms"),
        digits_to_number(baths).alias("bathrooms"),
        digits_to_number(F.col("floorSize.value")).alias("built_up_area"),
        kind.alias("property_type"),
        address.alias("address"),
        F.coalesce(F.nullif("address.addressLocality", F.lit("")), F.lit("Houston")).alias("locality"),
        number(F.col("geo.latitude")).alias("latitude"),
        number(F.col("geo.longitude")).alias("longitude"),
        F.col("url").alias("listing_url"),
        F.lit(source).alias("source"),
    )


# Markup of the repeated block and of its fields.
QUOTE_BLOCK = r'(?s)<div class="quote">(.*?)</div>'
QUOTE_FIELDS = {
    "Author": r'(?s)<small class="author">(.*?)</small>',
    "Quote": r'(?s)<span class="text">(.*?)</span>',
}


def extract_blocks(pages: DataFrame, patterns: dict[str, str] = QUOTE_FIELDS, block: str = QUOTE_BLOCK) -> DataFrame:
    """One row per repeated block of a page, with one column per field pattern."""
    found = F.posexplode_outer(F.regexp_extract_all("html", F.lit(block), F.lit(1)))
    blocks = pages.select("page_id", found.alias("pos", "b")).where(F.col("b").isNotNull())
    fields = [F.regexp_extract("b", pattern, 1).alias(name) for name, pattern in patterns.items()]
    return blocks.select("page_id", "pos", *fields)
