"""Keep-first deduplication and duplicate accounting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acrewise.functions.text import present
from acrewise.scale import first_per_key, lookup_join

SIGNATURE_COLUMNS = ["address", "price", "sqft", "bedrooms", "bathrooms", "zipcode"]


def dedupe_listings(
    df: DataFrame, fallback: tuple[str, ...] = ("address", "price"), order: tuple[Column | str, ...] = ("listing_id",)
) -> DataFrame:
    """One row per url; rows without a url are compared on the ``fallback`` columns.

    An absent, empty or ``nan`` url counts as missing, so url-less rows do not collapse into one.
    """
    url = present("listing_url")
    keys = [url, *[F.when(url.isNull(), F.col(c)) for c in fallback]]
    return first_per_key(df, keys, list(order))


def dedupe_on(df: DataFrame, keys: list[str], order: tuple[Column | str, ...]) -> DataFrame:
    return first_per_key(df, keys, list(order))


def dedupe_rows(df: DataFrame) -> DataFrame:
    """Drop rows equal in every column."""
    return df.distinct()


def duplicate_counts(df: DataFrame, keys: list[str], valid: Column | None = None) -> DataFrame:
    """``members``: rows sharing their key with another row; ``extras``: rows beyond the first of each key.

    Counts per key first, so the work does not depend on how large one key's group is.
    """
    rows = df if valid is None else df.where(valid)
    per_key = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("members"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("extras"),
    )


def duplicate_report(df: DataFrame, label: str | None = None) -> DataFrame:
    """One row per check: url, address + price, and full signature duplicates."""
    checks = []
    if "listing_url" in df.columns:
        checks.append(("listing_url", ["listing_url"], present("listing_url").isNotNull()))
    if {"address", "price"} <= set(df.columns):
        checks.append(("address_price", ["address", "price"], None))
    signature = [c for c in SIGNATURE_COLUMNS if c in df.columns]
    if signature:
        checks.append(("signature", signature, None))
    out = None
    for name, keys, valid in checks:
        row = duplicate_counts(df, keys, valid).withColumn("check", F.lit(name if label is None else f"{label}:{name}"))
        out = row if out is None else out.unionByName(row)
    return out.select("check", "members", "extras")


def duplicate_sample(df: DataFrame, order: str, n: int = 200) -> DataFrame:
    """The first ``n`` rows, in ``order``, that share their signature with another row."""
    signature = [c for c in SIGNATURE_COLUMNS if c in df.columns]
    repeated = df.groupBy(*signature).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*signature)
    rows = lookup_join(df, repeated, signature, how="left_semi", null_safe=True)
    return rows.orderBy(order).limit(n).select(order, *signature)
