"""Property type normalisation and inference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Spellings that mean the type is not known.
UNKNOWN_TYPES = ["unknown", "nan", "none", "", "other", "n/a", "na", "—", "-"]

# Alias to label, in matching order.
TYPE_ALIASES = {
    "single_family": "single_family",
    "singlefamily": "single_family",
    "single family": "single_family",
    "single_family_home": "single_family",
    "sfr": "single_family",
    "house": "single_family",
    "detached": "single_family",
    "condo": "condo",
    "condominium": "condo",
    "co-op": "condo",
    "coop": "condo",
    "townhouse": "townhouse",
    "townhome": "townhouse",
    "town home": "townhouse",
    "multi_family": "multi_family",
    "multifamily": "multi_family",
    "multi-family": "multi_family",
    "duplex": "multi_family",
    "triplex": "multi_family",
    "fourplex": "multi_family",
    "apartment": "apartment",
    "apartments": "apartment",
    "lot": "land",
    "land": "land",
    "mobile": "mobile",
    "manufactured": "mobile",
    "mfd/mobile home": "mobile",
    "modular": "mobile",
}

# Description pattern to label, in matching order.
TYPE_PATTERNS = [
    (r"\bcondominium\b|\bcondo\b", "condo"),
    (r"\btown[- ]?house\b|\btownhome\b|\btown home\b", "townhouse"),
    (r"\bduplex\b|\btriplex\b|\bfourplex\b|\bmulti[- ]family\b", "multi_family"),
    (r"\bapartment\b|\bapt\.?\b", "apartment"),
    (r"\bmobile home\b|\bmanufactured\b|\brv park\b", "mobile"),
    (r"\bvacant land\b|\bbuildable lot\b|\bunimproved\b", "land"),
    (r"\bsingle[- ]family\b|\bdetached home\b|\bfamily home\b", "single_family"),
]


def _first_match(cases: list[tuple[Column, str]]) -> Column:
    """Label of the first true condition, else NULL."""
    chain = F.when(*[cases[0][0], F.lit(cases[0][1])])
    for cond, label in cases[1:]:
        chain = chain.when(cond, F.lit(label))
    return chain


def _token(c: Column | str) -> Column:
    text = F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))
    return F.regexp_replace(F.lower(F.regexp_replace(text, r"^\s+|\s+$", "")), r"\s+", " ")


def normalize_property_type(c: Column | str) -> Column:
    """Vendor text to a small label set: exact alias, then first alias contained in it, else the text."""
    exact = F.create_map(*[F.lit(x) for pair in TYPE_ALIASES.items() for x in pair])

    def label(raw: Column) -> Column:
        contained = _first_match([(raw.contains(alias), label) for alias, label in TYPE_ALIASES.items()])
        known = F.coalesce(F.try_element_at(exact, raw), contained, raw)
        return F.when(raw.isin(UNKNOWN_TYPES), F.lit("unknown")).otherwise(known)

    # the one-element array binds the cleaned text once for some thirty branches
    return F.transform(F.array(_token(c)), label)[0]


def infer_type_from_text(c: Column | str) -> Column:
    """Type named in a description, NULL when none is."""
    text = F.lower(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")))
    return _first_match([(text.rlike(pattern), label) for pattern, label in TYPE_PATTERNS])


def infer_type(description: Column | str, sqft: Column | str, bedrooms: Column | str) -> Column:
    """Type from the description, else condo for small units with at most two bedrooms, else single family."""
    area = F.col(sqft) if isinstance(sqft, str) else sqft
    beds = F.col(bedrooms) if isinstance(bedrooms, str) else bedrooms
    by_size = F.when((area < 1100) & (beds <= 2), F.lit("condo")).otherwise(F.lit("single_family"))
    return F.coalesce(infer_type_from_text(description), by_size)


def resolve_property_type(df: DataFrame, out: str = "property_type") -> DataFrame:
    """Normalise ``property_type``, inferring it where it is unknown."""

    def have(name: str, kind: str) -> Column:
        return F.col(name) if name in df.columns else F.lit(None).cast(kind)

    # one column per step: the long alias chain is then evaluated once per row
    staged = df.withColumn("__type", normalize_property_type(have("property_type", "string")))
    inferred = infer_type(have("description", "string"), have("sqft", "double"), have("bedrooms", "double"))
    # labels normalise to themselves, so the result needs no second pass
    resolved = F.when(F.col("__type") == "unknown", inferred).otherwise(F.col("__type"))
    return staged.withColumn(out, resolved).drop("__type")
