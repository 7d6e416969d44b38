"""Text and number parsing as pure Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Unit conversion and the area kinds as the exports write them.
SQM_TO_SQFT = 10.7639
AREA_KINDS = {
    "super_built_up": r"Super Built up area ",
    "built_up": r"Built Up area\s*:\s*",
    "carpet": r"Carpet area\s*:\s*",
    "plot": r"Plot area ",
}
_NUMBER = r"(\d+\.?\d*)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _extract(c: Column, pattern: str, group: int = 1) -> Column:
    """Regex group, NULL when the pattern does not match or the group is empty."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def _first_token(c: Column, sep: str = " ") -> Column:
    return F.split_part(c, F.lit(sep), F.lit(1))


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def round_exact(c: Column, digits: int) -> Column:
    """Round the stored binary value to ``digits`` decimals, true ties to even.

    Scaling can turn 35.499999... into 35.5; the exact error of the product decides those cases.
    """
    scale = float(10**digits)
    product = c * scale
    # Veltkamp split: the high part times the scale is exact
    high = c * 134217729.0 - (c * 134217729.0 - c)
    error = (high * scale - product) + (c - high) * scale
    down = F.floor(product).cast("double")
    tie = (product - down) == 0.5
    nearest = F.when(tie & (error < 0), down).when(tie & (error > 0), down + 1).otherwise(F.rint(product))
    return nearest / scale


def digits_to_number(c: Column | str) -> Column:
    """Keep digits and dots, then read as a number; anything else is NULL."""
    return F.nullif(F.regexp_replace(_col(c).cast("string"), r"[^0-9.]", ""), F.lit("")).try_cast("double")


def parse_money(c: Column | str, dtype: T.DataType | None = None) -> Column:
    """Money text to double. Numeric columns (pass their ``dtype``) go through unchanged."""
    if isinstance(dtype, T.NumericType):
        return _col(c).cast("double")
    return digits_to_number(c)


def parse_sqft(c: Column | str) -> Column:
    """First number in front of ``sq``, else the first number; thousands commas are dropped."""
    text = F.regexp_replace(F.lower(_col(c).cast("string")), ",", "")
    found = F.coalesce(_extract(text, r"([0-9.]+)\s*sq"), _extract(text, r"([0-9.]+)"))
    return found.try_cast("double")


def price_to_crore(c: Column | str) -> Column:
    """Indian price text to crore: crore as is, lac/lacs/lakh divided by 100, bare numbers as is."""
    text = F.trim(F.lower(_col(c).cast("string")))
    number = _extract(text, _NUMBER).try_cast("double")
    value = (
        F.when(text.contains("crore"), number)
        .when(text.contains("lac") | text.contains("lakh"), number / 100)
        .otherwise(text.try_cast("double"))
    )
    return round_exact(value, 2)


def parse_rate(c: Column | str) -> Column:
    """Rate text such as ``<sign> 10,500/sq.ft.`` to double."""
    return F.trim(F.translate(_first_token(_col(c), "/"), "₹,", "")).try_cast("double")


def leading_int(c: Column | str) -> Column:
    return _first_token(_col(c)).try_cast("int")


def balcony_count(c: Column | str) -> Column:
    """Leading token, ``No`` read as 0; kept as text because of values such as ``3+``."""
    return F.replace(_first_token(_col(c)), F.lit("No"), F.lit("0"))


def floor_number(c: Column | str, basement_sign: bool = False) -> Column:
    """Floor token to int. Basements read as 1 unless ``basement_sign`` keeps them at -1."""
    token = _first_token(_col(c))
    token = F.when(token == "Ground", F.lit("0")).otherwise(token)
    token = F.replace(F.replace(token, F.lit("Basement"), F.lit("-1")), F.lit("Lower"), F.lit("0"))
    return _extract(token, r"(-?\d+)" if basement_sign else r"(\d+)").try_cast("int")


def clean_society(c: Column | str, missing: str | None = "independent") -> Column:
    """Drop the star rating, trim and lower; an absent name becomes ``missing``."""
    name = F.lower(_strip(F.regexp_replace(_col(c), r"\d+(\.\d+)?\s?★", "")))
    absent = name.isNull() | (name == "nan")
    return F.when(absent, F.lit(missing).cast("string")).otherwise(name)


def sector_of(c: Column | str) -> Column:
    """Text between the first and second literal ``in`` of a title, without the city name."""
    part = F.get(F.split(_col(c), "in"), F.lit(1))
    return F.lower(F.trim(F.replace(part, F.lit("Gurgaon"), F.lit(""))))


def alias_cascade(c: Column | str, pairs: list[tuple[str, str]]) -> Column:
    """Apply literal substring replacements one after the other; the order of ``pairs`` matters."""
    out = _col(c)
    for old, new in pairs:
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def area_of(c: Column | str, kind: str, sqm: bool = True, sqm_strict: bool = False) -> Column:
    """Area of one kind from the combined area text, in sqft.

    With ``sqm`` a bracketed square-metre figure right after the number wins. ``sqm_strict`` accepts it only
    after a number written with a decimal point and one space.
    """
    text = _col(c)
    number = _extract(text, AREA_KINDS[kind] + _NUMBER).try_cast("double")
    if not sqm:
        return number
    if sqm_strict:
        metres = _extract(text, AREA_KINDS[kind] + r"\d+\.\d+ \(" + _NUMBER + r" sq.m.\)")
    else:
        metres = _extract(text, AREA_KINDS[kind] + r"\d+\.?\d*\s*\(" + _NUMBER + r" sq\.m\.\)")
    return F.coalesce(metres.try_cast("double") * SQM_TO_SQFT, number)


def with_areas(df: DataFrame, c: str = "areaWithType", sqm_strict: bool = False) -> DataFrame:
    """Super built-up, built-up and carpet area; the plot area stands in when all three are missing."""
    sup = area_of(c, "super_built_up", sqm_strict=sqm_strict)
    built = area_of(c, "built_up", sqm_strict=sqm_strict)
    carpet = area_of(c, "carpet", sqm_strict=sqm_strict)
    none = sup.isNull() & built.isNull() & carpet.isNull()
    return df.withColumns(
        {
            "super_built_up_area": sup,
            "built_up_area": F.when(none, area_of(c, "plot", sqm=False)).otherwise(built),
            "carpet_area": carpet,
        }
    )


def contains_flags(df: DataFrame, c: str, terms: list[str]) -> DataFrame:
    """One 0/1 column per term telling whether the text contains it."""
    return df.withColumns({t: F.col(c).contains(t).cast("int") for t in terms})


def age_category(c: Column | str) -> Column:
    # fixed values: the phrases below are those of the exports
    text = _col(c)

    def has(*words: str) -> Column:
        cond = text.contains(words[0])
        for w in words[1:]:
            cond = cond | text.contains(w)
        return cond

    return (
        F.when(text.isNull(), "Undefined")
        .when(has("0 to 1 Year Old", "Within 6 months", "Within 3 months"), "New Property")
        .when(has("1 to 5 Year Old"), "Relatively New")
        .when(has("5 to 10 Year Old"), "Moderately Old")
        .when(has("10+ Year Old"), "Old Property")
        .when(has("Under Construction", "By"), "Under Construction")
        .when(text.rlike(r"(^| )[0-9]+$"), "Under Construction")
        .otherwise("Undefined")
    )


def map_or_default(c: Column | str, mapping: dict[str, str], default: str) -> Column:
    """Exact dictionary lookup; values outside ``mapping`` become ``default``."""
    entries = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.coalesce(F.try_element_at(entries, _col(c)), F.lit(default))


def furnishing_count(c: Column | str, term: str) -> Column:
    """Count stated in front of ``term``; a bare mention counts 1, ``No term`` and absence count 0."""
    text = _col(c)
    stated = _extract(text, r"(\d+) \Q" + term + r"\E").try_cast("int")
    return F.coalesce(
        F.when(text.contains(f"No {term}"), F.lit(0)).otherwise(
            F.coalesce(stated, F.when(text.contains(term), F.lit(1)))
        ),
        F.lit(0),
    )


def furnishing_terms(df: DataFrame, c: str) -> DataFrame:
    """Distinct furnishing names used in a details column."""
    items = F.split(F.translate(F.col(c), "[]'", ""), ", ")
    return (
        df.where(F.col(c).isNotNull())
        .select(F.explode(items).alias("item"))
        .select(F.trim(F.regexp_replace("item", r"No |\d+", "")).alias("term"))
        .where("term <> ''")
        .distinct()
    )


def parse_list(c: Column | str) -> Column:
    """Items of a list literal in single or double quotes; anything not starting with ``[`` is empty."""
    text = _col(c)
    quoted = F.regexp_extract_all(text, F.lit("'[^']*'|\"[^\"]*\""), F.lit(0))
    items = F.transform(quoted, lambda q: F.substring(q, F.lit(2), F.length(q) - 2))
    return F.when(text.startswith("["), items).otherwise(F.array().cast("array<string>"))


def binarize(df: DataFrame, c: str, vocabulary: list[str]) -> DataFrame:
    """One 0/1 column per vocabulary term of an array column."""
    return df.withColumns({t: F.coalesce(F.array_contains(c, t).cast("int"), F.lit(0)) for t in vocabulary})


def weighted_score(c: Column | str, weights: dict[str, int]) -> Column:
    """Sum of weights over the distinct items of an array; unknown items weigh nothing."""
    table = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair])
    return F.aggregate(
        F.array_distinct(F.coalesce(_col(c), F.array().cast("array<string>"))),
        F.lit(0),
        lambda acc, item: acc + F.coalesce(F.try_element_at(table, item), F.lit(0)),
    )


def sector_number(c: Column | str) -> Column:
    """First number in a name as a sort key; names without one sort last."""
    return F.coalesce(_extract(_col(c), r"(\d+)").try_cast("double"), F.lit(float("inf")))


def fix_zip(c: Column | str) -> Column:
    return F.regexp_replace(_col(c).cast("string"), r"\.0$", "")


def street_of(c: Column | str) -> Column:
    street = _strip(_first_token(F.coalesce(_col(c), F.lit("")), ","))
    return F.when(street == "", F.lit("(no address)")).otherwise(street)


def bedroom_label(c: Column | str, style: str = "bhk") -> Column:
    """Bedroom bucket label: ``bhk`` for dashboards, ``br`` clipped to 0..8, ``diagnostic`` with 5+."""
    beds = _col(c)
    whole = beds.cast("bigint").cast("string")
    if style == "bhk":
        return (
            F.when(beds >= 5, F.lit("5+ BHK"))
            .when(beds.isNotNull(), F.concat(whole, F.lit(" BHK")))
            .otherwise(F.lit("Unknown"))
        )
    if style == "br":
        clipped = F.least(F.greatest(F.coalesce(beds, F.lit(-1.0)), F.lit(0.0)), F.lit(8.0))
        return F.concat(clipped.cast("bigint").cast("string"), F.lit(" BR"))
    if style == "diagnostic":
        return F.when(beds >= 5, F.lit("5+")).otherwise(F.coalesce(whole, F.lit("-1")))
    raise ValueError(f"unknown style: {style}")


def present(c: Column | str) -> Column:
    """Trimmed text, NULL when it is empty or a spelled-out missing value."""
    text = _strip(_col(c).cast("string"))
    return F.when(~text.isin("", "nan", "None"), text)


def key_of(*cols: Column | str) -> Column:
    """Typed composite key; missing parts stay NULL and compare equal when grouped."""
    return F.struct(*[_col(c).alias(f"k{i}") for i, c in enumerate(cols)])
