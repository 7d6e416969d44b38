"""A and Q rows: descriptive statistics, relations and the data-quality profile."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import functions as F

from acrewise.operators import dedupe as dd
from acrewise.operators import outliers as ol
from acrewise.operators import profile as pf
from acrewise.operators import sketches as sk
from acrewise.operators import stats as st
from acrewise.operators.filters import in_band, require
from acrewise.queries.registry import listings, over, query, r, rounded, table, units
from acrewise.queries.tables import dedupe_sql, iqr_chain_sql
from acrewise.scale import quantiles, shared_folder


def _round_doubles(df, digits: int = 6):
    return rounded(df, {c: digits for c, t in df.dtypes if t == "double"})


# counts --------------------------------------------------------------------------------------------------


@query(
    "a01_value_counts",
    over("listings", "SELECT property_type, count(*) AS count, round(count(*) / (SELECT count(*) FROM listings WHERE property_type IS NOT NULL), 9) AS share FROM listings WHERE property_type IS NOT NULL GROUP BY property_type ORDER BY count DESC, property_type LIMIT 8"),
)
def a01(spark, sf):
    return rounded(st.value_counts(listings(spark, sf), "property_type", 8, share=True), {"share": 9})


@query(
    "a01_value_counts_filled",
    over("listings", "SELECT coalesce(property_type, 'unknown') AS property_type, count(*) AS count FROM listings GROUP BY 1"),
)
def a01_filled(spark, sf):
    return st.value_counts(listings(spark, sf), "property_type", fill="unknown")


@query(
    "a02_cumulative_share",
    over(
        "units",
        """, c AS (SELECT society, count(*) AS count FROM units WHERE society IS NOT NULL AND society <> 'independent' GROUP BY society)
        SELECT society, count, round(sum(count) OVER (ORDER BY count DESC, society ROWS UNBOUNDED PRECEDING) / (SELECT sum(count) FROM c), 9) AS cumulative_share FROM c ORDER BY count DESC, society LIMIT 75""",
    ),
)
def a02(spark, sf):
    return rounded(st.cumulative_share(units(spark, sf), "society", "independent", 75), {"cumulative_share": 9})


@query(
    "a03_frequency_bins",
    over(
        "units",
        """, c AS (SELECT count(*) AS n FROM units WHERE society IS NOT NULL GROUP BY society),
        b(band, lo, hi) AS (VALUES ('Very High (>100)', 101, 1000000000), ('High (50-100)', 50, 100), ('Average (10-49)', 10, 49), ('Low (2-9)', 2, 9), ('Very Low (1)', 1, 1))
        SELECT band, (SELECT count(*) FROM c WHERE n BETWEEN lo AND hi) AS "values" FROM b""",
    ),
)
def a03(spark, sf):
    return st.frequency_bins(units(spark, sf), "society")


_CLEAN = f""", k AS (SELECT * FROM listings WHERE price IS NOT NULL AND sqft IS NOT NULL AND bedrooms IS NOT NULL AND price > 30000 AND price < 20000000),
 {iqr_chain_sql('k', ['price', 'sqft', 'bedrooms'])}"""


@query(
    "a04_market_summary",
    over(
        "listings",
        _CLEAN
        + """ SELECT location, count(*) AS listings, round(median(price), 4) AS median_price, round(avg(price), 4) AS mean_price, round(median(price / sqft), 6) AS median_price_per_sqft
        FROM i2 GROUP BY location ORDER BY listings DESC, location LIMIT 18""",
    ),
)
def a04(spark, sf):
    rows = require(listings(spark, sf)).where(in_band("price", 30_000, 20_000_000))
    rows = ol.remove_outliers_iqr(rows, ["price", "sqft", "bedrooms"])
    rows = rows.withColumn("pps", F.try_divide("price", "sqft"))
    summary = st.group_summary(
        rows,
        ["location"],
        {
            "listings": ("price", "size"),
            "median_price": ("price", "median"),
            "mean_price": ("price", "mean"),
            "median_price_per_sqft": ("pps", "median"),
        },
    )
    top = summary.orderBy(F.desc("listings"), "location").limit(18)
    return rounded(top, {"median_price": 4, "mean_price": 4, "median_price_per_sqft": 6})


@query(
    "a05_mean_of_numerics",
    over("units", """SELECT agePossession, round(avg(price), 6) AS price, round(avg(area), 6) AS area, round(avg(bedRoom), 6) AS "bedRoom", round(avg(luxury_score), 6) AS luxury_score,
    round(avg(furnishing_type), 6) AS furnishing_type FROM units GROUP BY agePossession"""),
)
def a05(spark, sf):
    rows = units(spark, sf).select("agePossession", "price", "area", "bedRoom", "luxury_score", "furnishing_type")
    return _round_doubles(st.mean_of_numerics(rows, "agePossession"))


_AGES = ["Moderately Old", "New Property", "Old Property", "Relatively New", "Undefined"]


@query(
    "a06_crosstab",
    over("units", "SELECT property_type, " + ", ".join(f"count(*) FILTER (WHERE agePossession = '{a}') AS \"{a}\"" for a in _AGES) + " FROM units GROUP BY property_type"),
)
def a06(spark, sf):
    return st.crosstab(units(spark, sf), "property_type", "agePossession", _AGES)


@query(
    "a07_pivot_mean",
    over("units", "SELECT property_type, " + ", ".join(f'round(avg(price) FILTER (WHERE furnishing_type = {i}), 6) AS "{i}"' for i in range(3)) + " FROM units GROUP BY property_type"),
)
def a07(spark, sf):
    return _round_doubles(st.pivot_mean(units(spark, sf), "property_type", "furnishing_type", "price", [0, 1, 2]))


_DESCRIBED = ["price", "sqft", "lot_size", "bedrooms", "bathrooms", "year_built"]


@query(
    "a08_describe",
    over(
        "listings",
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, round(min({c}), 4) AS min, round(quantile_cont({c}, 0.01), 4) AS p1,
            round(quantile_cont({c}, 0.25), 4) AS p25, round(median({c}), 4) AS p50, round(quantile_cont({c}, 0.75), 4) AS p75, round(quantile_cont({c}, 0.99), 4) AS p99, round(max({c}), 4) AS max,
            round(skewness({c}), 6) AS skew, round(kurtosis({c}), 6) AS kurtosis FROM listings"""
            for c in _DESCRIBED
        ),
    ),
)
def a08(spark, sf):
    found = st.describe(listings(spark, sf), _DESCRIBED, (0.01, 0.25, 0.5, 0.75, 0.99))
    return rounded(_round_doubles(found.drop("skew", "kurtosis"), 4).join(found.select("column", "skew", "kurtosis"), "column"), {"skew": 6, "kurtosis": 6})


@query(
    "a09_skew_kurtosis",
    over("listings", """SELECT location, round(skewness(price), 6) AS skew, round(kurtosis(price), 6) AS kurtosis, round(skewness(ln(1 + price)), 6) AS log_skew FROM listings GROUP BY location"""),
)
def a09(spark, sf):
    rows = listings(spark, sf).withColumn("log_price", F.log1p("price"))
    return rows.groupBy("location").agg(
        r(st.skew("price")).alias("skew"), r(st.kurt("price")).alias("kurtosis"), r(st.skew("log_price")).alias("log_skew")
    )


@query(
    "a10_quantiles",
    over("units", """SELECT unnest([0.01, 0.05, 0.95, 0.99]::DOUBLE[]) AS prob, round(unnest(quantile_cont(area / "bedRoom", [0.01, 0.05, 0.95, 0.99])), 6) AS value FROM units WHERE price_per_sqft <= 20000"""),
)
def a10(spark, sf):
    rows = units(spark, sf).where("price_per_sqft <= 20000").withColumn("room", F.col("area") / F.col("bedRoom"))
    return rounded(st.quantile_table(rows, "room", [0.01, 0.05, 0.95, 0.99]), {"value": 6})


@query(
    "a10_grouped_quantiles",
    over("listings", "SELECT location, property_type, round(quantile_cont(price, 0.1), 4) AS p10, round(quantile_cont(price, 0.9), 4) AS p90 FROM listings GROUP BY location, property_type"),
)
def a10_grouped(spark, sf):
    q = quantiles(listings(spark, sf), ["price"], [0.1, 0.9], ["location", "property_type"])
    return q.select("location", "property_type", r(F.col("price")[0], 4).alias("p10"), r(F.col("price")[1], 4).alias("p90"))


@query(
    "a11_cut",
    over("units", """, c AS (SELECT CASE WHEN price >= 0 AND price < 1 THEN '0-1' WHEN price >= 1 AND price < 2 THEN '1-2' WHEN price >= 2 AND price < 3 THEN '2-3' WHEN price >= 3 AND price < 5 THEN '3-5'
    WHEN price >= 5 AND price < 10 THEN '5-10' WHEN price >= 10 AND price < 20 THEN '10-20' WHEN price >= 20 AND price < 50 THEN '20-50' END AS band FROM units) SELECT band, count(*) AS n FROM c GROUP BY band"""),
)
def a11(spark, sf):
    return units(spark, sf).groupBy(st.cut("price").alias("band")).agg(F.count(F.lit(1)).alias("n"))


def _hist_sql(c: str, bins: int, by: str | None = None) -> str:
    extra = f", {by}" if by else ""
    return f""", e AS (SELECT min({c}) AS lo, (max({c}) - min({c})) / {bins} AS w FROM listings)
 SELECT bin{extra}, count(*) AS n, round(min(lo) + bin * min(w), 4) AS bin_start, round(min(lo) + (bin + 1) * min(w), 4) AS bin_end
 FROM (SELECT CAST(least(floor(({c} - lo) / w), {bins - 1}) AS INTEGER) AS bin{extra}, lo, w FROM listings, e WHERE {c} IS NOT NULL) GROUP BY bin{extra}"""


@query("a12_histogram", over("listings", _hist_sql("price", 45)))
def a12(spark, sf):
    return _round_doubles(st.histogram(listings(spark, sf), "price", 45), 4)


@query("a12_histogram_by_group", over("listings", _hist_sql("sqft", 60, "property_type")))
def a12_by(spark, sf):
    return _round_doubles(st.histogram(listings(spark, sf), "sqft", 60, "property_type"), 4)


@query(
    "a13_ecdf",
    over("listings", """, c AS (SELECT price, count(*) AS n FROM listings WHERE price IS NOT NULL GROUP BY price)
    SELECT price, n, round(sum(n) OVER (ORDER BY price ROWS UNBOUNDED PRECEDING) / (SELECT count(*) FROM listings), 9) AS ecdf FROM c"""),
)
def a13(spark, sf):
    return rounded(st.ecdf(listings(spark, sf), "price"), {"ecdf": 9})


@query(
    "a14_box_stats",
    over(
        "listings",
        """, q AS (SELECT location, quantile_cont(price, 0.25) AS q1, median(price) AS md, quantile_cont(price, 0.75) AS q3 FROM listings WHERE price IS NOT NULL GROUP BY location),
        j AS (SELECT l.location, price, q1, md, q3, price BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS ok FROM listings l JOIN q ON l.location = q.location WHERE price IS NOT NULL)
        SELECT location, count(*) AS n, round(min(q1), 4) AS q1, round(min(md), 4) AS median, round(min(q3), 4) AS q3, round(min(price) FILTER (WHERE ok), 4) AS whisker_low, round(max(price) FILTER (WHERE ok), 4) AS whisker_high,
        count(*) FILTER (WHERE NOT ok) AS outliers FROM j GROUP BY location""",
    ),
)
def a14(spark, sf):
    return _round_doubles(st.box_stats(listings(spark, sf), "price", "location"), 4)


@query(
    "a15_kde",
    over(
        "listings",
        """, e AS (SELECT min(price) AS lo, max(price) AS hi, (max(price) - min(price)) / 200 AS w, stddev_samp(price) * pow(count(price), -0.2) AS h, count(price) AS n FROM listings),
        b AS (SELECT ((lo + bin * w) + (lo + (bin + 1) * w)) / 2 AS mid, c FROM (SELECT CAST(least(floor((price - lo) / w), 199) AS INTEGER) AS bin, min(lo) AS lo, min(w) AS w, count(*) AS c FROM listings, e WHERE price IS NOT NULL GROUP BY 1)),
        g AS (SELECT lo + i * ((hi - lo) / 49) AS x, h, n FROM e, range(50) t(i))
        SELECT round(x, 4) AS x, round(sum(c * exp(-((x - mid) / h) * ((x - mid) / h) / 2) / sqrt(2 * pi())) / (min(n) * min(h)) * 1e6, 6) AS density FROM g, b GROUP BY x""",
    ),
)
def a15(spark, sf):
    return st.kde(listings(spark, sf), "price").select(r("x", 4).alias("x"), r(F.col("density") * 1e6).alias("density"))


@query(
    "a16_group_bars",
    over("units", 'SELECT property_type, round(median(price), 6) AS median_price, round(avg("floorNum"), 6) AS mean_floor, round(median(built_up_area), 6) AS median_built_up FROM units GROUP BY property_type'),
)
def a16(spark, sf):
    aggs = {"median_price": ("price", "median"), "mean_floor": ("floorNum", "mean"), "median_built_up": ("built_up_area", "median")}
    return _round_doubles(st.group_summary(units(spark, sf), ["property_type"], aggs))


_FACTS = ["price", "location", "listing_url", "description", "state"]


@query(
    "a17_column_facts",
    over(
        "listings",
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_unique, round(count(DISTINCT {c}) / count(*), 9) AS unique_rate, round(avg(CASE WHEN {c} IS NULL THEN 1.0::DOUBLE ELSE 0 END), 9) AS missing_rate FROM listings"
            for c in _FACTS
        ),
    ),
)
def a17(spark, sf):
    return _round_doubles(st.column_facts(listings(spark, sf), _FACTS), 9)


# relations -----------------------------------------------------------------------------------------------

_CORR = ["price", "sqft", "lot_size", "bedrooms", "year_built", "flat"]


@query(
    "a18_corr_matrix",
    over(
        "listings",
        ", t AS (SELECT *, 1.0::DOUBLE AS flat FROM listings) "
        + " UNION ALL ".join(
            f"SELECT '{a}' AS a, '{b}' AS b, "
            + ("CAST(max(NULL) AS DOUBLE)" if "flat" in (a, b) else f"round(corr({a}, {b}), 6)")
            + " AS corr FROM t"
            for a in _CORR
            for b in _CORR
        ),
    ),
)
def a18(spark, sf):
    return rounded(st.corr_matrix(listings(spark, sf).withColumn("flat", F.lit(1.0)), _CORR), {"corr": 6})


_WITH = ["sqft", "lot_size", "bedrooms", "bathrooms", "year_built"]


@query(
    "a19_corr_with_target",
    over("listings", " UNION ALL ".join(f"SELECT '{c}' AS feature, round(corr({c}, price), 6) AS corr FROM listings" for c in _WITH)),
)
def a19(spark, sf):
    return rounded(st.corr_with(listings(spark, sf), "price", _WITH), {"corr": 6})


@query(
    "a20_rank_correlation",
    over(
        "listings",
        " UNION ALL ".join(
            f"""SELECT '{c}' AS feature, round(corr(price, {c}), 6) AS pearson, round(corr(rx, ry), 6) AS spearman FROM (
            SELECT price, {c}, rank() OVER (ORDER BY price) + (count(*) OVER (PARTITION BY price) - 1) / 2 AS rx, rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2 AS ry
            FROM listings WHERE price IS NOT NULL AND {c} IS NOT NULL)"""
            for c in _WITH
        ),
    ),
)
def a20(spark, sf):
    return rounded(st.rank_correlation(listings(spark, sf), "price", _WITH), {"pearson": 6, "spearman": 6})


@query(
    "a21_ols_trend",
    over("listings", "SELECT round(regr_slope(price, sqft), 6) AS slope, round(regr_intercept(price, sqft), 4) AS intercept, round(regr_r2(price, sqft), 9) AS r2, CAST(regr_count(price, sqft) AS BIGINT) AS n FROM listings"),
)
def a21(spark, sf):
    return rounded(st.ols_trend(listings(spark, sf), "sqft", "price"), {"slope": 6, "intercept": 4, "r2": 9})


_QQ = [(i + 0.5) / 19 for i in range(19)]


@query(
    "a22_qq_table",
    over(
        "listings",
        f", p(prob, z) AS (VALUES {', '.join(f'({p!r}::DOUBLE, {NormalDist().inv_cdf(p)!r}::DOUBLE)' for p in _QQ)}), v AS (SELECT unnest({_QQ!r}::DOUBLE[]) AS prob, unnest(quantile_cont(ln(1 + price), {_QQ!r}::DOUBLE[])) AS value FROM listings)"
        " SELECT round(p.prob, 9) AS prob, round(z, 9) AS z, round(value, 6) AS value FROM p JOIN v ON p.prob = v.prob",
    ),
)
def a22(spark, sf):
    table_ = st.qq_table(listings(spark, sf).withColumn("log_price", F.log1p("price")), "log_price")
    return rounded(table_, {"prob": 9, "z": 9, "value": 6})


@query(
    "a23_lineage_summary",
    over("listings", "SELECT data_tier, count(*) AS rows, round(median(price), 4) AS median_price, round(median(sqft), 4) AS median_sqft FROM listings GROUP BY data_tier"),
)
def a23(spark, sf):
    return _round_doubles(st.lineage_summary(listings(spark, sf)), 4)


@query(
    "a24_top_zips",
    over("listings", r"SELECT regexp_replace(zipcode, '\.0$', '') AS zipcode, count(*) AS listings, round(median(price), 4) AS median_price FROM listings GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 25"),
)
def a24(spark, sf):
    return _round_doubles(st.top_zips(listings(spark, sf)), 4)


@query(
    "a25_sector_means",
    over("units", r"SELECT sector, round(avg(price), 6) AS price, CAST(regexp_extract(sector, '(\d+)', 1) AS DOUBLE) AS sector_number FROM units WHERE sector IS NOT NULL GROUP BY sector"),
)
def a25(spark, sf):
    return rounded(st.sector_means(units(spark, sf), "price"), {"price": 6})


_STOP = ["the", "and", "of", "to", "in", "is", "it", "on", "by", "with", "are", "der", "die", "und", "le", "la", "les", "de", "des", "et"]


@query(
    "a26_token_counts",
    f"""WITH t AS (SELECT unnest(regexp_extract_all(lower(text), '[a-z0-9_][a-z0-9_'']*')) AS token FROM documents)
    SELECT token, count(*) AS count FROM t WHERE token NOT IN ({', '.join(f"'{w}'" for w in _STOP)}) GROUP BY token ORDER BY count DESC, token LIMIT 200""",
)
def a26(spark, sf):
    return st.token_counts(table(spark, sf, "documents"), "text", 200, _STOP)


@query(
    "a27_stage_summary",
    over("listings", f""", d AS ({dedupe_sql('listings', ['address', 'price'])}) SELECT 'raw' AS stage, count(*) AS rows, 18 AS cols FROM listings UNION ALL SELECT 'deduped', count(*), 18 FROM d
    UNION ALL SELECT 'complete', count(*), 18 FROM d WHERE price IS NOT NULL AND sqft IS NOT NULL AND bedrooms IS NOT NULL"""),
)
def a27(spark, sf):
    raw = listings(spark, sf)
    deduped = dd.dedupe_listings(raw)
    stages = {"raw": raw, "deduped": deduped, "complete": require(deduped)}
    return st.stage_summary(stages).withColumn("cols", F.col("cols") + 18 - len(raw.columns))


@query(
    "a28_binned_scatter",
    over(
        "listings",
        """, t AS (SELECT * FROM listings WHERE sqft IS NOT NULL AND price IS NOT NULL), e AS (SELECT min(sqft) AS x0, (max(sqft) - min(sqft)) / 30 AS wx, min(price) AS y0, (max(price) - min(price)) / 30 AS wy FROM t)
        SELECT CAST(least(floor((sqft - x0) / wx), 29) AS INTEGER) AS x_bin, CAST(least(floor((price - y0) / wy), 29) AS INTEGER) AS y_bin, count(*) AS n FROM t, e GROUP BY 1, 2""",
    ),
)
def a28(spark, sf):
    return st.binned_2d(listings(spark, sf), "sqft", "price")


@query(
    "a28_complete_cases",
    over("listings", "SELECT price, sqft, bedrooms, bathrooms, property_type FROM listings WHERE price IS NOT NULL AND sqft IS NOT NULL AND bedrooms IS NOT NULL AND bathrooms IS NOT NULL"),
)
def a28_rows(spark, sf):
    return st.complete_cases(listings(spark, sf), ["price", "sqft", "bedrooms", "bathrooms"], ["property_type"])


# quality -------------------------------------------------------------------------------------------------

_PROFILED = ["price", "sqft", "bedrooms", "location", "description", "state", "listing_url"]
_TEXTS = ["location", "description", "state", "listing_url"]


def _profile_sql(c: str) -> str:
    dtype = "string" if c in _TEXTS else "double"
    if c in _TEXTS:
        tops = f"(SELECT string_agg(k || ':' || CAST(n AS STRING), '; ' ORDER BY n DESC, k) FROM (SELECT coalesce({c}, 'nan') AS k, count(*) AS n FROM listings GROUP BY 1 ORDER BY n DESC, k LIMIT 3))"
        tail = f"CAST(NULL AS DOUBLE) AS p01, CAST(NULL AS DOUBLE) AS p50, CAST(NULL AS DOUBLE) AS p99, CAST(NULL AS DOUBLE) AS skew, {tops} AS top_values"
    else:
        tail = f"round(quantile_cont({c}, 0.01), 4) AS p01, round(median({c}), 4) AS p50, round(quantile_cont({c}, 0.99), 4) AS p99, round(skewness({c}), 4) AS skew, CAST(NULL AS STRING) AS top_values"
    return f"""SELECT '{c}' AS "column", '{dtype}' AS dtype, round(avg(CASE WHEN {c} IS NULL THEN 1.0::DOUBLE ELSE 0 END), 9) AS missing_rate, count(DISTINCT {c}) AS n_unique,
 round(count(DISTINCT {c}) / count(*), 9) AS unique_rate, {tail} FROM listings"""


@query("q01_profile_columns", over("listings", " UNION ALL ".join(_profile_sql(c) for c in _PROFILED)))
def q01(spark, sf):
    found = pf.profile_columns(listings(spark, sf).select(*_PROFILED))
    return rounded(found, {"missing_rate": 9, "unique_rate": 9, "p01": 4, "p50": 4, "p99": 4, "skew": 4})


def _merged_sql(c: str) -> str:
    skew = "CAST(NULL AS DOUBLE)" if c in _TEXTS else f"round(skewness({c}), 4)"
    tops = f"(SELECT string_agg(k || ':' || CAST(n AS STRING), '; ' ORDER BY n DESC, k) FROM (SELECT coalesce({c}, 'nan') AS k, count(*) AS n FROM listings GROUP BY 1 ORDER BY n DESC, k LIMIT 3))"
    shown = tops if c in ("location", "description", "state") else "CAST(NULL AS STRING)"
    return f"""SELECT '{c}' AS "column", round(avg(CASE WHEN {c} IS NULL THEN 1.0::DOUBLE ELSE 0 END), 9) AS missing_rate, {skew} AS skew, {shown} AS top_values FROM listings"""


@query("q01_profile_merged", over("listings", " UNION ALL ".join(_merged_sql(c) for c in _PROFILED)))
def q01_merged(spark, sf):
    # two rounds of files into one store; percentiles and distinct counts have bounds, which the tests check
    store = f"{shared_folder(spark, 'sketches')}/store"
    rows = listings(spark, sf).select("source_file", *_PROFILED)
    sk.append_sketches(rows.where(F.col("source_file") < "export_2"), store)
    sk.append_sketches(rows, store)
    # url counters are estimates: the column has more values than counters
    shown = F.when(F.col("column").isin("location", "description", "state"), F.col("top_values"))
    found = sk.stored_profile(spark, store).select("column", "missing_rate", "skew", shown.alias("top_values"))
    return rounded(found, {"missing_rate": 9, "skew": 4})


def _members_sql(keys: str, where: str = "true") -> str:
    return f"(SELECT CAST(coalesce(sum(CASE WHEN n > 1 THEN n ELSE 0 END), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM listings WHERE {where} GROUP BY {keys}))"


def _extras_sql(keys: str, where: str = "true") -> str:
    return f"(SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM listings WHERE {where} GROUP BY {keys}))"


_VALID_URL = "coalesce(trim(listing_url), '') NOT IN ('', 'nan', 'None')"
_SIGN = "address, price, sqft, bedrooms, bathrooms, zipcode"


@query(
    "q02_duplicate_report",
    over(
        "listings",
        f"""SELECT 'listing_url' AS "check", {_members_sql('listing_url', _VALID_URL)} AS members, {_extras_sql('listing_url', _VALID_URL)} AS extras
        UNION ALL SELECT 'address_price', {_members_sql('address, price')}, {_extras_sql('address, price')} UNION ALL SELECT 'signature', {_members_sql(_SIGN)}, {_extras_sql(_SIGN)}""",
    ),
)
def q02(spark, sf):
    return dd.duplicate_report(listings(spark, sf))


# every listing appears again with a shifted id when its id is divisible by five
_REPEATED = "SELECT * FROM listings UNION ALL SELECT * REPLACE (listing_id + 100000000 AS listing_id) FROM listings WHERE listing_id % 5 = 0"


@query(
    "q02_duplicate_sample",
    over(
        "listings",
        f""", t AS ({_REPEATED}), d AS (SELECT listing_id, {_SIGN}, count(*) OVER (PARTITION BY {_SIGN}) AS n FROM t)
        SELECT listing_id, {_SIGN} FROM d WHERE n > 1 ORDER BY listing_id LIMIT 200""",
    ),
)
def q02_sample(spark, sf):
    rows = listings(spark, sf)
    again = rows.where("listing_id % 5 = 0").withColumn("listing_id", F.col("listing_id") + 100_000_000)
    return dd.duplicate_sample(rows.unionByName(again), "listing_id")


_MISSING = ["price", "sqft", "lot_size", "year_built", "latitude", "property_type", "listing_url", "description"]


@query(
    "q03_quality_summary",
    over(
        "listings",
        ", f AS ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS c, avg(CASE WHEN {c} IS NULL THEN 1.0::DOUBLE ELSE 0 END) AS m, count(DISTINCT {c}) / count(*) AS u FROM listings"
            for c in ["listing_id", *_MISSING, "address", "zipcode", "bedrooms", "bathrooms"]
        )
        + f""") SELECT (SELECT count(*) FROM listings) AS rows, 13 AS columns, (SELECT coalesce(string_agg(c, ',' ORDER BY c), '') FROM f WHERE m > 0.2) AS missing_columns, (SELECT coalesce(string_agg(c, ',' ORDER BY c), '') FROM f WHERE u > 0.8) AS high_cardinality_columns,
        {_members_sql('listing_url', _VALID_URL)} AS duplicate_listing_url_rows, {_members_sql('address, price')} AS duplicate_address_price_rows, {_members_sql(_SIGN)} AS duplicate_signature_rows""",
    ),
)
def q03(spark, sf):
    cols = ["listing_id", *_MISSING, "address", "zipcode", "bedrooms", "bathrooms"]
    return pf.quality_summary(listings(spark, sf).select(*cols))


@query(
    "q04_missing_pattern",
    over(
        "listings",
        "SELECT " + " || ".join(f"CASE WHEN {c} IS NULL THEN '1' ELSE '0' END" for c in _MISSING) + " AS pattern, count(*) AS n FROM listings GROUP BY 1",
    ),
)
def q04(spark, sf):
    return pf.missing_pattern(listings(spark, sf), _MISSING)
