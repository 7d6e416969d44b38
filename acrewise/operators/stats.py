"""Descriptive and relational statistics. Every table here is aggregate-sized, never row-sized."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acrewise.functions.text import fix_zip, sector_number
from acrewise.operators import sketches
from acrewise.operators.filters import top_categories
from acrewise.scale import lookup_join, quantile_values, quantiles, running_sum, stage

# Price bands, lower edge included.
PRICE_EDGES = [0, 1, 2, 3, 5, 10, 20, 50]

# Frequency bands as (label, lowest count, highest count).
FREQUENCY_BANDS = [
    ("Very High (>100)", 101, None),
    ("High (50-100)", 50, 100),
    ("Average (10-49)", 10, 49),
    ("Low (2-9)", 2, 9),
    ("Very Low (1)", 1, 1),
]


# counts and shares ---------------------------------------------------------------------------------------


def value_counts(
    df: DataFrame, col: str, n: int | None = None, share: bool = False, fill: str | None = None
) -> DataFrame:
    """Frequency of each value, missing values left out unless ``fill`` names them."""
    rows = df.withColumn(col, F.coalesce(F.col(col), F.lit(fill))) if fill is not None else df
    rows = rows.where(F.col(col).isNotNull())
    counts = rows.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    if share:
        counts = counts.withColumn("share", F.try_divide(F.col("count"), F.lit(rows.count())))
    return counts.orderBy(F.desc("count"), col).limit(n) if n else counts


def cumulative_share(df: DataFrame, col: str, exclude: str | None = None, n: int | None = None) -> DataFrame:
    """Running share of the value counts, most frequent first."""
    rows = df.where(F.col(col).isNotNull())
    if exclude is not None:
        rows = rows.where(F.col(col) != exclude)
    counts = rows.groupBy(col).agg(F.count(F.lit(1)).alias("count")).withColumn("__neg", -F.col("count"))
    total = rows.count()
    out = running_sum(counts, "count", ["__neg", col], "__cum")
    out = out.withColumn("cumulative_share", F.col("__cum") / F.lit(total))
    if n is not None:
        out = out.orderBy("__neg", col).limit(n)
    return out.select(col, "count", "cumulative_share")


def frequency_bins(df: DataFrame, col: str) -> DataFrame:
    """How many values fall in each frequency band."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    per_band = []
    for label, lo, hi in FREQUENCY_BANDS:
        inside = F.col("n") >= lo if hi is None else F.col("n").between(lo, hi)
        per_band.append(F.struct(F.lit(label).alias("band"), F.count_if(inside).alias("values")))
    return counts.agg(F.array(*per_band).alias("b")).select(F.inline("b"))


def group_summary(
    df: DataFrame, keys: list[str], aggs: dict[str, tuple[str, str]], keep_null: bool = False
) -> DataFrame:
    """Aggregates per group; ``aggs`` maps output name to (column, one of mean/median/size/count/sum/min/max)."""
    rows = df if keep_null else df.dropna(subset=keys)
    plain = {
        "mean": F.avg,
        "count": F.count,
        "sum": F.sum,
        "min": F.min,
        "max": F.max,
        "size": lambda c: F.count(F.lit(1)),
    }
    cols = [plain[fn](c).alias(out) for out, (c, fn) in aggs.items() if fn != "median"]
    mids = {out: c for out, (c, fn) in aggs.items() if fn == "median"}
    if not mids:
        return rows.groupBy(*keys).agg(*cols)
    found = quantiles(rows.select(*keys, *[F.col(c).alias(out) for out, c in mids.items()]), list(mids), [0.5], keys)
    found = found.withColumns({out: F.col(out)[0] for out in mids})
    if not cols:
        return found
    return lookup_join(rows.groupBy(*keys).agg(*cols), found, keys, null_safe=True).select(*keys, *aggs)


def mean_of_numerics(df: DataFrame, key: str) -> DataFrame:
    """Mean of every numeric column per group."""
    numeric = [c for c, t in df.dtypes if t in ("double", "float", "int", "bigint", "smallint", "tinyint") and c != key]
    return df.dropna(subset=[key]).groupBy(key).agg(*[F.avg(c).alias(c) for c in numeric])


def crosstab(df: DataFrame, a: str, b: str, values: list | None = None) -> DataFrame:
    """Counts per (a, b); rows with a missing key are dropped.

    Long rows (a, b, count) of the pairs that occur, whose number may grow with the data. With ``values`` of ``b`` given, a
    wide table of these columns, 0 where a pair does not occur.
    """
    rows = df.dropna(subset=[a, b])
    if values is None:
        return rows.groupBy(a, b).agg(F.count(F.lit(1)).alias("count"))
    return rows.groupBy(a).pivot(b, values).agg(F.count(F.lit(1))).fillna(0)


def pivot_mean(df: DataFrame, a: str, b: str, v: str, values: list | None = None) -> DataFrame:
    """Mean of ``v`` per (a, b): long rows (a, b, mean), or a wide table of the ``values`` of ``b``, NULL where a pair does not occur."""
    rows = df.dropna(subset=[a, b])
    if values is None:
        return rows.groupBy(a, b).agg(F.avg(v).alias("mean"))
    return rows.groupBy(a).pivot(b, values).agg(F.avg(v))


# distribution shape --------------------------------------------------------------------------------------


def skew(c: Column | str) -> Column:
    """Bias-corrected skewness; 0 for a constant column, NULL below three values."""
    n = F.count(c).cast("double")
    adjusted = F.skewness(c) * F.try_divide(F.sqrt(n * F.greatest(n - 1, F.lit(0.0))), n - 2)
    return F.when(n >= 3, F.coalesce(F.nanvl(adjusted, F.lit(0.0)), F.lit(0.0)))


def kurt(c: Column | str) -> Column:
    """Bias-corrected excess kurtosis; 0 for a constant column, NULL below four values."""
    n = F.count(c).cast("double")
    adjusted = F.try_divide((n - 1) * ((n + 1) * F.kurtosis(c) + 6), (n - 2) * (n - 3))
    constant = F.min(c) == F.max(c)
    return F.when(n >= 4, F.when(constant, F.lit(0.0)).otherwise(adjusted))


def describe(
    df: DataFrame, cols: list[str], percentiles: tuple[float, ...] = (0.25, 0.5, 0.75), approx: bool = False
) -> DataFrame:
    """Count, mean, sample deviation, range, percentiles, skew and kurtosis; one row per column.

    ``approx=True`` takes the percentiles from a sketch (rank error ``sketches.RANK_ERROR``), so that one pass is enough.
    """
    probs = list(percentiles)
    found = {} if approx else quantile_values(df, cols, probs)
    rows = []
    for c in cols:
        if approx:
            sketch = F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(sketches.QUANTILE_K))
            values = [F.get(sketches.quantile(sketch, probs), F.lit(i)) for i in range(len(probs))]
        else:
            values = [F.lit(v).cast("double") for v in found[c]]
        marks = [v.alias("p" + f"{p * 100:g}".replace(".", "_")) for p, v in zip(probs, values, strict=True)]
        value = F.col(c).cast("double")
        rows.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count(value).alias("count"),
                F.avg(value).alias("mean"),
                F.stddev_samp(value).alias("std"),
                F.min(value).alias("min"),
                *marks,
                F.max(value).alias("max"),
                skew(value).alias("skew"),
                kurt(value).alias("kurtosis"),
            )
        )
    return df.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def quantile_table(df: DataFrame, col: str, probs: list[float]) -> DataFrame:
    found = quantile_values(df, [col], probs)[col]
    return df.sparkSession.createDataFrame(list(zip(probs, found, strict=True)), "prob double, value double")


def cut(c: Column | str, edges: list[float] = PRICE_EDGES, labels: list[str] | None = None) -> Column:
    """Label of the band [a, b) holding the value; NULL outside all bands."""
    value = F.col(c) if isinstance(c, str) else c
    labels = labels or [f"{a}-{b}" for a, b in zip(edges, edges[1:], strict=False)]
    out = F.when(F.lit(False), F.lit(""))
    for (a, b), label in zip(zip(edges, edges[1:], strict=False), labels, strict=True):
        out = out.when((value >= a) & (value < b), F.lit(label))
    return out


def histogram(df: DataFrame, c: str, bins: int, by: str | None = None) -> DataFrame:
    """Equal-width counts between minimum and maximum; the last bin includes the maximum."""
    lo, hi = df.agg(F.min(c).cast("double"), F.max(c).cast("double")).first()
    if lo is None:
        lo = hi = 0.0
    width = (hi - lo) / bins if hi > lo else 1.0
    index = F.least(F.floor((F.col(c) - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    keys = ["bin"] + ([by] if by else [])
    counts = df.where(F.col(c).isNotNull()).withColumn("bin", index).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumns(
        {"bin_start": F.lit(lo) + F.col("bin") * F.lit(width), "bin_end": F.lit(lo) + (F.col("bin") + 1) * F.lit(width)}
    )


def ecdf(df: DataFrame, c: str) -> DataFrame:
    """Share of all rows (missing ones included) at or below each value."""
    total = df.count()
    counts = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n"))
    out = running_sum(counts, "n", [c], "__cum")
    return out.select(c, "n", (F.col("__cum") / F.lit(total)).alias("ecdf"))


def box_stats(df: DataFrame, c: str, by: str, k: float = 1.5) -> DataFrame:
    """Quartiles, whiskers inside the k-IQR fences and outlier count per group."""
    rows = df.where(F.col(by).isNotNull() & F.col(c).isNotNull())
    q = quantiles(rows, [c], [0.25, 0.5, 0.75], [by]).select(
        by, F.col(c)[0].alias("q1"), F.col(c)[1].alias("median"), F.col(c)[2].alias("q3")
    )
    joined = lookup_join(rows.select(by, c), q, [by])
    reach = k * (F.col("q3") - F.col("q1"))
    inside = F.col(c).between(F.col("q1") - reach, F.col("q3") + reach)
    return joined.groupBy(by).agg(
        F.count(F.lit(1)).alias("n"),
        F.first("q1").alias("q1"),
        F.first("median").alias("median"),
        F.first("q3").alias("q3"),
        F.min(F.when(inside, F.col(c))).alias("whisker_low"),
        F.max(F.when(inside, F.col(c))).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )


def kde(df: DataFrame, c: str, grid: int = 50, bins: int = 200) -> DataFrame:
    """Gaussian density on an even grid, from histogram bins, with Scott's bandwidth."""
    n, sd, lo, hi = df.agg(
        F.count(c), F.stddev_samp(c), F.min(c).cast("double"), F.max(c).cast("double")
    ).first()
    if not n or n < 2 or not sd:
        return df.sparkSession.createDataFrame([], "x double, density double")
    h = sd * n ** (-0.2)
    step = (hi - lo) / (grid - 1)
    centers = histogram(df, c, bins).select(((F.col("bin_start") + F.col("bin_end")) / 2).alias("mid"), "n")
    # at most `bins` rows, each meeting `grid` points
    points = centers.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
    points = points.withColumn("x", F.lit(lo) + F.col("i") * F.lit(step))
    z = (F.col("x") - F.col("mid")) / F.lit(h)
    weight = F.col("n") * F.exp(-z * z / 2) / F.sqrt(2 * F.pi())
    return points.groupBy("i").agg(F.first("x").alias("x"), (F.sum(weight) / F.lit(n * h)).alias("density")).drop("i")


def qq_table(df: DataFrame, c: str, points: int = 19) -> DataFrame:
    """Normal score against the sample quantile on an even probability grid."""
    probs = [(i + 0.5) / points for i in range(points)]
    found = quantile_values(df, [c], probs)[c]
    rows = [(p, NormalDist().inv_cdf(p), v) for p, v in zip(probs, found, strict=True)]
    return df.sparkSession.createDataFrame(rows, "prob double, z double, value double")


def column_facts(df: DataFrame, cols: list[str]) -> DataFrame:
    """Distinct values, unique rate and missing rate per column."""
    facts = [
        F.struct(
            F.lit(c).alias("column"),
            F.count_distinct(F.col(c)).alias("n_unique"),
            F.try_divide(F.count_distinct(F.col(c)), F.count(F.lit(1))).alias("unique_rate"),
            F.avg(F.col(c).isNull().cast("double")).alias("missing_rate"),
        )
        for c in cols
    ]
    return df.agg(F.array(*facts).alias("f")).select(F.inline("f"))


# relations -----------------------------------------------------------------------------------------------


def pearson(a: str, b: str) -> Column:
    """Correlation over rows that have both values; NULL for a constant column."""
    x, y = F.col(a).cast("double"), F.col(b).cast("double")
    both = x.isNotNull() & y.isNotNull()
    spread = F.stddev_pop(F.when(both, x)) * F.stddev_pop(F.when(both, y))
    return F.try_divide(F.covar_pop(x, y), spread)


def corr_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pairwise-complete Pearson matrix in long form (a, b, corr); one aggregate for all pairs."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    cells = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), pearson(a, b).alias("corr")) for a, b in pairs]
    upper = df.agg(F.array(*cells).alias("c")).select(F.inline("c"))
    both = F.when(
        F.col("a") != F.col("b"),
        F.array(F.struct("a", "b", "corr"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), "corr")),
    ).otherwise(F.array(F.struct("a", "b", "corr")))
    return upper.select(F.inline(both))


def corr_with(df: DataFrame, target: str, cols: list[str], listwise: bool = False, min_rows: int = 0) -> DataFrame:
    """Pearson with the target per column; ``listwise`` uses only rows complete in every column."""
    rows = df.dropna(subset=[target, *cols]) if listwise else df
    cells = [
        F.struct(
            F.lit(c).alias("feature"),
            F.count_if(F.col(c).isNotNull() & F.col(target).isNotNull()).alias("n"),
            pearson(c, target).alias("corr"),
        )
        for c in cols
    ]
    out = rows.agg(F.array(*cells).alias("c")).select(F.inline("c"))
    return out.where(F.col("n") >= min_rows).drop("n")


def _average_ranks(counts: DataFrame, axis: str, out: str) -> DataFrame:
    """Average rank of each value of ``axis`` within its feature, from weighted distinct values."""
    per_value = counts.groupBy("feature", axis).agg(F.sum("w").alias("__w"))
    ranked = running_sum(per_value, "__w", [axis], "__upto", by=["feature"])
    return ranked.select("feature", axis, (F.col("__upto") - (F.col("__w") - 1) / 2).alias(out))


def rank_correlation(df: DataFrame, target: str, cols: list[str], min_rows: int = 0) -> DataFrame:
    """Pearson and Spearman with the target per column (rows with both values), by falling |spearman|; NULL
    where there are no values. ``min_rows`` leaves out columns with fewer rows.

    Equal (value, target) pairs are counted first; ranks come from prefix sums over distinct values, so no
    task ever sorts a whole column.
    """
    pairs = F.explode(
        F.array(
            *[
                F.struct(F.lit(c).alias("feature"), F.col(target).cast("double").alias("x"), F.col(c).cast("double").alias("y"))
                for c in cols
            ]
        )
    )
    counts = stage(
        df.select(pairs.alias("p"))
        .select("p.*")
        .where(F.col("x").isNotNull() & F.col("y").isNotNull())
        .groupBy("feature", "x", "y")
        .agg(F.count(F.lit(1)).alias("w")),
        "pairs",
    )
    ranked = lookup_join(counts, _average_ranks(counts, "x", "rx"), ["feature", "x"], how="inner")
    ranked = lookup_join(ranked, _average_ranks(counts, "y", "ry"), ["feature", "y"], how="inner")
    sizes = counts.groupBy("feature").agg(F.sum("w").alias("n"))
    ranked = lookup_join(ranked, sizes, ["feature"], how="inner")
    dx, dy = F.col("rx") - (F.col("n") + 1) / 2, F.col("ry") - (F.col("n") + 1) / 2
    w = F.col("w")
    spearman = F.try_divide(F.sum(w * dx * dy), F.sqrt(F.sum(w * dx * dx)) * F.sqrt(F.sum(w * dy * dy)))
    out = ranked.groupBy("feature").agg(spearman.alias("spearman"), F.first("n").alias("n"))
    linear = corr_with(df, target, cols).select("feature", F.col("corr").alias("pearson"))
    joined = lookup_join(linear, out, ["feature"]).where(F.coalesce("n", F.lit(0)) >= min_rows)
    return joined.select("feature", "pearson", "spearman").orderBy(F.desc_nulls_last(F.abs("spearman")), "feature")


def ols_trend(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line and R² over all rows with both values."""
    return df.agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
        F.regr_count(y, x).alias("n"),
    )


def complete_cases(df: DataFrame, cols: list[str], extra: list[str] | None = None) -> DataFrame:
    return df.dropna(subset=cols).select(*cols, *(extra or []))


def binned_2d(df: DataFrame, x: str, y: str, bins: int = 30, by: str | None = None) -> DataFrame:
    """Two-dimensional counts of the complete rows, the full-data form of a scatter plot."""
    rows = df.dropna(subset=[x, y])
    x0, x1, y0, y1 = rows.agg(*[f(c).cast("double") for c in (x, y) for f in (F.min, F.max)]).first()

    def index(c: str, lo: float, hi: float) -> Column:
        width = (hi - lo) / bins if hi > lo else 1.0
        return F.least(F.floor((F.col(c) - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")

    if x0 is None:
        x0 = x1 = y0 = y1 = 0.0
    keys = ["x_bin", "y_bin"] + ([by] if by else [])
    placed = rows.withColumns({"x_bin": index(x, x0, x1), "y_bin": index(y, y0, y1)})
    return placed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


# reports -------------------------------------------------------------------------------------------------


def lineage_summary(df: DataFrame) -> DataFrame:
    """Rows and medians per data tier; a missing tier is a group of its own."""
    aggs = {"rows": ("price", "size"), "median_price": ("price", "median"), "median_sqft": ("sqft", "median")}
    return group_summary(df, ["data_tier"], aggs, keep_null=True)


def top_zips(df: DataFrame, n: int = 25) -> DataFrame:
    """Zip codes with the most listings, with their median price.

    The top list is found from counts; medians are computed for those zips only.
    """
    rows = df.select(F.coalesce(fix_zip("zipcode"), F.lit("nan")).alias("zipcode"), "price")
    top = top_categories(rows, "zipcode", n)
    kept = rows.join(F.broadcast(top.select("zipcode")), "zipcode", "left_semi")
    return group_summary(kept, ["zipcode"], {"listings": ("price", "size"), "median_price": ("price", "median")})


def sector_means(df: DataFrame, value: str) -> DataFrame:
    """Mean per sector ordered by the number in its name; unnumbered sectors last."""
    means = df.dropna(subset=["sector"]).groupBy("sector").agg(F.avg(value).alias(value))
    return means.withColumn("sector_number", sector_number("sector")).orderBy("sector_number", "sector")


def token_counts(df: DataFrame, c: str, n: int, stop_words: list[str] | None = None) -> DataFrame:
    """Most frequent words of a text column, stop words left out."""
    words = F.regexp_extract_all(F.lower(F.col(c)), F.lit(r"[a-z0-9_][a-z0-9_']*"), F.lit(0))
    # the outer form keeps Spark from running the regex in a second, repeated filter
    tokens = df.select(F.explode_outer(words).alias("token")).where(F.col("token").isNotNull())
    if stop_words:
        tokens = tokens.where(~F.col("token").isin(stop_words))
    counts = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("count"), "token").limit(n)


def stage_summary(stages: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns of each stage of a job."""
    out = None
    for name, df in stages.items():
        row = df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("stage"), "rows", F.lit(len(df.columns)).alias("cols")
        )
        out = row if out is None else out.unionByName(row)
    return out
