"""Table profiles from mergeable sketches: one small row per file and column, so new files are merged, not recomputed.

A stored row holds exact parts (row and value counts, range, central moments) and three sketches:

* quantiles: a KLL sketch of ``QUANTILE_K``; a returned value has a rank within ``RANK_ERROR`` of the asked one;
* distinct values: a HyperLogLog sketch of 2^``DISTINCT_LG`` registers, relative standard error ``DISTINCT_ERROR``;
* frequent texts: the counters of at most ``TOP_ITEMS`` values; exact while a column has fewer than 3/4 of that.

Merging adds no error beyond these bounds. Missing values are in no sketch but count as ``nan`` among the frequent texts; a
column without values has no quantiles and 0 distinct values; an empty table has no stored rows. A row takes up to a few
hundred kilobytes, whatever the size of its file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acrewise.scale import exists, lookup_join

QUANTILE_K, DISTINCT_LG, TOP_ITEMS = 2000, 14, 4096
#: 99 % bounds that the sketches' authors give for these sizes
RANK_ERROR = 2.446 / QUANTILE_K**0.9433
DISTINCT_ERROR = 1.04 / 2 ** (DISTINCT_LG / 2)


def _number(field: T.StructField) -> Column:
    if isinstance(field.dataType, T.BooleanType):
        return F.col(f"`{field.name}`").cast("int").cast("double")
    if isinstance(field.dataType, T.NumericType):
        return F.col(f"`{field.name}`").cast("double")
    return F.lit(None).cast("double")


def _column_row(field: T.StructField) -> Column:
    value, text = _number(field), F.col(f"`{field.name}`").cast("string")
    shown = F.lit(None).cast("string") if isinstance(field.dataType, (T.NumericType, T.BooleanType)) else F.coalesce(text, F.lit("nan"))
    n, spread = F.count(value), F.var_pop(value)
    return F.struct(
        F.lit(field.name).alias("column"),
        F.lit(field.dataType.simpleString()).alias("dtype"),
        F.count(F.lit(1)).alias("rows"),
        F.count(text).alias("present"),
        n.alias("numbers"),
        F.avg(value).alias("mean"),
        (spread * n).alias("m2"),
        (F.coalesce(F.skewness(value), F.lit(0.0)) * n * spread * F.sqrt(spread)).alias("m3"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.kll_sketch_agg_double(value, F.lit(QUANTILE_K)).alias("quantiles"),
        F.hll_sketch_agg(F.concat(F.lit("="), text), DISTINCT_LG).alias("distinct"),  # the sketch takes no empty text
        F.call_function("approx_top_k_accumulate", shown, F.lit(TOP_ITEMS)).alias("top"),
    )


def column_sketches(df: DataFrame, cols: Sequence[str] | None = None, by: Sequence[str] = ("source_file",)) -> DataFrame:
    """One row per ``by`` group and column of ``cols`` (all others by default), in one aggregate combined in the tasks."""
    by = list(by)
    names = [c for c in df.columns if c not in by] if cols is None else list(cols)
    rows = [_column_row(df.schema[c]) for c in names]
    return df.groupBy(*by).agg(F.array(*rows).alias("__rows")).select(*by, F.inline("__rows"))


def append_sketches(df: DataFrame, store: str, cols: Sequence[str] | None = None, by: str = "source_file") -> None:
    """Sketch the files of ``df`` that the table at ``store`` does not have yet, and append them.

    A file is known by its name. Rows without a file name form a file of their own. The known names are settled and counted
    before they are broadcast; the rows of known files are left out before anything is sketched.
    """
    spark = df.sparkSession
    if exists(spark, store):
        known = spark.read.parquet(store).select(F.col(by)).distinct()
        seen = known.withColumn("__known", F.lit(True))
        df = lookup_join(df, seen, [by], null_safe=True).where("__known is null").drop("__known")
    column_sketches(df, cols, (by,)).write.mode("append").parquet(store)


def merged(sketches: DataFrame) -> DataFrame:
    """One row per column from the rows of any number of files; moments are pooled about the common mean."""
    means = sketches.groupBy("column").agg((F.sum(F.col("mean") * F.col("numbers")) / F.sum("numbers")).alias("__all"))
    # as many rows as the table has columns
    parts = sketches.join(F.broadcast(means), "column")
    off, n = F.col("mean") - F.col("__all"), F.col("numbers")
    return parts.groupBy("column").agg(
        F.max("dtype").alias("dtype"),
        F.sum("rows").alias("rows"),
        F.sum("present").alias("present"),
        F.sum("numbers").alias("numbers"),
        F.max("__all").alias("mean"),
        F.sum(F.col("m2") + n * off * off).alias("m2"),
        F.sum(F.col("m3") + 3 * off * F.col("m2") + n * off * off * off).alias("m3"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        F.kll_merge_agg_double("quantiles", F.lit(QUANTILE_K)).alias("quantiles"),
        F.hll_union_agg("distinct").alias("distinct"),
        F.call_function("approx_top_k_combine", F.col("top"), F.lit(TOP_ITEMS)).alias("top"),
    )


def quantile(sketch: Column | str, probs: Sequence[float]) -> Column:
    """Array of values whose ranks are within RANK_ERROR of ``probs``; NULL for a sketch without values."""
    sketch = F.col(sketch) if isinstance(sketch, str) else sketch
    found = F.kll_sketch_get_quantile_double(sketch, F.array(*[F.lit(float(p)) for p in probs]))
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, found)


def profile(sketches: DataFrame) -> DataFrame:
    """The columns of ``profile_columns`` from merged or unmerged sketches."""
    found = merged(sketches)
    n = F.col("numbers").cast("double")
    skew = F.coalesce(F.try_divide(F.col("m3") / n, F.pow(F.col("m2") / n, F.lit(1.5))), F.lit(0.0))
    unique = F.when(F.col("present") > 0, F.least(F.hll_sketch_estimate("distinct"), F.col("present"))).otherwise(F.lit(0))
    # summed counters have no order among ties: largest count first, then by value, as in the exact profile
    best = F.transform(F.call_function("approx_top_k_estimate", F.col("top"), F.lit(100)), lambda e: F.struct((-e["count"]).alias("n"), e["item"].alias("v")))
    shown = F.transform(F.slice(F.array_sort(best), 1, 3), lambda e: F.concat(e["v"], F.lit(":"), (-e["n"]).cast("string")))
    is_text = ~F.col("dtype").rlike("^(boolean|tinyint|smallint|int|bigint|float|double|decimal.*)$")
    facts = found.select(
        "column",
        "dtype",
        (1 - F.try_divide("present", "rows")).alias("missing_rate"),
        unique.cast("bigint").alias("n_unique"),
        F.try_divide(unique, F.greatest("rows", F.lit(1))).alias("unique_rate"),
        quantile("quantiles", [0.01, 0.5, 0.99]).alias("q"),
        F.when(F.col("numbers") > 2, skew * F.sqrt(n * (n - 1)) / (n - 2)).alias("skew"),
        F.when(is_text, F.array_join(shown, "; ")).alias("top_values"),
    )
    marks = [F.get("q", F.lit(i)).alias(name) for i, name in enumerate(("p01", "p50", "p99"))]
    return facts.select("column", "dtype", "missing_rate", "n_unique", "unique_rate", *marks, "skew", "top_values").orderBy(
        F.desc("missing_rate"), F.desc("unique_rate"), "column"
    )


def stored_profile(spark: SparkSession, store: str) -> DataFrame:
    """Profile of every file sketched so far; the files themselves are not read."""
    return profile(spark.read.parquet(store))
