"""Data-quality profile of a whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acrewise.operators import sketches
from acrewise.operators.dedupe import duplicate_report
from acrewise.operators.stats import skew
from acrewise.scale import quantiles


def profile_columns(df: DataFrame, approx: bool = False) -> DataFrame:
    """One row per column: type, missing rate, distinct values, percentiles and skew or the top values.

    ``approx=True`` takes percentiles, distinct counts and top values from the mergeable sketches of one aggregate, within
    the bounds that ``sketches`` states; rates and skew stay exact.

    All columns share one aggregate for rates and moments and one (column, value) count for distinct and
    top values; map-side counting collapses frequent values before the shuffle.
    """
    if approx:
        return sketches.profile(sketches.column_sketches(df, by=()))
    fields = list(df.schema.fields)
    numeric = [f.name for f in fields if isinstance(f.dataType, (T.NumericType, T.BooleanType))]
    texts = [f.name for f in fields if f.name not in numeric]
    as_number = {c: F.col(c).cast("int").cast("double") if _is_bool(df, c) else F.col(c).cast("double") for c in numeric}

    basics = []
    for f in fields:
        moment = F.when(F.count(f.name) > 2, skew(as_number[f.name])) if f.name in numeric else F.lit(None)
        basics.append(
            F.struct(
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("dtype"),
                F.count(F.lit(1)).alias("rows"),
                F.avg(F.col(f.name).isNull().cast("double")).alias("missing_rate"),
                moment.cast("double").alias("skew"),
            )
        )
    basics = df.agg(F.array(*basics).alias("b")).select(F.inline("b"))

    cells = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(f.name).alias("column"), F.col(f.name).cast("string").alias("value")) for f in fields])
        ).alias("e")
    )
    counts = cells.groupBy(F.col("e.column").alias("column"), F.col("e.value").alias("value")).agg(
        F.count(F.lit(1)).alias("n")
    )
    # both branches use `n` and all columns, so Spark computes and shuffles the counts once
    uniques = counts.groupBy("column").agg(F.count_if(F.col("value").isNotNull() & (F.col("n") > 0)).alias("n_unique"))
    # rank <= 3 is pushed below the shuffle, so each task sends three rows per column
    label = F.coalesce(F.col("value"), F.lit("nan"))
    by_count = Window.partitionBy("column").orderBy(F.desc("n"), label)
    top = counts.withColumn("rank", F.row_number().over(by_count)).where("rank <= 3")
    entry = F.struct("rank", F.concat(label, F.lit(":"), F.col("n").cast("string")).alias("text"))
    top = top.groupBy("column").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["text"]), "; ").alias("top_values")
    )

    out = basics.join(uniques, "column", "left").join(top, "column", "left")
    if numeric:
        wide = quantiles(df.select(*[as_number[c].alias(c) for c in numeric]), numeric, [0.01, 0.5, 0.99])
        marks = [F.struct(F.lit(c).alias("column"), F.col(c).alias("q")) for c in numeric]
        long = wide.select(F.inline(F.array(*marks)))
        out = out.join(long, "column", "left")
    else:
        out = out.withColumn("q", F.lit(None).cast("array<double>"))
    return out.select(
        "column",
        "dtype",
        "missing_rate",
        F.coalesce("n_unique", F.lit(0)).alias("n_unique"),
        F.try_divide(F.coalesce("n_unique", F.lit(0)), F.greatest("rows", F.lit(1))).alias("unique_rate"),
        F.get("q", F.lit(0)).alias("p01"),
        F.get("q", F.lit(1)).alias("p50"),
        F.get("q", F.lit(2)).alias("p99"),
        "skew",
        F.when(F.col("column").isin(texts), F.col("top_values")).alias("top_values"),
    ).orderBy(F.desc("missing_rate"), F.desc("unique_rate"), "column")


def _is_bool(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, T.BooleanType)


def quality_summary(df: DataFrame, missing_over: float = 0.2, unique_over: float = 0.8) -> DataFrame:
    """Row and column count, columns past the missing and unique limits, and duplicate counts; one row."""
    facts = profile_columns(df)

    def names(cond: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_list(F.when(cond, F.col("column")))), ",")

    flags = facts.agg(
        names(F.col("missing_rate") > missing_over).alias("missing_columns"),
        names(F.col("unique_rate") > unique_over).alias("high_cardinality_columns"),
    )
    duplicates = duplicate_report(df).agg(
        *[
            F.max(F.when(F.col("check") == name, F.col("members"))).alias(f"duplicate_{name}_rows")
            for name in ("listing_url", "address_price", "signature")
        ]
    )
    size = df.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).alias("columns"))
    # three one-row tables side by side
    keyed = [t.withColumn("__k", F.lit(0)) for t in (size, flags, duplicates)]
    return keyed[0].join(keyed[1], "__k").join(keyed[2], "__k").drop("__k")


def missing_pattern(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows per combination of missing key columns; the pattern has one digit per column, 1 for missing."""
    digits = F.concat(*[F.col(c).isNull().cast("int").cast("string") for c in cols])
    return df.groupBy(digits.alias("pattern")).agg(F.count(F.lit(1)).alias("n"))
