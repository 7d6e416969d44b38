"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import types

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: white space as the contracts define it (fixed value)
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def slim(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator needs, as ``doc_id`` long and ``text`` (null: empty), whatever else the table holds."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def worker_store(name: str) -> dict:
    """A dict that lives as long as the Python worker, for tables that are dear to build (tokenizers, word caches)."""
    module = sys.modules.setdefault("_acrewise_worker_store", types.ModuleType("_acrewise_worker_store"))
    return module.__dict__.setdefault(name, {})


def bounded_sample(df: DataFrame, key: Column, rows: int) -> DataFrame:
    """About ``rows`` rows chosen by a hash of ``key``, for fits with a documented bound.

    The share is set from the row count and applied in the scan, so that no more than about ``rows`` rows leave the tasks.
    """
    share = min(1.0, rows / max(1, df.count()))
    return df.where(F.pmod(F.xxhash64(key, F.lit(1)), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))


def evaluated(df: DataFrame, cols: dict[str, Column]) -> DataFrame:
    """``df`` plus ``cols``, each computed once for a row.

    A plain projection may be merged into what reads it: the optimizer then repeats an expression in every filter
    on its result, and for each element of a lambda that mentions it. A generator is not merged.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in cols.items()]))))


def most_frequent(counts: DataFrame, n: str, rows: int) -> Column:
    """A condition on ``counts`` that holds for its most frequent rows, at most ``rows`` of them.

    The bound is found on a histogram of the counts in steps of a sixteenth power of two, under 1100 rows however large the table is.
    """
    step = F.floor(F.log2(F.col(n)) * 16).cast("int")
    taken, least = 0, 1 << 30
    for r in counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("step")).collect():
        taken += r["rows"]
        if taken > rows:
            break
        least = r["step"]
    return step >= F.lit(least)
