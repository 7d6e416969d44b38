"""Exact dedup by content sort: sampled splitters range-partition the normalised texts, an external sort places equal
texts next to each other, and the comparison of neighbours keeps the smallest id.

* The splitters are Spark's sampled range bounds over (first characters, 64-bit hash, salt) of the normalised text, so a
  bound stays short however long the texts are, and texts with a common opening still spread.
* Inside a range the rows are sorted by the whole text and id; a window over (..., text) compares whole neighbours.
* A text that alone would fill a range is dealt over several salts. There are fewer such texts than ranges, so the
  table that marks them is broadcast. The representatives of its salts (one row for each) are merged afterwards by digest.

Null text counts as empty. Repeated rows are members of the group like any other; among rows with the smallest id all
but one are dropped only by ``kept`` being true for the id (ids are expected to be unique; with repeated ids every row that
carries the kept id is kept). A null id never represents a group that has another id. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acrewise.llm.common import partitions, slim
from acrewise.scale import stage

#: bytes of text that one range task should sort
RANGE_CHARS = 32


def normalised(text: Column) -> Column:
    """White space runs as one space; only runs that differ from one space are touched."""
    return F.regexp_replace(text, r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    spark = docs.sparkSession
    texts = slim(docs, id_col, text_col).select("doc_id", normalised(F.col("text")).alias("norm"))
    texts = texts.withColumn("hash", F.xxhash64("norm"))

    counted = stage(texts.groupBy("hash").agg(F.count(F.lit(1)).alias("n")), "content-counts")
    total = counted.agg(F.sum("n")).first()[0] or 0
    per_range = total / partitions(spark) + 1
    # more rows than a mean range holds: at most one such text for each range
    hot = counted.where(F.col("n") > F.lit(per_range)).select("hash", F.ceil(2 * F.col("n") / F.lit(per_range)).cast("int").alias("salts"))

    marked = texts.join(F.broadcast(hot), "hash", "left")
    salt = F.when(F.col("salts").isNull(), 0).otherwise(F.pmod(F.xxhash64("doc_id"), F.col("salts")).cast("int"))
    keyed = marked.select("doc_id", "norm", "hash", F.substring("norm", 1, RANGE_CHARS).alias("head"), salt.alias("salt"), F.col("salts").isNotNull().alias("hot"))
    ranged = keyed.repartitionByRange("head", "hash", "salt")
    # the range bounds cover a subset of these keys, so the window adds a sort but no shuffle
    same = Window.partitionBy("head", "hash", "salt", "norm").orderBy(F.asc_nulls_last("doc_id"))
    whole = same.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    runs = ranged.select(
        "doc_id",
        "hot",
        F.sha2("norm", 256).alias("text_sha256"),
        F.first("doc_id").over(whole).alias("keep_id"),
        F.count(F.lit(1)).over(whole).alias("group_size"),
        F.row_number().over(same).alias("at"),
    )
    runs = stage(runs, "content-runs")

    merged = (
        runs.where("hot and at = 1")
        .groupBy("text_sha256")
        .agg(F.min("keep_id").alias("all_keep"), F.sum("group_size").alias("all_size"))
    )
    cold = runs.where("not hot").select("doc_id", "keep_id", "group_size", "text_sha256")
    warm = (
        runs.where("hot")
        .join(F.broadcast(merged), "text_sha256")
        .select("doc_id", F.col("all_keep").alias("keep_id"), F.col("all_size").alias("group_size"), "text_sha256")
    )
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept")
    return cold.unionByName(warm).select("doc_id", "keep_id", "group_size", kept, "text_sha256")
