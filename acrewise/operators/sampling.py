"""Ordering, top-k, repeatable sampling and splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_k(df: DataFrame, col: str, k: int, key: str, ascending: bool = False) -> DataFrame:
    """First ``k`` rows by ``col``; ties by ``key``."""
    return df.orderBy(F.asc(col) if ascending else F.desc(col), key).limit(k)


def hash_order(key: str, seed: int) -> Column:
    return F.xxhash64(F.col(key), F.lit(seed))


def sample_n(df: DataFrame, n: int, seed: int, key: str) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, the same ones whatever the partitioning."""
    return df.orderBy(hash_order(key, seed), key).limit(n)


def shuffled(df: DataFrame, seed: int, key: str) -> DataFrame:
    return df.orderBy(hash_order(key, seed), key)


def hash_split(df: DataFrame, key: str, test: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Train and test part; membership depends on the key only."""
    bucket = F.pmod(hash_order(key, seed), F.lit(10_000))
    cut = int(round(test * 10_000))
    return df.where(bucket >= cut), df.where(bucket < cut)


def hash_folds(df: DataFrame, key: str, k: int = 5, seed: int = 42, out: str = "fold") -> DataFrame:
    return df.withColumn(out, F.pmod(hash_order(key, seed), F.lit(k)).cast("int"))


def concat_tables(*frames: DataFrame) -> DataFrame:
    """Stack tables by column name; columns missing on one side are NULL there."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def uniform(key: Column, seed: int, stream: int) -> Column:
    """Deterministic uniform number in (0, 1) per key."""
    mantissa = F.shiftrightunsigned(F.xxhash64(key, F.lit(seed), F.lit(stream)), 11)
    return (mantissa.cast("double") + 0.5) / float(1 << 53)


def gaussian(key: Column, seed: int, stream: int) -> Column:
    """Deterministic standard normal number per key (Box-Muller on two hashes)."""
    u, v = uniform(key, seed, 2 * stream), uniform(key, seed, 2 * stream + 1)
    return F.sqrt(-2 * F.log(u)) * F.cos(2 * F.pi() * v)
