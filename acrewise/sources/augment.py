"""Bootstrap augmentation with repeatable noise."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acrewise.functions.features import clip, round_even
from acrewise.operators.sampling import gaussian, uniform
from acrewise.scale import dense_index, medians


def bootstrap_augment(
    df: DataFrame,
    target_rows: int,
    order: list[str],
    seed: int = 42,
    # fixed values: noise widths
    price_jitter: float = 0.04,
    sqft_jitter: float = 0.05,
    geo_jitter: float = 0.0004,
) -> DataFrame:
    """Add resampled rows with small noise until the table has exactly ``target_rows`` rows.

    ``order`` must tell rows apart; it numbers them for drawing. Draw number, not partition, seeds every
    random choice, so a repeated run gives the same rows.
    """
    n = df.count()
    if n == 0:
        raise ValueError("cannot augment an empty table")
    if n >= target_rows:
        return df.withColumn("is_synthetic_augment", F.lit(False))
    mid = medians(df, ["sqft", "lot_size", "year_built", "bathrooms"])
    draw = F.col("__draw")
    picks = df.sparkSession.range(target_rows - n).withColumnRenamed("id", "__draw")
    picks = picks.withColumn("__ix", F.pmod(F.xxhash64(draw, F.lit(seed)), F.lit(n)))
    drawn = picks.join(dense_index(df, order, "__ix"), "__ix")

    def filled(c: str):
        return F.coalesce(F.col(c), F.lit(mid[c]).cast("double"))

    def factor(sd: float, stream: int):
        return 1 + sd * gaussian(draw, seed, stream)

    shift = F.floor(uniform(draw, seed, 1000) * 7) - 3
    synthetic = drawn.withColumns(
        {
            "price": clip(F.col("price") * factor(price_jitter, 1), 25_000.0, 18_000_000.0),
            "sqft": clip(filled("sqft") * factor(sqft_jitter, 2), 400.0, 12_000.0),
            "lot_size": clip(filled("lot_size") * factor(sqft_jitter, 3), 500.0, 50_000.0),
            "year_built": clip(filled("year_built") + shift, 1920.0, 2026.0),
            "latitude": F.col("latitude") + geo_jitter * gaussian(draw, seed, 4),
            "longitude": F.col("longitude") + geo_jitter * gaussian(draw, seed, 5),
            "bathrooms": round_even(clip(filled("bathrooms") + 0.15 * gaussian(draw, seed, 6), 0.5, 8.0), 1),
            "listing_url": F.lit(None).cast("string"),
            "address": F.concat(F.coalesce("address", F.lit("")), F.lit(" [aug]")),
            "data_tier": F.lit("synthetic_augmented"),
            "is_synthetic_augment": F.lit(True),
        }
    ).drop("__ix", "__draw")
    real = df.withColumn("is_synthetic_augment", F.lit(False))
    return real.unionByName(synthetic, allowMissingColumns=True)
