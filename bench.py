"""Headline queries on one machine; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from acrewise.queries import QUERIES
from acrewise.scale import release
from acrewise.session import build_session

HEADLINE = [
    "a04_market_summary",
    "i06_iqr_sequential",
    "i05_impute_mode_hierarchy",
    "w02_dedupe_url_price_sqft",
    "q01_profile_columns",
    "a20_rank_correlation",
    "e06_tfidf",
    "j07_radius_join",
    "r03_similar_listings",
    "r04_similarity_edges",
    "c02_preprocess",
    "c03_engineer_features",
    "c04_clean_units",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", int(cpus), "bench")
    spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        # the noop sink computes every column, which a count would not
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        release(spark)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    scale = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))


if __name__ == "__main__":
    main()
