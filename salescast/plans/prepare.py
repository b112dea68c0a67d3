"""Production plan: raw retail files -> features -> star schema on storage.

    python -m salescast.plans.prepare RAW_DIR OUT_DIR

Stages are separated by written tables (the same boundaries the original
pipeline has): the feature table is written once, partitioned by year, and
the star is built from that written table, so a lost executor never sends
Spark back to the raw files.  Facts are written partitioned by year and
sorted by ``date_key`` within files, so date filters prune files and row groups.
"""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

from salescast.operators import star as starmod
from salescast.sources import io


#: Rows of the exported sample.
SAMPLE_ROWS = 10_000


def prepare(spark: SparkSession, raw: dict, out_dir: str, family_to_category=None,
            state_to_region=None) -> starmod.Star:
    root = out_dir.rstrip("/")
    feats = starmod.features(starmod.load_raw(raw))
    io.write_parquet(io.by_year(feats, "date"), f"{root}/features", ["year"])
    feats = spark.read.parquet(f"{root}/features")
    star = starmod.build_star(feats, family_to_category, state_to_region)
    io.write_star(star, f"{root}/star")
    io.write_star_csv(star, f"{root}/csv", feats)
    io.write_csv(io.sample_n(feats, SAMPLE_ROWS, 42, ["date", "store_nbr", "family"]), f"{root}/csv/sample.csv")
    return load_star(spark, f"{root}/star")


def load_star(spark: SparkSession, path: str) -> starmod.Star:
    root = path.rstrip("/")
    t = {}
    for name in ("dim_date", "dim_store", "dim_product", "fact_sales", "fact_forecasts"):
        # facts keep their ``year`` partition column (pruning); only the forecasts may be missing
        t[name] = None if name == "fact_forecasts" and not io.exists(spark, f"{root}/{name}") else spark.read.parquet(f"{root}/{name}")
    return starmod.Star(**t)


def main(argv: list[str]) -> None:
    from salescast.session import get_session, size_shuffles
    raw_dir, out_dir = argv[1], argv[2]
    spark = get_session()
    size_shuffles(spark, [raw_dir])
    prepare(spark, io.load_raw_csv(spark, raw_dir), out_dir)


if __name__ == "__main__":
    main(sys.argv)
