"""spark-submit entry: raw files to Gold tables.

python -m ratings_engine RAW_ROOT TABLE_ROOT [INGESTION_DATE] [--category C] [--skip-compact]"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from ratings_engine.plans import medallion


def main(arguments=None) -> None:
    parser = argparse.ArgumentParser(prog="ratings_engine")
    parser.add_argument("raw_root")
    parser.add_argument("table_root")
    parser.add_argument("ingestion_date", nargs="?")
    parser.add_argument("--category")
    parser.add_argument("--skip-compact", action="store_true")
    parser.add_argument("--no-gate", action="store_true")
    parser.add_argument("--history", choices=("carried", "full", "lookback"), default="carried")
    parser.add_argument("--forward", action="store_true")
    options = parser.parse_args(arguments)
    spark = (SparkSession.builder.appName("ratings_engine")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    medallion.run(spark, options.raw_root, options.table_root, options.category,
                  options.ingestion_date, options.skip_compact, not options.no_gate,
                  options.history, options.forward)


if __name__ == "__main__":
    main()
