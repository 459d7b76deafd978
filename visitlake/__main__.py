"""Run the batch job: python -m visitlake VISITS DEMOGRAPHY LABELS TARGET"""

import argparse

from pyspark.sql import SparkSession

from visitlake.plans.pipeline import run


def main() -> None:
    parser = argparse.ArgumentParser(prog="visitlake", description="Build the visits star schema.")
    parser.add_argument("visits", help="Parquet folder of visit records")
    parser.add_argument("demography", help="semicolon-separated city files")
    parser.add_argument("labels", help="label file or folder")
    parser.add_argument("target", help="folder the tables are written to")
    parser.add_argument(
        "--partitions", type=int, help="ranges of visits to write, else the session's number"
    )
    parser.add_argument("--rejects", action="store_true", help="also count cells and codes that cannot be read")
    arguments = parser.parse_args()
    spark = SparkSession.builder.appName("visitlake").getOrCreate()
    run(
        spark,
        arguments.visits,
        arguments.demography,
        arguments.labels,
        arguments.target,
        arguments.partitions,
        rejects=arguments.rejects,
    ).show(100, truncate=False)


if __name__ == "__main__":
    main()
