"""python -m pressure <csv> [--root <folder>]: builds every table and shows the headline."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from pressure.plans.build import build_all
from pressure.plans.marts import headline


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="pressure", description="Build every table from raw CSV files.")
    parser.add_argument("csv", help="a CSV file, a folder or a glob")
    parser.add_argument("--root", help="folder to write the tables under (default: the warehouse folder)")
    given = parser.parse_args(arguments)
    spark = SparkSession.builder.appName("pressure").getOrCreate()
    headline(build_all(spark, given.csv, given.root).win_tables).show()


if __name__ == "__main__":
    main()
