"""Build the insurance layers: ``spark-submit`` this file, or ``python -m sedimenta``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from sedimenta.operators.reporting import labelled, overall_summary, summary_line
from sedimenta.plans import insurance
from sedimenta.sources import Warehouse
from sedimenta.sources.delimited import SPLIT

STEPS = ("bronze", "silver", "gold", "quality")


def multi_line(single: list[str] | None, split: list[str] | None = None) -> dict[str, bool | str]:
    """How sources are read that are named to hold no line breaks, or to be read in splits with them."""
    asked = {}
    for how, named in ((SPLIT, split), (False, single)):
        if named is not None:
            asked |= {source: how for source in named or insurance.SOURCE_FILES}
    return asked


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--sources", required=True, help="folder of the CSV files")
    parser.add_argument("--warehouse", required=True, help="folder of the stored tables")
    parser.add_argument("--reports", help="folder to add the quality report to")
    parser.add_argument(
        "--single-line",
        nargs="*",
        choices=insurance.SOURCE_FILES,
        help="sources without line breaks inside fields, read in splits; all if none is named",
    )
    parser.add_argument(
        "--split",
        nargs="*",
        choices=insurance.SOURCE_FILES,
        help="sources with line breaks inside fields to read in splits all the same; all if none is named",
    )
    parser.add_argument("steps", nargs="+", choices=STEPS, help="run in the given order")
    options = parser.parse_args(arguments)

    spark = SparkSession.builder.appName("insurance layers").getOrCreate()
    warehouse = Warehouse(spark, options.warehouse)
    for step in options.steps:
        if step == "bronze":
            print(insurance.build_bronze(warehouse, options.sources, multi_line(options.single_line, options.split)))
        elif step == "silver":
            print(insurance.build_silver(warehouse))
        elif step == "gold":
            print(insurance.build_gold(warehouse))
        else:
            results = insurance.check_quality(warehouse, options.reports)
            for row in labelled(results).collect():
                print(f"{row['label']:8} {row['name']}: {row['value']} {row['status']}")
            print(overall_summary(results).select(summary_line()).first()[0])


if __name__ == "__main__":
    main()
