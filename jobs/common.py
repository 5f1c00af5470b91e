"""What the jobs share: tables that may not be there yet, writes that a rerun repeats, configuration and the command line."""

from __future__ import annotations

import argparse
import json
import logging
import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def found(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The Parquet table at a path, or an empty one where nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def replace_partitions(rows: DataFrame, path: str, *by: str) -> None:
    """Write the rows' partitions, each in place of what it held; others stay. A repeated write leaves the same table."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def configuration(default: dict, path: str | None) -> dict:
    """The defaults, overridden by a JSON file's entries; an unknown entry is an error."""
    given = {}
    if path:
        with open(path) as f:
            given = json.load(f)
    if unknown := sorted(set(given) - set(default)):
        raise ValueError(f"unknown settings: {', '.join(unknown)}")
    return default | given


def main(run, about: str, paths: dict[str, str], default: dict, config: str) -> None:
    """The command line of a job: an option for each path, and one for the configuration."""
    parser = argparse.ArgumentParser(description=about)
    for name, what in paths.items():
        parser.add_argument(f"--{name}", required=True, help=what)
    parser.add_argument("--config", default=os.path.join(os.path.dirname(os.path.abspath(__file__)), config), help="JSON settings (default: %(default)s)")
    given = vars(parser.parse_args())
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    settings = configuration(default, given.pop("config"))
    spark = SparkSession.builder.appName(run.__module__).getOrCreate()
    try:
        run(spark, **given, settings=settings)
    finally:
        spark.stop()
