"""Test fixture files: a JSON list of records, or CSV with a header row
(every value a string). Any other suffix is an error."""

from __future__ import annotations

import pathlib

from pyspark.sql import DataFrame, SparkSession


def load_fixture(spark: SparkSession, path: str) -> DataFrame:
    suffix = pathlib.PurePath(path).suffix.lower()
    if suffix == ".json":
        return spark.read.option("multiLine", True).json(path)
    if suffix == ".csv":
        return spark.read.option("header", True).option("inferSchema", False).csv(path)
    raise ValueError(f"Unsupported fixture type for: {path}")
