"""The stored daily tables over the events of a folder, built once per application."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyloom.operators import rollups
from tallyloom.session import work_dir
from tallyloom.sources import testdata

_PATHS: dict[tuple[str, str], str] = {}


def stored_path(spark: SparkSession, sf: str) -> str:
    key = (spark.sparkContext.applicationId, sf)
    if key not in _PATHS:
        path = work_dir(spark, "stored")
        rollups.rebuild(testdata.events(spark, sf), path)
        _PATHS[key] = path
    return _PATHS[key]


def stored(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return rollups.stored_views(spark, stored_path(spark, sf))
