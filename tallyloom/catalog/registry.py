"""The table of queries. Results use plain types, so two engines can be compared."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.session import prepare

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Days and times as text, decimals as doubles, all integers as longs."""

    def cast(f: T.StructField):
        col = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            return col.cast("string").alias(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSS").alias(f.name)
        if isinstance(f.dataType, T.DecimalType):
            return col.cast("double").alias(f.name)
        if isinstance(f.dataType, T.IntegralType):
            return col.cast("long").alias(f.name)
        return col

    return df.select(*[cast(f) for f in df.schema.fields])


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name`` with its SQL twin."""

    def register(build: Query) -> Query:
        @wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(build(prepare(spark), sf_dir))

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register
