"""Registry of the queries run over the driver tables, with their DuckDB oracles.

Every query reads the given tables (or data Spark derives from them) at full
size.  Outputs are made comparable with another engine: UTC instants leave as
``timestamp_ntz`` wall-clock UTC, sums are rounded to 2 decimals, ratios to 6.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}

# Fixed run parameters shared by the queries (caller-supplied clocks, never now()).
AS_OF = datetime(2024, 1, 15, 12, 30, tzinfo=timezone.utc)
SOURCE_UPDATED_AT = datetime(2024, 2, 1, tzinfo=timezone.utc)


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn
    return deco


def finish(df: DataFrame) -> DataFrame:
    """UTC instants -> ``timestamp_ntz`` so engines without zones compare wall clocks."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampType):
            cols.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
