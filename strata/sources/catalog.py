"""Reads of published folders by path (catalog tables are read with ``spark.table``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_path(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A published folder read with its declared schema.

    The schema is always given: inference would turn partition values such as
    ``2025-02-22`` into DATE.
    """
    return spark.read.schema(schema).parquet(path)
