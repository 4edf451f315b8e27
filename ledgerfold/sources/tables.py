"""Scans of day-partitioned brokerage tables.

All predicates are plain column filters, so Catalyst turns ``busi_date`` filters
into partition pruning and the others into pushed-down file filters.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_day(df: DataFrame, busi_date: str, **equals: str) -> DataFrame:
    """Partition-equality scan, optionally with more equality filters (e.g. trd_type)."""
    out = df.where(F.col("busi_date") == F.lit(busi_date))
    for c, v in equals.items():
        out = out.where(F.col(c) == F.lit(v))
    return out


def read_days(df: DataFrame, days: Iterable[str]) -> DataFrame:
    """Scan only the listed partitions (e.g. the two endpoints T2, T1)."""
    return df.where(F.col("busi_date").isin(list(days)))


def read_partitioned(spark: SparkSession, path: str, schema=None, fmt: str = "parquet") -> DataFrame:
    """Read a day-partitioned dataset.  ``busi_date`` is declared as the yyyy-MM-dd string it is (Spark would
    infer a date), so that day filters compare strings and prune partitions."""
    if schema is None:
        found = spark.read.format(fmt).load(path).schema
        schema = T.StructType([T.StructField(f.name, T.StringType() if f.name == "busi_date" else f.dataType, f.nullable) for f in found.fields])
    return spark.read.format(fmt).schema(schema).load(path)
