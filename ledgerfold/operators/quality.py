"""Data-quality checks: injected errors versus detected quantity exceptions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfold.functions.expressions import nvl0
from ledgerfold.keys import KEYS


def error_counts(errors: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Injected-error rows per (trd_type, busi_date), optionally within [start, end]."""
    if start is not None:
        errors = errors.where(F.col("busi_date") >= start)
    if end is not None:
        errors = errors.where(F.col("busi_date") <= end)
    return errors.groupBy("trd_type", "busi_date").agg(F.count(F.lit(1)).alias("error_count"))


def error_count_diff(errors: DataFrame, exceptions: DataFrame, strict: bool = False) -> DataFrame:
    """Per (busi_date, trd_type): injected errors minus detected 'qty' exceptions, rows with a
    nonzero difference.  As written, a group present on one side only has a NULL difference
    and is dropped; ``strict`` counts the missing side as 0 instead.
    """
    a = errors.groupBy("trd_type", "busi_date").agg(F.count(F.lit(1)).alias("error_count"))
    b = (exceptions.where(F.col("exception_type") == "qty")
         .groupBy("trd_type", "busi_date").agg(F.count(F.lit(1)).alias("data_count")))
    j = a.join(b, ["trd_type", "busi_date"], "full")
    if strict:
        diff = nvl0("error_count") - nvl0("data_count")
    else:
        diff = F.col("error_count") - F.col("data_count")
    return j.select("trd_type", "busi_date", "error_count", "data_count", diff.alias("diff_count")) \
        .where(F.col("diff_count") != 0)


def qty_identity(errors: DataFrame, exceptions: DataFrame) -> DataFrame:
    """For every position with both an injected error and a 'qty' exception on the same day and
    book: ``pre_qty + trd_qty + error_qty - now_qty`` (0 when the error explains the exception)."""
    k = KEYS + ["trd_type", "busi_date"]
    a = errors.groupBy(*k).agg(F.sum(nvl0("error_qty")).alias("error_qty"))
    b = (exceptions.where(F.col("exception_type") == "qty").groupBy(*k).agg(
        F.sum(nvl0("pre_qty")).alias("pre_qty"), F.sum(nvl0("trd_qty")).alias("trd_qty"),
        F.sum(nvl0("now_qty")).alias("now_qty")))
    return a.join(b, k).select(
        *k, "error_qty", "pre_qty", "trd_qty", "now_qty",
        (F.col("pre_qty") + F.col("trd_qty") + F.col("error_qty") - F.col("now_qty")).alias("diff_count"))
