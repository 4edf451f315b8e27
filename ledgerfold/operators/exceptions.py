"""Exception detail and exception statistics over ``stock_daily_check_data``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfold.functions.expressions import exception_type, sql_div

DETAIL_COLUMNS = [
    "trade_id", "secu_acc_id", "prd_no", "pre_qty", "trd_qty", "now_qty", "pre_mkt_val", "now_mkt_val",
    "trd_cash_flow", "pos_cash_flow", "busi_flag_code", "exception_type", "trd_type", "busi_date",
]
REPORT_COLUMNS = [
    "exception_pv", "exception_uv", "exception_pv_rate", "exception_uv_rate", "max_return", "min_return",
    "max_return_rate", "min_return_rate", "exception_type", "busi_date",
]


def _flagged(check: DataFrame) -> DataFrame:
    return check.where((F.col("qty_exception") != 0) | (F.col("return_rate_exception") != 0))


def exception_detail(check: DataFrame) -> DataFrame:
    """Rows with any exception, classified; drops neg_cash_flow, return, return_rate and the flags."""
    return _flagged(check).withColumn(
        "exception_type", exception_type(F.col("qty_exception"), F.col("return_rate_exception"))
    ).select(*DETAIL_COLUMNS)


CLASSES = ("qty", "return_rate", "both")
_EXTREMES = (("max_return", F.max, "return"), ("min_return", F.min, "return"),
             ("max_return_rate", F.max, "return_rate"), ("min_return_rate", F.min, "return_rate"))


def exception_stat(check: DataFrame) -> DataFrame:
    """Per day and exception class: row count (pv), distinct trade_id (uv), their shares of the
    day's totals, and the extremes of return and return_rate.  Both books together.

    One pass over the check: counts and extremes of every class per (day, trade_id), then per
    day, where a customer counts once in every class that they have; a row a class last.
    """
    flagged = (F.col("qty_exception") != 0) | (F.col("return_rate_exception") != 0)
    cls = F.when(flagged, exception_type(F.col("qty_exception"), F.col("return_rate_exception")))
    rows = check.select("busi_date", "trade_id", "return", "return_rate", cls.alias("cls"))
    of = lambda c, x: F.when(F.col("cls") == c, x)
    per_customer = rows.groupBy("busi_date", "trade_id").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count(of(c, F.lit(1))).alias(f"n_{c}") for c in CLASSES],
        *[how(of(c, F.col(col))).alias(f"{name}_{c}") for c in CLASSES for name, how, col in _EXTREMES])
    known = F.col("trade_id").isNotNull()
    per_day = per_customer.groupBy("busi_date").agg(
        F.sum("n").alias("all_num"), F.count("trade_id").alias("all_user"),
        *[F.sum(f"n_{c}").alias(f"pv_{c}") for c in CLASSES],
        *[F.count(F.when(known & (F.col(f"n_{c}") > 0), F.lit(1))).alias(f"uv_{c}") for c in CLASSES],
        *[how(f"{name}_{c}").alias(f"{name}_{c}") for c in CLASSES for name, how, _ in _EXTREMES])
    one = lambda c: F.struct(
        F.lit(c).alias("exception_type"), F.col(f"pv_{c}").alias("pv"), F.col(f"uv_{c}").alias("uv"),
        *[F.col(f"{name}_{c}").alias(name) for name, _, _ in _EXTREMES])
    out = per_day.select("busi_date", "all_num", "all_user", F.inline(F.array(*[one(c) for c in CLASSES]))).where(F.col("pv") > 0)
    share = lambda a, b: sql_div(F.col(a).cast("double"), F.col(b).cast("double"))
    return out.select(
        F.col("pv").alias("exception_pv"), F.col("uv").alias("exception_uv"),
        share("pv", "all_num").alias("exception_pv_rate"), share("uv", "all_user").alias("exception_uv_rate"),
        *[name for name, _, _ in _EXTREMES], "exception_type", "busi_date")
