"""Cash-flow merge: intraday events -> one row per position, book and day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfold.keys import KEYS

MERGED_COLUMNS = [
    "trade_id", "secu_acc_id", "prd_no", "busi_flag_code", "busi_flag_name", "trd_qty", "pos_trd_qty",
    "neg_trd_qty", "trd_cash_flow", "pos_cash_flow", "neg_cash_flow", "trd_fee", "cash_flow_modi_label",
    "trd_type", "busi_date",
]


def merge_cash_flow(detail: DataFrame, order_col: str = "timestamp", with_names: bool = True) -> DataFrame:
    """Collapse intraday cash-flow events to one row per (position, trd_type, busi_date).

    One group-by with map-side partial aggregation; all days at once (filter the
    input by ``busi_date`` for a single day - it prunes partitions).  A NULL cash
    flow counts to neither the positive nor the negative side.

    ``busi_flag_code`` / ``busi_flag_name`` join the day's values with '-' in event
    time order (the original leaves the order unspecified).  Events at the same time
    are ordered by (code, name): equal sort keys then carry equal strings, so the
    result is deterministic without any further tie-break column.  ``with_names=False``
    leaves ``busi_flag_name`` NULL and does not collect it (the account check never reads it;
    Catalyst cannot prune a field inside a collected struct).
    """
    cf = F.col("trd_cash_flow")
    pos = cf >= 0
    neg = cf < 0
    fields = [F.col(order_col).alias("t"), F.col("busi_flag_code").alias("c")]
    if with_names:
        fields.append(F.col("busi_flag_name").alias("n"))
    items = F.sort_array(F.collect_list(F.struct(*fields)))
    names = F.concat_ws("-", F.transform("_items", lambda s: s["n"])) if with_names else F.lit(None).cast("string")
    return (
        detail.groupBy(*KEYS, "trd_type", "busi_date")
        .agg(
            items.alias("_items"),
            F.sum("trd_qty").alias("trd_qty"),
            F.sum(F.when(pos, F.col("trd_qty")).otherwise(F.lit(0))).alias("pos_trd_qty"),
            F.sum(F.when(neg, F.col("trd_qty")).otherwise(F.lit(0))).alias("neg_trd_qty"),
            F.sum(cf).alias("trd_cash_flow"),
            F.sum(F.when(pos, cf).otherwise(F.lit(0.0))).alias("pos_cash_flow"),
            F.sum(F.when(neg, cf).otherwise(F.lit(0.0))).alias("neg_cash_flow"),
            F.sum(cf - F.col("trd_amt")).alias("trd_fee"),
            F.max("cash_flow_modi_label").alias("cash_flow_modi_label"),
        )
        .withColumn("busi_flag_code", F.concat_ws("-", F.transform("_items", lambda s: s["c"])))
        .withColumn("busi_flag_name", names)
        .select(*MERGED_COLUMNS)
    )
