"""Tiny literal brokerage tables for unit cases."""

from pyspark.sql import types as T

from ledgerfold.keys import LONG

DETAIL = T.StructType([
    T.StructField("trade_id", T.StringType()), T.StructField("secu_acc_id", T.StringType()),
    T.StructField("prd_no", T.StringType()), T.StructField("busi_date", T.StringType()),
    T.StructField("timestamp", T.LongType()), T.StructField("busi_flag_code", T.StringType()),
    T.StructField("busi_flag_name", T.StringType()), T.StructField("trd_qty", T.LongType()),
    T.StructField("trd_cash_flow", T.DoubleType()), T.StructField("cash_flow_modi_label", T.DoubleType()),
    T.StructField("trd_amt", T.DoubleType()), T.StructField("trd_type", T.StringType()),
    T.StructField("amortize_label", T.IntegerType()),
    T.StructField("src_orderkey", T.LongType()), T.StructField("src_linenumber", T.IntegerType()),
    T.StructField("src_partkey", T.LongType()), T.StructField("src_suppkey", T.LongType()),
])
HOLDING = T.StructType([
    T.StructField("trade_id", T.StringType()), T.StructField("secu_acc_id", T.StringType()),
    T.StructField("prd_no", T.StringType()), T.StructField("qty", T.LongType()),
    T.StructField("mkt_val", T.DoubleType()), T.StructField("busi_date", T.StringType()),
])
CAL = T.StructType([T.StructField("busi_date", T.StringType()), T.StructField("rlt_rank", T.IntegerType())])


def events(spark, rows, book=LONG):
    """rows: (trade_id, prd_no, busi_date, ts, qty, cash_flow[, amt, code, label])"""
    out = []
    for i, r in enumerate(rows):
        tid, prd, day, ts, q, cf = r[:6]
        amt = r[6] if len(r) > 6 else cf
        code = r[7] if len(r) > 7 else "B"
        label = r[8] if len(r) > 8 else 0
        out.append((tid, "", prd, day, ts, code, "n" + str(code), q, cf, 0.0, amt, book, label, i, 1, 1, 1))
    return spark.createDataFrame(out, DETAIL)


def holdings(spark, rows):
    """rows: (trade_id, prd_no, busi_date, qty, mkt_val)"""
    return spark.createDataFrame([(t, "", p, q, v, d) for t, p, d, q, v in rows], HOLDING)


def calendar(spark, days):
    return spark.createDataFrame([(d, i + 1) for i, d in enumerate(days)], CAL)
