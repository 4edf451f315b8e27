"""Schemas of the brokerage tables (inputs, daily outputs, position and lot tables).

Quantities are long (sums of int overflow int), money double, flags int; dates
are ``yyyy-MM-dd`` strings and ``busi_date`` is the partition column.  Lot
quantities are double because amortisation makes them fractional.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, L, D, I = T.StringType(), T.LongType(), T.DoubleType(), T.IntegerType()


def _schema(*cols: tuple[str, T.DataType, str]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True, {"comment": c}) for n, t, c in cols])


_KEYS = (("trade_id", S, "customer id"), ("secu_acc_id", S, "securities account"), ("prd_no", S, "product code"))
_DAY = (("busi_date", S, "business date"),)

STOCK_CASH_FLOW_DETAIL = _schema(
    *_KEYS[:3], ("busi_date", S, "business date"), ("timestamp", L, "event time, epoch seconds"),
    ("busi_flag_code", S, "business code"), ("busi_flag_name", S, "business name"), ("trd_qty", L, "quantity"),
    ("trd_cash_flow", D, "cash flow"), ("orig_cash_flow", D, "original cash flow"),
    ("cash_flow_modi_label", D, "cash flow modified"), ("trd_amt", D, "amount"), ("trd_price", D, "price"),
    ("sys_code", S, "system"), ("trd_type", S, "book"), ("inner_busi_flag_code", S, "inner business code"),
    ("amortize_label", I, "amortising trade"),
)

STOCK_CASH_FLOW = _schema(
    *_KEYS, ("busi_flag_code", S, "business codes"), ("busi_flag_name", S, "business names"),
    ("trd_qty", L, "quantity"), ("pos_trd_qty", L, "quantity with positive cash flow"),
    ("neg_trd_qty", L, "quantity with negative cash flow"), ("trd_cash_flow", D, "cash flow"),
    ("pos_cash_flow", D, "positive cash flow"), ("neg_cash_flow", D, "negative cash flow"), ("trd_fee", D, "fee"),
    ("cash_flow_modi_label", D, "cash flow modified"), ("trd_type", S, "book"), *_DAY,
)

STOCK_DAILY_CHECK_DATA = _schema(
    *_KEYS, ("pre_qty", L, "quantity on T2"), ("trd_qty", L, "traded quantity"), ("now_qty", L, "quantity on T1"),
    ("pre_mkt_val", D, "market value on T2"), ("now_mkt_val", D, "market value on T1"),
    ("trd_cash_flow", D, "cash flow"), ("pos_cash_flow", D, "positive cash flow"),
    ("neg_cash_flow", D, "negative cash flow"), ("busi_flag_code", S, "business codes"), ("return", D, "return"),
    ("return_rate", D, "return rate"), ("qty_exception", I, "quantity check failed"),
    ("return_rate_exception", I, "return rate check failed"), ("trd_type", S, "book"), *_DAY,
)

STOCK_DAILY_CHECK_EXCEPTION = _schema(
    *_KEYS, ("pre_qty", L, "quantity on T2"), ("trd_qty", L, "traded quantity"), ("now_qty", L, "quantity on T1"),
    ("pre_mkt_val", D, "market value on T2"), ("now_mkt_val", D, "market value on T1"),
    ("trd_cash_flow", D, "cash flow"), ("pos_cash_flow", D, "positive cash flow"),
    ("busi_flag_code", S, "business codes"), ("exception_type", S, "qty / return_rate / both"),
    ("trd_type", S, "book"), *_DAY,
)

STOCK_DAILY_CHECK_REPORT = _schema(
    ("exception_pv", L, "exception rows"), ("exception_uv", L, "customers with exceptions"),
    ("exception_pv_rate", D, "share of rows"), ("exception_uv_rate", D, "share of customers"),
    ("max_return", D, "largest return"), ("min_return", D, "smallest return"),
    ("max_return_rate", D, "largest return rate"), ("min_return_rate", D, "smallest return rate"),
    ("exception_type", S, "qty / return_rate / both"), *_DAY,
)

STOCK_UNCLOSE_PRD_LONG_DATA = _schema(
    *_KEYS, ("open_date", S, "opening day"), ("holding_term", L, "days held"), ("return", D, "return"),
    ("return_rate", D, "return rate"), ("total_in", D, "money in"), ("total_out", D, "money out"),
    ("remain_qty", L, "quantity held"), ("remain_val", D, "value held"), ("exception_label", L, "exception"),
    ("n_detail", L, "trade records"), ("detail_return", D, "sum of trade returns"), *_DAY,
)

STOCK_CLOSE_PRD_LONG_DATA = _schema(
    *_KEYS, ("close_date", S, "closing day"), ("open_date", S, "opening day"), ("holding_term", L, "days held"),
    ("return", D, "return"), ("return_rate", D, "return rate"), ("total_in", D, "money in"),
    ("total_out", D, "money out"), ("exception_label", L, "exception"), ("n_detail", L, "trade records"),
    ("detail_return", D, "sum of trade returns"), *_DAY,
)

_LOT = (
    ("open_date", S, "opening day"), ("orig_trd_qty", D, "original quantity"), ("orig_trd_amt", D, "original amount"),
    ("trd_qty", D, "quantity after amortisation"), ("trd_amt", D, "cost after amortisation"),
)

STOCK_UNCLOSE_TRADE_LONG_DATA = _schema(
    *_KEYS, *_LOT, ("close_qty", D, "closed quantity"), ("close_amt", D, "closing proceeds"),
    ("unclose_qty", D, "open quantity"), ("unclose_amt", D, "open value"), ("return", D, "return"),
    ("return_rate", D, "return rate"), ("weighted_term", D, "weighted holding term"),
    ("exception_label", I, "exception"), *_DAY,
)

STOCK_CLOSE_TRADE_LONG_DATA = _schema(
    *_KEYS, *_LOT, ("close_amt", D, "closing proceeds"), ("return", D, "return"), ("return_rate", D, "return rate"),
    ("weighted_term", D, "weighted holding term"), ("exception_label", I, "exception"),
    ("close_date", S, "closing day"),
)

STOCK_UNCLOSE_TRADE_CAL = _schema(  # open lots carried to the next day (lot_state)
    *_KEYS, *_LOT, ("close_amt", D, "closing proceeds"), ("unclose_qty", D, "open quantity"),
    ("unclose_amt", D, "open value"), ("weighted_term", D, "weighted holding term"),
    ("exception_label", I, "exception"), *_DAY,
)

STOCK_UNCLOSE_PRD_STATE = _schema(  # open positions carried to the next day (position_state)
    *_KEYS, ("open_date", S, "opening day"), ("remain_qty", L, "quantity held"), ("cost_amt", D, "carried amount"),
    ("total_in", D, "money in"), ("out_amt", D, "money out, signed"), ("n_detail", L, "trade records"),
    ("detail_return", D, "sum of trade returns"), *_DAY,
)

STOCK_ASSET_HOLDING = _schema(
    *_KEYS, ("sys_code", S, "system"), ("qty", L, "quantity"), ("prsnt_qty", L, "present quantity"),
    ("asset_amend_qty", L, "amended quantity"), ("mkt_val", D, "market value"), *_DAY,
)

STOCK_DEBT_HOLDING = _schema(
    *_KEYS, ("sys_code", S, "system"), ("liab_qty", L, "liability quantity"),
    ("prsnt_liab_qty", L, "present liability quantity"), ("asset_amend_qty", L, "amended quantity"),
    ("mkt_val", D, "market value"), *_DAY,
)

TRADING_DAY = _schema(("busi_date", S, "trading day"), ("rlt_rank", I, "rank of the trading day"))

STOCK_RETURN_RATE_RANGE = _schema(
    ("prd_no", S, "product code"), ("long_lower_limit", D, "long book lower limit"),
    ("long_upper_limit", D, "long book upper limit"), ("short_lower_limit", D, "short book lower limit"),
    ("short_upper_limit", D, "short book upper limit"), *_DAY,
)

STOCK_GENERATE_ERROR = _schema(*_KEYS, ("trd_type", S, "book"), ("error_qty", L, "injected error"), *_DAY)

TABLES = {
    "stock_cash_flow_detail": STOCK_CASH_FLOW_DETAIL,
    "stock_asset_holding": STOCK_ASSET_HOLDING,
    "stock_debt_holding": STOCK_DEBT_HOLDING,
    "stock_return_rate_range": STOCK_RETURN_RATE_RANGE,
    "stock_generate_error": STOCK_GENERATE_ERROR,
    "stock_unclose_trade_long_data": STOCK_UNCLOSE_TRADE_LONG_DATA,
    "stock_close_trade_long_data": STOCK_CLOSE_TRADE_LONG_DATA,
    "stock_unclose_trade_cal": STOCK_UNCLOSE_TRADE_CAL,
    "stock_unclose_prd_state": STOCK_UNCLOSE_PRD_STATE,
    "stock_cash_flow": STOCK_CASH_FLOW,
    "stock_daily_check_data": STOCK_DAILY_CHECK_DATA,
    "stock_daily_check_exception": STOCK_DAILY_CHECK_EXCEPTION,
    "stock_daily_check_report": STOCK_DAILY_CHECK_REPORT,
    "stock_unclose_prd_long_data": STOCK_UNCLOSE_PRD_LONG_DATA,
    "stock_close_prd_long_data": STOCK_CLOSE_PRD_LONG_DATA,
}

# partition column of each table ("" = not partitioned)
PARTITION = {name: ("busi_date" if "busi_date" in s.names else "") for name, s in TABLES.items()}
PARTITION["stock_close_trade_long_data"] = "close_date"
PARTITION["stock_cash_flow_detail"] = "busi_date"  # the original leaves it unpartitioned; we partition it
