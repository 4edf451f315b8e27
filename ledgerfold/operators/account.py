"""Account check: reconcile holdings, flows and returns for the long and short books.

For a trading day T1 with previous trading day T2 and a book, a position gets
one row if it is held on T2 or T1 (cash product '0.0' excluded on the holdings
side) or has merged flows on T1.  Every day and both books are one grouping: each
holdings table is read once and each of its rows emitted as ``now`` of its own day and ``pre``
of the next trading day (found through the calendar), the merged flows are
read once for both books, and the union is grouped by (position, book, T1).

A full outer join never matches keys with a NULL part but keeps both sides, so the
side is part of the grouping key wherever a key has a NULL: such holdings and flows stay
apart, each with zeros for the other side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.functions.calendar import calendar_fits, day_side, previous_day
from ledgerfold.functions.expressions import nvl0, sql_div
from ledgerfold.keys import CASH_PRD, KEYS, LONG, SHORT
from ledgerfold.sources.tables import read_day, read_days

CHECK_COLUMNS = [
    "trade_id", "secu_acc_id", "prd_no", "pre_qty", "trd_qty", "now_qty", "pre_mkt_val", "now_mkt_val",
    "trd_cash_flow", "pos_cash_flow", "neg_cash_flow", "busi_flag_code", "return", "return_rate",
    "qty_exception", "return_rate_exception", "trd_type", "busi_date",
]

_BOOK = {
    LONG: dict(qty="qty", lower="long_lower_limit", upper="long_upper_limit"),
    SHORT: dict(qty="liab_qty", lower="short_lower_limit", upper="short_upper_limit"),
}


def _side(side: int) -> Column:
    """0 for keys that can match; ``side`` (1 holdings, 2 flows) where a key part is NULL."""
    some_null = F.col(KEYS[0]).isNull()
    for k in KEYS[1:]:
        some_null = some_null | F.col(k).isNull()
    return F.when(some_null, F.lit(side)).otherwise(F.lit(0)).alias("side")


def holdings_pair(holding: DataFrame, calendar: DataFrame, book: str, fits: bool | None = None) -> DataFrame:
    """Per (position, T1): pre/now quantity and market value (T2 = previous trading day of T1).

    One scan: a holdings row is ``now`` of its day if that day has a T2, and ``pre`` of the next day.
    """
    qty = _BOOK[book]["qty"]
    fits = calendar_fits(calendar) if fits is None else fits
    prev = previous_day(calendar, fits)
    # one row per trading day: has it a T2, and of which T1 is it the T2
    days = calendar.select("busi_date").join(day_side(prev, fits), "busi_date", "left").join(
        day_side(prev.select(F.col("busi_date").alias("next_date"), F.col("prev_date").alias("d")), fits), F.col("busi_date") == F.col("d"), "left"
    ).select("busi_date", F.when(F.col("prev_date").isNotNull(), F.col("busi_date")).alias("now_date"), "next_date")
    h = holding.where(F.col("prd_no") != F.lit(CASH_PRD)).select(
        *KEYS, "busi_date", F.col(qty).cast("long").alias("q"), F.col("mkt_val").cast("double").alias("v"))
    none_q, none_v = F.lit(0).cast("long"), F.lit(0.0)
    emit = lambda day, pre_q, now_q, pre_v, now_v: F.struct(
        day.alias("busi_date"), pre_q.alias("pre_q"), now_q.alias("now_q"), pre_v.alias("pre_v"), now_v.alias("now_v"))
    both = F.array(emit(F.col("now_date"), none_q, F.col("q"), none_v, F.col("v")),
                   emit(F.col("next_date"), F.col("q"), none_q, F.col("v"), none_v))
    h = h.join(day_side(days, fits), "busi_date").select(*KEYS, F.explode(F.filter(both, lambda x: x["busi_date"].isNotNull())).alias("x"))
    return h.select(*KEYS, "x.busi_date", "x.pre_q", "x.now_q", "x.pre_v", "x.now_v")


_HOLD_TYPES = [("pre_q", "long"), ("now_q", "long"), ("pre_v", "double"), ("now_v", "double")]
_FLOW_TYPES = [("f_trd_qty", "long"), ("f_trd_cash_flow", "double"), ("f_pos_cash_flow", "double"),
               ("f_neg_cash_flow", "double"), ("f_busi_flag_code", "string")]


def _holding_rows(holding: DataFrame, calendar: DataFrame, book: str, fits: bool) -> DataFrame:
    """Holdings rows of one book, keyed by (position, T1)."""
    return holdings_pair(holding, calendar, book, fits).select(
        *KEYS, F.lit(book).alias("trd_type"), "busi_date", _side(1), *[c for c, _ in _HOLD_TYPES],
        *[F.lit(None).cast(t).alias(c) for c, t in _FLOW_TYPES])


def _flow_rows(merged: DataFrame, calendar: DataFrame, books: tuple[str, ...], fits: bool) -> DataFrame:
    """Merged flows of the books, on days that have a T2."""
    prev = day_side(previous_day(calendar, fits).select("busi_date"), fits)
    return merged.where(F.col("trd_type").isin(list(books))).join(prev, "busi_date", "left_semi").select(
        *KEYS, "trd_type", "busi_date", _side(2), *[F.lit(None).cast(t).alias(c) for c, t in _HOLD_TYPES],
        *[F.col(c).cast(t).alias(c) for c, t in _FLOW_TYPES])


def _flows_renamed(merged: DataFrame) -> DataFrame:
    return merged.select(
        *KEYS, "trd_type", "busi_date",
        F.col("trd_qty").alias("f_trd_qty"), F.col("trd_cash_flow").alias("f_trd_cash_flow"),
        F.col("pos_cash_flow").alias("f_pos_cash_flow"), F.col("neg_cash_flow").alias("f_neg_cash_flow"),
        F.col("busi_flag_code").alias("f_busi_flag_code"))


def account_check(merged: DataFrame, asset_holding: DataFrame, debt_holding: DataFrame, limits: DataFrame,
                  calendar: DataFrame, books: tuple[str, ...] = (LONG, SHORT), t1: str | None = None,
                  keep_unlimited: bool = False) -> DataFrame:
    """``stock_daily_check_data`` for every T1 (or one ``t1``) and the given books.

    return      = now_mkt_val - pre_mkt_val - trd_cash_flow
    return_rate = return / (pos_cash_flow + pre_mkt_val)   (long)
                = return / (pos_cash_flow - now_mkt_val)   (short); x/0 -> NULL
    qty_exception = 0 iff pre_qty + trd_qty == now_qty (trd_qty truncated to bigint)
    return_rate_exception = 0 iff lower < return_rate < upper (NULL -> 1)
    Products without a limits row for T1 are dropped (inner join) unless ``keep_unlimited``.
    """
    fits = calendar_fits(calendar)
    if t1 is not None:
        # the two endpoints as literals, so that the scans prune to their partitions
        t2 = previous_day(calendar, fits).where(F.col("busi_date") == t1).first()
        days = [t1] if t2 is None else [t2["prev_date"], t1]
        asset_holding, debt_holding = read_days(asset_holding, days), read_days(debt_holding, days)
        merged = read_day(merged, t1)
    rows = _flow_rows(_flows_renamed(merged), calendar, books, fits)
    for book in books:
        rows = rows.unionByName(_holding_rows(asset_holding if book == LONG else debt_holding, calendar, book, fits))
    if t1 is not None:
        rows = rows.where(F.col("busi_date") == t1)

    g = rows.groupBy(*KEYS, "trd_type", "busi_date", "side").agg(
        nvl0(F.sum("pre_q")).alias("pre_qty"),
        nvl0(F.sum("now_q")).alias("now_qty"),
        nvl0(F.sum("pre_v")).cast("double").alias("pre_mkt_val"),
        nvl0(F.sum("now_v")).cast("double").alias("now_mkt_val"),
        nvl0(F.sum("f_trd_qty")).alias("trd_qty_d"),
        nvl0(F.sum("f_trd_cash_flow")).cast("double").alias("trd_cash_flow"),
        nvl0(F.sum("f_pos_cash_flow")).cast("double").alias("pos_cash_flow"),
        nvl0(F.sum("f_neg_cash_flow")).cast("double").alias("neg_cash_flow"),
        F.max("f_busi_flag_code").alias("busi_flag_code"),
    )
    ret = F.col("now_mkt_val") - F.col("pre_mkt_val") - F.col("trd_cash_flow")
    long_den = F.col("pos_cash_flow") + F.col("pre_mkt_val")
    short_den = F.col("pos_cash_flow") - F.col("now_mkt_val")
    rate = F.when(F.col("trd_type") == F.lit(LONG), sql_div(ret, long_den)).otherwise(sql_div(ret, short_den))
    trd_long = F.col("trd_qty_d").cast("long")
    qty_ok = ((F.col("pre_qty") + trd_long) >= F.col("now_qty")) & ((F.col("pre_qty") + trd_long) < F.col("now_qty") + 1)
    g = g.select(
        "*", ret.alias("return"), rate.alias("return_rate"),
        F.when(qty_ok, 0).otherwise(1).alias("qty_exception"),
        trd_long.alias("trd_qty"),
    )

    lim = limits.select(
        "prd_no", "busi_date",
        F.col("long_lower_limit").cast("double").alias("lim_ll"), F.col("long_upper_limit").cast("double").alias("lim_lu"),
        F.col("short_lower_limit").cast("double").alias("lim_sl"), F.col("short_upper_limit").cast("double").alias("lim_su"),
    )
    if t1 is not None:
        lim = lim.where(F.col("busi_date") == t1)
    # The limits side grows with products x days, so no broadcast hint: AQE switches
    # to a broadcast join at runtime when the measured side is small.
    j = g.join(lim, ["prd_no", "busi_date"], "left" if keep_unlimited else "inner")
    is_long = F.col("trd_type") == F.lit(LONG)
    lower = F.when(is_long, F.col("lim_ll")).otherwise(F.col("lim_sl"))
    upper = F.when(is_long, F.col("lim_lu")).otherwise(F.col("lim_su"))
    in_band = (F.col("return_rate") > lower) & (F.col("return_rate") < upper)
    j = j.withColumn("return_rate_exception", F.when(in_band, 0).otherwise(1))
    return j.select(*CHECK_COLUMNS)
