"""Cash-flow merge, account check and exceptions on literal rows (edge cases of FIXTURES §3)."""

import pytest
from pyspark.sql import functions as F

from fixtures import calendar, events, holdings
from ledgerfold.keys import LONG, SHORT
from ledgerfold.operators.account import account_check
from ledgerfold.operators.cashflow import merge_cash_flow
from ledgerfold.operators.exceptions import exception_detail, exception_stat

D1, D2 = "2017-03-16", "2017-03-17"


def _limits(spark, rows):
    return spark.createDataFrame(rows, "prd_no string, busi_date string, long_lower_limit double, "
                                       "long_upper_limit double, short_lower_limit double, short_upper_limit double")


def test_merge_sums_signs_and_order(spark):
    ev = events(spark, [
        ("1", "1.1", D1, 30, 10, 100.0, 99.0, "B"),
        ("1", "1.1", D1, 10, -4, -40.0, -41.0, "S"),
        ("1", "1.1", D1, 20, 5, None, 50.0, "X"),   # NULL cash flow: neither side
    ])
    r = merge_cash_flow(ev).collect()[0]
    assert r.trd_qty == 11 and r.pos_trd_qty == 10 and r.neg_trd_qty == -4
    assert r.trd_cash_flow == pytest.approx(60.0)
    assert r.pos_cash_flow == pytest.approx(100.0) and r.neg_cash_flow == pytest.approx(-40.0)
    assert r.trd_fee == pytest.approx(1.0 + 1.0)
    assert r.busi_flag_code == "S-X-B"  # event-time order


def test_merge_all_null_codes_give_empty_string(spark):
    ev = events(spark, [("1", "1.1", D1, 1, 1, 1.0, 1.0, None)])
    assert merge_cash_flow(ev).collect()[0].busi_flag_code == ""


def _check_inputs(spark):
    cal = calendar(spark, [D1, D2])
    ev = events(spark, [
        ("1", "1.1", D2, 1, 10, 100.0),        # held before: rate 0 ... see below
        ("2", "1.2", D2, 1, 5, 50.0),          # flow without holdings
        ("4", "1.4", D2, 1, 1, 10.0),          # product without limits
    ])
    h = holdings(spark, [
        ("1", "1.1", D1, 10, 1000.0), ("1", "1.1", D2, 20, 1100.0),   # return 0, rate 0/1100 = 0
        ("3", "1.3", D1, 7, 70.0), ("3", "1.3", D2, 7, 84.0),         # no flow: return 14, rate 14/70 = 0.2 -> at limit
        ("5", "0.0", D2, 3, 3.0),                                     # cash product: ignored on holdings side
        ("4", "1.4", D2, 1, 10.0),
    ])
    debt = holdings(spark, []).withColumnRenamed("qty", "liab_qty")
    lim = _limits(spark, [(p, D2, -0.2, 0.2, -0.2, 0.2) for p in ("1.1", "1.2", "1.3", "0.0")])
    return merge_cash_flow(ev), h, debt, lim, cal


def test_account_check_edges(spark):
    merged, h, debt, lim, cal = _check_inputs(spark)
    rows = {r.trade_id: r for r in account_check(merged, h, debt, lim, cal, books=(LONG,)).collect()}
    assert set(rows) == {"1", "2", "3"}          # '4' dropped: no limits; '5' cash holdings excluded
    r1 = rows["1"]
    assert (r1.pre_qty, r1.trd_qty, r1.now_qty, r1.qty_exception) == (10, 10, 20, 0)
    assert r1["return"] == pytest.approx(0.0) and r1.return_rate_exception == 0
    r2 = rows["2"]
    assert (r2.pre_qty, r2.now_qty, r2.qty_exception) == (0, 0, 1)
    assert r2["return"] == pytest.approx(-50.0) and r2.return_rate == pytest.approx(-1.0)
    r3 = rows["3"]
    assert r3.busi_flag_code is None and r3.qty_exception == 0
    assert r3.return_rate == pytest.approx(0.2) and r3.return_rate_exception == 1   # strict bounds
    kept = account_check(merged, h, debt, lim, cal, books=(LONG,), keep_unlimited=True)
    r4 = kept.where(F.col("trade_id") == "4").collect()[0]
    assert r4.return_rate_exception == 1


def test_zero_denominator_rate_is_null_and_flagged(spark):
    cal = calendar(spark, [D1, D2])
    h = holdings(spark, [("1", "1.1", D2, 0, 0.0)])
    lim = _limits(spark, [("1.1", D2, -0.2, 0.2, -0.2, 0.2)])
    empty = merge_cash_flow(events(spark, []))
    debt = holdings(spark, []).withColumnRenamed("qty", "liab_qty")
    r = account_check(empty, h, debt, lim, cal, books=(LONG,)).collect()[0]
    assert r.return_rate is None and r.return_rate_exception == 1


def test_short_book_denominator(spark):
    cal = calendar(spark, [D1, D2])
    debt = holdings(spark, [("1", "1.1", D1, 10, 100.0), ("1", "1.1", D2, 10, 90.0)]).withColumnRenamed("qty", "liab_qty")
    asset = holdings(spark, [])
    lim = _limits(spark, [("1.1", D2, -0.2, 0.2, -0.5, 0.5)])
    empty = merge_cash_flow(events(spark, [], book=SHORT))
    r = account_check(empty, asset, debt, lim, cal, books=(SHORT,)).collect()[0]
    # return = 90 - 100 - 0 = -10; short rate = -10 / (0 - 90)
    assert r.return_rate == pytest.approx(10 / 90) and r.return_rate_exception == 0


def test_exception_detail_and_stat(spark):
    merged, h, debt, lim, cal = _check_inputs(spark)
    chk = account_check(merged, h, debt, lim, cal, books=(LONG,))
    det = {r.trade_id: r.exception_type for r in exception_detail(chk).collect()}
    assert det == {"2": "both", "3": "return_rate"}
    st = {r.exception_type: r for r in exception_stat(chk).collect()}
    assert st["both"].exception_pv == 1 and st["both"].exception_pv_rate == pytest.approx(1 / 3)
    assert st["return_rate"].max_return == pytest.approx(14.0)


def test_single_day_equals_range_slice(spark, small):
    t = small
    merged = merge_cash_flow(t.cash_flow_detail)
    day = t.trading_day.where(F.col("rlt_rank") == 40).first()["busi_date"]
    full = account_check(merged, t.stock_asset_holding, t.stock_debt_holding, t.stock_return_rate_range,
                         t.trading_day).where(F.col("busi_date") == day)
    one = account_check(merged, t.stock_asset_holding, t.stock_debt_holding, t.stock_return_rate_range,
                        t.trading_day, t1=day)
    assert one.count() > 0
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, full.collect()))
