"""A single daily run, resumed from the previous day's states, equals the whole-range run."""

from pyspark.sql import functions as F

from ledgerfold.keys import SHORT
from ledgerfold.operators.lots import lot_state, open_lots, roll_lots
from ledgerfold.operators.positions import open_positions, position_state, roll_positions
from ledgerfold.plans.daily import previous_trading_days, run_day


def test_run_day_matches_range(spark, small):
    t = small
    day_of = {r.rlt_rank: r.busi_date for r in t.trading_day.collect()}
    first, t2, t1, d = day_of[1], day_of[20], day_of[21], day_of[22]
    assert previous_trading_days(t.trading_day, d) == (t2, t1)
    assert previous_trading_days(t.trading_day, "1900-01-01") is None
    pos = roll_positions(t.cash_flow_detail, t.stock_asset_holding, t.trading_day, first)
    lots = roll_lots(t.cash_flow_detail, t.stock_asset_holding, t.trading_day, first)
    out = run_day(t, d, position_state(pos, t2), lot_state(lots, t2))
    assert out.t1 == t1
    key = lambda r: repr(r)
    want = sorted(map(tuple, open_positions(pos).where(F.col("busi_date") == t1).collect()), key=key)
    assert sorted(map(tuple, out.open_positions.collect()), key=key) == want
    want_lots = sorted(map(tuple, lots.where((F.col("busi_date") == t1) & ~F.col("closed")).drop("closed").collect()),
                       key=key)
    assert sorted(map(tuple, out.open_lots.collect()), key=key) == want_lots
    assert {r.busi_date for r in out.check.select("busi_date").distinct().collect()} == {t1}
    assert out.report.count() > 0


def test_run_day_of_the_short_book_matches_range(spark, small):
    t = small
    day_of = {r.rlt_rank: r.busi_date for r in t.trading_day.collect()}
    first, t2, t1, d = day_of[1], day_of[20], day_of[21], day_of[22]
    how = dict(book=SHORT, qty_col="liab_qty")
    pos = roll_positions(t.cash_flow_detail, t.stock_debt_holding, t.trading_day, first, **how)
    lots = roll_lots(t.cash_flow_detail, t.stock_debt_holding, t.trading_day, first, **how)
    out = run_day(t, d, position_state(pos, t2), lot_state(lots, t2), SHORT)
    rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert rows(out.open_positions) == rows(open_positions(pos).where(F.col("busi_date") == t1))
    assert rows(out.open_lots) == rows(open_lots(lots).where(F.col("busi_date") == t1)) and out.open_lots.count() > 0
