"""Position fold cases re-derived by hand (FIXTURES §3)."""

import pytest
from pyspark.sql import functions as F

from fixtures import calendar, events, holdings
from ledgerfold.operators.positions import closed_positions, open_positions, roll_positions, seed_open_positions

S, D = "2017-03-15", "2017-03-16"


def _roll(spark, evs, hold, days=(S, D)):
    return roll_positions(events(spark, evs), holdings(spark, hold), calendar(spark, list(days)), S)


def _one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


@pytest.mark.parametrize("sell,closed,x,ret", [
    ((-30, -330.0), False, 70, -330.0),     # floor(40/70) = 0: y stays 1000
    ((-60, -660.0), False, 40, -1660.0),    # floor(-20/40) = -1: y drops to 0
    ((-100, -1200.0), True, 0, -2400.0),    # x = 0: y += a = -200; closed
])
def test_fold_as_written(spark, sell, closed, x, ret):
    evs = [("1", "1.1", D, 1, 100, 0.0, 1000.0), ("1", "1.1", D, 2, sell[0], 0.0, sell[1])]
    r = _one(_roll(spark, evs, []).where(F.col("busi_date") == D))
    assert r.closed == closed
    assert (r.remain_qty if not closed else 0) == x
    assert r["return"] == pytest.approx(ret)
    assert r.total_in == pytest.approx(1000.0) and r.total_out == pytest.approx(abs(sell[1]))
    assert r.exception_label == 1   # first day of the position: no state


def test_row1_new_position(spark):
    r = _one(open_positions(_roll(spark, [("10076", "1.600036", D, 1489662003, 45800, 0.0, 876154.0)], [])))
    assert (r.open_date, r.holding_term, r.remain_qty, r.exception_label) == (D, 0, 45800, 1)
    assert r["return"] == 0.0 and r.return_rate == 0.0 and r.total_in == 876154.0 and r.remain_val == 0.0


def test_row2_cash_without_events_closes_next_day(spark):
    r = _one(closed_positions(_roll(spark, [], [("10682", "0.0", S, 0, 6287600.0), ("10682", "0.0", D, 0, 6287600.0)])))
    assert (r.close_date, r.open_date, r.holding_term, r.exception_label) == (D, S, 1, 0)
    assert r["return"] == pytest.approx(0.0) and r.total_in == 6287600.0


def test_row3_cash_with_event(spark):
    r = _one(closed_positions(_roll(spark, [("92811", "0.0", D, 1489654800, 0, 0.0, 20535.39)],
                                    [("92811", "0.0", S, 0, 1042200.0), ("92811", "0.0", D, 0, 1062735.39)])))
    assert r.holding_term == 1 and r.exception_label == 0 and r.n_detail == 2
    assert r.total_in == pytest.approx(1062735.39) and r["return"] == pytest.approx(0.0, abs=1e-6)


def test_open_position_reemitted_and_label_from_holdings(spark):
    days = (S, D, "2017-03-17", "2017-03-20")
    evs = [("1", "1.1", D, 1, 10, 0.0, 100.0)]
    hold = [("1", "1.1", "2017-03-17", 10, 120.0), ("1", "1.1", "2017-03-20", 11, 130.0)]
    rows = {r.busi_date: r for r in open_positions(_roll(spark, evs, hold, days)).collect()}
    assert sorted(rows) == [D, "2017-03-17", "2017-03-20"]
    assert rows[D].exception_label == 1
    assert rows["2017-03-17"].exception_label == 0 and rows["2017-03-17"].remain_val == 120.0
    assert rows["2017-03-20"].exception_label == 1          # holdings 11 != x 10
    assert rows["2017-03-20"].holding_term == 4


def test_sell_return_tag_and_detail_sum(spark):
    # buy 100 @ 1000, then sell 100 for -1200 next day: tag = (1000 / 100) * -100 = -1000
    days = (S, D, "2017-03-17")
    evs = [("1", "1.1", D, 1, 100, 0.0, 1000.0), ("1", "1.1", "2017-03-17", 2, -100, 0.0, -1200.0)]
    hold = [("1", "1.1", "2017-03-17", 0, 0.0)]
    r = _one(closed_positions(_roll(spark, evs, hold, days)))
    assert r.detail_return == pytest.approx(-1000.0) and r.exception_label == 0 and r.n_detail == 2


def test_seed_rows(spark):
    h = holdings(spark, [("1", "1.1", S, 5, 50.0)])
    r = _one(seed_open_positions(h, S))
    assert (r.remain_qty, r.total_in, r.remain_val, r.exception_label, r.holding_term) == (5, 50.0, 50.0, 0, 0)


def test_resume_from_state_equals_whole_range(spark, small):
    from ledgerfold.operators.positions import position_state
    t = small
    first = t.trading_day.where(F.col("rlt_rank") == 1).first()["busi_date"]
    mid = t.trading_day.where(F.col("rlt_rank") == 30).first()["busi_date"]
    full = roll_positions(t.cash_flow_detail, t.stock_asset_holding, t.trading_day, first)
    state = position_state(full, mid)
    resumed = roll_positions(t.cash_flow_detail, t.stock_asset_holding, t.trading_day, mid, state=state)
    a = sorted(map(tuple, full.where(F.col("busi_date") > mid).collect()), key=repr)
    b = sorted(map(tuple, resumed.select(*full.columns).collect()), key=repr)
    assert len(a) > 0 and a == b


def test_detail_maps_at_the_table_boundary(spark):
    from ledgerfold.operators.positions import detail_maps, event_records
    ev = events(spark, [("1", "1.1", D, 5, 10, 0.0, 100.5), ("1", "1.1", D, 3, -2, 0.0, -20.0)])
    out = detail_maps(event_records(ev, "long_related")).collect()[0].trd_detail
    assert [m["timestamp"] for m in out] == ["3", "5"]
    assert out[1] == {"trd_qty": "10", "trd_amt": "100.5", "trd_date": D, "timestamp": "5"}


def test_fold_equals_the_recurrence_event_by_event(spark, small):
    """Every position-day of the smallest data against one pass over its events, in plain Python."""
    import math

    t = small
    days = [r.busi_date for r in t.trading_day.orderBy("rlt_rank").collect()]
    items = {}
    key = lambda r: (r.trade_id, r.secu_acc_id, r.prd_no)
    for r in t.stock_asset_holding.where(F.col("busi_date") == days[0]).collect():
        items.setdefault(key(r), []).append((days[0], -1, (0,), r.qty, r.mkt_val, True))
    for r in t.cash_flow_detail.where("trd_type = 'long_related'").collect():
        if r.busi_date > days[0]:
            items.setdefault(key(r), []).append((r.busi_date, r.timestamp, (r.src_orderkey, r.src_linenumber, r.src_partkey, r.src_suppkey), r.trd_qty, r.trd_amt, False))
    want = {}
    for k, events_ in items.items():
        x, y, paid, got, tags, n, at = 0, 0.0, 0.0, 0.0, 0.0, 0, 0
        events_.sort()
        started = False
        for day in days:
            while at < len(events_) and events_[at][0] == day:
                _, _, _, q, a, seed = events_[at]
                at, n, started = at + 1, n + 1, True
                if q >= 0:
                    x, y, paid = x + q, y + a, paid + a
                else:
                    if x and not seed:
                        tags += y / x * q
                    x += q
                    y += math.floor((x + q) / x) * y if x else a
                    got += a
            if started and day > days[0]:
                want[(*k, day)] = (x, y - paid + got, paid, abs(got), tags, n)
                if x == 0:
                    y, paid, got, tags, n, started = 0.0, 0.0, 0.0, 0.0, 0, False
    rolled = roll_positions(t.cash_flow_detail, t.stock_asset_holding, t.trading_day, days[0]).collect()
    assert {(*key(r), r.busi_date) for r in rolled} == set(want)
    for r in rolled:
        x, gain, paid, got, tags, n = want[(*key(r), r.busi_date)]
        assert (r.remain_qty or 0) == x and r.n_detail == n and r.closed == (x == 0)
        assert [r["return"], r.total_in, r.total_out, r.detail_return] == pytest.approx([gain, paid, got, tags], rel=1e-6, abs=1e-4)


def test_options_of_cost_and_new_positions(spark):
    days = (S, D, "2017-03-17")
    evs = [("1", "1.1", D, 1, 100, 0.0, 1000.0), ("1", "1.1", "2017-03-17", 2, -40, 0.0, -500.0)]
    hold = [("1", "1.1", D, 100, 1000.0), ("1", "1.1", "2017-03-17", 60, 700.0)]
    args = events(spark, evs), holdings(spark, hold), calendar(spark, list(days)), S
    rows = {r.busi_date: r for r in roll_positions(*args, cost_rule="average_cost", match_new=True).collect()}
    assert rows[D].exception_label == 0 and rows[D].remain_val == 1000.0   # D4: holdings seen on the first day
    # D1: 40 of 100 sold takes 400 of the cost; return = 500 + 600 - 1000
    assert rows["2017-03-17"].cost_amt == pytest.approx(600.0) and rows["2017-03-17"]["return"] == pytest.approx(100.0)
    assert {r.busi_date: r.exception_label for r in roll_positions(*args).collect()}[D] == 1
    with pytest.raises(ValueError):
        roll_positions(*args, cost_rule="other")


def test_detail_array_of_a_closed_position(spark):
    from ledgerfold.operators.positions import closed_position_details, detail_array_return
    days = (S, D, "2017-03-17")
    evs = [("1", "1.1", D, 1, 100, 0.0, 1000.0), ("1", "1.1", "2017-03-17", 2, -100, 0.0, -1200.0)]
    hold = holdings(spark, [("1", "1.1", "2017-03-17", 0, 0.0)])
    closed = closed_positions(roll_positions(events(spark, evs), hold, calendar(spark, list(days)), S))
    details = closed_position_details(closed, events(spark, evs), hold, S)
    (r,) = details.collect()
    assert [(e["trd_qty"], e["trd_amt"], e["return"]) for e in r.trd_detail] == [(100, 1000.0, None), (-100, -1200.0, pytest.approx(-1000.0))]
    assert detail_array_return(details).collect()[0].detail_return_sum == pytest.approx(r.detail_return)


def test_a_null_key_part_is_a_position_of_its_own(spark):
    days = [S, D, "2017-03-17", "2017-03-20"]
    rows = [("1.1", D, 1, 10, 0.0, 100.0), ("1.1", "2017-03-17", 1, -4, 0.0, -60.0), ("1.1", "2017-03-20", 1, -6, 0.0, -70.0)]
    held = [("1.1", S, 3, 30.0), ("1.1", "2017-03-17", 9, 99.0)]
    plain, null = ((events(spark, [(t, *r) for r in rows]), holdings(spark, [(t, *r) for r in held])) for t in ("7", None))
    a, b = (sorted((tuple(r)[1:] for r in roll_positions(*x, calendar(spark, days), S).collect()), key=repr) for x in (plain, null))
    assert a == b and len(a) == 3


def _details_by_hand(items, cost_rule):
    """Return tags of (quantity, amount) items, the first of which is no seed."""
    x, y, tags = 0, 0.0, []
    for q, a in items:
        tags.append(y / x * q if q < 0 and x else None)
        x1 = x + q
        if q >= 0:
            y += a
        elif cost_rule == "average_cost":
            y *= x1 / x if x else 1.0
        else:
            y = y + (x1 + q) // x1 * y if x1 else y + a
        x = x1
    return tags


@pytest.mark.parametrize("cost_rule", ["as_written", "average_cost"])
def test_details_follow_the_cost_rule_and_add_up(spark, cost_rule):
    from ledgerfold.operators.positions import closed_position_details, detail_maps, parse_detail_maps

    days = [S, D, "2017-03-17", "2017-03-20", "2017-03-21"]
    first = [(10, 100.0), (-4, -60.0), (5, 45.0), (-11, -130.0)]
    ev = events(spark, [("1", "1.1", days[1 + (k > 1)], k, q, 0.0, a) for k, (q, a) in enumerate(first)] + [("1", "1.1", days[4], 1, 2, 0.0, 9.0)])
    h = holdings(spark, [])
    closed = closed_positions(roll_positions(ev, h, calendar(spark, days), S, cost_rule=cost_rule))
    details = closed_position_details(closed, ev, h, S, cost_rule=cost_rule)
    row = _one(details)
    assert [e["return"] for e in row.trd_detail] == pytest.approx(_details_by_hand(first, cost_rule))
    assert sum(e["return"] or 0.0 for e in row.trd_detail) == pytest.approx(row.detail_return)
    # the stored form holds text only, and parses back to the same values
    maps = detail_maps(details, optional=("return",))
    texts = _one(maps).trd_detail
    assert texts[0] == {"trd_qty": "10", "trd_amt": "100.0", "trd_date": D, "timestamp": "0"} and "return" in texts[1]
    assert _one(parse_detail_maps(maps)).trd_detail == row.trd_detail


def test_stored_maps_of_other_writers_parse(spark):
    from ledgerfold.operators.positions import parse_detail_maps

    maps = [{"trd_qty": "1.2E3", "trd_amt": "1.2345679E7", "trd_date": "2017-03-16"}, {"trd_qty": "x", "return": "-5"}, {}]
    got = _one(parse_detail_maps(spark.createDataFrame([(maps,)], "trd_detail array<map<string,string>>"))).trd_detail
    assert [tuple(e) for e in got] == [(1200, 12345679.0, "2017-03-16", None, None), (None, None, None, None, -5.0), (None,) * 5]


def test_blocks_of_days_give_the_rows_of_one_scan(spark, small, monkeypatch):
    """Every position of the smallest data, in blocks of 7 days and resumed in the middle, against the unblocked scan."""
    from ledgerfold.operators import positions as P

    t = small
    day_of = {r.rlt_rank: r.busi_date for r in t.trading_day.collect()}
    roll = lambda day, **more: roll_positions(t.cash_flow_detail, t.stock_asset_holding, t.trading_day, day, **more)
    rows = lambda df: sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in df.collect()), key=repr)
    whole = rows(roll(day_of[1]))
    state = P.position_state(roll(day_of[1]), day_of[30])
    monkeypatch.setattr(P, "BLOCK_DAYS", 7)
    assert rows(roll(day_of[1])) == whole and len(whole) > 10_000
    assert rows(roll(day_of[30], state=state)) == [r for r in whole if r[-4] > day_of[30]]


def test_a_cycle_of_ten_thousand_days_is_cut_into_blocks(spark):
    import datetime

    from ledgerfold.operators.positions import BLOCK_DAYS

    first = datetime.date(1980, 1, 1)
    days = [(first + datetime.timedelta(days=i)).isoformat() for i in range(10_000)]
    evs = [("1", "1.1", d, 1, 2 if i % 3 else -3, 0.0, 20.0 + i % 7 if i % 3 else -31.0) for i, d in enumerate(days[1:])]
    out = roll_positions(events(spark, evs), holdings(spark, [("1", "1.1", days[0], 10, 100.0)]), calendar(spark, days), days[0])
    got = {r.busi_date: r for r in out.select("busi_date", "cost_amt", "total_in", "n_detail", "detail_return", "open_date").collect()}
    x, y, inc, tags = 10, 100.0, 100.0, 0.0
    for n, (_, _, d, _, q, _, a) in enumerate(evs, 2):
        tags += y / x * q if q < 0 else 0.0
        x += q
        y, inc = (y + a, inc + a) if q >= 0 else (y + (x + q) // x * y, inc)
        if n % 1000 == 0 or n == len(days):
            r = got[d]
            assert (r.n_detail, r.open_date) == (n, days[0]) and r.total_in == pytest.approx(inc)
            assert r.cost_amt == pytest.approx(y) and r.detail_return == pytest.approx(tags)
    assert len(days) > 50 * BLOCK_DAYS


def test_details_of_a_busy_position_take_time_in_line_with_its_events(spark):
    import time

    from ledgerfold.operators.positions import position_details

    n = 40_000
    first = [(7, 70.0 + k % 11) if k % 3 else (-5, -60.0 - k % 7) for k in range(n)]
    ev = events(spark, [("1", "1.1", D, k, q, 0.0, a) for k, (q, a) in enumerate(first)])
    span = spark.createDataFrame([("1", "a", "1.1", D, D)], "trade_id string, secu_acc_id string, prd_no string, open_date string, last_date string")
    span = span.withColumn("secu_acc_id", F.lit(ev.first()["secu_acc_id"]))
    began = time.monotonic()
    row = _one(position_details(span, ev, holdings(spark, []), S))
    assert time.monotonic() - began < 40  # rows copied for every event took some 90 s
    assert [(e["trd_qty"], e["trd_amt"]) for e in row.trd_detail] == first
    assert [e["return"] for e in row.trd_detail] == pytest.approx(_details_by_hand(first, "as_written"))


def test_details_of_a_very_busy_position_do_not_copy_its_rows_for_every_block(spark):
    import time

    from ledgerfold.operators.positions import position_details

    n = 400_000
    k = F.col("id")
    sell = (k % 3) == 0
    ev = spark.range(n).select(
        F.lit("1").alias("trade_id"), F.lit("a").alias("secu_acc_id"), F.lit("1.1").alias("prd_no"), F.lit(D).alias("busi_date"), k.alias("timestamp"),
        F.when(sell, -5).otherwise(7).alias("trd_qty"), F.when(sell, -60.0 - k % 7).otherwise(70.0 + k % 11).alias("trd_amt"),
        F.lit("long_related").alias("trd_type"), *[F.lit(0).alias(c) for c in ("src_orderkey", "src_linenumber", "src_partkey", "src_suppkey")])
    span = spark.createDataFrame([("1", "a", "1.1", D, D)], "trade_id string, secu_acc_id string, prd_no string, open_date string, last_date string")
    began = time.monotonic()
    row = _one(position_details(span, ev, holdings(spark, []), S).withColumn("returns", F.col("trd_detail.return")).drop("trd_detail"))
    assert time.monotonic() - began < 45  # all rows copied for every block of 64 events took some 95 s
    by_hand = _details_by_hand([(7, 70.0 + k % 11) if k % 3 else (-5, -60.0 - k % 7) for k in range(n)], "as_written")
    assert row.returns == by_hand


def test_maps_hold_only_the_optional_fields_that_have_a_value(spark):
    from ledgerfold.operators.positions import detail_maps

    items = [(1, 2.5, None), (None, None, "b"), (3, None, None)]
    df = spark.createDataFrame([(items,)], "trd_detail array<struct<q:bigint,a:double,b:string>>")
    got = _one(detail_maps(df, fields=("q",), optional=("a", "b"))).trd_detail
    assert got == [{"q": "1", "a": "2.5"}, {"q": None, "b": "b"}, {"q": "3"}]
    assert _one(detail_maps(df, fields=(), optional=("a",))).trd_detail == [{"a": "2.5"}, {}, {}]
    assert _one(detail_maps(df, fields=("q", "a", "b"))).trd_detail[0] == {"q": "1", "a": "2.5", "b": None}
