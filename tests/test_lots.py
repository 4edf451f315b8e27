"""Lot matching: hand case of FIFO + reconciliation, relational FIFO against a brute-force FIFO."""

import random

import pytest
from pyspark.sql import functions as F

from fixtures import calendar, events, holdings
from ledgerfold.operators.lots import TERM_UNIT, UNIT, Lot, LotBook, closed_lots, fifo_lots, fifo_intervals, fifo_matches, lot_log, open_lots, roll_lots, sorted_events


def lot(open_date, qty, amt, value=0.0):
    return Lot(open_date, qty * UNIT, amt, qty * UNIT, amt, 0.0, qty * UNIT, value)


def test_hand_case_sell_across_lots_and_reconcile():
    t0, t1 = LotBook([lot("T0", 100, 1000.0, 1000.0), lot("T1", 50, 600.0, 600.0)]).day([(-120.0, -1800.0, 0)], "T2", 30.0, 450.0)
    assert t0.proceeds == pytest.approx(1500.0) and t0.left == 0
    assert t0.proceeds - t0.amt == pytest.approx(500.0)
    assert t1.proceeds == pytest.approx(300.0) and t1.left == 30 * UNIT
    assert t1.value == pytest.approx(450.0) and t1.term == pytest.approx(0.6)
    assert t1.proceeds - t1.amt == pytest.approx(-300.0)


def test_buys_same_day_join_one_lot_and_oversell_is_dropped():
    lots = LotBook().day([(10.0, 100.0, 0), (5.0, 60.0, 0), (-20.0, -300.0, 0)], "D", 0.0, 0.0)
    assert len(lots) == 1 and lots[0].size == 15 * UNIT and lots[0].amt == 160.0
    # the sell closes all 15 with 15/20 of its cash; the other 5 are ignored
    assert lots[0].left == 0 and lots[0].proceeds == pytest.approx(225.0)


def test_a_buy_after_a_same_day_sell_out_reopens_the_lot():
    (x,) = LotBook().day([(10.0, 100.0, 0), (-10.0, -120.0, 0), (5.0, 60.0, 0)], "D", 5.0, 60.0)
    assert (x.size, x.left, x.label) == (15 * UNIT, 5 * UNIT, 0)


def test_amortise_pro_rata_and_surplus_holdings():
    lots = LotBook([lot("A", 30, 300.0, 300.0), lot("B", 10, 100.0, 100.0)]).day([(4.0, 40.0, 1)], "C", 50.0, 500.0)
    assert [x.size for x in lots] == [33 * UNIT, 11 * UNIT, 6 * UNIT]
    assert lots[0].amt == pytest.approx(330.0)
    # holdings 50 > 44 open: the surplus 6 becomes a new labelled lot opened today
    assert lots[2].open_date == "C" and lots[2].label == 1 and lots[2].left == 6 * UNIT


def test_amortising_thirds_leaves_no_dust():
    book = LotBook([lot("A", 1, 1.0), lot("B", 1, 1.0), lot("C", 1, 1.0)])
    lots = book.day([(1.0, 1.0, 1)], "D", 4.0, 4.0)
    assert len(lots) == 3 and sum(x.left for x in lots) == 4 * UNIT and not any(x.label for x in lots)


def test_negative_holdings_and_negative_amortisation():
    lots = LotBook([lot("A", 10, 100.0), lot("B", 5, 50.0)]).day([], "C", -3.0, -30.0)
    assert [(x.left, x.label) for x in lots] == [(0, 1), (0, 1)]
    lots = LotBook([lot("A", 10, 100.0), lot("B", 30, 300.0)]).day([(-36.0, -90.0, 1)], "C", 4.0, 4.0)
    assert sum(x.left for x in lots) == 4 * UNIT and not any(x.label for x in lots) and all(x.left >= 0 for x in lots)


def test_book_without_amortising_is_fifo_and_balances_with_holdings():
    rng = random.Random(5)
    for _ in range(200):
        book, queue, open_at = LotBook(), [], {}
        for day in range(rng.randint(1, 6)):
            trades, held, sold = [], 0, {}
            for _ in range(rng.randint(0, 6)):
                q = rng.choice([1, -1]) * rng.randint(1, 9)
                trades.append((float(q), float(10 * q), 0))
                if q > 0:
                    queue.append([str(day), q])
                for _ in range(-q):
                    if queue:
                        queue[0][1] -= 1
                        queue = queue[queue[0][1] == 0:]
            held = sum(n for _, n in queue)
            lots = book.day(trades, str(day), float(held), 7.0 * held)
            want = {}
            for d, n in queue:
                want[d] = want.get(d, 0) + n * UNIT
            assert {x.open_date: x.left for x in lots if x.left} == want
            assert not any(x.label for x in lots) and sum(x.value for x in lots) == pytest.approx(7.0 * held)


def test_roll_lots_open_and_closed_tables(spark):
    days = ["2017-03-15", "2017-03-16", "2017-03-17"]
    ev = events(spark, [("1", "1.1", "2017-03-16", 1, 10, 100.0), ("1", "1.1", "2017-03-17", 1, -10, -150.0)])
    h = holdings(spark, [("1", "1.1", "2017-03-16", 10, 110.0), ("1", "1.1", "2017-03-17", 0, 0.0)])
    rolled = roll_lots(ev, h, calendar(spark, days), "2017-03-15")
    op = open_lots(rolled).collect()
    cl = closed_lots(rolled).collect()
    assert [(r.busi_date, r.unclose_qty, r.unclose_amt) for r in op] == [("2017-03-16", 10.0, 110.0)]
    assert len(cl) == 1 and cl[0].close_date == "2017-03-17" and cl[0]["return"] == pytest.approx(50.0)


def _brute_fifo(evs):
    """Plain FIFO: per-buy queue, oversold quantity dropped; returns {(buy_ts, sell_ts): qty}."""
    out, queue = {}, []
    for ts, q in evs:
        if q > 0:
            queue.append([ts, q])
        else:
            need = -q
            while need and queue:
                take = min(need, queue[0][1])
                out[(queue[0][0], ts)] = out.get((queue[0][0], ts), 0) + take
                queue[0][1] -= take
                need -= take
                if queue[0][1] == 0:
                    queue.pop(0)
    return out


def test_relational_fifo_equals_brute_force(spark):
    rng = random.Random(7)
    days = [f"2017-03-{d:02d}" for d in range(1, 9)]
    rows, expected = [], {}
    for pos in range(12):
        evs, ts = [], 0
        for _ in range(rng.randint(1, 40)):
            ts += rng.randint(0, 2)  # repeated seconds exercise the within-second level
            q = rng.choice([1, -1]) * rng.randint(1, 20)
            evs.append((ts, q))
            rows.append((str(pos), "1.1", days[min(ts // 10, 7)], ts, q, float(q * 10)))
        for (b, s), q in _brute_fifo(evs).items():
            expected[(str(pos), b, s)] = q
    ev = events(spark, rows)
    got = {}
    for r in fifo_matches(ev, calendar(spark, days)).collect():
        k = (r.trade_id, r.buy_ts, r.sell_ts)
        got[k] = got.get(k, 0) + r.match_qty
    assert got == expected
    lots = fifo_lots(ev, calendar(spark, days))
    assert lots.agg(F.sum("close_qty")).first()[0] == sum(expected.values())


def test_bucketed_merge_equals_unbucketed(spark):
    rng = random.Random(11)
    days = [f"2017-03-{d:02d}" for d in range(1, 9)]
    rows = []
    for pos in range(6):
        ts = 0
        for _ in range(rng.randint(5, 40)):
            ts += rng.randint(1, 3)
            rows.append((str(pos), "1.1", days[min(ts // 10, 7)], ts, rng.choice([1, -1]) * rng.randint(1, 60),
                         float(rng.randint(-999, 999))))
    ev, cal = events(spark, rows), calendar(spark, days)
    cols = ["trade_id", "buy_ts", "sell_ts", "match_qty", "match_cost", "match_proceeds"]
    big = sorted(map(tuple, fifo_matches(ev, cal, bucket_qty=1 << 20).select(*cols).collect()))
    tiny = sorted(map(tuple, fifo_matches(ev, cal, bucket_qty=7).select(*cols).collect()))
    assert big == tiny and len(big) > 0


def test_roll_lots_resume_from_state_equals_whole_range(spark, small):
    from ledgerfold.operators.lots import lot_state
    t = small
    first = t.trading_day.where(F.col("rlt_rank") == 1).first()["busi_date"]
    mid = t.trading_day.where(F.col("rlt_rank") == 30).first()["busi_date"]
    full = roll_lots(t.cash_flow_detail, t.stock_asset_holding, t.trading_day, first)
    resumed = roll_lots(t.cash_flow_detail, t.stock_asset_holding, t.trading_day, mid, state=lot_state(full, mid))
    a = sorted(map(tuple, full.where(F.col("busi_date") > mid).collect()), key=repr)
    b = sorted(map(tuple, resumed.collect()), key=repr)
    assert len(a) > 0 and a == b


def test_the_log_tells_changes_only_and_expands_to_every_day(spark):
    days = [f"2017-{m:02d}-{d:02d}" for m in range(1, 11) for d in range(1, 29)]
    ev = events(spark, [("1", "1.1", days[1], 1, 10, 100.0), ("1", "1.1", days[100], 1, 5, 60.0), ("1", "1.1", days[200], 1, -12, -150.0)])
    held = lambda i: 10 if i < 100 else 15 if i < 200 else 3
    h = holdings(spark, [("1", "1.1", d, held(i), held(i) * 11.0 + i) for i, d in enumerate(days) if i])
    cal = calendar(spark, days)
    log = sorted(lot_log(ev, h, cal, days[0]).collect(), key=lambda r: (r.open_date, r.from_rank))
    # days[i] has rank i + 1; the sale takes all of the first lot and two of the second
    assert [(r.open_date, r.from_rank, r.to_rank, r.rest // UNIT) for r in log] == [
        (days[1], 2, 200, 10), (days[1], 201, 201, 0), (days[100], 101, 200, 5), (days[100], 201, len(days), 3)]
    rows = roll_lots(ev, h, cal, days[0]).collect()
    assert len(rows) == sum(r.to_rank - r.from_rank + 1 for r in log)
    last = {r.busi_date: r for r in rows if r.open_date == days[100]}
    assert last[days[199]].weighted_term == 100 and last[days[209]].weighted_term == 100 + 10 * 0.6
    assert last[days[250]].unclose_amt == pytest.approx(3 * 11.0 + 250)


def test_runs_of_days_equal_the_book_kept_daily(spark):
    """Random trades, gaps and jumps of holdings: the expanded log against a LotBook that is called on every day."""
    rng = random.Random(3)
    days = [f"2017-03-{d:02d}" for d in range(1, 25)]
    trades, held, want = [], [], []
    for pos in map(str, range(40)):
        book, since = LotBook(), None
        for rank, day in enumerate(days[1:], 2):
            todays = [(float(rng.randint(-9, 9)), float(rng.randint(-500, 500)), rng.choice([0, 0, 0, 1])) for _ in range(rng.choice([0, 0, 0, 0, 1, 3]))]
            trades += [(pos, "1.1", day, rank * 100 + k, int(q), c, c, "B", label) for k, (q, c, label) in enumerate(todays)]
            total = sum(x.left for x in book.queue) // UNIT
            qty = rng.choice([None, total, total, total, total, rng.randint(-3, 30)])
            if qty is not None:
                held.append((pos, "1.1", day, qty, 7.5 * qty))
            since = since or (rank if todays or qty is not None else None)
            if since:
                want += [(pos, day, x.open_date, x.size, x.amt, x.proceeds, x.left, x.label, round(x.term, 6)) for x in book.day(todays, day, float(qty or 0), 7.5 * (qty or 0))]
    got = roll_lots(events(spark, trades), holdings(spark, held), calendar(spark, days), days[0]).collect()
    got = [(r.trade_id, r.busi_date, r.open_date, round(r.trd_qty * UNIT), r.trd_amt, r.close_amt, round(r.unclose_qty * UNIT), r.exception_label, round(r.weighted_term, 6)) for r in got]
    assert sorted(got) == sorted(want) and len(want) > 500
    assert TERM_UNIT > 10**6 * len(days)


def test_a_null_key_part_is_a_value_of_its_own(spark):
    days = [f"2017-03-{d:02d}" for d in range(14, 20)]
    rows = [("1.1", days[1], 1, 10, 100.0), ("1.1", days[2], 1, 5, 60.0), ("1.1", days[3], 1, -12, -150.0)]
    held = [("1.1", days[1], 10, 110.0), ("1.1", days[2], 15, 170.0), ("1.1", days[3], 3, 40.0), ("1.1", days[4], 3, 41.0)]
    plain, null = ((events(spark, [(t, *r) for r in rows]), holdings(spark, [(t, *r) for r in held])) for t in ("7", None))
    cal = calendar(spark, days)
    for result in (lambda e, h: roll_lots(e, h, cal, days[0]), lambda e, h: fifo_lots(e, cal), lambda e, h: fifo_matches(e, cal)):
        a, b = (sorted((tuple(r)[1:] for r in result(*x).collect()), key=repr) for x in (plain, null))
        assert a == b and len(a) > 0
    assert {r.trade_id for r in roll_lots(*null, cal, days[0]).collect()} == {None}


def test_one_position_with_all_rows_runs_over_several_tasks(spark):
    """One position, most events in one second: ranges cut it, and the intervals stay those of one sequence."""
    rng = random.Random(13)
    day = "2017-03-02"
    rows = [("1", "1.1", day, 7 if k < 900 else k, rng.choice([1, -1, -1, 1, 1]) * rng.randint(1, 20), float(k)) for k in range(1000)] + [("2", "1.1", day, 1, 5, 9.0)]
    ev, cal = events(spark, rows), calendar(spark, ["2017-03-01", day])
    name = "spark.sql.adaptive.coalescePartitions.enabled"  # else so few rows are one task's
    spark.conf.set(name, "false")
    try:
        ranges = sorted_events(ev, cal).where("NOT total").groupBy("part").count().collect()
        seen = {(r.src_orderkey): r for r in fifo_intervals(ev, cal).where("trade_id = '1'").collect()}
    finally:
        spark.conf.unset(name)
    assert len(ranges) > 4 and max(r["count"] for r in ranges) < 500
    bought = sold = dropped = 0
    for k, (_, _, _, _, q, _) in enumerate(rows[:-1]):
        r = seen[k]
        if q > 0:
            assert (r.buy_start, r.buy_end) == (bought, bought + q)
            bought += q
        else:
            start, real = sold - dropped, min(-q, bought - (sold - dropped))
            sold, dropped = sold - q, dropped + (-q - real)
            assert (r.sell_start, r.sell_end) == (start, start + real)
    assert dropped > 0


def test_fifo_shuffles_the_events_once_before_the_merge(spark):
    ev = events(spark, [("1", "1.1", "2017-03-02", k, 5, 9.0) for k in range(20)])
    plan = fifo_intervals(ev, calendar(spark, ["2017-03-01", "2017-03-02"]))._jdf.queryExecution().executedPlan().toString()
    exchanges = [x for x in plan.splitlines() if "Exchange" in x and "Broadcast" not in x]
    assert len(exchanges) <= 1, plan  # that of the ranges' totals
