"""Seeds, empty closed table, save-as-table and backfill task validation."""

import uuid

import pytest
from pyspark.sql import functions as F

from fixtures import holdings
from ledgerfold.operators.lots import seed_lots
from ledgerfold.operators.positions import seed_closed_table, seed_open_positions
from ledgerfold.plans.backfill import backfill
from ledgerfold.sinks.tables import save_as_table


def test_seed_closed_table_is_empty_with_closed_schema(spark):
    h = holdings(spark, [("1", "1.1", "2017-03-15", 5, 50.0)])
    closed = seed_closed_table(seed_open_positions(h, "2017-03-15"))
    assert closed.count() == 0 and "close_date" in closed.columns and "remain_qty" not in closed.columns


def test_seed_lots_default_and_as_written(spark):
    h = holdings(spark, [("1", "1.1", "2017-03-15", 5, 50.0)])
    d = seed_lots(h, "2017-03-15").collect()[0]
    w = seed_lots(h, "2017-03-15", as_written=True).collect()[0]
    assert (d.unclose_qty, d.unclose_amt) == (5.0, 50.0)
    assert (w.unclose_qty, w.unclose_amt) == (0.0, 0.0) and w.trd_qty == 5.0


def test_save_as_table_roundtrip(spark):
    name = "seed_" + uuid.uuid4().hex[:8]
    h = holdings(spark, [("1", "1.1", "2017-03-15", 5, 50.0), ("2", "1.2", "2017-03-16", 1, 10.0)])
    save_as_table(seed_open_positions(h, "2017-03-15"), name, fmt="parquet")
    got = spark.table(name).where(F.col("busi_date") == "2017-03-15").collect()
    assert len(got) == 1 and got[0].remain_qty == 5


def test_backfill_rejects_unknown_task_and_limits_days(spark, small):
    with pytest.raises(ValueError):
        backfill("nope", small, "1995-01-01", "1995-12-01")
    days = sorted(r.busi_date for r in backfill("merge", small, "1995-01-01", "1995-06-01")
                  .select("busi_date").distinct().collect())
    # runs on trading days 1995-03-01 .. 1995-06-01 write T1 = 1995-02-01 .. 1995-05-01
    assert days == ["1995-02-01", "1995-03-01", "1995-04-01", "1995-05-01"]


def test_error_diff_one_sided_groups_pass_unless_strict(spark):
    from ledgerfold.operators.quality import error_count_diff
    err = spark.createDataFrame([("long_related", "d1"), ("long_related", "d2")], "trd_type string, busi_date string")
    exc = spark.createDataFrame([("long_related", "d1", "qty")], "trd_type string, busi_date string, exception_type string")
    assert error_count_diff(err, exc).count() == 0              # d2 has no detected side: NULL diff, dropped
    rows = error_count_diff(err, exc, strict=True).collect()
    assert [(r.busi_date, r.diff_count) for r in rows] == [("d2", 1)]


def test_a_long_range_prunes_holdings_and_equals_named_days(spark, small):
    from ledgerfold.plans.backfill import backfill

    day_of = {r.rlt_rank: r.busi_date for r in small.trading_day.collect()}
    named, long = (backfill("check", small, day_of[20], day_of[30], literal_days=n) for n in (400, 0))
    rows = lambda df: sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in df.collect()), key=repr)
    assert rows(long) == rows(named) and named.count() > 100
    plan = long._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "PartitionFilters" in line and "mkt_val" in line]
    # the bounds of the range (T2 of its first day, T1 of its last) reach both holdings' scans
    assert len(scans) >= 2 and all(day_of[18] in line and day_of[29] in line for line in scans), scans
