"""Calendar helpers, table writers and plan shape."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from fixtures import calendar
from ledgerfold.functions.calendar import shift_trading_day, trading_days
from ledgerfold.schemas import STOCK_CASH_FLOW
from ledgerfold.sinks.tables import (add_partition, append, conform, create_table, ddl, empty_like, replace_day,
                                     replace_partitions, save_as_table, write_partitioned)
from ledgerfold.session import ensure_checkpoint_dir


def test_trading_days_and_shift(spark):
    cal = calendar(spark, ["2017-03-16", "2017-03-17", "2017-03-20", "2017-03-21"])
    rows = trading_days(cal, "2017-03-16", "2017-03-21").orderBy("busi_date").collect()
    # 03-18/19 are not trading days; the first two days have no T2
    assert [(r.busi_date, r.t1_date, r.t2_date) for r in rows] == [
        ("2017-03-20", "2017-03-17", "2017-03-16"), ("2017-03-21", "2017-03-20", "2017-03-17")]
    d = spark.createDataFrame([("2017-03-16",), ("2017-03-20",)], "busi_date string")
    s = {r.busi_date: r.shifted_date for r in shift_trading_day(d, cal, -1).collect()}
    assert s == {"2017-03-16": None, "2017-03-20": "2017-03-17"}


def test_trading_days_errors(spark):
    cal = calendar(spark, ["2017-03-16"])
    with pytest.raises(ValueError):
        trading_days(cal, "2017-03-20", "2017-03-16")
    with pytest.raises(ValueError):
        trading_days(cal, "20170316", "2017-03-20")


def _scratch(spark):
    return os.path.join(ensure_checkpoint_dir(spark).replace("file:", ""), "t-" + uuid.uuid4().hex[:8])


def test_dynamic_overwrite_replaces_only_present_days_and_is_idempotent(spark):
    path = _scratch(spark)
    df = spark.createDataFrame([("a", 1, "d1"), ("b", 2, "d2")], "k string, v int, busi_date string")
    write_partitioned(df, path, replace="all")
    new = spark.createDataFrame([("c", 3, "d2")], "k string, v int, busi_date string")
    write_partitioned(new, path)
    write_partitioned(new, path)
    got = sorted((r.k, r.v, r.busi_date) for r in spark.read.parquet(path).collect())
    assert got == [("a", 1, "d1"), ("c", 3, "d2")]


def test_writer_options_reach_the_files(spark):
    path = f"{_scratch(spark)}/t"
    df = spark.createDataFrame([("a", "d1"), ("b", "d2")], "k string, busi_date string")
    write_partitioned(df, path, fmt="orc", replace="all", options={"compression": "zlib", "orc.dictionary.key.threshold": "0"})
    names = [r.p for r in spark.read.orc(path).select(F.input_file_name().alias("p")).distinct().collect()]
    assert len(names) == 2 and all(p.endswith(".zlib.orc") for p in names)
    assert sorted((r.k, r.busi_date) for r in spark.read.orc(path).collect()) == [("a", "d1"), ("b", "d2")]


def test_catalog_table_ddl_partition_and_replace_day(spark):
    name = "cf_" + uuid.uuid4().hex[:8]
    text = ddl(name, STOCK_CASH_FLOW)
    assert "PARTITIONED BY (busi_date)" in text and "COMMENT 'customer id'" in text
    create_table(spark, name, STOCK_CASH_FLOW, fmt="parquet")
    add_partition(spark, name, "2017-03-16")
    add_partition(spark, name, "2017-03-16")  # idempotent
    row = spark.createDataFrame([("1", "", "1.1", "2017-03-16")], "trade_id string, secu_acc_id string, prd_no string, busi_date string") \
        .withColumn("trd_qty", F.lit(5))
    replace_day(row, name, "2017-03-16")
    replace_day(row, name, "2017-03-16")
    out = spark.table(name).collect()
    assert len(out) == 1 and out[0].trd_qty == 5 and out[0].busi_flag_code is None
    with pytest.raises(ValueError):
        replace_day(row, "no_such_table_" + name, "2017-03-16")


def _days_of(df):
    return sorted((r.k, r.busi_date) for r in df.select("k", "busi_date").collect())


@pytest.mark.parametrize("mode", ["static", "dynamic"])
@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_replacing_a_day_keeps_the_others_in_any_session(spark, mode, fmt):
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        name = "rd_" + uuid.uuid4().hex[:8]
        df = spark.createDataFrame([("a", "d1"), ("b", "d2")], "k string, busi_date string")
        create_table(spark, name, df.schema, fmt=fmt)
        replace_partitions(df, name)
        replace_day(spark.createDataFrame([("c", "d2")], "k string, busi_date string"), name, "d2")
        assert _days_of(spark.table(name)) == [("a", "d1"), ("c", "d2")]
        replace_day(empty_like(df), name, "d2")  # a run without rows empties its day
        assert _days_of(spark.table(name)) == [("a", "d1")]
        with pytest.raises(Exception, match="not to be replaced"):
            replace_day(df, name, "d2")
        assert _days_of(spark.table(name)) == [("a", "d1")]

        path = _scratch(spark)
        write_partitioned(df, path, replace="all", fmt=fmt)
        write_partitioned(empty_like(df), path, fmt=fmt, days=["d2"])
        assert _days_of(spark.read.format(fmt).load(path)) == [("a", "d1")]
        write_partitioned(df.where("k = 'b'"), path, replace="all", fmt=fmt)
        assert _days_of(spark.read.format(fmt).load(path)) == [("b", "d2")]
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == mode
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


def test_conform_and_empty_like(spark):
    df = spark.createDataFrame([(1, "x")], "trd_qty int, trade_id string")
    c = conform(df, STOCK_CASH_FLOW)
    assert c.columns == [f.name for f in STOCK_CASH_FLOW.fields]
    assert dict(c.dtypes)["trd_qty"] == "bigint"
    assert empty_like(c).count() == 0 and empty_like(c).schema == c.schema


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_stay_in_the_jvm_and_push_filters(spark, small):
    from ledgerfold.operators.account import account_check
    from ledgerfold.operators.cashflow import merge_cash_flow
    from ledgerfold.operators.positions import roll_positions
    t = small
    merged = merge_cash_flow(t.cash_flow_detail)
    chk = account_check(merged, t.stock_asset_holding, t.stock_debt_holding, t.stock_return_rate_range, t.trading_day)
    first = t.trading_day.where(F.col("rlt_rank") == 1).first()["busi_date"]
    pos = roll_positions(t.cash_flow_detail, t.stock_asset_holding, t.trading_day, first)
    for df in (merged, chk, pos):
        p = _plan(df)
        assert "Python" not in p and "ArrowEval" not in p and "MapInPandas" not in p
    one_day = merge_cash_flow(t.cash_flow_detail.where(F.col("busi_date") == first))
    # the stored events are partitioned by day: the filter selects a folder
    assert "PartitionFilters: [isnotnull(busi_date#" in _plan(one_day) and f"= {first})]" in _plan(one_day)
    pushed = merge_cash_flow(t.cash_flow_detail.where(F.col("trd_type") == "long_related"))
    assert "EqualTo(trd_type,long_related)" in _plan(pushed)


def test_every_table_ddl_creates(spark):
    from ledgerfold.schemas import PARTITION, TABLES
    from ledgerfold.sinks.tables import create_database
    db = "fdata_" + uuid.uuid4().hex[:6]
    create_database(spark, db)
    for name, schema in TABLES.items():
        part = (PARTITION[name],) if PARTITION[name] else ()
        create_table(spark, f"{db}.{name}", schema, partition_cols=part, fmt="orc")
        assert spark.catalog.tableExists(f"{db}.{name}")
        cols = [f.name for f in schema.fields if f.name not in part] + list(part)  # partitions go last
        assert spark.table(f"{db}.{name}").columns == cols


def test_calendar_broadcast_is_checked_and_falls_back(spark):
    from ledgerfold.functions.calendar import calendar_fits, day_shift
    cal = calendar(spark, ["2017-03-16", "2017-03-17", "2017-03-20"])
    assert calendar_fits(cal) and not calendar_fits(cal, limit=2)
    a = sorted(map(tuple, day_shift(cal, -1, fits=True).collect()))
    b = sorted(map(tuple, day_shift(cal, -1, fits=False).collect()))
    assert a == b == [("2017-03-17", "2017-03-16"), ("2017-03-20", "2017-03-17")]


def test_check_reads_each_input_once_and_a_day_prunes(spark, small):
    from ledgerfold.operators.account import account_check
    from ledgerfold.operators.cashflow import merge_cash_flow
    from ledgerfold.operators.exceptions import exception_stat
    from ledgerfold.plans.backfill import backfill
    t = small
    chk = account_check(merge_cash_flow(t.cash_flow_detail, with_names=False), t.stock_asset_holding, t.stock_debt_holding, t.stock_return_rate_range, t.trading_day)
    for df in (chk, exception_stat(chk)):
        scans = [x for x in _plan(df).split("\n") if "FileScan" in x]
        assert [sum(c in x for x in scans) for c in ("trd_cash_flow", "liab_qty", "[trade_id#")] == [1, 1, 3]
    days = [r.busi_date for r in t.trading_day.orderBy("rlt_rank").collect()]
    scans = [x for x in _plan(backfill("check", t, days[-1], days[-1])).split("\n") if "FileScan" in x and "[trade_id#" in x]
    assert len(scans) == 3 and all("PartitionFilters: [" in x and days[-2] in x for x in scans)
    assert sum(days[-3] in x for x in scans) == 2 and not any(days[-4] in x for x in scans)


def test_no_checkpoint_folder_on_a_cluster_is_an_error():
    from types import SimpleNamespace
    context = SimpleNamespace(master="yarn", getCheckpointDir=lambda: None)
    session = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda k, d=None: d))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(session)


def _days_table(spark, name):
    schema = "k string, busi_date string"
    create_table(spark, name, spark.createDataFrame([], schema).schema, fmt="parquet")
    replace_partitions(spark.createDataFrame([("a", "d1"), ("b", "d2"), ("c", "d3")], schema), name)
    return lambda: sorted(tuple(r) for r in spark.table(name).select("k", "busi_date").collect())


def test_filled_and_cleared_days_are_switched_together(spark, monkeypatch):
    from ledgerfold.sinks import tables as S

    name = "switched_days"
    rows = _days_table(spark, name)
    new = spark.createDataFrame([("x", "d1"), ("y", "d4")], "k string, busi_date string")

    def fails(*a):
        raise RuntimeError("lost the driver")

    with monkeypatch.context() as m:  # between writing and switching: every day is whole and old
        m.setattr(S, "switch_days", fails)
        with pytest.raises(RuntimeError):
            replace_partitions(new, name, ["d1", "d2", "d4"])
    spark.catalog.refreshTable(name)
    assert rows() == [("a", "d1"), ("b", "d2"), ("c", "d3")]
    with pytest.raises(Exception, match="not to be replaced"):  # a row of another day fails before anything is switched
        replace_partitions(new, name, ["d1", "d2"])
    assert rows() == [("a", "d1"), ("b", "d2"), ("c", "d3")]
    replace_partitions(new, name, ["d1", "d2", "d4"])
    assert rows() == [("c", "d3"), ("x", "d1"), ("y", "d4")]
    assert {r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()} == {f"busi_date=d{i}" for i in (1, 2, 3, 4)}
    # later writes of both kinds go on from there
    append(spark.createDataFrame([("z", "d2")], "k string, busi_date string"), name)
    replace_partitions(spark.createDataFrame([("w", "d1")], "k string, busi_date string"), name)
    replace_day(spark.createDataFrame([("v", "d3")], "k string, busi_date string"), name, "d3")
    assert rows() == [("v", "d3"), ("w", "d1"), ("y", "d4"), ("z", "d2")]
    spark.sql(f"DROP TABLE {name}")


def test_a_table_made_from_itself(spark):
    name = "made_from_itself"
    save_as_table(spark.createDataFrame([("a", 1, "d1"), ("b", 2, "d2")], "k string, n int, busi_date string"), name, fmt="parquet")
    for _ in range(2):
        save_as_table(spark.table(name).withColumn("n", F.col("n") * 10).where("k <> 'b' OR n < 1000"), name, fmt="parquet")
    assert sorted(tuple(r) for r in spark.table(name).select("k", "n", "busi_date").collect()) == [("a", 100, "d1"), ("b", 200, "d2")]
    replace_day(spark.table(name).where("busi_date = 'd1'").withColumn("n", F.lit(7)), name, "d1")
    assert sorted(tuple(r) for r in spark.table(name).select("k", "n", "busi_date").collect()) == [("a", 7, "d1"), ("b", 200, "d2")]
    spark.sql(f"DROP TABLE {name}")
