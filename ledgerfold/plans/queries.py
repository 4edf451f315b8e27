"""Registered queries: (spark, sf_dir) -> DataFrame over the whole bound tables.

Each query binds the driver's tables (stored once per application), runs the
operators and rounds money to 2 decimals / rates to 6 so results compare across
engines.  ``oracle_sql`` holds the DuckDB statement of each.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerfold.functions.calendar import calendar_fits, day_shift, day_side, trading_days
from ledgerfold.keys import KEYS, LONG, SHORT
from ledgerfold.operators.account import account_check, holdings_pair
from ledgerfold.operators.cashflow import merge_cash_flow
from ledgerfold.operators.exceptions import exception_detail, exception_stat
from ledgerfold.operators.lots import (closed_lots, fifo_lots, fifo_matches, lot_event_records, open_lots, roll_lots,
                                       seed_lots)
from ledgerfold.operators.positions import (DETAIL_FIELDS, closed_position_details, closed_positions, detail_array_return, detail_maps,
                                            detail_return_check, event_records, open_position_details, open_positions, parse_detail_maps,
                                            position_base, position_state, roll_positions, seed_open_positions)
from ledgerfold.operators.quality import error_count_diff, error_counts, qty_identity
from ledgerfold.plans.backfill import backfill
from ledgerfold.sinks.tables import append, create_table, empty_like, replace_day, replace_partitions, save_as_table, write_partitioned
from ledgerfold.sources.binding import stored
from ledgerfold.sources.tables import read_partitioned

MONEY = 2
RATE = 6


def rounded(df: DataFrame, money: tuple[str, ...] = (), rates: tuple[str, ...] = ()) -> DataFrame:
    cols = []
    for c in df.columns:
        if c in money:
            cols.append(F.round(F.col(c), MONEY).alias(c))
        elif c in rates:
            cols.append(F.round(F.col(c), RATE).alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


def tables(spark: SparkSession, sf_dir: str):
    return stored(spark, sf_dir)


def _merged(spark, sf_dir):
    t = tables(spark, sf_dir)
    return merge_cash_flow(t.cash_flow_detail)


def _check(spark, sf_dir, books=(LONG, SHORT)):
    t = tables(spark, sf_dir)
    merged = merge_cash_flow(t.cash_flow_detail, with_names=False)
    return account_check(merged, t.stock_asset_holding, t.stock_debt_holding,
                         t.stock_return_rate_range, t.trading_day, books=books)


_CHECK_MONEY = ("pre_mkt_val", "now_mkt_val", "trd_cash_flow", "pos_cash_flow", "neg_cash_flow", "return")


def q_merge_cash_flow(spark, sf_dir):
    return rounded(_merged(spark, sf_dir), money=("trd_cash_flow", "pos_cash_flow", "neg_cash_flow", "trd_fee"))


def q_holdings_pair(spark, sf_dir):
    t = tables(spark, sf_dir)
    parts = []
    for book, h in ((LONG, t.stock_asset_holding), (SHORT, t.stock_debt_holding)):
        hp = holdings_pair(h, t.trading_day, book)
        parts.append(hp.groupBy(*KEYS, "busi_date").agg(
            F.sum("pre_q").alias("pre_qty"), F.sum("now_q").alias("now_qty"),
            F.sum("pre_v").alias("pre_mkt_val"), F.sum("now_v").alias("now_mkt_val"),
        ).withColumn("trd_type", F.lit(book)))
    out = parts[0].unionByName(parts[1])
    return rounded(out.select(*KEYS, "trd_type", "busi_date", "pre_qty", "now_qty", "pre_mkt_val", "now_mkt_val"),
                   money=("pre_mkt_val", "now_mkt_val"))


def q_check_all(spark, sf_dir):
    return rounded(_check(spark, sf_dir), money=_CHECK_MONEY, rates=("return_rate",))


def q_check_long(spark, sf_dir):
    return rounded(_check(spark, sf_dir, (LONG,)), money=_CHECK_MONEY, rates=("return_rate",))


def q_check_short(spark, sf_dir):
    return rounded(_check(spark, sf_dir, (SHORT,)), money=_CHECK_MONEY, rates=("return_rate",))


def q_exception_detail(spark, sf_dir):
    return rounded(exception_detail(_check(spark, sf_dir)),
                   money=("pre_mkt_val", "now_mkt_val", "trd_cash_flow", "pos_cash_flow"))


def q_exception_stat(spark, sf_dir):
    return rounded(exception_stat(_check(spark, sf_dir)), money=("max_return", "min_return"),
                   rates=("exception_pv_rate", "exception_uv_rate", "max_return_rate", "min_return_rate"))


def q_trading_days(spark, sf_dir):
    t = tables(spark, sf_dir)
    bounds = t.trading_day.agg(F.min("busi_date").alias("lo"), F.max("busi_date").alias("hi")).first()
    return trading_days(t.trading_day, bounds["lo"], bounds["hi"])


def q_shift_trading_day(spark, sf_dir):
    t = tables(spark, sf_dir)
    per_day = t.cash_flow_detail.groupBy("busi_date").agg(F.count(F.lit(1)).alias("n_events"))
    fits = calendar_fits(t.trading_day)
    nxt = day_shift(t.trading_day, 1, "next_date", fits)
    prv = day_shift(t.trading_day, -1, "prev_date", fits)
    return (per_day.join(day_side(t.trading_day.select("busi_date"), fits), "busi_date")
            .join(day_side(nxt, fits), "busi_date", "left").join(day_side(prv, fits), "busi_date", "left")
            .select("busi_date", "n_events", "next_date", "prev_date"))


def q_dq_error_counts(spark, sf_dir):
    return error_counts(tables(spark, sf_dir).stock_generate_error)


def q_dq_error_diff(spark, sf_dir):
    t = tables(spark, sf_dir)
    return error_count_diff(t.stock_generate_error, exception_detail(_check(spark, sf_dir)))


def q_dq_qty_identity(spark, sf_dir):
    t = tables(spark, sf_dir)
    return qty_identity(t.stock_generate_error, exception_detail(_check(spark, sf_dir)))


def _first_day(t) -> str:
    return t.trading_day.where(F.col("rlt_rank") == 1).first()["busi_date"]


def _rolled(spark, sf_dir, book=LONG):
    """A book, seeded from the holdings of the first trading day, rolled over all later days."""
    t = tables(spark, sf_dir)
    if book == SHORT:
        return roll_positions(t.cash_flow_detail, t.stock_debt_holding, t.trading_day, _first_day(t), SHORT, qty_col="liab_qty")
    return roll_positions(t.cash_flow_detail, t.stock_asset_holding, t.trading_day, _first_day(t), LONG)


def q_positions_open(spark, sf_dir):
    return open_positions(_rolled(spark, sf_dir))


def q_positions_closed(spark, sf_dir):
    return closed_positions(_rolled(spark, sf_dir))


def q_positions_resume(spark, sf_dir):
    """Daily-job style: run to the middle trading day, store that day's open-position state in
    the shared folder, then resume from the stored state; open positions of the later days."""
    t = tables(spark, sf_dir)
    n = t.trading_day.agg(F.max("rlt_rank")).first()[0]
    mid = t.trading_day.where(F.col("rlt_rank") == n // 2).first()["busi_date"]
    path = _scratch(spark, "position-state")
    start = roll_positions(t.cash_flow_detail, t.stock_asset_holding, t.trading_day, _first_day(t), LONG, until=mid)
    position_state(start, mid).write.mode("overwrite").parquet(path)
    state = spark.read.parquet(path)
    resumed = roll_positions(t.cash_flow_detail, t.stock_asset_holding, t.trading_day, mid, LONG, state=state)
    return open_positions(resumed)


def q_seed_open_positions(spark, sf_dir):
    t = tables(spark, sf_dir)
    return seed_open_positions(t.stock_asset_holding, _first_day(t))


def q_dq_detail_return(spark, sf_dir):
    return detail_return_check(closed_positions(_rolled(spark, sf_dir)))


def _detail_text(col: str = "trd_detail"):
    """Events as ``date@quantity@cents`` and, for sells, ``@cents of the return tag``."""
    cents = lambda c: F.round(c * 100).cast("long").cast("string")
    return F.concat_ws(",", F.transform(col, lambda e: F.concat_ws("@", e["trd_date"], e["trd_qty"].cast("string"), cents(e["trd_amt"]), cents(e["return"]))))


def _closed_detail(spark, sf_dir, book=LONG):
    t = tables(spark, sf_dir)
    held, qty_col = (t.stock_debt_holding, "liab_qty") if book == SHORT else (t.stock_asset_holding, "qty")
    return closed_position_details(closed_positions(_rolled(spark, sf_dir, book)), t.cash_flow_detail, held, _first_day(t), book, qty_col)


def q_positions_closed_detail(spark, sf_dir, book=LONG):
    """Closed positions with their events and return tags as text, in whole cents."""
    details = _closed_detail(spark, sf_dir, book)
    return details.select(*KEYS, "open_date", "close_date", F.size("trd_detail").cast("long").alias("n_items"), _detail_text().alias("detail"))


def q_positions_closed_detail_short(spark, sf_dir):
    return q_positions_closed_detail(spark, sf_dir, SHORT)


def q_positions_open_detail(spark, sf_dir):
    """The last day's open positions: their history is written as text maps, as the position tables hold it, read back and parsed."""
    t = tables(spark, sf_dir)
    last = _rolled(spark, sf_dir).where(F.col("busi_date") == _bounds(t)[1])
    details = open_position_details(open_positions(last), t.cash_flow_detail, t.stock_asset_holding, _first_day(t))
    path = _scratch(spark, "open-detail")
    # most texts of an event are its own: sorting them into dictionaries took more time than all else of the write
    write_partitioned(detail_maps(details.select(*KEYS, "open_date", "trd_detail", "busi_date"), DETAIL_FIELDS, optional=("return",)), path, fmt="orc", replace="all",
                      options={"orc.dictionary.key.threshold": "0"})
    stored_maps = spark.read.schema("trade_id string, secu_acc_id string, prd_no string, open_date string, trd_detail array<map<string,string>>, busi_date string").orc(path)
    back = parse_detail_maps(stored_maps)
    return back.select(*KEYS, "open_date", "busi_date", F.size("trd_detail").cast("long").alias("n_items"), _detail_text().alias("detail"))


def q_position_base(spark, sf_dir):
    """What every day's roll of the long book starts from: state of the day before, events as text, holdings."""
    t = tables(spark, sf_dir)
    base = position_base(open_positions(_rolled(spark, sf_dir)), t.cash_flow_detail, t.stock_asset_holding, t.trading_day)
    text = F.concat_ws(",", F.transform("events", lambda e: F.concat_ws("@", e["trd_qty"].cast("string"), F.round(e["trd_amt"] * 100).cast("long").cast("string"), e["timestamp"].cast("string"))))
    whole = {c: F.col(c).cast("double") for c in ("state_qty", "remain_qty")}  # NULL where there is no state
    return base.withColumns(whole).withColumn("n_events", F.size("events").cast("long")).withColumn("events", text)


def _unknown_account(df):
    """One customer's first account is not known."""
    return df.withColumn("secu_acc_id", F.when(~((F.col("trade_id") == "7") & (F.col("secu_acc_id") == "0")), F.col("secu_acc_id")))


def q_positions_null_keys(spark, sf_dir):
    t = tables(spark, sf_dir)
    return open_positions(roll_positions(_unknown_account(t.cash_flow_detail), _unknown_account(t.stock_asset_holding), t.trading_day, _first_day(t)))


def q_fifo_null_keys(spark, sf_dir):
    t = tables(spark, sf_dir)
    return fifo_lots(_unknown_account(t.cash_flow_detail), t.trading_day)


def q_lots_null_keys(spark, sf_dir):
    t = tables(spark, sf_dir)
    return open_lots(roll_lots(_unknown_account(t.cash_flow_detail), _unknown_account(t.stock_asset_holding), t.trading_day, _first_day(t)))


def q_lots_open_short(spark, sf_dir):
    return open_lots(_lots(spark, sf_dir, SHORT))


def q_lots_closed_short(spark, sf_dir):
    return closed_lots(_lots(spark, sf_dir, SHORT))


def q_dq_detail_array(spark, sf_dir):
    return rounded(detail_array_return(_closed_detail(spark, sf_dir)), money=("return", "detail_return_sum"))


def q_event_records(spark, sf_dir):
    """Ordered events per (position, day) of the long book, as a canonical 'qty@timestamp' list."""
    t = tables(spark, sf_dir)
    er = event_records(t.cash_flow_detail, LONG)
    return er.select(
        *KEYS, "busi_date", F.size("trd_detail").cast("long").alias("n_items"),
        F.concat_ws(",", F.transform("trd_detail", lambda e: F.concat(
            e["trd_qty"].cast("string"), F.lit("@"), e["timestamp"].cast("string")))).alias("detail"))


def q_seed_lots(spark, sf_dir):
    t = tables(spark, sf_dir)
    return seed_lots(t.stock_asset_holding, _first_day(t))


def q_lot_event_records(spark, sf_dir):
    """Ordered lot events per (position, day) of the long book as 'qty@cents@label' lists."""
    t = tables(spark, sf_dir)
    er = lot_event_records(t.cash_flow_detail, LONG)
    return er.select(
        *KEYS, "busi_date", F.size("trd_detail").cast("long").alias("n_items"),
        F.concat_ws(",", F.transform("trd_detail", lambda e: F.concat_ws(
            "@", e["trd_qty"].cast("string"), F.round(e["trd_cash_flow"] * 100).cast("long").cast("string"),
            e["amortize_label"].cast("string")))).alias("detail"))


def q_fifo_matches(spark, sf_dir):
    t = tables(spark, sf_dir)
    return fifo_matches(t.cash_flow_detail, t.trading_day, LONG).drop("match_cost_c", "match_proceeds_c")


def q_fifo_lots(spark, sf_dir):
    t = tables(spark, sf_dir)
    return fifo_lots(t.cash_flow_detail, t.trading_day, LONG)


def _lots(spark, sf_dir, book=LONG):
    t = tables(spark, sf_dir)
    if book == SHORT:
        return roll_lots(t.cash_flow_detail, t.stock_debt_holding, t.trading_day, _first_day(t), SHORT, "liab_qty")
    return roll_lots(t.cash_flow_detail, t.stock_asset_holding, t.trading_day, _first_day(t), LONG)


def q_lots_open(spark, sf_dir):
    return open_lots(_lots(spark, sf_dir))


def q_lots_closed(spark, sf_dir):
    return closed_lots(_lots(spark, sf_dir))


def _bounds(t):
    b = t.trading_day.agg(F.min("busi_date").alias("lo"), F.max("busi_date").alias("hi")).first()
    return b["lo"], b["hi"]


def q_backfill_merge(spark, sf_dir):
    t = tables(spark, sf_dir)
    lo, hi = _bounds(t)
    return rounded(backfill("merge", t, lo, hi), money=("trd_cash_flow", "pos_cash_flow", "neg_cash_flow", "trd_fee"))


def q_backfill_check(spark, sf_dir):
    t = tables(spark, sf_dir)
    lo, hi = _bounds(t)
    return rounded(backfill("check", t, lo, hi), money=_CHECK_MONEY, rates=("return_rate",))


def _scratch(spark, name: str) -> str:
    import uuid

    from ledgerfold.session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/ledgerfold-sink-{name}-{uuid.uuid4().hex[:10]}"


def q_sink_replace_day(spark, sf_dir):
    """Write the merged flows of every day as a day-partitioned table, then recompute and
    replace the last day from that day's events only; read the table back."""
    t = tables(spark, sf_dir)
    path = _scratch(spark, "cash-flow")
    write_partitioned(_merged(spark, sf_dir), path, replace="all")
    last = _bounds(t)[1]
    write_partitioned(merge_cash_flow(t.cash_flow_detail.where(F.col("busi_date") == last)), path, replace="dynamic")
    back = read_partitioned(spark, path, _merged(spark, sf_dir).schema)
    return rounded(back, money=("trd_cash_flow", "pos_cash_flow", "neg_cash_flow", "trd_fee"))


def q_sink_check_books(spark, sf_dir):
    """Long book written first, short book appended into the same day partitions, then one
    day replaced with both books again; read back, the table equals check_all."""
    t = tables(spark, sf_dir)
    path = _scratch(spark, "check")
    write_partitioned(_check(spark, sf_dir, (LONG,)), path, replace="all")
    write_partitioned(_check(spark, sf_dir, (SHORT,)), path, replace="append")
    last = _bounds(t)[1]
    write_partitioned(_check(spark, sf_dir).where(F.col("busi_date") == last), path, replace="dynamic")
    back = read_partitioned(spark, path, _check(spark, sf_dir).schema)
    return rounded(back, money=_CHECK_MONEY, rates=("return_rate",))


def q_positions_open_short(spark, sf_dir):
    return open_positions(_rolled(spark, sf_dir, SHORT))


def q_positions_closed_short(spark, sf_dir):
    return closed_positions(_rolled(spark, sf_dir, SHORT))


def q_fifo_matches_short(spark, sf_dir):
    t = tables(spark, sf_dir)
    return fifo_matches(t.cash_flow_detail, t.trading_day, SHORT).drop("match_cost_c", "match_proceeds_c")


def q_fifo_lots_short(spark, sf_dir):
    t = tables(spark, sf_dir)
    return fifo_lots(t.cash_flow_detail, t.trading_day, SHORT)


def q_dq_lots_balance(spark, sf_dir):
    """Open quantity of every position-day's lots."""
    return open_lots(_lots(spark, sf_dir)).groupBy(*KEYS, "busi_date").agg(
        F.round(F.sum("unclose_qty")).cast("long").alias("unclose_qty"))


def q_check_day(spark, sf_dir):
    """The check of one day alone, whose endpoints prune the scans."""
    t = tables(spark, sf_dir)
    last = _bounds(t)[1]
    merged = merge_cash_flow(t.cash_flow_detail.where(F.col("busi_date") == last), with_names=False)
    out = account_check(merged, t.stock_asset_holding, t.stock_debt_holding, t.stock_return_rate_range, t.trading_day, t1=last)
    return rounded(out, money=_CHECK_MONEY, rates=("return_rate",))


def q_check_null_keys(spark, sf_dir):
    """The check where one customer's account is unknown: holdings and flows that match nothing stay."""
    t = tables(spark, sf_dir)
    hide = lambda df: df.withColumn("secu_acc_id", F.when(F.col("trade_id") != "7", F.col("secu_acc_id")))
    out = account_check(merge_cash_flow(hide(t.cash_flow_detail), with_names=False), hide(t.stock_asset_holding),
                        hide(t.stock_debt_holding), t.stock_return_rate_range, t.trading_day)
    return rounded(out, money=_CHECK_MONEY, rates=("return_rate",))


def q_backfill_exception_detail(spark, sf_dir):
    t = tables(spark, sf_dir)
    return rounded(backfill("check_exception_detail", t, *_bounds(t)), money=("pre_mkt_val", "now_mkt_val", "trd_cash_flow", "pos_cash_flow"))


def q_backfill_exception_stat(spark, sf_dir):
    t = tables(spark, sf_dir)
    return rounded(backfill("check_exception_stat", t, *_bounds(t)), money=("max_return", "min_return"),
                   rates=("exception_pv_rate", "exception_uv_rate", "max_return_rate", "min_return_rate"))


def _catalog_merged(spark, sf_dir):
    """The merged flows of all days in a catalog table whose files are in the shared folder; its name."""
    import uuid

    name = f"stock_cash_flow_{uuid.uuid4().hex[:12]}"
    df = _merged(spark, sf_dir)
    create_table(spark, name, df.schema, fmt="parquet", location=_scratch(spark, name))
    append(df.hint("rebalance", "busi_date"), name)
    return name, df


def q_sink_catalog_replace(spark, sf_dir):
    """The last day of a catalog table replaced by changed rows: one book, quantities doubled; read back."""
    name, df = _catalog_merged(spark, sf_dir)
    last = _bounds(tables(spark, sf_dir))[1]
    changed = df.where((F.col("busi_date") == last) & (F.col("trd_type") == LONG)).withColumn("trd_qty", F.col("trd_qty") * 2)
    replace_day(changed, name, last)
    return rounded(spark.table(name).select(*df.columns), money=("trd_cash_flow", "pos_cash_flow", "neg_cash_flow", "trd_fee"))


def q_sink_empty_day(spark, sf_dir):
    """The last day of a catalog table replaced by no rows; read back."""
    name, df = _catalog_merged(spark, sf_dir)
    replace_day(empty_like(df), name, _bounds(tables(spark, sf_dir))[1])
    return rounded(spark.table(name).select(*df.columns), money=("trd_cash_flow", "pos_cash_flow", "neg_cash_flow", "trd_fee"))


def q_sink_switch_days(spark, sf_dir):
    """The last two days of a catalog table replaced together: one by its long book, the other by nothing; read back."""
    name, df = _catalog_merged(spark, sf_dir)
    days = [r.busi_date for r in tables(spark, sf_dir).trading_day.orderBy(F.desc("rlt_rank")).limit(2).collect()]
    replace_partitions(df.where((F.col("busi_date") == days[0]) & (F.col("trd_type") == LONG)), name, days)
    return rounded(spark.table(name).select(*df.columns), money=("trd_cash_flow", "pos_cash_flow", "neg_cash_flow", "trd_fee"))


def q_sink_self_overwrite(spark, sf_dir):
    """A catalog table saved from its own rows: the long book only, with quantities doubled; read back."""
    name, df = _catalog_merged(spark, sf_dir)
    own = spark.table(name)
    save_as_table(own.where(F.col("trd_type") == LONG).withColumn("trd_qty", F.col("trd_qty") * 2), name, fmt="parquet")
    return rounded(spark.table(name).select(*df.columns), money=("trd_cash_flow", "pos_cash_flow", "neg_cash_flow", "trd_fee"))


def q_backfill_long_range(spark, sf_dir):
    """The check of the later half of the trading days, planned as a range that is too long to name its days."""
    t = tables(spark, sf_dir)
    n = t.trading_day.agg(F.max("rlt_rank")).first()[0]
    from_day = t.trading_day.where(F.col("rlt_rank") == n // 2).first()["busi_date"]
    return rounded(backfill("check", t, from_day, _bounds(t)[1], literal_days=0), money=_CHECK_MONEY, rates=("return_rate",))


def q_dq_error_range(spark, sf_dir):
    """Injected errors of the later half of the trading days, by book and day."""
    t = tables(spark, sf_dir)
    n = t.trading_day.agg(F.max("rlt_rank")).first()[0]
    from_day = t.trading_day.where(F.col("rlt_rank") == n // 2).first()["busi_date"]
    return error_counts(t.stock_generate_error, from_day, _bounds(t)[1])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "merge_cash_flow": q_merge_cash_flow,
    "holdings_pair": q_holdings_pair,
    "check_all": q_check_all,
    "check_long": q_check_long,
    "check_short": q_check_short,
    "exception_detail": q_exception_detail,
    "exception_stat": q_exception_stat,
    "trading_days": q_trading_days,
    "shift_trading_day": q_shift_trading_day,
    "dq_error_counts": q_dq_error_counts,
    "dq_error_diff": q_dq_error_diff,
    "dq_qty_identity": q_dq_qty_identity,
    "event_records": q_event_records,
    "seed_open_positions": q_seed_open_positions,
    "positions_open": q_positions_open,
    "positions_closed": q_positions_closed,
    "positions_resume": q_positions_resume,
    "dq_detail_return": q_dq_detail_return,
    "positions_closed_detail": q_positions_closed_detail,
    "dq_detail_array": q_dq_detail_array,
    "seed_lots": q_seed_lots,
    "lot_event_records": q_lot_event_records,
    "fifo_matches": q_fifo_matches,
    "fifo_lots": q_fifo_lots,
    "lots_open": q_lots_open,
    "lots_closed": q_lots_closed,
    "backfill_merge": q_backfill_merge,
    "backfill_check": q_backfill_check,
    "sink_replace_day": q_sink_replace_day,
    "sink_check_books": q_sink_check_books,
    "sink_catalog_replace": q_sink_catalog_replace,
    "sink_empty_day": q_sink_empty_day,
    "backfill_exception_detail": q_backfill_exception_detail,
    "backfill_exception_stat": q_backfill_exception_stat,
    "check_day": q_check_day,
    "check_null_keys": q_check_null_keys,
    "positions_open_short": q_positions_open_short,
    "positions_closed_short": q_positions_closed_short,
    "fifo_matches_short": q_fifo_matches_short,
    "fifo_lots_short": q_fifo_lots_short,
    "dq_lots_balance": q_dq_lots_balance,
    "lots_open_short": q_lots_open_short,
    "lots_closed_short": q_lots_closed_short,
    "positions_closed_detail_short": q_positions_closed_detail_short,
    "positions_open_detail": q_positions_open_detail,
    "position_base": q_position_base,
    "positions_null_keys": q_positions_null_keys,
    "fifo_null_keys": q_fifo_null_keys,
    "lots_null_keys": q_lots_null_keys,
    "sink_switch_days": q_sink_switch_days,
    "sink_self_overwrite": q_sink_self_overwrite,
    "dq_error_range": q_dq_error_range,
    "backfill_long_range": q_backfill_long_range,
}
