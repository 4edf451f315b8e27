"""One trading day of the whole workflow, as the original daily jobs run it.

For calendar day D the daily driver computes T1 / T2 = the previous two trading
days and runs the tasks for T1.  ``run_day`` returns the DataFrames of every
table partition the day produces; the stateful parts (positions and lots)
resume from the previous day's stored states, so a day reads only that day's
events and holdings.  Write them with ``sinks.tables.write_partitioned`` (dynamic
overwrite: re-running a day replaces exactly its partitions).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfold.keys import LONG, SHORT
from ledgerfold.operators.exceptions import exception_detail, exception_stat
from ledgerfold.operators.lots import closed_lots, lot_state, open_lots, roll_lots
from ledgerfold.operators.positions import closed_positions, open_positions, position_state, roll_positions
from ledgerfold.plans.backfill import backfill


@dataclass
class DayOutputs:
    t1: str
    cash_flow: DataFrame
    check: DataFrame
    exceptions: DataFrame
    report: DataFrame
    open_positions: DataFrame
    closed_positions: DataFrame
    position_state: DataFrame
    open_lots: DataFrame
    closed_lots: DataFrame
    lot_state: DataFrame


def previous_trading_days(calendar: DataFrame, day: str) -> tuple[str, str] | None:
    """(T2, T1) for calendar day ``day``; None when it is not a trading day or has no T2."""
    r = calendar.where(F.col("busi_date") == day).select("rlt_rank").first()
    if r is None:
        return None
    ranks = {x.rlt_rank: x.busi_date for x in calendar.where(
        F.col("rlt_rank").isin(r[0] - 1, r[0] - 2)).collect()}  # two rows at most
    if len(ranks) < 2:
        return None
    return ranks[r[0] - 2], ranks[r[0] - 1]


def run_day(tables, day: str, position_state_t2: DataFrame, lot_state_t2: DataFrame, book: str = LONG) -> DayOutputs:
    """All partitions for trading day ``day`` (written as busi_date = T1).  The check covers both books; positions
    and lots are those of ``book``, from asset holdings (long) or debt holdings (short)."""
    days = previous_trading_days(tables.trading_day, day)
    if days is None:
        raise ValueError(f"{day} is not a trading day with two previous trading days")
    t2, t1 = days
    check = backfill("check", tables, day, day)
    events = tables.cash_flow_detail.where(F.col("busi_date") == t1)
    held, qty_col = (tables.stock_debt_holding, "liab_qty") if book == SHORT else (tables.stock_asset_holding, "qty")
    holding = held.where(F.col("busi_date") == t1)
    rolled = roll_positions(events, holding, tables.trading_day, t2, book, qty_col, state=position_state_t2, until=t1)
    lots = roll_lots(events, holding, tables.trading_day, t2, book, qty_col, state=lot_state_t2, until=t1)
    return DayOutputs(
        t1=t1,
        cash_flow=backfill("merge", tables, day, day),
        check=check,
        exceptions=exception_detail(check),
        report=exception_stat(check),
        open_positions=open_positions(rolled),
        closed_positions=closed_positions(rolled),
        position_state=position_state(rolled, t1),
        open_lots=open_lots(lots),
        closed_lots=closed_lots(lots),
        lot_state=lot_state(lots, t1),
    )
