"""Lot matching: first-in first-out lots per position, their closing proceeds and returns.

Two operators:

``fifo_matches`` / ``fifo_lots`` - plain FIFO (no amortisation, no holdings
reconciliation), fully relational.  On each position's cumulative-quantity axis
every buy covers [B - q, B) and every sell covers its *effective* interval (a
sell larger than the inventory is cut to it: the excess is dropped, via the
running minimum of the signed position).  A buy and a sell match on the overlap
of their intervals, cash pro rata by quantity.  The overlaps are found by
merging the interval end points in axis order (windows over sorted boundaries,
per bucket of the quantity axis), never by pairing every buy with every sell.
Cumulative sums run inside ranges of the sorted events, and each range adds what its first position
brings from the ranges before it, so a busy position - even a busy second of it - is spread over many tasks.

``roll_lots`` - the full lot fold with amortising trades, sells across
lots, holdings reconciliation (newest lot first), surplus holdings and the
weighted term, in two steps:

1. ``lot_log``: what changes.  The state of a day feeds the next, so each position is folded in day
   and time order: rows are hash-partitioned by position, sorted, and streamed
   through ``mapInPandas`` - a task keeps only the open lots of the
   position it is on.  Only days on which something can change reach Python: days with trades, and days whose holdings
   differ from those of the day before.  It gives one row per run of days in which a lot does not change.
2. ``expand_lots``: the daily table.  Runs are exploded to their days inside the JVM, valued from
   the day's holdings, and the weighted term follows in closed form: what it was before the run, and days times ratio.

A NULL key part is a value of its own in all of these (``keys.encode_keys``).
"""

from __future__ import annotations

import uuid
from collections import deque
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerfold.functions.calendar import calendar_fits, day_side, roll_bounds
from ledgerfold.keys import KEYS, LONG, decode_keys, encode_keys
from ledgerfold.session import ensure_checkpoint_dir
from ledgerfold.sources.binding import EVENT_ORDER, TIE_COLS

# ---------------------------------------------------------------------------
# Relational FIFO


def _lot_events(detail: DataFrame, calendar: DataFrame, book: str) -> DataFrame:
    ok = F.col("trd_qty").isNotNull() & F.col("trd_cash_flow").isNotNull() & F.col("timestamp").isNotNull()
    ev = detail.where((F.col("trd_type") == book) & ok & (F.col("amortize_label") == 0) & (F.col("trd_qty") != 0))
    cal = day_side(calendar.select("busi_date", F.col("rlt_rank").cast("int").alias("rank")), calendar_fits(calendar))
    return ev.join(cal, "busi_date").select(
        *KEYS, "rank", "busi_date", *EVENT_ORDER, F.col("trd_qty").cast("long").alias("q"),
        F.col("trd_cash_flow").cast("double").alias("cash"),
        F.round(F.col("trd_cash_flow") * 100).cast("long").alias("cash_c"))


_RUNNING = T.StructType([
    *[T.StructField(k, T.StringType()) for k in KEYS], T.StructField("busi_date", T.StringType()),
    *[T.StructField(c, T.LongType()) for c in EVENT_ORDER], T.StructField("q", T.LongType()),
    T.StructField("cash", T.DoubleType()), T.StructField("cash_c", T.LongType()),
    T.StructField("part", T.IntegerType()), T.StructField("total", T.BooleanType()),
    T.StructField("b", T.LongType()), T.StructField("s", T.LongType()),
    T.StructField("low", T.LongType()), T.StructField("low_before", T.LongType()),
])


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Running figures of every position inside one range of sorted events: bought (b), sold (s), and the least signed
    sum up to the event (low) and before it.  A ``total`` row tells where a position that may go on in other ranges has
    got to: only the first and the last one of a range can."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    key, b0, s0, low0, first = None, 0, 0, None, True
    names = [f.name for f in _RUNNING.fields]
    types = [pa.string()] * 4 + [pa.int64()] * (len(EVENT_ORDER) + 1) + [pa.float64(), pa.int64(), pa.int32(), pa.bool_()] + [pa.int64()] * 4

    def total() -> pa.RecordBatch:
        row = [*key, *[None] * (len(EVENT_ORDER) + 4), part, True, b0, s0, low0, None]
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types)], names=names)

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        held = [batch.column(i) for i in range(len(KEYS))]
        new = np.zeros(n, bool)
        for c in held:
            new[1:] |= pc.not_equal(c.slice(1), c.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        heads = tuple(c[0].as_py() for c in held)
        new[0] = heads != key
        if new[0] and key is not None and first:
            yield total()
            first = False
        group = np.cumsum(new)
        q = batch.column(names.index("q")).to_numpy(zero_copy_only=False)
        runs = pd.DataFrame({"g": group, "b": np.maximum(q, 0), "s": np.maximum(-q, 0)})
        sums = runs.groupby("g", sort=False).cumsum()
        b, s = sums["b"].to_numpy().copy(), sums["s"].to_numpy().copy()
        goes_on = group == 0
        b[goes_on] += b0
        s[goes_on] += s0
        low = pd.Series(b - s).groupby(group, sort=False).cummin().to_numpy().copy()
        if low0 is not None:
            low[goes_on] = np.minimum(low[goes_on], low0)
        before = np.concatenate([[0], low[:-1]])
        known = ~new
        if goes_on[0]:
            before[0] = low0
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(np.zeros(n, bool)), pa.array(b), pa.array(s), pa.array(low), pa.array(before, mask=~known)], names=names)
        if first and new[1:].any():
            at = int(np.nonzero(new[1:])[0][0])  # the last row of the range's first position
            key, b0, s0, low0 = tuple(c[at].as_py() for c in held), int(b[at]), int(s[at]), int(low[at])
            yield total()
            first = False
        key, b0, s0, low0 = tuple(c[n - 1].as_py() for c in held), int(b[-1]), int(s[-1]), int(low[-1])
    if key is not None:
        yield total()


def sorted_events(detail: DataFrame, calendar: DataFrame, book: str = LONG) -> DataFrame:
    """The book's events in ranges of (position, day, second, tie-break), each range one task, with their running figures
    (``_running``).  Written once to the checkpoint folder: the ranges' totals and their events are both read from it."""
    ev = _lot_events(encode_keys(detail), calendar, book)
    columns = [*KEYS, "busi_date", *EVENT_ORDER, "q", "cash", "cash_c"]
    order = [*KEYS, "rank", *EVENT_ORDER]
    ev = ev.repartitionByRange(*order).sortWithinPartitions(*order).select(
        *KEYS, "busi_date", *[F.col(c).cast("long").alias(c) for c in EVENT_ORDER], "q", "cash", "cash_c").select(*columns)
    path = f"{ensure_checkpoint_dir(detail.sparkSession).rstrip('/')}/fifo-events-{uuid.uuid4().hex}"
    ev.mapInArrow(_running, _RUNNING).write.parquet(path)
    return detail.sparkSession.read.schema(_RUNNING).parquet(path)


def fifo_intervals(detail: DataFrame, calendar: DataFrame, book: str = LONG) -> DataFrame:
    """Per event: its interval on the position's cumulative axis (buys: bought quantity,
    sells: effective sold quantity after dropping oversells).

    Events are shuffled once, into ranges that cut a busy position wherever they must; what a range's first position
    brings from earlier ranges is a row a range at most, so that table is broadcast."""
    ev = sorted_events(detail, calendar, book)
    # at most two rows a range; those of one position follow each other
    earlier = Window.partitionBy(*KEYS).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    total = ev.where("total").select(*KEYS, "part", F.sum("b").over(earlier).alias("b0"), F.sum("s").over(earlier).alias("s0"), "low").withColumn("r0", F.col("b0") - F.col("s0"))
    total = total.withColumn("low0", F.min(F.coalesce("r0", F.lit(0)) + F.col("low")).over(earlier)).where("b0 IS NOT NULL").drop("low")
    e = ev.where("NOT total").join(F.broadcast(total), [*KEYS, "part"], "left")
    zero = F.lit(0).cast("long")
    b_cum, s_cum = (F.col(c) + F.coalesce(f"{c}0", zero) for c in ("b", "s"))
    # what was sold beyond all that was bought so far: the running minimum below zero (least() skips NULLs)
    r0 = F.coalesce("r0", zero)
    dropped = -F.least(zero, F.col("low0"), r0 + F.col("low"))
    dropped_prev = -F.least(zero, F.col("low0"), r0 + F.col("low_before"))
    sq = -F.col("q")
    out = e.select(
        *KEYS, "busi_date", *[F.col(c).cast(detail.schema[c].dataType).alias(c) for c in EVENT_ORDER], "q", "cash", "cash_c",
        F.when(F.col("q") > 0, b_cum - F.col("q")).alias("buy_start"),
        F.when(F.col("q") > 0, b_cum).alias("buy_end"),
        F.when(F.col("q") < 0, s_cum - sq - dropped_prev).alias("sell_start"),
        F.when(F.col("q") < 0, s_cum - dropped).alias("sell_end"),
    )
    return decode_keys(out, detail)


BUCKET_QTY = 1 << 20  # width of a cumulative-quantity bucket for the boundary merge


def fifo_matches(detail: DataFrame, calendar: DataFrame, book: str = LONG, bucket_qty: int = BUCKET_QTY) -> DataFrame:
    """One row per (buy, sell) pair that FIFO matches (see ``matches_from_intervals``)."""
    return matches_from_intervals(fifo_intervals(detail, calendar, book), bucket_qty)


def matches_from_intervals(iv: DataFrame, bucket_qty: int = BUCKET_QTY, keep_unmatched: bool = False) -> DataFrame:
    """One row per (buy, sell) pair that FIFO matches, with quantity, cost share and proceeds share.

    The cumulative-quantity axis of each position is cut into buckets of ``bucket_qty``; every
    interval is clipped to the buckets it overlaps (an interval longer than a bucket is copied
    once per bucket).  Buy intervals tile the axis and so do effective sell intervals, so within
    one (position, bucket) the merge of end points is self-contained, and a group holds at most
    about 2 * bucket_qty end points (quantities are whole numbers) - a busy position is spread
    over many buckets instead of one sort.  ``keep_unmatched`` adds a (buy, NULL) row for the
    unsold part of each buy, so every buy appears at least once.
    """
    w_ = int(bucket_qty)
    ev_fields = ["busi_date", *EVENT_ORDER, "q", "cash_c"]

    # every buy and every (non-empty) effective sell gives one interval, in a single pass
    is_buy = F.col("q") > 0
    rec = F.struct(*ev_fields)
    iv = iv.where(is_buy | ((F.col("q") < 0) & (F.col("sell_end") > F.col("sell_start")))).select(
        *KEYS,
        F.when(is_buy, F.col("buy_start")).otherwise(F.col("sell_start")).alias("lo"),
        F.when(is_buy, F.col("buy_end")).otherwise(F.col("sell_end")).alias("hi"),
        F.when(is_buy, rec).alias("b"), F.when(~is_buy, rec).alias("s"))
    first = F.expr(f"lo div {w_}")
    last = F.expr(f"(hi - 1) div {w_}")
    pts = iv.select("*", F.explode(F.sequence(first, last)).alias("bucket")) \
        .withColumn("v", F.least(F.col("hi"), (F.col("bucket") + 1) * w_))
    # Buy ends are distinct per position and so are effective sell ends; a value may be both.
    pts = pts.groupBy(*KEYS, "bucket", "v").agg(F.max("b").alias("b"), F.max("s").alias("s"))
    w = Window.partitionBy(*KEYS, "bucket").orderBy(F.col("v").desc())
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    seg = pts.select(
        *KEYS, "v",
        F.coalesce(F.lead("v").over(w), F.col("bucket") * w_).alias("v_prev"),
        F.last("b", ignorenulls=True).over(run).alias("buy"),
        F.last("s", ignorenulls=True).over(run).alias("sell"),
    ).where(F.col("buy").isNotNull() & (F.col("sell").isNotNull() | F.lit(keep_unmatched)))
    # a pair whose overlap crosses a bucket edge comes in pieces: add them up
    seg = seg.where(F.col("v") > F.col("v_prev")).groupBy(*KEYS, "buy", "sell").agg(
        F.sum(F.col("v") - F.col("v_prev")).alias("match_qty"))
    qty = F.col("match_qty")
    wide = lambda c: c.cast("decimal(19,0)")  # noqa: E731  cents times quantity may pass 2^63
    m = seg.select(
        *KEYS,
        F.col("buy.busi_date").alias("buy_date"), F.col("buy.timestamp").alias("buy_ts"),
        *[F.col(f"buy.{c}").alias(f"buy_{c}") for c in TIE_COLS],
        F.col("sell.busi_date").alias("sell_date"), F.col("sell.timestamp").alias("sell_ts"),
        *[F.col(f"sell.{c}").alias(f"sell_{c}") for c in TIE_COLS],
        qty,
        (wide(F.col("buy.cash_c")) * wide(qty)).alias("_cn"), F.col("buy.q").alias("_cd"),
        F.coalesce(-wide(F.col("sell.cash_c")) * wide(qty), F.lit(0)).alias("_pn"),
        F.coalesce(-F.col("sell.q"), F.lit(1)).alias("_pd"),
        F.col("buy.q").alias("buy_q"), F.col("buy.cash_c").alias("buy_cash_c"),
    )
    # Pro-rata shares in whole cents, half away from zero (exact integer arithmetic).
    return m.withColumn("match_cost_c", F.expr(_half_away("_cn", "_cd"))) \
        .withColumn("match_proceeds_c", F.expr(_half_away("_pn", "_pd"))) \
        .withColumn("match_cost", F.col("match_cost_c") / 100.0) \
        .withColumn("match_proceeds", F.col("match_proceeds_c") / 100.0) \
        .drop("_cn", "_cd", "_pn", "_pd", *([] if keep_unmatched else ["buy_q", "buy_cash_c"]))


def _half_away(n: str, d: str) -> str:
    """SQL for round(n / d) half away from zero, for integers n and d > 0."""
    return f"CASE WHEN {n} < 0 THEN -((2 * abs({n}) + {d}) div (2 * {d})) ELSE (2 * {n} + {d}) div (2 * {d}) END"


def fifo_lots(detail: DataFrame, calendar: DataFrame, book: str = LONG) -> DataFrame:
    """Lots = a position's buys of one day (same-day buys join the day's lot), with closed
    quantity and proceeds from FIFO; return = close_amt - trd_amt, rate = return / trd_amt (0 for x / 0, D11)."""
    # one branch: pairs plus the unsold piece of every buy, so each buy is present at least once
    pairs = matches_from_intervals(fifo_intervals(detail, calendar, book), keep_unmatched=True)
    matched = F.col("sell_date").isNotNull()
    per_buy = pairs.groupBy(*KEYS, "buy_date", "buy_ts", *[f"buy_{c}" for c in TIE_COLS]).agg(
        F.first("buy_q").alias("q"), F.first("buy_cash_c").alias("cash_c"),
        F.sum(F.when(matched, F.col("match_qty")).otherwise(F.lit(0))).alias("close_qty"),
        F.sum(F.when(matched, F.col("match_proceeds_c")).otherwise(F.lit(0))).alias("close_c"))
    j = per_buy.groupBy(*KEYS, F.col("buy_date").alias("busi_date")).agg(
        F.sum("q").alias("trd_qty"), F.sum("cash_c").alias("trd_c"),
        F.sum("close_qty").alias("close_qty"), F.sum("close_c").alias("close_c"))
    close_qty = F.coalesce(F.col("close_qty"), F.lit(0)).cast("long")
    close_c = F.coalesce(F.col("close_c"), F.lit(0)).cast("long")
    ret_c = close_c - F.col("trd_c")
    return j.select(
        *KEYS, F.col("busi_date").alias("open_date"), F.col("trd_qty").cast("long").alias("trd_qty"),
        (F.col("trd_c") / 100.0).alias("trd_amt"), close_qty.alias("close_qty"), (close_c / 100.0).alias("close_amt"),
        (F.col("trd_qty") - close_qty).cast("long").alias("unclose_qty"),
        (ret_c / 100.0).alias("return"), F.coalesce(F.try_divide(ret_c.cast("double"), F.col("trd_c").cast("double")), F.lit(0.0)).alias("return_rate"))


# ---------------------------------------------------------------------------
# Seeds and event records


def seed_lots(holding: DataFrame, seed_date: str, qty_col: str = "qty", as_written: bool = False) -> DataFrame:
    """One lot per holding on ``seed_date``.  As written the lot's unclose_qty / unclose_amt are 0 (it could
    never be sold); by default they are the held quantity and value."""
    h = holding.where(F.col("busi_date") == seed_date)
    qty = F.col(qty_col).cast("double")
    val = F.col("mkt_val").cast("double")
    return h.select(
        *KEYS, F.col("busi_date").alias("open_date"), qty.alias("orig_trd_qty"), val.alias("orig_trd_amt"),
        qty.alias("trd_qty"), val.alias("trd_amt"), F.lit(0.0).alias("close_amt"),
        (F.lit(0.0) if as_written else qty).alias("unclose_qty"),
        (F.lit(0.0) if as_written else val).alias("unclose_amt"),
        F.lit(0.0).alias("weighted_term"), F.lit(0).alias("exception_label"), F.col("busi_date"))


def lot_event_records(detail: DataFrame, book: str, order_cols: Sequence[str] = EVENT_ORDER) -> DataFrame:
    """Ordered {trd_qty, trd_cash_flow, amortize_label, timestamp} records per (position, day)."""
    ok = (F.col("trd_qty").isNotNull() & F.col("trd_cash_flow").isNotNull() & F.col("amortize_label").isNotNull()
          & F.col("timestamp").isNotNull())
    ev = detail.where((F.col("trd_type") == book) & ok)
    item = F.struct(*[F.col(c) for c in order_cols], F.col("trd_qty"), F.col("trd_cash_flow"),
                    F.col("amortize_label"))
    return ev.groupBy(*KEYS, "busi_date").agg(F.sort_array(F.collect_list(item)).alias("trd_detail"))


# ---------------------------------------------------------------------------
# Full lot fold

LOT_FIELDS = ["open_date", "orig_trd_qty", "orig_trd_amt", "trd_qty", "trd_amt", "close_amt", "unclose_qty",
              "unclose_amt", "weighted_term", "exception_label"]

_KEY_FIELDS = [T.StructField(k, T.StringType()) for k in KEYS]

#: One run of days, ``from_rank`` to ``to_rank`` (trading-day ranks), in which a lot stays as it is.
#: Quantities are whole units (see UNIT); ``term`` is the weighted term before the run, in TERM_UNITs.
LOG_SCHEMA = T.StructType([
    *_KEY_FIELDS, T.StructField("open_date", T.StringType()),
    T.StructField("from_rank", T.IntegerType()), T.StructField("to_rank", T.IntegerType()),
    T.StructField("orig", T.LongType()), T.StructField("orig_amt", T.DoubleType()),
    T.StructField("size", T.LongType()), T.StructField("amt", T.DoubleType()),
    T.StructField("proceeds", T.DoubleType()), T.StructField("rest", T.LongType()),
    T.StructField("label", T.IntegerType()), T.StructField("term", T.LongType()),
])

# kind of a stream row: 0 = seed lot, 1 = trade, 2 = end-of-day holdings tick
_SEED, _TRADE, _TICK = 0, 1, 2


UNIT = 1_000_000
"""Quantities inside a ``LotBook`` are whole numbers of 1 / UNIT, so that shares of a lot add up exactly."""

TERM_UNIT = 100_000_000_000
"""A day's share of the weighted term (unsold / amortised quantity) counts in whole numbers of 1 / TERM_UNIT, half up, so that
days times ratio is exactly the sum over the days."""


def _ratio(a: float, b: float) -> float:
    """a / b, and 0 where b is 0 (D11)."""
    return a / b if b else 0.0


def _term_share(rest: int, size: int) -> int:
    """A day's share of the weighted term in TERM_UNITs."""
    return (2 * rest * TERM_UNIT + size) // (2 * size) if size else 0


@dataclass
class Lot:
    """One lot; ``orig``, ``size`` and ``left`` are bought, amortised and unsold units."""

    open_date: str
    orig: int = 0
    orig_amt: float = 0.0
    size: int = 0
    amt: float = 0.0
    proceeds: float = 0.0
    left: int = 0
    value: float = 0.0
    term: float = 0.0
    label: int = 0
    start: float = 0.0  # weighted term that the lot was restored with

    @classmethod
    def restore(cls, f: dict) -> Lot:
        units = lambda x: round(float(x) * UNIT)
        return cls(f["open_date"], units(f["orig_trd_qty"]), f["orig_trd_amt"], units(f["trd_qty"]), f["trd_amt"],
                   f["close_amt"], units(f["unclose_qty"]), f["unclose_amt"], f["weighted_term"], int(f["exception_label"]), f["weighted_term"])

    def state(self) -> tuple:
        """What a row of the log says of the lot."""
        return self.orig, self.orig_amt, self.size, self.amt, self.proceeds, self.left, self.label


class LotBook:
    """The lots of one position: a queue of lots with something left, and those sold out today.

    Decisions beside those of the survey: D17 a buy after the day's lot was sold out
    reopens that lot; D18 negative holdings count as none, also in the seed; D19 what a negative amortisation takes beyond a
    lot's rest is taken from the lots after it, and beyond the last lot from none.
    """

    def __init__(self, lots: Iterable[Lot] = ()):
        self.queue: deque[Lot] = deque(x for x in lots if x.left > 0)
        self.done: list[Lot] = [x for x in lots if x.left == 0]

    def lots(self) -> list[Lot]:
        return sorted([*self.done, *self.queue], key=lambda x: x.open_date)

    def _todays(self, day: str) -> Lot:
        """The lot opened on ``day``, in the queue; made or reopened if need be."""
        if self.queue and self.queue[-1].open_date == day:
            return self.queue[-1]
        again = next((x for x in self.done if x.open_date == day), None)
        if again is not None:
            self.done.remove(again)
        self.queue.append(again or Lot(day))
        return self.queue[-1]

    def _pass_sold_out(self) -> None:
        while self.queue and not self.queue[0].left:
            self.done.append(self.queue.popleft())

    def _take(self, units: int, cash: float) -> None:
        """Sell from the oldest lot on, cash by quantity; units beyond the last lot are dropped with their cash."""
        if not units:  # cash alone belongs to the oldest lot (D10)
            if self.queue:
                self.queue[0].proceeds += cash
            return
        rest = units
        while rest and self.queue:
            lot = self.queue[0]
            sold = min(rest, lot.left)
            lot.proceeds += cash * (sold / units)
            lot.value *= (lot.left - sold) / lot.left
            lot.left -= sold
            rest -= sold
            self._pass_sold_out()

    def buy(self, day: str, units: int, cash: float) -> None:
        lot = self._todays(day)
        lot.orig, lot.size, lot.left = lot.orig + units, lot.size + units, lot.left + units
        lot.orig_amt, lot.amt = lot.orig_amt + cash, lot.amt + cash

    def sell(self, units: int, cash: float) -> None:
        self._take(units, cash)

    def amortise(self, units: int, cash: float) -> None:
        """Spread over the open lots by size; cumulative shares are rounded, so they add up to ``units``."""
        total = sum(x.size for x in self.queue)
        if total <= 0:
            return
        before = seen = owed = 0
        for lot in self.queue:
            share = lot.size / total
            seen += lot.size
            part = units * seen // total - before
            before += part
            lot.size += part
            lot.left += part + owed
            owed = min(lot.left, 0)
            lot.left -= owed
            if cash >= 0:
                lot.amt += cash * share
            else:
                lot.proceeds -= cash * share
        self.queue = deque(x for x in self.queue if x.left or self.done.append(x))

    def reconcile(self, day: str, units: int, value: float) -> None:
        """Hold the open lots against the day's holdings, newest first; what holdings lack closes
        at cost with a label, what they have beyond all lots joins the day's lot with a label."""
        held = rest = max(units, 0)
        for lot in reversed(self.queue):
            if lot.left > rest:
                lot.label = 1
                lot.proceeds += lot.amt * _ratio(lot.left - rest, lot.size)
                lot.left = rest
            lot.value = value * _ratio(lot.left, held)
            rest -= lot.left
        self.queue = deque(x for x in self.queue if x.left or self.done.append(x))
        if rest:
            lot, cost = self._todays(day), value * _ratio(rest, held)
            self.buy(day, rest, cost)
            lot.value, lot.label = lot.value + cost, 1

    def day(self, trades: Iterable[tuple[float, float, int]], day: str, held: float, value: float) -> list[Lot]:
        """One day: trades (quantity, cash, amortise label) in order, then the holdings.
        Returns the day's lots, oldest first; sold-out ones leave the book afterwards."""
        for quantity, cash, label in trades:
            units = round(quantity * UNIT)
            if label == 1:
                self.amortise(units, cash)
            elif units > 0:
                self.buy(day, units, cash)
            else:
                self.sell(-units, -cash)
        self.reconcile(day, round(held * UNIT), value)
        for lot in [*self.queue, *self.done]:
            lot.term += _ratio(lot.left, lot.size)
        rows = self.lots()
        self.done = []
        return rows


_SEED_TYPES = {"open_date": "string", "exception_label": "int"}  # other lot fields are double


def _seed_columns(df: DataFrame | None = None) -> list:
    """The lot fields of a seed row as ``s_<field>`` columns (NULL on trade and tick rows)."""
    return [(F.col(f) if df is not None else F.lit(None)).cast(_SEED_TYPES.get(f, "double")).alias(f"s_{f}")
            for f in LOT_FIELDS]


class _Runs:
    """The log of one position: a row whenever a lot's run of unchanged days ends."""

    def __init__(self, key: tuple):
        self.key = key
        self.open: dict[str, list] = {}  # by open date: first rank of the run, state, term before the run

    def end(self, open_date: str, to_rank: int) -> tuple:
        first, state, term = self.open.pop(open_date)
        return (*self.key, open_date, first, to_rank, *state, term)

    def day(self, lots: list[Lot], rank: int) -> list[tuple]:
        """Rows of the runs that end before ``rank``, and of lots that close on it."""
        out = []
        for lot in lots:
            state, held = lot.state(), self.open.get(lot.open_date)
            if held is not None and held[1] == state:
                continue
            term = round(lot.start * TERM_UNIT)
            if held is not None:
                if held[0] < rank:
                    out.append(self.end(lot.open_date, rank - 1))
                term = held[2] + (rank - held[0]) * _term_share(held[1][5], held[1][2])
            self.open[lot.open_date] = [rank, state, term]
            if not lot.left:
                out.append(self.end(lot.open_date, rank))
        return out

    def close(self, last_rank: int) -> list[tuple]:
        return [self.end(d, last_rank) for d in sorted(self.open)]


def _lot_runs(last_rank: int):
    cols = [f.name for f in LOG_SCHEMA.fields]

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Fold sorted stream rows (position, rank, kind, order...) into runs of unchanged lots."""
        runs, seeds, book, trades = None, [], None, []
        for pdf in batches:
            out: list = []
            columns = [pdf[c].tolist() for c in (*KEYS, "kind", "busi_date", "rank", "q", "cash", "label")]
            for at, (*k, kind, day, rank, q, cash, label) in enumerate(zip(*columns)):
                if runs is None or tuple(k) != runs.key:
                    out += runs.close(last_rank) if runs else []
                    runs, seeds, book, trades = _Runs(tuple(k)), [], None, []
                if kind == _SEED:
                    seeds.append(Lot.restore({f: pdf[f"s_{f}"].iat[at] for f in LOT_FIELDS}))
                elif kind == _TRADE:
                    trades.append((q, cash, label))
                else:
                    book = book or LotBook(seeds)
                    out += runs.day(book.day(trades, day, q, cash), int(rank))
                    trades = []
            yield pd.DataFrame(out, columns=cols)
        if runs:
            yield pd.DataFrame(runs.close(last_rank), columns=cols)

    return fold


def lot_state(rolled: DataFrame, busi_date: str) -> DataFrame:
    """The open lots of one day - the state a next run resumes from."""
    return rolled.where((~F.col("closed")) & (F.col("busi_date") == busi_date)).select(*KEYS, *LOT_FIELDS, "busi_date")


def _ticks(seeds: DataFrame, trades: DataFrame, held: DataFrame, s: int, max_rank: int) -> DataFrame:
    """(position, rank) of the days on which lots can change, with the day's holdings (0 where there are none).

    These are each position's first day (of its seed lots, trades or holdings), days with trades, and days
    whose held quantity is not that of the day before.  Rows of holdings and marks meet in one grouping."""
    w = Window.partitionBy(*KEYS).orderBy("rank")
    units = lambda c: F.round(F.greatest(c, F.lit(0.0)) * UNIT)  # noqa: E731  what the fold sees of a quantity
    h = held.select(*KEYS, "rank", "h_q", "h_v", F.lag("rank").over(w).alias("before"), F.lag("h_q").over(w).alias("was"), F.lead("rank").over(w).alias("next"))
    same = (F.col("before") == F.col("rank") - 1) & (units(F.col("was")) == units(F.col("h_q")))
    ends = (F.coalesce(F.col("next"), F.lit(max_rank + 1)) > F.col("rank") + 1) & (F.col("rank") < max_rank)
    none = F.lit(None).cast("double")
    marks = h.select(*KEYS, F.explode(F.array(F.struct("rank", "h_q", "h_v", (~F.coalesce(same, F.lit(False))).alias("mark")),
                                              F.struct(F.when(ends, F.col("rank") + 1).alias("rank"), none.alias("h_q"), none.alias("h_v"), F.lit(True).alias("mark")))).alias("m")).select(*KEYS, "m.*")
    starts = seeds.select(*KEYS, F.lit(s + 1).alias("rank")).unionByName(trades.select(*KEYS, "rank"))
    starts = starts.select(*KEYS, "rank", none.alias("h_q"), none.alias("h_v"), F.lit(True).alias("mark"))
    return marks.unionByName(starts).where(F.col("rank") <= max_rank).groupBy(*KEYS, "rank").agg(
        F.coalesce(F.max("h_q"), F.lit(0.0)).alias("q"), F.coalesce(F.max("h_v"), F.lit(0.0)).alias("cash"), F.max("mark").alias("mark")).where("mark").drop("mark")


def lot_log(detail: DataFrame, holding: DataFrame, calendar: DataFrame, seed_date: str, book: str = LONG,
            qty_col: str = "qty", as_written_seed: bool = False, order_cols: Sequence[str] = EVENT_ORDER,
            num_partitions: int | None = None, state: DataFrame | None = None, until: str | None = None) -> DataFrame:
    """Runs of unchanged lots (``LOG_SCHEMA``) after ``seed_date``; a closing row is a run of its closing day.
    Keys are encoded (``keys.encode_keys``)."""
    detail, holding = encode_keys(detail), encode_keys(holding)
    cal = day_side(calendar.select("busi_date", F.col("rlt_rank").cast("int").alias("rank")), calendar_fits(calendar))
    s, max_rank = roll_bounds(calendar, seed_date, until)  # seed rank, last rank produced
    order = list(order_cols)
    no_order = [F.lit(None).cast("long").alias(f"o{i}") for i in range(len(order))]

    seed_src = (encode_keys(state).where(F.col("busi_date") == seed_date) if state is not None
                else seed_lots(holding, seed_date, qty_col, as_written_seed))
    seeds = seed_src.select(
        *KEYS, F.lit(seed_date).alias("busi_date"), F.lit(s).alias("rank"), F.lit(_SEED).alias("kind"), *no_order,
        F.lit(0.0).alias("q"), F.lit(0.0).alias("cash"), F.lit(0).alias("label"), *_seed_columns(seed_src))
    ok = F.col("trd_qty").isNotNull() & F.col("trd_cash_flow").isNotNull() & F.col("timestamp").isNotNull()
    trades = (detail.where((F.col("trd_type") == book) & ok)
              .join(cal, "busi_date").where((F.col("rank") > s) & (F.col("rank") <= max_rank))
              .select(*KEYS, "busi_date", "rank", F.lit(_TRADE).alias("kind"),
                      *[F.col(c).cast("long").alias(f"o{i}") for i, c in enumerate(order)],
                      F.col("trd_qty").cast("double").alias("q"), F.col("trd_cash_flow").cast("double").alias("cash"),
                      F.coalesce(F.col("amortize_label"), F.lit(0)).alias("label"), *_seed_columns()))
    held = _held(holding, cal, qty_col).where((F.col("rank") > s) & (F.col("rank") <= max_rank))
    ticks = _ticks(seeds, trades, held, s, max_rank).join(cal, "rank").select(
        *KEYS, "busi_date", "rank", F.lit(_TICK).alias("kind"), *no_order, "q", "cash", F.lit(0).alias("label"), *_seed_columns())
    stream = seeds.unionByName(trades).unionByName(ticks)
    n = num_partitions or int(stream.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # seed lots in list order (oldest first), then each day's trades in time order, then its tick
    sort_cols = [*KEYS, "rank", "kind", "s_open_date", *[f"o{i}" for i in range(len(order))]]
    stream = stream.repartition(n, *KEYS).sortWithinPartitions(*sort_cols)
    return stream.mapInPandas(_lot_runs(max_rank), LOG_SCHEMA)


def _held(holding: DataFrame, cal: DataFrame, qty_col: str) -> DataFrame:
    """(position, rank) with the held quantity and value; NULLs count as 0."""
    return holding.join(cal, "busi_date").select(*KEYS, "rank", F.coalesce(F.col(qty_col).cast("double"), F.lit(0.0)).alias("h_q"),
                                                 F.coalesce(F.col("mkt_val").cast("double"), F.lit(0.0)).alias("h_v"))


def expand_lots(log: DataFrame, holding: DataFrame, calendar: DataFrame, qty_col: str = "qty") -> DataFrame:
    """Daily lot rows from ``lot_log``: every lot on every day of its runs, valued by its share of the day's holdings."""
    cal = day_side(calendar.select("busi_date", F.col("rlt_rank").cast("int").alias("rank")), calendar_fits(calendar))
    days = log.select("*", F.explode(F.sequence("from_rank", "to_rank")).alias("rank"))
    days = days.join(_held(encode_keys(holding), cal, qty_col), [*KEYS, "rank"], "left").join(cal, "rank")
    qty = lambda c: F.col(c) / F.lit(float(UNIT))
    ratio = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    # a day's share of the term, as ``_term_share``
    days = days.withColumn("_n", F.lit(2) * wide("rest") * F.lit(TERM_UNIT).cast("decimal(12,0)") + wide("size")).withColumn("_d", F.lit(2) * wide("size"))
    term = F.col("term") + (F.col("rank") - F.col("from_rank") + 1) * F.when(F.col("size") != 0, F.expr("_n div _d")).otherwise(F.lit(0))
    units = F.round(F.greatest(F.coalesce("h_q", F.lit(0.0)), F.lit(0.0)) * UNIT)
    gain = F.col("proceeds") - F.col("amt")
    return days.select(
        *KEYS, "busi_date", "open_date", qty("orig").alias("orig_trd_qty"), F.col("orig_amt").alias("orig_trd_amt"),
        qty("size").alias("trd_qty"), F.col("amt").alias("trd_amt"), ((F.col("size") - F.col("rest")) / F.lit(float(UNIT))).alias("close_qty"),
        F.col("proceeds").alias("close_amt"), qty("rest").alias("unclose_qty"),
        (F.coalesce("h_v", F.lit(0.0)) * ratio(F.col("rest"), units)).alias("unclose_amt"), gain.alias("return"),
        ratio(gain, F.col("amt")).alias("return_rate"), (term / F.lit(float(TERM_UNIT))).alias("weighted_term"),
        F.col("label").alias("exception_label"), (F.col("rest") == 0).alias("closed"))


def roll_lots(detail: DataFrame, holding: DataFrame, calendar: DataFrame, seed_date: str, book: str = LONG,
              qty_col: str = "qty", as_written_seed: bool = False, order_cols: Sequence[str] = EVENT_ORDER,
              num_partitions: int | None = None, state: DataFrame | None = None,
              until: str | None = None) -> DataFrame:
    """Daily lot rows (open and closed) for every trading day after ``seed_date``.

    Each position is processed on every trading day from its first seed lot, trade or
    holdings row on (lots are re-emitted daily; holdings reconcile them every day; no
    holdings row means holdings of 0).  Seed lots follow ``seed_lots``, or - to resume a daily run -
    the open lots of ``seed_date`` given as ``state`` (``lot_state``).  The rows are those of ``lot_log``, expanded to days.
    """
    log = lot_log(detail, holding, calendar, seed_date, book, qty_col, as_written_seed, order_cols, num_partitions, state, until)
    return decode_keys(expand_lots(log, holding, calendar, qty_col), detail)


def open_lots(rolled: DataFrame) -> DataFrame:
    return rolled.where(~F.col("closed")).drop("closed")


def closed_lots(rolled: DataFrame) -> DataFrame:
    return rolled.where(F.col("closed")).drop("closed", "unclose_qty", "unclose_amt", "close_qty") \
        .withColumnRenamed("busi_date", "close_date")
