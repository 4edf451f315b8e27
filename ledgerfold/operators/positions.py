"""Position roll-forward: open / closed positions per trading day with return and holding term.

Semantics (per position and book, from a seed day S on): every event of a
position since its cycle opened is folded in time order with state
(x = quantity, y = amount, in, out):

* q >= 0: x += q; y += a; in += a
* q <  0: x += q; then y += floor((x + q) / x) * y if x != 0 else y += a; out += a
  (x already updated - the reference's rule, kept as written), and the sell is
  tagged with return = (y / x before the sell) * q, or 0 if x was 0.

A position closes on the first day its x ends at 0 (close_date = that day) and
a later event opens a new cycle.  An open position is re-emitted on every later
trading day, with or without events.  return = out + y - in, rate = return / in
(0 if in = 0), total_out = |out|, holding_term = days since open_date.
exception_label = 1 on the first day of a cycle (no state the day before) or when
the holdings quantity differs from x (NULL-aware), else 0.

Plan.  The reference re-folds the whole, ever-growing history array of every
position every day on Python workers.  Here the carried state is four numbers:

1. events -> one row per (position, day, second): the quantity sum and that
   second's events as a sorted array (so a busy position is split by time, not
   held in one array per day);
2. a window over each position's days (one row per trading day, bounded by the
   calendar) gives x at the day's end and the cycle number; a window over the
   seconds of one day gives x at each chunk's start;
3. one ``F.aggregate`` per chunk turns its events into an affine map
   ``y_end = M * y_start + C`` plus the coefficients of its return tags
   ``A * y_start + B`` and its in / out sums - x is known, so the map is exact;
   the chunk maps of a day (at most one per second) compose into the day's map;
4. a cycle's days are cut into blocks of ``BLOCK_DAYS`` trading days.  Each block's maps are composed to the block's map, the block
   maps of a cycle give the state at every block's start (a row a block), and one ``F.aggregate`` scan a
   block makes its day rows from there: no array is longer than a block, so time is linear in the days of a cycle.
   A range of days within one block needs no second level;
5. the days between events are produced by a row-local ``sequence`` explode,
   and holdings are joined for remain_qty / remain_val.

Only step 1 shuffles events; everything after works on per-chunk or
per-position-day rows.  No Python runs.  A NULL key part is a value of its own (``keys.encode_keys``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerfold.functions.calendar import calendar_fits, day_side, roll_bounds
from ledgerfold.functions.expressions import null_safe_ne, open_date_or
from ledgerfold.keys import KEYS, LONG, decode_keys, encode_keys
from ledgerfold.sources.binding import EVENT_ORDER

OPEN_COLUMNS = [
    "trade_id", "secu_acc_id", "prd_no", "open_date", "holding_term", "return", "return_rate", "total_in",
    "total_out", "remain_qty", "remain_val", "exception_label", "n_detail", "detail_return", "busi_date",
]
CLOSED_COLUMNS = [
    "trade_id", "secu_acc_id", "prd_no", "close_date", "open_date", "holding_term", "return", "return_rate",
    "total_in", "total_out", "exception_label", "n_detail", "detail_return", "busi_date",
]

_ACC = T.StructType([
    T.StructField("x", T.LongType()), T.StructField("M", T.DoubleType()), T.StructField("C", T.DoubleType()),
    T.StructField("A", T.DoubleType()), T.StructField("B", T.DoubleType()),
    T.StructField("ins", T.DoubleType()), T.StructField("outs", T.DoubleType()),
])
_DAY = T.StructType([
    T.StructField("rank", T.IntegerType()), T.StructField("x_end", T.LongType()),
    T.StructField("M", T.DoubleType()), T.StructField("C", T.DoubleType()),
    T.StructField("A", T.DoubleType()), T.StructField("B", T.DoubleType()),
    T.StructField("ins", T.DoubleType()), T.StructField("outs", T.DoubleType()),
    T.StructField("n_ev", T.LongType()),
])
_SCAN_OUT = T.StructType([
    T.StructField("rank", T.IntegerType()), T.StructField("x_end", T.LongType()),
    T.StructField("y", T.DoubleType()), T.StructField("dr", T.DoubleType()),
    T.StructField("inc", T.DoubleType()), T.StructField("outc", T.DoubleType()),
    T.StructField("n", T.LongType()),
])


COST_RULES = ("as_written", "average_cost")

BLOCK_DAYS = 128
"""Trading days of a block of the day scan."""


def _event_step(acc: Column, e: Column, cost_rule: str = "as_written") -> Column:
    """One event of the fold, as an update of the day's affine map.

    A sell multiplies the cost by 1 + floor((x1 + q) / x1) as written (D1), or takes the sold
    share of it away with ``average_cost`` (nothing from a flat position)."""
    q, a = e["q"], e["a"]
    x1 = acc["x"] + q
    buy = q >= 0
    k = F.floor(F.try_divide(x1 + q, x1))
    m = acc["M"]
    c = acc["C"]
    tagged = (~buy) & (~e["seed"]) & (acc["x"] != 0)
    if cost_rule == "average_cost":
        left = F.coalesce(F.try_divide(x1.cast("double"), acc["x"].cast("double")), F.lit(1.0))
        sold_m, sold_c = m * left, c * left
    else:
        sold_m, sold_c = F.when(x1 != 0, m + k * m).otherwise(m), F.when(x1 != 0, c + k * c).otherwise(c + a)
    return F.struct(
        x1.alias("x"),
        F.when(buy, m).otherwise(sold_m).alias("M"),
        F.when(buy, c + a).otherwise(sold_c).alias("C"),
        F.when(tagged, acc["A"] + m / acc["x"] * q).otherwise(acc["A"]).alias("A"),
        F.when(tagged, acc["B"] + c / acc["x"] * q).otherwise(acc["B"]).alias("B"),
        F.when(buy, acc["ins"] + a).otherwise(acc["ins"]).alias("ins"),
        F.when(buy, acc["outs"]).otherwise(acc["outs"] + a).alias("outs"),
    )


def _chunk_step(acc: Column, c: Column) -> Column:
    """Compose the next chunk's map after the day's maps so far (return tags included)."""
    return F.struct(
        (c["M"] * acc["M"]).alias("M"),
        (c["M"] * acc["C"] + c["C"]).alias("C"),
        (acc["A"] + c["A"] * acc["M"]).alias("A"),
        (acc["B"] + (c["A"] * acc["C"] + c["B"])).alias("B"),
        (acc["ins"] + c["ins"]).alias("ins"),
        (acc["outs"] + c["outs"]).alias("outs"),
    )


def _day_state(acc: Column, d: Column) -> dict[str, Column]:
    """One day's map (or a block's) put on the cycle state."""
    return {"y": d["M"] * acc["y"] + d["C"], "dr": acc["dr"] + (acc["y"] * d["A"] + d["B"]),
            "inc": acc["inc"] + d["ins"], "outc": acc["outc"] + d["outs"], "n": acc["n"] + d["n_ev"]}


def _named(cols: dict[str, Column]) -> list[Column]:
    return [c.alias(n) for n, c in cols.items()]


def _day_step(acc: Column, d: Column) -> Column:
    """Compose one day's map onto the cycle state and append the day's result."""
    after = _day_state(acc, d)
    row = F.struct(d["rank"].alias("rank"), d["x_end"].alias("x_end"), *_named(after))
    return F.struct(*_named(after), F.concat(acc["rows"], F.array(row)).alias("rows"))


def _scan_days(days: DataFrame, pos: list[str], blocks: bool) -> DataFrame:
    """Day rows (position, cycle, start_rank, rank, x_end and the state at the day's end) from day maps ``m``.

    ``blocks`` cuts the days of a cycle into blocks; without it a cycle is one array."""
    day_item = F.struct(F.col("rank"), F.col("x_end"), F.col("m.M").alias("M"), F.col("m.C").alias("C"),
                        F.col("m.A").alias("A"), F.col("m.B").alias("B"), F.col("m.ins").alias("ins"),
                        F.col("m.outs").alias("outs"), F.col("n_ev")).cast(_DAY)
    zero = {"y": F.lit(0.0), "dr": F.lit(0.0), "inc": F.lit(0.0), "outc": F.lit(0.0), "n": F.lit(0).cast("long")}
    cut = [*pos, "cycle", "block"]
    days = days.withColumn("block", F.expr(f"rank div {BLOCK_DAYS}") if blocks else F.lit(0).cast("long"))
    held = days.groupBy(*cut).agg(F.sort_array(F.collect_list(day_item)).alias("d"))
    if blocks:
        # the map of each block, and from those of a cycle the state before each (one item a block)
        one = F.struct(F.lit(1.0).alias("M"), F.lit(0.0).alias("C"), F.lit(0.0).alias("A"), F.lit(0.0).alias("B"), F.lit(0.0).alias("ins"),
                       F.lit(0.0).alias("outs"), F.lit(0).cast("long").alias("n_ev"))
        both = lambda acc, d: F.struct(*[_chunk_step(acc, d)[f].alias(f) for f in ("M", "C", "A", "B", "ins", "outs")], (acc["n_ev"] + d["n_ev"]).alias("n_ev"))
        maps = held.select(*cut, F.col("d")[0]["rank"].alias("first"), F.aggregate("d", one, both).alias("m"))
        listed = maps.groupBy(*pos, "cycle").agg(F.min("first").alias("start_rank"), F.sort_array(F.collect_list(F.struct("block", "m"))).alias("bs"))
        state = "array<struct<block:bigint,y:double,dr:double,inc:double,outc:double,n:bigint>>"

        def pass_block(acc: Column, b: Column) -> Column:
            before = F.struct(b["block"].alias("block"), *[acc[f].alias(f) for f in zero])
            return F.struct(*_named(_day_state(acc, b["m"])), F.concat(acc["rows"], F.array(before)).cast(state).alias("rows"))

        starts = listed.select(*pos, "cycle", "start_rank", F.explode(F.aggregate("bs", F.struct(*_named(zero), F.array().cast(state).alias("rows")), pass_block)["rows"]).alias("s"))
        held = held.join(starts.select(*pos, "cycle", F.col("s.block").alias("block"), "start_rank", "s"), cut)
        zero = {f: F.col(f"s.{f}") for f in zero}
    else:
        held = held.withColumn("start_rank", F.col("d")[0]["rank"])
    scan_init = F.struct(*_named(zero), F.array().cast(T.ArrayType(_SCAN_OUT)).alias("rows"))
    return held.select(*pos, "cycle", "start_rank", F.explode(F.aggregate("d", scan_init, _day_step)["rows"]).alias("r")).select(*pos, "cycle", "start_rank", "r.*")


def seed_open_positions(holding: DataFrame, seed_date: str, qty_col: str = "qty") -> DataFrame:
    """One open position per holding on ``seed_date``: total_in = remain_val = mkt_val,
    one seed detail item, label 0."""
    h = holding.where(F.col("busi_date") == seed_date)
    return h.select(
        *KEYS, F.col("busi_date").alias("open_date"), F.lit(0).cast("long").alias("holding_term"),
        F.lit(0.0).alias("return"), F.lit(0.0).alias("return_rate"), F.col("mkt_val").cast("double").alias("total_in"),
        F.lit(0.0).alias("total_out"), F.col(qty_col).cast("long").alias("remain_qty"),
        F.col("mkt_val").cast("double").alias("remain_val"), F.lit(0).cast("long").alias("exception_label"),
        F.lit(1).cast("long").alias("n_detail"), F.lit(0.0).alias("detail_return"), "busi_date",
    )


def seed_closed_table(seed_open: DataFrame) -> DataFrame:
    """The closed-positions table starts empty with the closed schema (``where 1 = 0``)."""
    return seed_open.select(
        *KEYS, F.lit(None).cast("string").alias("close_date"), "open_date", "holding_term", "return", "return_rate",
        "total_in", "total_out", "exception_label", "n_detail", "detail_return", "busi_date",
    ).limit(0)


def event_records(detail: DataFrame, book: str, order_cols: Sequence[str] = EVENT_ORDER,
                  fields: Sequence[str] = ("trd_qty", "trd_amt")) -> DataFrame:
    """Ordered event records per (position, day) of one book.  An event with a NULL field is
    dropped, as the reference's NULL-propagating concat makes it vanish."""
    ok = F.lit(True)
    for c in list(fields) + ["busi_date", "timestamp"]:
        ok = ok & F.col(c).isNotNull()
    ev = detail.where((F.col("trd_type") == book) & ok)
    item = F.struct(*[F.col(c) for c in order_cols], *[F.col(c) for c in fields if c not in order_cols],
                    F.col("busi_date").alias("trd_date"))
    return ev.groupBy(*KEYS, "busi_date").agg(F.sort_array(F.collect_list(item)).alias("trd_detail"))


STATE_COLUMNS = ["trade_id", "secu_acc_id", "prd_no", "open_date", "remain_qty", "cost_amt", "total_in", "out_amt",
                 "n_detail", "detail_return", "busi_date"]


def position_state(rolled: DataFrame, busi_date: str) -> DataFrame:
    """The open positions of one day with the carried fold state (x, y, in, signed out) - the
    input of the next run, like the reference's unclosed-positions table."""
    return rolled.where((~F.col("closed")) & (F.col("busi_date") == busi_date)).select(*STATE_COLUMNS)


def roll_positions(detail: DataFrame, holding: DataFrame, calendar: DataFrame, seed_date: str,
                   book: str = LONG, qty_col: str = "qty", order_cols: Sequence[str] = EVENT_ORDER,
                   state: DataFrame | None = None, until: str | None = None, cost_rule: str = "as_written",
                   match_new: bool = False) -> DataFrame:
    """Daily position rows for every trading day after ``seed_date``; ``closed`` tells the table.

    Without ``state`` the positions start from the holdings of ``seed_date`` (one seed
    item each).  With ``state`` (``position_state`` of ``seed_date``) they resume from the
    carried state, so a daily run only reads the new day's events: resuming gives exactly
    the rows of one run over the whole range.

    ``cost_rule='average_cost'`` replaces the floor-division rule (D1); its return is
    abs(out) + cost - in.  ``match_new`` lets a position see holdings on its first day too (D4).

    Returns one row per (position, day) with both open and closed columns, the carried
    ``cost_amt`` / ``out_amt`` and ``closed``.
    """
    if cost_rule not in COST_RULES:
        raise ValueError(f"cost_rule is one of {', '.join(COST_RULES)}")
    types = detail
    detail, holding = encode_keys(detail), encode_keys(holding)
    state = encode_keys(state) if state is not None else None
    cal = day_side(calendar.select("busi_date", F.col("rlt_rank").cast("int").alias("rank")), calendar_fits(calendar))
    s, max_rank = roll_bounds(calendar, seed_date, until)  # seed rank, last rank produced
    pos = KEYS

    # 1. events of the book after the seed, the seed holdings as first history item, and an
    #    empty marker on the day after the seed (so a zero-quantity seed closes that day).
    ok = F.col("trd_qty").isNotNull() & F.col("trd_amt").isNotNull() & F.col("timestamp").isNotNull()
    ev = (detail.where((F.col("trd_type") == book) & ok)
          .join(cal, "busi_date").where((F.col("rank") > s) & (F.col("rank") <= max_rank))
          .select(*pos, "rank", F.col(order_cols[0]).cast("long").alias("cts"),
                  F.struct(F.lit(1).alias("src"), *[F.col(c) for c in order_cols],
                                         F.col("trd_qty").cast("long").alias("q"),
                                         F.col("trd_amt").cast("double").alias("a"),
                                         F.lit(False).alias("seed")).alias("e")))
    ev_type = ev.schema["e"].dataType
    hs = holding.where(F.col("busi_date") == seed_date)
    seed_items = hs.select(*pos, F.lit(s).alias("rank"), F.lit(-1).cast("long").alias("cts"), F.struct(
        F.lit(0).alias("src"), *[F.lit(None).cast(ev_type[c].dataType).alias(c) for c in order_cols],
        F.col(qty_col).cast("long").alias("q"), F.col("mkt_val").cast("double").alias("a"),
        F.lit(True).alias("seed")).alias("e"))
    markers = hs.select(*pos, F.lit(s + 1).alias("rank"), F.lit(-1).cast("long").alias("cts"),
                        F.lit(None).cast(ev_type).alias("e")) \
        if s < max_rank else None
    if state is not None:
        st = state.where(F.col("busi_date") == seed_date)
        markers = st.select(*pos, F.lit(s + 1).alias("rank"), F.lit(-1).cast("long").alias("cts"),
                            F.lit(None).cast(ev_type).alias("e")) if s < max_rank else None
        items = ev
    else:
        items = ev.unionByName(seed_items)
    if markers is not None:
        items = items.unionByName(markers)

    # 1b. chunks: the events of one position in one second (any bound on a day's events per
    #     position is then a bound on seconds per day times events per position per second).
    chunks = items.groupBy(*pos, "rank", "cts").agg(
        F.sort_array(F.collect_list("e")).alias("evs"),
        F.coalesce(F.sum(F.col("e.q")), F.lit(0)).cast("long").alias("dq"),
        F.count("e").alias("n_ev"),
    ).withColumn("given", F.lit(None).cast(_ACC))
    if state is not None:
        # a resumed position enters as one chunk whose map is already known: y = cost_amt
        given = F.struct(F.col("remain_qty").cast("long").alias("x"), F.lit(1.0).alias("M"),
                         F.col("cost_amt").cast("double").alias("C"), F.lit(0.0).alias("A"),
                         F.col("detail_return").cast("double").alias("B"),
                         F.col("total_in").cast("double").alias("ins"),
                         F.col("out_amt").cast("double").alias("outs")).cast(_ACC)
        chunks = chunks.unionByName(st.select(
            *pos, F.lit(s).alias("rank"), F.lit(-1).cast("long").alias("cts"),
            F.array().cast(T.ArrayType(ev_type)).alias("evs"), F.col("remain_qty").cast("long").alias("dq"),
            F.col("n_detail").cast("long").alias("n_ev"), given.alias("given")))

    # 2. x at day end and cycle number; one row per position and day (bounded by the calendar).
    days = chunks.groupBy(*pos, "rank").agg(F.sum("dq").alias("dq_day"))
    wp = Window.partitionBy(*pos).orderBy("rank")
    days = days.withColumn("x_end", F.sum("dq_day").over(wp.rowsBetween(Window.unboundedPreceding, 0)))
    zero = F.when((F.col("x_end") == 0) & (F.col("rank") > s), 1).otherwise(0)
    days = days.withColumn("cycle", F.coalesce(
        F.sum(zero).over(wp.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))

    # 3. each chunk's events as an affine map of the chunk's starting y; x at the chunk start is
    #    the day's start plus the earlier chunks of the day (a window over one day's seconds).
    chunks = chunks.join(days, pos + ["rank"])
    wd = Window.partitionBy(*pos, "rank").orderBy("cts").rowsBetween(Window.unboundedPreceding, -1)
    x0 = F.col("x_end") - F.col("dq_day") + F.coalesce(F.sum("dq").over(wd), F.lit(0))
    init = F.struct(x0.alias("x"), F.lit(1.0).alias("M"), F.lit(0.0).alias("C"),
                    F.lit(0.0).alias("A"), F.lit(0.0).alias("B"), F.lit(0.0).alias("ins"),
                    F.lit(0.0).alias("outs")).cast(_ACC)
    chunks = chunks.withColumn("m", F.coalesce(F.col("given"), F.aggregate("evs", init, lambda acc, e: _event_step(acc, e, cost_rule))))

    # 3b. compose the chunk maps of each day in time order (at most one per second of the day).
    chunk_item = F.struct(F.col("cts"), F.col("m.M").alias("M"), F.col("m.C").alias("C"), F.col("m.A").alias("A"),
                          F.col("m.B").alias("B"), F.col("m.ins").alias("ins"), F.col("m.outs").alias("outs"))
    days = chunks.groupBy(*pos, "rank").agg(
        F.first("x_end").alias("x_end"), F.first("cycle").alias("cycle"), F.sum("n_ev").alias("n_ev"),
        F.sort_array(F.collect_list(chunk_item)).alias("cm"))
    day_init = F.struct(F.lit(1.0).alias("M"), F.lit(0.0).alias("C"), F.lit(0.0).alias("A"), F.lit(0.0).alias("B"),
                        F.lit(0.0).alias("ins"), F.lit(0.0).alias("outs"))
    days = days.withColumn("m", F.aggregate("cm", day_init, _chunk_step))

    # 4. compose the day maps of each cycle in day order.
    rows = _scan_days(days, pos, blocks=s // BLOCK_DAYS != max_rank // BLOCK_DAYS)

    # 5. days between events: each event day stands for itself and the quiet days up to the
    #    next event day of its cycle, or to the cycle end (its closing day, else the last day).
    wc = Window.partitionBy(*pos, "cycle").orderBy("rank")
    nxt = F.lead("rank").over(wc)
    closes = (F.col("x_end") == 0) & (F.col("rank") > s)
    upto = F.coalesce(nxt - 1, F.when(closes, F.col("rank")).otherwise(F.lit(max_rank)))
    rows = rows.withColumn("upto", upto).select(
        "*", F.explode(F.sequence(F.col("rank"), F.col("upto"))).alias("day_rank")).where(F.col("day_rank") > s)

    out = rows.join(cal.withColumnRenamed("rank", "day_rank"), "day_rank")
    out = out.join(cal.select(F.col("busi_date").alias("open_date"), F.col("rank").alias("start_rank")), "start_rank")
    if state is not None:
        # a resumed cycle keeps the opening day it had
        opened = st.select(*pos, F.col("open_date").alias("open0"), F.lit(s).alias("start_rank"))
        out = out.join(opened, pos + ["start_rank"], "left") \
            .withColumn("open_date", open_date_or(F.col("open0"), F.col("open_date"))).drop("open0")
    has_state = F.lit(True) if match_new else F.col("day_rank") > F.col("start_rank")
    h = holding.select(*pos, "busi_date", F.col(qty_col).cast("long").alias("h_qty"),
                       F.col("mkt_val").cast("double").alias("h_val"))
    out = out.join(h, pos + ["busi_date"], "left")
    h_qty = F.when(has_state, F.col("h_qty"))
    h_val = F.when(has_state, F.col("h_val"))
    ret = (F.abs("outc") if cost_rule == "average_cost" else F.col("outc")) + F.col("y") - F.col("inc")
    closed = F.col("x_end") == 0
    out = out.select(
        *pos,
        F.when(closed, F.col("busi_date")).alias("close_date"),
        "open_date",
        F.datediff(F.to_date("busi_date"), F.to_date("open_date")).cast("long").alias("holding_term"),
        ret.alias("return"),
        F.when(F.col("inc") != 0, ret / F.col("inc")).otherwise(F.lit(0.0)).alias("return_rate"),
        F.col("inc").alias("total_in"),
        F.abs("outc").alias("total_out"),
        F.when(~closed, F.col("x_end")).alias("remain_qty"),
        F.when(~closed, F.coalesce(h_val, F.lit(0.0))).alias("remain_val"),
        F.when(~has_state | null_safe_ne(h_qty, F.col("x_end")), 1).otherwise(0).cast("long").alias("exception_label"),
        F.col("n").alias("n_detail"),
        F.col("dr").alias("detail_return"),
        "busi_date",
        F.col("y").alias("cost_amt"),
        F.col("outc").alias("out_amt"),
        closed.alias("closed"),
    )
    return decode_keys(out, types)


def open_positions(rolled: DataFrame) -> DataFrame:
    return rolled.where(~F.col("closed")).select(*OPEN_COLUMNS)


def closed_positions(rolled: DataFrame) -> DataFrame:
    return rolled.where(F.col("closed")).select(*CLOSED_COLUMNS)


_DETAIL = "array<struct<trd_qty:bigint,trd_amt:double,trd_date:string,timestamp:bigint,return:double>>"
_DETAIL_STATES = "array<struct<x:bigint,y:double>>"


def position_details(spans: DataFrame, detail: DataFrame, holding: DataFrame, seed_date: str, book: str = LONG,
                     qty_col: str = "qty", order_cols: Sequence[str] = EVENT_ORDER, cost_rule: str = "as_written") -> DataFrame:
    """``trd_detail`` of each span (position, open_date, last_date): its events in order, each sell tagged with its
    return (cost / quantity before it, times its quantity; NULL on other events), the seed first.

    Spans of a position don't overlap.  The days on which it has events get their span by one ordered pass over days (the last
    span that opened); events then join their day, so cycles and events never meet in pairs.
    A span's events are gathered in one array and folded one after the other.  Spark copies what a fold carries at every step, so
    nothing that grows with the span is carried from event to event: one fold gives the state at the start of every block of
    events, another the tags of each block from there.  Blocks are as wide as the cube root of the number of events, twice.
    ``cost_rule`` is the one that the positions were rolled with."""
    if cost_rule not in COST_RULES:
        raise ValueError(f"cost_rule is one of {', '.join(COST_RULES)}")
    types = spans
    spans, detail, holding = encode_keys(spans), encode_keys(detail), encode_keys(holding)
    ok = F.col("trd_qty").isNotNull() & F.col("trd_amt").isNotNull() & F.col("timestamp").isNotNull()
    orders = [f"o{i}" for i in range(len(order_cols))]
    item = lambda seed, ts, order, q, a: [
        F.lit(not seed).alias("later"), *[c.cast("long").alias(o) for o, c in zip(orders, order, strict=True)],
        q.cast("long").alias("q"), a.cast("double").alias("a"), ts.cast("long").alias("timestamp")]
    ev = detail.where((F.col("trd_type") == book) & ok & (F.col("busi_date") > seed_date)).select(
        *KEYS, "busi_date", *item(False, F.col("timestamp"), [F.col(c) for c in order_cols], F.col("trd_qty"), F.col("trd_amt")))
    seeds = holding.where(F.col("busi_date") == seed_date).select(
        *KEYS, "busi_date", *item(True, F.lit(None), [F.lit(None)] * len(order_cols), F.col(qty_col), F.col("mkt_val")))
    ev = ev.unionByName(seeds)
    span = spans.select(*KEYS, F.col("open_date").alias("busi_date"), F.struct("open_date", "last_date").alias("span"))
    days = ev.select(*KEYS, "busi_date").distinct().withColumn("span", F.lit(None).cast(span.schema["span"].dataType)).unionByName(span)
    days = days.groupBy(*KEYS, "busi_date").agg(F.max("span").alias("span"))
    in_order = Window.partitionBy(*KEYS).orderBy("busi_date")
    days = days.withColumns({"span": F.last("span", ignorenulls=True).over(in_order), "day": F.row_number().over(in_order)})
    days = days.where(F.col("busi_date") <= F.col("span.last_date"))
    e = F.struct("day", "later", *orders, "q", "a", "timestamp", F.col("busi_date").alias("trd_date")).alias("e")
    ev = ev.join(days, [*KEYS, "busi_date"]).select(*KEYS, "span", e).repartition(*KEYS, "span")
    ordered = ev.groupBy(*KEYS, "span").agg(F.sort_array(F.collect_list("e")).alias("evs"))

    def after(state: Column, e: Column) -> list[Column]:
        x, y, q, a = state["x"], state["y"], e["q"], e["a"]
        x1 = x + q
        if cost_rule == "average_cost":
            sold = y * F.coalesce(F.try_divide(x1.cast("double"), x.cast("double")), F.lit(1.0))
        else:
            sold = F.when(x1 != 0, y + F.floor(F.try_divide(x1 + q, x1)) * y).otherwise(y + a)
        return [x1.alias("x"), F.when(q >= 0, y + a).otherwise(sold).alias("y")]

    def tagged(acc: Column, e: Column) -> Column:
        x, y, q = acc["x"], acc["y"], e["q"]
        tag = F.when((q < 0) & e["later"] & (x != 0), F.try_divide(y, x.cast("double")) * q)
        return F.struct(*after(acc, e), F.concat(acc["tags"], F.array(tag)).alias("tags"))

    last, width = F.size("evs") - 1, F.col("width")
    block = lambda first: F.transform(F.sequence(first, F.least(first + width - 1, last)), lambda i: F.col("evs")[i])
    firsts = F.sequence(F.lit(0), last, width)
    zero = F.array(F.struct(F.lit(0).cast("long").alias("x"), F.lit(0.0).alias("y"))).cast(_DETAIL_STATES)
    starts = F.aggregate(firsts, zero, lambda done, first: F.concat(done, F.array(F.aggregate(
        block(first), F.element_at(done, -1), lambda state, e: F.struct(*after(state, e))))))
    tags = F.flatten(F.zip_with(firsts, F.slice(starts, 1, F.size(firsts)), lambda first, s: F.aggregate(
        block(first), F.struct(s["x"].alias("x"), s["y"].alias("y"), F.array().cast("array<double>").alias("tags")), tagged, lambda acc: acc["tags"])))
    rows = F.zip_with("evs", tags, lambda e, tag: F.struct(e["q"].alias("trd_qty"), e["a"].alias("trd_amt"), e["trd_date"].alias("trd_date"),
                                                           e["timestamp"].alias("timestamp"), tag.alias("return")))
    ordered = ordered.withColumn("width", F.ceil(F.cbrt(F.size("evs")) * 2).cast("int"))
    out = ordered.select(*KEYS, "span.*", rows.cast(_DETAIL).alias("trd_detail"))
    return decode_keys(out, types)


def _with_details(rows: DataFrame, last: str, detail: DataFrame, holding: DataFrame, seed_date: str, *how) -> DataFrame:
    spans = rows.select(*KEYS, "open_date", F.col(last).alias("last_date"))
    found = encode_keys(position_details(spans, detail, holding, seed_date, *how)).withColumnRenamed("last_date", last)
    return decode_keys(encode_keys(rows).join(found, [*KEYS, "open_date", last], "left"), rows)


def closed_position_details(closed: DataFrame, detail: DataFrame, holding: DataFrame, seed_date: str, book: str = LONG,
                            qty_col: str = "qty", order_cols: Sequence[str] = EVENT_ORDER, cost_rule: str = "as_written") -> DataFrame:
    """Closed positions with ``trd_detail`` (``position_details``).

    Built for closing rows only: the daily state stays free of the array, which holds
    a position's whole cycle because that is the table's column.
    """
    return _with_details(closed, "close_date", detail, holding, seed_date, book, qty_col, order_cols, cost_rule)


def open_position_details(open_rows: DataFrame, detail: DataFrame, holding: DataFrame, seed_date: str, book: str = LONG,
                          qty_col: str = "qty", order_cols: Sequence[str] = EVENT_ORDER, cost_rule: str = "as_written") -> DataFrame:
    """One day's open positions with ``trd_detail``, their history up to that day (``position_details``)."""
    return _with_details(open_rows, "busi_date", detail, holding, seed_date, book, qty_col, order_cols, cost_rule)


def position_base(open_rows: DataFrame, detail: DataFrame, holding: DataFrame, calendar: DataFrame, book: str = LONG,
                  qty_col: str = "qty", order_cols: Sequence[str] = EVENT_ORDER) -> DataFrame:
    """What a day's roll starts from, for every trading day T1: the positions open on the trading day before, beside the
    day's events in order, and for open ones what is held on T1.  A position has a row if it is open or has events.

    The three inputs are tagged and meet in one grouping by (position, day); each is read and shuffled once."""
    cal = day_side(calendar.select("busi_date", F.col("rlt_rank").cast("int").alias("rank")), calendar_fits(calendar))
    t1 = day_side(calendar.select((F.col("rlt_rank").cast("int") - 1).alias("rank"), F.col("busi_date").alias("t1")), calendar_fits(calendar))
    state = open_rows.join(cal, "busi_date").join(t1, "rank").select(*KEYS, F.col("t1").alias("busi_date"), F.struct("open_date", F.col("remain_qty").alias("state_qty")).alias("state"))
    ok = F.col("trd_qty").isNotNull() & F.col("trd_amt").isNotNull() & F.col("timestamp").isNotNull()
    event = F.struct(*[F.col(c) for c in order_cols], F.col("trd_qty"), F.col("trd_amt"))
    events = detail.where((F.col("trd_type") == book) & ok).select(*KEYS, "busi_date", event.alias("event"))
    held = holding.select(*KEYS, "busi_date", F.struct(F.col(qty_col).cast("long").alias("remain_qty"), F.col("mkt_val").cast("double").alias("remain_val")).alias("held"))
    rows = state.unionByName(events, allowMissingColumns=True).unionByName(held, allowMissingColumns=True)
    g = rows.groupBy(*KEYS, "busi_date").agg(F.max("state").alias("state"), F.sort_array(F.collect_list("event")).alias("events"), F.max("held").alias("held"))
    is_open = F.col("state").isNotNull()
    return g.where(is_open | (F.size("events") > 0)).select(
        *KEYS, "busi_date", "state.open_date", "state.state_qty", "events",
        F.when(is_open, F.col("held.remain_qty")).alias("remain_qty"), F.when(is_open, F.col("held.remain_val")).alias("remain_val"))


def detail_array_return(details: DataFrame) -> DataFrame:
    """Closed positions with label 0 next to the sum of the returns in their ``trd_detail``."""
    total = F.aggregate("trd_detail", F.lit(0.0), lambda t, e: t + F.coalesce(e["return"], F.lit(0.0)))
    return details.where(F.col("exception_label") == 0).select(*KEYS, "busi_date", "return", total.alias("detail_return_sum"))


def detail_return_check(closed: DataFrame) -> DataFrame:
    """Closed positions with label 0 next to the sum of their detail returns."""
    return closed.where(F.col("exception_label") == 0).select(
        *KEYS, "busi_date", "return", F.col("detail_return").alias("detail_return_sum"))


DETAIL_FIELDS = ("trd_qty", "trd_amt", "trd_date", "timestamp")


def detail_maps(records: DataFrame, fields: Sequence[str] = DETAIL_FIELDS, col: str = "trd_detail", optional: Sequence[str] = ()) -> DataFrame:
    """Convert an array of event structs (``event_records``) to the table format of the original
    position tables, ``array<map<string,string>>`` with every value as text.  Structs are used
    inside the engine; maps only at this boundary.  A NULL ``optional`` field (a tag) has no entry."""
    def to_map(e: Column) -> Column:
        pairs = lambda names: F.create_map(*[c for f in names for c in (F.lit(f), e[f].cast("string"))])
        none = F.create_map().cast("map<string,string>")
        known = pairs(fields) if fields else none
        if optional:
            known = F.when(e[optional[0]].isNotNull(), pairs([*fields, optional[0]])).otherwise(known)
        if len(optional) > 1:
            known = F.map_concat(known, *[F.when(e[f].isNotNull(), pairs([f])).otherwise(none) for f in optional[1:]])
        return known
    return records.withColumn(col, F.transform(col, to_map))


def parse_detail_maps(records: DataFrame, col: str = "trd_detail") -> DataFrame:
    """The typed events of stored maps: what ``detail_maps`` wrote, or maps of other writers.  Text that is no
    number gives NULL, as does an entry that is missing; quantities may be written as decimals."""
    def parse(m: Column) -> Column:
        whole = lambda f: F.coalesce(m[f].try_cast("long"), m[f].try_cast("double").try_cast("long"))
        return F.struct(whole("trd_qty").alias("trd_qty"), m["trd_amt"].try_cast("double").alias("trd_amt"), m["trd_date"].alias("trd_date"),
                        whole("timestamp").alias("timestamp"), m["return"].try_cast("double").alias("return"))
    return records.withColumn(col, F.transform(col, parse).cast(_DETAIL))
