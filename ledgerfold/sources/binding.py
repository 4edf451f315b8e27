"""Binding of the driver's TPC-H style tables to the brokerage input tables.

The brokerage application reads intraday cash-flow events, daily asset / debt
holdings, a trading calendar, return-rate limits and an injected-error log.  The
test data ships lineitem / orders instead, so this module derives those inputs
from them with plain DataFrame expressions (one lineitem x orders join; the rest
are group-bys and window running sums over bounded per-position day lists).

Money is computed in integer cents and divided by 100 once, so every engine
(Spark here, DuckDB in the oracle SQL) produces bit-identical doubles.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerfold.keys import KEYS, LONG, SHORT
from ledgerfold.sinks.tables import write_partitioned
from ledgerfold.sources.tables import read_partitioned

# Fixed values of the binding (chosen for the test data; see FIXTURES.md §2).
N_TRADERS = 40          # trade_id = o_custkey % 40
N_ACCOUNTS = 2          # secu_acc_id = l_suppkey % 2
N_PRODUCTS = 13         # prd_no from l_partkey % 13, remainder 0 is cash '0.0'
BUMP_MODULUS = 11       # holdings get +1 when (rlt_rank + trade_id) % 11 = 0
PRICE_BASE = 1500       # mkt_val = qty * (1500 + (rlt_rank * 37) % 200)
PRICE_STEP = 37
PRICE_SPAN = 200
RATE_LIMIT = 0.2        # every product/day gets limits -0.2 / 0.2 ...
UNLIMITED_PRD = "1.12"  # ... except this product, which has no limits row

# Unique intraday order of events within a position, after the timestamp.
TIE_COLS = ["src_orderkey", "src_linenumber", "src_partkey", "src_suppkey"]
EVENT_ORDER = ["timestamp"] + TIE_COLS


def _cents(c: Column) -> Column:
    return F.round(c * 100).cast("long")


@dataclass
class BrokerageTables:
    """Lazily derived brokerage input tables for one data directory."""

    spark: SparkSession
    sf_dir: str
    n_traders: int = N_TRADERS

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def cash_flow_detail(self) -> DataFrame:
        """odata.stock_cash_flow_detail: one intraday event per lineitem."""
        li = self._read("lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
            "l_extendedprice", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
        )
        od = self._read("orders").select("o_orderkey", "o_custkey", "o_orderpriority")
        j = li.join(od, li.l_orderkey == od.o_orderkey)
        ret = F.col("l_returnflag") == "R"
        ext_c = _cents(F.col("l_extendedprice"))
        amt_c = F.when(ret, -F.floor(ext_c / 2)).otherwise(ext_c)
        fee_c = F.floor((_cents(F.col("l_tax")) * ext_c + 50) / 100)
        qty = F.when(ret, -F.floor(F.col("l_quantity") / 2)).otherwise(F.col("l_quantity")).cast("long")
        pmod = F.col("l_partkey") % N_PRODUCTS
        return j.select(
            (F.col("o_custkey") % self.n_traders).cast("string").alias("trade_id"),
            (F.col("l_suppkey") % N_ACCOUNTS).cast("string").alias("secu_acc_id"),
            F.when(pmod == 0, F.lit("0.0")).otherwise(F.concat(F.lit("1."), pmod.cast("string"))).alias("prd_no"),
            F.date_format(F.trunc("l_shipdate", "MM"), "yyyy-MM-dd").alias("busi_date"),
            F.unix_timestamp("l_shipdate").alias("timestamp"),
            F.concat("l_returnflag", "l_linestatus").alias("busi_flag_code"),
            F.col("o_orderpriority").alias("busi_flag_name"),
            qty.alias("trd_qty"),
            ((amt_c + fee_c) / 100.0).alias("trd_cash_flow"),
            ((amt_c + fee_c) / 100.0).alias("orig_cash_flow"),
            F.when(F.col("l_linenumber") == 1, 1.0).otherwise(0.0).alias("cash_flow_modi_label"),
            (amt_c / 100.0).alias("trd_amt"),
            F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")).alias("trd_price"),
            F.lit("tpch").alias("sys_code"),
            F.when(F.col("l_linestatus") == "O", F.lit(LONG)).otherwise(F.lit(SHORT)).alias("trd_type"),
            F.col("l_returnflag").alias("inner_busi_flag_code"),
            F.when(F.col("l_linenumber") == 7, 1).otherwise(0).alias("amortize_label"),
            F.col("l_orderkey").alias("src_orderkey"),
            F.col("l_linenumber").alias("src_linenumber"),
            F.col("l_partkey").alias("src_partkey"),
            F.col("l_suppkey").alias("src_suppkey"),
        )

    @cached_property
    def trading_day(self) -> DataFrame:
        """odata.trading_day(busi_date, rlt_rank): one row per distinct business day.

        The ranking window runs over the distinct days only (bounded by the
        calendar length), never over events.
        """
        days = self.cash_flow_detail.select("busi_date").distinct()
        return days.select("busi_date", F.row_number().over(Window.orderBy("busi_date")).alias("rlt_rank"))

    @cached_property
    def _holdings(self) -> DataFrame:
        """Daily holdings of both books: every trading day from a position's first event on."""
        from ledgerfold.functions.calendar import calendar_fits, day_side
        cal = day_side(self.trading_day, calendar_fits(self.trading_day))  # one row per trading day
        pos = KEYS + ["trd_type"]
        per_day = (
            self.cash_flow_detail.groupBy(*pos, "busi_date").agg(F.sum("trd_qty").alias("day_qty"))
            .join(cal, "busi_date")
        )
        first = per_day.groupBy(*pos).agg(F.min("rlt_rank").alias("first_rank"))
        last = self.trading_day.agg(F.max("rlt_rank")).first()[0]
        grid = first.select(*pos, F.explode(F.sequence("first_rank", F.lit(last))).alias("rlt_rank")) \
            .join(cal, "rlt_rank")
        w = Window.partitionBy(*pos).orderBy("rlt_rank").rowsBetween(Window.unboundedPreceding, 0)
        cum = F.sum(F.coalesce("day_qty", F.lit(0))).over(w)
        bump = F.when((F.col("rlt_rank") + F.col("trade_id").cast("int")) % BUMP_MODULUS == 0, 1).otherwise(0)
        price = F.lit(PRICE_BASE) + (F.col("rlt_rank") * PRICE_STEP) % PRICE_SPAN
        return (
            grid.join(per_day.drop("busi_date"), pos + ["rlt_rank"], "left")
            .select(*pos, "busi_date", "rlt_rank", (cum + bump).alias("qty"), bump.alias("bump"))
            .withColumn("mkt_val", (F.col("qty") * price).cast("double"))
        )

    @cached_property
    def stock_asset_holding(self) -> DataFrame:
        h = self._holdings.where(F.col("trd_type") == LONG)
        return h.select(*KEYS, F.lit("tpch").alias("sys_code"), "qty", F.lit(0).cast("long").alias("prsnt_qty"),
                        F.lit(0).cast("long").alias("asset_amend_qty"), "mkt_val", "busi_date")

    @cached_property
    def stock_debt_holding(self) -> DataFrame:
        h = self._holdings.where(F.col("trd_type") == SHORT)
        return h.select(*KEYS, F.lit("tpch").alias("sys_code"), F.col("qty").alias("liab_qty"),
                        F.lit(0).cast("long").alias("prsnt_liab_qty"), F.lit(0).cast("long").alias("asset_amend_qty"),
                        "mkt_val", "busi_date")

    @cached_property
    def stock_return_rate_range(self) -> DataFrame:
        """Limits for every (product, day) that holdings or events mention, except one product."""
        pairs = (
            self._holdings.select("prd_no", "busi_date")
            .unionByName(self.cash_flow_detail.select("prd_no", "busi_date"))
            .distinct()
            .where(F.col("prd_no") != UNLIMITED_PRD)
        )
        lo, hi = F.lit(-RATE_LIMIT), F.lit(RATE_LIMIT)
        return pairs.select("prd_no", "busi_date", lo.alias("long_lower_limit"), hi.alias("long_upper_limit"),
                            lo.alias("short_lower_limit"), hi.alias("short_upper_limit"))

    @cached_property
    def stock_generate_error(self) -> DataFrame:
        """Injected errors: the +1 bumps change now - pre - trd by bump(day) - bump(previous day)."""
        pos = KEYS + ["trd_type"]
        w = Window.partitionBy(*pos).orderBy("rlt_rank")
        prev = F.coalesce(F.lag("bump").over(w), F.lit(0))
        return (
            self._holdings.select(*pos, "busi_date", (F.col("bump") - prev).alias("error_qty"))
            .where(F.col("error_qty") != 0)
        )


def bind(spark: SparkSession, sf_dir: str, n_traders: int = N_TRADERS) -> BrokerageTables:
    return BrokerageTables(spark, sf_dir, n_traders)


_TABLES = ("cash_flow_detail", "trading_day", "stock_asset_holding", "stock_debt_holding",
           "stock_return_rate_range", "stock_generate_error")


_BY_DAY = ("cash_flow_detail", "stock_asset_holding", "stock_debt_holding")


class StoredTables:
    """The same tables, written once as parquet under the session's checkpoint directory and
    read back - the stand-in for the stored brokerage tables of a real deployment.  Reading
    them back gives pushdown / pruning and cuts the derivation lineage."""

    def __init__(self, spark: SparkSession, root: str, sf_dir: str):
        self.spark = spark
        self.root = root
        self.sf_dir = sf_dir
        for name in _TABLES:
            setattr(self, name, read_partitioned(spark, f"{root}/{name}") if name in _BY_DAY else spark.read.parquet(f"{root}/{name}"))


def store(tables: BrokerageTables, root: str) -> StoredTables:
    """Write every bound table; each one is derived from the already-written ones (the
    cached properties are replaced by the read-back DataFrames as we go).  Tables that jobs
    read by day are partitioned by it, so a day's job reads that day's files."""
    for name in ("cash_flow_detail", "trading_day", "_holdings") + _TABLES[2:]:
        df, path = getattr(tables, name), f"{root}/{name}"
        if name in _BY_DAY:
            write_partitioned(df, path, replace="all")
            tables.__dict__[name] = read_partitioned(tables.spark, path)
        else:
            df.write.mode("overwrite").parquet(path)
            tables.__dict__[name] = tables.spark.read.parquet(path)
    return StoredTables(tables.spark, root, tables.sf_dir)


_STORED: dict[tuple[str, str], StoredTables] = {}


def stored(spark: SparkSession, sf_dir: str) -> StoredTables:
    """Bound tables for ``sf_dir``, derived and written once per Spark application."""
    import uuid

    from ledgerfold.session import ensure_checkpoint_dir

    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STORED:
        root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ledgerfold-tables-{uuid.uuid4().hex[:12]}"
        _STORED[key] = store(bind(spark, sf_dir), root)
    return _STORED[key]
