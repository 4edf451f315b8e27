"""The binding + account check reproduce the counts published in FIXTURES.md §2 (sf0.01, 1998-06-01)."""

from pyspark.sql import functions as F

from ledgerfold.operators.account import account_check
from ledgerfold.operators.cashflow import merge_cash_flow
from ledgerfold.sources.binding import stored

# FIXTURES.md §2, "Account check for 1998-06-01 at sf 0.01"
EXPECTED = {
    ("long_related", 0, 0): 673, ("long_related", 0, 1): 31, ("long_related", 1, 0): 169, ("long_related", 1, 1): 24,
    ("short_related", 0, 0): 658, ("short_related", 0, 1): 46, ("short_related", 1, 0): 164,
    ("short_related", 1, 1): 35,
}


def test_account_check_counts_for_1998_06_01(spark):
    t = stored(spark, "/root/testdata/sf0.01")
    chk = account_check(merge_cash_flow(t.cash_flow_detail, with_names=False), t.stock_asset_holding,
                        t.stock_debt_holding, t.stock_return_rate_range, t.trading_day, t1="1998-06-01")
    got = {(r.trd_type, r.qty_exception, r.return_rate_exception): r["count"]
           for r in chk.groupBy("trd_type", "qty_exception", "return_rate_exception").count().collect()}
    assert got == EXPECTED
    cash = {r.trd_type: r["count"] for r in chk.where(F.col("prd_no") == "0.0").groupBy("trd_type").count().collect()}
    assert cash == {"long_related": 17, "short_related": 23}
    assert t.stock_asset_holding.count() + t.stock_debt_holding.count() == 167725
