"""Every registered query against its DuckDB oracle on the smallest data set, compared like the
driver does: same row count, same column names, same rows (order-insensitive)."""

import math
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from ledgerfold.plans.queries import QUERIES as OWN

SF = "/root/testdata/sf0.001"
NO_ORACLE = set()


def _norm(v):
    if v is None:
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("lineitem", "orders"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle_or_is_listed():
    assert set(OWN) - set(oracle_sql()) == NO_ORACLE


def test_lots_balance_and_follow_from_each_other(spark):
    """Every lot's figures against each other and the sequence of its days, beside the SQL of both tables."""
    lots = OWN["lots_open"](spark, SF).toPandas()
    assert (lots.unclose_qty > 0).all() and (lots.trd_qty - lots.close_qty - lots.unclose_qty).abs().max() < 1e-6
    assert (lots.unclose_qty * 1e6 - (lots.unclose_qty * 1e6).round()).abs().max() < 1e-3 and lots.unclose_qty.min() >= 1e-6
    closed = OWN["lots_closed"](spark, SF).toPandas()
    assert len(closed) and ((closed.close_amt - closed.trd_amt) - closed["return"]).abs().max() < 1e-6
    key = ["trade_id", "secu_acc_id", "prd_no", "open_date"]
    last_open = lots.groupby(key).busi_date.max()
    both = closed.set_index(key).join(last_open, how="inner")
    assert (both.close_date > both.busi_date).all()


@pytest.mark.parametrize("name", sorted(set(oracle_sql()) & set(OWN)))
def test_query_matches_oracle(spark, duck, name):
    sdf = queries()[name](spark, SF).toPandas()
    ddf = duck.execute(oracle_sql()[name]).df()
    assert sorted(sdf.columns) == sorted(ddf.columns)
    cols = sorted(sdf.columns)
    a = sorted((tuple(_norm(x) for x in r) for r in sdf[cols].itertuples(index=False)), key=repr)
    b = sorted((tuple(_norm(x) for x in r) for r in ddf[cols].itertuples(index=False)), key=repr)
    assert len(a) == len(b)
    assert a == b


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "return_rate_exception" in df.columns
