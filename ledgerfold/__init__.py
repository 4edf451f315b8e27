"""ledgerfold: brokerage reconciliation and profit analytics as Spark DataFrame operators.

Every operator takes DataFrames (plus dates / options) and returns a lazy DataFrame;
Catalyst plans the work.  Only the lot-matching fold with amortisation and reconciliation
runs Python, grouped per position with ``applyInPandas``.
"""

from ledgerfold.keys import KEYS, POSITION, LONG, SHORT

__all__ = ["KEYS", "POSITION", "LONG", "SHORT"]
