"""Input tables: the test-data binding and readers for real brokerage tables."""

from ledgerfold.sources.binding import BrokerageTables, bind, EVENT_ORDER, TIE_COLS
from ledgerfold.sources.tables import read_day, read_days, read_partitioned

__all__ = ["BrokerageTables", "bind", "EVENT_ORDER", "TIE_COLS", "read_day", "read_days", "read_partitioned"]
