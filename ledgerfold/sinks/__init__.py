"""Table management and writers: DDL, partitions, idempotent day replacement."""

from ledgerfold.sinks.tables import (add_partition, append, conform, create_database, create_table, ddl, empty_like,
                                     replace_day, replace_partitions, save_as_table, write_partitioned)

__all__ = ["add_partition", "append", "conform", "create_database", "create_table", "ddl", "empty_like",
           "replace_day", "replace_partitions", "save_as_table", "write_partitioned"]
