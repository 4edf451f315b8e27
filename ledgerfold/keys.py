"""Column-name conventions shared by all operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the brokerage data model.
KEYS = ["trade_id", "secu_acc_id", "prd_no"]  # a position inside one book
LONG = "long_related"
SHORT = "short_related"
CASH_PRD = "0.0"

POSITION = KEYS + ["trd_type"]  # a position together with its book
BOOKS = (LONG, SHORT)


def encode_keys(df: DataFrame) -> DataFrame:
    """Position keys as text that is never NULL ('' for NULL, '=' before any value), so that joins, groups and
    windows of one plan treat a NULL key part alike: as a value of its own."""
    return df.withColumns({k: F.coalesce(F.concat(F.lit("="), F.col(k).cast("string")), F.lit("")) for k in KEYS})


def decode_keys(df: DataFrame, like: DataFrame) -> DataFrame:
    """The keys of ``encode_keys`` as they were, in the types of ``like``."""
    types = {f.name: f.dataType for f in like.schema.fields}
    return df.withColumns({k: F.when(F.col(k) != "", F.substr(F.col(k), F.lit(2))).cast(types[k]) for k in KEYS})
