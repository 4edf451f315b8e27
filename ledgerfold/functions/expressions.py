"""Scalar column helpers with the reference's NULL and zero-division rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def nvl0(c: Column | str) -> Column:
    """``nvl(x, 0)``."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(0))


def sql_div(num: Column, den: Column) -> Column:
    """SQL division of the original engine: x / 0 is NULL (ANSI would raise)."""
    return F.try_divide(num, den)


def null_safe_ne(a: Column, b: Column) -> Column:
    """Python ``a != b`` where None != 0 is True."""
    return ~a.eqNullSafe(b)


def open_date_or(c: Column, default: Column) -> Column:
    """Use ``c`` only if it is a 10-character date string, else ``default``."""
    return F.when(c.isNotNull() & (F.length(c) == 10), c).otherwise(default)


def exception_type(qty_exception: Column, rate_exception: Column) -> Column:
    """(1,0) -> 'qty'; (0,1) -> 'return_rate'; anything else -> 'both'."""
    return (
        F.when((qty_exception == 1) & (rate_exception == 0), F.lit("qty"))
        .when((qty_exception == 0) & (rate_exception == 1), F.lit("return_rate"))
        .otherwise(F.lit("both"))
    )
