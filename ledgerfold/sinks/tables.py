"""Writers for partitioned brokerage tables.

Every daily job of the original application ends by replacing one day
partition (``insert overwrite ... partition(busi_date=...)``).  Here a job names
the days it owns: those days are replaced by its rows, an owned day without rows
becomes empty, and a row of any other day fails the job before it commits.  Without
named days exactly the days present in the rows are replaced.  Other days stay, whatever the
session's ``partitionOverwriteMode`` is: ``insertInto`` reads only the session's setting, so it is
set for the write and restored.  A write is a single Spark job: a lost executor only
re-runs tasks, and the commit protocol keeps half-written files invisible.

Named days of a catalog table are written beside it first, those with rows and those without, and then each
day's partition is pointed at its new folder: until then every day is as it was, and no day is ever part old and part new.
A table that is saved again (``save_as_table``) is written under another name and then takes its place, so it may be made from itself.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Reorder ``df`` by the target's column names and cast to the target types (positional
    inserts then line up); columns the target lacks are dropped, missing ones are NULL."""
    cols = df.columns
    return df.select(*[
        (F.col(f.name) if f.name in cols else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def ddl(name: str, schema: T.StructType, partition_cols: tuple[str, ...] = ("busi_date",), fmt: str = "orc",
        comment: str | None = None, location: str | None = None) -> str:
    """``CREATE TABLE IF NOT EXISTS`` for a datasource table with column comments."""
    def col(f: T.StructField) -> str:
        c = f.metadata.get("comment")
        text = f"`{f.name}` {f.dataType.simpleString()}"
        return text + (f" COMMENT '{c}'" if c else "")
    body = ",\n  ".join(col(f) for f in schema.fields)
    out = f"CREATE TABLE IF NOT EXISTS {name} (\n  {body}\n) USING {fmt}"
    if partition_cols:
        out += f"\nPARTITIONED BY ({', '.join(partition_cols)})"
    if location:
        out += f"\nLOCATION '{location}'"
    if comment:
        out += f"\nCOMMENT '{comment}'"
    return out


def create_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def create_table(spark: SparkSession, name: str, schema: T.StructType, partition_cols: tuple[str, ...] = ("busi_date",),
                 fmt: str = "orc", comment: str | None = None, location: str | None = None) -> None:
    spark.sql(ddl(name, schema, partition_cols, fmt, comment, location))


def add_partition(spark: SparkSession, table: str, busi_date: str) -> None:
    """Make an (empty) day partition; a no-op when it exists."""
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION (busi_date = '{busi_date}')")


OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


@contextmanager
def dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """Dynamic partition overwrite inside the block; the session's own setting afterwards."""
    before = spark.conf.get(OVERWRITE_MODE, None)
    spark.conf.set(OVERWRITE_MODE, "dynamic")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(OVERWRITE_MODE)
        else:
            spark.conf.set(OVERWRITE_MODE, before)


def owned(df: DataFrame, days: Sequence[str], day_col: str = "busi_date") -> DataFrame:
    """``df``, failing when it is run if a row is of none of ``days``."""
    other = F.raise_error(F.concat(F.lit("row of a day that is not to be replaced: "), F.coalesce(F.col(day_col), F.lit("NULL"))))
    return df.withColumn(day_col, F.when(F.col(day_col).isin(list(days)), F.col(day_col)).otherwise(other.cast("string")))


def _written_days(df: DataFrame, day_col: str) -> tuple[DataFrame, Observation]:
    """``df`` and an observation of the days it holds (one value a day)."""
    seen = Observation()
    return df.observe(seen, F.collect_set(day_col).alias("days")), seen


def _described(spark: SparkSession, table: str, day: str | None = None) -> dict[str, str]:
    """What the catalog says of a table, or of one of its days ({} if it has no such day)."""
    if day is not None and spark.sql(f"SHOW PARTITIONS {table} PARTITION (busi_date = '{day}')").isEmpty():
        return {}
    of = f" PARTITION (busi_date = '{day}')" if day is not None else ""
    out: dict[str, str] = {}
    for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}{of}").collect():
        out.setdefault(r["col_name"], r["data_type"])  # a partition's own entries come before the table's
    return out


def stage_days(df: DataFrame, table: str, days: Sequence[str]) -> str:
    """Write ``df`` beside ``table``, a folder for each of ``days`` (empty without rows); the folder that holds them."""
    spark = df.sparkSession
    about = _described(spark, table)
    folder = f"{about['Location'].rstrip('/')}/_days_{uuid.uuid4().hex}"
    out, seen = _written_days(owned(df, days).hint("rebalance", "busi_date"), "busi_date")
    out.write.format(about["Provider"]).partitionBy("busi_date").save(folder)
    for day in sorted(set(days) - set(seen.get["days"])):
        empty_like(df.drop("busi_date")).write.format(about["Provider"]).save(f"{folder}/busi_date={day}")
    return folder


def switch_days(spark: SparkSession, table: str, days: Sequence[str], folder: str) -> None:
    """Point the partitions of ``days`` at their folders under ``folder``; what they held before is removed."""
    whole = _described(spark, table)["Location"].rstrip("/")
    before = {day: _described(spark, table, day).get("Location") for day in days}
    for day in days:
        place = f"'{folder}/busi_date={day}'"
        if before[day] is None:
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION (busi_date = '{day}') LOCATION {place}")
        else:
            spark.sql(f"ALTER TABLE {table} PARTITION (busi_date = '{day}') SET LOCATION {place}")
    spark.catalog.refreshTable(table)
    for old in filter(None, before.values()):
        if old.rstrip("/") != whole and not whole.startswith(old):
            _drop_folder(spark, old)


def replace_partitions(df: DataFrame, table: str, days: Sequence[str] | None = None) -> None:
    """Replace the named ``days`` (default: the days in ``df``) of a catalog table by ``df``.

    Named days are staged and switched; a day without rows stays as an empty partition."""
    spark = df.sparkSession
    out = conform(df, spark.table(table).schema)
    if days is not None:
        named = sorted(set(days))
        if any(re.search(r"[^\w.-]", day) for day in named):
            raise ValueError(f"not days: {named}")
        switch_days(spark, table, named, stage_days(out, table, named))
        return
    with dynamic_overwrite(spark):
        out.write.insertInto(table, overwrite=True)


def append(df: DataFrame, table: str) -> None:
    target = df.sparkSession.table(table).schema
    conform(df, target).write.insertInto(table, overwrite=False)


def replace_day(df: DataFrame, table: str, busi_date: str) -> None:
    """Replace one day of an existing ``table`` with ``df``; rows of other days raise."""
    if not df.sparkSession.catalog.tableExists(table):
        raise ValueError(f"no table {table} to replace a day of")
    replace_partitions(df, table, [busi_date])


def save_as_table(df: DataFrame, table: str, partition_cols: tuple[str, ...] = ("busi_date",), fmt: str = "orc",
                  mode: str = "overwrite") -> None:
    """(Re)create a partitioned catalog table from ``df``, which may read the table itself: an
    existing one is kept until the new one is whole and takes its name."""
    spark = df.sparkSession
    if mode != "overwrite" or not spark.catalog.tableExists(table):
        w = df.write.format(fmt).mode(mode)
        (w.partitionBy(*partition_cols) if partition_cols else w).saveAsTable(table)
        return
    about = _described(spark, table)
    old = about["Location"].rstrip("/")
    folder = f"{re.sub('_rows_[0-9a-f]{32}$', '', old)}_rows_{uuid.uuid4().hex}"
    w = df.write.format(fmt)
    (w.partitionBy(*partition_cols) if partition_cols else w).save(folder)
    spark.sql(f"DROP TABLE {table}")
    create_table(spark, table, T.StructType([f for f in df.schema if f.name not in partition_cols] + [df.schema[c] for c in partition_cols]), partition_cols, fmt, location=folder)
    if partition_cols:
        spark.sql(f"MSCK REPAIR TABLE {table}")
    if re.search("_rows_[0-9a-f]{32}$", old):  # an earlier folder of this function; a managed table's went with the table
        _drop_folder(spark, old)


def empty_like(df: DataFrame) -> DataFrame:
    """A DataFrame with ``df``'s schema and no rows (``where 1 = 0``)."""
    return df.limit(0)


def _drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a partition's folder through the path's own file system."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def write_partitioned(df: DataFrame, path: str, fmt: str = "parquet", partition_cols: tuple[str, ...] = ("busi_date",),
                      replace: str = "dynamic", days: Sequence[str] | None = None, options: dict[str, str] | None = None) -> None:
    """Write ``df`` to a path partitioned by day.  ``replace='dynamic'`` replaces the named
    ``days`` (default: those present in ``df``); ``'all'`` replaces the whole dataset; ``'append'`` adds files.
    ``options`` are the writer's.

    Rows are clustered by the partition columns with a REBALANCE hint, so each task writes few
    files per day while AQE splits a day that is too big for one task and merges small ones."""
    if days is not None and (replace != "dynamic" or partition_cols != ("busi_date",)):
        raise ValueError("days can be named only where days are replaced")
    out = owned(df, days) if days is not None else df
    out = out.hint("rebalance", *partition_cols) if partition_cols else out
    seen = None
    if days is not None:
        out, seen = _written_days(out, "busi_date")
    w = out.write.format(fmt).options(**(options or {}))
    if replace == "append":
        w = w.mode("append")
    else:
        # the mode is named either way: the session's setting must not decide what is kept
        w = w.mode("overwrite").option("partitionOverwriteMode", "dynamic" if replace == "dynamic" else "static")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.save(path)
    if seen is not None:
        for day in sorted(set(days) - set(seen.get["days"])):
            _drop_folder(df.sparkSession, f"{path.rstrip('/')}/busi_date={day}")
