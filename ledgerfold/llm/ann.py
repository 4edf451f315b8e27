"""Approximate nearest neighbours by cross-polytope hashing, with exact reranking.

A unit vector is rotated by three rounds of random signs and a fast Hadamard transform (padded to a
power of two) and falls in the bucket of its nearest signed axis.  ``tables`` rotations give as many
buckets; a query probes the ``probes`` nearest signed axes of each.

How many tables and probes a table of vectors needs is measured, for each length of vectors (``measure``): ``SAMPLE`` queries are answered
exactly, against all rows in blocks, and the least tables x probes is taken at which the buckets hold ``RECALL`` of
their true neighbours.  Vectors in clusters need few of the ``TABLES`` and of the axes; vectors without any structure need so many that
most rows are met, which no hashing avoids.

Inside a bucket queries and
rows are cut into blocks of ``BLOCK``, and each pair of blocks is one unit of work, so
neither a hot bucket nor a popular probe lands in one task.  A unit scores its pairs exactly, in double precision on the
original vectors, and hands on each query's nearest: pairs are never rows.

Equal vectors are searched once: they share their score, so only their ``k`` + 1 least ids
can ever be in a result (taken by rank, with a limit before the shuffle).  Queries that
found fewer than they can are scored against all rows in blocks (small tables, odd vectors).

Rows are hashed by direction and ranked by the inner product, so tables and probes must suit
the spread of norms; on unit vectors both agree.  Defined results: a null id, and a vector that is null, empty, zero or
holds null or non-finite components takes no part; of rows with the same id the least vector counts; vectors
meet only those of their own length; ties go to the smaller id.  Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerfold.llm.token_files import scratch

TABLES, BLOCK, K = 16, 4096, 20
#: Share of true neighbours that the buckets must hold, and queries of each length on which it is measured.
RECALL, SAMPLE = 0.97, 200
HASHED = "rep long, v array<double>, d int, t int, b int"
FOUND = "q long, c long, score double"


def _hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row (their length a power of two)."""
    n, h = x.shape[1], 1
    while h < n:
        x = x.reshape(len(x), -1, 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(len(x), n)
        h *= 2
    return x / np.sqrt(n)


def nearest_axes(x: np.ndarray, table: int, probes: int, seed: int = 11) -> np.ndarray:
    """The ``probes`` nearest signed axes of each row after the table's rotation, nearest first."""
    size = 1 << max(0, int(x.shape[1] - 1).bit_length())
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    x = np.pad(x, ((0, 0), (0, size - x.shape[1])))
    rng = np.random.default_rng([seed, table, size])
    for _ in range(3):
        x = _hadamard(x * rng.choice([-1.0, 1.0], size))
    both = np.concatenate([x, -x], axis=1)
    probes = min(probes, both.shape[1])
    if probes == 1:
        return both.argmax(axis=1)[:, None]
    best = np.argpartition(-both, probes - 1, axis=1)[:, :probes]
    return np.take_along_axis(best, np.argsort(-np.take_along_axis(both, best, axis=1), axis=1, kind="stable"), axis=1)


def _matrix(column: pa.Array) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row numbers, matrix) for the vectors of each length."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    out = []
    for d in np.unique(lengths).tolist():
        rows = np.nonzero(lengths == d)[0]
        out.append((d, rows, column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).reshape(len(rows), d).astype(np.float64)))
    return out


def _hasher(plan: dict[int, tuple[int, int]], asking: bool) -> Callable:
    """Rows of HASHED: the buckets of rows, or those that queries probe.  plan: (tables, probes) by length."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, rows, x in _matrix(batch.column(1)):
                ids = batch.column(0).take(pa.array(rows))
                tables, probes = plan.get(d, (0, 0))
                for table in range(tables):
                    axes = nearest_axes(x, table, probes if asking else 1)
                    for p in range(axes.shape[1]):
                        n = len(rows)
                        yield pa.RecordBatch.from_arrays([
                            ids, pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * d), pa.array(x.reshape(-1))),
                            pa.array(np.full(n, d, np.int32)), pa.array(np.full(n, table, np.int32)), pa.array(axes[:, p].astype(np.int32))], names=["rep", "v", "d", "t", "b"])

    return hashed


def _nearest(qi: np.ndarray, q: np.ndarray, ci: np.ndarray, c: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k nearest of c for each row of q: (query ids, ids, scores); ties to the smaller id."""
    order = np.argsort(ci)
    ci, c = ci[order], c[order]
    out = []
    for at in range(0, len(q), 256):
        part = q[at:at + 256]
        rough = part @ c.T
        n = min(k, len(c))
        # all that are within rounding of the n-th best, then exactly, in one order of addition
        bound = -np.partition(-rough, n - 1, axis=1)[:, n - 1]
        slack = 1e-9 * (1 + np.abs(bound))
        i, j = np.nonzero(rough >= (bound - slack)[:, None])
        exact = (part[i] * c[j]).sum(axis=1)
        order = np.lexsort((ci[j], -exact, i))
        i, j, exact = i[order], j[order], exact[order]
        rank = np.arange(len(i)) - np.searchsorted(i, i)
        best = rank < n
        out.append((qi[at + i[best]], ci[j[best]], exact[best]))
    return tuple(np.concatenate(x) for x in zip(*out))


def _searcher(k: int) -> Callable:
    """Rows (unit columns..., is_query, rep, v) sorted by unit -> FOUND; holds one unit at a time."""

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, held = None, []

        def found(rows: list) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(rows)
            is_query = table["is_query"].to_numpy()
            if not is_query.any() or is_query.all():
                return
            ids = table["rep"].to_numpy()
            v = table["v"].combine_chunks()
            x = v.flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
            q, c, s = _nearest(ids[is_query], x[is_query], ids[~is_query], x[~is_query], k)
            yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(c), pa.array(s)], names=["q", "c", "score"])

        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)], axis=1)
            cuts = np.concatenate([[0], np.nonzero((keys[1:] != keys[:-1]).any(axis=1))[0] + 1, [len(keys)]]) if len(keys) else np.zeros(0, int)
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if unit is not None and tuple(keys[a]) != unit:
                    yield from found(held)
                    held = []
                unit = tuple(keys[a])
                held.append(batch.slice(a, b - a))
        if held:
            yield from found(held)

    return searched


def _usable(v: Column) -> Column:
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & fine & F.exists(v, lambda x: x != 0)


def _in_blocks(rows: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Nearest of ``rows`` for ``queries`` (HASHED both) inside each bucket, block pair by block pair."""
    place = ["d", "t", "b"]
    blocks = lambda c: F.greatest(F.lit(1), F.ceil(F.col(c) / F.lit(BLOCK))).cast("int")
    sizes = rows.groupBy(*place).agg(F.count("*").alias("nr")).join(queries.groupBy(*place).agg(F.count("*").alias("nq")), place).select(*place, blocks("nr").alias("nr"), blocks("nq").alias("nq"))
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    own = lambda c: F.pmod(F.xxhash64("rep"), F.col(c)).cast("int")
    # a row a bucket in use: tables x signed axes for each length of vectors
    data = rows.join(F.broadcast(sizes), place).select(*place, own("nr").alias("i"), every("nq").alias("j"), F.lit(False).alias("is_query"), "rep", "v")
    asks = queries.join(F.broadcast(sizes), place).select(*place, every("nr").alias("i"), own("nq").alias("j"), F.lit(True).alias("is_query"), "rep", "v")
    unit = [*place, "i", "j"]
    return data.unionByName(asks).repartition(*unit).sortWithinPartitions(*unit).mapInArrow(_searcher(k), FOUND)


def cheapest(ranks: np.ndarray, target: float) -> tuple[int, int]:
    """The (tables, probes) of least product that find ``target`` of the pairs; ranks: for each pair and table, how many
    axes are nearer to the query than the candidate's."""
    best = None
    for tables in range(1, ranks.shape[1] + 1):
        first = np.sort(ranks[:, :tables].min(axis=1))
        probes = int(first[max(0, int(np.ceil(target * len(first))) - 1)]) + 1
        if best is None or tables * probes < best[0] * best[1]:
            best = tables, probes
    return best


def _whole(d: DataFrame) -> DataFrame:
    """HASHED rows that are all in one bucket of their length."""
    return d.select("rep", "v", F.size("v").alias("d"), F.lit(-1).alias("t"), F.lit(0).alias("b"))


def measure(all_rows: DataFrame, asking: DataFrame, k: int = K, tables: int = TABLES, target: float = RECALL, sample: int = SAMPLE) -> dict[int, tuple[int, int]]:
    """(tables, probes) for each length of the vectors that queries have, from ``sample`` queries of the length (those of least
    hash) and their ``k`` true neighbours; those few vectors reach the driver, so lengths are expected to be few."""
    by_hash = Window.partitionBy("d").orderBy(F.xxhash64("rep"), "rep")
    some = asking.withColumn("d", F.size("v")).withColumn("r", F.row_number().over(by_hash)).filter(F.col("r") <= sample).select("rep", "v")
    exact = _in_blocks(_whole(all_rows), _whole(some), k + 1).filter("q <> c")
    true = exact.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "c"))).filter(F.col("r") <= k).select("q", "c")
    q, c = (all_rows.select(F.col("rep").alias(n), F.col("v").alias(f"{n}v")) for n in ("q", "c"))
    pairs = true.join(c, "c").groupBy("q").agg(F.collect_list("cv").alias("near")).join(q, "q").select(F.size("qv").alias("d"), "qv", "near").collect()
    plan = {r.d: (1, 1) for r in some.select(F.size("v").alias("d")).distinct().collect()}  # a length of one vector
    for d in {r.d for r in pairs}:
        mine = [r for r in pairs if r.d == d]
        x, y = np.array([r.qv for r in mine]), np.concatenate([np.array(r.near) for r in mine])
        of = np.repeat(np.arange(len(mine)), [len(r.near) for r in mine])
        ranks = np.empty((len(y), tables), np.int64)
        for table in range(tables):
            axes = nearest_axes(x, table, 1 << 62)
            place = np.argsort(axes, axis=1)  # of each axis in the query's order
            ranks[:, table] = place[of, nearest_axes(y, table, 1)[:, 0]]
        plan[d] = cheapest(ranks, target)
    return plan


def search(spark: SparkSession, vectors: DataFrame, queries: Column, k: int = K, tables: int = TABLES, recall: float = RECALL, sample: int = SAMPLE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """For the rows where ``queries`` (an expression of ``vec_id``) holds: query_id, rank, vec_id, score.  At most ``tables``
    rotations are used, and as few of them and of probes as reach ``recall`` (``measure``)."""
    folder = scratch(spark, "ann")
    v = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v")).filter(F.col("vec_id").isNotNull() & _usable(F.col("v")))
    v = v.groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("x", F.xxhash64("v")).withColumn("y", F.xxhash64(F.lit(7), "v"))
    v.write.parquet(f"{folder}/vectors")
    v = spark.read.parquet(f"{folder}/vectors")
    by_id = Window.partitionBy("x", "y").orderBy("vec_id")
    firsts = v.select("vec_id", "x", "y").withColumn("r", F.row_number().over(by_id)).filter(F.col("r") <= k + 1)
    groups = v.groupBy("x", "y").agg(F.min(F.struct("vec_id", "v")).alias("m")).select("x", "y", F.col("m.vec_id").alias("rep"), F.col("m.v").cast("array<double>").alias("v"))
    groups.write.parquet(f"{folder}/groups")
    groups = spark.read.parquet(f"{folder}/groups")
    asked = v.filter(queries).select(F.col("vec_id").alias("query_id"), "x", "y")
    asking = groups.join(asked.select("x", "y").distinct(), ["x", "y"], "left_semi").select("rep", "v")
    all_rows = groups.select("rep", "v")

    plan = measure(all_rows, asking, k, tables, recall, sample)
    _in_blocks(all_rows.mapInArrow(_hasher(plan, False), HASHED), asking.mapInArrow(_hasher(plan, True), HASHED), k + 1).write.parquet(f"{folder}/found")
    found = spark.read.schema(FOUND).parquet(f"{folder}/found").groupBy("q", "c").agg(F.max("score").alias("score"))
    # queries with fewer vectors than they could have: against all rows of their length
    there = all_rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"))
    few = asking.withColumn("d", F.size("v")).join(found.groupBy(F.col("q").alias("rep")).agg(F.count("*").alias("got")), "rep", "left").join(F.broadcast(there), "d").filter(
        F.coalesce("got", F.lit(0)) < F.least(F.lit(k + 1), "n")).select("rep", "v")
    few.write.parquet(f"{folder}/few")
    few = spark.read.schema("rep long, v array<double>").parquet(f"{folder}/few")
    if not few.isEmpty():
        rest = _in_blocks(_whole(all_rows), _whole(few), k + 1)
        found = found.join(few.select(F.col("rep").alias("q")), "q", "left_anti").unionByName(rest.groupBy("q", "c").agg(F.max("score").alias("score")))

    nearest = lambda over, *order: F.row_number().over(Window.partitionBy(over).orderBy(F.desc("score"), *order))
    best = found.withColumn("r", nearest("q", "c")).filter(F.col("r") <= k + 1).select("q", "c", "score")
    reps = groups.select("rep", "x", "y")
    ids = firsts.join(reps, ["x", "y"]).select(F.col("rep").alias("c"), "vec_id")
    best = best.join(ids, "c").withColumn("r", nearest("q", "vec_id")).filter(F.col("r") <= k + 1).select("q", "vec_id", "score")
    asked = asked.join(reps, ["x", "y"]).select("query_id", F.col("rep").alias("q"))
    out = asked.join(best, "q").filter(F.col("query_id") != F.col("vec_id")).withColumn("rank", nearest("query_id", "vec_id")).filter(F.col("rank") <= k)
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
