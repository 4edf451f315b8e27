"""Best-fit packing in bulk-synchronous rounds.

State: open sequences with their gaps, and unplaced pieces.  A round

1. range-sorts gaps and pieces together by size, largest first (equal sizes are split by id);
2. sweeps every range in its own task: a piece takes the smallest gap of its range that
   holds it, and what is left of that gap joins the sweep again;
3. matches across ranges: what a range has left over is, in sweep order, pieces that fit no gap of
   it and then gaps; from the number, extreme sizes and token sum of both a range, the driver pairs
   each range's pieces with the nearest larger range that has gaps left (a bracket match
   over as many rows as there are tasks) and gives new sequences to pieces beyond all gaps;
4. resolves who gets which gap by rank in a join, updates the gaps, and repeats while pieces are left.

Every round is two written tables under the shared checkpoint folder, so nothing is
recomputed and a lost executor costs its tasks.  No group is collected: a task holds one
range of (id, size) rows.  A sequence has at most ``capacity`` pieces, which bounds the
final window that turns the order of placement into offsets.

Pieces over the capacity are cut before; full ones are sequences of their own.  Defined results: a
null or empty text is the end id alone; repeated rows are packed as often as they occur;
an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerfold.llm.token_files import scratch, vocabulary, with_end
from ledgerfold.llm.word_ids import lean, texts_of, word_ids

CAPACITY, END = 2048, 0
PIECES = "uid long, doc_id long, piece int, start long, length long, ids_crc32 long"
#: kind 0: an open sequence and its gap; 1: an unplaced piece; 2: a piece placed in ``seq`` as its ``ord``-th of the step.
ROWS = "kind int, id long, size int, seq long, ord int, part int, rank long"
GAP, PIECE, PLACED = 0, 1, 2
#: Share of the new sequences needed at least that one round opens.
OPEN_SHARE = 0.5


def _cutter(path: str, capacity: int, end: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        uid = TaskContext.get().partitionId() << 40
        for batch in batches:
            at = 0
            for texts in texts_of(batch.column(1)):
                docs = batch.column(0).slice(at, len(texts))
                at += len(texts)
                ids, counts = with_end(*word_ids(path).encode(texts), end)
                n = -(-counts // capacity)
                doc = np.repeat(np.arange(len(counts)), n)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
                start = piece * capacity
                length = np.minimum(counts[doc] - start, capacity)
                ends = np.cumsum(length)
                raw = memoryview(np.ascontiguousarray(ids, "<u4").tobytes())
                crc = [zlib.crc32(raw[4 * (e - x):4 * e]) for e, x in zip(ends.tolist(), length.tolist())]
                yield pa.RecordBatch.from_arrays([
                    pa.array(uid + np.arange(len(doc))), docs.take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start),
                    pa.array(length), pa.array(crc, pa.int64())], names=["uid", "doc_id", "piece", "start", "length", "ids_crc32"])
                uid += len(doc)

    return rows


def cut_pieces(docs: DataFrame, vocab: str | None = None, capacity: int = CAPACITY, end: int = END, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each piece of at most ``capacity`` ids; ``uid`` numbers the rows of one run."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return d.mapInArrow(_cutter(vocab or vocabulary(), capacity, end), PIECES)


@lean
def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Best fit inside one range; its rows come largest first, gaps before pieces of equal size."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    stack: list[tuple[int, int]] = []  # (gap, sequence), smallest on top
    later: list[tuple[int, int]] = []  # what placed pieces left of their gaps, as (-gap, sequence)
    left, placed, filled = [], [], {}
    least = None
    for batch in batches:
        for kind, id_, size in zip(*(batch.column(i).to_pylist() for i in range(3))):
            least = size
            while later and -later[0][0] >= size:
                gap, seq = heapq.heappop(later)
                stack.append((-gap, seq))
            if kind == GAP:
                stack.append((size, id_))
            elif not stack:
                left.append((id_, size))
            else:
                gap, seq = stack.pop()
                filled[seq] = n = filled.get(seq, -1) + 1
                placed.append((id_, size, seq, n))
                if gap > size:
                    heapq.heappush(later, (size - gap, seq))
    if least is None:
        return
    rows = [(PLACED, u, s, q, n, part, -1) for u, s, q, n in placed]
    rows += [(PIECE, u, s, -1, 0, part, r) for r, (u, s) in enumerate(left)]
    rows += [(GAP, q, s, q, 0, part, r) for r, (s, q) in enumerate(reversed(stack))]  # smallest first
    rows += [(GAP, q, -g, q, 0, part, -1) for g, q in later]  # smaller than the range: for the next round
    columns = list(zip(*rows))
    for at in range(0, len(rows), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(c[at:at + 100_000], t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64()))],
                                         names=["kind", "id", "size", "seq", "ord", "part", "rank"])


def match_ranges(ranges: list[dict], capacity: int) -> tuple[list[tuple], int]:
    """Pair left-over pieces with gaps of larger ranges, from one row a range.

    ranges: largest sizes first, each with pieces, longest, tokens, gaps, least_gap.
    Returns rows (part, first, last, gap_part, gap_first, per_gap): the pieces of rank
    first..last-1 take the gaps from gap_first on, per_gap each; gap_part -1 is new
    sequences; and the number of new sequences.
    """
    plan, stack, beyond = [], [], []
    for r in ranges:
        at = 0
        while at < r["pieces"] and stack:
            top = stack[-1]
            per = max(1, top["least"] // r["longest"])
            n = min(r["pieces"] - at, (top["to"] - top["from"]) * per)
            plan.append((r["part"], at, at + n, top["part"], top["from"], per))
            at, top["from"] = at + n, top["from"] + -(-n // per)
            if top["from"] == top["to"]:
                stack.pop()
        if at < r["pieces"]:
            beyond.append((r, at))
        if r["gaps"]:
            stack.append({"part": r["part"], "from": 0, "to": r["gaps"], "least": r["least_gap"]})
    # the pieces beyond all gaps fill so many new sequences at least; a share of them is opened
    # for the largest, so that the next sweep can fit the others to what those leave
    tokens = sum(-(-r["tokens"] * (r["pieces"] - at) // r["pieces"]) for r, at in beyond)
    least = -(-tokens // capacity)
    new = least if least <= len(ranges) else math.ceil(least * OPEN_SHARE)
    used, room = 0, 0  # sequences begun, and what the last of them surely has left
    for r, at in beyond:
        if room >= r["longest"]:
            n = min(r["pieces"] - at, room // r["longest"])
            plan.append((r["part"], at, at + n, -1, used - 1, n))
            at, room = at + n, room - n * r["longest"]
        per = max(1, capacity // r["longest"])
        n = min(r["pieces"] - at, (new - used) * per)
        if n > 0:
            plan.append((r["part"], at, at + n, -1, used, per))
            used += -(-n // per)
            room = capacity - ((n - 1) % per + 1) * r["longest"]
    return plan, used


def place(spark: SparkSession, sizes: DataFrame, capacity: int = CAPACITY, folder: str | None = None) -> DataFrame:
    """Pack rows (uid, length <= capacity) and return (uid, sequence_id, offset)."""
    folder = folder or scratch(spark, "packing")
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    whole = sizes.filter(F.col("length") == capacity).select("uid", F.col("uid").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    # no two pieces over half the capacity share a sequence: each opens one
    part = sizes.filter(F.col("length") < capacity).withColumn("big", 2 * F.col("length") > capacity)
    state = part.select(F.when(F.col("big"), GAP).otherwise(PIECE).alias("kind"), F.col("uid").alias("id"),
                        F.when(F.col("big"), capacity - F.col("length")).otherwise(F.col("length")).cast("int").alias("size"))
    placed = part.filter("big").select(F.col("uid").alias("id"), F.col("length").cast("int").alias("size"), F.col("uid").alias("seq"), F.lit(0).alias("ord"), F.lit(-1).alias("step"))
    tables: list[tuple[int, str]] = []
    step = 0
    while True:
        order = [F.col("size").desc(), F.col("kind"), F.col("id")]
        swept = f"{folder}/sweep-{step}"
        (state.select("kind", "id", "size").repartitionByRange(parts, F.col("size").desc(), F.col("kind"), F.xxhash64("id"))
         .sortWithinPartitions(*order).mapInArrow(_sweep, ROWS).write.parquet(swept))
        rows = spark.read.schema(ROWS).parquet(swept)
        tables.append((2 * step, swept))
        ranges = [r.asDict() for r in rows.filter("rank >= 0").groupBy("part").agg(
            F.count(F.when(F.col("kind") == PIECE, 1)).alias("pieces"), F.max(F.when(F.col("kind") == PIECE, F.col("size"))).alias("longest"),
            F.sum(F.when(F.col("kind") == PIECE, F.col("size")).otherwise(0)).alias("tokens"),
            F.count(F.when(F.col("kind") == GAP, 1)).alias("gaps"), F.min(F.when(F.col("kind") == GAP, F.col("size"))).alias("least_gap")).collect()]
        if not any(r["pieces"] for r in ranges):
            break
        plan, new = match_ranges(sorted(ranges, key=lambda r: r["part"]), capacity)
        resolved = f"{folder}/resolve-{step}"
        _resolve(spark, rows, plan, new, step, capacity).write.parquet(resolved)
        tables.append((2 * step + 1, resolved))
        state = spark.read.schema(ROWS).parquet(resolved).filter(F.col("kind") != PLACED)
        step += 1
    for at, path in tables:
        t = spark.read.schema(ROWS).parquet(path).filter(F.col("kind") == PLACED)
        placed = placed.unionByName(t.select("id", "size", "seq", "ord", F.lit(at).alias("step")))
    before = Window.partitionBy("seq").orderBy("step", "ord", "id").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.select(F.col("id").alias("uid"), F.col("seq").alias("sequence_id"), F.coalesce(F.sum("size").over(before), F.lit(0)).cast("long").alias("offset"))
    return offsets.unionByName(whole)


def _resolve(spark: SparkSession, rows: DataFrame, plan: list[tuple], new: int, step: int, capacity: int) -> DataFrame:
    """The next state and this step's placements across ranges. ``plan`` has at most two rows a range."""
    p = spark.createDataFrame(plan, "part int, first long, last long, gap_part int, gap_first long, per long")
    pieces = rows.filter((F.col("kind") == PIECE)).select("id", "size", "part", "rank")
    # a piece falls in one interval of its range at most
    hit = pieces.join(F.broadcast(p), (pieces["part"] == p["part"]) & (pieces["rank"] >= p["first"]) & (pieces["rank"] < p["last"]), "left").select(
        "id", "size", "gap_part", (F.col("gap_first") + F.floor((F.col("rank") - F.col("first")) / F.col("per"))).alias("gap_rank"),
        ((F.col("rank") - F.col("first")) % F.col("per")).cast("int").alias("ord"))
    stay = hit.filter("gap_part IS NULL").select(F.lit(PIECE).alias("kind"), "id", "size", F.lit(-1).cast("long").alias("seq"), F.lit(0).alias("ord"))
    gaps = rows.filter(F.col("kind") == GAP).select(F.col("id").alias("seq"), F.col("size").alias("gap"), F.col("part").alias("gap_part"), F.col("rank").alias("gap_rank"))
    first_new = -((step + 1) << 40)  # below zero, where no uid is
    fresh = spark.range(new).select((F.lit(first_new) + F.col("id")).alias("seq"), F.lit(capacity).alias("gap"), F.lit(-1).alias("gap_part"), F.col("id").alias("gap_rank"))
    placed = hit.filter("gap_part IS NOT NULL")
    # gaps that are not in the plan have rank -1 or no piece: they come out as they are
    joined = gaps.unionByName(fresh).join(placed, ["gap_part", "gap_rank"], "left").select("seq", "gap", "id", "size", "ord")
    put = joined.filter("id IS NOT NULL").select(F.lit(PLACED).alias("kind"), "id", "size", "seq", "ord")
    after = joined.groupBy("seq", "gap").agg(F.coalesce(F.sum("size"), F.lit(0)).alias("used")).select(
        F.lit(GAP).alias("kind"), F.col("seq").alias("id"), (F.col("gap") - F.col("used")).cast("int").alias("size"), "seq", F.lit(0).alias("ord")).filter("size > 0")
    return stay.unionByName(put).unionByName(after).withColumn("part", F.lit(-1)).withColumn("rank", F.lit(-1).cast("long"))


def pack(spark: SparkSession, docs: DataFrame, vocab: str | None = None, capacity: int = CAPACITY, end: int = END, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece."""
    folder = scratch(spark, "packing")
    cut_pieces(docs, vocab, capacity, end, id_col, text_col).write.parquet(f"{folder}/pieces")
    pieces = spark.read.schema(PIECES).parquet(f"{folder}/pieces")
    places = place(spark, pieces.select("uid", "length"), capacity, folder)
    return pieces.join(places, "uid").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
