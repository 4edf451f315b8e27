"""Token-id files: every text's ids in ascending document order, as frames of the context-mixing coder.

``write_token_files`` range-partitions the texts by document id, and each task encodes its
texts and writes frames of whole documents (about ``FRAME_IDS`` ids; a longer document is
one frame) as rows of a Parquet table: Spark's committer makes the write safe against
lost executors.  ``read_token_files`` checks and decodes frames where they lie and gives
one row a document, with the ids, without a shuffle.

Defined results: a null or empty text is the end id alone; a null doc_id comes first;
repeated rows and ids are kept, rows of equal id in the order of their text's hash.  An empty table gives an
empty file set.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerfold.llm import mixing_coder
from ledgerfold.llm.word_ids import texts_of, word_ids
from ledgerfold.session import ensure_checkpoint_dir

END, FRAME_IDS = 2, 4_000_000
FRAMES = "shard int, frame int, ids_before long, n_ids long, doc_ids array<long>, counts array<int>, payload binary"


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def with_end(ids: np.ndarray, counts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """``end`` after each text's ids, and the counts with it."""
    out = np.insert(ids, np.cumsum(counts), end) if len(counts) else ids
    return out, counts + 1


def _framer(path: str, end: int, frame_ids: int):
    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, frame, before = TaskContext.get().partitionId(), 0, 0
        held: list[tuple[list, np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            nonlocal frame, before, held
            docs = [d for x in held for d in x[0]]
            counts = np.concatenate([x[1] for x in held])
            ids = np.concatenate([x[2] for x in held])
            row = pa.RecordBatch.from_arrays([
                pa.array([shard], pa.int32()), pa.array([frame], pa.int32()), pa.array([before], pa.int64()), pa.array([len(ids)], pa.int64()),
                pa.array([docs], pa.list_(pa.int64())), pa.array([counts.tolist()], pa.list_(pa.int32())), pa.array([mixing_coder.encode(ids)], pa.binary())],
                names=["shard", "frame", "ids_before", "n_ids", "doc_ids", "counts", "payload"])
            frame, before, held = frame + 1, before + len(ids), []
            return row

        for batch in batches:
            at = 0
            for texts in texts_of(batch.column(1)):
                ids, counts = with_end(*word_ids(path).encode(texts), end)
                held.append((batch.column(0).slice(at, len(texts)).to_pylist(), counts, ids))
                at += len(texts)
                if sum(len(x[2]) for x in held) >= frame_ids:
                    yield flush()
        if held:
            yield flush()

    return frames


def write_token_files(docs: DataFrame, path: str, vocab: str | None = None, end: int = END, id_col: str = "doc_id", text_col: str = "text", frame_ids: int = FRAME_IDS) -> str:
    """Write the files under ``path`` (a folder that all executors share) and return it."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # rows of equal id and text are parted by their place in the input, so that no group of repeats is one task's
    order = ["doc_id", "hash", "row"]
    d = d.select("doc_id", "text", F.xxhash64("text").alias("hash"), F.monotonically_increasing_id().alias("row"))
    d = d.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    d.mapInArrow(_framer(vocab or vocabulary(), end, frame_ids), FRAMES).write.option("compression", "none").parquet(path)
    return path


def read_frames(spark: SparkSession, path: str) -> DataFrame:
    """The files' frames, with ``start``: ids of all frames before them."""
    from pyspark.sql import Window

    frames = spark.read.schema(FRAMES).parquet(path)
    # a row a shard: as many as the write had tasks
    shards = frames.groupBy("shard").agg(F.sum("n_ids").alias("n")).select(
        "shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("shard_start"))
    return frames.join(F.broadcast(shards), "shard").withColumn("start", F.col("shard_start") + F.col("ids_before"))


def _each_document(batch: pa.RecordBatch):
    """(doc_ids, counts, start, ids) of each frame of a batch."""
    doc_ids, counts, payload, start = (batch.column(i) for i in range(4))
    for k in range(batch.num_rows):
        ids = mixing_coder.decode(payload[k].as_py())
        n = counts[k].values.to_numpy().astype(np.int64)
        if int(n.sum()) != len(ids):
            raise ValueError("a frame's documents don't add up to its ids")
        yield doc_ids[k].values, n, start[k].as_py(), ids


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for docs, n, start, ids in _each_document(batch):
            ends = np.cumsum(n)
            raw = memoryview(np.ascontiguousarray(ids, "<u4").tobytes())
            crc = [zlib.crc32(raw[4 * (e - c):4 * e]) for e, c in zip(ends.tolist(), n.tolist())]
            yield pa.RecordBatch.from_arrays([docs, pa.array(start + ends - n), pa.array(n), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def _ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for docs, n, start, ids in _each_document(batch):
            offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([docs, pa.array(start + offsets[:-1].astype(np.int64)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32)))], names=["doc_id", "start", "ids"])


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start and ids of every document of the files."""
    return read_frames(spark, path).select("doc_ids", "counts", "payload", "start").mapInArrow(_ids, "doc_id long, start long, ids array<int>")


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the decoded files."""
    return read_frames(spark, path).select("doc_ids", "counts", "payload", "start").mapInArrow(_digests, "doc_id long, start long, n_tokens long, ids_crc32 long")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the session's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
