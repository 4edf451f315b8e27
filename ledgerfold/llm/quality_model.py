"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader.

Words are runs of letters or digits and runs of other signs, as they are written; their one- and
two-grams are hashed into ``DIM`` weights.  A word that repeats the one before it, or the one before that, also
counts as the two-gram "same again" whatever the word.  A feature's value is its share of the text's n-grams
times ``SCALE``, so a score is one sparse dot product, the mean weight of the text's n-grams.

Training takes a bounded sample: at most ``SAMPLE`` labelled texts, those of least hash,
whose n-grams are made on the executors; the proximal FTRL updates run over it in a fixed order.

Defined results: a null or empty text scores the bias alone; a null label isn't learned
from; of several labels of a doc_id the least counts, of several texts that of the least hash; with no label every score is 0.5.  Repeated rows give
repeated rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfold.llm.word_ids import texts_of

BITS, SAMPLE, SCALE, SLICE = 18, 6000, 20.0, 4_000_000
DIM = 1 << BITS
#: Features of "same again" at distance one and two.
SAME = (DIM - 1, DIM - 2)
THRESHOLD = 0.7
SCORES = "doc_id long, score double"


def ngrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(feature numbers of all texts' one- and two-grams, their number per text)."""
    from pandas.util import hash_array

    split = pc.ascii_split_whitespace(pc.replace_substring_regex(texts, r"([^\p{L}\p{N}\s]+)", r" \1 "))
    words, offsets = split.flatten(), split.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    coded = words.dictionary_encode()
    table = hash_array(coded.dictionary.to_numpy(zero_copy_only=False).astype(object), categorize=False) if len(words) else np.zeros(0, np.uint64)
    real = (pc.not_equal(coded.dictionary, "").to_numpy(zero_copy_only=False) if len(words) else np.zeros(0, bool))
    codes = coded.indices.to_numpy(zero_copy_only=False) if len(words) else np.zeros(0, np.int64)
    keep = real[codes]
    offsets = np.concatenate([[0], np.cumsum(keep)])[offsets]
    h = table[codes[keep]]
    n = np.diff(offsets)
    doc = np.repeat(np.arange(len(n)), n)
    shift = np.uint64(64 - BITS)
    one = (h * np.uint64(0x9E3779B97F4A7C15)) >> shift
    pair = doc[1:] == doc[:-1]
    two = (((h[:-1] * np.uint64(0xC2B2AE3D27D4EB4F)) ^ h[1:]) * np.uint64(0x9E3779B97F4A7C15) >> shift)[pair]
    again = [doc[k:][(h[k:] == h[:-k]) & (doc[k:] == doc[:-k])] for k in (1, 2)]
    # text by text: its words, its pairs, its repetitions
    at = np.concatenate([doc, doc[1:][pair], *again])
    found = np.concatenate([one.astype(np.int64), two.astype(np.int64), *(np.full(len(a), SAME[k]) for k, a in enumerate(again))])
    return found[np.argsort(at, kind="stable")], np.bincount(at, minlength=len(n))


def train_ftrl(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, alpha: float = 0.2, beta: float = 1.0, l1: float = 0.01, l2: float = 0.01, epochs: int = 4, seed: int = 9) -> tuple[np.ndarray, float]:
    """Weights and bias from sparse rows (features, values) and labels 0 or 1, by proximal FTRL."""
    z, n = np.zeros(DIM + 1), np.zeros(DIM + 1)

    def weights(at: np.ndarray) -> np.ndarray:
        small = np.abs(z[at]) <= l1
        return np.where(small, 0.0, -(z[at] - np.sign(z[at]) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2))

    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)).tolist():
            at, value = np.append(rows[i][0], DIM), np.append(rows[i][1], 1.0)
            w = weights(at)
            p = 1 / (1 + np.exp(-np.clip(w @ value, -35, 35)))
            g = (p - y[i]) * value
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - step * w
            n[at] += g * g
    w = weights(np.arange(DIM + 1))
    return w[:DIM], float(w[DIM])


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = 0
        for texts in texts_of(batch.column(1), SLICE):
            found, n = ngrams(texts)
            rows = [np.unique(part, return_counts=True) for part in np.split(found, np.cumsum(n)[:-1])]
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(at, len(texts)), pa.array([a.astype("<i4").tobytes() for a, _ in rows], pa.binary()),
                pa.array([(SCALE * c / max(1, c.sum())).astype("<f4").tobytes() for _, c in rows], pa.binary())], names=["y", "at", "value"])
            at += len(texts)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> tuple[np.ndarray, float]:
    """Train on at most ``sample`` labelled documents, one text each (that of the least hash, where a doc_id
    repeats).  The chosen labels are so few that they are broadcast."""
    one = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.min(label_col).cast("int").alias("y"))
    chosen = one.orderBy(F.xxhash64("_id"), "_id").limit(sample)
    texts = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("text"))
    # repeats of a chosen id are combined before the shuffle
    rows = texts.join(F.broadcast(chosen), F.col("_doc") == F.col("_id")).groupBy("_id").agg(
        F.min("y").alias("y"), F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t")).select("y", "t.text")
    got = rows.mapInArrow(_sparse, "y int, at binary, value binary").toArrow().sort_by([(c, "ascending") for c in ("y", "at", "value")])
    if not len(got):
        return np.zeros(DIM), 0.0
    return train_ftrl([(np.frombuffer(a.as_buffer(), "<i4"), np.frombuffer(v.as_buffer(), "<f4")) for a, v in zip(got["at"], got["value"])], got["y"].to_numpy())


def _scorer(weights: np.ndarray, bias: float) -> Callable:
    weights = weights.astype(np.float32)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in texts_of(batch.column(1), SLICE):
                found, n = ngrams(texts)
                total = np.concatenate([[0.0], np.cumsum(weights[found], dtype=np.float64)])
                ends = np.cumsum(n)
                dot = SCALE * (total[ends] - total[ends - n]) / np.maximum(n, 1) + bias
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), pa.array(1 / (1 + np.exp(-np.clip(dot, -35, 35))))], names=["doc_id", "score"])
                at += len(texts)

    return rows


def score(docs: DataFrame, model: tuple[np.ndarray, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score of every row; the model (1 MB) travels with the tasks."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(_scorer(*model), SCORES)
