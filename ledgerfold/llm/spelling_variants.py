"""Spelling variants: each word's near words (one edit apart), its form and the root of its chain of forms.

1. Words are counted in one pass over the whole texts; a task holds ``HELD`` different words and
   then passes their counts on, and Spark sums them.
2. A word becomes the vector of its letter counts.  Letters are dealt into a few groups of equal
   weight, and the counts a group make the word's block, so a block holds words of one length.  An
   edit moves one letter at most out of and into a group: near words lie in one block, in two blocks
   of one length that differ by one letter, or in a block and one of the next length with a letter
   more.  The number of groups grows with the vocabulary, results don't depend on it.
3. A block is cut into parts of about ``PART`` words.  Every part meets the parts of its
   partner blocks in its own group of rows, streamed: NumPy products of the count matrices give all squared
   distances, pairs at 1 (lengths differ) or 2 (same length) are kept and their edits verified on the code
   points.  A group gives a row a word (number of near words, best of them), never pair rows.
4. A form is a near word at least ``RATIO`` times as frequent, so chains are short; roots follow by
   doubling joins on the words that have a form.

Defined results: a null or empty text has no words; a null doc_id counts as the empty string before the colon;
repeated rows count as often as they occur; ties between forms go to the first in code-point order;
an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerfold.llm.token_files import scratch

#: Fixed values of the task: least length and occurrences of a word, one damaged run in so many, a form's least ratio.
LEAST, OCCURRENCES, DAMAGED, RATIO = 7, 2, 31, 10
#: Different words a task holds; words and code points of a part; words that a part meets at a time.
HELD, PART, PART_CHARS, MEET = 300_000, 1_000, 50_000, 4_000
#: The alphabet after lower-casing A to Z: its size bounds every table of letters.
LETTERS = [*range(0x61, 0x7B), *range(0xC0, 0x100)]
COLUMN = np.zeros(0x100, np.int64)
COLUMN[LETTERS] = np.arange(len(LETTERS))
#: Numbers of a count matrix below this are exact in single precision.
EXACT = 1 << 23
COUNTED = "word string, n long"
NEAR = "word string, n_near long, form_n long, form string"


def damaged(doc_id: str, run: str, start: int | None = None) -> str:
    """The run as it counts: one code point less if the checksum of ``doc_id:run`` says so (``start``: that of ``doc_id:``)."""
    h = zlib.crc32(run.encode(), zlib.crc32(f"{doc_id}:".encode()) if start is None else start)
    if h % DAMAGED:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def _counter(least: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = re.compile(f"[a-zÀ-ÿ]{{{least},}}")  # shorter maximal runs give no word
        held: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = text.as_py()
                if raw is None:
                    continue
                start = zlib.crc32(f"{doc}:".encode())
                for run, n in Counter(runs.findall(raw.lower().decode())).items():  # bytes: lower-cases A to Z alone
                    word = damaged(doc, run, start)
                    if len(word) >= least:
                        held[word] += n
                if len(held) >= HELD:
                    yield flush()
        if held:
            yield flush()

    return rows


def count_words(docs: DataFrame, least: int = LEAST, occurrences: int = OCCURRENCES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word and n: runs of letters as they count, with their occurrences in all texts."""
    d = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return d.mapInArrow(_counter(least), COUNTED).groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= occurrences)


def _codes(words: str, n: int) -> np.ndarray:
    """Code points of ``n`` words of equal length, written one after another."""
    return np.frombuffer(words.encode("utf-32-le"), np.uint32).reshape(n, -1)


def letter_counts(codes: np.ndarray) -> np.ndarray:
    """The count matrix [words, letters]."""
    n, d = len(codes), len(LETTERS)
    at = COLUMN[codes] + np.arange(n)[:, None] * d
    return np.bincount(at.ravel(), minlength=n * d).reshape(n, d)


def _letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, words = np.zeros(len(LETTERS), np.int64), 0
    for batch in batches:
        for word in batch.column(0).to_pylist():
            total += np.bincount(COLUMN[_codes(word, 1)[0]], minlength=len(LETTERS))
        words += batch.num_rows
    yield pa.RecordBatch.from_arrays([pa.array([-1, *range(len(LETTERS))], pa.int32()), pa.array([words, *total.tolist()], pa.int64())], names=["letter", "n"])


def deal_letters(weights: list[int], groups: int) -> list[int]:
    """A group for each letter: the heaviest letters first, each to the lightest group."""
    load, of = [0] * groups, [0] * len(weights)
    for i in sorted(range(len(weights)), key=lambda i: (-weights[i], i)):
        g = min(range(groups), key=lambda g: (load[g], g))
        of[i], load[g] = g, load[g] + weights[i]
    return of


def choose_groups(words: int) -> int:
    """Letter groups for a vocabulary: each further one makes blocks about four times smaller."""
    groups = 3
    while words > 20_000 and groups < 12:
        words, groups = words // 4, groups + 1
    return groups


def _blocker(of: list[int], groups: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = np.array(of)
        for batch in batches:
            words = batch.column(0).to_pylist()
            lengths = np.array([len(w) for w in words], np.int64)
            codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
            row = np.repeat(np.arange(len(words)), lengths)
            counts = np.bincount(row * groups + group[COLUMN[codes]], minlength=len(words) * groups).reshape(-1, groups)
            yield pa.RecordBatch.from_arrays([pa.array([",".join(map(str, c)) for c in counts.tolist()], pa.string()), batch.column(0), batch.column(1)], names=["block", "word", "n"])

    return rows


def partners(block: str) -> list[str]:
    """Blocks whose words can be near the block's own: itself, then each other pair of blocks from one of its two sides."""
    c = [int(x) for x in block.split(",")]
    out = [block]
    for i in range(len(c)):
        out.append(",".join(str(x + (k == i)) for k, x in enumerate(c)))
        out += [",".join(str(x + (k == i) - (k == j)) for k, x in enumerate(c)) for j in range(i + 1, len(c)) if c[j]]
    return out


def _partners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = [partners(b) for b in batch.column(0).to_pylist()]
        at = pa.array(np.repeat(np.arange(len(lists)), [len(x) for x in lists]))
        yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array([x for y in lists for x in y], pa.string())], names=["block", "parts", "partner"])


def near_pairs(a: np.ndarray, b: np.ndarray, within: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Rows i of ``a`` and j of ``b`` whose words are one edit apart; words of ``b`` are as long or one longer.

    a, b: code points [words, length].  ``within``: a and b are the same rows, each pair counts once.
    """
    x, y = letter_counts(a), letter_counts(b)
    kind = np.float32 if max(a.shape[1], b.shape[1]) ** 2 < EXACT else np.float64
    x, y = x.astype(kind), y.astype(kind)
    far = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T)
    i, j = np.nonzero((far > 0) & (far <= 2))
    if within:
        i, j = i[i < j], j[i < j]
    m = a.shape[1]
    keep = np.zeros(len(i), bool)
    step = max(1, 4_000_000 // m)
    for at in range(0, len(i), step):
        p, q = a[i[at:at + step]], b[j[at:at + step]]
        if b.shape[1] == m:
            keep[at:at + step] = (p != q).sum(1) == 1
        else:  # the longer word less one code point: equal beginnings and ends cover the shorter
            head = np.logical_and.accumulate(p == q[:, :m], axis=1).sum(1)
            tail = np.logical_and.accumulate((p == q[:, 1:])[:, ::-1], axis=1).sum(1)
            keep[at:at + step] = head + tail >= m
    return i[keep], j[keep]


class _Tally:
    """Near words found of a part's words: their number and the best (most frequent, then first in code-point order)."""

    def __init__(self) -> None:
        self.found: dict[str, list] = {}

    def add(self, word: str, n: int, form: str) -> None:
        held = self.found.get(word)
        if held is None:
            self.found[word] = [1, n, form]
        else:
            held[0] += 1
            if n > held[1] or n == held[1] and form < held[2]:
                held[1], held[2] = n, form

    def rows(self) -> pa.RecordBatch:
        found, self.found = self.found, {}
        columns = zip(*found.values()) if found else ([], [], [])
        n_near, form_n, form = (list(c) for c in columns)
        return pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(n_near, pa.int64()), pa.array(form_n, pa.int64()), pa.array(form, pa.string())], names=["word", "n_near", "form_n", "form"])


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (block, part, tag, words, counts), sorted: a part (tag 0), then the parts that it meets (1: itself, 2: others)."""
    tally = _Tally()
    own = key = None
    waiting: dict[int, list] = {}  # by length: parts to be met

    def words_of(codes: np.ndarray) -> list[str]:
        m, text = codes.shape[1], codes.astype("<u4").tobytes().decode("utf-32-le")
        return [text[at:at + m] for at in range(0, len(text), m)]

    def meet(parts: list, within: bool = False) -> None:
        codes, n = (np.concatenate(c) for c in zip(*parts))
        i, j = near_pairs(own[0], codes, within)
        if len(i):
            left, right = words_of(own[0]), words_of(codes)
            for p, q in zip(i.tolist(), j.tolist()):
                tally.add(left[p], int(n[q]), right[q])
                tally.add(right[q], int(own[1][p]), left[p])

    def settle(least: int) -> None:
        for m in [m for m, parts in waiting.items() if sum(len(p[1]) for p in parts) >= least]:
            meet(waiting.pop(m))

    for batch in batches:
        for k in range(batch.num_rows):
            at, tag = (batch.column(0)[k].as_py(), batch.column(1)[k].as_py()), batch.column(2)[k].as_py()
            n = batch.column(4)[k].values.to_numpy()
            part = _codes(batch.column(3)[k].as_py(), len(n)), n
            if at != key:
                settle(1)
                if len(tally.found) >= 10 * PART:
                    yield tally.rows()
                key, own = at, None
            if tag == 0:
                own = part
            elif own is None:
                continue  # no word was dealt to this part of the block
            elif tag == 1:
                meet([part], within=True)
            else:
                waiting.setdefault(part[0].shape[1], []).append(part)
                settle(MEET)
                if len(tally.found) >= 50 * PART:
                    yield tally.rows()
    settle(1)
    yield tally.rows()


def near_words(spark: SparkSession, words: DataFrame, groups: int | None = None, part: int = PART) -> DataFrame:
    """A row for each word of ``words`` (word, n) with near words, in parts: n_near to be summed, form the best of the part."""
    # as many rows as the alphabet has letters
    weights = {r.letter: r.n for r in words.select("word").mapInArrow(_letters, "letter int, n long").groupBy("letter").agg(F.sum("n").alias("n")).collect()}
    total = weights.pop(-1, 0)
    groups = groups or choose_groups(total)
    of = deal_letters([weights.get(i, 0) for i in range(len(LETTERS))], groups)
    blocks = words.select("word", "n").mapInArrow(_blocker(of, groups), "block string, word string, n long")
    sizes = blocks.groupBy("block").agg(F.greatest(F.ceil(F.count("*") / part), F.ceil(F.sum(F.length("word")) / PART_CHARS)).cast("int").alias("parts"))
    parts = (blocks.join(sizes, "block").withColumn("part", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
             .groupBy("block", "part").agg(F.collect_list(F.struct("word", "n")).alias("held"))
             .select("block", "part", F.array_join(F.col("held.word"), "").alias("words"), F.col("held.n").alias("counts")))
    folder = scratch(spark, "spelling")
    parts.write.parquet(f"{folder}/parts")
    parts = spark.read.schema("block string, part int, words string, counts array<long>").parquet(f"{folder}/parts")
    sizes = parts.groupBy("block").agg((F.max("part") + 1).alias("parts"))
    wanted = sizes.mapInArrow(_partners, "block string, parts int, partner string")
    met = wanted.join(sizes.select(F.col("block").alias("partner"), F.col("parts").alias("others")), "partner")
    # a part meets itself once, the later parts of its own block, and all parts of partner blocks
    same = F.col("block") == F.col("partner")
    met = met.withColumn("own", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    met = met.withColumn("other", F.explode(F.sequence(F.when(same, F.col("own")).otherwise(0), F.col("others") - 1)))
    met = met.join(parts.select(F.col("block").alias("partner"), F.col("part").alias("other"), "words", "counts"), ["partner", "other"])
    met = met.select("block", F.col("own").alias("part"), F.when(same & (F.col("own") == F.col("other")), 1).otherwise(2).alias("tag"), "words", "counts")
    rows = met.unionByName(parts.withColumn("tag", F.lit(0))).select("block", "part", "tag", "words", "counts")
    return rows.repartition("block", "part").sortWithinPartitions("block", "part", "tag").mapInArrow(_meet, NEAR)


def follow_forms(spark: SparkSession, links: DataFrame, folder: str) -> DataFrame:
    """word and root from rows (word, form): each step doubles how far a row has followed its chain."""
    links.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")).write.parquet(f"{folder}/roots-0")
    step = 0
    while True:
        held = spark.read.schema("word string, root string, moved boolean").parquet(f"{folder}/roots-{step}")
        if held.filter("moved").isEmpty():
            return held.drop("moved")
        on = held.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step += 1
        held.drop("moved").join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")).write.parquet(f"{folder}/roots-{step}")


def spelling_variants(spark: SparkSession, docs: DataFrame, least: int = LEAST, occurrences: int = OCCURRENCES, ratio: int = RATIO,
                      groups: int | None = None, part: int = PART, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, form, root, n, n_near and form_n of every word."""
    folder = scratch(spark, "spelling")
    count_words(docs, least, occurrences, id_col, text_col).write.parquet(f"{folder}/words")
    words = spark.read.schema(COUNTED).parquet(f"{folder}/words")
    none = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("struct<less:long,form:string>").alias("best"))
    found = near_words(spark, words, groups, part).select("word", F.lit(None).cast("long").alias("n"), "n_near", F.struct((-F.col("form_n")).alias("less"), "form").alias("best"))
    found = none.unionByName(found).groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    holds = -F.col("best.less") >= ratio * F.col("n")
    found = found.select("word", F.when(holds, F.col("best.form")).alias("form"), "n", "n_near", F.when(holds, -F.col("best.less")).alias("form_n"))
    found.write.parquet(f"{folder}/variants")
    found = spark.read.schema("word string, form string, n long, n_near long, form_n long").parquet(f"{folder}/variants")
    roots = follow_forms(spark, found.filter("form IS NOT NULL").select("word", "form"), folder)
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
