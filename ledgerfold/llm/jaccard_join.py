"""N-gram Jaccard self-join by MinHash banding: who is linked to whom at ``threshold``.

1. One pass over the texts hashes word 5-grams, and gives each text a fingerprint of its
   n-gram *set* and ``bands`` keys of ``rows`` MinHash values (``choose_bands`` takes the most rows
   that still reach the target recall at the threshold).
2. Texts of equal sets are one class (map-side combined, so copies cost a row a task).
3. Classes meet in buckets, a bucket a band key.  Buckets of one class vanish, and of
   buckets with the same members (a close pair shares most of its bands) one stays; both by
   aggregates that hold counts and hashes, never members.
4. The full n-gram sets of the classes in the buckets that stay are compared.  A bucket is cut into
   blocks of about ``BLOCK`` n-grams, and every pair of its blocks is a unit of work, so
   a hot bucket spreads over many tasks.  A unit gives a row a class: its number of
   links, and the least class it is linked to inside the unit.  Links themselves are never rows.  A pair that
   shares several buckets counts in the first.
5. Those spanning edges are joined to groups by alternating large and small stars.

Defined results: words are runs without ASCII white space, taken as they are; a text of one
to four words has one n-gram, its words; a text without words (or null) is in no link.
Repeated rows are copies of each other; a repeated doc_id stands for as many documents.
Extra columns are not read.  An empty table gives no rows.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerfold.llm import word_ids
from ledgerfold.llm.token_files import scratch

N, THRESHOLD, RECALL, HASHES = 5, 0.8, 0.9999, 224
#: N-grams of a block, and bytes of text that are hashed at a time.
BLOCK, SLICE = 120_000, 1_000_000
SIGNATURES = "doc_id long, key1 long, key2 long, cid binary, n_grams long, bands array<long>"
SETS = "cid binary, copies long, n_grams long, keys array<long>, own array<struct<key:long,blocks:int>>, grams binary"
UNITS = "cid binary, links long, least binary"


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, hashes: int = HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows for which a pair at the threshold meets in some band with the recall."""
    for rows in range(hashes, 0, -1):
        bands = hashes // rows
        if 1 - (1 - threshold**rows) ** bands >= recall:
            return bands, rows
    return hashes, 1


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and shift)."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def grams(texts: pa.Array, n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram hashes of all texts, their number per text), repeats included."""
    from pandas.util import hash_array

    split = pc.ascii_split_whitespace(texts)
    words, offsets = split.flatten(), split.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    real = pc.not_equal(words, "").to_numpy(zero_copy_only=False) if len(words) else np.zeros(0, bool)
    if not real.all():  # white space at an end leaves an empty piece
        offsets = np.concatenate([[0], np.cumsum(real)])[offsets]
        words = words.filter(pa.array(real))
    coded = words.dictionary_encode()
    h = hash_array(coded.dictionary.to_numpy(zero_copy_only=False).astype(object), categorize=False) if len(words) else np.zeros(0, np.uint64)
    h = h[coded.indices.to_numpy(zero_copy_only=False)] if len(words) else h
    lengths = np.diff(offsets)
    counts = np.where(lengths >= n, lengths - n + 1, np.minimum(lengths, 1))
    first = np.cumsum(counts) - counts
    at = np.arange(int(counts.sum())) + np.repeat(offsets[:-1] - first, counts)
    size = np.repeat(np.minimum(lengths, n), counts)  # words of the n-gram
    out = np.repeat(np.minimum(lengths, n).astype(np.uint64), counts)
    padded = np.concatenate([h, np.zeros(n, np.uint64)])
    for k in range(n):
        step = out * np.uint64(0x9E3779B97F4A7C15) + padded[at + k]
        out = np.where(k < size, step, out)
    return _mix(out), counts


def unique_sets(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's hashes sorted and without repeats, and their numbers."""
    doc = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
    order = np.argsort(hashes)
    order = order[np.argsort(doc[order], kind="stable")]
    hashes, doc = hashes[order], doc[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    return hashes[new], np.bincount(doc[new], minlength=len(counts)).astype(np.int64)


def fingerprints(sets: np.ndarray, counts: np.ndarray) -> list[bytes | None]:
    """16 bytes for each set (None for an empty one), independent of order."""
    full = np.nonzero(counts)[0]
    out: list[bytes | None] = [None] * len(counts)
    if len(full):
        starts = (np.cumsum(counts) - counts)[full]
        sums = np.stack([np.add.reduceat(_mix(sets + np.uint64(seed)), starts) for seed in (0x1234567, 0xABCDEF01)], axis=1)
        for k, row in zip(full.tolist(), sums):
            out[k] = row.tobytes()
    return out


def band_keys(sets: np.ndarray, counts: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """int64 keys [texts with n-grams, bands]."""
    full = np.nonzero(counts)[0]
    starts = (np.cumsum(counts) - counts)[full]
    odd = np.random.default_rng(20).integers(1, 1 << 62, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    keys = np.empty((len(full), bands), np.uint64)
    work = np.empty_like(sets)
    for b in range(bands):
        key = np.full(len(full), b + 1, np.uint64)
        for r in range(rows):
            np.multiply(sets, odd[b * rows + r], out=work)
            low = np.minimum.reduceat(work, starts)
            key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + low)
        keys[:, b] = key
    return keys.view(np.int64)


def _signer(n: int, bands: int, rows: int):
    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in word_ids.texts_of(batch.column(3), SLICE):
                keys_of_row = [batch.column(i).slice(at, len(texts)) for i in range(3)]
                at += len(texts)
                sets, counts = unique_sets(*grams(texts, n))
                keys = band_keys(sets, counts, bands, rows) if len(sets) else np.zeros((0, bands), np.int64)
                offsets = np.concatenate([[0], np.cumsum(np.where(counts > 0, bands, 0))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    *keys_of_row, pa.array(fingerprints(sets, counts), pa.binary()), pa.array(counts), pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.reshape(-1)))],
                    names=["doc_id", "key1", "key2", "cid", "n_grams", "bands"])

    return signed


def _set_maker(n: int):
    """(cid, copies, keys, own, text) -> rows of SETS; a row whose text has another fingerprint is dropped."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in word_ids.texts_of(batch.column(4), SLICE):
                cid, copies, keys, own = (batch.column(i).slice(at, len(texts)) for i in range(4))
                at += len(texts)
                sets, counts = unique_sets(*grams(texts, n))
                ends = np.cumsum(counts)
                raw = [sets[e - c:e].tobytes() for e, c in zip(ends.tolist(), counts.tolist())]
                out = pa.RecordBatch.from_arrays([cid, copies, pa.array(counts), keys, own, pa.array(raw, pa.binary())], names=["cid", "copies", "n_grams", "keys", "own", "grams"])
                same = [a == b for a, b in zip(cid.to_pylist(), fingerprints(sets, counts))]
                yield out.filter(pa.array(same, pa.bool_()))

    return made


class _Side:
    """The classes of one block: sets, sizes, copies, all their band keys."""

    def __init__(self, rows: list[tuple]):
        self.cid = [r[0] for r in rows]
        self.copies = np.array([r[1] for r in rows], np.int64)
        self.sets = [np.frombuffer(r[2], np.uint64) for r in rows]
        self.size = np.array([len(s) for s in self.sets], np.int64)
        self.keys = np.array([r[3] for r in rows], np.int64)

    def index(self) -> tuple[np.ndarray, np.ndarray]:
        grams = np.concatenate(self.sets)
        doc = np.repeat(np.arange(len(self.sets)), self.size)
        order = np.argsort(grams, kind="stable")
        return grams[order], doc[order]


def _links(a: _Side, b: _Side, same: bool, key: int, share: Fraction) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of a and b with Jaccard >= share whose first common bucket is ``key``."""
    grams, doc = b.index()
    left, right = [], []
    for i, s in enumerate(a.sets):
        lo = np.searchsorted(grams, s, "left")
        n = np.searchsorted(grams, s, "right") - lo
        common = np.bincount(doc[word_ids.gather(np.arange(len(grams)), lo, n)], minlength=len(b.sets))
        # common / union >= p / q, in integers
        near = share.denominator * common >= share.numerator * (a.size[i] + b.size - common)
        j = np.nonzero(near)[0]
        j = j[j > i] if same else j
        if len(j):
            left.append(np.full(len(j), i))
            right.append(j)
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    i, j = np.concatenate(left), np.concatenate(right)
    # keys that are in no bucket that stays are null, read as 0
    both = (a.keys[i] == b.keys[j]) & (a.keys[i] != 0)
    mine = a.keys[i, both.argmax(axis=1)] == key
    return i[mine], j[mine]


def _unit(rows: list[tuple], key: int, bi: int, bj: int, share: Fraction) -> list[tuple[bytes, int, bytes]]:
    """A row for each class of the unit that has links: their number, and the least class reached."""
    a = _Side([r[:4] for r in rows if r[4] == bi])
    b = a if bi == bj else _Side([r[:4] for r in rows if r[4] == bj])
    if not a.cid or not b.cid:
        return []
    i, j = _links(a, b, bi == bj, key, share)
    if not len(i):
        return []
    shift = 0 if b is a else len(a.cid)
    cid = a.cid if b is a else a.cid + b.cid
    copies = a.copies if b is a else np.concatenate([a.copies, b.copies])
    j = j + shift
    links = np.bincount(i, copies[j], len(cid)) + np.bincount(j, copies[i], len(cid))
    rank = np.empty(len(cid), np.int64)
    rank[sorted(range(len(cid)), key=cid.__getitem__)] = np.arange(len(cid))
    low = rank.copy()  # least rank of the class's component, by repeated minimum over links
    while True:
        before = low.copy()
        np.minimum.at(low, i, low[j])
        np.minimum.at(low, j, low[i])
        if (before == low).all():
            break
    by_rank = np.argsort(rank)
    return [(cid[k], int(links[k]), cid[by_rank[low[k]]]) for k in np.nonzero(links)[0].tolist()]


def _verifier(share: Fraction):
    """Rows sorted by (key, bi, bj) -> rows of UNITS; holds one unit at a time."""

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, held, out = None, [], []

        def pages(force: bool) -> Iterator[pa.RecordBatch]:
            if out and (force or len(out) > 20_000):
                columns = list(zip(*out))
                out.clear()
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.binary())], names=["cid", "links", "least"])

        for batch in batches:
            key, bi, bj, block, cid, copies, grams_, keys = (batch.column(k) for k in range(8))
            width = len(keys[0]) if batch.num_rows else 0
            all_keys = pc.fill_null(keys.flatten(), 0).to_numpy(zero_copy_only=False).reshape(-1, width) if width else np.zeros((batch.num_rows, 0))
            rows = zip(zip(key.to_pylist(), bi.to_pylist(), bj.to_pylist()), block.to_pylist(), cid.to_pylist(), copies.to_pylist(), grams_, all_keys)
            for at, mine, c, m, g, k in rows:
                if at != unit:
                    if len(held) > 1:
                        out += _unit(held, *unit, share)
                        yield from pages(False)
                    unit, held = at, []
                held.append((c, m, g.as_py(), k, mine))
        if len(held) > 1:
            out += _unit(held, *unit, share)
        yield from pages(True)

    return verified


def row_keys(id_col: str, text_col: str, names: tuple[str, str] = ("key1", "key2")) -> list[Column]:
    """Two hashes that together stand for a row's id and text; never null, so that joins and
    groupings on them share one partitioning."""
    both = F.col(id_col).isNull(), F.col(id_col).cast("long"), F.col(text_col).isNull(), F.col(text_col)
    return [F.xxhash64(F.lit(k), *both).alias(name) for k, name in enumerate(names)]


def signatures(docs: DataFrame, n: int = N, bands: int = 37, rows: int = 6, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), *row_keys(id_col, text_col), F.col(text_col).alias("text"))
    return d.mapInArrow(word_ids.lean(_signer(n, bands, rows)), SIGNATURES)


def components(spark: SparkSession, edges: DataFrame, folder: str) -> DataFrame:
    """(cid, root) for every vertex of ``edges`` (u, v): root is the least cid of its component.

    Alternating large and small stars; each round is a written table.  Minima are map-side combined, and
    the joins with them are left to the engine, which splits hot vertices.
    """
    def star(e: DataFrame, large: bool) -> DataFrame:
        if large:
            e = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        else:
            e = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = e.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        joined = e.join(low, "u")
        if large:
            out = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        return out.filter("u <> v").distinct()

    state, before, step = edges.filter("u <> v").distinct(), None, 0
    while True:
        path = f"{folder}/stars-{step}"
        (star(star(state, True), False) if step else state).write.parquet(path)
        state = spark.read.schema("u binary, v binary").parquet(path)
        now = state.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if now == before or not now["n"]:
            break
        before, step = now, step + 1
    # a converged state is a star around every component's least vertex
    return state.select(F.col("u").alias("cid"), F.col("v").alias("root")).unionByName(state.select(F.col("v").alias("cid"), F.col("v").alias("root")).distinct())


CLASSES = "number long, cid binary, copies long, doc_id long, key1 long, key2 long, n_grams long, bands array<long>"


def _write_classes(spark: SparkSession, folder: str) -> None:
    """The classes of equal n-gram sets, each by its row of least doc_id (nulls last); texts without words (cid null) stay out."""
    sigs = spark.read.schema(SIGNATURES).parquet(f"{folder}/signatures")
    first = sigs.filter("cid IS NOT NULL").groupBy("cid").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key1", "key2", "n_grams", "bands")).alias("f"), F.count("*").alias("copies"))
    # a class has a number from here on: eight bytes that compress, where buckets repeat it for every band
    first.select(F.monotonically_increasing_id().alias("number"), "cid", "copies", "f.doc_id", "f.key1", "f.key2", "f.n_grams", "f.bands").write.parquet(f"{folder}/classes")


def _write_links(spark: SparkSession, docs: DataFrame, folder: str, bands: int, n: int, share: Fraction, id_col: str, text_col: str) -> None:
    """Links of the classes that meet in buckets, as rows of UNITS."""
    classes = spark.read.schema(CLASSES).parquet(f"{folder}/classes")
    members = classes.select("number", "n_grams", F.posexplode("bands").alias("band", "key"))
    several = members.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    inside = members.join(several.select("key"), "key")
    tag = lambda seed: F.bit_xor(F.xxhash64(F.lit(seed), "number"))
    buckets = inside.groupBy("key").agg(F.count("*").alias("n"), F.sum("n_grams").alias("grams"), tag(1).alias("x"), tag(2).alias("y"))
    alike = buckets.groupBy("n", "x", "y").agg(F.min("key").alias("key"), F.max("grams").alias("grams"))
    blocks = F.greatest(F.lit(1), F.ceil(F.col("grams") / F.lit(BLOCK))).cast("int")
    kept = inside.select("number", "band", "key").join(alike.select("key", blocks.alias("blocks")), "key")
    # at most one bucket a band: the list is bounded by the number of bands
    mine = kept.groupBy("number").agg(F.map_from_entries(F.collect_list(F.struct("band", F.struct("key", "blocks")))).alias("m")).select(
        "number", F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda b: F.try_element_at("m", b)["key"]).alias("keys"), F.map_values("m").alias("own"))
    wanted = mine.join(classes.select("number", "cid", "copies", "key1", "key2"), "number")
    # a class's row is one id and text, and repeats of it (combined map-side) are one row: each class meets one text
    texts = docs.select(*row_keys(id_col, text_col), F.col(text_col).alias("text")).dropDuplicates(["key1", "key2"])
    sets = wanted.join(texts, ["key1", "key2"]).select("cid", "copies", "keys", "own", "text").mapInArrow(word_ids.lean(_set_maker(n)), SETS)

    # a class is in block h of its bucket, and in the units (h, j) and (i, h)
    in_bucket = sets.select("cid", "copies", "keys", "grams", F.explode("own").alias("o")).select(
        "cid", "copies", "keys", "grams", "o.key", "o.blocks", F.pmod(F.xxhash64("cid"), F.col("o.blocks")).cast("int").alias("block"))
    units = in_bucket.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key", F.least("block", "other").alias("bi"), F.greatest("block", "other").alias("bj"), "block", "cid", "copies", "grams", "keys")
    found = (units.repartition("key", "bi", "bj").sortWithinPartitions("key", "bi", "bj").mapInArrow(word_ids.lean(_verifier(share)), UNITS))
    found.write.parquet(f"{folder}/links")


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of finished phases: its cleaner does so once the driver has
    collected what refers to them, which by itself may come after the job's next text shuffle."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _grouped(spark: SparkSession, docs: DataFrame, threshold: float = THRESHOLD, n: int = N, recall: float = RECALL, hashes: int = HASHES, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The signatures, and a row for every class: cid, its row of least doc_id (class_id, key1, key2), copies, links and
    root (the group's least cid, never null)."""
    folder = folder or scratch(spark, "jaccard-join")
    bands, rows = choose_bands(threshold, recall, hashes)
    signatures(docs, n, bands, rows, id_col, text_col).write.parquet(f"{folder}/signatures")
    _write_classes(spark, folder)
    release(spark)
    _write_links(spark, docs, folder, bands, n, Fraction(str(threshold)), id_col, text_col)
    release(spark)
    sigs = spark.read.schema(SIGNATURES).parquet(f"{folder}/signatures")
    classes = spark.read.schema(CLASSES).parquet(f"{folder}/classes")
    links = spark.read.schema(UNITS).parquet(f"{folder}/links")

    per_class = links.groupBy("cid").agg(F.sum("links").alias("links"))
    roots = components(spark, links.select(F.col("cid").alias("u"), F.col("least").alias("v")), folder)
    grouped = classes.select("cid", "copies", F.col("doc_id").alias("class_id"), "key1", "key2").join(per_class, "cid", "left").join(roots, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    return sigs, grouped


def near_duplicates(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """A row for every row of ``docs``: doc_id, key1, key2 (``row_keys``), class_id (least doc_id of the texts
    with the same n-gram set), group_id (least doc_id of all that links join it to; both null only
    if all those ids are) and n_links (other documents with Jaccard >= threshold, copies included)."""
    sigs, grouped = _grouped(spark, docs, **options)
    least = grouped.groupBy("root").agg(F.min("class_id").alias("group_id"))
    result = grouped.join(least, "root").select("cid", "class_id", "group_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    return sigs.select("doc_id", "key1", "key2", "cid").join(result, "cid", "left").select(
        "doc_id", "key1", "key2", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("group_id", "doc_id").alias("group_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of every group (that of the least doc_id, nulls last), with all its columns; texts without words stay."""
    keys = tuple(word_ids.free_name(docs.columns, k) for k in ("key1", "key2"))
    sigs, grouped = _grouped(spark, docs, id_col=id_col, text_col=text_col, **options)
    first = grouped.groupBy("root").agg(F.min(F.struct(F.col("class_id").isNull(), "class_id", "key1", "key2")).alias("f"))
    wordless = sigs.filter("cid IS NULL").select("key1", "key2").distinct()
    stay = first.select("f.key1", "f.key2").unionByName(wordless).toDF(*keys)
    # one shuffle of the texts: the repeated rows meet where the join has put them
    joined = docs.select(*docs.columns, *row_keys(id_col, text_col, keys)).join(stay, list(keys), "left_semi")
    return joined.dropDuplicates(list(keys)).select(*docs.columns)
