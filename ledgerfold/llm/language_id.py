"""Hierarchical language identification: family first, then one-versus-one within it.

A text is its hashed byte n-grams (one to three bytes of the lower-cased whole text, everything but
letters as one space), each count as the square root of its share.  Linear support vector machines, one for every pair of families
and one for every pair of languages of a family, are trained by dual coordinate descent on all different labelled
texts: in shares of about ``SAMPLE`` texts, dealt by a hash, whose machines are averaged.
A pair's machine votes; votes, then summed margins, then the name decide.  Scoring is one pass
without a shuffle: counts times a small weight matrix that travels with the task.

Defined results: null text, or text without a letter: ``und``, score 0.  With no labelled
text at all, every text is ``und``; with one language, every other text is of it.  A row
without a language isn't learned from.  One language alone rejects no lettered text.  Repeated rows give repeated rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerfold.llm.word_ids import free_name, lean, texts_of

#: Language families by ISO 639-1 code. Other codes are families of their own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi".split(),
    "romance": "fr es it pt ro ca gl oc".split(),
    "slavic": "ru uk be pl cs sk bg sr hr bs sl mk".split(),
    "uralic": "fi et hu".split(),
    "indic": "hi ur bn mr gu pa ne".split(),
    "semitic": "ar he mt am".split(),
    "turkic": "tr az kk uz".split(),
}
DIM, SAMPLE, SLICE, DOCS = 4096, 6000, 1_000_000, 128
UNKNOWN = "und"
#: Least score kept where no threshold has been learned. A winner of two has a margin of 0 or more, so this alone rejects nothing.
LEAST = 0.5
#: Learned thresholds: this share of the margin that all but ``LOW`` of a language's labelled texts reach.
LOW, SHARE = 0.01, 0.5
SHARPNESS = 4.0
PREDICTIONS = "doc_id long, lang_pred string, score double"


def family(lang: str) -> str:
    return next((name for name, langs in FAMILIES.items() if lang.split("-")[0].lower() in langs), lang)


def _byte_table() -> np.ndarray:
    """Bytes of letters stay (in UTF-8 every byte from 128 on counts as one), all others are a space."""
    table = np.full(256, 32, np.uint8)
    for b in [*range(ord("a"), ord("z") + 1), *range(128, 256)]:
        table[b] = b
    return table


TABLE = _byte_table()


def features(texts: pa.Array) -> np.ndarray:
    """float32 [texts, DIM + 1]; the last column is the constant 1."""
    texts = pc.utf8_lower(texts)
    lengths = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    raw = np.frombuffer(b"".join(x.encode() for x in texts.to_pylist()), np.uint8)
    # a space around every text, so that n-grams never join two texts
    ends = np.cumsum(lengths)
    b = np.insert(TABLE[raw], np.concatenate([[0], ends]), 32) if len(lengths) else raw
    doc = np.repeat(np.arange(len(lengths)), lengths + 1)
    b, doc = b[: len(doc) + 1], np.concatenate([doc, [len(lengths) - 1]]) if len(lengths) else doc
    out = np.zeros((len(lengths), DIM + 1), np.float32)
    if len(lengths):
        keep = np.ones(len(b), bool)
        keep[1:] = (b[1:] != 32) | (b[:-1] != 32)  # runs of spaces are one
        b, doc = b[keep].astype(np.uint32), doc[keep]
        for n in (1, 2, 3):
            if len(b) < n:
                break
            code = np.full(len(b) - n + 1, n, np.uint32)
            for k in range(n):
                code = code * np.uint32(0x9E3779B1) + b[k:len(b) - n + 1 + k]
            code = (code * np.uint32(0x85EBCA6B)) >> np.uint32(20)
            at = doc[: len(code)]
            same = at == doc[n - 1:]
            counts = np.bincount(at[same] * DIM + code[same], minlength=len(lengths) * DIM).reshape(len(lengths), DIM)
            out[:, :DIM] += counts
        total = np.maximum(out[:, :DIM].sum(axis=1, keepdims=True), 1)
        out[:, :DIM] = np.sqrt(out[:, :DIM] / total)
        out[:, DIM] = 1
    return out


def train_svm(x: np.ndarray, y: np.ndarray, c: float = 10.0, epochs: int = 20, seed: int = 5, rows: np.ndarray | None = None) -> np.ndarray:
    """Weights of the L1-loss linear SVM for y in {-1, 1}, by dual coordinate descent; ``rows`` of x (all), which are not
    copied: one row at a time is widened to single precision."""
    rng = np.random.default_rng(seed)
    rows = np.arange(len(x)) if rows is None else rows
    w, alpha = np.zeros(x.shape[1], np.float64), np.zeros(len(rows))
    at, wide = rows.tolist(), lambda r: x[r] if x.dtype == np.float64 else x[r].astype(np.float32)
    square = np.array([float(v @ v) for v in map(wide, at)])
    # rarer class: as much weight in all as the other
    most = np.where(y > 0, 1 / max(1, (y > 0).sum()), 1 / max(1, (y < 0).sum())) * len(y) / 2 * c
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)).tolist():
            old, row = alpha[i], wide(at[i])
            new = min(max(old - (y[i] * float(row @ w) - 1) / square[i], 0.0), most[i])
            if new != old:
                w += (new - old) * y[i] * row
                alpha[i] = new
                moved = max(moved, abs(new - old))
        if moved < 1e-3:
            break
    return w


@dataclass
class Model:
    """Languages by family, and a weight column for each pair (first, second): positive means first."""

    languages: dict[str, list[str]] = field(default_factory=dict)
    pairs: list[tuple[str, str]] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros((DIM + 1, 0)))
    #: Least score of each language, if learned (``thresholds``).
    least: dict[str, float] = field(default_factory=dict)

    def _choose(self, names: list[str], margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the winner among names for each row, and its least margin over any other."""
        n = len(margins)
        if len(names) == 1:
            return np.zeros(n, np.int64), np.full(n, np.inf)
        votes, sums = np.zeros((n, len(names))), np.zeros((n, len(names)))
        over = np.full((n, len(names)), np.inf)
        for i, j in combinations(range(len(names)), 2):
            m = margins[:, self.pairs.index((names[i], names[j]))]
            votes[:, i] += m >= 0
            votes[:, j] += m < 0
            sums[:, i] += m
            sums[:, j] -= m
            over[:, i], over[:, j] = np.minimum(over[:, i], m), np.minimum(over[:, j], -m)
        best = np.lexsort((-np.arange(len(names))[None, :].repeat(n, 0), sums, votes), axis=1)[:, -1]
        return best, over[np.arange(n), best]

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        margins = x @ self.weights
        names = sorted(self.languages)
        chosen, margin = self._choose(names, margins)
        langs = np.empty(len(x), object)
        for k, name in enumerate(names):
            rows = np.nonzero(chosen == k)[0]
            inside = sorted(self.languages[name])
            best, m = self._choose(inside, margins[rows])
            langs[rows] = [inside[b] for b in best]
            margin[rows] = np.minimum(margin[rows], m)
        return langs.tolist(), _score(margin)


def _score(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-SHARPNESS * np.clip(margin, -50, 50)))


def train(x: np.ndarray, langs: list[str]) -> Model:
    """Family machines, then machines within each family, from features and languages."""
    by_family: dict[str, list[str]] = {}
    for lang in sorted(set(langs)):
        by_family.setdefault(family(lang), []).append(lang)
    labels, families = np.array(langs, object), np.array([family(a) for a in langs], object)
    pairs, columns = [], []
    for names, of in [(sorted(by_family), families), *((sorted(v), labels) for _, v in sorted(by_family.items()))]:
        for a, b in combinations(names, 2):
            rows = np.nonzero((of == a) | (of == b))[0]
            pairs.append((a, b))
            columns.append(train_svm(x, np.where(of[rows] == a, 1.0, -1.0), rows=rows))
    return Model(by_family, pairs, np.stack(columns, axis=1) if columns else np.zeros((DIM + 1, 0)))


def thresholds(x: np.ndarray, langs: list[str], h: np.ndarray) -> dict[str, float]:
    """Least score of each language: ``SHARE`` of the ``LOW`` quantile of its texts' margins.

    Each half of the texts, by the text's hash, is judged by a model of the other half, since a machine's margins on
    what it has learned are too large.  A language none of whose texts is recognised that way has
    the threshold of all texts together; one language alone has no machine and no threshold.
    """
    labels, half = np.array(langs, object), h & 1
    margins: dict[str, list[np.ndarray]] = {}
    for part in (0, 1):
        learned, judged = np.nonzero(half != part)[0], np.nonzero(half == part)[0]
        model = train(x[learned], labels[learned].tolist()) if len(learned) else Model()
        if not model.pairs:
            continue
        for at in range(0, len(judged), DOCS):
            rows = judged[at:at + DOCS]
            got, score = model.predict(x[rows].astype(np.float32))
            margin = np.log(score / np.maximum(1 - score, 1e-12)) / SHARPNESS
            right = np.array(got, object) == labels[rows]
            for lang in set(labels[rows][right]):
                margins.setdefault(lang, []).append(margin[right & (labels[rows] == lang)])
    if not margins:
        return {}
    least = lambda some: float(_score(np.array(SHARE * np.quantile(np.concatenate(some), LOW, method="lower"))))
    every = least([m for some in margins.values() for m in some])
    return {lang: least(margins[lang]) if lang in margins else every for lang in set(langs)}


def held_out(id_: Column, parts: int = 5, part: int = 0) -> Column:
    return F.crc32(id_.cast("string").cast("binary")) % parts == part


def _limited(column: pa.Array) -> Iterator[pa.Array]:
    """Slices bounded in bytes and in texts."""
    for texts in texts_of(column, SLICE):
        for at in range(0, len(texts), DOCS):
            yield texts.slice(at, DOCS)


def _limited_rows(column: pa.Array, rows: np.ndarray) -> Iterator[pa.Array]:
    """``_limited`` of the texts at ``rows``, of which a slice at a time is copied."""
    ends, at = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64)[rows]), 0
    while at < len(rows):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + SLICE, side="right")))
        for k in range(at, to, DOCS):
            yield column.take(pa.array(rows[k:min(k + DOCS, to)]))
        at = to


#: Vectors that a share has room for at first: shares of ``SAMPLE`` texts, dealt by a hash, are rarely larger.
ROOM = SAMPLE + SAMPLE // 4
#: Rows of the machines trained on one share: weights of a pair, and (with ``reject``, of one share alone) a language's threshold.
TRAINED = "share int, part int, a string, b string, n long, w binary, least double"
#: Margins are counted in cells of this width, rounded down, to find the quantiles of all texts.
CELL = 1e-4


def _trainer(alone: bool, reject: bool) -> Callable:
    """Machines of every share of texts (rows: lang, text, h, share; sorted by share, lang, h and text)."""
    names = [c.split()[0] for c in TRAINED.split(", ")]

    def trained(share: int, langs: list[str], hashes: list[int], x: np.ndarray) -> pa.RecordBatch:
        model = train(x, langs)
        n = [sum(lang in pair or family(lang) in pair for lang in langs) for pair in model.pairs]
        rows = [(share, share % 2, a, b, k, w.tobytes(), None) for (a, b), k, w in zip(model.pairs, n, model.weights.T)]
        if alone and reject:
            rows += [(share, 0, lang, None, 0, None, least) for lang, least in thresholds(x, langs, np.array(hashes, np.int64)).items()]
        types = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=names)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        share, last, langs, hashes = None, None, [], []
        room = np.empty((ROOM, DIM + 1), "<f2")  # of a share's vectors; its pages are taken as they are filled
        for batch in batches:
            keys = list(zip(batch.column(3).to_pylist(), batch.column(0).to_pylist(), batch.column(2).to_pylist()))
            kept = np.nonzero(np.array([key != before for key, before in zip(keys, [last, *keys])], bool))[0]  # copies follow each other
            last, shares = keys[-1] if keys else last, batch.column(3).to_numpy()[kept]
            cuts = [0, *(np.nonzero(np.diff(shares))[0] + 1).tolist(), len(shares)] if len(shares) else []
            for a, b in zip(cuts, cuts[1:]):
                if share is not None and shares[a] != share:
                    yield trained(share, langs, hashes, room[:len(langs)])
                    langs, hashes = [], []
                share, n = int(shares[a]), len(langs)
                langs += batch.column(0).take(pa.array(kept[a:b])).to_pylist()
                hashes += batch.column(2).take(pa.array(kept[a:b])).to_pylist()
                if len(langs) > len(room):
                    room = np.concatenate([room, np.empty((max(len(room) // 2, len(langs) - len(room)), DIM + 1), "<f2")])
                for texts in _limited_rows(batch.column(1), kept[a:b]):
                    room[n:n + len(texts)] = features(texts)
                    n += len(texts)
        if share is not None:
            yield trained(share, langs, hashes, room[:len(langs)])

    return rows


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a pair and part: the sum of its shares' weights, each times its texts (rows sorted by pair, part and share)."""
    key, n, total, names = None, 0, None, [c.split()[0] for c in TRAINED.split(", ")]
    row = lambda: pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((0, key[2], key[0], key[1], n, total.tobytes(), None), (pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.float64()))], names=names)
    for batch in batches:
        for r in range(batch.num_rows):
            part, a, b, k, w = (batch.column(c)[r] for c in (1, 2, 3, 4, 5))
            at, k = (a.as_py(), b.as_py(), part.as_py()), k.as_py()
            if at != key:
                if key is not None:
                    yield row()
                key, n, total = at, 0, np.zeros(DIM + 1)
            n += k
            total += k * np.frombuffer(w.as_buffer(), np.float64)
    if key is not None:
        yield row()


def _assembled(languages: list[str], sums: list[dict]) -> Model:
    """The model whose machines are ``sums`` of weights by their texts ``n``; a pair that met in no share has no say."""
    by_family: dict[str, list[str]] = {}
    for lang in sorted(languages):
        by_family.setdefault(family(lang), []).append(lang)
    pairs = [pair for names in (sorted(by_family), *(v for _, v in sorted(by_family.items()))) for pair in combinations(names, 2)]
    weights = np.zeros((DIM + 1, len(pairs)))
    for k, pair in enumerate(pairs):
        found = [r for r in sums if (r["a"], r["b"]) == pair]
        if found:
            weights[:, k] = np.sum([np.frombuffer(r["w"], np.float64) for r in found], axis=0) / sum(r["n"] for r in found)
    return Model(by_family, pairs, weights)


def _judged(halves: list[Model]) -> Callable:
    """lang, h and the margin's cell of every text that the model of the other half recognises (rows: lang, text, h)."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in _limited(batch.column(1)):
                langs, h = (batch.column(c).slice(at, len(texts)) for c in (0, 2))
                x, half, truth = features(texts), h.to_numpy() & 1, np.array(langs.to_pylist(), object)
                cell, right = np.zeros(len(texts), np.int64), np.zeros(len(texts), bool)
                for part in (0, 1):
                    of = np.nonzero(half == part)[0]
                    if len(of):
                        got, score = halves[1 - part].predict(x[of])
                        cell[of] = np.floor(np.log(score / np.maximum(1 - score, 1e-12)) / SHARPNESS / CELL)
                        right[of] = np.array(got, object) == truth[of]
                yield pa.RecordBatch.from_arrays([langs, h, pa.array(cell)], names=["lang", "h", "cell"]).filter(pa.array(right))
                at += len(texts)

    return rows


def _all_thresholds(rows: DataFrame, halves: list[Model], languages: list[str]) -> dict[str, float]:
    """``thresholds`` from all texts: each is judged by the model of the other half, and margins are counted by cell."""
    judged = rows.select("lang", "text", "h").mapInArrow(lean(_judged(halves)), "lang string, h long, cell long").distinct()
    counts = judged.groupBy("lang", "cell").agg(F.count("*").alias("n"))
    counts = counts.unionByName(counts.groupBy("cell").agg(F.sum("n").alias("n")).withColumn("lang", F.lit(None).cast("string")))
    w = Window.partitionBy("lang").orderBy("cell")
    counts = counts.withColumn("upto", F.sum("n").over(w)).withColumn("all", F.sum("n").over(Window.partitionBy("lang")))
    lows = counts.filter(F.col("upto") > F.floor((F.col("all") - 1) * LOW)).groupBy("lang").agg(F.min("cell").alias("cell")).collect()
    least = {r["lang"]: float(_score(np.array(SHARE * r["cell"] * CELL))) for r in lows}
    return {lang: least.get(lang, least[None]) for lang in languages} if least else {}


def fit(docs: DataFrame, sample: int = SAMPLE, lang_col: str = "lang", text_col: str = "text", order: Column | None = None, reject: bool = False) -> Model:
    """Train on every different text with a language; with ``reject``, learn ``thresholds`` from all of them too.
    Copies count once.  At most half as many languages as ``sample`` are learned, those with the most different texts.

    Texts are dealt by their hash over shares of about ``sample``, each share trains its machines in a task, and a pair's machine
    is the mean over shares, by their texts.  A language of few texts is dealt to several shares, so that none lacks it.
    Even and odd shares hold the two halves that judge each other.  Weights and counts by language are all that reaches the driver.
    """
    order = order if order is not None else F.xxhash64(text_col)
    rows = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), order.alias("h"))
    half = F.col("h").bitwiseAND(1)
    texts = rows.select("lang", "h").distinct().groupBy("lang").agg(F.count("*").alias("n"), (F.min(half) == F.max(half)).alias("lone"))
    per = {r["lang"]: (r["n"], r["lone"]) for r in texts.orderBy(F.desc("n"), "lang").limit(sample // 2).collect()}
    if not per:
        return Model()
    total = sum(n for n, _ in per.values())
    alone, pairs_of_shares = total <= sample, -(-total // (2 * sample))
    # shares of its half that a text goes to: each share has about ``few`` texts of every language, if it has so many
    few = max(1, sample // (4 * len(per)))
    to = F.create_map(*[F.lit(v) for lang, (n, _) in per.items() for v in (lang, min(pairs_of_shares, -(-few * 2 * pairs_of_shares // n)))])
    lone = [lang for lang, (_, one) in per.items() if one]  # in one half only: known to both, and not judged
    rows = rows.filter(F.col("lang").isin(list(per)))
    once = lambda some: some.groupBy("lang", "h").agg(F.min("text").alias("text")).select("lang", "text", "h")
    if alone:
        some = once(rows).withColumn("share", F.lit(0))
    else:
        # a text of more copies than a share has texts is reduced to one before the deal, others by the task that sorts them
        hot = F.broadcast(rows.groupBy("lang", "h").count().filter(F.col("count") > sample).select("lang", "h"))
        some = rows.join(hot, ["lang", "h"], "left_anti").select("lang", "text", "h").unionByName(once(rows.join(hot, ["lang", "h"], "left_semi")))
        first = F.pmod(F.xxhash64("h"), F.lit(pairs_of_shares))
        steps = F.transform(F.sequence(F.lit(0), F.try_element_at(to, F.col("lang")) - 1), lambda k: (F.pmod(first + k, F.lit(pairs_of_shares)) * 2 + half).cast("int"))
        some = some.withColumn("share", F.explode(F.when(F.col("lang").isin(lone), F.sequence(F.lit(0), F.lit(2 * pairs_of_shares - 1))).otherwise(steps)))
    dealt = some.select("lang", "text", "h", "share").repartition(1 if alone else 2 * pairs_of_shares, "share").sortWithinPartitions("share", "lang", "h", "text")
    trained = dealt.mapInArrow(lean(_trainer(alone, reject)), TRAINED)
    if alone:
        got = trained.toArrow().to_pylist()
        model = _assembled(list(per), [{**r, "n": 1} for r in got if r["w"] is not None])
        model.least = {r["a"]: r["least"] for r in got if r["w"] is None}
        return model
    sums = trained.repartition("a", "b").sortWithinPartitions("a", "b", "part", "share").mapInArrow(lean(_summed), TRAINED).toArrow().to_pylist()
    sums.sort(key=lambda r: (r["a"], r["b"], r["part"]))
    model = _assembled(list(per), sums)
    if reject and model.pairs:
        halves = [_assembled(list(per), [r for r in sums if r["part"] == part]) for part in (0, 1)]
        model.least = _all_thresholds(rows.filter(~F.col("lang").isin(lone)), halves, list(per))
    return model


def _predictor(model: Model) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in _limited(batch.column(1)):
                lettered = batch.column(2).slice(at, len(texts)).to_numpy(zero_copy_only=False)
                langs, score = model.predict(features(texts)) if model.languages else ([UNKNOWN] * len(texts), np.zeros(len(texts)))
                known = lettered & bool(model.languages)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(at, len(texts)), pa.array([a if k else UNKNOWN for a, k in zip(langs, known)], pa.string()),
                    pa.array(np.where(known, score, 0.0))], names=["doc_id", "lang_pred", "score"])
                at += len(texts)

    return rows


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred and score of every row."""
    lettered = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), lettered.alias("lettered")).mapInArrow(lean(_predictor(model)), PREDICTIONS)


def keep_identified(docs: DataFrame, model: Model, least: float = LEAST, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with an identified language, all their columns: their score reaches ``least`` and the
    model's threshold for the language, if it has learned one."""
    columns = docs.columns

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in _limited(batch.column(columns.index(text_col))):
                lettered = batch.column(len(columns)).slice(at, len(texts)).to_numpy(zero_copy_only=False)
                langs, score = model.predict(features(texts)) if model.languages else ([UNKNOWN] * len(texts), np.zeros(len(texts)))
                bound = np.array([max(least, model.least.get(lang, least)) for lang in langs])
                part = pa.RecordBatch.from_arrays([batch.column(i).slice(at, len(texts)) for i in range(len(columns))], names=columns)
                yield part.filter(pa.array(lettered & (score >= bound)))
                at += len(texts)

    lettered = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    return docs.select(*docs.columns, lettered.alias(free_name(columns, "lettered"))).mapInArrow(lean(rows), docs.schema)
