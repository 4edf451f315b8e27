"""Language ID and the quality model: held-out accuracy on the smallest tables, and awkward rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerfold.llm import language_id as L
from ledgerfold.llm import quality_model as Q
from ledgerfold.llm.queries import QUERIES
from tests.llm.cases import PROSE, TEXTS, documents

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_language_of_held_out_texts(spark, docs):
    got = QUERIES["op3_language_id"](spark, SF).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right"), F.min("score"), F.max("score"), F.count("*").alias("n")).first()
    assert got["n"] > 150 and got["right"] > 0.97 and 0 <= got["min(score)"] <= got["max(score)"] <= 1


def test_unknown_language_rows_and_no_model(spark, docs):
    model = L.fit(docs)
    rows = {r.doc_id: r for r in L.predict(documents(spark, [(1, None), (2, ""), (3, "123 $$ 45"), (4, "A the and of that was with")]), model).collect()}
    assert [rows[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and rows[1].score == 0
    assert rows[4].lang_pred in ("de", "en", "es", "fr") and 0 <= rows[4].score <= 1
    assert len(L.predict(documents(spark), model).collect()) == len(TEXTS)
    nothing = L.fit(documents(spark))  # no language at all
    assert {r.lang_pred for r in L.predict(documents(spark), nothing).collect()} == {"und"}
    one = L.fit(docs.filter("lang = 'fr'"))
    assert {r.lang_pred for r in L.predict(documents(spark, [(1, PROSE)]), one).collect()} == {"fr"}
    assert L.predict(documents(spark, []), model).collect() == []


def test_language_stage_keeps_clean_rows(spark, docs):
    model = L.fit(docs)
    table = documents(spark, [*TEXTS, (99, "12 34 5")])
    out = L.keep_identified(table, model)
    assert out.columns == table.columns
    gone = {i for i, _ in [*TEXTS, (99, "")]} - {r.doc_id for r in out.collect()}
    assert gone == {2, 3, 4, 10, 99}


DUTCH = ("De regering heeft gisteren besloten om de regels voor de bouw van nieuwe huizen in de stad te veranderen. Volgens de minister is er veel te weinig ruimte "
         "voor jonge gezinnen en moet er snel iets gebeuren, maar de bewoners zijn bang dat het groen verdwijnt en dat het verkeer te druk wordt voor de kinderen.")
PORTUGUESE = ("O governo decidiu ontem mudar as regras para a construção de novas casas na cidade. Segundo o ministro, há muito pouco espaço para as famílias jovens "
              "e é preciso fazer alguma coisa depressa, mas os moradores têm medo de que o verde desapareça e que o trânsito fique demasiado intenso.")
NOISE = " ".join(["the of and xqzk vvbg wrtp hjkl zzxc qwpf mnbv"] * 12)


def test_language_stage_rejects_other_languages_and_keeps_the_learned(spark, docs):
    import corpus_pipeline

    clean = corpus_pipeline.quality_stage(spark, docs, SF).cache()
    one = lambda i, t: (i, t, None, "s", 0)
    extra = spark.createDataFrame([one(-1, DUTCH), one(-2, PORTUGUESE), one(-3, NOISE)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id for r in corpus_pipeline.language_stage(spark, clean.unionByName(extra.select(clean.columns)), SF).select("doc_id").collect()}
    assert not {-1, -2, -3} & kept
    assert all(len(ids - kept) <= 0.02 * len(ids) for ids in (set(r.ids) for r in clean.groupBy('lang').agg(F.collect_list('doc_id').alias('ids')).collect()))
    clean.unpersist()


def test_thresholds_of_few_texts():
    x = np.hstack([np.eye(6, L.DIM), np.ones((6, 1))]).astype("<f2")
    assert L.thresholds(x, ["en"] * 6, np.arange(6)) == {}
    assert set(L.thresholds(x[[0, 0, 1, 1, 2]], ["en", "en", "fr", "fr", "de"], np.array([0, 1, 2, 3, 4]))) <= {"en", "fr", "de"}


def test_families_come_first():
    model = L.Model({"romance": ["es", "fr"], "x": ["x"]}, [("romance", "x"), ("es", "fr")], np.zeros((L.DIM + 1, 2)))
    model.weights[L.DIM] = [1, -1]
    assert model.predict(np.eye(1, L.DIM + 1, L.DIM))[0] == ["fr"]


def test_svm_separates():
    rng = np.random.default_rng(0)
    x = np.hstack([rng.normal(size=(200, 5)), np.ones((200, 1))])
    y = np.where(x[:, 0] + 0.5 * x[:, 1] > 0.2, 1.0, -1.0)
    assert (np.sign(x @ L.train_svm(x, y, epochs=100)) == y).mean() > 0.97


def test_quality_of_held_out_texts(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = QUERIES["op9_quality_model"](spark, "/root/testdata/sf0.1").join(labels, "doc_id").filter("held_out").agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")).alias("right"), F.count("*").alias("n")).first()
    assert got["n"] > 500 and got["right"] > 0.97


def test_quality_awkward_rows(spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (7, 0), (None, 1), (10, None)], "doc_id long, quality int")
    model = Q.fit(documents(spark), labels)
    rows = Q.score(documents(spark), model).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (2, 3, 4)}) == 1
    assert {r.score for r in Q.score(documents(spark), Q.fit(documents(spark), labels.limit(0))).collect()} == {0.5}
    assert Q.score(documents(spark, []), model).collect() == []


def test_a_language_of_a_few_texts_and_many_copies_is_learned(spark, docs):
    french = [r.text for r in docs.filter("lang = 'fr' AND length(text) > 400").select("text").distinct().orderBy("text").limit(5).collect()]
    german = [r.text for r in docs.filter("lang = 'de' AND length(text) > 400").select("text").distinct().orderBy("text").limit(80).collect()]
    copies = spark.range(4_000).select((F.col("id") % len(french)).cast("int").alias("k")).select(F.lit("fr").alias("lang"), F.element_at(F.lit(french), F.col("k") + 1).alias("text"))
    table = copies.unionByName(spark.createDataFrame([("de", t) for t in german], "lang string, text string"))
    for sample in (6, 40, 1000):
        model = L.fit(table, sample=sample)
        assert model.languages == {"germanic": ["de"], "romance": ["fr"]}
        again = L.fit(table.repartition(3), sample=sample)
        assert np.array_equal(model.weights, again.weights)
    got = L.predict(spark.createDataFrame([(1, french[0]), (2, german[0])], "doc_id long, text string"), model)
    assert {r.doc_id: r.lang_pred for r in got.collect()} == {1: "fr", 2: "de"}


def test_pair_machines_agree_with_plain_subgradient_descent():
    """The same objective (hinge loss, L2, classes of equal weight) minimised the slow way."""
    rng = np.random.default_rng(1)
    x = np.hstack([rng.normal(size=(60, 3)), np.ones((60, 1))])
    y = np.where(x[:, 0] - 0.7 * x[:, 2] + 0.1 * rng.normal(size=60) > 0.1, 1.0, -1.0)
    c = np.where(y > 0, 1 / (y > 0).sum(), 1 / (y < 0).sum()) * len(y) / 2
    worth = lambda w: w @ w / 2 + (c * np.maximum(0, 1 - y * (x @ w))).sum()
    w, best = np.zeros(4), np.inf
    for step in range(1, 40_000):
        w -= (w - ((c * y * (y * (x @ w) < 1)) @ x)) / (step + 10)
        best = min(best, worth(w))
    assert worth(L.train_svm(x, y, c=1.0, epochs=500)) < best * 1.01


def test_ftrl_equals_a_plain_loop_over_all_weights():
    rng = np.random.default_rng(2)
    rows = [(np.sort(rng.choice(12, 4, replace=False)).astype(np.int32), rng.random(4).astype(np.float32)) for _ in range(30)]
    y = rng.integers(0, 2, 30)
    alpha, beta, l1, l2 = 0.2, 1.0, 0.01, 0.01
    z, n, order = dict.fromkeys([*range(12), "bias"], 0.0), dict.fromkeys([*range(12), "bias"], 0.0), np.random.default_rng(9)
    weight = lambda k: 0.0 if abs(z[k]) <= l1 else -(z[k] - np.sign(z[k]) * l1) / ((beta + n[k]**0.5) / alpha + l2)
    for _ in range(4):
        for i in order.permutation(30).tolist():
            values = {**dict(zip(rows[i][0].tolist(), rows[i][1].tolist())), "bias": 1.0}
            held = {k: weight(k) for k in values}
            p = 1 / (1 + np.exp(-sum(held[k] * v for k, v in values.items())))
            for k, v in values.items():
                g = (p - y[i]) * v
                z[k] += g - ((n[k] + g * g)**0.5 - n[k]**0.5) / alpha * held[k]
                n[k] += g * g
    w, bias = Q.train_ftrl(rows, y)
    assert w[:12] == pytest.approx([weight(k) for k in range(12)], abs=1e-9) and bias == pytest.approx(weight("bias"), abs=1e-9) and not w[12:].any()


def test_repeated_ids_give_one_text_and_the_same_model(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    once = [(i, ("good clean words here " if i % 2 else "bad bad bad $$ ") * (3 + i % 5)) for i in range(40)]
    hot = [*once, *[(7, f"other text {k % 3}") for k in range(3_000)]]
    models = [Q.fit(documents(spark, hot).repartition(k), labels) for k in (1, 5)]
    assert np.array_equal(models[0][0], models[1][0]) and models[0][1] == models[1][1]
    scores = {r.doc_id: r.score for r in Q.score(documents(spark, once), models[0]).collect()}
    assert all((scores[i] > 0.5) == bool(i % 2) for i in scores if i != 7)


def test_every_text_is_learned_from(spark):
    """More texts than a share holds: a word of any one text counts, and every text is judged for the thresholds."""
    import random

    rng = random.Random(3)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(6))
    rows = [(lang, " ".join(word(letters) for _ in range(12))) for lang, letters in (("aa", "abcdefg"), ("bb", "hijklmn"), ("cc", "opqrstu")) for _ in range(60)]
    rows += [("dd", "vwxyz " * 9)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    model = L.fit(docs, sample=12, reject=True)
    assert sorted(model.least) == sorted(model.languages) == ["aa", "bb", "cc", "dd"]
    got = L.predict(docs.selectExpr("monotonically_increasing_id() AS doc_id", "text", "lang"), model)
    right = got.join(docs.selectExpr("monotonically_increasing_id() AS doc_id", "lang"), "doc_id").filter("lang = lang_pred").count()
    assert right == len(rows)
    again = L.fit(docs.repartition(3), sample=12, reject=True)
    assert np.array_equal(model.weights, again.weights) and model.least == again.least
    for k in (0, 17, 100, 179):  # without any one text the machines are others
        assert not np.array_equal(model.weights, L.fit(docs.filter(F.col("text") != rows[k][1]), sample=12).weights)


def share_of(texts):
    """Batches as a task of the trainer gets them: two languages, one share, sorted."""
    import pyarrow as pa

    rows = sorted((("aa", "bb")[k % 2], t, k) for k, t in enumerate(texts))
    langs, texts, hashes = zip(*rows)
    batch = pa.RecordBatch.from_arrays([pa.array(langs), pa.array(texts), pa.array(hashes, pa.int64()), pa.array([3] * len(rows), pa.int32())], names=["lang", "text", "h", "share"])
    return [batch.slice(at, 1000) for at in range(0, len(rows), 1000)]


def test_a_share_is_held_once_beside_its_texts(monkeypatch):
    import tracemalloc

    monkeypatch.setattr(L, "train_svm", lambda x, y, rows: np.zeros(x.shape[1]))
    batches = share_of([f"{'wxyz'[k % 2::2] * 5} {k}" for k in range(6000)])
    tracemalloc.start()
    assert len(list(L._trainer(False, True)(iter(batches)))) == 1
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1.8 * 6000 * (L.DIM + 1) * 2


def test_a_share_larger_than_its_room_is_trained_whole(monkeypatch):
    batches = share_of([f"{'abcd'[k % 2::2] * 5} " + "vwxyz"[k % 5] * (k % 7 + 1) for k in range(300)])
    whole = [b.to_pylist() for b in L._trainer(False, True)(iter(batches))]
    monkeypatch.setattr(L, "ROOM", 7)
    assert [b.to_pylist() for b in L._trainer(False, True)(iter(batches))] == whole and whole[0][0]["n"] == 300


def test_tasks_of_other_operators_let_the_word_tables_go():
    from ledgerfold.llm import word_ids as W
    from ledgerfold.llm.token_files import vocabulary

    W.word_ids.cache_clear()
    W.word_ids(vocabulary())
    assert W.word_ids.cache_info().currsize == 1
    assert list(W.lean(L._trainer(False, True))(iter(share_of(["one text", "another text"])))) and W.word_ids.cache_info().currsize == 0
