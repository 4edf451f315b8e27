import collections
import re

from ledgerfold.llm import quality_rules as Q
from tests.llm.cases import PROSE, TEXTS, documents, plain

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    count = collections.Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)
    return *n, n[0] < 50 or 100 * n[4] > 50 * n[0]


def test_counts_equal_brute_force(spark):
    got = plain(Q.quality_rules(documents(spark)).collect(), "doc_id", *COUNTS, "base_failed")
    assert got == plain([dict(zip(("doc_id", *COUNTS, "base_failed"), (i, *brute(t)))) for i, t in TEXTS], "doc_id", *COUNTS, "base_failed")


def test_a_collision_of_hashes_falls_back_to_the_windows_text(spark, monkeypatch):
    # all but one bit of a packed window is its position: nearly every pair of windows collides
    monkeypatch.setattr(Q, "POSITION", (1 << 24) - 1)
    import pyspark.sql.functions as F
    real = F.xxhash64
    monkeypatch.setattr(Q.F, "xxhash64", lambda *c: real(*c).bitwiseAND(F.lit(1 << 24)))
    got = plain(Q.quality_rules(documents(spark)).collect(), "doc_id", "n_repeat_words")
    assert got == plain([{"doc_id": i, "n_repeat_words": brute(t)[4]} for i, t in TEXTS], "doc_id", "n_repeat_words")


def test_verdict_and_empty_table(spark):
    rows = {r.doc_id: r for r in Q.quality_rules(documents(spark, [(1, PROSE), (2, None), (3, "#@ $$$ %%% " * 60)])).collect()}
    assert rows[1].kept and not rows[1].base_failed and rows[1].failed_rules == []
    assert not rows[2].kept and rows[2].base_failed and "length" in rows[2].failed_rules
    assert "symbol_ratio" in rows[3].failed_rules
    assert Q.quality_rules(documents(spark, [])).collect() == []


def test_stage_keeps_all_columns_and_only_kept_rows(spark):
    docs = documents(spark, [*TEXTS, (20, PROSE)])
    out = Q.keep_quality(docs)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == sorted(r.doc_id for r in Q.quality_rules(docs).filter("kept").collect())
