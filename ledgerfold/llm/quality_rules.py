"""Quality rules: a threshold table compiled into one Spark projection.

Every measure is a built-in expression over the whole text, and every rule is a row of
``RULES`` (measure, numerator, denominator, least, most).  ``quality_rules`` compiles the table into a single
``select``: no user function, no shuffle, no state across rows.  A row's cost is
O(n log n) in its own words (one sort of the three-word windows, and only for texts in
which a window repeats).

Defined results: a null or empty text has no words, all counts 0, ``base_failed`` true and
``kept`` false; repeated rows give repeated rows; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
#: Low bits of a packed window that hold its position.
POSITION = (1 << 24) - 1

#: Frequent function words of the corpus' languages, in one list.
STOP_WORDS = (
    "the of and to in a is that for it as was with on are by be this at from or "
    "der die das und ist in zu den mit von für auf im dem nicht ein eine als auch sich des "
    "le la les de des et est un une en que qui dans pour par sur du au avec "
    "el los las y es una por con se del para al lo no su"
).split()


@dataclass(frozen=True)
class Rule:
    """``least <= numerator / denominator <= most`` must hold; None leaves a side open."""

    name: str
    numerator: str
    denominator: str | None
    least: float | None = None
    most: float | None = None


#: Production thresholds. The measures are columns of ``measures``.
RULES = (
    Rule("length", "n_words", None, 50, None),
    Rule("mean_word_length", "word_chars", "n_words", 2, 20),
    Rule("symbol_ratio", "n_symbols", "n_words", None, 0.1),
    Rule("stop_word_ratio", "n_stop_words", "n_words", 0.06, None),
    Rule("duplicate_line_ratio", "n_dup_lines", "n_lines", None, 0.5),
)


def let(value: Column, body) -> Column:
    """``body(v)`` with ``value`` evaluated once a row, however often ``v`` occurs in it."""
    return F.transform(F.array(value), body)[0]


def _covered(starts: Column) -> Column:
    """Words covered by the three-word windows that begin at ``starts`` (ascending)."""
    # a window starting at i covers i..i+2: it adds 3 words less the overlap with the one before
    adds = lambda a: F.transform(a, lambda i, k: F.least(F.lit(3), i - F.coalesce(F.get(a, k - 1), F.lit(-3))))
    return let(starts, lambda a: F.aggregate(adds(a), F.lit(0), lambda t, x: t + x))


def _repeats_by_text(words: Column, window_at) -> Column:
    """Starts of repeated windows, found by sorting the windows themselves."""

    def runs(s: Column) -> Column:
        same = lambda x, k: F.coalesce(F.get(s, k)["w"] == x["w"], F.lit(False))
        return F.array_sort(F.transform(F.filter(s, lambda x, k: same(x, k - 1) | same(x, k + 1)), lambda x: x["i"]))

    pairs = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.struct(F.concat_ws(" ", *window_at(i)).alias("w"), i.alias("i")))
    return let(F.array_sort(pairs), runs)


def _n_repeat_words(words: Column) -> Column:
    """Words inside three-word windows that occur at least twice in the text.

    Windows are sorted as one bigint each: 40 bits of a hash above 24 bits of position.
    Neighbours of equal hash are compared word by word; if any pair differs (a collision)
    or the text has 2^24 words, the windows' text is sorted instead, so counts are exact.
    """
    n = F.size(words)
    window_at = lambda i: (words[i], words[i + 1], words[i + 2])
    place = lambda x: x.bitwiseAND(F.lit(POSITION)).cast("int")

    def runs(s: Column) -> Column:
        # neighbours in sorted order with the same hash; the last has no successor (null)
        twin = lambda x, y: F.when(F.shiftright(x.bitwiseXOR(y), 24) == 0, F.struct(place(x).alias("a"), place(y).alias("b")))

        def checked(pairs: Column) -> Column:
            equal = lambda i, j: (words[i] == words[j]) & (words[i + 1] == words[j + 1]) & (words[i + 2] == words[j + 2])
            collided = F.exists(pairs, lambda p: ~equal(p["a"], p["b"]))
            starts = F.array_sort(F.array_distinct(F.concat(pairs["a"], pairs["b"])))
            return F.when(collided, _covered(_repeats_by_text(words, window_at))).otherwise(_covered(starts))

        return let(F.array_compact(F.zip_with(s, F.slice(s, 2, n), twin)), lambda pairs: F.when(F.size(pairs) == 0, F.lit(0)).otherwise(checked(pairs)))

    packed = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(*window_at(i)).bitwiseAND(F.lit(~POSITION)).bitwiseOR(i.cast("long")))
    fast = let(F.sort_array(packed), runs)
    exact = _covered(_repeats_by_text(words, window_at))
    return F.when(n < 3, F.lit(0)).when(n <= POSITION, fast).otherwise(exact).cast("long")


def measures(text: Column, stop_words: list[str] | tuple[str, ...] = tuple(STOP_WORDS)) -> Column:
    """Struct of the counts that rules refer to, for a text (null counts as empty)."""
    text = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(text, SPACE, -1), "")
    stop = sorted(set(stop_words))

    def counts(w: Column) -> Column:
        lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
        return let(lines, lambda ls: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
            (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
            _n_repeat_words(w).alias("n_repeat_words"),
            F.size(ls).cast("long").alias("n_lines"),
            F.size(F.filter(w, lambda x: F.lower(x).isin(stop))).cast("long").alias("n_stop_words"),
        ))

    return let(words, counts)


def _passes(rule: Rule, m: Column) -> Column:
    """Integer-safe form: no division, so an empty text divides nothing."""
    top = m[rule.numerator].cast("double")
    base = m[rule.denominator].cast("double") if rule.denominator else F.lit(1.0)
    ok = F.lit(True)
    if rule.least is not None:
        ok = ok & (top >= F.lit(float(rule.least)) * base)
    if rule.most is not None:
        ok = ok & (top <= F.lit(float(rule.most)) * base)
    return ok


def verdict(m: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Struct of base_failed, kept and the names of the rules that a text fails."""
    base = (m["n_words"] < 50) | (100 * m["n_repeat_words"] > 50 * m["n_words"])
    failed = F.array_compact(F.array(*[F.when(~_passes(r, m), F.lit(r.name)) for r in rules]))
    return let(failed, lambda f: F.struct(base.alias("base_failed"), (~base & (F.size(f) == 0)).alias("kept"), f.alias("failed_rules")))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, the counts, base_failed, kept and failed_rules for every row of ``docs``."""
    both = let(measures(F.col(text_col)), lambda m: F.struct(m.alias("m"), verdict(m, rules).alias("v")))
    return docs.select(F.col(id_col).alias("doc_id"), both.alias("_q")).select(
        "doc_id", *[F.col(f"_q.m.{c}") for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words")],
        "_q.v.base_failed", "_q.v.kept", "_q.v.failed_rules")


def keep_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that every rule keeps, with all their columns and no others."""
    return docs.filter(let(measures(F.col(text_col)), lambda m: verdict(m, rules)["kept"]))


def oracle_sql(rules: tuple[Rule, ...] = RULES, stop_words: list[str] | tuple[str, ...] = tuple(STOP_WORDS)) -> str:
    """The same table by unnesting words and grouping windows (DuckDB)."""
    stop = ", ".join("'" + w + "'" for w in sorted(set(stop_words)))
    sides = []
    for r in rules:
        base = f"CAST({r.denominator} AS DOUBLE)" if r.denominator else "1.0"
        if r.least is not None:
            sides.append((r.name, f"CAST({r.numerator} AS DOUBLE) >= CAST({float(r.least)} AS DOUBLE) * {base}"))
        if r.most is not None:
            sides.append((r.name, f"CAST({r.numerator} AS DOUBLE) <= CAST({float(r.most)} AS DOUBLE) * {base}"))
    by_rule: dict[str, list[str]] = {}
    for name, side in sides:
        by_rule.setdefault(name, []).append(side)
    failed = ", ".join(f"CASE WHEN NOT ({' AND '.join(s)}) THEN '{name}' END" for name, s in by_rule.items())
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
split AS (SELECT rid, [x for x in string_split_regex(text, '[\\x20\\x09-\\x0D]+') if x <> ''] AS ws,
                 [x for x in string_split(text, chr(10)) if regexp_matches(x, '[^\\x20\\x09-\\x0D]')] AS ls FROM d),
words AS (SELECT rid, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM split),
tri AS (SELECT rid, i, w || ' ' || lead(w) OVER p || ' ' || lead(w, 2) OVER p AS t FROM words WINDOW p AS (PARTITION BY rid ORDER BY i)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, t) AS c FROM tri WHERE t IS NOT NULL) WHERE c > 1),
cov AS (SELECT rid, count(DISTINCT i + k) AS n FROM rep, (VALUES (0), (1), (2)) AS o(k) GROUP BY rid),
st AS (SELECT rid, count(*) AS n FROM words WHERE lower(w) IN ({stop}) GROUP BY rid),
m AS (SELECT d.doc_id, CAST(len(s.ws) AS BIGINT) AS n_words,
             CAST(length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(s.ls) - len(list_distinct(s.ls)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words, CAST(len(s.ls) AS BIGINT) AS n_lines,
             CAST(coalesce(st.n, 0) AS BIGINT) AS n_stop_words
      FROM d JOIN split s USING (rid) LEFT JOIN cov USING (rid) LEFT JOIN st USING (rid)),
v AS (SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
             [x for x in [{failed}] if x IS NOT NULL] AS f FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_stop_words, base_failed,
       (NOT base_failed AND len(f) = 0) AS kept, array_to_string(f, ',') AS failed_rules
FROM v"""
