"""Small tables with the awkward rows that every operator on texts must take."""

from pyspark.sql import types as T

PROSE = ("The river and the hills lie in the north of the country and people come to see them. "
         "It was a long walk to the village, but we had bread with us and the weather was on our side. "
         "Nobody in the house knew that the letter from the old man had been on the table for a week. ")
LONG = " ".join(f"word{i % 977} the" for i in range(30_000))

TEXTS = [
    (1, PROSE), (2, None), (3, ""), (4, " \t\n \x0b"), (5, LONG), (6, "a"), (7, PROSE), (7, PROSE),
    (8, "Ünïcödé ﬁ ß 日本語 😀 é <|endoftext|> 12 3.4"), (9, "x" * 70_000), (None, "no id " * 20), (10, "$$$ *** ### |" * 30), (11, "same line\n" * 40),
]


def documents(spark, rows=TEXTS):
    """doc_id and text beside columns that are named like the operators' own."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                           T.StructField("score", T.StringType()), T.StructField("n_words", T.IntegerType()), T.StructField("lettered", T.IntegerType()),
                           T.StructField("row_key", T.IntegerType()), T.StructField("uid", T.StringType()), T.StructField("kept", T.StringType())])
    return spark.createDataFrame([(i, t, None, "s", 1, 2, 3, "u", "k") for i, t in rows], schema)


def plain(rows, *columns):
    """Rows as sorted tuples; None sorts first."""
    out = [tuple(r[c] for c in columns) for r in rows]
    return sorted(out, key=lambda r: tuple((x is not None, x) if not isinstance(x, list) else (True, tuple(x)) for x in r))
