"""Small tables with nulls, empty and long texts, repeated rows, ties and clashing column names."""

from pyspark.sql import types as T

EDGE = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()), T.StructField("kept", T.StringType()), T.StructField("n_words", T.StringType()), T.StructField("fp", T.StringType()),
    T.StructField("label", T.StringType()), T.StructField("h__", T.StringType()), T.StructField("row__", T.StringType()), T.StructField("masked", T.StringType()),
])
PROSE = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(80))
TEXTS = [
    (1, PROSE), (1, PROSE), (2, PROSE.upper()), (3, PROSE + " one more"), (4, None), (5, ""), (6, " \t\n"), (None, "a text without an id"), (None, None),
    (7, "x" * 30_000 + " " + "ab!" * 9_000), (8, "many " * 12_000), (9, "mail a.b@mail1.example.com or +1 (555) 555-1234, card 4111 1111 1111 1111, host 10.0.0.1"),
    (9, "the same id, another text"), (10, "“zwei”  Wörter\r\n\r\n三 个字 <|endoftext|> 's we'll"), (11, "### *** %%% &&& $$$ || <> ###"),
]


def docs(spark, rows=TEXTS):
    filler = ("en", "src", 0, "k", "w", "f", "l", "h", "r", "m")
    return spark.createDataFrame([(i, t, *filler) for i, t in rows], EDGE)


def empty(spark):
    return spark.createDataFrame([], EDGE)
