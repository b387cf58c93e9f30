"""Small tables and plain restatements for the tests of this folder."""

import re

from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

# Nulls, empty, blank and unusual texts, repeated rows and ids, a null id, a very long text.
AWKWARD = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, "   \n\t ", "en", "a", 6),
    (4, "one", None, "b", 3),
    (5, "One two three four five six seven eight nine ten", "en", None, 48),
    (5, "One two three four five six seven eight nine ten", "en", None, 48),
    (6, "one TWO three, four five six seven eight nine ten!", "en", "c", 50),
    (7, "Größe – naïve café 日本語 😀 Ωμέγα", "de", "c", 30),
    (None, "a row without an id but with some text", "en", "c", 38),
    (None, None, None, None, None),
    (8, "!!! ### $$$", "en", "c", 11),
    (9, "12345 678", "en", "c", 9),
    (10, "long words and lines of text " * 20_000, "en", "c", 580_000),
    (11, "x" * 300_000, "en", "c", 300_000),
]


def documents(spark, rows=AWKWARD):
    """The rows over several partitions."""
    return spark.createDataFrame(rows, DOCUMENTS).repartition(3)


def texts(spark, values):
    return documents(spark, [(i, t, "en", "s", len(t or "")) for i, t in enumerate(values)])


def words(text):
    return _WORD.findall((text or "").translate(_LOWER))
