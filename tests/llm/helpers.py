"""Small tables with every odd case: nulls in any column, empty and very long
texts, ties, repeated rows, and extra columns with names the operators use."""

import random

from pyspark.sql import functions as F

#: Names that operators use for columns of their own.
CLASHES = ["_row", "_fp", "fp", "row", "root", "key", "t1", "t2", "_t1", "_t2", "_spans", "spans", "ids", "length", "piece", "start",
           "_language", "_toxic", "_repeats", "result", "anchor", "score", "label", "node", "k", "n", "r", "h", "id", "offset", "sequence_id", "a.b", "a b"]

WORDS = "the of and to in that is was for it with as his on be at by had not are but from or have an they which one you were".split()


def prose(seed, n=120):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(["", "", "", "ing", "er", "."]) + r.choice(["", "", str(r.randint(0, 99))]) for _ in range(n))


LONG = prose(99, 30_000)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows():
    t = [(1, prose(1), "en"), (2, prose(2), "en"), (3, prose(1), "en"), (4, None, "en"), (5, "", None), (6, "   \n\t ", "en"),
         (7, "12345 !!", None), (8, "Ein Straßenschild über den Bäumen und die Häuser der Stadt", "de"), (None, prose(3), "en"),
         (None, None, None), (9, LONG, "en"), (10, prose(2), None), (10, prose(2), None), (11, "one", "en"), (12, "\x1c a\x1fb", "en"),
         (13, "日本語のテキスト", None), (14, "𝒳𝒴 emoji 😀 text", "en")]
    return [(a, b, c, None if a == 3 else "s0", len(b) if b else None) for a, b, c in t]


def odd(spark, clash=True):
    d = spark.createDataFrame(rows(), SCHEMA)
    if clash:
        for i, c in enumerate(CLASHES):
            d = d.withColumn(c, F.when(F.col("doc_id") != 2, F.lit(i)))
    return d


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def write(spark, folder, **tables):
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return folder
