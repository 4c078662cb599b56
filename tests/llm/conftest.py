import pytest
from pyspark.sql import types as T

# Texts that every operator has to take: null, empty, blank, ties, repeats, other scripts, a very long one.
TEXTS = [
    None, "", " \t\n", "one", "one two", "one two three", "One  TWO three", "one two three four five six",
    "Größe ÉTÉ ñandú über alles", "日本語 テキスト", "a b c", "!!! ??? 123 456",
    "Released under the MIT License. All rights reserved. mit license MIT LICENSE mit license",
    "licensed under the Apache License, Version 2.0 and the GNU General Public License, version 3.",
    "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore",
    "Xx lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et magna",
    "word " * 5000, "der die das und nicht ist ein eine zu den mit sich des auf für", "le la les et des en un une du que",
]


@pytest.fixture(scope="session")
def hostile(spark):
    """Documents with every odd text, repeated rows, null keys and columns named like results."""
    rows = [(i, t, ["en", "de", None][i % 3], ["a", "b", None][i % 3]) for i, t in enumerate(TEXTS)]
    rows += [rows[5], rows[5], (None, "one two three", "en", None), (None, None, None, None), (100, rows[16][1] + " x", "en", "a"),
             (101, rows[7][1], "fr", "z"), (102, rows[7][1] + " ", "fr", "z")]
    extra = [f"{r[0]}" for r in rows]
    names = ["found", "language", "lm", "kept", "cleaned", "main_text", "row_file", "row_index", "flag", "_metadata", "n_words"]
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                           *[T.StructField(n, T.StringType()) for n in names]])
    return spark.createDataFrame([(*r, *[x] * len(names)) for r, x in zip(rows, extra)], schema).repartition(3)


@pytest.fixture(scope="session")
def empty(hostile):
    return hostile.limit(0)


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
