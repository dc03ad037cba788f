import pytest
from pyspark.sql import types as T


@pytest.fixture(scope="module")
def documents(spark):
    """Builds a table of documents; every column of the operators' own is there too, to clash."""
    extra = ["node", "at", "sha", "key", "part", "score", "length", "ids", "bands", "label", "root", "digest", "draw"]
    schema = T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
        + [T.StructField(c, T.StringType()) for c in ["lang", "source", *extra]]
    )

    def build(rows):
        return spark.createDataFrame([(i, t, "en", "s", *extra) for i, t in rows], schema)

    return build


LONG = "The quick brown fox jumps over the lazy dog while seventeen small birds sing about rivers and hills, again. "


@pytest.fixture(scope="module")
def odd_rows():
    """Nulls, empty and long texts, repeated rows and ids, odd marks and white space."""
    return [
        (1, "plain words here, and a few more."),
        (2, None),
        (3, ""),
        (4, "   \n\t "),
        (None, "a text without an id " * 9),
        (5, LONG * 3),
        (6, LONG * 3),
        (6, LONG * 3),
        (6, "another text of the same id"),
        (7, "x" * 30_000),
        (8, "Der " * 3000),
        (9, "it's I'LL we'd <|endoftext|> a<|startoftext|>b 　\x1c!\x1c tab\there"),
        (10, "é é İstanbul ΑΣ Ā́ 漢字 😀 ½ ₂ ١٢"),
        (11, LONG + "unlike the rest of it, this one goes on about something else entirely and ends " + LONG),
        (12, "� bad �"),
    ]
