import pytest
from pyspark.sql import types as T

SMALL = "/root/testdata/sf0.001"

#: columns whose names the operators use themselves
EXTRA = ["kept", "h", "row", "n", "bucket", "stratum", "key", "node", "shard", "n_words", "comp", "t"]

LONG = " ".join(f"word{i % 977} of{i % 13}" for i in range(30000))
BASE = " ".join(f"alpha{i}" for i in range(100))
NEAR = " ".join(f"alpha{i}" if i != 50 else "changed" for i in range(100))
FAR = " ".join(f"beta{i}" for i in range(100))

ROWS = [
    (1, BASE, "en", "src0"), (2, BASE, "en", "src0"), (3, BASE.replace(" ", "\n"), "en", None),
    (4, NEAR, None, "src1"), (5, FAR, "de", "src1"), (5, FAR, "de", "src1"),
    (6, None, "en", "src0"), (7, "", "en", "src0"), (8, " \t\n ", None, None), (9, "one", "fr", "src2"),
    (10, "ONE", "fr", "src2"), (11, LONG, "en", "src0"), (12, LONG + " end", "en", "src0"),
    (13, "1234 !!! ...", "es", "src3"), (14, "x" * 70, "es", "src3"), (15, "x" * 70 + " y", "es", "src3"),
    (16, "é漢 <|endoftext|> Straße İ Σς", "de", "src2"), (17, "a\nb\nc\nd\ne\na\nb\nc\nd\nz", "en", "src0"),
    (18, "q\na\nb\nc\nd", "en", "src0"), (None, "no id here at all", None, None), (19, "the end " * 40, "en", "src0"),
]


def documents(spark, rows=ROWS, extra=True):
    fields = [("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()),
              ("n_chars", T.LongType())] + ([(e, T.StringType()) for e in EXTRA] if extra else [])
    schema = T.StructType([T.StructField(n, t) for n, t in fields])
    more = tuple("clash" for _ in EXTRA) if extra else ()
    return spark.createDataFrame([(i, t, lang, s, len(t or ""), *more) for i, t, lang, s in rows], schema).repartition(3)


@pytest.fixture(scope="session")
def edge(spark):
    return documents(spark)


@pytest.fixture(scope="session")
def empty(spark):
    return documents(spark, [])


@pytest.fixture(scope="session")
def small():
    import pandas as pd
    return pd.read_parquet(f"{SMALL}/documents.parquet").set_index("doc_id").text
