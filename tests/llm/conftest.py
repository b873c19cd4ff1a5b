import re

import pytest
from pyspark.sql import types as T

LONG = ("alpha beta gamma delta epsilon zeta eta theta iota kappa " * 4000).strip()


def words(text):
    """Words as the operators cut them: runs over 0x20, ASCII letters lowered."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x20]+", low)


def collected(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").cache()


@pytest.fixture(scope="session")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


@pytest.fixture(scope="session")
def odd(spark):
    """Null, empty, blank, long, tied and repeated rows, with extra columns
    whose names the operators use inside."""
    schema = T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
        + [T.StructField(n, T.StringType()) for n in ("_id", "_s", "_row", "_class", "node", "score", "SPANS", "_Language", "_secrets", "_leaks", "kept")]
    )
    a, b = "one two three four five six seven eight nine ten", "un deux trois quatre cinq six sept huit neuf dix"
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, LONG), (5, LONG), (6, a), (6, a), (7, a), (None, b), (None, None), (8, "1234 5678 !!"), (9, "mot"), (10, "mot"), (11, "\U0001f642 \U0001f642"), (12, "x" * 70000)]
    return spark.createDataFrame([(i, t, "en" if t and i and i % 2 else None, None, None, *["x"] * 11) for i, t in rows], schema).cache()
