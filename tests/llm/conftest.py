import sys
from pathlib import Path

import pytest
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).resolve().parent))

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])


@pytest.fixture
def documents(spark):
    """A table of documents from (doc_id, text, lang, source), with further columns that clash with results."""

    def make(*rows):
        full = [(*r, *(None,) * (4 - len(r)), None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, DOCUMENTS)
        for name in ("id", "kept", "n_tokens", "mix", "cell", "rank", "block", "class"):
            df = df.selectExpr("*", f"'x' AS `{name}`")
        return df

    return make


def collected(df):
    return [r.asDict() for r in df.collect()]
