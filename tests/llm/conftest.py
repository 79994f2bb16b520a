import pytest
from pyspark.sql import types as T

from shelfledger.llm.common import ship_code

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from (doc_id, text[, lang[, source]])."""
    ship_code(spark)

    def make(rows):
        full = [(*r, *[None] * (4 - len(r))) for r in rows]
        return spark.createDataFrame([(*r, len(r[1] or "")) for r in full], DOCS)

    return make
