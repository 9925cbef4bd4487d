import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()),
                   StructField("lang", StringType()), StructField("source", StringType()),
                   StructField("n_chars", LongType()), StructField("size", StringType()),
                   StructField("token", StringType())])


@pytest.fixture()
def docs(spark):
    """Rows (doc_id, text, lang, source) as documents, with two extra columns of clashing names."""
    return lambda rows: spark.createDataFrame(
        [(*r, None if r[1] is None else len(r[1]), "x", "y") for r in rows], DOCS)
