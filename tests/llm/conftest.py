import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
                   StructField("source", StringType()), StructField("n_chars", LongType())])
ITEMS = StructType([StructField("item_id", LongType()), StructField("text", StringType())])
LABELS = StructType([StructField("doc_id", LongType()), StructField("quality", LongType()), StructField("toxic", LongType())])


@pytest.fixture()
def docs(spark):
    """docs(rows): a documents table from (doc_id, text[, lang[, source]])."""
    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s0", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCS)
    return make
