import pytest
from pyspark.sql import types as T

DOCUMENT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture
def documents(spark):
    """Rows ``(doc_id, text)`` or ``(doc_id, text, lang, source)`` as a table of documents."""

    def make(rows, extra=()):
        full = [(r[0], r[1], *(r[2:] or ("en", "web")), None if r[1] is None else len(r[1])) for r in rows]
        frame = spark.createDataFrame(full, DOCUMENT).repartition(3)
        for name in extra:  # columns that an operator might use itself
            frame = frame.withColumn(name, frame["n_chars"])
        return frame

    return make
