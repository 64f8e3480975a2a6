import pytest
from pyspark.sql import types as T

from tallywell.llm.common import reach_workers

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        # names that operators use themselves
        *(T.StructField(n, T.StringType()) for n in ("t", "d", "n", "c", "row", "fingerprint", "anchor", "spans", "bucket")),
    ]
)


@pytest.fixture(autouse=True)
def workers(spark):
    reach_workers(spark)


@pytest.fixture
def docs(spark):
    def make(*rows, parts=3):
        """Rows of doc_id, text and optionally lang; with columns whose names clash."""
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", *"abcdefghi") for r in rows]
        df = spark.createDataFrame(full, DOCS)
        return df.repartition(parts) if rows else df

    return make


