import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """Makes a documents table from (doc_id, text) or longer rows."""

    def make(rows):
        filled = []
        for row in rows:
            doc_id, text, lang, source = (*row, None, None)[:4]
            filled.append((doc_id, text, lang, source, len(text) if text is not None else None))
        return spark.createDataFrame(filled, DOCUMENTS).repartition(2)

    return make


@pytest.fixture
def clashing():
    """Adds columns whose names an operator might use itself."""

    def add(table):
        from pyspark.sql import functions as F

        for name in ("size", "score", "label", "hash", "row", "node", "key", "block", "shard", "spans", "ids"):
            table = table.withColumn(name, F.lit("own"))
        return table

    return add
