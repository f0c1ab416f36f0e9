import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from brute import DOCS, edge_docs


@pytest.fixture(scope="session")
def awkward(spark):
    """Awkward documents with two extra columns whose names clash with outputs, over several partitions."""
    return spark.createDataFrame(edge_docs(), DOCS).selectExpr("*", "'x' AS copy", "1 AS n_words").repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)
