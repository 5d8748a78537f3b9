import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from edge_rows import EDGE_ROWS  # noqa: E402

#: Extra columns, named like the operators' own.
EXTRA = ", keep_id string, row string, sequence_id string, score string, component_id string, digest string, token string"


@pytest.fixture(scope="session")
def edge(spark):
    rows = [(i, t, *["x"] * 7) for i, t in EDGE_ROWS]
    return spark.createDataFrame(rows, "doc_id long, text string" + EXTRA).repartition(3)


@pytest.fixture(scope="session")
def nothing(edge):
    return edge.where("false")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
