import os

import pytest

from tests.llm.util import edge_rows


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Documents with nulls, empty and long texts, copies, repeated rows and clashing column names."""
    return spark.createDataFrame(edge_rows(), "doc_id long, text string, slot string, n_lines string, kept string, version string")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string")


@pytest.fixture(scope="session")
def small_dir():
    return "/root/testdata/sf0.001" if os.path.isdir("/root/testdata/sf0.001") else pytest.skip("no test data")
