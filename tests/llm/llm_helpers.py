"""Fixtures of the training-data tests."""

import pytest

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def docs(spark):
    """Makes documents from (id, text) pairs, with columns that clash with those that operators add."""

    def make(*pairs):
        rows = [(i, t, 7, "x", True) for i, t in pairs]
        return spark.createDataFrame(rows, "doc_id bigint, text string, n_lines int, kept string, score boolean").repartition(2)

    return make
