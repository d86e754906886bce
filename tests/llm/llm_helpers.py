"""Helpers of the tests in this folder."""

import numpy as np
import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture
def frame(spark):
    return spark.createDataFrame


def auc(scores, labels):
    s, y = np.asarray(scores), np.asarray(labels)
    rank = s.argsort(kind="stable").argsort()
    return (rank[y == 1].mean() - rank[y == 0].mean()) / len(y) + 0.5
