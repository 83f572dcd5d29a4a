from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from visitflow.spark import local_session

    s = local_session("*", shuffle_partitions=8, app="visitflow-tests")
    yield s
    s.stop()


def lines_df(spark, lines):
    """Text lines as ``read_lines`` produces them (value + log_order)."""
    rows = [(v, i) for i, v in enumerate(lines)]
    return spark.createDataFrame(rows, "value string, log_order long")
