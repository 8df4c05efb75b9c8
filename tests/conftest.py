import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))

from cellweave.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("8", app="cellweave-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(params=[2, None])
def both_ways(request, monkeypatch):
    """Run a test with two ranges, and with as many as the session asks for."""
    from cellweave.operators import ordering

    if request.param:
        monkeypatch.setattr(ordering, "range_count", lambda df: request.param)
    return request.param


@pytest.fixture(scope="session")
def tiny(spark):
    """Five cells, six genes: a cell and a gene without counts, a tie and a hot gene."""
    x = spark.createDataFrame(
        [("c1", "g1", 5.0), ("c1", "g2", 1.0), ("c2", "g1", 5.0), ("c2", "g3", 2.0), ("c3", "g1", 1.0), ("c3", "g2", 3.0),
         ("c3", "g4", 9.0), ("c4", "g1", 2.0), ("c4", "g5", 2.0)],
        "cell_id string, gene string, value double",
    )
    obs = spark.createDataFrame(
        [("c1", "s1", "a"), ("c2", "s1", "a"), ("c3", "s2", "b"), ("c4", "s2", "b"), ("c5", "s2", None)],
        "cell_id string, sample string, label string",
    )
    var = spark.createDataFrame(
        [("g1", "mt-A"), ("g2", "B"), ("g3", "B"), ("g4", "C"), ("g5", "MT-D"), ("g6", "B")], "gene string, gene_name string"
    )
    return x, obs, var
