"""Every registered query against its SQL twin on the smallest test tables."""

from pathlib import Path

import pytest

from workload.compare import compare, duck
from workload.oracles import ORACLES
from workload.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    same, note = compare(spark, con, FOLDER, name)
    assert same, note
