"""Every registered query against its SQL, on the smallest tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

from check_oracle import compare, connect  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_keys():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, duck, name):
    verdict = compare(entry.queries()[name](spark, SF), duck, entry.oracle_sql().get(name))
    assert verdict.startswith("ok") or verdict == "EMPTY", verdict
