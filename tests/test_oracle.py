"""Every registered query against its SQL on the smallest tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import check  # noqa: E402
import workload  # noqa: E402


@pytest.fixture(scope="module")
def connection(sf_dir):
    return check.connect(sf_dir)


def test_every_query_has_sql():
    assert set(workload.queries()) == set(workload.oracle_sql())


@pytest.mark.parametrize("name", sorted(workload.queries()))
def test_query(spark, connection, sf_dir, name):
    df = workload.queries()[name](spark, sf_dir)
    problems = [p for p in check.compare(df, connection, workload.oracle_sql()[name]) if p != "empty result"]
    assert not problems, "\n".join(problems)
