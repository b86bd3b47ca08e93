"""Every registered query against its reference SQL on the smallest test tables."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))
duckdb = pytest.importorskip("duckdb")

import compare  # noqa: E402

from siltstone.plans import oracle, registry  # noqa: E402

FOLDER = compare.contract.SMOKE_DIR
if not Path(FOLDER).exists():
    pytest.skip("test tables are not here", allow_module_level=True)


@pytest.fixture(scope="module")
def connection():
    return compare.connection(FOLDER)


def test_names_agree():
    assert set(oracle.statements()) == set(registry.queries())
    assert set(compare.contract.oracle_sql()) <= set(compare.contract.queries())


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, connection, name):
    assert ": ok" in compare.compare(spark, connection, name, FOLDER)
