"""The operators whose result SQL can state, against it on the smallest test tables."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))
pytest.importorskip("duckdb")

import compare  # noqa: E402

from siltstone.llm.queries import oracle_sql  # noqa: E402

FOLDER = compare.contract.SMOKE_DIR
if not Path(FOLDER).exists():
    pytest.skip("test tables are not here", allow_module_level=True)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query(spark, name):
    assert ": ok" in compare.compare(spark, compare.connection(FOLDER), name, FOLDER)
