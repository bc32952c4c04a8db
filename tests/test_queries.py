"""Every query of the catalog against its DuckDB twin; those without one must run and be stable in schema."""

from __future__ import annotations

import pytest
from oracle import same

from quillspark.plans import registry

QUERIES, ORACLES = registry.queries(), registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, sf_dir, name):
    same(QUERIES[name](spark, sf_dir), ORACLES[name], sf_dir)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, sf_dir, name):
    frame = QUERIES[name](spark, sf_dir)
    assert frame.columns and frame.count() >= 0


def test_names_are_taken_once():
    with pytest.raises(ValueError, match="twice"):
        registry.register("bm25_topk")(lambda *_: None)


def test_entry_imports():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
