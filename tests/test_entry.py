import importlib.util
import os

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="module")
def entry_mod():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    m = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(m)
    return m


def test_entry_runs(spark, entry_mod):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert df.columns == entry_mod.entry(spark).columns


def test_oracle_keys_are_queries(entry_mod):
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 100


def test_every_query_has_a_docstring():
    from riskpanel.catalog import REGISTRY
    assert all(e.doc for e in REGISTRY.values())
