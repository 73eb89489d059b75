"""Driver contract and registry sanity."""

import importlib.util
import os

from conftest import ROOT, SF_SMALL


def load_entry():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    m = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(m)
    return m


def test_entry_runs(spark):
    m = load_entry()
    df = m.entry(spark)
    assert df.count() > 0
    assert "match_feature" in df.columns and "label" in df.columns


def test_oracle_keys_are_queries():
    m = load_entry()
    q, o = m.queries(), m.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 80


def test_every_query_builds_on_smallest_scale(spark):
    """Every registered query plans and runs over the whole sf0.001 tables."""
    m = load_entry()
    for name, fn in m.queries().items():
        if name.startswith(("lr_", "gbt_")):
            continue   # fits are covered in test_models
        df = fn(spark, SF_SMALL)
        df.write.format("noop").mode("overwrite").save()


def test_every_query_is_in_the_readme_inventory():
    m = load_entry()
    readme = open(os.path.join(ROOT, "README.md"), encoding="utf-8").read()
    assert [q for q in m.queries() if f"`{q}`" not in readme] == []
