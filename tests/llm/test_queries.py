"""Every query runs over its whole table; those with SQL match it."""

import pytest

from clickfeat.llm import queries
from conftest import SF_SMALL


def test_names_and_entry():
    import importlib.util
    import os

    from conftest import ROOT
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    m = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(m)
    names = set(m.queries())
    assert set(queries.QUERIES) <= names and "pipeline" in names
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert set(queries.ORACLE) <= set(m.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_matches_duckdb(spark, name):
    from tools_oracle_check import duck, norm
    got = queries.QUERIES[name](spark, SF_SMALL)
    res = duck(SF_SMALL).execute(queries.ORACLE[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(got.columns)
    a = sorted((tuple(norm(r[c]) for c in cols) for r in got.collect()), key=repr)
    assert a == sorted((tuple(norm(x) for x in r) for r in res.fetchall()), key=repr)
