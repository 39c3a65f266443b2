"""Every registered query against its DuckDB oracle on the smallest data set."""

import pytest

import __spark_entry__ as E
from tools.check_oracle import compare, duck_connect

SF = "/root/testdata/sf0.001"
QUERIES = {name: fn for name, fn in E.queries().items() if name not in E.CORPUS_QUERIES}
SQLS = {name: sql for name, sql in E.oracle_sql().items() if name not in E.CORPUS_SQL}


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQLS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    n, problems = compare(spark, con, QUERIES[name], SQLS.get(name), SF)
    assert not problems, problems


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["taskid", "area", "areaLevel", "productid", "cityInfos", "clickCount", "productName",
                          "productStatus"]
