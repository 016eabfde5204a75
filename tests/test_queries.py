import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from patternscan.oracle import ORACLES
from patternscan.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
TYPES = {"bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(SF_DIR + "/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES) <= set(entry.queries())


def rounded(value):
    return round(value, 9) if isinstance(value, float) else value


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    relation = duck.sql(entry.oracle_sql()[name])
    assert sorted(relation.columns) == columns
    kinds = dict(zip(relation.columns, map(str, relation.types)))
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema} == kinds
    order = [relation.columns.index(c) for c in columns]
    want = [tuple(rounded(r[i]) for i in order) for r in relation.fetchall()]
    got = [tuple(rounded(r[c]) for c in columns) for r in df.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_entry(spark):
    assert entry.entry(spark).columns == ["lang", "rule_id", "n_matches"]
