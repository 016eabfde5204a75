import glob
import os

import duckdb
import pytest
from test_pairs import plain_components

import __spark_entry__ as entry
import corpus_pipeline
from patternscan.llm.frames import saved, shared_folder, table
from patternscan.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE"}


def test_all_operators_are_registered():
    names = [f"op{n}_" for n in range(1, 14)]
    found = entry.queries()
    assert all(any(k.startswith(n) for k in found) for n in names) and "pipeline" in found
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(SF_DIR + "/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    relation = con.sql(ORACLES[name])
    kinds = dict(zip(relation.columns, map(str, relation.types)))
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema} == kinds
    order = [relation.columns.index(c) for c in columns]
    want = sorted((tuple(r[i] for i in order) for r in relation.fetchall()), key=repr)
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr) == want


def test_pipeline_stages(spark):
    """Each stage's decisions take effect, and clean documents stay."""
    docs, folder = table(spark, SF_DIR, "documents"), shared_folder(spark)
    labels = {r.doc_id: r.quality for r in table(spark, SF_DIR, "labels").collect()}
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = saved(stage(spark, docs, SF_DIR), folder, name)
        assert after.schema == docs.schema
        ids = [r.doc_id for r in after.select("doc_id").collect()]
        assert len(ids) == len(set(ids))
        kept.append(set(ids))
        docs = after
    assert kept[1] <= kept[0] and kept[2] < kept[1] and kept[3] == kept[2]
    good = {k for k, q in labels.items() if q == 1} & kept[0]
    assert len(good - kept[1]) <= 0.03 * len(good)
    packed = corpus_pipeline.pack(spark, docs, SF_DIR)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == kept[3]


def test_near_duplicate_stage_equals_all_pairs(spark):
    docs = table(spark, SF_DIR, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    groups = plain_components(rows, 5, 80)
    assert len(set(groups.values())) < len(groups)
    kept = corpus_pipeline.near_duplicates(spark, docs, SF_DIR).select("doc_id").collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(groups.values()))


def test_pipeline_of_awkward_rows(spark, awkward, nothing):
    for docs in (awkward, nothing):
        folder = shared_folder(spark)
        for name, stage in corpus_pipeline.STAGES:
            after = saved(stage(spark, docs, SF_DIR), folder, name)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert after.columns == docs.columns
            docs = after


def test_pipeline_runs(spark):
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert rows and sum(r.length for r in rows if r.start == 0) > 0
