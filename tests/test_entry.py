import duckdb

import __spark_entry__ as E
from tessera.session import TABLES

SMALL = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert set(df.columns) == {"doc_id", "source", "coarse_similarity", "similarity"}
    assert df.count() == 5


def test_every_sql_key_is_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_sample_of_queries_match_duckdb(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    for key in ["keep_recent", "common_words", "knn_graph", "tree_nodes", "retrieve_two_stage", "describe", "flatten_records", "level_keywords"]:
        s = E.queries()[key](spark, SMALL)
        rel = con.sql(E.oracle_sql()[key])
        cols = sorted(s.columns)
        assert cols == sorted(rel.columns), key
        a = sorted(repr(tuple(r[c] for c in cols)) for r in s.collect())
        idx = [rel.columns.index(c) for c in cols]
        b = sorted(repr(tuple(r[i] for i in idx)) for r in rel.fetchall())
        assert a == b, key
