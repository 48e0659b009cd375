"""The operator queries against their SQL, and the others against brute force, on the provided tables."""

from collections import Counter

import duckdb
import pytest

from ridelake.llm import oracle, queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_equals_sql(sc, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "pages", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = queries.queries()[name](sc, SF)
    columns = sorted(df.columns)
    cursor = con.execute(oracle.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    want = Counter(tuple(r[names.index(c)] for c in columns) for r in cursor.fetchall())
    assert Counter(tuple(r[c] for c in columns) for r in df.collect()) == want


def test_held_out_toxicity(sc):
    labels = {r.doc_id: r.toxic for r in sc.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    rows = queries.op2_toxicity(sc, "/root/testdata/sf0.1").collect()
    judged = Counter((r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels)
    assert judged[1, 1] / (judged[1, 1] + judged[0, 1]) > 0.8
    assert judged[1, 0] / (judged[1, 0] + judged[0, 0]) < 0.02
