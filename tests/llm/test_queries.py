"""Queries that SQL can express, on the given tables."""

import duckdb
import pytest
from conftest import DATA

from barloom.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        con.execute(f"create view {table} as select * from '{DATA}/{table}.parquet'")
    frame = queries.QUERIES[name](spark, DATA)
    cursor = con.execute(queries.ORACLE[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(frame.columns) == sorted(columns)
    expected = sorted(cursor.fetchall(), key=str)
    assert sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=str) == expected


def test_every_document_has_its_row(spark):
    documents, pages = (spark.read.parquet(f"{DATA}/{t}.parquet").count() for t in ("documents", "pages"))
    for name, rows in (("op1_bpe", documents), ("op2_sharding", documents), ("op4_token_counts", documents), ("op7_html_text", pages)):
        assert queries.QUERIES[name](spark, DATA).count() == rows
