import random

import corpus_pipeline
import pytest
from conftest import DATA
from helpers import documents
from test_toxicity import corpus

import __spark_entry__ as entry_module
from barloom.llm import bpe, queries
from barloom.llm.tables import table

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def test_registered():
    names = entry_module.queries()
    assert set(queries.QUERIES) | {"pipeline"} <= set(names)
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(queries.ORACLE) <= set(entry_module.oracle_sql())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "mixing", "bpe"]


def made(tmp_path, spark, rows, labels):
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_stages_one_by_one(spark, tmp_path):
    docs, labels = corpus(400, random.Random(4))
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t, _ in docs]
    rows += [(1000 + i, rows[i][1] + " tail", "en", None, 0) for i in range(0, 60, 3)]
    rows += [(2000, None, None, None, None), (2001, "", "en", "s0", 0), (None, "a b c", None, "s1", 5)]
    folder = made(tmp_path, spark, rows, [(i, 1, t) for i, t in labels])
    given = table(spark, folder, "documents")
    kept = corpus_pipeline.drop_toxic(spark, given, folder)
    assert kept.columns == given.columns
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    toxic = {i for i, t in labels if t}
    assert len(ids & toxic) <= 0.1 * len(toxic) and len(ids - toxic) >= 0.98 * (len(rows) - len(toxic))
    single = corpus_pipeline.drop_near_duplicates(spark, given, folder)
    left = sorted((r.doc_id for r in single.select("doc_id").collect()), key=str)
    long_enough = {i for i, t, _ in docs if len(t.split()) >= 20}
    assert not {1000 + i for i in range(0, 60, 3) if i in long_enough} & set(left)
    assert set(range(400)) <= set(left) and {2000, 2001, None} <= set(left)
    mixed = corpus_pipeline.mix_sources(spark, given, folder)
    assert mixed.columns == given.columns
    assert mixed.groupBy("doc_id").count().agg({"count": "max"}).first()[0] <= 2
    encoded = corpus_pipeline.encode_texts(spark, given, folder).collect()
    own = bpe.vocabulary(queries.BPE_FILE)
    by_id = {r[0]: r[1] for r in rows}
    assert all(bytes(r.ids) == own.encode([by_id[r.doc_id]])[0] for r in encoded)


def test_whole_run_repeats_itself(spark):
    first, second = (sorted((r.doc_id, r.n_tokens) for r in corpus_pipeline.run(spark, DATA).collect()) for _ in range(2))
    assert first == second and 0 < len({i for i, _ in first}) < 200


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None)]])
def test_empty_tables(spark, tmp_path, rows):
    folder = made(tmp_path, spark, rows, [])
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_clashing_columns_stay(spark, tmp_path):
    folder = made(tmp_path, spark, [], [])
    docs = documents(spark).selectExpr("*", "'en' as lang", "1 as n_chars", "2 as score", "3 as passages", "4 as _0", "5 as kept", "6 as _copies", "7 as _id", "8 as c0", "9 as copies", "10 as rate", "11 as named")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns
        assert out.select("_copies", "_id", "c0", "rate").distinct().collect() == [(6, 7, 8, 10)]
