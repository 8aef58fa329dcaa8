"""The five stages on small tables, nulls and repeats included."""

import os

import pytest

import corpus_pipeline
from ledgerlens.llm import simhash


@pytest.fixture(scope="module")
def folder(corpus, labels, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    corpus.write.parquet(os.path.join(path, "documents.parquet"))
    labels.write.parquet(os.path.join(path, "labels.parquet"))
    return path


def test_stages_keep_columns_and_their_work_takes_effect(spark, corpus, folder):
    docs = corpus
    for name, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, docs, folder)
        assert out.columns == corpus.columns and out.dtypes == corpus.dtypes, name
        rows = out.collect()
        assert rows, name
        docs = spark.createDataFrame(rows, corpus.schema)
    ids = [r.doc_id for r in docs.collect()]
    assert 0 in ids and 7 not in ids and ids.count(3) <= 1  # one of each group, one of repeated rows
    assert not {11, 12, 13, 14, 15} & set(ids)  # too few words, or one line again and again
    assert all(r.n_chars == len(r.text) for r in docs.collect() if r.doc_id is not None)


def test_texts_under_one_id_are_judged_each(spark, folder):
    prose = [" ".join(f"{k}w{i * i * k % 997}" for i in range(300)) for k in (3, 5, 7, 11)]
    near = [t + " end" for t in prose]
    rows = [(5, prose[0]), (5, prose[1]), (5, prose[1]), (5, prose[2]), (5, near[2]), (2, near[1]), (6, near[0]), (7, prose[3]), (8, near[2]), (None, prose[3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(((r.doc_id, r.text) for r in corpus_pipeline.simhash_near_dedup(spark, docs, folder).collect()), key=str)
    assert got == sorted([(5, prose[0]), (2, near[1]), (5, prose[2]), (7, prose[3]), (None, prose[3])], key=str)
    groups = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(spark, docs).collect()}
    assert groups == {(5, 5), (5, 2), (2, 2), (6, 5), (7, 7), (8, 5), (None, None)}


def test_run_and_empty_input(spark, folder, nothing):
    assert {"doc_id", "sequence_id", "offset", "ids_crc32"} <= set(corpus_pipeline.run(spark, folder).columns)
    for name, step in corpus_pipeline.STAGES:
        assert step(spark, nothing, folder).count() == 0, name


def test_registered():
    import __spark_entry__ as entry
    names = entry.queries()
    assert "pipeline" in names and {f"op{n}" for n in range(1, 11)} <= {x.split("_")[0] for x in names}


def test_oracle_of_top_scores(spark, sf):
    import duckdb

    import __spark_entry__ as entry
    import check
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    df = entry.queries()["op5_maxscore"](spark, sf)
    cursor = con.execute(entry.oracle_sql()["op5_maxscore"])
    assert check.compare((df.columns, [tuple(r) for r in df.collect()]), ([d[0] for d in cursor.description], cursor.fetchall())) is None
