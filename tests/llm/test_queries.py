"""Registered queries and the pipeline at the smallest size."""

import sys
from pathlib import Path

import pytest

import corpus_pipeline
from millrace.llm import queries

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
from check_oracle import connect, difference  # noqa: E402
from texts import frame, odd_texts  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    got = queries.QUERIES[name](spark, FOLDER).toPandas()
    assert difference(got, connect(FOLDER).execute(queries.ORACLE_SQL[name]).fetchdf()) is None


def test_names():
    assert [int(n.split("_")[0][2:]) for n in queries.QUERIES] == list(range(1, 14))


def test_stages_keep_columns(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    left = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER).cache()
        assert out.schema.names == docs.schema.names, name
        assert 0 < out.count() <= left
        docs, left = out, out.count()
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.select("doc_id").collect()}
    run = corpus_pipeline.run(spark, FOLDER)
    assert run.select("doc_id", "piece", "ids_crc32").exceptAll(pieces.select("doc_id", "piece", "ids_crc32")).count() == 0
    assert run.count() == pieces.count()


@pytest.fixture
def odd_tables(spark, tmp_path):
    """Tables with null, empty, long and repeated rows and a further column;
    ``small`` leaves benchmark and labels empty."""

    def make(small):
        texts = odd_texts(11)
        ids = [None, *range(1, len(texts) - 2), 5, 5]
        frame(spark, texts + [texts[12]], ids + [12]).write.parquet(f"{tmp_path}/documents.parquet")
        marks = [(i, i % 2, i % 3 == 0) for i in range(1, 40)] + [(None, 1, True), (3, None, None)]
        spark.createDataFrame([] if small else [(i, q, int(t or 0)) for i, q, t in marks], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
        items = [(1, texts[20]), (2, None), (None, texts[21]), (3, "")]
        spark.createDataFrame([] if small else items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
        return str(tmp_path)

    return make


@pytest.mark.parametrize("small", [False, True])
def test_pipeline_over_odd_rows(spark, odd_tables, monkeypatch, small):
    monkeypatch.setattr(queries, "ACCEPTED", 0.0)  # the classifier lets all through, so that the other stages see them
    folder = odd_tables(small)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns, name
        docs = spark.createDataFrame(out.collect(), docs.schema)
    ids = [r.doc_id for r in docs.collect()]
    assert ids.count(5) <= 1 or len({r.text for r in docs.where("doc_id = 5").collect()}) == ids.count(5)
    if not small:
        assert not {20} & set(ids)
    run = corpus_pipeline.run(spark, folder)
    assert {r.doc_id for r in run.select("doc_id").distinct().collect()} == set(ids)


def test_pipeline_of_no_documents(spark, tmp_path):
    frame(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
