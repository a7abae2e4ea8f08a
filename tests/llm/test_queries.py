"""The registered queries and the pipeline."""

from types import SimpleNamespace

import pyarrow as pa
import pytest

pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
from check import TABLES, compare  # noqa: E402
from srcsieve.llm import decontaminate, queries  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def test_thirteen_operators():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.Q) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_against_sql(spark, db, name):
    outcome = compare(spark, db, name, queries.Q[name], queries.SQL[name], SF)
    assert not outcome.startswith("FAIL"), outcome


def test_stages_work_on_what_the_one_before_kept(spark):
    docs = queries.table(spark, SF, "documents")
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    sizes = [len(before)]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        from srcsieve.session import materialise

        docs = materialise(stage(spark, docs, SF), "test-stage")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[1] < sizes[0] and sizes[-1] > 100
    kept = {r["doc_id"] for r in docs.collect()}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r["doc_id"] for r in packed.collect()} == kept
    benchmark = [" ".join(w.decode() for w in decontaminate.words_of(r["text"])) for r in queries.table(spark, SF, "benchmark").collect()]
    for row in docs.collect():
        text = " ".join(w.decode() for w in decontaminate.words_of(row["text"]))
        assert not any(item in text for item in benchmark)


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert len({r["doc_id"] for r in rows}) > 100


def test_stages_with_python_take_small_batches(spark, monkeypatch):
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    docs = spark.createDataFrame([(1, "one two three")], "doc_id long, text string")
    for stage in (corpus_pipeline.dedup_documents, corpus_pipeline.drop_leaks, corpus_pipeline.pack):
        spark.conf.set(setting, "10000")
        stage(spark, docs, SF)
        assert spark.conf.get(setting) == corpus_pipeline.BATCH_ROWS


def test_texts_of_a_batch_are_not_held_as_strings_together():
    held = []
    index = SimpleNamespace(value=SimpleNamespace(matches=lambda texts: held.append(isinstance(texts, list)) or []))
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["a", "b"])], names=["doc_id", "text"])
    assert [out.num_rows for out in decontaminate._finder(index)([batch])] == [0] and held == [False]
