import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from tests.llm.test_texts import brute_lines

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], COLUMNS)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Labelled documents, a fifth of them toxic, and a few without label, null or empty."""
    d = str(tmp_path_factory.mktemp("tables"))
    rows = [(k, ("idiot " if k % 5 == 0 else "kind ") + f"word number {k} and stone {k * 7} in line") for k in range(400)]
    docs = documents(spark, [*rows, (1000, "an 1d10t again"), (1001, "all is well"), (1002, None), (1003, "")])
    docs.write.parquet(f"{d}/documents.parquet")
    labels = [(k, int(k % 5 == 0)) for k, _ in rows]
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{d}/labels.parquet")
    return d


def test_toxic_documents_go(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    left = {r["doc_id"] for r in pipeline.drop_toxic(spark, docs, tables).collect()}
    assert left == {k for k in range(400) if k % 5} | {1001, 1002, 1003}


def test_line_stage(spark):
    long = "a line of more than forty characters, which is near another"
    rows = [(1, f"{long}\nx"), (2, long.replace("forty", "forte")), (3, "x"), (4, "x\ny"), (6, "")]
    docs = documents(spark, [*rows, (5, None)])
    found = {r["doc_id"]: (r["text"], r["n_chars"]) for r in pipeline.dedup_lines(spark, docs, "").collect()}
    brute = {d: (t, len(t)) for d, t in brute_lines(rows, 2, 20).items() if t or d == 6}
    assert found == {**brute, 5: (None, 0)} and set(found) == {1, 4, 5, 6}


def test_document_and_mixing_stages(spark):
    words = [f"w{k}" for k in range(100)]
    near = [*words[:99], "other"]
    docs = documents(spark, [(1, " ".join(words)), (2, " ".join(near)), (3, " ".join(words)), (4, "else"), (5, None)])
    left = pipeline.dedup_documents(spark, docs, "")
    assert sorted(r["doc_id"] for r in left.collect()) == [1, 4, 5]
    mixed = pipeline.mix_sources(spark, left, "")
    assert mixed.columns == list(pipeline.COLUMNS) and mixed.where(F.col("doc_id").isin(1, 4, 5)).count() == mixed.count()


def test_run_and_empty_tables(spark, tables):
    rows = pipeline.run(spark, tables).collect()
    assert rows and all(r["doc_id"] % 5 or r["doc_id"] > 1000 for r in rows)
    docs = spark.read.parquet(f"{tables}/documents.parquet").where("false")
    for _, stage in pipeline.STAGES:
        out = stage(spark, docs, tables)
        assert out.count() == 0
