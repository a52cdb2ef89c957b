"""The pipeline as a whole on tables that hold everything odd, and on none."""

import corpus_pipeline
from tests.conftest import SF


def folder_of(docs, labels, path):
    docs.write.parquet(f"{path}/documents.parquet")
    labels.write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_run_on_odd_rows(spark, odd, tmp_path):
    labels = spark.createDataFrame([(4, 1, 0), (6, 0, 0), (None, None, None), (4, 1, 0)], "doc_id long, quality int, toxic int")
    rows = corpus_pipeline.run(spark, folder_of(odd, labels, tmp_path)).collect()
    ids = {r["doc_id"] for r in rows}
    # Short and repetitive texts go, of the equal ones one stays, and rows without an id all do.
    assert ids == {None, 6}
    assert all(r["restored"] and r["n_tokens"] == len(r["ids"]) for r in rows)


def test_run_on_empty_tables(spark, odd, tmp_path):
    labels = spark.read.parquet(f"{SF}/labels.parquet").limit(0)
    assert corpus_pipeline.run(spark, folder_of(odd.limit(0), labels, tmp_path)).count() == 0
