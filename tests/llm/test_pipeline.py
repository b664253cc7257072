"""The pipeline's stages one after another."""

import corpus_pipeline
from tests.conftest import SF


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line dedup", "n-gram Jaccard join", "mixing sources", "best-fit packing"]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        path = str(tmp_path / str(k))
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        if k < 4:
            assert docs.columns == columns
        if k < 3:
            assert docs.select("doc_id").distinct().count() == docs.count() <= before
            before = docs.count()
    assert docs.count() > 0


def test_empty_and_odd_tables(spark, tmp_path):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    odd = [(None, None, None, None, None), (1, "", "en", "a", 0), (1, "", "en", "a", 0),
           (2, "x y z", None, None, 5)]
    for k, rows in enumerate(([], odd)):
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{k}/documents.parquet"))
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(
            str(tmp_path / f"{k}/labels.parquet"))
        assert corpus_pipeline.run(spark, str(tmp_path / str(k))).count() == len(rows)
