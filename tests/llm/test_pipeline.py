"""The pipeline's stages, one on what the other kept."""

import corpus_pipeline


def test_stages(spark, documents):
    folder = "/root/testdata/sf0.001"
    docs, counts = documents, [documents.count()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == documents.columns
            docs = spark.createDataFrame(out.collect(), documents.schema)
            counts.append(docs.count())
    assert counts[0] > counts[1] > counts[2] > counts[3] == counts[4]
    packed = {r["doc_id"] for r in out.select("doc_id").distinct().collect()}
    assert packed == {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert "@mail" not in " ".join(r["text"] for r in docs.select("text").collect())


def test_stages_on_odd_rows(spark, odd, none):
    folder = "/root/testdata/sf0.001"
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, odd, folder).count()
        assert stage(spark, none, folder).count() == 0
