"""The pipeline's stages one by one, and its result against what its stages say."""

import corpus_pipeline

DATA = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    seen = [{r["doc_id"] for r in docs.select("doc_id").collect()}]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, DATA).write.parquet(str(tmp_path / str(k)))
        out = spark.read.parquet(str(tmp_path / str(k)))
        if k < 3:
            assert out.columns == docs.columns
        seen.append({r["doc_id"] for r in out.select("doc_id").collect()})
        assert seen[-1] <= seen[-2] and seen[-1]
        docs = out
    assert seen[4] == seen[3]
    assert len({d for d in seen[1] if d in labels and labels[d]["toxic"]}) <= 1
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, DATA).select("doc_id").collect()} == seen[4]


def test_odd_documents(spark, tmp_path):
    """Nulls, empty and repeated rows, null ids, other columns, and an empty table, through all stages."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, part int, key string, nth long, sequence_id long"
    base = [(k, t, "en", None, 1, 1, "k", 2, 3) for k, t in enumerate([None, "", "one two three", "one two three", "x " * 9000, "Ünï — 中文 text"])]
    rows = spark.createDataFrame(base + [base[4], (None, "nobody knows", None, "s", None, None, None, None, None)], schema)
    (tmp_path / "in").mkdir()
    rows.write.parquet(str(tmp_path / "in" / "documents.parquet"))
    spark.createDataFrame([(2, 1, 0), (4, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "in" / "labels.parquet"))
    packed = corpus_pipeline.run(spark, str(tmp_path / "in")).collect()
    assert sum(r["piece"] == 0 for r in packed) == 5  # empty, three words, long, other scripts, nobody
    docs = rows.filter("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path / "in"))
        assert docs.count() == 0
