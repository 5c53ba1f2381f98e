from gristmill.plans import catalog, dataset_queries


def test_prompt_holds_the_reference_limit(spark, tmp_path):
    texts = ["a" * 1500, "b" * 3000]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, 1, 0), (1, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    got = {r["id"]: r["prompt"].split("\n", 1)[1] for r in catalog.QUERIES["sft_rows"](spark, str(tmp_path)).collect()}
    assert got == {0: texts[0], 1: texts[1][: dataset_queries.PROMPT_CHARS]} and dataset_queries.PROMPT_CHARS == 2000
