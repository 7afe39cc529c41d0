from ledgerlens.llm import common, quality, simhash, token_store

NAME = "spark.sql.execution.arrow.maxRecordsPerBatch"


def test_a_pass_gives_memory_back_at_its_end(monkeypatch):
    calls = []
    monkeypatch.setattr(common, "trim", lambda: calls.append(1))
    assert list(common.trimmed(lambda batches: (x + 1 for x in batches))([1, 2])) == [2, 3] and calls == [1]


def test_stages_and_the_store_send_small_batches(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string")
    spark.createDataFrame([(1, 1)], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    stages = [
        lambda: quality.keep_good(spark, docs, str(tmp_path)), lambda: simhash.near_dedup(spark, docs, str(tmp_path)),
        lambda: token_store.encode(docs, str(tmp_path / "ids"), token_store.default_tokenizer()),
    ]
    for stage in stages:
        spark.conf.set(NAME, "10000")
        stage()
        assert int(spark.conf.get(NAME)) <= 1000


def test_small_batches_bound_what_parquet_hands_over(spark):
    name = "spark.sql.parquet.columnarReaderBatchSize"
    for now, then in (("4096", 250), ("10", 10)):
        spark.conf.set(name, now)
        common.small_batches(spark)
        assert int(spark.conf.get(name)) == then
    spark.conf.unset(name)
