import random

import corpus_pipeline
from ledgerlens.llm import pieces

HEX = "9233a8ecf7c5b09fe5949719b6b82bc439e9329b"


def write(spark, folder):
    rng = random.Random(4)

    def prose(n):
        return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(n)) + "."

    docs, labels = [], []
    for i in range(300):
        bad = i % 6 == 0
        text = prose(60)
        docs.append((i, text.upper().replace(" ", "!! ") if bad else text, "en", "src1", 0))
        labels.append((i, int(not bad), 0))
    item = prose(30)
    good = {i: t for i, t, *_ in docs if i % 6}
    docs += [(1000, good[1], "en", "src1", 0), (1001, good[2] + " one more", "en", "src2", 0), (1002, prose(30) + " " + item + " " + prose(30), "en", "src1", 0)]
    docs += [(1003, prose(40) + f' token = "{HEX}" ' + prose(10), "en", "src1", 0), (1004, " ".join(prose(20) for _ in range(300)), "en", "src1", 0)]
    docs = [(i, t, a, b, len(t)) for i, t, a, b, _ in docs]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return {i: t for i, t, *_ in docs}


def test_stages_and_result(spark, tmp_path):
    texts = write(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, kept = docs.columns, None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == columns, name
        kept = {r.doc_id: r.text for r in docs.collect()}
    want = {i for i in texts if i >= 1000 or i % 6} - {1000, 1001, 1002}
    assert set(kept) == want
    assert all(kept[i] == texts[i] for i in want - {1003}) and HEX not in kept[1003] and "[secret]" in kept[1003]
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(out) == want
    library = pieces.model_of(pieces.default_model()).library
    assert all(out[i].ids == library.encode(kept[i]) and out[i].n_tokens == len(out[i].ids) for i in want)


def test_stages_on_odd_tables(spark, tmp_path):
    """Empty tables, nulls in every column, repeated rows, clashing names, no source and n_chars."""
    write(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    token = f'key = "{HEX}"'
    rows = [(None, None, None, None, None), (None, "", "en", None, 0), (7, None, None, "s", 1), (5, f"some words {token}", "en", "s", None), (5, f"some words {token}", "en", "s", None)]
    odd = spark.createDataFrame(rows, docs.schema)
    for name in ("_row", "_key", "_text", "_score", "_secrets", "_keep", "_found", "row", "node", "key", "fp"):
        odd = odd.withColumn(name, odd["lang"])
    for table in (odd, odd.limit(0), odd.drop("source", "n_chars")):
        n = table.count()
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, table, str(tmp_path))
            assert out.columns == table.columns, name
            assert out.schema["text"].dataType == table.schema["text"].dataType
            kept = out.count()
            assert kept <= n and (n == 0 or kept > 0 or name == "quality classifier"), name
            if name == "secret scans" and n:
                assert kept == n and sum("[secret]" in (r.text or "") for r in out.collect()) == 2
            if name == "simhash near-dedup" and n:
                assert kept == 2  # the texts without words are one group
        assert corpus_pipeline.STAGES[-1][1](spark, table, str(tmp_path)).count() == n
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{tmp_path}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/empty/{name}.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/empty").count() == 0
