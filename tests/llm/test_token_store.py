from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlens.llm import token_store as t


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 5000), max_size=400))
def test_elias_fano_round_trip(gaps):
    values = np.cumsum([0, *gaps])
    ef = t.EliasFano.of(values)
    assert ef.all().tolist() == values.tolist()
    for i in {0, len(values) // 2, len(values) - 1}:
        assert ef.select(i) == values[i]
    with pytest.raises(IndexError):
        ef.select(len(values))


def test_elias_fano_is_near_minimal():
    values = np.cumsum(np.random.default_rng(0).integers(0, 1000, 100_000))
    ef = t.EliasFano.of(values)
    assert ef.n_bytes() * 8 / len(values) < 2 + np.log2(values[-1] / len(values)) + 1
    assert all(ef.select(i) == values[i] for i in range(0, 100_000, 997))


def test_round_trip_against_the_library(spark):
    from tokenizers import Tokenizer

    path = t.default_tokenizer()
    texts = ["Hello, world!\nIt's é É　x", None, "", "  \n\n ", "a" * 700 + " " + "ß" * 300, "x<|endoftext|>y  z", "tab\tend nbsp 'S 're", "café ́alone", "ΑΣ ΑΣ."] + [f"word{i} w{i % 7}" for i in range(60)]
    rows = [(1000 - i, x, "clash") for i, x in enumerate(texts)] + [(None, "null id", "c"), (950, texts[50], "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string")
    got = [tuple(r) for r in t.token_offsets(docs, path).select("doc_id", "start", "n_tokens", "ids_crc32").collect()]
    whole, want, start = Tokenizer.from_file(path), [], 0
    for d, x, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*whole.encode(x or "", add_special_tokens=False).ids, 2]
        want.append((d, start, len(ids), crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(got, key=lambda r: r[1]) == want
    assert t.token_offsets(docs.limit(0), path).count() == 0


def test_blocks_stay_small(spark, tmp_path):
    """Rows of a megabyte, of which Spark and Parquet hold several copies, filled the executors' heaps."""
    docs = spark.createDataFrame([(i, "word " * 4000) for i in range(80)], "doc_id long, text string")
    t.encode(docs.coalesce(1), str(tmp_path / "ids"), t.default_tokenizer())
    blocks = spark.read.parquet(str(tmp_path / "ids")).selectExpr("octet_length(ids) as n", "size(doc_ids) as docs").collect()
    assert sum(r.docs for r in blocks) == 80 and max(r.n for r in blocks) <= 1 << 18
