"""The corpus pipeline: quality classifier, near-duplicates, decontamination, secrets, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next stage's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import decontaminate, pieces, quality, secrets, simhash
from ledgerlens.llm.common import new_path, remove, table

STAGES = [
    ("quality classifier", quality.keep_good),
    ("simhash near-dedup", simhash.near_dedup),
    ("benchmark decontamination", decontaminate.drop_contaminated),
    ("secret scans", secrets.redact),
    ("sentencepiece encoding and decoding", pieces.tokens),
]

#: No SQL form: see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other; a stage's table goes when the next one is written."""
    docs, last = table(spark, sf_dir, "documents"), None
    for k, (_, stage) in enumerate(STAGES):
        path = new_path(spark, f"stage{k}")
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if last:
            remove(spark, last)
        last = path
    return docs
