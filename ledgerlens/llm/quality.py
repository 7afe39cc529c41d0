"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader, sparse dot products."""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import small_batches, table, trim, trimmed

DIM = 1 << 18
TRAIN_ROWS = 3000  # bound of the labelled sample the model is fitted on: those whose hashed doc_id is smallest
THRESHOLD = 0.7
CACHE = 400_000  # distinct words a worker remembers; it forgets all of them beyond
SCALE = 24.0
_REPEAT = np.uint64(0x9E3779B97F4A7C15)
_RUN = re.compile(r"(.)\1+", re.S)
#: Letters by case and digits become one sign each; everything else stands for itself.
_SHAPES = re.compile(r"[^\W\d_]+|\d+")


def word_shape(word: str) -> str:
    """The word's form: a, A or Aa for letters, 9 for digits, other signs as they are, runs of a sign once."""
    if len(word) <= 64:  # the common forms at once: letters, and letters with one sign at the end
        body, tail = (word, "") if word.isalpha() else (word[:-1], word[-1]) if not word[-1].isalnum() and word[-1] != "_" else ("", "")
        if body.isalpha():
            return ("a" if body.islower() else "A" if body.isupper() and len(body) > 1 else "Aa") + tail

    def sign(m: re.Match) -> str:
        part = m[0]
        if part[0].isdigit():
            return "9"
        return "a" if part.islower() else "A" if part.isupper() and len(part) > 1 else "Aa"

    return _RUN.sub(r"\1", _SHAPES.sub(sign, word[:64]))[:16]


class Grams:
    """Hashed n-grams of whole texts: words, word pairs, and one to three word shapes, repeats of a word marked."""

    def __init__(self) -> None:
        self.reset()

    def reset(self) -> None:
        self.ids: dict[str, int] = {}
        self.raw = np.zeros(1024, np.uint64)
        self.shape = np.zeros(1024, np.uint64)

    def add(self, word: str) -> int:
        i = self.ids[word] = len(self.ids)
        if i >= len(self.raw):
            self.raw, self.shape = (np.concatenate((x, np.zeros_like(x))) for x in (self.raw, self.shape))
        self.raw[i] = crc32(word.lower().encode("utf-8"))
        self.shape[i] = crc32(word_shape(word).encode("utf-8"), 7)
        return i

    def of(self, text: str | None) -> np.ndarray:
        words = (text or "").split()
        if len(self.ids) > CACHE:
            self.reset()
        get = self.ids.get
        at = np.fromiter((i if (i := get(w)) is not None else self.add(w) for w in words), np.int64, len(words))
        raw, shape = self.raw[at], self.shape[at]
        if len(at) > 1:
            shape[1:][at[1:] == at[:-1]] = _REPEAT
        mix, odd, big = np.uint64(0x9E3779B1), np.uint64(0x85EBCA6B), np.uint64(29)
        two = shape[:-1] * mix + shape[1:] * odd
        grams = [raw, shape + np.uint64(1), raw[:-1] * odd + raw[1:] * mix, two, two[:-1] * mix + shape[2:]]
        h = np.concatenate(grams) * np.uint64(0xD6E8FEB86659FD93)
        return ((h ^ (h >> big)) & np.uint64(DIM - 1)).astype(np.int64)


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = 4, alpha: float = 0.3, beta: float = 1.0, l1: float = 0.02, l2: float = 0.05) -> np.ndarray:
    """FTRL-proximal weights; the last one is the bias. rows: (indices, values, label), visited in a fixed order;
    those of 32 bits are widened a row at a time."""
    z, n = np.zeros(DIM + 1), np.zeros(DIM + 1)
    order = np.arange(len(rows))
    rng = np.random.default_rng(5)
    bias = np.array([DIM], np.int64)

    def weight(i: np.ndarray) -> np.ndarray:
        zi = z[i]
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(n[i])) / alpha + l2))

    for _ in range(epochs):
        rng.shuffle(order)
        for k in order:
            i, x, y = rows[k]
            i, x = np.concatenate((i, bias)), np.concatenate((np.asarray(x, float) * SCALE, [1.0]))
            w = weight(i)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - y) * x
            s = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha
            z[i] += g - s * w
            n[i] += g * g
    return weight(np.arange(DIM + 1))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> np.ndarray:
    """Weights from at most ``rows`` labelled documents that are not held out; all zero (score 0.5) without any.

    Labels of the same doc_id count by their mean, a mean of exactly one half and nulls are left out. Only the
    chosen documents are read into features, on the executors; the driver receives their sparse vectors.
    """
    marks = labels.where("doc_id is not null and quality is not null").where(~held_out(F.col("doc_id")))
    marks = marks.groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.avg(F.col("quality").cast("double")).alias("_y")).where("_y <> 0.5")
    marks = marks.orderBy(F.xxhash64("_id"), "_id").limit(rows)
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(marks), F.col("doc_id") == F.col("_id"))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams()
        for batch in batches:
            idx, val = [], []
            for t in batch.column("text").to_pylist():
                i, c = np.unique(grams.of(t), return_counts=True)
                idx.append(i.astype("<i4").tobytes())
                val.append((c / max(1, c.sum())).astype("<f4").tobytes())
            yield pa.record_batch({"id": batch.column("_id"), "y": pa.array([int(y > 0.5) for y in batch.column("_y").to_pylist()], pa.int32()), "i": pa.array(idx, pa.binary()), "x": pa.array(val, pa.binary())})

    got = chosen.select("_id", "_y", "text").mapInArrow(trimmed(vectors), "id long, y int, i binary, x binary").collect()
    got.sort(key=lambda r: (r["id"], bytes(r["i"])))
    weights = fit([(np.frombuffer(r["i"], "<i4"), np.frombuffer(r["x"], "<f4"), r["y"]) for r in got])
    del got
    trim()  # the driver holds the vectors no longer
    return weights


def score(docs: DataFrame, weights: np.ndarray, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and ``_score``, the model's probability of good quality for the whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, w = Grams(), shared.value
        bias, w = float(w[-1]), w[:-1]
        for batch in batches:
            out = []
            for t in batch.column("_text").to_pylist():
                i = grams.of(t)
                dot = bias + (SCALE * float(w[i].sum(dtype=np.float64)) / len(i) if len(i) else 0.0)
                out.append(1 / (1 + np.exp(-np.clip(dot, -35, 35))))
            kept = {c: batch.column(c) for c in keep}
            yield pa.record_batch(kept | {"_score": pa.array(out, pa.float64())})

    return docs.select(*keep, F.col("text").alias("_text")).mapInArrow(trimmed(run), schema + ", _score double")


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of each row of docs.

    Null and empty texts get the bias alone. Repeated rows and null doc_ids (never held out) keep their rows; other
    columns are not read; no documents give no rows. labels, lang, source and doc_id are no inputs of a score.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = score(docs, train(docs, labels), ["doc_id"])
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents predicted to be of low quality go. Columns and their order stay.

    Null and empty texts have the bias alone for a score; repeated rows stay or go together; columns of any name may
    follow; no documents give none, and without labels every score is 0.5, so that all go.
    """
    small_batches(spark)
    weights = train(docs, table(spark, sf_dir, "labels"))
    scored = score(docs.select(F.struct(*docs.columns).alias("row"), "text"), weights, ["row"])
    return scored.where(F.col("_score") >= THRESHOLD).select("row.*")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
