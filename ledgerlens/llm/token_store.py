"""Token ids on disk: blocks of concatenated ids with Elias-Fano document boundaries.

File format (Parquet rows, one a block of documents in ascending doc_id order):
bucket, block (their order is the order of the blocks), doc_ids, n_ids, width (bytes an id), ids (little-endian),
low_bits, low, high, samples (the boundaries; see EliasFano).
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import cache
from math import ceil
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens.llm.common import by_size, maybe_broadcast, new_path, small_batches, table, trim

END = 2
BLOCK_IDS = 1 << 16  # a block closes at so many ids, which keeps a row and its copies under half a region of a 1 GB heap; one longer document makes a block of its own
BUCKET_DOCS = 20_000
GROUP = 1024  # buckets whose sums run in one task
CACHE = 60_000  # distinct words of a generation; a worker remembers two
LONG = 200  # longer words are encoded each time
SLICE = 2_000_000  # bytes of text that a worker holds as words at a time

FORMAT = "bucket int, block int, doc_ids array<bigint>, n_ids bigint, width int, ids binary, low_bits int, low binary, high binary, samples binary"


class EliasFano:
    """A non-decreasing sequence of n integers up to u in about 2 + log2(u / n) bits each, with select.

    The low bits of each value are packed; the high bits are a unary bit vector in which value i sets bit
    (value >> low_bits) + i. Every 128th set bit's place is kept as 32 bits, so select(i) counts through a few words.
    """

    EVERY = 128

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, samples: bytes):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        u = int(values[-1]) + 1 if n else 1
        bits = max(0, (u // max(n, 1)).bit_length() - 1)
        low = (values[:, None] >> np.arange(bits, dtype=np.uint64) & np.uint64(1)).astype(np.uint8)
        places = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        high = np.zeros((int(places[-1]) + 8) // 8 * 8 if n else 8, np.uint8)
        high[places] = 1
        return cls(n, bits, np.packbits(low, bitorder="little").tobytes(), np.packbits(high, bitorder="little").tobytes(), places[:: cls.EVERY].astype("<u4").tobytes())

    def _low(self, lo: int, hi: int) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(hi - lo, np.int64)
        first, last = lo * self.low_bits, hi * self.low_bits
        raw = np.frombuffer(self.low, np.uint8)[first // 8 : (last + 7) // 8]
        bits = np.unpackbits(raw, bitorder="little")[first % 8 :][: last - first]
        return bits.reshape(-1, self.low_bits).astype(np.int64) @ (1 << np.arange(self.low_bits, dtype=np.int64))

    def select(self, i: int) -> int:
        """Value i: from the sample before it, byte by byte to its set bit."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at = int(np.frombuffer(self.samples, "<u4")[i // self.EVERY])
        left = i % self.EVERY
        high = np.frombuffer(self.high, np.uint8)
        byte, word = at // 8, int(high[at // 8]) >> at % 8 << at % 8
        while (ones := word.bit_count()) <= left:
            left -= ones
            byte += 1
            word = int(high[byte])
        for _ in range(left):
            word &= word - 1
        place = byte * 8 + (word & -word).bit_length() - 1
        return (place - i << self.low_bits) + int(self._low(i, i + 1)[0])

    def all(self) -> np.ndarray:
        places = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little"))[: self.n]
        return (places - np.arange(self.n) << self.low_bits) + self._low(0, self.n)

    def n_bytes(self) -> int:
        return len(self.low) + len(self.high) + len(self.samples)


class WordEncoder:
    """Encodes texts with a tokenizer whose pre-tokens never span white space: each distinct word is encoded once.

    Texts are cut at spaces and line feeds only; a word's ids do not depend on its neighbours. A word of letters with
    signs at its end is two pre-tokens, each encoded once; new words of letters go to the library many at a time.
    """

    SIGNS = ".,;:!?*#$%&|()"
    JOINED = 500

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        n = self.tokenizer.get_vocab_size()
        self.dtype = "<u2" if n <= 1 << 16 else "<u4"
        self.ends = np.array([(self.tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(n)])
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, bytes] = {"": b""}
        self.letters: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}  # letters before the last overflow: those met again are kept

    def _each(self, words: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.dtype).tobytes() for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)] if words else []

    def _learn_letters(self, words: list[str]) -> None:
        groups = [words[i : i + self.JOINED] for i in range(0, len(words), self.JOINED)]
        for group, e in zip(groups, self.tokenizer.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False) if groups else []):
            ids = np.array(e.ids, self.dtype)
            stops = (np.flatnonzero(self.ends[ids]) + 1).tolist()
            if len(stops) == len(group):
                raw, size = ids.tobytes(), ids.itemsize
                self.letters.update((w, raw[a * size : b * size]) for w, a, b in zip(group, [0, *stops], stops))
            else:  # some word is more than one pre-token after normalisation
                self.letters.update(zip(group, self._each(group)))

    def _coded(self, words: pa.Array) -> list[bytes]:
        """Ids of different words."""
        if len(self.known) > CACHE:
            self.forget()
        if len(self.letters) > CACHE:
            self.older, self.letters = self.letters, {}
        bases = pc.utf8_rtrim(words, characters=self.SIGNS)
        plain = pc.utf8_is_alpha(bases).to_numpy(zero_copy_only=False).tolist()
        # by way of numpy: Arrow's own lists make a scalar of each value first
        words, bases = (x.to_numpy(zero_copy_only=False).tolist() for x in (words, bases))
        letters, older = self.letters, self.older
        new = {b for b, ok in zip(bases, plain) if ok and b not in letters}
        letters.update((b, older[b]) for b in new if b in older)
        self._learn_letters([b for b in new if b not in older])
        signs = [w[len(b) :] if ok else w for w, b, ok in zip(words, bases, plain)]
        new = list(set(signs) - self.known.keys())
        long = [w for w in new if len(w) > LONG]
        new = [w for w in new if len(w) <= LONG]
        self.known.update(zip(new, self._each(new)))
        known = self.known | dict(zip(long, self._each(long))) if long else self.known
        return [(letters[b] + known[s] if s else letters[b]) if ok else known[s] for b, s, ok in zip(bases, signs, plain)]

    def batch(self, texts: pa.Array, tail: bytes = b"") -> list[bytes]:
        """Ids of each text, with ``tail`` after each. Words are told apart by Arrow; only different ones come here."""
        words = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        counts, coded = pc.list_value_length(words).to_numpy(), pc.list_flatten(words).dictionary_encode()
        got = self._coded(coded.dictionary)
        size = np.dtype(self.dtype).itemsize
        flat, lengths = np.frombuffer(b"".join(got), self.dtype), np.fromiter(map(len, got), np.int64, len(got)) // size
        firsts, order = np.cumsum(lengths) - lengths, coded.indices.to_numpy()
        n = lengths[order]
        ends = np.cumsum(n)
        ids = flat[np.repeat(firsts[order] - ends + n, n) + np.arange(n.sum())].tobytes()
        cuts = (np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(counts)))] * size).tolist()
        return [ids[a:b] + tail for a, b in zip(cuts, cuts[1:])]


@cache
def encoder_of(path: str) -> WordEncoder:
    """One for each worker process, which keeps its words from task to task."""
    return WordEncoder(path)


def encode(docs: DataFrame, path: str, tokenizer: str, end: int = END) -> None:
    """Writes the ids of every row of docs(doc_id, text) to ``path`` in the file format above.

    Order: doc_id (nulls first), then the hash of the text. The id range is cut at quantiles of doc_id, which need
    that column only; texts are encoded where they are read, and only ids (two bytes each) are shuffled.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = docs.agg(F.count("doc_id")).first()[0]
    buckets = max(parts, ceil(n / BUCKET_DOCS))
    cuts = docs.agg(F.percentile_approx("doc_id", [i / buckets for i in range(1, buckets)] or [0.5], 100_000)).first()[0] if n else []
    bounds = np.unique(np.array(cuts or [], np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer)
        tail = np.array([end], encoder.dtype).tobytes()
        width = len(tail)
        for batch in batches:
            for part in by_size(batch, "text", limit=SLICE):
                bucket = pa.array([-1 if d is None else int(np.searchsorted(bounds, d, "right")) for d in part.column("doc_id").to_pylist()], pa.int32())
                ids = pa.array(encoder.batch(part.column("text"), tail), pa.binary())
                pa.default_memory_pool().release_unused()
                yield pa.record_batch({"bucket": bucket, "doc_id": part.column("doc_id"), "tie": part.column("tie"), "width": pa.array([width] * part.num_rows, pa.int32()), "ids": ids})
        trim()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, block, held, size = None, 0, [], 0

        def close() -> pa.RecordBatch:
            width = held[0][1]
            ends = np.cumsum([len(x[2]) // width for x in held])
            ef = EliasFano.of(np.concatenate(([0], ends)))
            row = {"bucket": bucket, "block": block, "doc_ids": [x[0] for x in held], "n_ids": int(ends[-1]), "width": width, "ids": b"".join(x[2] for x in held), "low_bits": ef.low_bits, "low": ef.low, "high": ef.high, "samples": ef.samples}
            return pa.RecordBatch.from_pylist([row], pa.schema([("bucket", pa.int32()), ("block", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("n_ids", pa.int64()), ("width", pa.int32()), ("ids", pa.binary()), ("low_bits", pa.int32()), ("low", pa.binary()), ("high", pa.binary()), ("samples", pa.binary())]))

        for batch in batches:
            for b, d, w, ids in zip(*(batch.column(c).to_pylist() for c in ("bucket", "doc_id", "width", "ids"))):
                if held and (b != bucket or size >= BLOCK_IDS):
                    yield close()
                    block, held, size = (block + 1 if b == bucket else 0), [], 0
                bucket = b
                held.append((d, w, ids))
                size += len(ids) // w
        if held:
            yield close()
        trim()

    coded = docs.select("doc_id", "text", F.xxhash64("text").alias("tie")).mapInArrow(run, "bucket int, doc_id long, tie long, width int, ids binary")
    dealt = coded.repartition(parts, "bucket").sortWithinPartitions(F.asc("bucket"), F.asc_nulls_first("doc_id"), F.asc("tie"))
    dealt.mapInArrow(pack, FORMAT).write.parquet(path)


def _based(blocks: DataFrame) -> DataFrame:
    """(bucket, block, base: the ids of all blocks before it). Sums run inside groups of buckets; one total a group, of
    about GROUP * BUCKET_DOCS documents each, comes to the driver."""
    heads = blocks.select("bucket", "block", "n_ids").withColumn("group", F.floor(F.col("bucket") / GROUP).cast("int"))
    totals = sorted(tuple(r) for r in heads.groupBy("group").agg(F.sum("n_ids")).collect())
    before = np.cumsum([0, *(n for _, n in totals)]).tolist()
    offsets = heads.sparkSession.createDataFrame([(g, n) for (g, _), n in zip(totals, before)], "group int, offset long")
    order = Window.partitionBy("group").orderBy("bucket", "block").rowsBetween(Window.unboundedPreceding, -1)
    inside = heads.select("group", "bucket", "block", F.coalesce(F.sum("n_ids").over(order), F.lit(0)).alias("inside"))
    return inside.join(maybe_broadcast(offsets, len(totals)), "group").select("bucket", "block", (F.col("offset") + F.col("inside")).alias("base"))


def _read(spark: SparkSession, path: str, view, schema: str) -> DataFrame:
    """``view(ids, width)``, columns by name, of the documents of the files, with doc_id and start: one Python pass."""
    small_batches(spark)
    blocks = spark.read.schema(FORMAT).parquet(path)
    blocks = blocks.join(maybe_broadcast(_based(blocks), blocks.count()), ["bucket", "block"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                r = {c: batch.column(c)[row].as_py() for c in batch.schema.names}
                docs, ids, width = r["doc_ids"], memoryview(r["ids"]), r["width"]
                at = EliasFano(len(docs) + 1, r["low_bits"], r["low"], r["high"], r["samples"]).all()
                for lo in range(0, len(docs), 1000):
                    some, cut = docs[lo : lo + 1000], at[lo : lo + 1001]
                    seen = view([ids[a * width : b * width] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())], width)
                    yield pa.record_batch({"doc_id": pa.array(some, pa.int64()), "start": pa.array(cut[:-1] + r["base"], pa.int64())} | seen)
        trim()

    return blocks.mapInArrow(run, f"doc_id long, start long, {schema}")


def decode(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids binary, width) of every document, from the files alone."""
    view = lambda ids, width: {"ids": pa.array(map(bytes, ids), pa.binary()), "width": pa.array([width] * len(ids), pa.int32())}
    return _read(spark, path, view, "ids binary, width int")


def digest(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 (of the ids as little-endian unsigned 32-bit integers), from the files alone."""

    def view(ids: list[memoryview], width: int) -> dict[str, pa.Array]:
        crc = [crc32(np.frombuffer(x, f"<u{width}").astype("<u4").tobytes()) for x in ids]
        return {"n_tokens": pa.array([len(x) // width for x in ids], pa.int64()), "ids_crc32": pa.array(crc, pa.int64())}

    return _read(spark, path, view, "n_tokens long, ids_crc32 long")


def token_offsets(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Encodes, writes, reads back: one row per row of docs.

    Null and empty texts hold the end id alone. Repeated rows and repeated doc_ids keep their rows, in the order of
    the text's hash; null doc_ids come first. Other columns are not read; an empty table gives no rows.
    """
    path = new_path(docs.sparkSession, "tokens")
    encode(docs, path, tokenizer)
    return digest(docs.sparkSession, path)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op4_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_offsets(table(spark, sf_dir, "documents"), default_tokenizer())
