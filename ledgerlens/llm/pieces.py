"""SentencePiece encoding and decoding; giant documents by a max-plus scan over chunks.

A BPE segmentation is the one path through the text on which every two neighbouring pieces a, b are what BPE makes of
their concatenation; in max-plus terms, edges a -> b have weight 0 or minus infinity and the state is the last piece.
A giant document is cut into chunks of characters. Each chunk yields, independently, its transfer matrix between the
states at its two boundaries (a state: the piece that reaches the boundary and how far it runs over). Matrices combine
associatively (``compose``) up a tree, ``FAN`` neighbours a task; the states at the outer boundaries then go down the
tree to all chunks, and each chunk is backtraced on its own. No task holds more than ``FAN`` matrices of a text.

No piece joins a sign to the white space after it, so a segment (spaces and the word after them) is a path of its
own: matrices of chunks with white space have rank one, and segments are encoded once each and remembered. Where no
piece of the model joins a letter to a sign after it, a word and the signs at its end are two paths. Arrow tells the
words of many texts apart, so that only different ones are looked up, and new ones go to the library in one call: calls
with few words cost it several times as much, and its own threads more than they save.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import cache
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import by_size, cut, maybe_broadcast, small_batches, table, trimmed, written

CHUNK = 16_384  # characters of a chunk; longer documents are giant
FAN = 32  # neighbouring matrices that one step of the scan combines
CACHE = 80_000  # segments of a generation; a worker remembers two
SIGNS = ".,;:!?*#$%&|()"
LONG = 200  # longer segments are not remembered
SPACE = "▁"
SEGMENT = re.compile(" +[^ \n]*|\n[^ \n]*")

State = tuple[int, str]  # characters beyond the boundary, piece
START: State = (0, "")


class Pieces:
    """The vocabulary of a SentencePiece BPE model with byte fallback, identity normalisation and a leading space."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids: dict[str, int] = {}
        self.bytes = [b""] * sp.get_piece_size()
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.bytes[i] = bytes([int(piece[3:5], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i)):
                self.ids[piece] = i
                self.bytes[i] = piece.replace(SPACE, " ").encode()
        self.score = {p: sp.get_score(i) for p, i in self.ids.items()}
        self.longest = max(map(len, self.ids))
        if any("\n" in p or SPACE in p.lstrip(SPACE) for p in self.ids) or sp.encode("ﬁ  x") == sp.encode("fi x"):
            raise ValueError("the model's pieces span white space, or it normalises texts")
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}  # segments before the last overflow: those met again are kept
        before = {a for p in self.ids for a, b in zip(p, p[1:]) if b in SIGNS and a not in SIGNS + SPACE}
        self.signs = "" if before and pc.any(pc.utf8_is_alpha(pa.array(sorted(before)))).as_py() else SIGNS
        self.fits: dict[tuple[str, str], bool] = {}

    # ------------------------------------------------------------ plain rules
    def merge(self, text: str) -> list[str]:
        """BPE of a short string: the best-scored neighbouring pair joins first, the leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            best = max(range(len(parts) - 1), key=lambda i: (self.score.get(parts[i] + parts[i + 1], -np.inf), -i))
            if parts[best] + parts[best + 1] not in self.score:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return parts

    def joins(self, a: str, b: str) -> bool:
        """Whether piece b may follow piece a."""
        found = self.fits.get((a, b))
        if found is None:
            if len(self.fits) > CACHE:
                self.fits.clear()
            found = self.fits[a, b] = self.merge(a + b) == ([a, b] if a else [b])
        return found

    def code(self, piece: str) -> list[int]:
        i = self.ids.get(piece)
        return [i] if i is not None else [self.library.piece_to_id(f"<0x{b:02X}>") for b in piece.encode()]

    # ------------------------------------------------------------ segments
    def _new(self, found: list[str]) -> list[bytes]:
        """Ids of segments by the library: each starts with a space, a line feed or, signs after a word, with neither."""
        # the library adds the leading space itself; before a line feed it is a piece of its own, and before signs a letter stands
        coded = self.library.encode([s[1:] if s[0] == " " else s if s[0] == "\n" else "a" + s for s in found], num_threads=1) if found else []
        coded = [self.code(SPACE) if s == " " else c if s[0] == " " else c[1:] for s, c in zip(found, coded)]
        ends = np.cumsum([0, *map(len, coded)]) * 2
        flat = np.fromiter(chain.from_iterable(coded), "<u2", int(ends[-1]) // 2).tobytes()
        return [flat[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]

    def segments(self, found: list[str]) -> list[bytes]:
        """Ids (16 bits each) of segments; each starts with a space or a line feed, or is of signs alone."""
        if len(self.known) > CACHE:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        got = list(map(known.get, found))
        if None in got:
            new = {s for s, g in zip(found, got) if g is None}
            known.update((s, older[s]) for s in new if s in older)
            new = [s for s in new if s not in known]
            fresh = dict(zip(new, self._new(new)))
            known.update((s, g) for s, g in fresh.items() if len(s) <= LONG)
            got = [g if g is not None else known[s] if s in known else fresh[s] for s, g in zip(found, got)]
        return got

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        return b"".join(self.segments(SEGMENT.findall(" " + text.replace(SPACE, " "))))

    def batch(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text. A text without two spaces in a row is cut at its spaces and before its line feeds; others go one by one."""
        texts = pc.replace_substring(texts, SPACE, " ")
        plain = pc.invert(pc.or_(pc.match_substring(texts, "  "), pc.or_(pc.starts_with(texts, " "), pc.equal(texts, ""))))
        cut = pc.split_pattern(pc.replace_substring(texts.filter(plain), "\n", " \n"), " ")
        counts, coded = pc.list_value_length(cut).to_numpy(), pc.list_flatten(cut).dictionary_encode()
        words = coded.dictionary
        bases = pc.utf8_rtrim(words, characters=self.signs) if self.signs else words
        whole = pc.invert(pc.utf8_is_alpha(pc.utf8_ltrim(bases, characters="\n"))).to_numpy(zero_copy_only=False).tolist()
        words, bases = (x.to_numpy(zero_copy_only=False).tolist() for x in (words, bases))
        parts = [w if ok else b for w, b, ok in zip(words, bases, whole)]
        tails = ["" if ok else w[len(b) :] for w, b, ok in zip(words, bases, whole)]
        different = list(set(tails) - {""})
        got = self.segments([w if w[:1] == "\n" else " " + w for w in parts] + different)
        ends = dict(zip(different, got[len(parts) :]))
        got = [g + ends[t] if t else g for g, t in zip(got, tails)]
        flat, n = np.frombuffer(b"".join(got), "<u2"), np.fromiter(map(len, got), np.int64, len(got)) // 2
        firsts, order = np.cumsum(n) - n, coded.indices.to_numpy()
        n = n[order]
        stops = np.cumsum(n)
        ids = flat[np.repeat(firsts[order] - stops + n, n) + np.arange(n.sum())].tobytes()
        cuts = (np.concatenate(([0], stops))[np.concatenate(([0], np.cumsum(counts)))] * 2).tolist()
        found = iter([ids[a:b] for a, b in zip(cuts, cuts[1:])])
        return [next(found) if ok else self.encode(t.as_py()) for ok, t in zip(plain.to_pylist(), texts)]

    def decode(self, ids: np.ndarray) -> bytes:
        """The text's UTF-8 bytes, without the leading space."""
        raw = b"".join(map(self.bytes.__getitem__, ids.tolist()))
        return raw[1:]

    # ------------------------------------------------------------ chunks
    def walk(self, text: str, states: dict[tuple[int, str], int], stop: int) -> tuple[dict, dict]:
        """From states (end, piece) -> set of entries as bits, all pieces that start before ``stop``.

        Returns the exit states (pieces that start before and end at or after stop) and, for each state, those before it.
        """
        text = text.replace(" ", SPACE)
        at: dict[int, dict[str, int]] = {}
        for (end, piece), bits in states.items():
            at.setdefault(end, {})[piece] = bits
        before: dict[tuple[int, str], list[tuple[int, str]]] = {}
        out: dict[tuple[int, str], int] = {(e, p): b for (e, p), b in states.items() if e >= stop}
        for q in range(min(at, default=stop), min(stop, len(text))):
            here = at.pop(q, None)
            if not here:
                continue
            for size in range(1, min(self.longest, len(text) - q) + 1):
                b = text[q : q + size]
                if size > 1 and b not in self.ids:
                    continue
                for a, bits in here.items():
                    if self.joins(a, b):
                        end = q + size
                        known = at.setdefault(end, {}) if end < stop else out
                        k = b if end < stop else (end, b)
                        known[k] = known.get(k, 0) | bits
                        before.setdefault((end, b), []).append((q, a))
        return out, before

    def entries(self, text: str, s: int) -> list[tuple[int, str]]:
        """Pieces (end, piece) that start before ``s`` and end at or after it."""
        line = text.replace(" ", SPACE)
        found = []
        for lo in range(max(0, s - self.longest), s):
            for hi in range(s, min(lo + self.longest, len(text)) + 1):
                if hi - lo == 1 or line[lo:hi] in self.ids:
                    found.append((hi, line[lo:hi]))
        return found

    @staticmethod
    def cuts(text: str, s: int, e: int) -> list[int]:
        return [m.start() for m in SEGMENT.finditer(text, s, e) if m.start() == 0 or text[m.start()] == "\n" or text[m.start() - 1] != " "]

    def transfer(self, text: str, s: int, e: int, first: bool) -> dict[State, list[State]]:
        """The chunk's matrix: for each state at s the states at e that a valid path leads to. text holds context."""
        begin = [START] if first else [(end - s, p) for end, p in self.entries(text, s)]
        cuts = self.cuts(text, s, e)
        if cuts:
            head, tail = cuts[0], cuts[-1]
            bits = {(s + o, p): 1 << i for i, (o, p) in enumerate(begin)}
            reach = sum({b for (end, _), b in self._bits(*self.walk(text, bits, head)).items() if end == head}) if head > s else 0
            if head == s:  # a segment starts here: any piece that ends here will do
                alive = [x for x in begin if x[0] == 0]
            else:
                alive = [x for i, x in enumerate(begin) if reach >> i & 1]
            exits = [(end - e, p) for end, p in self.walk(text, {(tail, ""): 1}, e)[0]]
            return {x: exits for x in alive}
        out, _ = self.walk(text, {(s + o, p): 1 << i for i, (o, p) in enumerate(begin)}, e)
        return {x: y for i, x in enumerate(begin) if (y := [(end - e, p) for (end, p), bits in out.items() if bits >> i & 1])}

    @staticmethod
    def _bits(out: dict, _: dict) -> dict:
        merged: dict = {}
        for (end, _p), bits in out.items():
            merged[end, ""] = merged.get((end, ""), 0) | bits
        return merged

    def backtrace(self, text: str, s: int, e: int, entry: State, exit_: State) -> list[int]:
        """The ids of the pieces that start in [s, e), given the states at both boundaries."""
        cuts = self.cuts(text, s, e)
        if not cuts:
            return self._path(text, (s + entry[0], entry[1]), (e + exit_[0], exit_[1]), e)
        head, tail = cuts[0], cuts[-1]
        first: list[int] = []
        if head > s and s + entry[0] < head:
            start = (s + entry[0], entry[1])
            ends = [x for x in self.walk(text, {start: 1}, head)[0] if x[0] == head]
            first = self._path(text, start, ends[0], head)
        middle = np.frombuffer(b"".join(self.segments(SEGMENT.findall(text[head:tail]))), "<u2").tolist()
        return first + middle + self._path(text, (tail, ""), (e + exit_[0], exit_[1]), e)

    def _path(self, text: str, start: tuple[int, str], goal: tuple[int, str], stop: int) -> list[int]:
        before = self.walk(text, {start: 1}, stop)[1]
        path, at = [], goal
        while at != start:
            path.append(at[1])
            at = before[at][0]
        return [i for p in path[::-1] for i in self.code(p)]


def compose(a: dict[State, list[State]], b: dict[State, list[State]]) -> dict[State, list[State]]:
    """The max-plus product of two transfer matrices with weights 0 and minus infinity."""
    out = {}
    for x, ys in a.items():
        if zs := list(dict.fromkeys(z for y in ys for z in b.get(y, ()))):
            out[x] = zs
    return out


Matrix = dict[State, list[State]]


def boundary_states(matrices: list[Matrix], entry: State = START, exit_: State | None = None) -> list[State]:
    """The states at all boundaries on the path from ``entry`` to ``exit_`` (None: a piece that ends with the text)."""
    reached: list[set[State]] = [{entry}]
    for m in matrices:
        reached.append({y for x in reached[-1] for y in m.get(x, ())})
    states = [exit_ or next(s for s in sorted(reached[-1]) if s[0] == 0)]
    for m, some in zip(matrices[::-1], reached[-2::-1]):
        states.append(next(x for x in sorted(some) if states[-1] in m.get(x, ())))
    return states[::-1]


def _dump(m: Matrix) -> str:
    return json.dumps([[list(x), ys] for x, ys in m.items()])


def _load(text: str) -> Matrix:
    return {tuple(x): [tuple(y) for y in ys] for x, ys in json.loads(text)}


def scan(leaves: DataFrame, most: int, fan: int = FAN) -> DataFrame:
    """(key, at, entry, exit): the states at both boundaries of each leaf (key, at, matrix; at from 0, without gaps).

    ``most``: the largest at. Up: neighbours combine ``fan`` at a time until one matrix a key is left. Down: the states
    at the boundaries of each node give those of its children.
    """

    def up(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("at")
        whole = None
        for text in rows.column("matrix").to_pylist():
            whole = _load(text) if whole is None else compose(whole, _load(text))
        return pa.table({"key": rows.column("key")[:1], "at": pa.array([rows.column("at")[0].as_py() // fan], pa.int64()), "matrix": pa.array([_dump(whole)])})

    def down(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("at")
        ends = [tuple(json.loads(x)) if (x := rows.column(c)[0].as_py()) else None for c in ("entry", "exit")]
        states = boundary_states([_load(m) for m in rows.column("matrix").to_pylist()], ends[0] or START, ends[1])
        return pa.table({"key": rows.column("key"), "at": rows.column("at"), "entry": pa.array(map(json.dumps, states[:-1]), pa.string()), "exit": pa.array(map(json.dumps, states[1:]), pa.string())})

    levels = [leaves]
    while most >= fan:
        most //= fan
        levels.append(written(levels[-1].groupBy("key", F.floor(F.col("at") / fan)).applyInArrow(up, "key string, at long, matrix string"), "scan"))
    states = levels[-1].select("key", "at", "matrix", F.lit(None).cast("string").alias("entry"), F.lit(None).cast("string").alias("exit"))
    for k in range(len(levels) - 1, -1, -1):
        states = states.groupBy("key", F.floor(F.col("at") / fan)).applyInArrow(down, "key string, at long, entry string, exit string")
        if k:
            above = written(states, "states").select(F.col("key").alias("u_key"), F.col("at").alias("u_at"), "entry", "exit")
            below = levels[k - 1]
            states = below.join(above, (F.col("key") == F.col("u_key")) & (F.floor(F.col("at") / fan) == F.col("u_at"))).select("key", "at", "matrix", "entry", "exit")
    return states


@cache
def model_of(path: str) -> Pieces:
    """One for each worker process, which keeps its segments from task to task."""
    return Pieces(path)


# ---------------------------------------------------------------- operators
def _giant(docs: DataFrame, path: str, chunk: int, fan: int = FAN) -> DataFrame:
    """(key, ids binary) of each different text of docs(key, text), all longer than a chunk."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        room = model_of(path).longest
        for batch in batches:
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                line = " " + text.replace(SPACE, " ")
                for n, s in enumerate(range(0, len(line), chunk)):
                    lo = max(0, s - room)
                    part = line[lo : s + chunk + room]
                    yield pa.record_batch({"key": [key], "at": pa.array([n], pa.int64()), "s": pa.array([s - lo], pa.int32()), "e": pa.array([min(s + chunk, len(line)) - lo], pa.int32()), "part": [part]})

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(path)
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("at", "s", "e", "part")))
            out = [_dump(model.transfer(part, s, e, n == 0)) for n, s, e, part in rows]
            yield pa.record_batch({"key": batch.column("key"), "at": batch.column("at"), "matrix": pa.array(out, pa.string())})

    def traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(path)
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("s", "e", "part", "entry", "exit")))
            out = [np.array(model.backtrace(part, s, e, tuple(json.loads(x)), tuple(json.loads(y))), "<u2").tobytes() for s, e, part, x, y in rows]
            yield pa.record_batch({"key": batch.column("key"), "at": batch.column("at"), "ids": pa.array(out, pa.binary())})

    def whole(rows: pa.Table) -> pa.Table:
        return pa.table({"key": rows.column("key")[:1], "ids": pa.array([b"".join(rows.sort_by("at").column("ids").to_pylist())], pa.binary())})

    chunks = docs.mapInArrow(trimmed(split), "key string, at long, s int, e int, part string")
    chunks = written(chunks.dropDuplicates(["key", "at"]), "chunks")  # copies once; chunks spread over tasks
    most, n_chunks = chunks.agg(F.max("at"), F.count("*")).first()
    leaves = written(chunks.mapInArrow(trimmed(matrices), "key string, at long, matrix string"), "matrices")
    states = scan(leaves, most or 0, fan).select(F.col("key").alias("s_key"), F.col("at").alias("s_at"), "entry", "exit")
    # a counted number of states, some bytes each, spares the chunks a second shuffle
    joined = chunks.join(maybe_broadcast(states, n_chunks), (F.col("key") == F.col("s_key")) & (F.col("at") == F.col("s_at")))
    ids = joined.select("key", "at", "s", "e", "part", "entry", "exit").mapInArrow(trimmed(traced), "key string, at long, ids binary")
    return ids.groupBy("key").applyInArrow(whole, "key string, ids binary")


def encoded(docs: DataFrame, path: str, view, schema: str, chunk: int = CHUNK, fan: int = FAN) -> DataFrame:
    """doc_id and what ``view(model, ids, text_crc32)``, columns by name, makes of each row's ids, in the pass that encodes
    it: no second Python worker beside the one that holds the model. Rules for odd rows: see ``encode``."""
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(path)
        for batch in batches:
            for part in by_size(batch, "text", limit=2_000_000):
                ids = model.batch(part.column("text"))
                pa.default_memory_pool().release_unused()
                yield pa.record_batch({"doc_id": part.column("doc_id")} | view(model, ids, part.column("text_crc32").to_pylist()))

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(path)
        for batch in batches:
            for part in by_size(batch, "ids", 500, 2_000_000):
                yield pa.record_batch({"doc_id": part.column("doc_id")} | view(model, part.column("ids").to_pylist(), part.column("text_crc32").to_pylist()))

    crc = F.crc32(F.col("text").cast("binary")).alias("text_crc32")
    out = f"doc_id long, {schema}"
    small = docs.where(F.length("text") <= chunk).select("doc_id", crc, "text").mapInArrow(trimmed(run), out)
    key = F.md5(F.col("text").cast("binary")).alias("key")
    large = docs.where(F.length("text") > chunk)
    found = _giant(large.select(key, "text"), path, chunk, fan)
    # the rows of giant texts are some bytes each: where their counted number allows, the ids are not shuffled again
    who = cut(large.select("doc_id", crc, key))
    return small.unionByName(found.join(maybe_broadcast(who, who.count()), "key").select("doc_id", "text_crc32", "ids").mapInArrow(trimmed(seen), out))


def encode(docs: DataFrame, path: str, chunk: int = CHUNK, fan: int = FAN) -> DataFrame:
    """(doc_id, text_crc32, ids): the ids (little-endian, 16 bits) of each row's text, as the library encodes it.

    Null and empty texts have no ids. Repeated rows and null doc_ids keep their rows; other columns are not read; an
    empty table gives no rows. Giant texts are encoded once however often they occur.
    """
    view = lambda _, ids, crc: {"text_crc32": pa.array(crc, pa.int64()), "ids": pa.array(ids, pa.binary())}
    return encoded(docs, path, view, "text_crc32 long, ids binary", chunk, fan)


def decode(coded: DataFrame, path: str) -> DataFrame:
    """coded with the decoded text: (doc_id, text_crc32, ids, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(path)
        for batch in batches:
            out = [model.decode(np.frombuffer(x, "<u2")).decode("utf-8", "replace") for x in batch.column("ids").to_pylist()]
            yield pa.record_batch({c: batch.column(c) for c in ("doc_id", "text_crc32", "ids")} | {"text": pa.array(out, pa.string())})

    return coded.select("doc_id", "text_crc32", "ids").mapInArrow(trimmed(run), "doc_id long, text_crc32 long, ids binary, text string")


def _digest(model: Pieces, ids: list[bytes], crcs: list[int]) -> dict[str, pa.Array]:
    ids = [np.frombuffer(x, "<u2") for x in ids]
    back = [crc32(model.decode(x)) for x in ids]
    return {
        "n_tokens": pa.array(map(len, ids), pa.int64()), "ids_crc32": pa.array([crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()),
        "decoded_crc32": pa.array(back, pa.int64()), "round_trip": pa.array([a == b for a, b in zip(back, crcs)], pa.bool_()),
    }


def digest(docs: DataFrame, path: str, chunk: int = CHUNK, fan: int = FAN) -> DataFrame:
    """doc_id, n_tokens, ids_crc32 (ids as little-endian unsigned 32-bit integers), decoded_crc32 and round_trip of each row."""
    return encoded(docs, path, _digest, "n_tokens long, ids_crc32 long, decoded_crc32 long, round_trip boolean", chunk, fan)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage, the last: doc_id, n_tokens and ids of every document.

    Null and empty texts have no ids; repeated rows and null doc_ids keep their rows; other columns, whatever their
    names, are not read; no documents give no rows.
    """

    def view(_: Pieces, ids: list[bytes], __: list[int]) -> dict[str, pa.Array]:
        flat = np.frombuffer(b"".join(ids), "<u2").astype(np.int32)
        ends = np.cumsum([0, *(len(x) // 2 for x in ids)]).astype(np.int32)
        return {"n_tokens": pa.array(np.diff(ends), pa.int64()), "ids": pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))}

    return encoded(docs, default_model(), view, "n_tokens long, ids array<int>")


def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(table(spark, sf_dir, "documents"), default_model())
