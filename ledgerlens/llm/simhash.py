"""SimHash near-duplicates: pigeonhole blocks, Hamming verification, connected components.

Fingerprints that differ in few bits must agree on whole blocks, so links are sought only between fingerprints that
share a block key. Exact copies collapse to one fingerprint before anything is shuffled, and each bucket returns a
spanning forest of its links (at most one row less than it has members), never all its pairs; the components are
the same. Of a bucket above ``HOT`` rows every row is compared with the bucket's smallest; only rows far from that one
meet the others, tile by tile (``tiled``), so that a group of any size needs no large task and loses no link.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import by_size, components, cut, maybe_broadcast, small_batches, table, trimmed

SEED = 42
HOT = 20_000  # rows of a bucket above which it is tiled, and rows of a tile
TILE = 8_000_000  # bytes of shingle sets in a tile
LINK_SCHEMA = "a long, b long"
BITS = 512  # of a wide fingerprint
BANDS, ROWS = 12, 3  # a pair of Jaccard s shares a band with probability 1 - (1 - s ** ROWS) ** BANDS: 0.9998 at 0.8
SLACK = 6  # standard deviations that the Hamming distance of a pair at the threshold may exceed its mean by
_ODD = np.random.default_rng(SEED).integers(1, 1 << 62, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


# ---------------------------------------------------------------- fingerprints
def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """XXH64 of every word shingle, repeats included; fewer words than ``size``: one hash of all; none: no hash."""
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    line, n = b" ".join(words), max(1, len(words) - size + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[: n - 1])).tolist()
    stops = (ends[min(size, len(words)) - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts, stops)), np.uint64, n)


def majority(hashes: np.ndarray) -> int:
    """The 64-bit fingerprint: a bit is set where over half the hashes have it; no hash: zero."""
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].astype("<u8")
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(hashes), bitorder="little").view("<u8")[0])


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """The distinct shingle hashes, sorted."""
    return np.unique(shingle_hashes(text, size))


def sign_table(bits: int, rows: int = 2048) -> np.ndarray:
    """Fixed pseudo-random signs: row h mod rows holds the ``bits`` votes of a shingle with hash h."""
    return np.random.default_rng(SEED).choice(np.array([-1, 1], np.float32), (rows, bits))


def wide_fingerprints(sets: list[np.ndarray], signs: np.ndarray) -> list[bytes]:
    """Wide fingerprints: each distinct shingle adds its own sign (the top bit of its hash) to its bucket, and the sums are
    multiplied with the sign table. The signs centre the sums, so that disjoint texts of any length have cosine 0."""
    rows = len(signs)
    sums = np.stack([np.bincount((h % np.uint64(rows)).astype(np.int64), 1.0 - 2.0 * (h >> np.uint64(63)), rows) for h in sets]).astype(np.float32)
    packed = np.packbits(sums @ signs > 0, axis=1, bitorder="little")
    return [row.tobytes() for row in packed]


# ---------------------------------------------------------------- blocks
def layout(n: int, distance: int) -> tuple[list[tuple[int, int]], int]:
    """Blocks (shift, width) of 64 bits, and how many of them a key joins.

    With b blocks, ``distance`` flips leave b - distance blocks untouched, so every linked pair shares a key whatever
    b is; b grows with the number of fingerprints, which keeps chance collisions below one a fingerprint.
    """
    for b in range(distance + 1, distance + 6):
        take = b - distance
        if comb(b, take) * n / 2 ** (64 * take / b) <= 1 or b == distance + 5:
            edges = [round(64 * i / b) for i in range(b + 1)]
            return [(lo, hi - lo) for lo, hi in zip(edges, edges[1:])], take
    raise AssertionError


def narrow_keys(blocks: list[tuple[int, int]], take: int):
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node = batch.column("node").to_numpy()
            fp = node.view(np.uint64)
            for k, chosen in enumerate(combinations(blocks, take)):
                key = np.full(len(fp), k, np.uint64)
                for lo, width in chosen:
                    key = (key << np.uint64(width)) | ((fp >> np.uint64(lo)) & np.uint64((1 << width) - 1))
                yield pa.record_batch({"key": key.view(np.int64), "node": node, "fp": batch.column("fp")})

    return keys


def bands(h: np.ndarray) -> np.ndarray:
    """The keys of a shingle set: of each band ``ROWS`` min-hashes, mixed. No shingle: no keys."""
    if not len(h):
        return np.zeros(0, np.int64)
    low = np.array([_mixed(h, k).min() for k in range(BANDS * ROWS)], np.uint64).reshape(BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for r in range(ROWS):
        key = _mixed(key ^ low[:, r], r)
    return key.view(np.int64)


def _mixed(x: np.ndarray, k: int) -> np.ndarray:
    x = x * _ODD[k]
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def band_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in (batch.slice(at, 2000) for at in range(0, batch.num_rows, 2000)):
            keys = part.column("bands").to_pylist()
            at = np.repeat(np.arange(part.num_rows), [len(x) // 8 for x in keys])
            yield pa.record_batch({"key": np.frombuffer(b"".join(keys), np.int64), "node": part.column("node").take(pa.array(at)), "fp": part.column("fp").take(pa.array(at))})


# ---------------------------------------------------------------- links inside buckets
def forest(fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """A spanning forest of the graph that links rows within ``distance`` bits (fps: rows x 64-bit words)."""
    left, out = np.arange(len(fps)), []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = np.bitwise_count(fps[left] ^ fps[at]).sum(axis=1) <= distance
            if near.any():
                found = left[near]
                out += [(at, x) for x in found]
                queue += list(found)
                left = left[~near]
    return out


def grouped_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Whole groups of rows that are sorted by ``key``, with the places where a group begins, and the end; groups may span
    batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column("key")
        held.append(batch)
        if key[0] == key[-1] and held[0].column("key")[0] == key[0]:
            continue
        rows = pa.Table.from_batches(held)
        keys = rows.column("key").to_numpy()
        cuts = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1))
        yield rows.slice(0, int(cuts[-1])), cuts
        held = rows.slice(int(cuts[-1])).to_batches()
    if held:
        rows = pa.Table.from_batches(held)
        keys = rows.column("key").to_numpy()
        yield rows, np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]))


def _words(rows: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(rows.column("fp").to_pylist()), "<u8").reshape(rows.num_rows, -1)


def bucket_links(distance: int):
    """Over partitions sorted by key: a spanning forest of the links of each bucket."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, cuts in grouped_rows(batches):
            node, fps = rows.column("node").to_numpy(), _words(rows)
            lo, hi = cuts[:-1], cuts[1:]
            two = lo[hi - lo == 2]
            near = two[np.bitwise_count(fps[two] ^ fps[two + 1]).sum(axis=1) <= distance]
            a, b = [node[near]], [node[near + 1]]
            for i in np.flatnonzero(hi - lo > 2):
                pairs = np.array(forest(fps[lo[i] : hi[i]], distance), np.int64).reshape(-1, 2) + lo[i]
                a.append(node[pairs[:, 0]])
                b.append(node[pairs[:, 1]])
            a, b = np.concatenate(a), np.concatenate(b)
            yield pa.record_batch({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return links


def tiled(rows: DataFrame, weight: Column, bound: int) -> DataFrame:
    """Deals the rows of each group ``key`` over tiles, which become the key: every far row meets every other row of its
    group in a tile; two near rows need not meet. A tile holds two shares of about ``bound``. Groups without far rows go.
    """
    share = lambda far: F.ceil(F.sum(F.when(F.col("far") == far, weight).otherwise(0)) / bound).cast("int")
    sizes = cut(rows.groupBy("key").agg(share(False).alias("nears"), share(True).alias("fars")).where("fars > 0"))
    dealt = rows.join(maybe_broadcast(sizes, sizes.count()), "key")
    own = F.pmod(F.xxhash64("node", F.lit(1)), F.greatest(F.when(F.col("far"), F.col("fars")).otherwise(F.col("nears")), F.lit(1))).cast("int")
    dealt = dealt.withColumn("own", own)
    place = lambda kind, i, j: F.xxhash64(F.lit(kind), "key", i, j)
    upto = lambda n, f: F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), f)).otherwise(F.array().cast("array<bigint>"))
    me = F.col("own")
    of_far = F.concat(upto(F.col("nears"), lambda i: place("near", me, i)), upto(F.col("fars"), lambda i: place("far", F.least(me, i), F.greatest(me, i))))
    tiles = F.when(F.col("far"), of_far).otherwise(upto(F.col("fars"), lambda i: place("near", i, me)))
    return dealt.withColumn("key", F.explode(tiles)).drop("own", "nears", "fars")


def links_of(nodes: DataFrame, keys, distance: int, hot: int = HOT) -> DataFrame:
    """Links (a, b) whose components are those of all pairs within ``distance``; nodes: (node long, fp binary)."""
    keyed = nodes.mapInArrow(keys, "key long, node long, fp binary")
    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    linked = lambda rows: rows.repartition(n, "key").sortWithinPartitions("key", "node").mapInArrow(trimmed(bucket_links(distance)), LINK_SCHEMA)
    sizes = keyed.groupBy("key").count().where(F.col("count") > hot).select(F.col("key").alias("h_key"))
    n_hot = sizes.count()
    if not n_hot:
        return linked(keyed)
    sizes = maybe_broadcast(cut(sizes), n_hot)
    rest = keyed.join(sizes, F.col("key") == F.col("h_key"), "left_anti")
    large = cut(keyed.join(sizes, F.col("key") == F.col("h_key"), "left_semi").distinct())
    hubs = large.groupBy(F.col("key").alias("h_key")).agg(F.min(F.struct("node", "fp")).alias("hub"))

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                mine, hub = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u8").reshape(batch.num_rows, -1) for c in ("fp", "h_fp"))
                far = np.bitwise_count(mine ^ hub).sum(axis=1) > distance
                yield pa.record_batch({"key": batch.column("key"), "node": batch.column("node"), "fp": batch.column("fp"), "hub": batch.column("h_node"), "far": far})

    large = large.join(maybe_broadcast(hubs, n_hot), F.col("key") == F.col("h_key")).select("key", "node", "fp", F.col("hub.node").alias("h_node"), F.col("hub.fp").alias("h_fp"))
    large = cut(large.mapInArrow(measured, "key long, node long, fp binary, hub long, far boolean"))
    to_hub = large.where("not far and node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b"))
    return linked(rest).unionByName(to_hub).unionByName(linked(tiled(large.drop("hub"), F.lit(1), hot).select("key", "node", "fp")))


# ---------------------------------------------------------------- operators
def fingerprints(docs: DataFrame, size: int = 4) -> DataFrame:
    """(doc_id, fp long) of each row by the majority rule on 64-bit shingle hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([majority(shingle_hashes(t, size)) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "fp": fp.view(np.int64)})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


def grouped(prints: DataFrame, links: DataFrame, node: str) -> DataFrame:
    """Adds component_id, the smallest doc_id of a row's component. All joins but the last are on distinct nodes."""
    roots = components(links)
    tops = prints.groupBy(node).agg(F.min("doc_id").alias("_first")).withColumnRenamed(node, "_node")
    tops = tops.join(roots, F.col("_node") == F.col("node"), "left").select("_node", "_first", F.coalesce("root", "_node").alias("_root"))
    lows = tops.groupBy("_root").agg(F.min("_first").alias("component_id"))
    found = cut(tops.select("_node", "_root").join(lows, "_root").select("_node", "component_id"))
    return prints.join(maybe_broadcast(found, found.count()), F.col(node) == F.col("_node"), "left").drop("_node")


def simhash_components(docs: DataFrame, size: int = 4, distance: int = 4) -> DataFrame:
    """One row per row of docs: doc_id, fingerprint (16 hex digits), component_id.

    Null and empty texts have the zero fingerprint and link like any other. A null doc_id keeps its row and never
    names a component; a component of null doc_ids alone has a null component_id. Repeated rows give repeated
    rows. Other columns are not read, whatever their names. No rows give no rows.
    """
    prints = cut(fingerprints(docs, size))
    nodes = cut(prints.select(F.col("fp").alias("node")).distinct())
    blocks, take = layout(nodes.count(), distance)
    packed = nodes.mapInArrow(_pack, "node long, fp binary")
    out = grouped(prints, links_of(packed, narrow_keys(blocks, take), distance), "fp")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        node = batch.column("node").to_numpy()
        yield pa.record_batch({"node": node, "fp": pa.array([x.tobytes() for x in node.astype("<i8")], pa.binary())})


def shingle_sets(texts: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """(node, s: the sorted set of shingle hashes) of each node(node, key); texts: (key, text). Other texts are not hashed."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_size(batch, "text", 500):
                made = [shingle_set(t, size).tobytes() for t in part.column("text").to_pylist()]
                yield pa.record_batch({"node": part.column("node"), "s": pa.array(made, pa.binary())})

    wanted = cut(nodes.select("node", "key"))
    found = texts.join(maybe_broadcast(wanted, wanted.count()), "key").select("node", "text").mapInArrow(trimmed(sets), "node long, s binary")
    return found.groupBy("node").agg(F.first("s").alias("s"))


def similar(texts: DataFrame, nodes: DataFrame, links: DataFrame, size: int, similarity: float) -> DataFrame:
    """The links (a, b) whose shingle sets have a Jaccard similarity of at least ``similarity``, counted exactly.

    texts: (key, text); nodes: (node, key) with the key of a text that has the node's set.
    """

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                x, y = (np.frombuffer(batch.column(c)[i].as_buffer(), np.uint64) for c in ("sa", "sb"))
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok[i] = both >= similarity * (len(x) + len(y) - both)
            yield pa.record_batch({"a": batch.column("a"), "b": batch.column("b")}).filter(pa.array(ok))

    ends = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    found = cut(shingle_sets(texts, nodes.select("node", "key").join(ends, "node"), size))
    left, right = found.select(F.col("node").alias("a"), F.col("s").alias("sa")), found.select(F.col("node").alias("b"), F.col("s").alias("sb"))
    return links.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(trimmed(decide), LINK_SCHEMA)


def set_links(distance: int, similarity: float):
    """Over partitions sorted by key (rows: key, node, fp, firm, s: the sorted set): links between rows of different
    components ``firm`` whose sets have the similarity, until none joins any more; a link joins its components."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, cuts in grouped_rows(batches):
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if hi - lo < 2:
                    continue
                part = rows.slice(lo, hi - lo)
                node, fps, firm = part.column("node").to_numpy(), _words(part), part.column("firm").to_numpy().copy()
                sets = [np.frombuffer(x, np.uint64) for x in part.column("s").to_pylist()]
                n = np.array([len(x) for x in sets])
                ends = np.cumsum(n)
                ids = np.unique(np.concatenate(sets), return_inverse=True)[1]
                member = np.zeros(int(ids.max(initial=-1)) + 1, np.int64)
                kinds, many = np.unique(firm, return_counts=True)
                home = kinds[many.argmax()]  # two rows of the largest component need not meet
                a, b = [], []
                for i in np.flatnonzero(firm != home).tolist():
                    near = (firm != firm[i]) & (np.bitwise_count(fps ^ fps[i]).sum(axis=1) <= distance) & (np.minimum(n, n[i]) >= similarity * np.maximum(n, n[i]))
                    at = np.flatnonzero(near & (n > 0))
                    if not len(at):
                        continue
                    mine = ids[ends[i] - n[i] : ends[i]]
                    member[mine] = 1
                    steps = np.cumsum(n[at])
                    flat = np.repeat(ends[at] - steps, n[at]) + np.arange(steps[-1])
                    both = np.add.reduceat(member[ids[flat]], steps - n[at])
                    member[mine] = 0
                    for j in at[both >= similarity * (n[i] + n[at] - both)].tolist():
                        if firm[j] != firm[i]:
                            a.append(node[i])
                            b.append(node[j])
                            firm[firm == firm[i]] = firm[j]
                a, b = np.array(a, np.int64), np.array(b, np.int64)
                yield pa.record_batch({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return links


def exact_links(nodes: DataFrame, texts: DataFrame, keys, distance: int, size: int, similarity: float) -> DataFrame:
    """Links (a, b) of at least that similarity, with the components of all such pairs that share a key and are within
    ``distance``. nodes: (node, key, fp, bands); texts: (key, text).

    The buckets' forests are checked first. Where that broke a group into several components, the rows outside its
    largest component meet all others of the group with their sets, in tiles of bounded bytes; what is returned is
    a forest again, so no task and no table holds all pairs of a group.
    """
    links = cut(links_of(nodes.select("node", "bands", "fp"), keys, distance).distinct())
    good = cut(similar(texts, nodes, links, size, similarity))
    if good.count() == links.count():
        return good
    loose = components(links).select(F.col("node").alias("p_node"), F.col("root").alias("key"))
    firm = components(good).select(F.col("node").alias("f_node"), F.col("root").alias("firm"))
    parts = cut(loose.join(firm, F.col("p_node") == F.col("f_node"), "left").select("p_node", "key", F.coalesce("firm", "p_node").alias("firm")))
    # of each broken group the largest component
    each = parts.groupBy("key", "firm").count()
    main = cut(each.groupBy(F.col("key").alias("m_key")).agg(F.max_by("firm", F.struct("count", "firm")).alias("main"), F.count("*").alias("parts")).where("parts > 1").drop("parts"))
    rows = parts.join(maybe_broadcast(main, main.count()), F.col("key") == F.col("m_key"))
    rows = cut(rows.select("p_node", "key", "firm", (F.col("firm") != F.col("main")).alias("far")))
    wanted = nodes.select("node", F.col("key").alias("t_key"), "fp").join(rows, F.col("node") == F.col("p_node"))
    sets = shingle_sets(texts, wanted.select("node", F.col("t_key").alias("key")), size)
    held = wanted.select(F.col("node").alias("w_node"), "fp", "key", "firm", "far").join(sets, F.col("w_node") == F.col("node")).select("key", "node", "fp", "firm", "far", "s")
    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = tiled(cut(held), F.length("s") + F.lit(100), TILE).select("key", "node", "fp", "firm", "s")
    more = dealt.repartition(n, "key").sortWithinPartitions("key", "node").mapInArrow(trimmed(set_links(distance, similarity)), LINK_SCHEMA)
    return cut(good.unionByName(more))


def wide_links(docs: DataFrame, size: int = 5, similarity: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(doc_id, key, row, node) of each row, key and row being hashes of the text and of all columns, and the links
    (a, b) of nodes whose sets of shingles have at least that Jaccard similarity.

    Equal sets are one node. Candidates share a band of min-hashes, whose number and width do not depend on the table's
    size, so neither does the share of pairs found: blocks of fingerprint bits would have to become wider and more with
    it. Inside a bucket the Hamming distance of wide fingerprints sorts out what is far: a set pair of Jaccard s has
    cosine c = 2s / (1 + s), and its fingerprints differ in a share arccos(c) / pi of their bits (0.15 at s = 0.8) with a
    binomial spread, of which ``SLACK`` deviations are allowed. The exact similarity of the sets then decides.
    """
    share = np.arccos(2 * similarity / (1 + similarity)) / np.pi
    distance = int(BITS * share + SLACK * (BITS * share * (1 - share)) ** 0.5)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"), row_hash(docs).alias("row"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signs = sign_table(BITS)
        for batch in batches:
            for part in by_size(batch, "text", 500):
                sets = [shingle_set(t, size) for t in part.column("text").to_pylist()]
                node = np.array([xxhash.xxh64_intdigest(x.tobytes(), SEED) for x in sets], np.uint64).view(np.int64)
                yield pa.record_batch({"doc_id": part.column("doc_id"), "key": part.column("key"), "row": part.column("row"), "node": node, "fp": pa.array(wide_fingerprints(sets, signs), pa.binary()), "bands": pa.array([bands(x).tobytes() for x in sets], pa.binary())})

    prints = cut(docs.mapInArrow(trimmed(run), "doc_id long, key long, row long, node long, fp binary, bands binary"))
    nodes = cut(prints.groupBy("node").agg(F.min("fp").alias("fp"), F.min("bands").alias("bands"), F.min("key").alias("key")))
    links = exact_links(nodes, docs.select("key", "text"), band_keys, distance, size, similarity)
    return prints.select("doc_id", "key", "row", "node"), links


def row_hash(docs: DataFrame) -> Column:
    """A hash of all columns of a row and of which of them are null."""
    return F.xxhash64(*(docs[c] for c in docs.columns), *(docs[c].isNull() for c in docs.columns))


def wide_components(docs: DataFrame) -> DataFrame:
    """doc_id, node and component_id of each row by ``wide_links``."""
    prints, links = wide_links(docs)
    return grouped(prints.select("doc_id", "node"), links, "node")


def near_dedup(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each group of near copies one row stays, that with the smallest doc_id (null ids last), then the
    smallest hash of the text and of the row.

    Groups are those of the texts, whatever their doc_ids: rows that share a doc_id, or have none, stay where their
    texts are in different groups. Documents without a word (null, empty, white space) are one group.
    """
    small_batches(spark)
    prints, links = wide_links(docs)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key", "row")).alias("first")
    tops = prints.groupBy("node").agg(first)
    roots = components(links).select(F.col("node").alias("r_node"), "root")
    tops = tops.join(roots, F.col("node") == F.col("r_node"), "left").groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("first").alias("first"))
    kept = cut(tops.select(F.col("first.row").alias("row")))
    rows = prints.groupBy("row").count()
    gone = cut(rows.join(kept, "row", "left_anti").select(F.col("row").alias("_other")))
    keyed = docs.select(F.struct(*docs.columns).alias("_doc"), row_hash(docs).alias("_hash"))
    out = keyed.join(maybe_broadcast(gone, gone.count()), F.col("_hash") == F.col("_other"), "left_anti")
    # rows that are equal in every column
    twice = cut(rows.where("count > 1").join(kept, "row", "left_semi").select(F.col("row").alias("_other")))
    if n_twice := twice.count():
        twice = maybe_broadcast(twice, n_twice)
        single = out.join(twice, F.col("_hash") == F.col("_other"), "left_anti")
        out = single.unionByName(out.join(twice, F.col("_hash") == F.col("_other"), "left_semi").dropDuplicates())
    return out.select("_doc.*")


def op5_simhash(spark, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))
