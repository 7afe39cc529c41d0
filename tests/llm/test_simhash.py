import numpy as np
import xxhash

from ledgerlens.llm import simhash as s
from ledgerlens.llm.common import components


def brute(pairs):
    top = {}

    def find(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        top[b] = a
    return {x: find(x) for x in list(top)}


def test_components(spark):
    rng = np.random.default_rng(1)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 120, (90, 2))] + [(200 + i, 201 + i) for i in range(40)]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = brute([p for p in pairs if p[0] != p[1]])
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_fingerprint(text):
    words = [w for w in (text or "").encode().lower().split()]
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_operator_against_brute_force(spark):
    rng = np.random.default_rng(2)
    base = [" ".join(rng.choice(["alpha", "Beta", "gamma", "Ünder", "x"], 300)) for _ in range(12)]
    texts = [None, "", "  \n ", "one two", "One TWO"] + base + base[:3]
    for t in base[:6]:
        for k in (1, 2, 3):
            w = t.split()
            w[7 * k] = "changed"
            texts.append(" ".join(w))
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(None, base[0], "clash"), (3, "one two", "clash")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    out = s.simhash_components(docs).collect()
    assert len(out) == len(rows)
    fps = [plain_fingerprint(t) for _, t, _ in rows]
    ids = [i for i, _, _ in rows]
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 4 and label[a] != label[b]:
                old, new = label[a], label[b]
                label = [new if x == old else x for x in label]
    want = sorted((ids[i] if ids[i] is not None else -1, f"{fps[i]:016x}", min(ids[j] for j in range(len(rows)) if label[j] == label[i] and ids[j] is not None)) for i in range(len(rows)))
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.fingerprint, r.component_id) for r in out)
    assert got == want
    assert s.simhash_components(docs.limit(0)).count() == 0


def test_hot_bucket_is_split_without_loss(spark):
    rng = np.random.default_rng(3)
    centre = 0x0123456789ABCDEF
    fps = {centre}
    while len(fps) < 150:
        x = centre
        for b in rng.integers(0, 64, 5):
            x ^= 1 << int(b)
        fps.add(x)
    fps = sorted(fps)
    nodes = spark.createDataFrame([(x if x < 1 << 63 else x - (1 << 64),) for x in fps], "node long").mapInArrow(s._pack, "node long, fp binary")
    blocks, take = s.layout(len(fps), 4)
    signed = [x if x < 1 << 63 else x - (1 << 64) for x in fps]
    want = brute([(signed[i], signed[j]) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4])
    for hot in (10, 10_000):
        links = s.links_of(nodes, s.narrow_keys(blocks, take), 4, hot)
        assert {r.node: r.root for r in components(links).collect()} == want


def test_near_dedup_keeps_one_of_each_group(spark):
    rng = np.random.default_rng(4)
    docs = [" ".join(f"w{x}" for x in rng.integers(0, 4000, 400)) for _ in range(30)]
    near = []
    for t in docs[:10]:
        w = t.split()
        w[50] = w[250] = "other"
        near.append(" ".join(w))
    rows = [(i, t) for i, t in enumerate(docs + near + docs[10:15])]
    out = s.near_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert sorted(r.doc_id for r in out.collect()) == list(range(30))


def test_long_unrelated_texts_are_no_copies(spark):
    rng = np.random.default_rng(6)
    texts = [" ".join(f"{i}w{x}" for x in rng.integers(0, 9000, 20_000)) for i in range(6)]
    rows = list(enumerate([*texts, texts[0] + " one more"]))
    out = s.near_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert sorted(r.doc_id for r in out.collect()) == list(range(6))
    fps = [np.unpackbits(np.frombuffer(x, np.uint8)) for x in s.wide_fingerprints([s.shingle_set(t, 5) for t in texts], s.sign_table(512))]
    assert min(int((fps[i] != fps[j]).sum()) for i in range(6) for j in range(i)) > 180


def jaccard(x, y, size=5):
    x, y = (set(map(tuple, (w[i : i + size] for i in range(len(w) - size + 1)))) for w in (x.split(), y.split()))
    return len(x & y) / len(x | y)


def test_only_pairs_at_the_threshold_are_linked(spark):
    rng = np.random.default_rng(7)
    texts = []
    for k in range(25):
        w = [f"{k}v{x}" for x in rng.integers(0, 9000, 300)]
        for m in range(4):  # some pairs of each group are above 0.8, others below
            v = list(w)
            for p in rng.choice(290, 3 * m, replace=False):
                v[p] = f"new{m}"
            texts.append(" ".join(v))
    pairs = {(i, j): jaccard(texts[i], texts[j]) for i in range(100) for j in range(i + 1, 4 * (i // 4) + 4)}
    want = brute([p for p, x in pairs.items() if x >= 0.8])
    want = [want.get(i, i) for i in range(100)]
    got = {r.doc_id: r.component_id for r in s.wide_components(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert 25 < len(set(want)) < 100
    assert all(want[i] == want[g] for i, g in got.items())  # nothing below the threshold is linked
    assert [got[i] for i in range(100)] == want


def test_pairs_just_above_the_threshold_are_found(spark):
    rng = np.random.default_rng(8)
    texts = []
    for k in range(150):
        w = [f"{k}v{x}" for x in rng.integers(0, 9000, 504)]
        v = list(w)
        for p in range(0, 11):
            v[20 + 40 * p] = "changed"
        texts += [" ".join(w), " ".join(v)]
    texts += ["a b c d e f g h", "a b c d e f g h i", "A B  c d e f g h I", "a b c d"]
    assert all(0.8 <= jaccard(texts[2 * k], texts[2 * k + 1]) < 0.81 for k in range(150))
    out = {r.doc_id: r.component_id for r in s.wide_components(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [out[300 + i] for i in range(4)] == [300, 300, 300, 303]
    assert sum(out[2 * k + 1] == 2 * k for k in range(150)) >= 149
    assert all(out[2 * k] == 2 * k for k in range(150))


def test_near_dedup_keeps_a_row_of_each_group_whatever_the_ids(spark):
    rng = np.random.default_rng(9)
    a, b, c, d, e = (" ".join(f"{k}w{x}" for x in rng.integers(0, 4000, 200)) for k in range(5))
    rows = [(None, a, "x"), (None, b, "x"), (None, a + " more", "x"), (7, c, "x"), (7, d, "x"), (7, d, "x"), (8, d, "x"), (5, e, None), (5, e, "y"), (None, None, "x"), (9, " ", "x")]
    out = s.near_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string, source string"), "").collect()
    assert len(out) == 6
    assert {(r.doc_id, r.text) for r in out} in ({(None, x), (None, b), (7, c), (7, d), (5, e), (9, " ")} for x in (a, a + " more"))
