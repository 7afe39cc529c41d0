import numpy as np

from ledgerlens.llm import quality as q


def test_word_shapes():
    assert [q.word_shape(w) for w in ("and", "The", "NOW!!", "on,***", "a1b22", "|")] == ["a", "Aa", "A!", "a,*", "a9a9", "|"]


def test_held_out_accuracy_and_odd_rows(spark):
    rng = np.random.default_rng(0)
    rows, labels = [(9001, None, "x"), (9002, "", "x"), (None, "no id", "x"), (9003, "tie tie", "x"), (9003, "tie tie", "x")], [(9001, 1), (None, 1), (9003, None)]
    for i in range(400):
        words = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(40)]
        bad = i % 5 == 0
        rows.append((i, " ".join(w.upper() + "!!" for w in words) if bad else " ".join(words) + ".", "x"))
        labels.append((i, int(not bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    out = q.quality_scores(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    assert len(out) == len(rows)
    truth = dict(labels)
    held = [r for r in out if r.held_out and r.doc_id in truth and r.doc_id < 9000]
    assert len(held) > 50 and all(r.predicted == truth[r.doc_id] for r in held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in out)
    empty = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in q.quality_scores(docs, empty).collect()} == {0.5}
    assert q.quality_scores(docs.limit(0), empty).count() == 0


def test_scores_against_plain_python(spark):
    """The sparse dot product of each text, its n-grams counted by plain loops."""
    from math import exp
    from zlib import crc32

    mask, mix, odd = (1 << 64) - 1, 0x9E3779B1, 0x85EBCA6B
    rng = np.random.default_rng(4)
    weights = rng.normal(size=q.DIM + 1)

    def plain(text):
        words = (text or "").split()
        raw = [crc32(w.lower().encode()) for w in words]
        shape = [crc32(q.word_shape(w).encode(), 7) for w in words]
        shape = [0x9E3779B97F4A7C15 if i and words[i] == words[i - 1] else s for i, s in enumerate(shape)]
        two = [(a * mix + b * odd) & mask for a, b in zip(shape, shape[1:])]
        grams = raw + [(s + 1) & mask for s in shape] + [(a * odd + b * mix) & mask for a, b in zip(raw, raw[1:])] + two + [(a * mix + b) & mask for a, b in zip(two, shape[2:])]
        hashed = [(g * 0xD6E8FEB86659FD93) & mask for g in grams]
        places = [(x ^ (x >> 29)) & (q.DIM - 1) for x in hashed]
        w = weights.astype(np.float32).astype(float)
        dot = w[-1] + (q.SCALE * sum(w[i] for i in places) / len(places) if places else 0)
        return 1 / (1 + exp(-max(-35, min(35, dot))))

    texts = [None, "", "one", "two two two", "The QUICK brown fox, 12 times!! é ü", "x " * 30_000, *(" ".join(f"w{x}" for x in rng.integers(0, 50, 40)) for _ in range(20))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r._score for r in q.score(docs, weights, ["doc_id"]).collect()}
    assert all(abs(got[i] - plain(t)) < 1e-6 for i, t in enumerate(texts))


def test_the_driver_gives_back_what_training_held(spark, monkeypatch):
    """Rows stay as narrow as they came, and the weights are the same; the driver's memory is trimmed afterwards."""
    calls, seen, plain = [], [], q.fit

    def fit(rows):
        seen.extend(rows)
        return plain(rows)

    monkeypatch.setattr(q, "trim", lambda: calls.append(1))
    monkeypatch.setattr(q, "fit", fit)
    docs = spark.createDataFrame([(i, f"good words number {i}" if i % 2 else "bad bad bad") for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    got = q.train(docs, labels)
    assert calls == [1] and {(i.itemsize, x.itemsize) for i, x, _ in seen} == {(4, 4)}
    assert (got == plain([(i.astype(np.int64), x.astype(float), y) for i, x, y in seen])).all() and got.any()
