import math

from pyspark.sql import functions as F

from ledgerlens.operators import forecast, gate, quality, reconcile, resolve, retrieval, rules, signals


def test_implied_value_branches(spark):
    df = spark.createDataFrame([(1.2, 100, 12000.0), (-1.2, 100, 5.0), (1.0, 0, 5.0), (0.0, 5, 0.0), (0.0, 5, 1.0), (1.0, 1, None)], "rev double, n int, actual double")
    out = quality.implied_value(df, F.col("rev"), F.col("n"), F.col("actual"), scale=1e6).collect()
    assert [r.status for r in out] == ["pass", "pass", "missing", "pass", "fail", "missing"]
    assert out[0].expected == 12000 and out[0].delta == 0


def test_alignment_and_rules(spark):
    a, b = spark.createDataFrame([(1,), (2,), (None,)], "k int"), spark.createDataFrame([(2,), (3,)], "k int")
    assert {r.side: r["keys"] for r in quality.alignment(a, b, "k").collect()} == {"left_only": 1, "both": 1, "right_only": 1}
    df = spark.createDataFrame([(i, -i) for i in range(8)], "id int, v int")
    assert [r.id for r in quality.violating_rows(df, [quality.in_range("v", 0)], ["id"], first=3).orderBy("id").collect()] == [1, 2, 3]
    assert quality.schema_differences(df, [("v", "int"), ("id", "int")]) == ["columns out of order"]
    assert quality.schema_differences(df, [("id", "bigint"), ("x", "int")]) == ["missing column x", "unexpected column v", "column id is int, not bigint"]
    found = spark.createDataFrame([("error",), ("info",)], "severity string")
    assert tuple(quality.run_passed(found).first()) == (False, 1, 0, 1)


def test_best_evidence_order(spark):
    rows = [("k", 1.0, "ranking", "b", 0.9, "2024-01-01"), ("k", 2.0, "ranking", "a", 0.9, "2024-01-01"), ("k", 3.0, "other", "a", 1.0, "2024-02-01"), ("k", None, "sec_filing", "a", 1.0, "2024-02-01"), ("m", 4.0, "other", "z", None, None), ("m", 5.0, "other", "y", 0.0, "2020-01-01")]
    df = spark.createDataFrame(rows, "key string, value double, source_type string, source_name string, confidence double, as_of_date string")
    out = {r.key: r.value for r in reconcile.best_evidence(df, ["key"], reconcile.PRIMARY_PRIORITY).collect()}
    assert out == {"k": 2.0, "m": 5.0}


def test_gate_cases(spark):
    rows = [("m", 1.0, 1.0, "s", 0.95, "A", 0.0, "estimated", False, False, False), ("m", 1.0, None, None, None, "MISSING", None, "reported", False, False, False), ("m", 1.0, 1.0, "s", 0.95, "A", 0.0, "reported", False, False, False)]
    df = spark.createDataFrame(rows, "metric string, value double, reference_value double, source_name string, confidence double, grade string, relative_error double, method string, hard_fail boolean, finding boolean, provenance_missing boolean")
    out = gate.decide(df, gate.Policy("1", (gate.MetricPolicy("m"),))).collect()
    assert [(r.status, r.blocking, r.warnings) for r in out] == [("advisory", [], ["method not publishable"]), ("blocked", ["evidence missing"], []), ("publishable", [], [])]


def test_signal_interpretation_golden_scores(spark):
    sets = {"empty": [("unknown", "f")], "weak": [("weak", "f")], "moderate": [("moderate", "f")], "strong": [("strong", "f")], "all": [("weak", "a"), ("moderate", "b"), ("strong", "c")], "unnamed": [("unknown", None)]}
    df = spark.createDataFrame([(k, s, f, "type") for k, v in sets.items() for s, f in v], "case string, strength string, field_name string, signal_type string")
    out = {r.case: (r.score, r.review) for r in signals.interpret(df, ["case"]).collect()}
    assert out == {"empty": (0, False), "weak": (10, False), "moderate": (25, True), "strong": (45, True), "all": (90, True), "unnamed": (5, False)}


def test_heaping_and_outliers(spark):
    df = spark.createDataFrame([(float(5 * i),) for i in range(20)], "v double")
    r = signals.end_digit_heaping(df, ["v"]).first()
    assert r.share == 1 and math.isclose(r.z, 0.8 / math.sqrt(0.2 * 0.8 / 20)) and r.strength == "moderate"
    df = spark.createDataFrame([(i, float(i % 5)) for i in range(40)] + [(99, 1000.0)], "k int, v double")
    assert [(x.k, x.strength) for x in signals.robust_outliers(df, "k", "v").collect()] == [(99, "moderate")]


def test_isolation_forest_finds_the_far_row(spark):
    rows = [(i, float(i % 7), float(i % 11)) for i in range(200)] + [(999, 80.0, -60.0)]
    out = signals.isolation_forest(spark.createDataFrame(rows, "k long, a double, b double"), "k", ["a", "b"]).orderBy(F.desc("score")).first()
    assert out.k == 999 and out.flagged and out.strength == "moderate"


def test_forecast_hand_values(spark):
    rows = [("a", i, float(v)) for i, v in enumerate([1, 2, 3, 9])]
    split = forecast.time_split(spark.createDataFrame(rows, "e string, d int, v double"), "e", "d", 1, 3)
    s = forecast.train_state(split, "e", "d", "v").first()
    assert (s.naive, s.rolling, s.smoothed, s.scale) == (3.0, 2.0, 2.25, 1.0)
    short = forecast.time_split(spark.createDataFrame(rows[:2], "e string, d int, v double"), "e", "d", 1, 3)
    assert {r.part for r in short.collect()} == {"dropped_short"}
    flat = spark.createDataFrame([("a", 0.0, 0.0, None), ("a", 2.0, 1.0, 1.5)], "b string, forecast double, actual double, scale double")
    m = forecast.metrics(flat, ["b"]).first()
    assert (m.mase, m.smape) == (0.666667, 0.666667)


def test_chunks(spark):
    long, para = "x" * 2000, "p" * 400
    docs = spark.createDataFrame([(1, long), (2, "  "), (3, "\n\n".join([para, para, para])), (4, None), (5, f"{para}\n\n{long}\n\nend")], "doc_id int, text string")
    out = {}
    for r in retrieval.chunks(docs, "doc_id", "text").orderBy("doc_id", "chunk_no").collect():
        out.setdefault(r.doc_id, []).append(len(r.chunk))
    assert out == {1: [900, 900, 440], 2: [0], 3: [802, 400], 4: [0], 5: [400, 900, 900, 440, 3]}


def test_bm25_idf_and_fill(spark):
    docs = spark.createDataFrame([(1, "apple pie"), (2, "plain text"), (3, "other words")], "doc_id int, text string")
    q = spark.createDataFrame([(1, "apple")], "q int, text string")
    out = retrieval.bm25(docs, "doc_id", "text", q, "q", "text", 3).orderBy("rank").collect()
    assert [r.doc_id for r in out] == [1, 2, 3] and out[1].score == 0
    assert math.isclose(out[0].score, math.log(1 + 2.5 / 1.5), abs_tol=1e-6)


def test_ndcg_hand_value(spark):
    results = spark.createDataFrame([(1, "b", 1), (1, "a", 2)], "q int, d string, rank int")
    relevant = spark.createDataFrame([(1, "a", 2), (1, "b", 1)], "q int, d string, grade int")
    r = retrieval.ir_metrics(results, relevant, "q", "d", 2).first()
    assert (r.recall, r.mrr, r.ndcg) == (1.0, 1.0, 0.796708)


def test_fuzzy_resolution(spark):
    names = spark.createDataFrame([("Chick fil A",), ("McDonalds Corp",), ("Wendyss",), ("zzz",), (" ",)], "n string")
    aliases = spark.createDataFrame([("chickfila", "Chick-fil-A"), ("wendys", "Wendy's"), ("mcdonaldscorporation", "McDonald's")], "alias_key string, canonical string")
    out = {r.n: (r.canonical, r.match) for r in resolve.resolve_fuzzy(names, aliases, "n").collect()}
    assert out["Chick fil A"] == ("Chick-fil-A", "exact_alias") and out["Wendyss"] == ("Wendy's", "fuzzy_medium")
    assert out["zzz"] == (None, "unmatched") and out[" "] == (None, "missing")


def test_stack_and_readiness(spark):
    df = spark.createDataFrame([(1, 1, 1, "A"), (2, 0, 0, "A"), (3, 0, 1, "A")], "k int, errors int, sources int, grade string")
    df = df.withColumn("readiness", rules.readiness(F.col("errors"), F.col("sources"), F.col("grade")))
    df = rules.archetypes(df, [("x", F.lit(True), F.lit(1.0))], ("y", 0.5))
    out = [(r.k, r.rule, r.priority) for r in rules.stack(df, "k", [("x", "now", 1, "ready"), ("x", "always", 2, "hold")]).orderBy("k", "priority").collect()]
    assert out == [(1, "foundation", 1), (1, "always", 2), (2, "always", 1), (3, "now", 1), (3, "always", 2)]


def test_filters_and_dense_blocks(spark):
    df = spark.createDataFrame([(1, ["a", "b"], '{"k": 2}'), (2, ["c"], '{"k": 3}')], "i int, tags array<string>, props string")
    assert [r.i for r in df.where(retrieval.matches({"tags": ["b", "z"], "$.k": 2}, "props", ("tags",))).collect()] == [1]
    v = spark.createDataFrame([(i, [math.cos(i), math.sin(i)]) for i in range(30)], "vec_id int, e array<double>")
    asked = v.withColumnRenamed("vec_id", "q")
    whole, blocks = (sorted(map(tuple, retrieval.dense(v, "vec_id", "e", asked, "q", 3, rows=n).select("q", "vec_id", "rank").collect())) for n in (100, 7))
    assert whole == blocks and len(whole) == 90


def test_quantiles_in_brackets_are_exact(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    for values in (rng.normal(size=5000), rng.integers(0, 9, 5000).astype(float), np.ones(3000)):
        df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
        shares = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
        got = signals.quantiles(df, F.col("v"), shares, accuracy=200, small=10)
        assert np.allclose(got, np.quantile(values, shares), atol=1e-9), got
    assert signals.quantiles(df.limit(0), F.col("v"), [0.5]) == [None]


def test_forest_scores_against_plain_recursion():
    import numpy as np

    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 3))
    forest = signals.Forest(x, trees=20)

    def depth(node, row):
        return node[0] if len(node) == 1 else depth(node[2] if row[node[0]] < node[1] else node[3], row)

    c = 2 * (np.log(255) + 0.5772156649) - 2 * 255 / 256
    want = [2 ** (-np.mean([depth(t, r) for t in forest.trees]) / c) for r in x]
    assert np.allclose(forest.score(x), want)


def test_fuzzy_resolution_against_all_pairs(spark):
    """Every name against every alias: blocking by two-letter pieces must lose none."""
    import random
    from difflib import SequenceMatcher

    rng = random.Random(2)
    aliases = ["".join(rng.choices("abcdeg", k=rng.randint(4, 9))) for _ in range(40)]
    names = []
    for _ in range(120):
        a = list(rng.choice(aliases))
        for _ in range(rng.randint(0, 2)):
            a[rng.randrange(len(a))] = rng.choice("abcdegx")
        names.append("".join(a))
    side = spark.createDataFrame([(a, a.upper()) for a in sorted(set(aliases))], "alias_key string, canonical string")
    out = resolve.resolve_fuzzy(spark.createDataFrame([(n,) for n in sorted(set(names))], "n string"), side, "n").collect()
    for r in out:
        ratio, best = max((SequenceMatcher(None, r.n, a).ratio(), a) for a in set(aliases))
        want = "exact_alias" if r.n in aliases else "fuzzy_high" if ratio >= 0.93 else "fuzzy_medium" if ratio >= 0.85 else "unmatched"
        assert r.match == want and (want == "unmatched" or r.canonical == best.upper()), (r, ratio, best)
