import random

import regex

from ledgerlens.llm import decontaminate as d
from ledgerlens.llm import queries

ITEMS = [
    (1, "The train leaves the old station at 9:15 and covers 240 km in 3 hours, so how fast does the train go on average that day?"),
    (2, "After lunch, Anna Berg gave 12 apples to her friend and later that day Anna Berg gave 12 more to the same friend again"),
    (3, "too short here"),
    (4, None),
    (5, "exactly six words stand right here"),
    (None, "an item without an id is never reported for any document at all by this operator"),
]


def docs_of(spark):
    one, two = ITEMS[0][1], ITEMS[1][1]
    rows = [
        (1, "Some words before. " + one + " And after."),
        (2, regex.sub("[,?.]", "", one).upper().replace("9:15", "9:15")),
        (3, one.replace("240 km", "512 miles").replace("3 hours", "7 days")),
        (4, two.replace("Anna Berg", "Marta").replace("12", "30")),
        (5, two.replace("gave 12 apples", "gave 30 apples")),  # one value, two values here
        (6, " ".join(two.split()[:9]) + " something else entirely now"),
        (7, None),
        (8, ""),
        (9, "clean words " * 40),
        (10, "we know exactly six words stand right here today"),
        (11, "too short here"),
        (None, one),
        (1, "Some words before. " + one + " And after."),
    ]
    return rows, spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, item_id string")


def test_planted_cases(spark):
    rows, docs = docs_of(spark)
    bench = spark.createDataFrame([(*r, "x") for r in ITEMS + ITEMS[:1]], "item_id long, text string, tokens string")
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.item_id, r.kind) for r in d.contamination(docs, bench).collect())
    verbatim, changed = "verbatim", "re-parameterised"
    assert got == [(-1, 1, verbatim), (1, 1, verbatim), (1, 1, verbatim), (2, 1, verbatim), (3, 1, changed), (4, 2, changed), (10, 5, verbatim)]
    assert d.contamination(docs.limit(0), bench).count() == 0
    assert d.contamination(docs, bench.limit(0)).count() == 0


def test_template_and_slots(spark):
    df = spark.createDataFrame([("In 3.5 km from Paris, the big John Smith ran -12 miles.",), (None,)], "text string")
    from pyspark.sql import functions as F

    t, v = df.select(d.template(F.col("text")), d.slots(F.col("text"))).first()
    n, a, u = d.NUM, d.NAME, d.UNIT
    assert t == ["in", n, u, "from", a, "the", "big", a, "ran", n, u]
    assert (v.num, [x.strip() for x in v.unit], v.name) == (["3.5", "-12"], ["km", "miles"], ["Paris", "John Smith"])


def brute(docs, items):
    """Items of plain lower-case words: windows of 8 words, 13 of the item's covered."""
    out = set()
    for doc, text in docs:
        words = text.split()
        at = {}
        for i in range(len(words) - 7):
            at.setdefault(tuple(words[i : i + 8]), []).append(i)
        for item, t in items:
            w = t.split()
            covered = {p for k in range(len(w) - 7) if tuple(w[k : k + 8]) in at for p in range(k, k + 8)}
            if len(covered) >= min(13, len(w)):
                out.add((doc, item, len(covered)))
    return out


def test_against_brute_force(spark):
    rng = random.Random(3)
    words = ["alpha", "beta", "gamma", "delta", "eta"]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(9, 30)))) for i in range(12)]
    docs = []
    for i in range(80):
        text = " ".join(rng.choices(words, k=30))
        if i % 2:
            w = rng.choice(items)[1].split()
            lo = rng.randint(0, 4)
            text += " " + " ".join(w[lo : lo + rng.randint(5, 25)]) + " " + text
        docs.append((i, text))
    got = {(r.doc_id, r.item_id, r.n_tokens) for r in d.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == brute(docs, items) and got


def test_no_python_in_the_plan(spark):
    assert "op6_decontaminate" in queries.QUERIES
    _, docs = docs_of(spark)
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    plan = d.contamination(docs, bench)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_items_rich_in_placeholders(spark):
    items = [(1, "What is 12 plus 5 times 3 minus 7?"), (2, "If 3 x + 4 y = 10 and 2 x - 5 y = 7, find x and y."), (3, "add 1, 2, 3 to 4, 5, 6 or 7, 8, 9 then halve 10, 11, 12 again"), (4, "1 and 2 and 3, 4, 5, 6, 7")]
    docs = [(i, f"Some words before that: {t} And some after it.") for i, t in items]
    docs += [(11, "so what is 30 plus 8 times 4 minus 9 then"), (12, docs[1][1].replace("= 7", "= 9")), (13, "add 21, 22, 23 to 24, 25, 26 or 27, 28, 29 then halve 30, 31, 32 again"), (14, "1 and 2 and 3, 4, 5, 6, 8"), (15, "add 1, 2, 3 to 4, 5, 6 or 7, 8, 9 then double 10, 11, 12 again")]
    got = {(r.doc_id, r.item_id, r.kind) for r in d.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {(i, i, "verbatim") for i in (1, 2, 3, 4)} | {(10 + i, i, "re-parameterised") for i in (1, 2, 3)}


def test_long_runs_and_sentence_starts(spark):
    """Twenty thousand capitalised words, or joined numbers, in a row must not end the JVM."""
    item = "Alice has 5 apples and then buys 7 more from the shop near her house. Boris eats 2 of them after dinner"
    other = item.replace("Alice", "Maria").replace("Boris", "Carl").replace(" 5 ", " 9 ").replace(" 7 ", " 8 ")
    rows = [(1, " ".join(f"Word{'abcdefghij'[i % 10]}" for i in range(20_000))), (2, ",".join(str(i) for i in range(20_000))), (3, "so " + other), (4, item.lower()), (5, item.upper()), (6, "Nora " + item), (7, "Anna Berg " * 20_000 + ". " + item)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, item), (1, "quite another item of more than eight plain words under the same id")], "item_id long, text string")
    got = {(r.doc_id, r.kind) for r in d.contamination(docs, bench).collect()}
    assert got == {(3, "re-parameterised"), (4, "verbatim"), (5, "verbatim"), (6, "verbatim"), (7, "verbatim")}
    more = docs.unionByName(spark.createDataFrame([(8, "well, quite another item of more than eight plain words under the same id")], "doc_id long, text string"))
    assert {r.doc_id for r in d.contamination(more, bench).collect()} == {3, 4, 5, 6, 7, 8}
