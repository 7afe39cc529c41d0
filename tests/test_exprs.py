from pyspark.sql import functions as F

from ledgerlens.functions import exprs as e


def values(spark, texts, column, kind="string"):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, t {kind}")
    return [r[1] for r in df.select("i", column(F.col("t")).alias("x")).orderBy("i").collect()]


def test_ranges(spark):
    got = values(spark, ["6-8", "8–12%", "5", "1,200~1,400", "a", "1-2-3", None, "-5"], e.numeric_range)
    assert [tuple(r) for r in got] == [(6, 8, 7), (8, 12, 10), (5, 5, 5), (1200, 1400, 1300), (None,) * 3, (None,) * 3, (None,) * 3, (5, 5, 5)]


def test_keys_and_text(spark):
    assert values(spark, ["A&W", "Café  O’Neil"], e.lookup_key) == ["aw", "cafeoneil"]
    assert values(spark, ["A&W"], e.resolver_key) == ["aandw"]
    assert values(spark, [" x ", " ", "nan", None], e.clean_text) == ["x", None, "nan", None]
    assert values(spark, ["nan", "a\r\nb"], lambda c: e.clean_text(c, True)) == [None, "a\r\nb"]
    assert values(spark, ["a\r\nb\rc"], e.normalise_newlines) == ["a\nb\nc"]
    assert values(spark, ["--A b_C!"], e.slug) == ["a-b-c"]
    assert values(spark, ["$1,200.5", "-", "1.2.3", ""], e.safe_double) == [1200.5, None, None, None]
    assert values(spark, ["2.5", "3.5", "x"], e.whole_number) == [2, 4, None]


def test_grades(spark):
    assert values(spark, [0.02, 0.05, 0.10, 0.20, 0.2001, None], e.relative_grade, "double") == ["A", "B", "C", "D", "F", "MISSING"]
    assert values(spark, [0, 1, 3, 5, 6], e.rank_grade, "int") == ["A", "B", "C", "D", "F"]
    assert values(spark, [0.9, 0.75, 0.6, 0.4, 0.1, None], e.confidence_grade, "double") == ["A", "B", "C", "D", "F", "MISSING"]
    row = spark.range(1).select(e.worst_grade(F.lit("A"), F.lit("MISSING"), F.lit("C")).alias("a"), e.worst_grade(F.lit("MISSING")).alias("b")).first()
    assert tuple(row) == ("C", "MISSING")


def test_digits(spark):
    assert values(spark, [1000.0, 0.00123, 99.9, -4.0, 0.0, 9.999999], lambda c: e.leading_digits(c, 1), "double") == [1, 1, 9, None, None, 9]
    assert values(spark, [1000.0, 123.4], lambda c: e.leading_digits(c, 2), "double") == [10, 12]
    assert values(spark, [-12.5, 0.0, 13.5], e.end_digit, "double") == [2, 0, 4]


def test_lists_and_shares(spark):
    assert values(spark, ['["a", " b "]', "x|y| ", "one", "nan", None], e.json_list) == [["a", "b"], ["x", "y"], ["one"], [], []]
    assert values(spark, ["62.5%加盟，其余直营", "约 41%授权", "25%直营", "自营"], e.franchise_share) == [0.625, 0.41, 0.75, None]
    assert values(spark, ["Yes", "0", "", "maybe"], e.parse_flag) == [True, False, False, None]
