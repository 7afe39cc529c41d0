"""Rules over attributes: archetypes by predicate, ranked recommendation stacks, readiness, consistency of decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: How ready a subject must be, least first.
READINESS = ["hold", "caution", "ready"]


def archetypes(df: DataFrame, predicates: list[tuple[str, Column, Column]], default: tuple[str, float]) -> DataFrame:
    """Adds archetypes: array of (code, confidence) of the predicates that hold, in order; the default if none does."""
    hits = F.array_compact(F.array(*[F.when(F.coalesce(p, F.lit(False)), F.struct(F.lit(c).alias("code"), conf.cast("double").alias("confidence"))) for c, p, conf in predicates]))
    fallback = F.array(F.struct(F.lit(default[0]).alias("code"), F.lit(float(default[1])).alias("confidence")))
    return df.withColumn("_hits", hits).withColumn("archetypes", F.when(F.size("_hits") > 0, F.col("_hits")).otherwise(fallback)).drop("_hits")


def readiness(errors: Column, sources: Column, grade: Column) -> Column:
    """hold on any error; caution without source or with a grade of MISSING, D or F; else ready."""
    return F.when(errors > 0, "hold").when((F.coalesce(sources, F.lit(0)) == 0) | grade.isin("MISSING", "D", "F"), "caution").otherwise("ready")


def stack(subjects: DataFrame, key: str, rules: list[tuple[str, str, int, str]], foundation: str = "foundation") -> DataFrame:
    """key, rule, priority: a subject on hold gets the foundation rule first, then the rules of its archetypes in their
    order and the rules' own, each once, where the subject is ready enough.

    rules: (archetype, rule, order, least readiness), as many as the configuration names.
    """
    level = F.array_position(F.array(*map(F.lit, READINESS)), F.col("readiness"))
    frame = subjects.sparkSession.createDataFrame([(a, r, o, READINESS.index(m) + 1) for a, r, o, m in rules], "code string, rule string, place int, least int")
    each = subjects.select(key, level.alias("level"), F.posexplode("archetypes").alias("nth", "a")).select(key, "level", "nth", F.col("a.code").alias("code"))
    chosen = each.join(F.broadcast(frame), "code").where(F.col("level") >= F.col("least")).groupBy(key, "rule").agg(F.min(F.struct("nth", "place")).alias("at"))
    base = subjects.where("readiness = 'hold'").select(key, F.lit(foundation).alias("rule"), F.struct(F.lit(-1).alias("nth"), F.lit(0).alias("place")).alias("at"))
    rank = F.row_number().over(Window.partitionBy(key).orderBy("at", "rule"))
    return chosen.unionByName(base).select(key, "rule", rank.alias("priority"))


def differences(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Multiset difference of two sets of rows by key: the keys whose numbers of rows differ."""
    a = left.groupBy(*keys).agg(F.count("*").alias("left_rows"))
    b = right.groupBy(*keys).agg(F.count("*").alias("right_rows"))
    out = a.join(b, keys, "full").select(*keys, F.coalesce("left_rows", F.lit(0)).alias("left_rows"), F.coalesce("right_rows", F.lit(0)).alias("right_rows"))
    return out.where("left_rows <> right_rows")


def top_counts(df: DataFrame, key: str, n: int) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), key).limit(n)


# ---------------------------------------------------------------- operating models
#: Tokens of categories and supply chains that stand for an operating model.
BEVERAGE = ("咖啡", "饮品", "甜甜圈")
BEVERAGE_SUPPLY = ("咖啡机", "糖浆", "门店仅制作饮品", "饮品门店现场制作")
THROUGHPUT_SUPPLY = ("无烹饪设备", "极简", "减少等待", "hot-n-ready|hotnready", "现场组装", "加热\\+组装")
DELIVERY = ("披萨", "鸡翅")
DELIVERY_SUPPLY = ("外卖", "配送", "pickup", "delivery")
HEAVY_COOKING = ("现场压力油炸", "压力油炸", "现炸", "大锅翻炒")
ASSEMBLY_SUPPLY = ("组装", "预制")
ASSEMBLY = ("面包", "三明治", "fast-casual")
DRIVE_THRU = ("drive-thru", "drive thru", "drive-in", "drive in", "得来速")


def _any(text: Column, words: tuple[str, ...]) -> Column:
    return F.coalesce(F.lower(text).rlike("|".join(words)), F.lit(False))


def drive_thru(category: Column, supply: Column) -> Column:
    return _any(category, DRIVE_THRU) | _any(supply, DRIVE_THRU)


def operating_models(df: DataFrame, category: str, supply: str, auv: str, fte: str, stores: str, margin: str, franchised: str) -> DataFrame:
    """Adds models: array of (code, confidence) of the six operating models whose conditions hold, in a fixed order.

    Nulls fulfil no condition. Without any model the default is franchise_standardized from a franchised share of 0.7 on,
    else premium_service, both with low confidence.
    """
    c, s = F.col(category), F.col(supply)
    num = lambda x: F.col(x).cast("double")
    holds = lambda x: F.coalesce(x, F.lit(False))
    count = lambda xs: sum((holds(x).cast("int") for x in xs), F.lit(0))
    throughput = count([*[_any(s, (w,)) for w in THROUGHPUT_SUPPLY], (num(fte) <= 12) & (num(stores) >= 2000)])
    assembly = count([*[_any(s, (w,)) for w in ASSEMBLY_SUPPLY], *[_any(c, (w,)) for w in ASSEMBLY], num(fte) <= 15])
    share = num(franchised)
    high = lambda x: F.when(x, "high").otherwise("medium")
    rules = [
        ("premium_service", (num(auv) >= 3000) & (num(fte) >= 20) & (num(margin) >= 20) & ~_any(s, ("无烹饪设备",)), F.lit("high")), ("beverage_ops", _any(c, BEVERAGE) | _any(s, BEVERAGE_SUPPLY), F.lit("high")),
        ("throughput_model", throughput > 0, high(throughput >= 2)), ("franchise_standardized", share >= 0.85, high(share >= 0.95)),
        ("digital_delivery", _any(c, DELIVERY) | _any(s, DELIVERY_SUPPLY), F.lit("medium")), ("assembly_automation", (assembly > 0) & ~_any(s, HEAVY_COOKING), high(assembly >= 2)),
    ]
    hits = F.array_compact(F.array(*[F.when(holds(p), F.struct(F.lit(n).alias("code"), conf.alias("confidence"))) for n, p, conf in rules]))
    default = F.array(F.struct(F.when(holds(share >= 0.7), "franchise_standardized").otherwise("premium_service").alias("code"), F.lit("low").alias("confidence")))
    return df.withColumn("_hits", hits).withColumn("models", F.when(F.size("_hits") > 0, F.col("_hits")).otherwise(default)).drop("_hits")


def open_issues(findings: Column, weak_fields: Column, signals: Column, limit: int = 6) -> Column:
    """The first different texts of findings, weak fields and signals, in this order; nulls are empty."""
    none = F.array().cast("array<string>")
    weak = F.transform(F.coalesce(weak_fields, none), lambda f: F.concat(F.lit("weak evidence: "), f))
    return F.slice(F.array_distinct(F.concat(F.coalesce(findings, none), weak, F.coalesce(signals, none))), 1, limit)
