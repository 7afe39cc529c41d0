"""Statistical anomaly signals. Every operator is a few grouped passes; only vectors of at most 100 cells are joined back."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import exprs

#: Least sample sizes, and the shares that heaping and nice numbers are held against.
MIN_FIRST, MIN_TWO, MIN_HEAPING = 40, 100, 15
HEAPING_SHARE, NICE_SHARE = 0.2, 0.12
CONTRIBUTION = {"strong": 45, "moderate": 25, "weak": 10}


def long_form(df: DataFrame, fields: list[str]) -> DataFrame:
    """(field, value) of several numeric columns, so that one pass serves all of them."""
    return df.select(F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("double").alias("value")) for f in fields])).alias("x")).select("x.*")


def digit_histogram(df: DataFrame, fields: list[str], digits: int) -> DataFrame:
    """field, digit, observed, n, expected share: the whole domain, zero counts too."""
    lo, hi = 10 ** (digits - 1), 10**digits - 1
    counted = long_form(df, fields).select("field", exprs.leading_digits(F.col("value"), digits).alias("digit")).where("digit is not null").groupBy("field", "digit").agg(F.count("*").alias("observed"))
    domain = df.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, fields))).alias("field")).withColumn("digit", F.explode(F.sequence(F.lit(lo), F.lit(hi))))
    full = domain.join(counted, ["field", "digit"], "left").withColumn("observed", F.coalesce("observed", F.lit(0)).cast("long"))
    totals = counted.groupBy("field").agg(F.sum("observed").alias("n"))
    return full.join(totals, "field", "left").withColumn("n", F.coalesce("n", F.lit(0))).withColumn("expected", F.log10(1 + 1 / F.col("digit")))


def benford(df: DataFrame, fields: list[str], digits: int = 1) -> DataFrame:
    """field, n, mad, chi2, and p_value (first digit: the closed form for eight degrees of freedom) and strength."""
    cells = digit_histogram(df, fields, digits)
    want = F.col("expected") * F.col("n")
    out = cells.groupBy("field").agg(F.max("n").alias("n"), F.avg(F.abs(F.try_divide(F.col("observed"), F.col("n")) - F.col("expected"))).alias("mad"), F.sum(F.try_divide((F.col("observed") - want) * (F.col("observed") - want), want)).alias("chi2"))
    least = MIN_FIRST if digits == 1 else MIN_TWO
    out = out.where(F.col("n") >= least)
    half = F.col("chi2") / 2
    p = F.exp(-half) * (1 + half + half * half / 2 + half * half * half / 6) if digits == 1 else F.lit(None).cast("double")
    out = out.withColumn("p_value", p)
    strong = (F.col("p_value") < 0.01) & (F.col("mad") >= 0.02)
    weak = (F.col("p_value") < 0.05) | (F.col("mad") >= 0.015)
    return out.withColumn("strength", F.when(strong, "moderate").when(weak, "weak").otherwise("unknown"))


def _share_signal(df: DataFrame, fields: list[str], hit: Column, expected: float) -> DataFrame:
    rows = long_form(df, fields).where("value is not null")
    out = rows.groupBy("field").agg(F.count("*").alias("n"), F.avg(hit.cast("double")).alias("share"))
    return out.withColumn("z", exprs.share_z(F.col("share"), expected, F.col("n")))


def end_digit_heaping(df: DataFrame, fields: list[str]) -> DataFrame:
    """field, n, share of values that end in 0 or 5, z against one fifth, chi2 of all end digits, strength."""
    rows = long_form(df, fields).where("value is not null").withColumn("d", exprs.end_digit(F.col("value")))
    counts = [F.count_if(F.col("d") == i).alias(f"_{i}") for i in range(10)]
    out = rows.groupBy("field").agg(F.count("*").alias("n"), F.avg(F.col("d").isin(0, 5).cast("double")).alias("share"), *counts).where(F.col("n") >= MIN_HEAPING)
    tenth = F.col("n") / 10
    chi2 = sum(((F.col(f"_{i}") - tenth) * (F.col(f"_{i}") - tenth) / tenth for i in range(10)), F.lit(0.0))
    out = out.withColumn("z", exprs.share_z(F.col("share"), HEAPING_SHARE, F.col("n"))).withColumn("chi2", chi2)
    strength = F.when((F.col("share") >= 0.5) & (F.col("z") >= 3), "moderate").when((F.col("share") >= 0.35) & (F.col("z") >= 2), "weak").otherwise("unknown")
    return out.select("field", "n", "share", "z", "chi2", strength.alias("strength"))


def nice_numbers(df: DataFrame, fields: list[str]) -> DataFrame:
    """field, n, share of multiples of 10 or 25, z against 0.12, strength."""
    v = F.rint("value")
    out = _share_signal(df, fields, (v % 10 == 0) | (v % 25 == 0), NICE_SHARE)
    return out.withColumn("strength", F.when(F.col("z") >= 3, "moderate").when(F.col("z") >= 2, "weak").otherwise("unknown"))


def correlations(df: DataFrame, fields: list[str], top: int = 3) -> DataFrame:
    """left_field, right_field, r of the pairs with the largest absolute correlation; columns of one value left out."""
    pairs = [(a, b) for i, a in enumerate(fields) for b in fields[i + 1 :]]
    one = df.agg(*[F.corr(a, b).alias(f"r{k}") for k, (a, b) in enumerate(pairs)], F.count("*").alias("n"))
    each = F.array(*[F.struct(F.lit(a).alias("left_field"), F.lit(b).alias("right_field"), F.col(f"r{k}").alias("r")) for k, (a, b) in enumerate(pairs)])
    out = one.where("n >= 5").select(F.explode(each).alias("x")).select("x.*").where(F.col("r").isNotNull() & ~F.isnan("r"))
    out = out.withColumn("strength", F.when(F.abs("r") >= 0.97, "weak").otherwise("unknown"))
    return out.orderBy(F.desc(F.bround(F.abs("r"), 9)), "left_field", "right_field").limit(top)


def quantiles(df: DataFrame, value: Column, shares: list[float], accuracy: int = 10_000, small: int = 100_000) -> list[float | None]:
    """Exact quantiles (interpolated) in bounded memory; null without any value.

    Above ``small`` rows a first pass brackets each quantile by approximate ones, a second counts what lies below and
    inside, and only the values inside the brackets, a few of ``accuracy``, are ordered.
    """
    v = df.select(value.cast("double").alias("v")).where("v is not null")
    n = v.count()
    if not n:
        return [None] * len(shares)
    if n <= small:
        return list(v.agg(F.percentile("v", F.array(*map(F.lit, shares)))).first()[0])
    slack = 3 / accuracy
    while True:
        ends = [min(1.0, max(0.0, p + d)) for p in shares for d in (-slack, slack)]
        marks = v.agg(F.percentile_approx("v", ends, accuracy)).first()[0]
        pairs = [(p, lo if p > slack else float("-inf"), hi if p < 1 - slack else float("inf")) for p, lo, hi in zip(shares, marks[::2], marks[1::2])]
        inside = [(F.col("v") >= lo) & (F.col("v") <= hi) for _, lo, hi in pairs]
        counts = v.agg(*[F.count_if(F.col("v") < lo) for _, lo, _ in pairs], *[F.count_if(x) for x in inside]).first()
        below, held = counts[: len(pairs)], counts[len(pairs) :]
        ranks = [(p * (n - 1) - b, m - 1) for (p, _, _), b, m in zip(pairs, below, held)]
        if all(0 <= r <= m for r, m in ranks) or slack > 0.5:
            parts = [F.percentile(F.when(x, F.col("v")), min(1.0, max(0.0, r / m if m > 0 else 0.0))) for x, (r, m) in zip(inside, ranks)]
            return list(v.agg(*parts).first())
        slack *= 4  # the approximation missed


def robust_outliers(df: DataFrame, key: str, field: str) -> DataFrame:
    """key, field, robust_z, outside (of the quartile fences), strength: both moderate, one weak; others left out.

    The robust z is 0.6745 (x - median) / MAD, zero for all where MAD is zero.
    """
    v = F.col(field).cast("double")
    first, mid, third = quantiles(df, v, [0.25, 0.5, 0.75])
    mad = quantiles(df, F.abs(v - F.lit(mid)), [0.5])[0] if mid is not None else None
    rows = df.select(key, v.alias(field)).where(F.col(field).isNotNull())
    z = (0.6745 * (F.col(field) - F.lit(mid)) / F.lit(mad)) if mad else F.lit(0.0)
    spread = 1.5 * (third - first) if mid is not None else 0.0
    outside = (F.col(field) < (first or 0.0) - spread) | (F.col(field) > (third or 0.0) + spread)
    out = rows.select(key, field, z.alias("robust_z"), outside.alias("outside"))
    far = F.abs("robust_z") >= 3
    return out.where(F.col("outside") | far).withColumn("strength", F.when(F.col("outside") & far, "moderate").otherwise("weak"))


class Forest:
    """Isolation trees on samples of at most 256 rows, as arrays; the score is 2 ** (-mean depth / c(sample))."""

    def __init__(self, x: np.ndarray, trees: int = 200, seed: int = 42):
        rng = np.random.default_rng(seed)
        self.size = min(256, len(x))
        limit = max(1, int(np.ceil(np.log2(max(self.size, 2)))))
        self.trees = [self._grow(x[rng.choice(len(x), self.size, replace=False)], 0, limit, rng) for _ in range(trees)]

    @staticmethod
    def average_depth(n: float) -> float:
        return 0.0 if n <= 1 else 1.0 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n

    def _grow(self, x: np.ndarray, depth: int, limit: int, rng) -> tuple:
        spread = np.flatnonzero(x.max(axis=0) > x.min(axis=0)) if len(x) > 1 else []
        if depth >= limit or not len(spread):
            return (depth + self.average_depth(len(x)),)
        f = int(rng.choice(spread))
        at = rng.uniform(x[:, f].min(), x[:, f].max())
        left = x[:, f] < at
        return f, at, self._grow(x[left], depth + 1, limit, rng), self._grow(x[~left], depth + 1, limit, rng)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))

        def walk(node: tuple, rows: np.ndarray) -> None:
            if len(node) == 1:
                total[rows] += node[0]
            elif len(rows):
                f, at, left, right = node
                small = x[rows, f] < at
                walk(left, rows[small])
                walk(right, rows[~small])

        for tree in self.trees:
            walk(tree, np.arange(len(x)))
        return 2.0 ** (-total / len(self.trees) / max(self.average_depth(self.size), 1e-9))


def isolation_forest(df: DataFrame, key: str, fields: list[str], sample: int = 50_000) -> DataFrame:
    """key, score, flagged and strength of each complete row; at least twelve are needed.

    Trees see a bounded sample (smallest hashed keys) on the driver; rows are scored where they are. The share of rows
    flagged is 2 / n, at least 0.05 and at most 0.15; flagged rows from the ninetieth percentile on are moderate.
    """
    rows = df.select(F.col(key).alias(key), *[F.col(f).cast("double").alias(f) for f in fields]).na.drop()
    train = rows.orderBy(F.xxhash64(key), key).limit(sample).select(*fields).collect()
    schema = f"{key} {dict(df.dtypes)[key]}, score double"
    if len(train) < 12:
        return df.sparkSession.createDataFrame([], schema + ", flagged boolean, strength string")
    forest = df.sparkSession.sparkContext.broadcast(Forest(np.array(train, float)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.stack([b.column(f).to_numpy() for f in fields], axis=1) if b.num_rows else np.zeros((0, len(fields)))
            yield pa.record_batch({key: b.column(key), "score": pa.array(forest.value.score(x), pa.float64())})

    scored = rows.mapInArrow(run, schema)
    n = rows.count()
    share = min(0.15, max(0.05, 2 / n))
    low, high = quantiles(scored, F.col("score"), [1 - share, 0.9])
    out = scored.withColumn("flagged", F.col("score") > low)
    return out.select(key, "score", "flagged", F.when(F.col("flagged") & (F.col("score") >= high), "moderate").when(F.col("flagged"), "weak").alias("strength"))


def interpret(signals: DataFrame, by: list[str], halve_unnamed: bool = True) -> DataFrame:
    """Score and review of the signals of each group: contributions by strength, five more for each further key.

    With ``halve_unnamed`` a signal without field counts half, at least five, and its type is its key (the first
    scorer); without, all count whole and only named fields are keys (the second).
    """
    full = F.coalesce(*[F.when(F.col("strength") == k, F.lit(v)) for k, v in CONTRIBUTION.items()], F.lit(0))
    part = F.when(F.col("field_name").isNull(), F.greatest(F.lit(5), F.floor(full / 2))).otherwise(full) if halve_unnamed else full
    name = F.coalesce("field_name", "signal_type") if halve_unnamed else exprs.clean_text(F.col("field_name"))
    out = signals.groupBy(*by).agg(F.sum(part).cast("long").alias("base"), F.countDistinct(name).alias("fields"), F.max(part).cast("long").alias("largest"), F.count("*").alias("signals"))
    score = F.least(F.lit(100), F.col("base") + 5 * F.greatest(F.col("fields") - 1, F.lit(0)))
    return out.withColumn("score", score.cast("long")).withColumn("review", (F.col("score") >= 35) | (F.col("largest") >= 25))
