"""Data-quality checks. Each returns finding rows or the checked rows with their verdict, in one lazy plan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


@dataclass(frozen=True)
class Rule:
    """A named condition that every row should meet; null where it cannot be told counts as broken."""

    field: str
    name: str
    holds: Column
    kind: str = "allowed_range"  # or null, schema_type


def not_null(field: str) -> Rule:
    return Rule(field, "not_null", F.col(field).isNotNull(), "null")


def in_range(field: str, low: float | None = None, high: float | None = None, strict: bool = False) -> Rule:
    c, ok = F.col(field), F.lit(True)
    if low is not None:
        ok = ok & (c > low if strict else c >= low)
    if high is not None:
        ok = ok & (c <= high)
    return Rule(field, f"in_range({low},{high})" if not strict else f"greater_than({low})", ok)


def text_length(field: str, least: int = 1) -> Rule:
    return Rule(field, f"str_length({least})", F.length(F.trim(field)) >= least)


def equals(field: str, value: object) -> Rule:
    return Rule(field, "equals", F.col(field) == F.lit(value))


def schema_differences(df: DataFrame, expected: list[tuple[str, str]]) -> list[str]:
    """Strict and ordered: missing, unexpected and misplaced columns, and other types than expected."""
    names, out = df.columns, []
    out += [f"missing column {n}" for n, _ in expected if n not in names]
    out += [f"unexpected column {n}" for n in names if n not in dict(expected)]
    if not out and names != [n for n, _ in expected]:
        out.append("columns out of order")
    types = dict(df.dtypes)
    out += [f"column {n} is {types[n]}, not {t}" for n, t in expected if n in types and types[n] != t]
    return out


def rule_violations(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """field_name, check_name, kind, violations, rows: one pass over df, a row for each rule, kept ones too."""
    sums = [F.count_if(~F.coalesce(r.holds, F.lit(False))).alias(f"r{i}") for i, r in enumerate(rules)]
    one = df.agg(F.count("*").alias("n"), *sums)
    each = F.array(*[F.struct(F.lit(r.field).alias("field_name"), F.lit(r.name).alias("check_name"), F.lit(r.kind).alias("kind"), F.col(f"r{i}").alias("violations"), F.col("n").alias("rows")) for i, r in enumerate(rules)])
    return one.select(F.explode(each).alias("x")).select("x.*")


def violating_rows(df: DataFrame, rules: list[Rule], order: list[str], first: int = 5) -> DataFrame:
    """The first rows by order that break each rule."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(r.holds, F.lit(False)), F.struct(F.lit(r.field).alias("field_name"), F.lit(r.name).alias("check_name"), F.lit(r.kind).alias("kind"))) for r in rules]))
    rows = df.select(*order, F.explode(broken).alias("x")).select(*order, "x.*")
    place = Window.partitionBy("field_name", "check_name").orderBy(*order)
    return rows.withColumn("nth", F.row_number().over(place)).where(F.col("nth") <= first)


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once (nulls equal each other), with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where("rows > 1")


def alignment(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """side (both, left_only, right_only) and keys: how two tables agree on their different keys."""
    a = left.select(key).where(F.col(key).isNotNull()).distinct().withColumn("l", F.lit(1))
    b = right.select(key).where(F.col(key).isNotNull()).distinct().withColumn("r", F.lit(1))
    side = F.when(F.col("l").isNull(), "right_only").when(F.col("r").isNull(), "left_only").otherwise("both")
    return a.join(b, key, "full").groupBy(side.alias("side")).agg(F.count("*").alias("keys"))


def implied_value(df: DataFrame, amount: Column, count: Column, actual: Column, scale: float = 1.0, tolerance: float = 0.05) -> DataFrame:
    """Adds expected, delta and status: pass where actual is within tolerance of amount * scale / count.

    Missing values or a count of zero or less: missing. Expected zero: only zero passes. The divisor keeps its sign,
    so a negative expected value always passes.
    """
    whole = amount.isNotNull() & actual.isNotNull() & (count > 0)
    expected = F.when(whole, amount * scale / count)
    out = df.withColumn("expected", expected)
    gap = F.abs(actual - F.col("expected"))
    out = out.withColumn("delta", F.when(F.col("expected") == 0, F.when(actual == 0, 0.0)).otherwise(gap / F.col("expected")))
    return out.withColumn("status", F.when(F.col("expected").isNull(), "missing").when(F.col("delta") <= tolerance, "pass").otherwise("fail"))


def severity_counts(df: DataFrame, status: str = "status") -> DataFrame:
    """Findings by severity: errors for failing and missing rows, one info for all that pass."""
    kinds = df.agg(F.count_if(F.col(status) == "fail").alias("fail"), F.count_if(F.col(status) == "missing").alias("missing"), F.count_if(F.col(status) == "pass").alias("pass"))
    named = (("error", "implied_value_mismatch", "fail"), ("error", "implied_value_missing", "missing"), ("info", "implied_value_passed", "pass"))
    rows = F.array(*[F.struct(F.lit(s).alias("severity"), F.lit(c).alias("check_name"), F.col(k).alias("rows")) for s, c, k in named])
    return kinds.select(F.explode(rows).alias("x")).select("x.*").where("rows > 0")


def run_passed(findings: DataFrame) -> DataFrame:
    """One row: passed (no error), and the number of findings by severity."""
    return findings.agg((F.count_if(F.col("severity") == "error") == 0).alias("passed"), *[F.count_if(F.col("severity") == s).alias(s) for s in ("error", "warning", "info")])


def monotonic(df: DataFrame, low: Column, mid: Column, high: Column) -> DataFrame:
    """Adds ordered: low <= mid <= high; a null counts as broken."""
    return df.withColumn("ordered", F.coalesce((low <= mid) & (mid <= high), F.lit(False)))


def section_split(df: DataFrame, group: list[str], order: str, marker: Column, blank: Column) -> DataFrame:
    """Adds section: rows after the first marker and before the next blank row are findings, other non-blank notes."""
    w = Window.partitionBy(*group)
    first = F.min(F.when(marker, F.col(order))).over(w)
    out = df.withColumn("_first", first).withColumn("_end", F.min(F.when(blank & (F.col(order) > F.col("_first")), F.col(order))).over(w))
    inside = (F.col(order) > F.col("_first")) & (F.col("_end").isNull() | (F.col(order) < F.col("_end")))
    section = F.when(blank | marker, F.lit(None)).when(F.coalesce(inside, F.lit(False)), "finding").otherwise("note")
    return out.withColumn("section", section).drop("_first", "_end").where(F.col("section").isNotNull())
