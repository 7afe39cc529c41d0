"""Reconciliation of claims with reference evidence: best evidence per key and field, graded errors, coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens.functions import exprs

#: How near a kind of source is to the subject, the nearest first.
PRIMARY_PRIORITY = {"sec_filing": 0, "investor_relations": 1, "ranking": 2, "technomic": 3, "franchise_disclosure": 4}


def priority_of(source: Column, priorities: dict[str, int]) -> Column:
    """Unknown kinds come a hundred after the last."""
    known = F.coalesce(*[F.when(source == k, F.lit(v)) for k, v in priorities.items()])
    return F.coalesce(known, F.lit(max(priorities.values(), default=0) + 100))


def best_evidence(evidence: DataFrame, keys: list[str], priorities: dict[str, int]) -> DataFrame:
    """Of evidence(keys, value, source_type, source_name, confidence, as_of_date, ...) the best row of each key.

    Only rows with a value count: nearest kind of source, highest confidence (null: 0), latest date (none: last),
    first source name; the value decides last. One partial aggregate before the shuffle, no sort of whole groups.
    """
    order = F.struct(
        (-priority_of(F.col("source_type"), priorities)).alias("p"), F.coalesce("confidence", F.lit(0.0)).alias("c"), F.coalesce(F.col("as_of_date").cast("date"), F.lit("0001-01-01").cast("date")).alias("d"),
    )
    rest = [c for c in evidence.columns if c not in keys]
    # min_by on the last criteria needs the largest of the first ones: those are negated or turned round
    rank = F.struct((-order["p"]).alias("p"), (-order["c"]).alias("c"), F.datediff(F.lit("9999-12-31").cast("date"), order["d"]).alias("d"), F.col("source_name"), F.col("value"))
    best = evidence.where(F.col("value").isNotNull()).groupBy(*keys).agg(F.min_by(F.struct(*rest), rank).alias("b"))
    return best.select(*keys, "b.*")


def compare_numeric(df: DataFrame, claimed: Column, reference: Column) -> DataFrame:
    """Adds absolute_error, relative_error and grade; a reference of zero cannot be graded."""
    gap = F.abs(claimed - reference)
    relative = F.try_divide(gap, F.abs(reference))
    return df.withColumns({"absolute_error": gap, "relative_error": relative, "grade": exprs.relative_grade(relative)})


def compare_rank(df: DataFrame, claimed: Column, reference: Column) -> DataFrame:
    gap = F.abs(exprs.whole_number(claimed) - exprs.whole_number(reference))
    return df.withColumns({"rank_difference": gap, "grade": exprs.rank_grade(gap)})


def coverage(expected: DataFrame, evidence: DataFrame, row_key: str, column_key: str) -> DataFrame:
    """coverage_kind, coverage_key, covered, possible, coverage_rate, missing: by row key, by column key, and in all.

    expected: the different (row_key, column_key) pairs that should be covered; evidence: those that are.
    """
    have = evidence.select(row_key, column_key).distinct().withColumn("_have", F.lit(1))
    grid = expected.select(row_key, column_key).distinct().join(have, [row_key, column_key], "left")
    sums = [F.count("_have").alias("covered"), F.count("*").alias("possible")]
    lacking = F.when(F.col("_have").isNull(), F.col(column_key).cast("string"))
    rows = grid.groupBy(F.col(row_key).cast("string").alias("coverage_key")).agg(*sums, F.array_join(F.array_sort(F.collect_set(lacking)), "|").alias("missing")).withColumn("coverage_kind", F.lit("row"))
    columns = grid.groupBy(F.col(column_key).cast("string").alias("coverage_key")).agg(*sums).withColumns({"missing": F.lit(""), "coverage_kind": F.lit("column")})
    whole = grid.agg(*sums).withColumns({"missing": F.lit(""), "coverage_kind": F.lit("all"), "coverage_key": F.lit("all")})
    out = rows.unionByName(columns).unionByName(whole)
    return out.select("coverage_kind", "coverage_key", "covered", "possible", F.try_divide(F.col("covered"), F.col("possible")).alias("coverage_rate"), "missing")


def provenance_quality(df: DataFrame, by: list[str], fields: list[str], confidence: Column) -> DataFrame:
    """Completeness (filled fields of all) and mean, least and largest confidence of each group."""
    filled = sum((F.when(exprs.clean_text(F.col(f).cast("string"), nan_is_null=True).isNotNull(), 1).otherwise(0) for f in fields), F.lit(0))
    return df.groupBy(*by).agg(F.count("*").alias("rows"), (F.sum(filled) / (F.count("*") * len(fields))).alias("completeness"), F.avg(confidence).alias("mean_confidence"), F.min(confidence).alias("min_confidence"), F.max(confidence).alias("max_confidence"))


def source_tier(evidence: DataFrame, keys: list[str], priorities: dict[str, int], primary: list[str], usable: Column) -> DataFrame:
    """tier (primary, secondary, missing) of the best usable source of each key, and the primary source's status.

    used: the best is primary; available: there is a usable primary one; scope_mismatch: only an unusable one; none.
    """
    is_primary = F.col("source_type").isin(*primary)
    best = F.min_by(F.when(usable, F.col("source_type")), F.when(usable, F.struct(priority_of(F.col("source_type"), priorities), F.col("source_type"))))
    out = evidence.groupBy(*keys).agg(best.alias("best_source"), F.bool_or(is_primary & usable).alias("_ok"), F.bool_or(is_primary & ~usable).alias("_off"))
    tier = F.when(F.col("best_source").isNull(), "missing").when(F.col("best_source").isin(*primary), "primary").otherwise("secondary")
    status = F.when(F.col("best_source").isin(*primary), "used").when(F.col("_ok"), "available").when(F.col("_off"), "scope_mismatch").otherwise("none")
    return out.select(*keys, "best_source", tier.alias("tier"), status.alias("primary_status"))


def worst_by(df: DataFrame, by: str, error: str, tie: str) -> DataFrame:
    """The row with the largest error of each group."""
    place = Window.partitionBy(by).orderBy(F.desc(error), tie)
    return df.withColumn("_n", F.row_number().over(place)).where("_n = 1").drop("_n")


def contradictions(df: DataFrame, keys: list[str], limit: float = 0.05, top: int = 10) -> DataFrame:
    """The largest relative errors beyond the limit."""
    return df.where(F.abs("relative_error") > limit).orderBy(F.desc("relative_error"), *keys).limit(top)
