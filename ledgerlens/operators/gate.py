"""Policy gate and credibility: reasons as arrays, status from their sizes, scores as column expressions."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Base of the reconciliation score by grade, and penalties by invariant status.
GRADE_BASE = {"A": 100, "B": 85, "C": 65, "D": 40, "F": 15, "MISSING": 20}
PENALTY = {"passed": 0, "warning": 15, "failed": 35, "unknown": 5}


@dataclass(frozen=True)
class MetricPolicy:
    metric: str
    needs_evidence: bool = True
    min_confidence: float = 0.75
    grades: tuple[str, ...] = ("A", "B")
    max_error: float = 0.05
    advisory_only: bool = False
    publishable_methods: tuple[str, ...] = ("reported",)
    hard_fail_checks: tuple[str, ...] = ()
    advisory_checks: tuple[str, ...] = ()


@dataclass(frozen=True)
class Policy:
    version: str
    metrics: tuple[MetricPolicy, ...] = field(default_factory=tuple)

    def frame(self, spark: SparkSession) -> DataFrame:
        """One row a metric: as many as the policy names, so it is safe to broadcast."""
        rows = [(m.metric, m.needs_evidence, float(m.min_confidence), list(m.grades), float(m.max_error), m.advisory_only, list(m.publishable_methods)) for m in self.metrics]
        return spark.createDataFrame(rows, "metric string, needs_evidence boolean, min_confidence double, grades array<string>, max_error double, advisory_only boolean, methods array<string>")


_REPORTED = ("reported", "reported_and_estimated", "mixed")
_MISSING = ("brand_alignment.missing_ai_brands",)
_UNIQUE = "core_brand_metrics.brand_unique"


def _evidenced(metric: str, *checks: str) -> MetricPolicy:
    return MetricPolicy(metric, True, 0.8, ("A", "B"), 0.05, False, _REPORTED, checks, _MISSING)


def _estimated(metric: str, *checks: str) -> MetricPolicy:
    return MetricPolicy(metric, False, 0.0, (), 0.05, True, (), checks, _MISSING)


#: The published policy, four metrics that need evidence and two that are advisory only.
POLICY_V1 = Policy("v1.0.0", (
    _evidenced("rank", "core_brand_metrics.rank_unique", _UNIQUE), _evidenced("store_count", _UNIQUE), _evidenced("system_sales", _UNIQUE), _evidenced("auv", "implied_auv_k"),
    _estimated("fte_mid", "fte_range_order", "fte_range_order.row"), _estimated("margin_mid_pct", "margin_range_order", "margin_range_order.row"),
))


def finding_flags(claims: DataFrame, findings: DataFrame, policy: Policy, subject: str) -> DataFrame:
    """Claims with hard_fail and finding: whether an error of a hard-fail check, or a finding of an advisory check, is about
    their subject, or about all (null subject), and their metric. The policy's checks and metrics are few rows."""
    rows = [(m.metric, c, hard) for m in policy.metrics for hard, checks in ((True, m.hard_fail_checks), (False, m.advisory_checks)) for c in checks]
    spec = claims.sparkSession.createDataFrame(rows, "metric string, _check string, _hard boolean")
    about = findings.join(F.broadcast(spec), F.col("check_name") == F.col("_check"))
    found = about.groupBy(F.col(subject).alias("_s"), F.col("metric").alias("_m")).agg(F.bool_or(F.col("_hard") & (F.col("severity") == "error")).alias("_h"), F.bool_or(~F.col("_hard")).alias("_f"))
    general = found.where("_s is null").select(F.col("_m").alias("_gm"), F.col("_h").alias("_gh"), F.col("_f").alias("_gf"))
    out = claims.join(found.where("_s is not null"), (F.col(subject) == F.col("_s")) & (F.col("metric") == F.col("_m")), "left").join(F.broadcast(general), F.col("metric") == F.col("_gm"), "left")
    flag = lambda a, b: F.coalesce(F.col(a), F.lit(False)) | F.coalesce(F.col(b), F.lit(False))
    return out.withColumns({"hard_fail": flag("_h", "_gh"), "finding": flag("_f", "_gf")}).drop("_s", "_m", "_h", "_f", "_gm", "_gh", "_gf")


def decide(claims: DataFrame, policy: Policy) -> DataFrame:
    """Blocking and warning reasons and status of each claim.

    claims: metric, value, reference_value, source_name, confidence, grade, relative_error, method, hard_fail,
    finding, provenance_missing (booleans). Confidence, grade, error and method only count with evidence. A row blocks
    on any blocking reason, is advisory on any warning, else publishable. Metrics outside the policy are left out.
    """
    rows = claims.join(F.broadcast(policy.frame(claims.sparkSession)), "metric")
    evidence = F.col("reference_value").isNotNull() & (F.coalesce(F.trim("source_name"), F.lit("")) != "")
    rows = rows.withColumn("evidence", evidence)
    e = F.col("evidence")

    def when(condition: Column, reason: str) -> Column:
        return F.when(F.coalesce(condition, F.lit(False)), F.lit(reason))

    blocking = F.array_compact(F.array(
        when(F.col("value").isNull(), "value missing"), when(F.col("needs_evidence") & ~e, "evidence missing"), when(F.col("provenance_missing"), "provenance incomplete"), when(F.col("hard_fail"), "hard-fail finding"),
        when(e & (F.col("confidence").isNull() | (F.col("confidence") < F.col("min_confidence"))), "confidence too low"), when(e & ~F.array_contains("grades", F.col("grade")), "grade not allowed"), when(e & (F.col("relative_error") > F.col("max_error")), "error too large"),
    ))
    warning = F.array_compact(F.array(when(e & ~F.array_contains("methods", F.col("method")), "method not publishable"), when(F.col("finding"), "advisory finding"), when(F.col("advisory_only"), "advisory metric")))
    out = rows.withColumns({"blocking": blocking, "warnings": warning})
    status = F.when(F.size("blocking") > 0, "blocked").when(F.size("warnings") > 0, "advisory").otherwise("publishable")
    return out.withColumn("status", status)


def summary(decisions: DataFrame, by: list[str]) -> DataFrame:
    """Counts by status for each of ``by`` alone and in all, in one pass over grouping sets."""
    sets = [[c] for c in by] + [[]]
    out = decisions.groupingSets(sets, *by).agg(F.count("*").alias("rows"), *[F.count_if(F.col("status") == s).alias(s) for s in ("publishable", "advisory", "blocked")])
    return out


def reasons(decisions: DataFrame, column: str) -> DataFrame:
    """Reasons by frequency."""
    return decisions.select(F.explode(column).alias("reason")).groupBy("reason").agg(F.count("*").alias("rows"))


def recommendation(decisions: DataFrame, by: str) -> DataFrame:
    """What to do with each subject by its counts of statuses."""
    out = decisions.groupBy(by).agg(*[F.count_if(F.col("status") == s).alias(s) for s in ("publishable", "advisory", "blocked")])
    mixed = ((F.col("blocked") > 0) & (F.col("publishable") > 0)) | ((F.col("advisory") > 0) & (F.col("publishable") > 0))
    return out.withColumn("recommendation", F.when(mixed, "publishable_subset_only").when(F.col("blocked") > 0, "blocked_for_external_use").when(F.col("advisory") > 0, "advisory_only").otherwise("publishable"))


def _clamped(c: Column) -> Column:
    return F.least(F.lit(100.0), F.greatest(F.lit(0.0), F.bround(c, 0)))


def provenance_score(confidence: Column, filled: Column, sources: Column, external: Column) -> Column:
    bonus = F.when(external, F.least(F.lit(3), sources) / 3 * 20).otherwise(0.0)
    return _clamped(F.coalesce(confidence, F.lit(0.0)) * 45 + filled / 6 * 35 + bonus)


def reconciliation_score(grade: Column, relative: Column, evidence: Column, reconcilable: Column) -> Column:
    base = F.coalesce(*[F.when(grade == g, F.lit(float(v))) for g, v in GRADE_BASE.items()], F.lit(20.0))
    cut = F.least(F.lit(25.0), F.bround(F.coalesce(relative, F.lit(0.0)) * 200, 0))
    return F.when(~reconcilable, 55.0).when(~evidence, 20.0).otherwise(_clamped(base - cut))


def invariant_status(severities: Column) -> Column:
    """From the severities of a subject's findings: null unknown, empty passed, any error failed, else warning."""
    return F.when(severities.isNull(), "unknown").when(F.array_contains(severities, "error"), "failed").when(F.size(severities) > 0, "warning").otherwise("passed")


def credibility(provenance: Column, reconciliation: Column, signal: Column, invariant: Column) -> Column:
    penalty = F.coalesce(*[F.when(invariant == k, F.lit(float(v))) for k, v in PENALTY.items()], F.lit(5.0))
    return _clamped(0.40 * provenance + 0.35 * reconciliation + 0.25 * (100 - signal) - penalty)


def needs_review(status: Column, invariant: Column, signal_review: Column, provenance: Column, reconciliation: Column, score: Column) -> Column:
    return (status != "publishable") | (invariant != "passed") | signal_review | (provenance < 70) | (reconciliation < 70) | (score < 65)
