"""Scorecards and rollups: what a report shows of each subject and in all, as aggregates; only their few rows are rendered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens.functions import exprs

WEAK = ("MISSING", "D", "F")
#: The per-subject checks of a scorecard, and those whose result holds for all subjects.
CHECKS = (
    ("rank uniqueness", "core_brand_metrics.rank_unique", "core_brand_metrics.rank_unique"), ("brand uniqueness", "core_brand_metrics.brand_unique", "core_brand_metrics.brand_unique"),
    ("implied AUV consistency", "implied_auv_k", None), ("FTE range ordering", "fte_range_order.row", "fte_range_order"), ("margin range ordering", "margin_range_order.row", "margin_range_order"),
)


def magnitude_span(df: DataFrame, by: list[str], field: str) -> DataFrame:
    """Largest over least positive value of each group; null without any."""
    positive = F.when(F.col(field) > 0, F.col(field))
    return df.groupBy(*by).agg(F.try_divide(F.max(positive), F.min(positive)).alias("span"))


def source_counts(evidence: DataFrame, by: list[str], source: str) -> DataFrame:
    """Number of different sources of each group, blank and unknown ones left out."""
    name = exprs.clean_text(F.col(source).cast("string"))
    return evidence.groupBy(*by).agg(F.countDistinct(F.when(F.lower(name) != "unknown", name)).alias("sources"))


def warning_counts(findings: DataFrame) -> DataFrame:
    """Findings that warn or fail, by category."""
    return findings.where(F.col("severity").isin("warning", "error")).groupBy("category").agg(F.count("*").alias("findings"), F.count_if(F.col("severity") == "error").alias("errors"))


def weakest_fields(graded: DataFrame, field: str, subject: str) -> DataFrame:
    """field, weak, covered, mean_confidence, place: fields by their number of weak or missing grades, then least confidence.

    graded: one row a subject and field with grade and confidence.
    """
    grade = F.coalesce("grade", F.lit("MISSING"))
    out = graded.groupBy(field).agg(F.count_if(grade.isin(*WEAK)).alias("weak"), F.count_if(grade != "MISSING").alias("covered"), F.bround(F.avg("confidence"), 9).alias("mean_confidence"))
    place = Window.orderBy(F.desc("weak"), F.coalesce("mean_confidence", F.lit(-1.0)), field)  # as many rows as there are fields
    return out.withColumn("place", F.row_number().over(place))


def largest_errors(graded: DataFrame, keys: list[str], top: int = 10, by: str | None = None) -> DataFrame:
    """The largest relative errors: ``top`` in all, or of each group ``by``."""
    rows = graded.where(F.col("relative_error").isNotNull())
    if by is None:
        return rows.orderBy(F.desc("relative_error"), *keys).limit(top)
    place = F.row_number().over(Window.partitionBy(by).orderBy(F.desc("relative_error"), *keys))
    return rows.withColumn("_n", place).where(F.col("_n") <= top).drop("_n")


def signal_overview(signals: DataFrame, top: int = 5) -> DataFrame:
    """kind (all, strength, type), value, signals: all, by strength, and the most frequent types."""
    sets = signals.groupingSets([["strength"], ["signal_type"], []], "strength", "signal_type").agg(F.grouping_id().alias("g"), F.count("*").alias("signals"))
    kind = F.when(F.col("g") == 3, "all").when(F.col("g") == 1, "strength").otherwise("type")
    out = sets.select(kind.alias("kind"), F.coalesce(F.when(F.col("g") == 1, F.col("strength")).when(F.col("g") == 2, F.col("signal_type")), F.lit("all")).alias("value"), "signals")
    place = F.row_number().over(Window.partitionBy("kind").orderBy(F.desc("signals"), "value"))
    return out.withColumn("_n", place).where((F.col("kind") != "type") | (F.col("_n") <= top)).drop("_n")


def subject_counts(findings: DataFrame, subject: str, severity: str = "severity", issue: str = "check_name") -> DataFrame:
    """subject, errors, warnings, issues (sorted, each once)."""
    return findings.where(F.col(subject).isNotNull()).groupBy(subject).agg(F.count_if(F.col(severity) == "error").alias("errors"), F.count_if(F.col(severity) == "warning").alias("warnings"), F.array_sort(F.collect_set(issue)).alias("issues"))


def validation_status(errors: Column, warnings: Column) -> Column:
    return F.when(errors > 0, "failed").when(warnings > 0, "warning").otherwise("passed")


def global_checks(findings: DataFrame, checks: list[str]) -> DataFrame:
    """check_name, status: failed where its last finding (by ordinal) is an error, else passed; unknown without any."""
    last = findings.where(F.col("check_name").isin(checks)).groupBy("check_name").agg(F.max_by("severity", "ordinal").alias("s"))
    names = findings.sparkSession.createDataFrame([(c,) for c in checks], "check_name string")
    return names.join(last, "check_name", "left").select("check_name", F.when(F.col("s").isNull(), "unknown").when(F.col("s") == "error", "failed").otherwise("passed").alias("status"))


def invariant_results(subjects: DataFrame, findings: DataFrame, subject: str, checks: tuple = CHECKS) -> DataFrame:
    """subject, label, status of every check of every subject: failed or warning by its own findings, else the check's result
    for all; a check without such a result passes."""
    overall = global_checks(findings, sorted({g for _, _, g in checks if g}))
    spec = findings.sparkSession.createDataFrame([(label, own, g) for label, own, g in checks], "label string, own string, overall string")
    spec = spec.join(overall.withColumnRenamed("status", "all_status"), F.col("overall") == F.col("check_name"), "left").drop("check_name")
    own = findings.where(F.col(subject).isNotNull()).groupBy(F.col(subject).alias("_s"), F.col("check_name").alias("_c")).agg(F.count_if(F.col("severity") == "error").alias("e"), F.count("*").alias("n"))
    grid = subjects.select(subject).distinct().join(F.broadcast(spec))  # as many rows as there are checks
    rows = grid.join(own, (F.col(subject) == F.col("_s")) & (F.col("own") == F.col("_c")), "left")
    status = F.when(F.col("e") > 0, "failed").when(F.col("n") > 0, "warning").otherwise(F.coalesce("all_status", F.lit("passed")))
    return rows.select(subject, "label", status.alias("status"))


def subject_scorecards(subjects: DataFrame, findings: DataFrame, graded: DataFrame, subject: str, field: str) -> DataFrame:
    """One row a subject: validation status, overall grade, weak fields, its three largest errors and its open issues."""
    counts = subject_counts(findings, subject)
    position = F.array_position(F.array(*map(F.lit, exprs.GRADE_ORDER)), F.col("grade"))
    weak = F.array_sort(F.collect_set(F.when(F.coalesce("grade", F.lit("MISSING")).isin(*WEAK), F.col(field))))
    worst = F.max(F.when(position > 0, position))
    errors = F.transform(F.slice(F.array_sort(F.collect_list(F.when(F.col("relative_error").isNotNull(), F.struct((-F.col("relative_error")).alias("e"), F.col(field).alias("f"))))), 1, 3), lambda x: x["f"])
    fields = graded.groupBy(subject).agg(worst.alias("_w"), weak.alias("weak_fields"), errors.alias("largest_errors"))
    rows = subjects.select(subject).distinct().join(counts, subject, "left").join(fields, subject, "left")
    none = F.array().cast("array<string>")
    issues = F.concat(F.coalesce("issues", none), F.transform(F.coalesce("weak_fields", none), lambda f: F.concat(F.lit("weak evidence: "), f)))
    grade = F.coalesce(F.element_at(F.array(*map(F.lit, exprs.GRADE_ORDER)), F.col("_w").cast("int")), F.lit("MISSING"))
    status = validation_status(F.coalesce("errors", F.lit(0)), F.coalesce("warnings", F.lit(0)))
    return rows.select(subject, status.alias("validation_status"), grade.alias("overall_grade"), F.coalesce("weak_fields", none).alias("weak_fields"), F.coalesce("largest_errors", none).alias("largest_errors"), issues.alias("open_issues"))


def global_scorecard(scorecards: DataFrame) -> DataFrame:
    """One row: subjects in all, failed, with warnings and clean."""
    return scorecards.agg(F.count("*").alias("subjects"), *[F.count_if(F.col("validation_status") == s).alias(n) for s, n in (("failed", "failed"), ("warning", "warned"), ("passed", "clean"))])


def credibility_rollup(scored: DataFrame, subject: str) -> DataFrame:
    """One row a subject: rows, mean score, least score with its metric, rows to review, and counts by status."""
    return scored.groupBy(subject).agg(
        F.count("*").alias("rows"), F.bround(F.avg("score"), 6).alias("mean_score"), F.min("score").alias("least_score"), F.min_by("metric", F.struct("score", "metric")).alias("least_metric"),
        F.count_if("review").alias("to_review"), *[F.count_if(F.col("status") == s).alias(s) for s in ("publishable", "advisory", "blocked")],
    )


def credibility_summary(scored: DataFrame, keys: list[str], top: int = 10) -> tuple[DataFrame, DataFrame]:
    """The averages by status and in all, and the rows to review with the least scores."""
    sums = scored.groupingSets([["status"], []], "status").agg(F.count("*").alias("rows"), F.bround(F.avg("score"), 6).alias("mean_score"), F.count_if("review").alias("to_review"))
    return sums, scored.where("review").orderBy("score", *keys).limit(top)


def seed_metadata(corpus: DataFrame, subject: str, metric: str, sets: list[str]) -> DataFrame:
    """subject, metric (null: all metrics of the subject) and the sorted set of each of the columns ``sets``."""
    agg = [F.array_sort(F.collect_set(c)).alias(c) for c in sets]
    return corpus.where(F.col(subject).isNotNull()).groupingSets([[subject], [subject, metric]], subject, metric).agg(F.grouping_id().alias("_g"), *agg).where(f"_g = 1 or {metric} is not null").drop("_g")


def reusable_plays(plays: DataFrame, play: str, order: list[str], limit: int = 6) -> DataFrame:
    """The first row of each play by ``order``, and of these the first ``limit``."""
    rest = [c for c in plays.columns if c != play]
    first = plays.groupBy(play).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_p")).select(play, "_p.*")
    return first.orderBy(*order, play).limit(limit)


def in_order(parts: list[tuple[str, DataFrame]]) -> DataFrame:
    """Findings of several checks in a fixed order: check_name and ordinal, the check's place."""
    out = None
    for i, (name, df) in enumerate(parts):
        part = df.withColumns({"check_name": F.lit(name), "ordinal": F.lit(i)})
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def unresolved_warnings(evidence: DataFrame, subject: str, known: DataFrame, source: str) -> DataFrame:
    """A warning for each name of the evidence that no known subject has, with its number of rows."""
    lost = evidence.join(known.select(subject).distinct(), subject, "left_anti").groupBy(source, subject).agg(F.count("*").alias("rows"))
    return lost.select(source, subject, "rows", F.format_string("%s: %d rows name no known subject: %s", F.col(source).cast("string"), F.col("rows"), F.coalesce(F.col(subject).cast("string"), F.lit("(blank)"))).alias("warning"))


def provenance_records(evidence: DataFrame, claims: DataFrame, subject: str) -> DataFrame:
    """One registry: a record for each row of evidence and of the claims' own table, with the subject as JSON in extra."""
    columns = ["source_type", "source_name", "as_of_date", "method", "confidence"]
    extra = F.to_json(F.struct(F.col(subject).alias("canonical_brand_name")))
    pick = lambda df: df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns], extra.alias("extra"))
    return pick(evidence).unionByName(pick(claims))


def summary_of_grades(graded: DataFrame, field: str) -> DataFrame:
    """field, grade, rows: the distribution of grades, missing ones included."""
    return graded.groupBy(field, F.coalesce("grade", F.lit("MISSING")).alias("grade")).agg(F.count("*").alias("rows"))


def single_source_slice(graded: DataFrame, source: str, subject: str, field: str) -> tuple[DataFrame, DataFrame]:
    """The graded rows whose evidence is of one source, and the (subject, field) pairs that it does not cover."""
    own = graded.where(F.col("source_type") == source)
    return own, graded.select(subject, field).distinct().join(own.select(subject, field).distinct(), [subject, field], "left_anti")


def render(title: str, sections: list[tuple[str, DataFrame]], limit: int = 50) -> str:
    """A Markdown report: of each section the first ``limit`` rows as a table. Reads no more than it shows."""
    lines = [f"# {title}", ""]
    for name, df in sections:
        lines += [f"## {name}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
        lines += ["| " + " | ".join("" if v is None else ", ".join(map(str, v)) if isinstance(v, list) else str(v) for v in r) + " |" for r in df.limit(limit).collect()]
        lines.append("")
    return "\n".join(lines)
