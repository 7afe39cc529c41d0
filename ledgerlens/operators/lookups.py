"""Lookups that the gate and the snapshots need: findings, provenance, signals and coverage of each subject.

Every lookup is one aggregate by key followed by a left join on a key that is unique on the looked-up side, so claims
never multiply and a hot subject costs one partial row a task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import exprs

#: The metric that a field belongs to, and those that a check is about.
FIELD_METRICS = {
    "rank": "rank", "us_store_count_2024": "store_count", "systemwide_revenue_usd_billions_2024": "system_sales", "average_unit_volume_usd_thousands": "auv",
    "implied_auv_k": "auv", "fte_mid": "fte_mid", "margin_mid_pct": "margin_mid_pct",
}
CHECK_METRICS = {
    "core_brand_metrics.rank_unique": ["rank"], "core_brand_metrics.brand_unique": ["rank", "store_count", "system_sales", "auv"], "implied_auv_k": ["auv"],
    "fte_range_order": ["fte_mid"], "fte_range_order.row": ["fte_mid"], "margin_range_order": ["margin_mid_pct"], "margin_range_order.row": ["margin_mid_pct"],
}
#: Words in a signal's title that follow the subject's name.
TITLE_MARKS = (" stands out", " is unusual", " deserves", " AUV")
LABELS = ("relevant", "partially_relevant", "not_relevant")


def left_lookups(claims: DataFrame, others: list[tuple[DataFrame, list[str]]]) -> DataFrame:
    """Claims with the columns of each other table by its keys, one after the other; a table must be unique on them."""
    return reduce(lambda df, o: df.join(o[0], o[1], "left"), others, claims)


def latest_per(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by the given columns: one partial aggregate, no sort."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_last")).select(*keys, "_last.*")


def with_coverage(snapshot: DataFrame, coverage: DataFrame, key: str, order: list[str], statuses: list[str] | None = None) -> DataFrame:
    """Snapshot rows of the wanted statuses with the last coverage row of their subject."""
    rows = snapshot if statuses is None else snapshot.where(F.col("status").isin(statuses))
    return rows.join(latest_per(coverage, [key], order), key, "left")


def resolved(names: Column, aliases: DataFrame, df: DataFrame, alias: str, canonical: str, out: str) -> DataFrame:
    """df with ``out``: the canonical name of an alias by resolver key, else the cleaned name itself."""
    known = aliases.select(exprs.resolver_key(F.col(alias)).alias("_alias"), F.col(canonical).alias("_canonical")).groupBy("_alias").agg(F.min("_canonical").alias("_canonical"))
    keyed = df.withColumn("_key", exprs.resolver_key(names))
    return keyed.join(known, F.col("_key") == F.col("_alias"), "left").withColumn(out, F.coalesce("_canonical", exprs.clean_text(names))).drop("_key", "_alias", "_canonical")


def findings_by_subject(findings: DataFrame, subject: str, message: str, order: list[str]) -> DataFrame:
    """subject, findings: of each message the first finding by ``order``, in that order. Rows without a subject are left out."""
    rest = [c for c in findings.columns if c not in (subject, message)]
    first = findings.where(F.col(subject).isNotNull()).groupBy(subject, message).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_f"))
    place = F.struct(*[F.col(f"_f.{c}").alias(f"o{i}") for i, c in enumerate(order)])
    row = F.struct(place.alias("place"), F.struct(F.col(message).alias("message"), F.col("_f").alias("finding")).alias("row"))
    return first.groupBy(subject).agg(F.array_sort(F.collect_list(row))["row"].alias("findings"))


def pick_provenance(claims: DataFrame, provenance: DataFrame, claim_key: str, subject: str, fallback: str = "workbook") -> DataFrame:
    """claim_key and the provenance row of each claim(claim_key, subject, source_name, source_type): one that matches name
    and type, else one of the fallback type, else any; of several the highest confidence (null: -1), the latest date
    text, the last name."""
    p = provenance.where(F.col(subject).isNotNull()).select(F.col(subject), F.struct(*[c for c in provenance.columns if c != subject]).alias("p"))
    match = F.when(F.col("source_name").eqNullSafe(F.col("p.source_name")) & F.col("source_type").eqNullSafe(F.col("p.source_type")), 2).when(F.col("p.source_type") == fallback, 1).otherwise(0)
    order = F.struct(match, F.coalesce("p.confidence", F.lit(-1.0)), F.coalesce(F.col("p.as_of_date").cast("string"), F.lit("")), F.coalesce("p.source_name", F.lit("")))
    return claims.join(p, subject).groupBy(claim_key).agg(F.max_by("p", order).alias("provenance"))


def metric_of(field: Column, metrics: dict[str, str] | None = None) -> Column:
    """The policy metric of a field name; null for others."""
    return F.coalesce(*[F.when(field == k, F.lit(v)) for k, v in (metrics or FIELD_METRICS).items()])


def finding_metrics(findings: DataFrame, check: str, field: str, checks: dict[str, list[str]] | None = None, fields: dict[str, str] | None = None) -> DataFrame:
    """A row for each finding and metric that it is about: by its check, or by its field; each metric once."""
    by_check = F.coalesce(*[F.when(F.col(check) == k, F.array(*map(F.lit, v))) for k, v in (checks or CHECK_METRICS).items()], F.array().cast("array<string>"))
    by_field = F.array_compact(F.array(metric_of(F.col(field), fields)))
    return findings.withColumn("metric", F.explode(F.array_distinct(F.concat(by_check, by_field))))


def signals_by_metric(signals: DataFrame, subject: str, metric: str, text: str, strengths: list[str]) -> DataFrame:
    """subject, metric, signals: the texts of signals strong enough, sorted; without a subject or metric none."""
    rows = signals.where(F.col("strength").isin(strengths) & F.col(subject).isNotNull() & F.col(metric).isNotNull())
    return rows.groupBy(subject, metric).agg(F.array_sort(F.collect_list(F.coalesce(F.col(text), F.lit("signal present")))).alias("signals"))


def applicable_signals(claims: DataFrame, signals: DataFrame, subject: str, metric: str) -> DataFrame:
    """Claims with each signal of their subject that names their metric, or none: two equi-joins, no condition on a product."""
    rest = [c for c in signals.columns if c not in (subject, metric)]
    named = claims.join(signals.where(F.col(metric).isNotNull()), [subject, metric])
    general = claims.join(signals.where(F.col(metric).isNull()).select(subject, *rest), subject)
    return named.unionByName(general)


def signal_subject(details: Column, title: Column) -> Column:
    """The subject of a signal: its JSON details' brand_name, else what its title has before one of the marks."""
    before = F.regexp_extract(title, "^(.*?)(?:" + "|".join(TITLE_MARKS) + ")", 1)
    return F.coalesce(exprs.clean_text(F.get_json_object(details, "$.brand_name")), exprs.clean_text(before))


def only_subjects(df: DataFrame, key: str, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of the wanted subjects, and the subjects that have none (empty where the slice is complete)."""
    names = wanted.select(key).distinct()
    return df.join(names, key, "left_semi"), names.join(df, key, "left_anti")


def status_filter(mode: str) -> list[str] | None:
    """The statuses of a named filter; ``all`` is no filter, a plain status stands for itself."""
    return {"all": None, "non_blocked": ["publishable", "advisory"]}.get(mode, [mode])


def substantive(judgments: DataFrame) -> DataFrame:
    """Judgments with a query, a target, a known label and a rationale."""
    filled = lambda c: exprs.clean_text(F.col(c).cast("string")).isNotNull()
    return judgments.where(filled("query_id") & (filled("doc_id") | filled("chunk_id")) & F.col("label").isin(*LABELS) & filled("rationale"))


def cited(name: Column, url: Column) -> Column:
    """Whether a result names its source."""
    return exprs.clean_text(name).isNotNull() | exprs.clean_text(url).isNotNull()
