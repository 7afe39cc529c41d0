"""Intake and judgment packs: validation findings, query specifications, seeded queries, authoring coverage, provenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens.functions import exprs

#: Vocabularies of intake files and packs.
METHODS = ["reported", "estimated"]
SCOPES = ["direct_comparable", "system_only", "segment_only", "global_only", "not_comparable"]
LABELS = {"not_relevant": 0, "relevant": 1, "highly_relevant": 2}
PROVENANCE_FIELDS = ["source_type", "source_name", "source_url_or_doc_id", "as_of_date", "method_reported_or_estimated", "confidence_score"]
#: Other names under which provenance fields come in.
PROVENANCE_ALIASES = {"source_type": ["type"], "source_name": ["name"], "source_url_or_doc_id": ["source_url", "doc_id"], "as_of_date": ["date", "as_of", "effective_date"], "method_reported_or_estimated": ["method", "basis"]}


def _findings(df: DataFrame, keys: list[str], checks: list[tuple[str, str, Column]]) -> DataFrame:
    """keys, severity, check_name of each check that a row breaks."""
    broken = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.struct(F.lit(s).alias("severity"), F.lit(n).alias("check_name"))) for s, n, c in checks]))
    return df.select(*keys, F.explode(broken).alias("x")).select(*keys, "x.*")


def intake_findings(df: DataFrame, keys: list[str], metrics: list[str], scope: str | None = None) -> DataFrame:
    """Findings of a reference file, all columns text: names, provenance, method, confidence, dates, numbers, scope."""
    clean = lambda c: exprs.clean_text(F.col(c), nan_is_null=True)
    score = clean("confidence_score").try_cast("double")
    checks = [
        ("error", "missing_brand", clean("brand_name").isNull()),
        ("warning", "missing_provenance", F.exists(F.array(*[clean(c) for c in PROVENANCE_FIELDS]), lambda x: x.isNull())),
        ("error", "unknown_method", clean("method_reported_or_estimated").isNotNull() & ~F.lower(clean("method_reported_or_estimated")).isin(METHODS)),
        ("error", "bad_confidence", clean("confidence_score").isNotNull() & (score.isNull() | ~score.between(0, 1))),
        ("error", "bad_date", clean("as_of_date").isNotNull() & F.try_to_date(clean("as_of_date"), "yyyy-MM-dd").isNull()),
        ("warning", "no_metrics", F.forall(F.array(*[clean(m) for m in metrics]), lambda x: x.isNull())),
        *[("error", f"bad_number_{m}", clean(m).isNotNull() & exprs.safe_double(F.col(m)).isNull()) for m in metrics],
    ]
    if scope:
        has = F.exists(F.array(*[clean(m) for m in metrics]), lambda x: x.isNotNull())
        checks += [("error", "unknown_scope", clean(scope).isNotNull() & ~F.lower(clean(scope)).isin(SCOPES)), ("warning", "missing_scope", clean(scope).isNull() & has)]
    return _findings(df, keys, checks)


def normalise_provenance(df: DataFrame) -> DataFrame:
    """The six provenance fields by name or alias; confidence clamped to 0..1, dates parsed; other columns as JSON in extra."""
    def named(field: str) -> Column:
        present = [c for c in [field, *PROVENANCE_ALIASES.get(field, [])] if c in df.columns]
        return F.coalesce(*[exprs.clean_text(F.col(c).cast("string")) for c in present]) if present else F.lit(None).cast("string")

    used = {a for f in PROVENANCE_FIELDS for a in [f, *PROVENANCE_ALIASES.get(f, [])]}
    rest = [c for c in df.columns if c not in used]
    out = {f: named(f) for f in PROVENANCE_FIELDS}
    out["as_of_date"] = F.try_to_date(out["as_of_date"], "yyyy-MM-dd")
    out["confidence_score"] = exprs.clamped(out["confidence_score"].try_cast("double"))
    extra = F.to_json(F.struct(*[F.col(c) for c in rest]), {"ignoreNullFields": "false"}) if rest else F.lit("{}")
    return df.select(*[c.alias(n) for n, c in out.items()], extra.alias("extra"))


def pack_findings(queries: DataFrame, judgments: DataFrame) -> DataFrame:
    """check_name and query_id of a pack's problems: duplicate ids, missing text, the same text with other intents,
    judgments of unknown queries, unknown labels, contradictory and repeated judgments."""
    def named(df: DataFrame, check: str) -> DataFrame:
        return df.select("query_id", F.lit(check).alias("check_name")).distinct()

    key = F.lower(exprs.clean_text(F.col("query_text")))
    twice = queries.groupBy("query_id").agg(F.count("*").alias("n")).where("n > 1")
    blank = queries.where(exprs.clean_text(F.col("query_text")).isNull())
    intents = queries.withColumn("_k", key).where("_k is not null")
    mixed = intents.groupBy("_k").agg(F.countDistinct("intent").alias("n")).where("n > 1")
    unknown = judgments.join(queries.select("query_id").distinct(), "query_id", "left_anti")
    label = judgments.where(~F.coalesce(F.col("label").isin(*LABELS), F.lit(False)))
    pairs = judgments.groupBy("query_id", "target").agg(F.count("*").alias("n"), F.countDistinct("label").alias("l"))
    parts = [
        named(twice, "duplicate_query_id"), named(blank, "missing_query_text"), named(intents.join(mixed, "_k", "left_semi"), "conflicting_intent"), named(unknown, "judgment_without_query"),
        named(label, "unknown_label"), named(pairs.where("l > 1"), "contradictory_judgment"), named(pairs.where("n > 1 and l = 1"), "repeated_judgment"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def query_specs(queries: DataFrame, judgments: DataFrame) -> DataFrame:
    """query_id, query_text, grades: map of target to its highest grade; unknown labels do not count."""
    grade = F.coalesce(*[F.when(F.col("label") == k, F.lit(v)) for k, v in LABELS.items()])
    best = judgments.withColumn("g", grade).where("g is not null").groupBy("query_id", "target").agg(F.max("g").alias("g"))
    maps = best.groupBy("query_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("target", "g")))).alias("grades"))
    return queries.select("query_id", "query_text").join(maps, "query_id", "left").select("query_id", "query_text", F.coalesce("grades", F.create_map().cast("map<string,int>")).alias("grades"))


def seed_queries(corpus: DataFrame, entity: str, metric: str, templates: dict[str, str], per_entity: int = 3) -> DataFrame:
    """query_id, query_text, kind: templates filled with each entity's first metrics, once a text, ids with suffixes.

    Templates use {entity} and {metric}."""
    pairs = corpus.select(entity, metric).where(F.col(entity).isNotNull() & F.col(metric).isNotNull()).distinct()
    place = F.row_number().over(Window.partitionBy(entity).orderBy(metric))
    pairs = pairs.withColumn("_n", place).where(F.col("_n") <= per_entity)
    texts = F.array(*[F.struct(F.lit(k).alias("kind"), F.replace(F.replace(F.lit(t), F.lit("{entity}"), F.col(entity).cast("string")), F.lit("{metric}"), F.col(metric).cast("string")).alias("query_text")) for k, t in templates.items()])
    rows = pairs.select(entity, F.explode(texts).alias("x")).select(entity, "x.*").groupBy("query_text").agg(F.min("kind").alias("kind"), F.min(entity).alias(entity))
    base = exprs.slug(F.concat_ws(" ", F.col("kind"), F.col(entity).cast("string")))
    nth = F.row_number().over(Window.partitionBy("_id").orderBy("query_text"))
    return rows.withColumn("_id", base).withColumn("_n", nth).select(F.when(F.col("_n") == 1, F.col("_id")).otherwise(F.concat_ws("-", "_id", "_n")).alias("query_id"), "query_text", "kind")


def entity_pairs(corpus: DataFrame, entity: str, metric: str, first: int = 24) -> DataFrame:
    """Pairs of entities with a common metric, the first by name: an equi-join on the metric."""
    a = corpus.select(entity, metric).distinct()
    b = a.select(F.col(entity).alias("other"), metric)
    return a.join(b, metric).where(F.col(entity) < F.col("other")).groupBy(entity, "other").agg(F.min(metric).alias("metric")).orderBy(entity, "other").limit(first)


def coverage_by(df: DataFrame, dimensions: list[str], least: int = 2) -> DataFrame:
    """dimension, value, queries, under_covered: how many queries each value of each dimension has, in one pass."""
    each = F.array(*[F.struct(F.lit(d).alias("dimension"), F.coalesce(F.col(d).cast("string"), F.lit("none")).alias("value")) for d in dimensions])
    out = df.select(F.explode(each).alias("x")).select("x.*").groupBy("dimension", "value").agg(F.count("*").alias("queries"))
    return out.withColumn("under_covered", F.col("queries") < least)


def supporting_signals(interpretations: Column, signals: Column, caveats: Column) -> Column:
    """struct(support: the fixed statements and the first three signals, caveats: up to six different ones)."""
    return F.struct(F.concat(F.slice(interpretations, 1, 4), F.slice(F.coalesce(signals, F.array().cast("array<string>")), 1, 3)).alias("support"), F.slice(exprs.distinct_texts(F.coalesce(caveats, F.array().cast("array<string>"))), 1, 6).alias("caveats"))


def preflight(decisions: DataFrame, publishable: DataFrame, blocked: DataFrame, keys: list[str]) -> DataFrame:
    """check_name, problems: subsets equal the decisions of their status as multisets, and no decision key occurs twice."""
    from ledgerlens.operators.rules import differences

    parts = []
    for name, subset in (("publishable", publishable), ("blocked", blocked)):
        parts.append(differences(decisions.where(F.col("status") == name), subset, keys).agg(F.count("*").alias("problems")).select(F.lit(f"{name}_matches").alias("check_name"), "problems"))
    twice = decisions.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    return parts[0].unionByName(parts[1]).unionByName(twice.agg(F.count("*").alias("problems")).select(F.lit("decision_keys_unique").alias("check_name"), "problems"))
