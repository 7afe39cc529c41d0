"""Command line: python -m ledgerlens COMMAND --help. Each command reads tables from folders and writes to a folder."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators import evaluation, forecast, gate, lookups, packs, quality, reconcile, retrieval, rules, scorecards, signals
from ledgerlens.sources import normalise, sinks, tables


def session() -> SparkSession:
    return SparkSession.builder.appName("ledgerlens").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def _read(path: str) -> DataFrame:
    return tables.read(SparkSession.getActiveSession(), path)


def validate(a) -> DataFrame:
    """Implied values of --table: amount * scale / count against actual."""
    df = quality.implied_value(_read(a.table), F.col(a.amount), F.col(a.count), F.col(a.actual), a.scale, a.tolerance)
    return quality.severity_counts(df)


def run_signals(a) -> DataFrame:
    df, fields = _read(a.table), a.fields.split(",")
    parts = [signals.benford(df, fields).select(F.lit("benford_first").alias("signal_type"), "field", "strength"), signals.end_digit_heaping(df, fields).select(F.lit("end_digit_heaping").alias("signal_type"), "field", "strength"), signals.nice_numbers(df, fields).select(F.lit("nice_numbers").alias("signal_type"), "field", "strength")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def run_reconcile(a) -> DataFrame:
    best = reconcile.best_evidence(_read(a.evidence), a.key.split(","), reconcile.PRIMARY_PRIORITY).withColumnRenamed("value", "reference_value")
    return reconcile.compare_numeric(_read(a.table).join(best, a.key.split(","), "left"), F.col("value"), F.col("reference_value"))


def audit_reference(a) -> DataFrame:
    return packs.intake_findings(_read(a.table), a.key.split(","), a.metrics.split(","))


def gate_gold(a) -> DataFrame:
    policy = gate.Policy("cli", tuple(gate.MetricPolicy(m) for m in a.metrics.split(",")))
    return gate.decide(_read(a.table), policy)


def summarise(a) -> DataFrame:
    return gate.summary(_read(a.table), a.by.split(","))


def snapshot(a) -> None:
    sinks.write_snapshot(_read(a.table), a.out, a.date)


def run_forecast(a) -> DataFrame:
    split = forecast.time_split(forecast.panel(tables.load_snapshots(SparkSession.getActiveSession(), a.table), a.entity, a.date, a.value, a.date), a.entity, a.date, a.holdout, a.train)
    return forecast.metrics(forecast.forecasts(split, a.entity, a.date, a.value, season=a.season), ["baseline"])


def build_corpus(a) -> DataFrame:
    return retrieval.chunks(_read(a.table), a.id, a.text)


def search(a) -> DataFrame:
    q = SparkSession.getActiveSession().createDataFrame([(1, a.query)], "query_id int, query string")
    return retrieval.bm25(_read(a.table), a.id, a.text, q, "query_id", "query", a.k)


def validate_pack(a) -> DataFrame:
    return packs.pack_findings(_read(a.queries), _read(a.judgments))


def adjudicate(a) -> DataFrame:
    return retrieval.adjudicate(_read(a.table), a.reviewers)


def triage(a) -> DataFrame:
    return retrieval.triage(_read(a.table))


def preflight(a) -> DataFrame:
    spark = SparkSession.getActiveSession()
    return packs.preflight(_read(a.table), sinks.read_gate(spark, a.gold, "publishable"), sinks.read_gate(spark, a.gold, "blocked"), a.key.split(","))


def compare_decisions(a) -> DataFrame:
    return rules.differences(_read(a.table), _read(a.other), a.key.split(","))


def _mapping(text: str) -> dict[str, str]:
    """old=new,old=new"""
    return dict(pair.split("=", 1) for pair in text.split(","))


def ingest(a) -> DataFrame:
    """A raw sheet (with its rows' places in --position) renamed by --names, cleaned and coerced."""
    return normalise.core_metrics(_read(a.table), _mapping(a.names), a.sheet, a.position)


def single_source(a) -> DataFrame:
    """The graded rows of one source; the pairs that it does not cover go beside them."""
    own, gaps = scorecards.single_source_slice(_read(a.table), a.source, a.subject, a.field)
    sinks.write_table(gaps, a.out.removesuffix(".parquet") + "_gaps.parquet")
    return own


def primary_source(a) -> DataFrame:
    """Tier and status of the best usable source of each key."""
    return reconcile.source_tier(_read(a.table), a.key.split(","), reconcile.PRIMARY_PRIORITY, a.primary.split(","), F.expr(a.usable))


def score_credibility(a) -> None:
    """Rollup by subject, with its report."""
    scored = _read(a.table)
    sums, queue = scorecards.credibility_summary(scored, a.key.split(","))
    report = scorecards.render("Credibility", [("By status", sums), ("To review first", queue)])
    sinks.write_rollup(SparkSession.getActiveSession(), scorecards.credibility_rollup(scored, a.subject), a.out, "credibility", report)


def build_panel(a) -> DataFrame:
    return forecast.panel(tables.load_snapshots(SparkSession.getActiveSession(), a.table), a.entity, a.date, a.value, a.date)


def seed_queries(a) -> DataFrame:
    templates = {"value": "What is the {metric} of {entity}?", "status": "Is the {metric} of {entity} publishable?"}
    return packs.seed_queries(_read(a.table), a.entity, a.metric, templates)


def init_pack(a) -> None:
    """Metadata of a new benchmark pack."""
    import json

    given = {"pack_id": a.pack, "title": a.title, "reviewers": a.reviewers.split(",")}
    sinks.put_text(SparkSession.getActiveSession(), f"{a.out}/metadata.json", json.dumps(evaluation.pack_metadata(given), ensure_ascii=False, indent=1))


def bootstrap_judgments(a) -> DataFrame:
    """Candidates for judgment of a run's results, for each reviewer."""
    return evaluation.judgment_workspace(_read(a.table), a.reviewers.split(","), a.k)


def check_reviewer(a) -> DataFrame:
    """Judgments whose target the corpus does not have, or that occur twice."""
    return retrieval.judgment_problems(_read(a.table), _read(a.corpus), a.key)


def evaluate(a) -> DataFrame:
    """BM25 over --table for the queries, against the relevant rows: metrics by query."""
    corpus, queries = _read(a.table), _read(a.queries)

    def bm25() -> DataFrame:
        found = retrieval.bm25(corpus, a.id, a.text, queries, "query_id", "query", a.k)
        return found.select(F.col("query_id").cast("string").alias("query_id"), F.col(a.id).cast("string").alias("doc_id"), "rank", "score")

    results, _ = evaluation.run({"bm25": bm25})
    return evaluation.metrics_by_retriever(results, _read(a.relevant), a.k)


def inspect_query(a) -> DataFrame:
    return evaluation.inspect(_read(a.table), _read(a.relevant), a.query, _read(a.corpus), a.k)


def mine_negatives(a) -> DataFrame:
    """Results of another language or source than --language."""
    kinds = [("wrong_language", F.col("lang") != a.language)]
    return retrieval.hard_negatives(_read(a.table), "query_id", "doc_id", kinds)


def authoring_summary(a) -> DataFrame:
    return evaluation.authoring_summary(_read(a.queries), _read(a.table))


def report(a) -> None:
    """A report of each subject and one of all."""
    cards = scorecards.subject_scorecards(_read(a.table), _read(a.findings), _read(a.graded), a.subject, a.field)
    overall = scorecards.render("All subjects", [("Status", scorecards.global_scorecard(cards))])
    sinks.write_reports(SparkSession.getActiveSession(), a.out, cards, a.subject, overall)


def demo(a) -> DataFrame:
    """The slice of the wanted subjects; a subject without rows is an error."""
    rows, missing = lookups.only_subjects(_read(a.table), a.key, _read(a.wanted))
    if lost := [str(r[0]) for r in missing.limit(10).collect()]:
        raise ValueError(f"no rows of {', '.join(lost)}")
    return rows


def package(a) -> None:
    """Copies --tables (name=path,...) into one folder with a manifest."""
    sinks.bundle(SparkSession.getActiveSession(), _mapping(a.tables), a.out)


#: name -> (function, required options, optional ones with their default and type)
COMMANDS = {
    "validate": (validate, ["table", "amount", "count", "actual"], {"scale": (1.0, float), "tolerance": (0.05, float)}),
    "signals": (run_signals, ["table", "fields"], {}),
    "reconcile": (run_reconcile, ["table", "evidence", "key"], {}),
    "audit-reference": (audit_reference, ["table", "key", "metrics"], {}),
    "gate": (gate_gold, ["table", "metrics"], {}),
    "gate-summary": (summarise, ["table", "by"], {}),
    "snapshot": (snapshot, ["table", "date"], {}),
    "forecast": (run_forecast, ["table", "entity", "date", "value"], {"holdout": (1, int), "train": (2, int), "season": (None, int)}),
    "build-corpus": (build_corpus, ["table", "id", "text"], {}),
    "search": (search, ["table", "id", "text", "query"], {"k": (5, int)}),
    "validate-pack": (validate_pack, ["queries", "judgments"], {}),
    "adjudicate": (adjudicate, ["table"], {"reviewers": (2, int)}),
    "triage": (triage, ["table"], {}),
    "preflight": (preflight, ["table", "gold", "key"], {}),
    "ingest": (ingest, ["table", "names", "sheet", "position"], {}),
    "reconcile-source": (single_source, ["table", "source", "subject", "field"], {}),
    "reconcile-primary": (primary_source, ["table", "key", "primary"], {"usable": ("true", str)}),
    "score-credibility": (score_credibility, ["table", "subject", "key"], {}),
    "build-panel": (build_panel, ["table", "entity", "date", "value"], {}),
    "seed-queries": (seed_queries, ["table", "entity", "metric"], {}),
    "init-pack": (init_pack, ["pack"], {"title": ("", str), "reviewers": ("", str)}),
    "bootstrap-judgments": (bootstrap_judgments, ["table", "reviewers"], {"k": (10, int)}),
    "check-reviewer": (check_reviewer, ["table", "corpus", "key"], {}),
    "evaluate": (evaluate, ["table", "id", "text", "queries", "relevant"], {"k": (5, int)}),
    "inspect": (inspect_query, ["table", "relevant", "corpus", "query"], {"k": (5, int)}),
    "mine-negatives": (mine_negatives, ["table", "language"], {}),
    "authoring-summary": (authoring_summary, ["table", "queries"], {}),
    "report": (report, ["table", "findings", "graded", "subject", "field"], {}),
    "demo": (demo, ["table", "wanted", "key"], {}),
    "package": (package, ["tables"], {}),
    "compare-decisions": (compare_decisions, ["table", "other", "key"], {}),
}


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="ledgerlens")
    subs = parser.add_subparsers(dest="command", required=True)
    for name, (f, required, optional) in COMMANDS.items():
        p = subs.add_parser(name, help=(f.__doc__ or "").split("\n")[0])
        p.add_argument("--out", required=True)
        for r in required:
            p.add_argument(f"--{r}", required=True)
        for o, (default, kind) in optional.items():
            p.add_argument(f"--{o}", default=default, type=kind)
    a = parser.parse_args(args)
    session()
    try:
        out = COMMANDS[a.command][0](a)
        if out is not None:
            sinks.write_table(out, a.out)
    except Exception as e:
        print(sinks.audit_record(a.command, e), file=sys.stderr)
        raise
    print(sinks.audit_record(a.command))
    return 0


if __name__ == "__main__":
    sys.exit(main())
