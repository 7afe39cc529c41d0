"""Evaluation of retrieval: relevance, runs over several retrievers, reranking, inspection, authoring of judgments.

A run is one table of results (retriever, query_id, doc_id, rank, score); everything else derives from it by joins, so
all queries of all retrievers are evaluated at once.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens.functions import exprs
from ledgerlens.operators import lookups, retrieval

RESULTS = "retriever string, query_id string, doc_id string, rank int, score double"
#: The columns that a reviewer fills in.
WORKSPACE = ("label", "rationale", "must_appear", "reviewer")
#: Statuses of a pack in which the adjudicated judgments count.
ADJUDICATED = ("adjudicated", "approved")
#: Forecasters that are only planned, with what they need.
EXPERIMENTS = {"chronos": {"needs": ("torch", "chronos"), "least_periods": 3}}


def relevant_targets(specs: DataFrame, corpus: DataFrame, filters: Callable[[], Column] | None = None) -> DataFrame:
    """query_id, chunk_id, grade, by: explicit chunks; for queries without them the chunks of explicit documents; for those
    without either the chunks that the filters admit (grade 1).

    specs: query_id, chunk_ids, doc_ids (map of id to grade). corpus: doc_id, chunk_id. ``filters`` is a condition on a
    corpus row, the same for all queries that have no targets.
    """
    has = lambda c: F.size(F.coalesce(c, F.create_map().cast("map<string,int>"))) > 0
    chunks = specs.where(has("chunk_ids")).select("query_id", F.explode("chunk_ids").alias("chunk_id", "grade"), F.lit("chunk").alias("by"))
    docs = specs.where(~has("chunk_ids") & has("doc_ids")).select("query_id", F.explode("doc_ids").alias("doc_id", "grade"))
    docs = docs.join(corpus.select("doc_id", "chunk_id").distinct(), "doc_id").select("query_id", "chunk_id", "grade", F.lit("document").alias("by"))
    out = chunks.unionByName(docs)
    if filters is not None:
        rest = specs.where(~has("chunk_ids") & ~has("doc_ids")).select("query_id")
        # the admitted rows are the same for all such queries: one array, exploded for each
        admitted = corpus.where(filters()).agg(F.array_sort(F.collect_set("chunk_id")).alias("ids"))
        out = out.unionByName(rest.join(F.broadcast(admitted)).select("query_id", F.explode("ids").alias("chunk_id"), F.lit(1).alias("grade"), F.lit("filter").alias("by")))
    return out.where("grade > 0")


def rerank(results: DataFrame, scorer: Callable[[Column, Column], Column] | None, query: str, text: str, k: int) -> tuple[DataFrame, str]:
    """Results of each retriever ranked anew by ``scorer(query, text)``, a column, and why not where there is none."""
    if scorer is None:
        return results.where(F.col("rank") <= k), "skipped: no scorer is given"
    place = F.row_number().over(Window.partitionBy("retriever", "query_id").orderBy(F.desc("rerank_score"), "rank", "doc_id"))
    scored = results.withColumn("rerank_score", scorer(F.col(query), F.col(text))).withColumn("first_rank", F.col("rank"))
    return scored.withColumn("rank", place).where(F.col("rank") <= k), "ok"


def run(retrievers: dict[str, Callable[[], DataFrame]]) -> tuple[DataFrame, list[dict]]:
    """The results of all retrievers, and of each its status, reason and seconds of planning.

    A retriever returns query_id, doc_id, rank, score. One that raises is reported and left out.
    """
    parts, states = [], []
    for name, f in retrievers.items():
        began = time.perf_counter()
        try:
            parts.append(f().select(F.lit(name).alias("retriever"), "query_id", "doc_id", "rank", "score"))
            states.append({"retriever": name, "status": "ok", "reason": None})
        except (ValueError, RuntimeError, ImportError) as e:
            states.append({"retriever": name, "status": "skipped", "reason": str(e)})
        states[-1]["seconds"] = time.perf_counter() - began
    if not parts:
        raise ValueError("no retriever gave results")
    return reduce(lambda a, b: a.unionByName(b), parts), states


def metrics_by_retriever(results: DataFrame, relevant: DataFrame, k: int) -> DataFrame:
    """retriever, query_id, relevant, recall, mrr, ndcg for every retriever and query that has targets, found or not."""
    names = results.select("retriever").distinct()
    # retriever and query are one key, so that the metrics of all runs are one aggregate
    key = lambda df: df.withColumn("_run", F.struct("retriever", "query_id"))
    targets = key(_per_retriever(names, relevant))
    out = retrieval.ir_metrics(key(results).select("_run", "doc_id", "rank"), targets.select("_run", "doc_id", "grade"), "_run", "doc_id", k)
    return out.select("_run.retriever", "_run.query_id", "relevant", "recall", "mrr", "ndcg")


def _per_retriever(names: DataFrame, relevant: DataFrame) -> DataFrame:
    """The targets once for each retriever; the few names travel as one array."""
    listed = names.agg(F.array_sort(F.collect_set("retriever")).alias("_names"))
    return relevant.join(F.broadcast(listed)).withColumn("retriever", F.explode("_names")).drop("_names")


def run_summary(metrics: DataFrame, places: int = 6) -> DataFrame:
    """retriever, queries and the mean of each metric."""
    return metrics.groupBy("retriever").agg(F.count("*").alias("queries"), *[F.bround(F.avg(c), places).alias(c) for c in ("recall", "mrr", "ndcg")])


def rerank_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """retriever and query_id with the change of each metric by reranking."""
    b = after.select("retriever", "query_id", *[F.col(c).alias(f"_{c}") for c in ("recall", "mrr", "ndcg")])
    return before.join(b, ["retriever", "query_id"]).select("retriever", "query_id", *[F.bround(F.col(f"_{c}") - F.col(c), 6).alias(f"{c}_delta") for c in ("recall", "mrr", "ndcg")])


def inspect(results: DataFrame, relevant: DataFrame, query_id, docs: DataFrame, k: int) -> DataFrame:
    """One query: its results of all retrievers with grade (0: not relevant), citation flag and title, and the relevant
    documents that no retriever found (rank null)."""
    found = results.where((F.col("query_id") == query_id) & (F.col("rank") <= k))
    targets = relevant.where(F.col("query_id") == query_id).select("doc_id", "grade")
    rows = found.select("retriever", "doc_id", "rank", "score").join(targets, "doc_id", "full")
    facts = docs.select("doc_id", "title", lookups.cited(F.col("source_name"), F.col("source_url")).alias("cited"))
    return rows.join(facts, "doc_id", "left").select("retriever", "doc_id", "rank", "score", F.coalesce("grade", F.lit(0)).alias("grade"), "title", F.coalesce("cited", F.lit(False)).alias("cited"))


# ---------------------------------------------------------------- authoring
def preferred_judgments(folder: str, status: str) -> str:
    """The adjudicated judgments where the pack's status says they are final, else the reviewers' own."""
    return f"{folder}/{'adjudicated_judgments' if status.strip().lower() in ADJUDICATED else 'judgments'}.csv"


def pack_metadata(given: dict) -> dict:
    """Metadata of a benchmark pack with every key that readers expect, texts trimmed, names sorted and each once."""
    text = lambda k, d="": str(given.get(k) or d).strip()
    names = sorted({str(x).strip() for x in given.get("reviewers") or [] if str(x).strip()})
    return {"pack_id": text("pack_id"), "title": text("title", given.get("pack_id") or ""), "version": text("version", "v1"), "status": text("status", "draft").lower(), "reviewers": names, "notes": text("notes")}


def judgment_workspace(results: DataFrame, reviewers: list[str], per_query: int) -> DataFrame:
    """Candidates for judgment: of each query the ``per_query`` best documents of any retriever, once for each reviewer, with
    empty columns to fill in."""
    best = results.groupBy("query_id", "doc_id").agg(F.min("rank").alias("rank"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("rank", "doc_id"))
    rows = best.withColumn("candidate", place).where(F.col("candidate") <= per_query)
    empty = [F.lit("").alias(c) for c in WORKSPACE if c != "reviewer"]
    return rows.select("query_id", "doc_id", "candidate", F.explode(F.array(*map(F.lit, reviewers))).alias("reviewer"), *empty)


def authoring_summary(queries: DataFrame, judgments: DataFrame) -> DataFrame:
    """query_id, judged, reviewers, relevant, state (empty, single, complete): how far the judgments of each query are."""
    done = lookups.substantive(judgments).groupBy("query_id").agg(F.count("*").alias("judged"), F.countDistinct("reviewer").alias("reviewers"), F.count_if(F.col("label") != "not_relevant").alias("relevant"))
    out = queries.select("query_id").distinct().join(done, "query_id", "left").na.fill(0, ["judged", "reviewers", "relevant"])
    return out.withColumn("state", F.when(F.col("judged") == 0, "empty").when(F.col("reviewers") < 2, "single").otherwise("complete"))


def run_context(metrics: DataFrame, failures: DataFrame, least: float = 0.5) -> DataFrame:
    """query_id, worst recall over the retrievers and the causes of its failures: what an author should look at first."""
    causes = failures.where(F.col("cause").isNotNull()).groupBy("query_id").agg(F.array_sort(F.collect_set("cause")).alias("causes"))
    worst = metrics.groupBy("query_id").agg(F.min("recall").alias("worst_recall"))
    return worst.join(causes, "query_id", "left").where((F.col("worst_recall") < least) | F.col("causes").isNotNull()).select("query_id", "worst_recall", F.coalesce("causes", F.array().cast("array<string>")).alias("causes"))


def experiment_guard(name: str, periods: int, enabled: bool, environment: dict[str, str], available: Callable[[str], bool]) -> dict:
    """Whether a planned model may run: asked for, not in continuous integration, enough periods, its packages present."""
    spec = EXPERIMENTS[name]
    missing = [p for p in spec["needs"] if not available(p)]
    reason = (
        "not enabled" if not enabled
        else "continuous integration" if environment.get("CI", "").lower() in ("1", "true")
        else f"fewer than {spec['least_periods']} periods" if periods < spec["least_periods"]
        else f"missing packages: {', '.join(missing)}" if missing
        else None
    )
    return {"experiment": name, "status": "skipped" if reason else "ready", "reason": reason}


def query_text(c: Column) -> Column:
    """The text of a query as retrievers see it."""
    return F.coalesce(exprs.clean_text(c), F.lit(""))
