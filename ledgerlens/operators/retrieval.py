"""Retrieval: chunks, BM25 and dense search, filters, metrics, diagnosis, judgments. Queries meet documents by term."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens.functions import exprs

SIZE, STEP = 900, 780  # characters of a chunk, and from one window of a long paragraph to the next
K1, B = 1.5, 0.75


def chunks(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, chunk_no (from 1), chunk: paragraphs packed greedily up to 900 characters, joined by a blank line.

    A longer paragraph closes the open chunk and is cut in windows of 900 every 780. Empty texts are one empty chunk.
    """
    body = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"^\s+|\s+$", "")
    paragraphs = F.filter(F.transform(F.split(body, r"\n\s*\n"), lambda p: F.regexp_replace(p, r"^\s+|\s+$", "")), lambda p: p != "")
    zero = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"))

    def closed(acc: Column) -> Column:
        return F.when(acc["open"] != "", F.array_append(acc["done"], acc["open"])).otherwise(acc["done"])

    def add(acc: Column, p: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(0), F.ceil(F.greatest(F.length(p) - SIZE, F.lit(0)) / STEP).cast("int")), lambda i: F.substr(p, i * STEP + 1, F.lit(SIZE)))
        fits = (acc["open"] != "") & (F.length(acc["open"]) + 2 + F.length(p) <= SIZE)
        long = F.struct(F.concat(closed(acc), windows).alias("done"), F.lit("").alias("open"))
        joined = F.struct(acc["done"].alias("done"), F.concat(acc["open"], F.lit("\n\n"), p).alias("open"))
        fresh = F.struct(closed(acc).alias("done"), p.alias("open"))
        return F.when(F.length(p) > SIZE, long).when(fits, joined).otherwise(fresh)

    packed = F.aggregate(paragraphs, zero, add, closed)
    whole = F.when(F.size(packed) == 0, F.array(F.lit(""))).otherwise(packed)
    return docs.select(doc_id, F.posexplode(whole).alias("n", "chunk")).select(doc_id, (F.col("n") + 1).alias("chunk_no"), "chunk")


def postings(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, term, tf, length."""
    words = docs.select(doc_id, exprs.tokens(F.coalesce(F.col(text), F.lit(""))).alias("t")).select(doc_id, F.size("t").alias("length"), F.explode("t").alias("term"))
    return words.groupBy(doc_id, "length", "term").agg(F.count("*").alias("tf"))


def document_frequency(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return postings(docs, doc_id, text).groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("occurrences"))


def bm25(docs: DataFrame, doc_id: str, text: str, queries: DataFrame, query_id: str, query: str, k: int, candidates: DataFrame | None = None) -> DataFrame:
    """query_id, doc_id, score (six places), rank: the k best documents of each query.

    Statistics are those of the whole corpus, candidates (doc_id) only restrict the result; repeated query terms count
    repeatedly. Only query terms' postings are joined. Documents of score zero come last by id: they fill a query only
    where fewer than k score, and are taken from the k smallest ids, so queries never meet all documents.
    """
    stats = docs.agg(F.count("*").alias("N"), F.avg(F.regexp_count(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit("[a-z0-9']+"))).alias("avgdl"))
    asked = queries.select(query_id, F.explode(exprs.tokens(F.coalesce(F.col(query), F.lit("")))).alias("term")).groupBy(query_id, "term").agg(F.count("*").alias("qf"))
    terms = asked.select("term").distinct()
    post = postings(docs, doc_id, text).join(terms, "term", "left_semi")
    df = post.groupBy("term").agg(F.count("*").alias("df"))
    if candidates is not None:
        post = post.join(candidates, doc_id, "left_semi")
    idf = F.ln(1 + (F.col("N") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weight = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("length") / F.col("avgdl")))
    weighted = post.join(df, "term").join(F.broadcast(stats)).select(doc_id, "term", weight.alias("w"))
    scored = asked.join(weighted, "term").groupBy(query_id, doc_id).agg(F.bround(F.sum(F.col("qf") * F.col("w")), 6).alias("score"))
    pool = candidates if candidates is not None else docs.select(doc_id)
    fill = pool.select(doc_id).orderBy(doc_id).limit(2 * k).agg(F.collect_list(doc_id).alias("_ids"))  # at most 2 k ids
    rest = queries.select(query_id).join(F.broadcast(fill)).select(query_id, F.explode("_ids").alias(doc_id), F.lit(0.0).alias("score"))
    both = scored.unionByName(rest).groupBy(query_id, doc_id).agg(F.max("score").alias("score"))
    return ranked(both, query_id, doc_id, k)


def ranked(scored: DataFrame, query_id: str, doc_id: str, k: int) -> DataFrame:
    w = Window.partitionBy(query_id).orderBy(F.desc("score"), doc_id)
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def dense(vectors: DataFrame, vec_id: str, vector: str, queries: DataFrame, query_id: str, k: int, rows: int = 2000) -> DataFrame:
    """Exact cosine search of a stated set of query vectors over all vectors: score (six places), rank.

    Queries go in blocks of about ``rows``, each broadcast: only a block meets the vectors at a time, and every task keeps
    its k best of a query before the shuffle.
    """
    def unit(c: Column) -> Column:
        v = F.transform(c, lambda x: x.cast("double"))
        norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))
        return F.transform(v, lambda x: F.try_divide(x, norm))

    q = queries.select(query_id, unit(F.col(vector)).alias("_q"))
    blocks = max(1, -(-q.count() // rows))
    d = vectors.select(vec_id, unit(F.col(vector)).alias("_d"))
    dot = F.aggregate(F.zip_with("_q", "_d", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    parts = [q.where(F.pmod(F.xxhash64(query_id), F.lit(blocks)) == i) if blocks > 1 else q for i in range(blocks)]
    found = [ranked(d.join(F.broadcast(p)).where(F.col(query_id) != F.col(vec_id)).select(query_id, vec_id, F.bround(dot, 6).alias("score")), query_id, vec_id, k) for p in parts]
    return reduce(lambda a, b: a.unionByName(b), found)


def matches(filters: dict, metadata: str | None = None, lists: tuple[str, ...] = ()) -> Column:
    """All filters hold: lists meet by intersection, a list of wanted values is IN, else equality of texts. Keys that
    are no column are read from the JSON column ``metadata`` when they start with a dollar sign."""
    out = F.lit(True)
    for key, wanted in filters.items():
        c = F.get_json_object(metadata, key) if key.startswith("$") else F.col(key)
        options = [str(x) for x in (wanted if isinstance(wanted, list | tuple) else [wanted])]
        if key in lists:
            out = out & F.arrays_overlap(c, F.array(*map(F.lit, options)))
        else:
            out = out & F.coalesce(c.cast("string").isin(*options), F.lit(False))
    return out


def ir_metrics(results: DataFrame, relevant: DataFrame, query_id: str, doc_id: str, k: int) -> DataFrame:
    """recall, mrr, ndcg of each query with relevant rows (query, doc, grade); gain 2 ** grade - 1."""
    grades = relevant.where("grade > 0")
    hits = results.where(F.col("rank") <= k).join(grades, [query_id, doc_id])
    gain = (F.pow(F.lit(2.0), F.col("grade")) - 1) / F.log2(F.col("rank") + 1.0)
    got = hits.groupBy(query_id).agg(F.count("*").alias("found"), F.min("rank").alias("first"), F.sum(gain).alias("dcg"))
    place = F.row_number().over(Window.partitionBy(query_id).orderBy(F.desc("grade"), doc_id))
    ideal = grades.withColumn("_p", place).groupBy(query_id).agg(F.count("*").alias("relevant"), F.sum(F.when(F.col("_p") <= k, (F.pow(F.lit(2.0), F.col("grade")) - 1) / F.log2(F.col("_p") + 1.0))).alias("best"))
    out = ideal.join(got, query_id, "left")
    zero = F.lit(0.0)
    return out.select(query_id, "relevant", F.coalesce(F.bround(F.col("found") / F.col("relevant"), 6), zero).alias("recall"), F.coalesce(F.bround(1 / F.col("first"), 6), zero).alias("mrr"), F.coalesce(F.bround(F.col("dcg") / F.col("best"), 6), zero).alias("ndcg"))


def diagnose(filtered: DataFrame, unfiltered: DataFrame, relevant: DataFrame, query_id: str, doc_id: str, k: int) -> DataFrame:
    """Why a query missed relevant rows: labeling (none), null (all found), retrieval (not in the unfiltered 5 k),
    filtering (there, but filtered away), else ranking."""
    target = relevant.where("grade > 0").select(query_id, doc_id)
    top = filtered.where(F.col("rank") <= k).select(query_id, doc_id, F.lit(1).alias("_top"))
    seen = filtered.select(query_id, doc_id, F.lit(1).alias("_seen"))
    wide = unfiltered.where(F.col("rank") <= 5 * k).select(query_id, doc_id, F.lit(1).alias("_wide"))
    each = target.join(top, [query_id, doc_id], "left").join(seen, [query_id, doc_id], "left").join(wide, [query_id, doc_id], "left")
    out = each.groupBy(query_id).agg(F.count("*").alias("targets"), F.count("_top").alias("found"), F.count_if(F.col("_wide").isNull()).alias("lost"), F.count_if(F.col("_wide").isNotNull() & F.col("_seen").isNull()).alias("cut"))
    cause = F.when(F.col("found") == F.col("targets"), F.lit(None)).when(F.col("lost") > 0, "retrieval").when(F.col("cut") > 0, "filtering").otherwise("ranking")
    return out.select(query_id, "targets", "found", cause.alias("cause"))


def bucket_means(metrics: DataFrame, buckets: Column, names: list[str], places: int = 6) -> DataFrame:
    return metrics.select(F.explode(buckets).alias("bucket"), *names).groupBy("bucket").agg(F.count("*").alias("queries"), *[F.bround(F.avg(n), places).alias(n) for n in names])


def adjudicate(judgments: DataFrame, reviewers: int) -> DataFrame:
    """Of judgments (reviewer, query_id, target, label, must_appear): conflict and agreed label of each target.

    Some reviewer missing: missing_judgment; different labels: relevance_label_conflict; different must_appear:
    must_appear_conflict; at least two reviewers are needed."""
    out = judgments.groupBy("query_id", "target").agg(F.countDistinct("reviewer").alias("r"), F.countDistinct("label").alias("l"), F.countDistinct("must_appear").alias("m"), F.min("label").alias("label"))
    conflict = F.when(F.col("r") < max(2, reviewers), "missing_judgment").when(F.col("l") > 1, "relevance_label_conflict").when(F.col("m") > 1, "must_appear_conflict")
    return out.select("query_id", "target", conflict.alias("conflict"), F.when(conflict.isNull(), F.col("label")).alias("label"))


def judgment_problems(judgments: DataFrame, targets: DataFrame, key: str) -> DataFrame:
    """problem (dangling_target, duplicate_judgment) and target of judgments that do not fit the corpus."""
    lost = judgments.join(targets.select(key).distinct(), key, "left_anti").select(key, F.lit("dangling_target").alias("problem"))
    twice = judgments.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").select(key, F.lit("duplicate_judgment").alias("problem"))
    return lost.unionByName(twice).distinct()


def hard_negatives(results: DataFrame, query_id: str, doc_id: str, kinds: list[tuple[str, Column]]) -> DataFrame:
    """Results that are near misses: the first kind whose condition holds names them; once each."""
    kind = F.coalesce(*[F.when(c, F.lit(n)) for n, c in kinds])
    return results.withColumn("kind", kind).where(F.col("kind").isNotNull()).dropDuplicates([query_id, doc_id, "kind"])


def triage(failures: DataFrame) -> DataFrame:
    """bucket of each failure by its flags, the first that holds: label, rerank, filter, citation, ambiguity, retrieval."""
    flags = [("label_problem", "label"), ("lost_by_rerank", "rerank"), ("filtered_out", "filter"), ("uncited", "citation"), ("ambiguous", "ambiguity")]
    return failures.withColumn("bucket", F.coalesce(*[F.when(F.col(c), F.lit(n)) for c, n in flags], F.lit("retrieval")))
