"""Queries of retrieval evaluation: runs over two retrievers, reranking, inspection and the authoring of judgments."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens.operators import evaluation
from ledgerlens.plans.base import query, table
from ledgerlens.plans.retrieval_plans import _BM25, _bm25

K = 5
#: Two retrievers: BM25, and the longest documents whatever the query. Relevant are the documents of the item's source.
_RUN = _BM25.format(where="") + """, l as (select doc_id, row_number() over (order by n_chars desc, doc_id) k from documents),
 ru as (select 'bm25' retriever, item_id::varchar query_id, doc_id::varchar doc_id, k, score from r where k <= 5 union all select 'longest', item_id::varchar, doc_id::varchar, k, 1.0::double / k from benchmark, l where k <= 5),
 tg as (select item_id::varchar query_id, doc_id::varchar doc_id from benchmark join documents on source = 'src' || (item_id % 10)),
 ft as (select query_id, count(*) relevant, sum(1 / log2(p + 1)) filter (p <= 5) best from (select *, row_number() over (partition by query_id order by doc_id) p from tg) group by 1),
 ht as (select retriever, query_id, count(*) f, min(k) first, sum(1 / log2(k + 1)) dcg from ru join tg using (query_id, doc_id) group by 1, 2),
 mt as (select n.retriever, ft.query_id, relevant, coalesce(round_even(f / relevant::double, 6), 0) recall, coalesce(round_even(1.0::double / first, 6), 0) mrr, coalesce(round_even(dcg / best, 6), 0) ndcg
  from ft cross join (select distinct retriever from ru) n left join ht on ht.retriever = n.retriever and ht.query_id = ft.query_id)
"""


def _results(spark, sf):
    items = table(spark, sf, "benchmark").select(F.col("item_id").cast("string").alias("query_id"))
    found = lambda: _bm25(spark, sf, K).select(F.col("item_id").cast("string").alias("query_id"), F.col("doc_id").cast("string").alias("doc_id"), "rank", "score")

    def longest():
        top = table(spark, sf, "documents").select("doc_id", "n_chars").orderBy(F.desc("n_chars"), "doc_id").limit(K)
        place = F.row_number().over(Window.orderBy(F.desc("n_chars"), "doc_id"))
        listed = top.withColumn("rank", place).agg(F.array_sort(F.collect_list(F.struct("rank", F.col("doc_id").cast("string").alias("doc_id")))).alias("top"))
        return items.join(F.broadcast(listed)).select("query_id", F.explode("top").alias("t")).select("query_id", "t.doc_id", "t.rank", (1.0 / F.col("t.rank")).alias("score"))

    return evaluation.run({"bm25": found, "longest": longest})[0]


def _targets(spark, sf):
    items = table(spark, sf, "benchmark").select(F.col("item_id").cast("string").alias("query_id"), F.concat(F.lit("src"), (F.col("item_id") % 10).cast("string")).alias("source"))
    return items.join(table(spark, sf, "documents").select("source", F.col("doc_id").cast("string").alias("doc_id")), "source").select("query_id", "doc_id", F.lit(1).alias("grade"))


def _metrics(spark, sf, results=None):
    return evaluation.metrics_by_retriever(_results(spark, sf) if results is None else results, _targets(spark, sf), K)


@query(_RUN + "select retriever, query_id, relevant, recall, mrr, ndcg from mt")
def q_run_metrics(spark, sf):
    return _metrics(spark, sf)


@query(_RUN + "select retriever, count(*) queries, round_even(avg(recall), 9) recall, round_even(avg(mrr), 9) mrr, round_even(avg(ndcg), 9) ndcg from mt group by 1")
def q_eval_run(spark, sf):
    return evaluation.run_summary(_metrics(spark, sf), 9)


@query(_RUN + """, rr as (select ru.*, row_number() over (partition by retriever, query_id order by d.n_chars, k, ru.doc_id) k2 from ru join documents d on d.doc_id::varchar = ru.doc_id),
 h2 as (select retriever, query_id, count(*) f, min(k2) first, sum(1 / log2(k2 + 1)) dcg from rr join tg using (query_id, doc_id) group by 1, 2),
 m2 as (select mt.retriever, mt.query_id, coalesce(round_even(1.0::double / h2.first, 6), 0) mrr, coalesce(round_even(dcg / best, 6), 0) ndcg from mt join ft using (query_id) left join h2 on h2.retriever = mt.retriever and h2.query_id = mt.query_id)
 select retriever, query_id, round_even(m2.mrr - mt.mrr, 6) mrr_delta, round_even(m2.ndcg - mt.ndcg, 6) ndcg_delta from mt join m2 using (retriever, query_id)""")
def q_rerank_delta(spark, sf):
    results = _results(spark, sf)
    lengths = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), "n_chars")
    joined = results.join(lengths, "doc_id")
    after, _ = evaluation.rerank(joined, lambda q, t: -t, "query_id", "n_chars", K)
    return evaluation.rerank_delta(_metrics(spark, sf, results), _metrics(spark, sf, after)).select("retriever", "query_id", "mrr_delta", "ndcg_delta")


@query(_RUN + """, one as (select min(item_id)::varchar q from benchmark), x as (select retriever, ru.doc_id, k, tg.doc_id is not null g from ru join one on query_id = q left join tg using (query_id, doc_id)),
 miss as (select doc_id from tg join one on query_id = q where doc_id not in (select doc_id from x))
 select retriever, x.doc_id, k::integer rank, g::integer grade, d.source title, d.lang <> '' cited from x join documents d on d.doc_id::varchar = x.doc_id union all select null, m.doc_id, null, 1, d.source, d.lang <> '' from miss m join documents d on d.doc_id::varchar = m.doc_id""")
def q_inspect_query(spark, sf):
    one = table(spark, sf, "benchmark").agg(F.min("item_id")).first()[0]
    docs = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), F.col("source").alias("title"), F.col("lang").alias("source_name"), F.lit(None).cast("string").alias("source_url"))
    return evaluation.inspect(_results(spark, sf), _targets(spark, sf), str(one), docs, K).drop("score")


@query("""with c as (select conv_id || '-' || turn chunk_id, conv_id::varchar doc_id, role from conversations), s as (select conv_id::varchar query_id, case when conv_id % 3 = 0 then 'chunk' when conv_id % 3 = 1 then 'document' else 'filter' end kind, conv_id from (select distinct conv_id from conversations))
 select query_id, conv_id || '-0' chunk_id, 2 grade, 'chunk' as by from s where kind = 'chunk' union all select query_id, chunk_id, 1, 'document' from s join c on c.doc_id = s.query_id where kind = 'document'
 union all select query_id, chunk_id, 1, 'filter' from s, c where kind = 'filter' and role = 'system'""")
def q_relevant_targets(spark, sf):
    turns = table(spark, sf, "conversations")
    corpus = turns.select(F.concat_ws("-", "conv_id", "turn").alias("chunk_id"), F.col("conv_id").cast("string").alias("doc_id"), "role")
    ids = turns.select("conv_id").distinct()
    none = F.create_map().cast("map<string,int>")
    chunk = F.when(F.col("conv_id") % 3 == 0, F.create_map(F.concat_ws("-", "conv_id", F.lit("0")), F.lit(2))).otherwise(none)
    doc = F.when(F.col("conv_id") % 3 == 1, F.create_map(F.col("conv_id").cast("string"), F.lit(1))).otherwise(none)
    specs = ids.select(F.col("conv_id").cast("string").alias("query_id"), chunk.alias("chunk_ids"), doc.alias("doc_ids"))
    return evaluation.relevant_targets(specs, corpus, lambda: F.col("role") == "system")


@query(_RUN + """, b as (select query_id, doc_id, min(k) k from ru group by 1, 2), c as (select *, row_number() over (partition by query_id order by k, doc_id) candidate from b)
 select query_id, doc_id, candidate::integer candidate, reviewer, '' as label, '' rationale, '' must_appear from c, (values ('ann'), ('bo')) v(reviewer) where candidate <= 6""")
def q_judgment_workspace(spark, sf):
    return evaluation.judgment_workspace(_results(spark, sf), ["ann", "bo"], 6)


_MADE = """with j as (select conv_id query_id, turn::varchar doc_id, case turn % 3 when 0 then 'relevant' when 1 then 'not_relevant' else 'odd' end as label, case when length(text) > 60 then text end rationale, role reviewer from conversations),
 ok as (select * from j where label <> 'odd' and trim(rationale) <> '')
"""


@query(_MADE + """, d as (select query_id, count(*) judged, count(distinct reviewer) reviewers, count(*) filter (label <> 'not_relevant') relevant from ok group by 1)
 select q.query_id, coalesce(judged, 0) judged, coalesce(reviewers, 0) reviewers, coalesce(relevant, 0) relevant, case when judged is null then 'empty' when reviewers < 2 then 'single' else 'complete' end state from (select distinct conv_id query_id from conversations) q left join d using (query_id)""")
def q_authoring_summary(spark, sf):
    turns = table(spark, sf, "conversations")
    label = F.when(F.col("turn") % 3 == 0, "relevant").when(F.col("turn") % 3 == 1, "not_relevant").otherwise("odd")
    made = turns.select(F.col("conv_id").alias("query_id"), F.col("turn").cast("string").alias("doc_id"), F.lit(None).cast("string").alias("chunk_id"), label.alias("label"), F.when(F.length("text") > 60, F.col("text")).alias("rationale"), F.col("role").alias("reviewer"))
    return evaluation.authoring_summary(made, made)


@query(_RUN + ", w as (select query_id, min(recall) worst_recall, count(*) filter (recall = 0) z from mt group by 1) select query_id, worst_recall, case when z > 0 then 'retrieval' else '' end causes from w where worst_recall < 0.5 or z > 0")
def q_run_context(spark, sf):
    metrics = _metrics(spark, sf)
    failures = metrics.select("query_id", F.when(F.col("recall") == 0, "retrieval").alias("cause"))
    return evaluation.run_context(metrics, failures).withColumn("causes", F.array_join("causes", "|"))
