"""Retrieval and rule queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.functions import exprs
from ledgerlens.operators import retrieval, rules
from ledgerlens.plans.base import query, table
from ledgerlens.plans.reconcile_plans import _DECISIONS, _GRADED, _decisions, _graded


@query("""with d as (select doc_id, regexp_replace(text, '^\\s+|\\s+$', '', 'g') t from documents),
 w as (select doc_id, i + 1 chunk_no, substr(t, (i * 780 + 1)::bigint, 900) c from (select doc_id, t, unnest(range(0, 1 + case when length(t) > 900 then ceil((length(t) - 900) / 780.0)::bigint else 0 end)) i from d))
 select doc_id, chunk_no::integer chunk_no, length(c)::integer n_chars, md5(c) digest from w""")
def q_chunk_documents(spark, sf):
    out = retrieval.chunks(table(spark, sf, "documents"), "doc_id", "text")
    return out.select("doc_id", "chunk_no", F.length("chunk").alias("n_chars"), F.md5("chunk").alias("digest"))


_POST = """with t as (select doc_id, regexp_extract_all(lower(text), '[a-z0-9'']+') w from documents), p0 as (select doc_id, len(w) l, unnest(w) term from t),
 p as (select doc_id, l, term, count(*) tf from p0 group by all), df as (select term, count(*) df, sum(tf)::bigint occurrences from p group by 1)
"""


@query(_POST + "select * from df")
def q_tokenise_df(spark, sf):
    return retrieval.document_frequency(table(spark, sf, "documents"), "doc_id", "text")


_BM25 = _POST + """, st as (select count(*)::double n, avg(len(w)) a from t), q1 as (select item_id, unnest(regexp_extract_all(lower(text), '[a-z0-9'']+')) term from benchmark),
 q as (select item_id, term, count(*) qf from q1 group by all),
 s as (select item_id, doc_id, round_even(sum(qf * ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * l / a))), 6) score from q join df using (term) join p using (term), st {where} group by 1, 2),
 r as (select *, row_number() over (partition by item_id order by score desc, doc_id) k from s)
"""


def _bm25(spark, sf, k, candidates=None):
    bench = table(spark, sf, "benchmark").select("item_id", F.col("text").alias("query"))
    return retrieval.bm25(table(spark, sf, "documents"), "doc_id", "text", bench, "item_id", "query", k, candidates)


@query(_BM25.format(where="") + "select item_id, doc_id, score, k::integer rank from r where k <= 5")
def q_bm25_topk(spark, sf):
    return _bm25(spark, sf, 5).select("item_id", "doc_id", "score", "rank")


_DENSE = """with v as (select vec_id, label, list_transform(embedding, lambda x: x::double) e from embeddings), u as (select vec_id, label, list_transform(e, lambda x: x / sqrt(list_sum(list_transform(e, lambda y: y * y)))) e from v),
 s as (select q.vec_id query_id, d.vec_id, d.label, q.label ql, round_even(list_sum(list_transform(range(1, 65), lambda i: q.e[i] * d.e[i])), 6) score from u q join u d on q.vec_id <> d.vec_id where q.vec_id % 100 = 0),
 r as (select *, row_number() over (partition by query_id order by score desc, vec_id) k from s)
"""


def _dense(spark, sf, k, labels=None):
    vectors = table(spark, sf, "embeddings")
    queries = vectors.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    pool = vectors if labels is None else vectors.where(F.col("label").isin(labels))
    return retrieval.dense(pool, "vec_id", "embedding", queries, "query_id", k)


@query(_DENSE + "select query_id, vec_id, score, k::integer rank from r where k <= 10")
def q_dense_topk(spark, sf):
    return _dense(spark, sf, 10).select("query_id", "vec_id", "score", "rank")


@query("select event_id, event_type from events where event_type in ('error', 'purchase') and json_extract_string(props, '$.k') in ('1', '2', '3')")
def q_metadata_filter(spark, sf):
    events = table(spark, sf, "events")
    return events.where(retrieval.matches({"event_type": ["error", "purchase"], "$.k": [1, 2, 3]}, metadata="props")).select("event_id", "event_type")


def _relevant(spark, sf):
    vectors = table(spark, sf, "embeddings").select("vec_id", "label")
    asked = vectors.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "label")
    return asked.join(vectors, "label").where("query_id <> vec_id").select("query_id", "vec_id", (1 + F.col("vec_id") % 2).cast("int").alias("grade"))


_IR = _DENSE + """, g as (select q.vec_id query_id, d.vec_id, 1 + d.vec_id % 2 grade from embeddings q join embeddings d on q.label = d.label and q.vec_id <> d.vec_id where q.vec_id % 100 = 0),
 h as (select query_id, count(*) f, min(k) first, sum((pow(2, grade) - 1) / log2(k + 1)) dcg from r join g using (query_id, vec_id) where k <= 10 group by 1),
 i as (select query_id, count(*) relevant, sum((pow(2, grade) - 1) / log2(p + 1)) filter (p <= 10) best from (select *, row_number() over (partition by query_id order by grade desc, vec_id) p from g) group by 1),
 m as (select query_id, relevant, coalesce(round_even(f / relevant::double, 6), 0) recall, coalesce(round_even(1.0::double / first, 6), 0) mrr, coalesce(round_even(dcg / best, 6), 0) ndcg from i left join h using (query_id))
"""


def _ir(spark, sf):
    return retrieval.ir_metrics(_dense(spark, sf, 10), _relevant(spark, sf), "query_id", "vec_id", 10)


@query(_IR + "select query_id, relevant, recall, mrr, ndcg from m")
def q_ir_metrics(spark, sf):
    return _ir(spark, sf)


@query(_IR + """, b as (select unnest([case when query_id % 200 = 0 then 'even' else 'odd' end, 'all']) bucket, recall, mrr from m) select bucket, count(*) queries, round_even(avg(recall), 9) recall, round_even(avg(mrr), 9) mrr from b group by 1""")
def q_bucket_metrics(spark, sf):
    buckets = F.array(F.when(F.col("query_id") % 200 == 0, "even").otherwise("odd"), F.lit("all"))
    return retrieval.bucket_means(_ir(spark, sf), buckets, ["recall", "mrr"], places=9)


@query(_DENSE + """, g as (select query_id, vec_id from s where label = ql),
 f as (select *, row_number() over (partition by query_id order by score desc, vec_id) kf from s where label < 8), ff as (select * from f where kf <= 60),
 e as (select g.query_id, g.vec_id, ff.kf, ff.kf is not null seen, r.k <= 25 wide from g left join ff using (query_id, vec_id) left join r using (query_id, vec_id)),
 o as (select query_id, count(*) targets, count(*) filter (kf <= 5) found, count(*) filter (not wide) lost, count(*) filter (wide and not seen) cut from e group by 1)
 select query_id, targets, found, case when found = targets then null when lost > 0 then 'retrieval' when cut > 0 then 'filtering' else 'ranking' end cause from o""")
def q_failure_diagnosis(spark, sf):
    target = _relevant(spark, sf)
    return retrieval.diagnose(_dense(spark, sf, 60, list(range(8))), _dense(spark, sf, 25), target, "query_id", "vec_id", 5)


_JUDGED = "with j as (select doc_id query_id, doc_id % 7 target, 'a' reviewer, quality label, toxic > 0 must from labels union all select doc_id, doc_id % 7, 'b', case when toxic = 1 then 0 else quality end, false from labels where doc_id % 3 <> 0)"


@query(_JUDGED + """, g as (select query_id, target, count(distinct reviewer) r, count(distinct label) l, count(distinct must) m, min(label) label from j group by 1, 2),
 c as (select *, case when r < 2 then 'missing_judgment' when l > 1 then 'relevance_label_conflict' when m > 1 then 'must_appear_conflict' end conflict from g) select query_id, target, conflict, case when conflict is null then label end as label from c""")
def q_adjudication(spark, sf):
    labels = table(spark, sf, "labels")
    base = [F.col("doc_id").alias("query_id"), (F.col("doc_id") % 7).alias("target")]
    a = labels.select(*base, F.lit("a").alias("reviewer"), F.col("quality").alias("label"), (F.col("toxic") > 0).alias("must_appear"))
    b = labels.where("doc_id % 3 <> 0").select(*base, F.lit("b").alias("reviewer"), F.when(F.col("toxic") == 1, 0).otherwise(F.col("quality")).alias("label"), F.lit(False).alias("must_appear"))
    return retrieval.adjudicate(a.unionByName(b), 2)


@query(_BM25.format(where="") + """, x as (select r.item_id, r.doc_id, d.lang, d.source from r join documents d using (doc_id) where k <= 10)
 select item_id, doc_id, case when lang <> 'en' then 'wrong_language' when source in ('src0', 'src1', 'src2') then 'wrong_source' end kind from x where lang <> 'en' or source in ('src0', 'src1', 'src2')""")
def q_hard_negatives(spark, sf):
    found = _bm25(spark, sf, 10).join(table(spark, sf, "documents").select("doc_id", "lang", "source"), "doc_id")
    kinds = [("wrong_language", F.col("lang") != "en"), ("wrong_source", F.col("source").isin("src0", "src1", "src2"))]
    return retrieval.hard_negatives(found, "item_id", "doc_id", kinds).select("item_id", "doc_id", "kind")


@query("""with t as (select doc_id from documents where lang = 'en'), j as (select doc_id from labels union all select doc_id from labels where toxic = 1)
 select distinct doc_id, 'dangling_target' problem from j where doc_id not in (select doc_id from t) union all select doc_id, 'duplicate_judgment' from j group by 1 having count(*) > 1""")
def q_judgment_validation(spark, sf):
    labels = table(spark, sf, "labels")
    judged = labels.select("doc_id").unionByName(labels.where("toxic = 1").select("doc_id"))
    return retrieval.judgment_problems(judged, table(spark, sf, "documents").where("lang = 'en'"), "doc_id")


@query("""select user_id, count(*) as rows, count(*) filter (event_type = 'error') errors, max(case when event_type = 'error' then 'label' when event_type = 'purchase' and value > 50 then 'citation' else 'retrieval' end) last_bucket from events group by 1""")
def q_failure_triage(spark, sf):
    flags = {"label_problem": F.col("event_type") == "error", "lost_by_rerank": F.lit(False), "filtered_out": F.lit(False), "uncited": (F.col("event_type") == "purchase") & (F.col("value") > 50), "ambiguous": F.lit(False)}
    out = retrieval.triage(table(spark, sf, "events").withColumns(flags))
    return out.groupBy("user_id").agg(F.count("*").alias("rows"), F.count_if(F.col("event_type") == "error").alias("errors"), F.max("bucket").alias("last_bucket"))


_SUBJECTS = _GRADED + """, a as (select p_partkey, list_filter([case when p_type like '%BRASS%' then 'brass' end, case when p_size > 30 then 'large' end, case when p_retailprice < 1000 then 'cheap' end], lambda x: x is not null) c0, case when p_size > 48 then 'hold' when confidence is null or grade in ('MISSING', 'D', 'F') then 'caution' else 'ready' end readiness, p_size from h),
 sj as (select *, case when len(c0) > 0 then c0 else ['standard'] end codes from a)
"""


def _subjects(spark, sf):
    rows = _graded(spark, sf)
    named = [("brass", F.col("p_type").contains("BRASS"), F.lit(0.9)), ("large", F.col("p_size") > 30, F.lit(0.8)), ("cheap", F.col("p_retailprice") < 1000, F.lit(0.6))]
    ready = rules.readiness((F.col("p_size") > 48).cast("int"), F.when(F.col("confidence").isNotNull(), 1).otherwise(0), F.col("grade"))
    return rules.archetypes(rows.withColumn("readiness", ready), named, ("standard", 0.5))


@query(_SUBJECTS + "select p_partkey, readiness, array_to_string(codes, '|') codes from sj")
def q_archetypes(spark, sf):
    return _subjects(spark, sf).select("p_partkey", "readiness", F.array_join("archetypes.code", "|").alias("codes"))


_RULES = [("brass", "polish", 1, "caution"), ("brass", "inspect", 2, "hold"), ("large", "inspect", 1, "hold"), ("large", "crate", 2, "ready"), ("cheap", "bundle", 1, "caution"), ("standard", "stock", 1, "hold")]


@query(_SUBJECTS + ", ru(code, rule, place, least) as (values " + ", ".join(f"('{a}', '{r}', {o}, {rules.READINESS.index(m) + 1})" for a, r, o, m in _RULES) + """),
 ex as (select p_partkey, case readiness when 'hold' then 1 when 'caution' then 2 else 3 end lvl, unnest(codes) code, generate_subscripts(codes, 1) nth from sj),
 ch as (select p_partkey, rule, min(nth * 100 + place) pos from ex join ru using (code) where lvl >= least group by 1, 2 union all select p_partkey, 'foundation', -1 from sj where readiness = 'hold')
 select p_partkey, rule, row_number() over (partition by p_partkey order by pos, rule)::integer priority from ch""")
def q_rule_stack(spark, sf):
    return rules.stack(_subjects(spark, sf), "p_partkey", _RULES)


@query(_DECISIONS + ", x as (select p_brand, status from s), y as (select p_brand, status from s where p_partkey % 50 <> 0) select p_brand, status, a.n left_rows, coalesce(b.n, 0) right_rows from (select p_brand, status, count(*) n from x group by 1, 2) a left join (select p_brand, status, count(*) n from y group by 1, 2) b using (p_brand, status) where a.n <> coalesce(b.n, 0)")
def q_decision_consistency(spark, sf):
    d = _decisions(spark, sf)
    return rules.differences(d, d.where("p_partkey % 50 <> 0"), ["p_brand", "status"])


@query("select l_returnflag, count(*) as rows from lineitem group by 1 order by 2 desc, 1 limit 2")
def q_top_counts(spark, sf):
    return rules.top_counts(table(spark, sf, "lineitem"), "l_returnflag", 2)


@query("""select doc_id, regexp_replace(lower(lang || ' ' || source), '[^a-z0-9]+', '-', 'g') slug, case when n_chars / 5000.0 >= 0.9 then 'high' when n_chars / 5000.0 >= 0.75 then 'medium' else 'low' end tier,
 case when n_chars / 5000.0 >= 0.9 then 'A' when n_chars / 5000.0 >= 0.75 then 'B' when n_chars / 5000.0 >= 0.6 then 'C' when n_chars / 5000.0 >= 0.4 then 'D' else 'F' end grade from documents""")
def q_scalar_ladders(spark, sf):
    score = F.col("n_chars") / 5000.0
    return table(spark, sf, "documents").select("doc_id", exprs.slug(F.concat_ws(" ", "lang", "source")).alias("slug"), exprs.confidence_tier(score).alias("tier"), exprs.confidence_grade(score).alias("grade"))
