"""Intake, provenance, pack and release queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.operators import packs
from ledgerlens.plans.base import query, table
from ledgerlens.plans.reconcile_plans import _DECISIONS, _decisions


def _intake(spark, sf):
    k = F.col("s_suppkey")
    return table(spark, sf, "supplier").select(
        "s_suppkey", F.when(k % 10 == 0, " ").otherwise(F.col("s_name")).alias("brand_name"), F.lit("ranking").alias("source_type"), F.col("s_name").alias("source_name"), F.lit("u").alias("source_url_or_doc_id"),
        F.when(k % 4 == 0, "2024-13-01").otherwise("2024-01-01").alias("as_of_date"), F.when(k % 7 == 0, "guessed").otherwise("reported").alias("method_reported_or_estimated"),
        F.when(k % 6 == 0, "1.5").when(k % 5 == 0, "").otherwise("0.9").alias("confidence_score"), F.when(k % 3 == 0, "n/a").when(k % 3 == 1, "").otherwise(F.col("s_acctbal").cast("string")).alias("store_count"),
    )


@query("""select s_suppkey, unnest(list_filter([case when s_suppkey % 10 = 0 then 'error|missing_brand' end, case when s_suppkey % 5 = 0 and s_suppkey % 6 <> 0 then 'warning|missing_provenance' end, case when s_suppkey % 7 = 0 then 'error|unknown_method' end,
 case when s_suppkey % 6 = 0 then 'error|bad_confidence' end, case when s_suppkey % 4 = 0 then 'error|bad_date' end, case when s_suppkey % 3 = 1 then 'warning|no_metrics' end, case when s_suppkey % 3 = 0 then 'error|bad_number_store_count' end], lambda x: x is not null)) finding from supplier""")
def q_intake_validation(spark, sf):
    return packs.intake_findings(_intake(spark, sf), ["s_suppkey"], ["store_count"]).select("s_suppkey", F.concat_ws("|", "severity", "check_name").alias("finding"))


@query("select s_suppkey, case when s_suppkey % 4 = 0 then null else date '2024-01-01' end as_of_date, case when s_suppkey % 6 = 0 then 1.0::double when s_suppkey % 5 = 0 then null else 0.9::double end confidence_score, s_name source_name from supplier")
def q_provenance_normalise(spark, sf):
    df = _intake(spark, sf).withColumnsRenamed({"source_name": "name", "as_of_date": "effective_date", "method_reported_or_estimated": "basis"})
    out = packs.normalise_provenance(df)
    return out.select(F.get_json_object("extra", "$.s_suppkey").cast("long").alias("s_suppkey"), "as_of_date", "confidence_score", "source_name")


def _pack(spark, sf):
    q = table(spark, sf, "conversations").where("role = 'user'").select(F.concat_ws("-", F.lit("c"), "conv_id", F.col("turn") % 3).alias("query_id"), F.col("text").alias("query_text"), (F.col("turn") % 2).cast("string").alias("intent"))
    j = table(spark, sf, "labels").select(F.concat_ws("-", F.lit("c"), F.col("doc_id") % 300, F.lit(0)).alias("query_id"), (F.col("doc_id") % 2).cast("string").alias("target"), F.when(F.col("quality") == 1, "relevant").when(F.col("toxic") == 1, "odd").otherwise("not_relevant").alias("label"))
    return q, j


_PACK = """with q as (select 'c-' || conv_id || '-' || (turn % 3) query_id, text query_text, (turn % 2)::varchar intent from conversations where role = 'user'),
 j as (select 'c-' || (doc_id % 300) || '-0' query_id, (doc_id % 2)::varchar target, case when quality = 1 then 'relevant' when toxic = 1 then 'odd' else 'not_relevant' end as label from labels)
"""


@query(_PACK + """, k as (select *, nullif(lower(trim(query_text)), '') t from q), mx as (select t from k where t is not null group by 1 having count(distinct intent) > 1), pr as (select query_id, target, count(*) n, count(distinct label) l from j group by 1, 2)
 select query_id, 'duplicate_query_id' check_name from q group by 1 having count(*) > 1 union all select distinct query_id, 'missing_query_text' from k where t is null union all select distinct query_id, 'conflicting_intent' from k where t in (select t from mx)
 union all select distinct query_id, 'judgment_without_query' from j where query_id not in (select query_id from q) union all select distinct query_id, 'unknown_label' from j where label = 'odd'
 union all select distinct query_id, 'contradictory_judgment' from pr where l > 1 union all select distinct query_id, 'repeated_judgment' from pr where n > 1 and l = 1""")
def q_pack_validation(spark, sf):
    return packs.pack_findings(*_pack(spark, sf))


@query(_PACK + """, b as (select query_id, target, max(case label when 'relevant' then 1 when 'not_relevant' then 0 end) g from j where label <> 'odd' group by 1, 2)
 select q.query_id, coalesce(string_agg(distinct target || ':' || g, '|' order by target || ':' || g), '') grades from (select distinct query_id from q) q left join b using (query_id) group by 1""")
def q_query_specs(spark, sf):
    q, j = _pack(spark, sf)
    out = packs.query_specs(q.groupBy("query_id").agg(F.min("query_text").alias("query_text")), j)
    return out.select("query_id", F.array_join(F.array_sort(F.transform(F.map_entries("grades"), lambda e: F.concat_ws(":", e["key"], e["value"]))), "|").alias("grades"))


@query("""with p as (select *, row_number() over (partition by n_name order by s) k from (select distinct n_name, c_mktsegment s from customer join nation on c_nationkey = n_nationkey)),
 t as (select 'value' kind, 'What is the ' || s || ' of ' || n_name || '?' query_text, n_name from p where k <= 3 union select 'status', 'Is ' || n_name || ' publishable?', n_name from p where k <= 3),
 i as (select *, trim(regexp_replace(lower(kind || ' ' || n_name), '[^a-z0-9]+', '-', 'g'), '-') id, row_number() over (partition by kind, n_name order by query_text) n from t)
 select case when n = 1 then id else id || '-' || n end query_id, query_text, kind from i""")
def q_seed_queries(spark, sf):
    rows = table(spark, sf, "customer").join(F.broadcast(table(spark, sf, "nation")), F.col("c_nationkey") == F.col("n_nationkey")).select("n_name", "c_mktsegment")
    return packs.seed_queries(rows, "n_name", "c_mktsegment", {"value": "What is the {metric} of {entity}?", "status": "Is {entity} publishable?"})


@query("""with a as (select distinct c_nationkey n, c_mktsegment m from customer) select a.n left_key, b.n right_key, min(a.m) metric from a join a b on a.m = b.m and a.n < b.n group by 1, 2 order by 1, 2 limit 24""")
def q_entity_pairs(spark, sf):
    out = packs.entity_pairs(table(spark, sf, "customer"), "c_nationkey", "c_mktsegment")
    return out.select(F.col("c_nationkey").alias("left_key"), F.col("other").alias("right_key"), "metric")


@query("""select dimension, value, count(*) queries, count(*) < 60 under_covered from (select 'lang' dimension, coalesce(lang, 'none') value from documents union all select 'source', coalesce(source, 'none') from documents) group by 1, 2""")
def q_authoring_coverage(spark, sf):
    return packs.coverage_by(table(spark, sf, "documents"), ["lang", "source"], least=60)


@query(_DECISIONS + ", kp as (select p_partkey, metric, status from s where status = 'publishable' and p_partkey % 100 <> 0), x as (select count(*) n from s where status = 'publishable' and p_partkey % 100 = 0) select 'publishable_matches' check_name, n problems from x union all select 'blocked_matches', 0 union all select 'decision_keys_unique', 0")
def q_release_preflight(spark, sf):
    d = _decisions(spark, sf)
    return packs.preflight(d, d.where("status = 'publishable' and p_partkey % 100 <> 0"), d.where("status = 'blocked'"), ["p_partkey", "metric"])
