"""Reconciliation, gate and credibility queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens.functions import exprs
from ledgerlens.operators import gate, reconcile
from ledgerlens.plans.base import query, table

_FLAGS = {"N": 0, "A": 1}
#: Evidence: each line's unit price is a claim about its part; return flags are the kinds of source.
_EVIDENCE = """with e as (select l_partkey, round_even(l_extendedprice / l_quantity, 6) v, l_returnflag t, l_discount c, cast(l_shipdate as date) d, 'supplier ' || l_suppkey n from lineitem),
 r as (select *, row_number() over (partition by l_partkey order by case t when 'N' then 0 when 'A' then 1 else 101 end, coalesce(c, 0) desc, d desc, n, v) k from e),
 b as (select l_partkey, v reference_value, t source_type, c confidence, n source_name from r where k = 1)
"""


def _evidence(spark, sf):
    lines = table(spark, sf, "lineitem")
    return lines.select("l_partkey", F.bround(F.col("l_extendedprice") / F.col("l_quantity"), 6).alias("value"), F.col("l_returnflag").alias("source_type"), F.col("l_discount").alias("confidence"), F.col("l_shipdate").cast("date").alias("as_of_date"), F.concat(F.lit("supplier "), "l_suppkey").alias("source_name"))


def _best(spark, sf):
    return reconcile.best_evidence(_evidence(spark, sf), ["l_partkey"], _FLAGS)


@query(_EVIDENCE + "select l_partkey, round_even(reference_value, 4) reference_value, source_type, confidence, source_name from b")
def q_best_reference(spark, sf):
    return _best(spark, sf).select("l_partkey", F.bround("value", 4).alias("reference_value"), "source_type", "confidence", "source_name")


def _graded(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", "p_brand", "p_type", "p_retailprice", "p_size")
    best = _best(spark, sf).select("l_partkey", F.col("value").alias("reference_value"), "source_type", "source_name", "confidence")
    return reconcile.compare_numeric(parts.join(best, F.col("p_partkey") == F.col("l_partkey"), "left"), F.col("p_retailprice"), F.col("reference_value"))


_GRADED = _EVIDENCE + """, g as (select p.*, b.*, abs(p_retailprice - reference_value) / abs(reference_value) rel from part p left join b on p_partkey = l_partkey),
 h as (select *, case when rel is null then 'MISSING' when rel <= 0.02 then 'A' when rel <= 0.05 then 'B' when rel <= 0.1 then 'C' when rel <= 0.2 then 'D' else 'F' end grade from g)
"""


@query(_GRADED + "select p_partkey, round_even(abs(p_retailprice - reference_value), 4) absolute_error, round_even(rel, 6) relative_error, grade from h")
def q_reconcile_grades(spark, sf):
    return _graded(spark, sf).select("p_partkey", F.bround("absolute_error", 4).alias("absolute_error"), F.bround("relative_error", 6).alias("relative_error"), "grade")


@query(_GRADED + """, w as (select p_brand, max(case grade when 'A' then 1 when 'B' then 2 when 'C' then 3 when 'D' then 4 when 'F' then 5 else 0 end) w, count(*) filter (grade = 'A') a, count(*) filter (grade = 'MISSING') missing from h group by 1)
 select p_brand, case w when 0 then 'MISSING' else substr('ABCDF', w, 1) end overall_grade, a, missing from w""")
def q_overall_grade(spark, sf):
    place = F.array_position(F.array(*map(F.lit, exprs.GRADE_ORDER)), F.col("grade"))
    out = _graded(spark, sf).groupBy("p_brand").agg(F.max(F.struct(place.alias("place"), "grade")).alias("w"), F.count_if(F.col("grade") == "A").alias("a"), F.count_if(F.col("grade") == "MISSING").alias("missing"))
    return out.select("p_brand", F.when(F.col("w.place") > 0, F.col("w.grade")).otherwise("MISSING").alias("overall_grade"), "a", "missing")


@query("""with r as (select n_name, sum(o_totalprice) v, count(*) o from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by 1),
 k as (select n_name, row_number() over (order by round_even(v, 2) desc, n_name) a, row_number() over (order by o desc, n_name) b from r)
 select n_name, a::integer revenue_rank, b::integer order_rank, abs(a - b)::bigint rank_difference, case abs(a - b) when 0 then 'A' when 1 then 'B' when 2 then 'C' when 3 then 'C' when 4 then 'D' when 5 then 'D' else 'F' end grade from k""")
def q_rank_compare(spark, sf):
    buyers = table(spark, sf, "customer").join(F.broadcast(table(spark, sf, "nation")), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")
    spent = table(spark, sf, "orders").groupBy("o_custkey").agg(F.sum("o_totalprice").alias("v"), F.count("*").alias("o"))
    totals = spent.join(buyers, F.col("o_custkey") == F.col("c_custkey")).groupBy("n_name").agg(F.sum("v").alias("v"), F.sum("o").alias("o"))
    ranked = totals.select("n_name", F.row_number().over(Window.orderBy(F.desc(F.bround("v", 2)), "n_name")).alias("revenue_rank"), F.row_number().over(Window.orderBy(F.desc("o"), "n_name")).alias("order_rank"))
    return reconcile.compare_rank(ranked, F.col("revenue_rank"), F.col("order_rank"))


@query("""with g as (select distinct c_nationkey, c_mktsegment from customer), h as (select distinct c_nationkey, c_mktsegment, 1 y from customer join orders on o_custkey = c_custkey where o_totalprice > 490000),
 x as (select g.*, y from g left join h using (c_nationkey, c_mktsegment)),
 u as (select 'row' coverage_kind, c_nationkey::varchar coverage_key, count(y) covered, count(*) possible, coalesce(string_agg(case when y is null then c_mktsegment end, '|' order by c_mktsegment), '') missing from x group by 2 union all
 select 'column', c_mktsegment, count(y), count(*), '' from x group by 2 union all select 'all', 'all', count(y), count(*), '' from x)
 select coverage_kind, coverage_key, covered, possible, round_even(covered / possible::double, 6) coverage_rate, missing from u""")
def q_coverage_audit(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    large = table(spark, sf, "orders").where("o_totalprice > 490000").select("o_custkey").distinct()
    covered = customers.join(large, F.col("c_custkey") == F.col("o_custkey"), "left_semi")
    return reconcile.coverage(customers, covered, "c_nationkey", "c_mktsegment").withColumn("coverage_rate", F.bround("coverage_rate", 6))


@query("""select source, count(*) as rows, round_even(sum((trim(text) <> '' and lower(trim(text)) <> 'nan')::integer + (nullif(lang, 'en') is not null)::integer + (trim(source) <> '')::integer) / (count(*) * 3.0::double), 6) completeness,
 round_even(avg(least(1.0, n_chars / 5000.0::double)), 6) mean_confidence, round_even(min(least(1.0, n_chars / 5000.0::double)), 6) min_confidence, round_even(max(least(1.0, n_chars / 5000.0::double)), 6) max_confidence from documents group by 1""")
def q_provenance_quality(spark, sf):
    docs = table(spark, sf, "documents").select("source", "text", F.nullif("lang", F.lit("en")).alias("lang"), "n_chars").withColumn("origin", F.col("source"))
    out = reconcile.provenance_quality(docs, ["source"], ["text", "lang", "origin"], F.least(F.lit(1.0), F.col("n_chars") / 5000.0))
    return out.select("source", "rows", *[F.bround(c, 6).alias(c) for c in ("completeness", "mean_confidence", "min_confidence", "max_confidence")])


@query("""with g as (select l_partkey, min(case l_returnflag when 'R' then 0 when 'A' then 1 else 2 end) filter (l_discount >= 0.06) b, bool_or(l_returnflag = 'R' and l_discount >= 0.06) ok, bool_or(l_returnflag = 'R' and l_discount < 0.06) off from lineitem group by 1)
 select l_partkey, case b when 0 then 'R' when 1 then 'A' when 2 then 'N' end best_source, case when b is null then 'missing' when b = 0 then 'primary' else 'secondary' end tier,
 case when b = 0 then 'used' when ok then 'available' when off then 'scope_mismatch' else 'none' end primary_status from g""")
def q_source_tier(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_partkey", F.col("l_returnflag").alias("source_type"), "l_discount")
    return reconcile.source_tier(lines, ["l_partkey"], {"R": 0, "A": 1, "N": 2}, ["R"], F.col("l_discount") >= 0.06)


@query(_GRADED + ", k as (select *, row_number() over (partition by p_brand order by round_even(rel, 9) desc nulls last, p_partkey) n from h) select p_brand, p_partkey, round_even(rel, 6) relative_error, grade from k where n = 1")
def q_worst_delta(spark, sf):
    out = reconcile.worst_by(_graded(spark, sf).withColumn("_e", F.bround("relative_error", 9)), "p_brand", "_e", "p_partkey")
    return out.select("p_brand", "p_partkey", F.bround("relative_error", 6).alias("relative_error"), "grade")


@query(_GRADED + "select p_brand, p_partkey, round_even(rel, 6) relative_error from h where rel > 0.05 order by round_even(rel, 9) desc, p_brand, p_partkey limit 10")
def q_contradictions(spark, sf):
    out = _graded(spark, sf).withColumn("relative_error", F.bround("relative_error", 9))
    return reconcile.contradictions(out, ["p_brand", "p_partkey"]).select("p_brand", "p_partkey", F.bround("relative_error", 6).alias("relative_error"))


POLICY = gate.Policy("1.0.0", (gate.MetricPolicy("price", min_confidence=0.03, grades=("A", "B", "C"), max_error=0.15, publishable_methods=("STANDARD", "PROMO")), gate.MetricPolicy("size", needs_evidence=False, min_confidence=0.0, grades=("MISSING", "A", "B", "C", "D", "F"), max_error=9e9, advisory_only=True)))


def _decisions(spark, sf):
    graded = _graded(spark, sf)
    common = [F.col("p_partkey"), F.col("p_brand")]
    shared = [F.split("p_type", " ")[0].alias("method"), (F.col("p_size") > 48).alias("hard_fail"), (F.col("p_size") < 4).alias("finding"), F.lit(False).alias("provenance_missing")]
    price = graded.select(*common, F.lit("price").alias("metric"), F.col("p_retailprice").alias("value"), "reference_value", "source_name", "confidence", "grade", "relative_error", *shared)
    size = graded.select(*common, F.lit("size").alias("metric"), F.nullif("p_size", F.lit(7)).cast("double").alias("value"), F.lit(None).cast("double").alias("reference_value"), F.lit(None).cast("string").alias("source_name"), F.lit(None).cast("double").alias("confidence"), F.lit("MISSING").alias("grade"), F.lit(None).cast("double").alias("relative_error"), *shared)
    return gate.decide(price.unionByName(size), POLICY)


_DECISIONS = _GRADED + """, c as (select p_partkey, p_brand, 'price' metric, p_retailprice is null novalue, reference_value is not null and coalesce(trim(source_name), '') <> '' e, true needs, confidence, 0.03 minc, grade in ('A', 'B', 'C') okgrade, rel, 0.15 maxe, split_part(p_type, ' ', 1) in ('STANDARD', 'PROMO') okm, p_size, false adv, grade, source_name from h
 union all select p_partkey, p_brand, 'size', p_size = 7, false, false, null, 0, true, null, 9e9, false, p_size, true, 'MISSING', null from h),
 d as (select *, concat_ws('|', case when novalue then 'value missing' end, case when needs and not e then 'evidence missing' end, case when p_size > 48 then 'hard-fail finding' end, case when e and (confidence is null or confidence < minc) then 'confidence too low' end, case when e and not okgrade then 'grade not allowed' end, case when e and rel > maxe then 'error too large' end) blocking,
 concat_ws('|', case when e and not okm then 'method not publishable' end, case when p_size < 4 then 'advisory finding' end, case when adv then 'advisory metric' end) warnings from c),
 s as (select *, case when blocking <> '' then 'blocked' when warnings <> '' then 'advisory' else 'publishable' end status from d)
"""


@query(_DECISIONS + "select p_partkey, metric, status, blocking, warnings from s")
def q_gate_decisions(spark, sf):
    return _decisions(spark, sf).select("p_partkey", "metric", "status", F.array_join("blocking", "|").alias("blocking"), F.array_join("warnings", "|").alias("warnings"))


@query(_DECISIONS + "select p_brand, metric, count(*) as rows, count(*) filter (status = 'publishable') publishable, count(*) filter (status = 'advisory') advisory, count(*) filter (status = 'blocked') blocked from s group by grouping sets ((p_brand), (metric), ())")
def q_gate_summary(spark, sf):
    return gate.summary(_decisions(spark, sf), ["p_brand", "metric"])


@query(_DECISIONS + "select unnest(string_split(blocking, '|')) reason, count(*) as rows from s where blocking <> '' group by 1")
def q_gate_reasons(spark, sf):
    return gate.reasons(_decisions(spark, sf), "blocking")


@query(_DECISIONS + """, rc as (select p_partkey, count(*) filter (status = 'publishable') publishable, count(*) filter (status = 'advisory') advisory, count(*) filter (status = 'blocked') blocked from s group by 1)
 select *, case when (blocked > 0 and publishable > 0) or (advisory > 0 and publishable > 0) then 'publishable_subset_only' when blocked > 0 then 'blocked_for_external_use' when advisory > 0 then 'advisory_only' else 'publishable' end recommendation from rc""")
def q_brand_recommendation(spark, sf):
    return gate.recommendation(_decisions(spark, sf), "p_partkey")


@query(_DECISIONS + """, i as (select *, case when metric = 'size' and p_size > 40 then null when p_size > 48 then 'failed' when p_size < 4 then 'warning' else 'passed' end iv, (p_size * 2)::double sig, 6 - p_size % 3 filled, 1 + p_size % 4 srcs from s),
 p as (select *, coalesce(iv, 'unknown') inv, least(100.0, greatest(0.0, round_even(coalesce(confidence, 0) * 45 + filled / 6.0::double * 35 + case when e then least(3, srcs) / 3.0::double * 20 else 0 end, 0))) prov,
 case when metric = 'size' then 55.0 when not e then 20.0 else least(100.0, greatest(0.0, case grade when 'A' then 100 when 'B' then 85 when 'C' then 65 when 'D' then 40 when 'F' then 15 else 20 end - least(25.0, round_even(coalesce(rel, 0) * 200, 0)))) end rec from i),
 q as (select *, least(100.0, greatest(0.0, round_even(0.4::double * prov + 0.35::double * rec + 0.25::double * (100 - sig) - case inv when 'passed' then 0 when 'warning' then 15 when 'failed' then 35 else 5 end, 0))) sc from p)
 select p_partkey, metric, inv invariant, prov::double provenance, rec::double reconciliation, sc::double score, status <> 'publishable' or inv <> 'passed' or sig >= 35 or prov < 70 or rec < 70 or sc < 65 review from q""")
def q_credibility(spark, sf):
    d = _decisions(spark, sf).join(table(spark, sf, "part").select(F.col("p_partkey").alias("k"), "p_size"), F.col("p_partkey") == F.col("k"))
    size, signal = F.col("p_size"), (F.col("p_size") * 2).cast("double")
    unknown = (F.col("metric") == "size") & (size > 40)
    severities = F.when(unknown, F.lit(None)).when(size > 48, F.array(F.lit("error"))).when(size < 4, F.array(F.lit("info"))).otherwise(F.array().cast("array<string>"))
    d = d.withColumn("invariant", gate.invariant_status(severities))
    d = d.withColumn("provenance", gate.provenance_score(F.col("confidence"), 6 - size % 3, 1 + size % 4, F.col("evidence")))
    d = d.withColumn("reconciliation", gate.reconciliation_score(F.col("grade"), F.col("relative_error"), F.col("evidence"), F.col("metric") != "size"))
    d = d.withColumn("score", gate.credibility(F.col("provenance"), F.col("reconciliation"), signal, F.col("invariant")))
    review = gate.needs_review(F.col("status"), F.col("invariant"), signal >= 35, F.col("provenance"), F.col("reconciliation"), F.col("score"))
    return d.select("p_partkey", "metric", "invariant", "provenance", "reconciliation", "score", review.alias("review"))
