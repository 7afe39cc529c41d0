"""Queries of the lookups, scorecards, rollups and operating models."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.operators import lookups, rules, scorecards
from ledgerlens.plans.base import query, table
from ledgerlens.plans.reconcile_plans import _DECISIONS, _GRADED, _decisions, _graded
from ledgerlens.sources import normalise

#: Each line is a finding about its supplier.
_FIND = """with f as (select l_suppkey subject, case l_returnflag when 'R' then 'error' when 'A' then 'warning' else 'info' end severity, case l_linestatus when 'F' then 'implied_auv_k' else 'fte_range_order.row' end check_name,
 case l_linenumber % 3 when 0 then 'rank' when 1 then 'us_store_count_2024' else 'other' end field_name, l_linestatus category, l_returnflag || l_linestatus || (l_linenumber % 5) message, l_orderkey * 10 + l_linenumber ordinal from lineitem)
"""


def _findings(spark, sf):
    lines = table(spark, sf, "lineitem")
    severity = F.when(F.col("l_returnflag") == "R", "error").when(F.col("l_returnflag") == "A", "warning").otherwise("info")
    field = F.when(F.col("l_linenumber") % 3 == 0, "rank").when(F.col("l_linenumber") % 3 == 1, "us_store_count_2024").otherwise("other")
    check = F.when(F.col("l_linestatus") == "F", "implied_auv_k").otherwise("fte_range_order.row")
    message = F.concat("l_returnflag", "l_linestatus", (F.col("l_linenumber") % 5).cast("string"))
    return lines.select(F.col("l_suppkey").alias("subject"), severity.alias("severity"), check.alias("check_name"), field.alias("field_name"), F.col("l_linestatus").alias("category"), message.alias("message"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ordinal"))


@query(_FIND + ", g as (select subject, message, min(ordinal) o from f group by 1, 2) select subject, count(*)::integer n, string_agg(message, '|' order by o, message) messages from g group by 1")
def q_findings_by_subject(spark, sf):
    out = lookups.findings_by_subject(_findings(spark, sf), "subject", "message", ["ordinal"])
    return out.select("subject", F.size("findings").alias("n"), F.array_join(F.transform("findings", lambda x: x["message"]), "|").alias("messages"))


@query(_FIND + """, m as (select subject, unnest(list_distinct(case check_name when 'implied_auv_k' then ['auv'] else ['fte_mid'] end || case field_name when 'rank' then ['rank'] when 'us_store_count_2024' then ['store_count'] else [] end)) metric from f)
 select subject, metric, count(*) findings from m group by 1, 2""")
def q_finding_metrics(spark, sf):
    out = lookups.finding_metrics(_findings(spark, sf), "check_name", "field_name")
    return out.groupBy("subject", "metric").agg(F.count("*").alias("findings"))


_SIGNALS = "with s as (select user_id subject, case json_extract_string(props, '$.k')::integer % 3 when 0 then 'auv' when 1 then 'rank' end metric, event_type strength, event_id || ' at ' || round_even(value, 2) note from events)"


def _signals(spark, sf):
    k = F.get_json_object("props", "$.k").cast("int") % 3
    note = F.concat(F.col("event_id").cast("string"), F.lit(" at "), F.bround("value", 2).cast("string"))
    return table(spark, sf, "events").select(F.col("user_id").alias("subject"), F.when(k == 0, "auv").when(k == 1, "rank").alias("metric"), F.col("event_type").alias("strength"), "event_id", note.alias("note"))


@query("with s as (select user_id subject, case json_extract_string(props, '$.k')::integer % 3 when 0 then 'auv' when 1 then 'rank' end metric, event_type strength, event_id::varchar note from events) select subject, metric, count(*)::integer n, string_agg(note, '|' order by note) notes from s where strength in ('error', 'purchase') and metric is not null group by 1, 2")
def q_signals_by_metric(spark, sf):
    rows = _signals(spark, sf).withColumn("note", F.col("event_id").cast("string"))
    out = lookups.signals_by_metric(rows, "subject", "metric", "note", ["error", "purchase"])
    return out.select("subject", "metric", F.size("signals").alias("n"), F.array_join("signals", "|").alias("notes"))


@query(_SIGNALS + """, c as (select distinct user_id subject, m metric from events, (values ('auv'), ('rank'), ('store_count')) v(m))
 select c.subject, c.metric, count(*) signals from c join s on s.subject = c.subject and (s.metric is null or s.metric = c.metric) group by 1, 2""")
def q_applicable_signals(spark, sf):
    users = table(spark, sf, "events").select(F.col("user_id").alias("subject")).distinct()
    claims = users.withColumn("metric", F.explode(F.array(*map(F.lit, ("auv", "rank", "store_count")))))
    out = lookups.applicable_signals(claims, _signals(spark, sf).select("subject", "metric", "event_id"), "subject", "metric")
    return out.groupBy("subject", "metric").agg(F.count("*").alias("signals"))


@query("""with e as (select l_partkey, case l_returnflag when 'R' then 'workbook' else l_returnflag end t, 'supplier ' || l_suppkey n, nullif(l_discount, 0.05) c, l_shipdate::date::varchar d, l_orderkey * 10 + l_linenumber k from lineitem),
 p as (select p_partkey, 'supplier ' || (p_partkey % 100 + 1) n, 'N' t from part), r as (select p.p_partkey, e.*, row_number() over (partition by p.p_partkey order by case when e.n = p.n and e.t = p.t then 2 when e.t = 'workbook' then 1 else 0 end desc, coalesce(c, -1) desc, d desc, e.n desc, k desc) place from p join e on p_partkey = l_partkey)
 select p_partkey, t source_type, n source_name, c confidence from r where place = 1""")
def q_provenance_pick(spark, sf):
    lines = table(spark, sf, "lineitem")
    kind = F.when(F.col("l_returnflag") == "R", "workbook").otherwise(F.col("l_returnflag"))
    rows = lines.select(F.col("l_partkey").alias("subject"), F.nullif("l_discount", F.lit(0.05)).alias("confidence"), F.col("l_shipdate").cast("date").cast("string").alias("as_of_date"), F.concat(F.lit("supplier "), F.col("l_suppkey").cast("string")).alias("source_name"), kind.alias("source_type"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("k"))
    claims = table(spark, sf, "part").select("p_partkey", F.col("p_partkey").alias("subject"), F.concat(F.lit("supplier "), (F.col("p_partkey") % 100 + 1).cast("string")).alias("source_name"), F.lit("N").alias("source_type"))
    out = lookups.pick_provenance(claims, rows, "p_partkey", "subject")
    return out.select("p_partkey", "provenance.source_type", "provenance.source_name", "provenance.confidence")


@query("""with l as (select o_custkey, o_orderstatus, o_totalprice, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) k from orders)
 select c_custkey, c_mktsegment, o_orderstatus last_status, o_totalprice last_price from customer left join l on c_custkey = o_custkey and k = 1 where c_mktsegment in ('BUILDING', 'MACHINERY')""")
def q_snapshot_coverage(spark, sf):
    snapshot = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", F.col("c_mktsegment").alias("status"))
    coverage = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderdate", "o_orderkey", "o_orderstatus", "o_totalprice")
    out = lookups.with_coverage(snapshot, coverage, "c_custkey", ["o_orderdate", "o_orderkey"], ["BUILDING", "MACHINERY"])
    return out.select("c_custkey", "c_mktsegment", F.col("o_orderstatus").alias("last_status"), F.col("o_totalprice").alias("last_price"))


@query("select s_suppkey, coalesce(r_name, 'supplier of ' || s_nationkey) canonical from supplier join nation on s_nationkey = n_nationkey left join region on n_regionkey = r_regionkey and n_nationkey % 2 = 0")
def q_alias_resolution(spark, sf):
    nations, regions = table(spark, sf, "nation"), table(spark, sf, "region")
    # the supplier's text is another spelling of the nation's; every second nation is an alias of its region
    aliases = nations.where("n_nationkey % 2 = 0").join(F.broadcast(regions), F.col("n_regionkey") == F.col("r_regionkey")).select(F.concat(F.lit("Supplier of "), F.col("n_nationkey").cast("string")).alias("alias"), "r_name")
    rows = table(spark, sf, "supplier").select("s_suppkey", F.concat(F.lit("supplier of "), F.col("s_nationkey").cast("string")).alias("name"))
    return lookups.resolved(F.col("name"), aliases, rows, "alias", "r_name", "canonical").select("s_suppkey", "canonical")


@query("select event_id, case when event_type = 'signup' then 'named ' || user_id when event_type = 'error' then 'user ' || user_id when event_type = 'click' then 'visitor' end subject from events")
def q_signal_subjects(spark, sf):
    user = F.col("user_id").cast("string")
    title = F.when(F.col("event_type") == "error", F.concat(F.lit("user "), user, F.lit(" stands out in errors"))).when(F.col("event_type") == "click", F.lit("visitor AUV is unusual")).otherwise(F.lit("no subject here"))
    details = F.when(F.col("event_type") == "signup", F.to_json(F.struct(F.concat(F.lit(" named "), user).alias("brand_name")))).otherwise(F.lit("{}"))
    return table(spark, sf, "events").select("event_id", lookups.signal_subject(details, title).alias("subject"))


# ---------------------------------------------------------------- scorecards
_FIELDS = _GRADED + ", gf as (select *, case p_size % 4 when 0 then 'rank' when 1 then 'store_count' when 2 then 'system_sales' else 'auv' end field, round_even(rel, 9) e from h)\n"


def _fields(spark, sf):
    field = F.element_at(F.array(*map(F.lit, ("rank", "store_count", "system_sales", "auv"))), (F.col("p_size") % 4 + 1).cast("int"))
    return _graded(spark, sf).withColumns({"field": field, "relative_error": F.bround("relative_error", 9)})


@query(_FIELDS + """, w as (select field, count(*) filter (grade in ('MISSING', 'D', 'F')) weak, count(*) filter (grade <> 'MISSING') covered, round_even(avg(confidence), 9) mean_confidence from gf group by 1)
 select *, row_number() over (order by weak desc, coalesce(mean_confidence, -1), field)::integer place from w""")
def q_weakest_fields(spark, sf):
    return scorecards.weakest_fields(_fields(spark, sf), "field", "p_partkey")


@query(_FIELDS + ", k as (select *, row_number() over (partition by p_brand order by e desc, p_partkey) n from gf where e is not null) select p_brand, p_partkey, field, e relative_error from k where n <= 3")
def q_largest_errors(spark, sf):
    return scorecards.largest_errors(_fields(spark, sf), ["p_partkey"], 3, by="p_brand").select("p_brand", "p_partkey", "field", "relative_error")


@query(_FIELDS + "select field, grade, count(*) as rows from gf group by 1, 2")
def q_grade_distribution(spark, sf):
    return scorecards.summary_of_grades(_fields(spark, sf), "field")


@query("""with t as (select event_type strength, 'k' || json_extract_string(props, '$.k') signal_type from events), y as (select 'type' kind, signal_type as value, count(*) signals, row_number() over (order by count(*) desc, signal_type) n from t group by 2)
 select 'all' kind, 'all' as value, count(*) signals from t union all select 'strength', strength, count(*) from t group by 2 union all select kind, value, signals from y where n <= 5""")
def q_signal_overview(spark, sf):
    rows = table(spark, sf, "events").select(F.col("event_type").alias("strength"), F.concat(F.lit("k"), F.get_json_object("props", "$.k")).alias("signal_type"))
    return scorecards.signal_overview(rows)


@query(_FIND + "select category, count(*) findings, count(*) filter (severity = 'error') errors from f where severity <> 'info' group by 1")
def q_warning_counts(spark, sf):
    return scorecards.warning_counts(_findings(spark, sf))


@query(_FIND + "select subject, count(*) filter (severity = 'error') errors, count(*) filter (severity = 'warning') warnings, string_agg(distinct check_name, '|' order by check_name) issues from f group by 1")
def q_subject_counts(spark, sf):
    return scorecards.subject_counts(_findings(spark, sf), "subject").withColumn("issues", F.array_join("issues", "|"))


@query(_FIND + """, su as (select s_suppkey subject from supplier), o as (select subject, check_name, count(*) filter (severity = 'error') e, count(*) n from f where ordinal % 7 = 0 group by 1, 2),
 c(label, own) as (values ('rank uniqueness', 'core_brand_metrics.rank_unique'), ('brand uniqueness', 'core_brand_metrics.brand_unique'), ('implied AUV consistency', 'implied_auv_k'), ('FTE range ordering', 'fte_range_order.row'), ('margin range ordering', 'margin_range_order.row'))
 select su.subject, label, case when e > 0 then 'failed' when n > 0 then 'warning' when label = 'implied AUV consistency' then 'passed' else 'unknown' end status from su cross join c left join o on o.subject = su.subject and o.check_name = own""")
def q_invariant_results(spark, sf):
    found = _findings(spark, sf).where("ordinal % 7 = 0")  # findings are rare: the others passed
    return scorecards.invariant_results(table(spark, sf, "supplier").select(F.col("s_suppkey").alias("subject")), found, "subject")


_CARDS = _FIELDS + """, fi as (select p_brand subject, case when l_returnflag = 'R' and l_discount > 0.09 then 'error' else 'warning' end severity, 'line ' || l_linestatus check_name from lineitem join part on l_partkey = p_partkey where l_discount > 0.09 and l_quantity > 45),
 ct as (select subject, count(*) filter (severity = 'error') errors, count(*) filter (severity = 'warning') warnings, string_agg(distinct check_name, '|' order by check_name) issues from fi group by 1),
 fs as (select p_brand subject, max(case grade when 'A' then 1 when 'B' then 2 when 'C' then 3 when 'D' then 4 when 'F' then 5 else 0 end) w, string_agg(distinct case when grade in ('MISSING', 'D', 'F') then field end, '|' order by case when grade in ('MISSING', 'D', 'F') then field end) weak from gf group by 1),
 cd as (select subject, case when coalesce(errors, 0) > 0 then 'failed' when coalesce(warnings, 0) > 0 then 'warning' else 'passed' end validation_status, case w when 0 then 'MISSING' else substr('ABCDF', w, 1) end overall_grade, coalesce(weak, '') weak_fields from fs left join ct using (subject))
"""


def _cards(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", F.col("p_brand").alias("subject"))
    lines = table(spark, sf, "lineitem").where("l_discount > 0.09 and l_quantity > 45").join(parts, F.col("l_partkey") == F.col("p_partkey"))
    found = lines.select("subject", F.when(F.col("l_returnflag") == "R", "error").otherwise("warning").alias("severity"), F.concat(F.lit("line "), "l_linestatus").alias("check_name"))
    return scorecards.subject_scorecards(parts, found, _fields(spark, sf).withColumnRenamed("p_brand", "subject"), "subject", "field")


@query(_CARDS + "select * from cd")
def q_subject_scorecards(spark, sf):
    return _cards(spark, sf).select("subject", "validation_status", "overall_grade", F.array_join("weak_fields", "|").alias("weak_fields"))


@query(_CARDS + "select count(*) subjects, count(*) filter (validation_status = 'failed') failed, count(*) filter (validation_status = 'warning') warned, count(*) filter (validation_status = 'passed') clean from cd")
def q_global_scorecard(spark, sf):
    return scorecards.global_scorecard(_cards(spark, sf))


_ROLL = _DECISIONS + ", z as (select *, case status when 'publishable' then 90.0::double when 'advisory' then 60.0::double else 20.0::double end - p_partkey % 10 score, status <> 'publishable' review from s)\n"


def _scored(spark, sf):
    base = F.when(F.col("status") == "publishable", 90.0).when(F.col("status") == "advisory", 60.0).otherwise(20.0)
    return _decisions(spark, sf).withColumns({"score": base - F.col("p_partkey") % 10, "review": F.col("status") != "publishable"})


@query(_ROLL + """select p_brand, count(*) as rows, round_even(avg(score), 6) mean_score, min(score) least_score, min_by(metric, score * 10 + case metric when 'price' then 0 else 1 end) least_metric, count(*) filter (review) to_review,
 count(*) filter (status = 'publishable') publishable, count(*) filter (status = 'advisory') advisory, count(*) filter (status = 'blocked') blocked from z group by 1""")
def q_credibility_rollup(spark, sf):
    return scorecards.credibility_rollup(_scored(spark, sf), "p_brand")


@query(_ROLL + "select status, count(*) as rows, round_even(avg(score), 6) mean_score, count(*) filter (review) to_review from z group by grouping sets ((status), ())")
def q_credibility_summary(spark, sf):
    return scorecards.credibility_summary(_scored(spark, sf), ["p_partkey", "metric"])[0]


@query(_ROLL + "select p_partkey, metric, score from z where review order by score, p_partkey, metric limit 10")
def q_review_queue(spark, sf):
    return scorecards.credibility_summary(_scored(spark, sf), ["p_partkey", "metric"])[1].select("p_partkey", "metric", "score")


@query("select source, lang, string_agg(distinct (n_chars % 5)::varchar, '|' order by (n_chars % 5)::varchar) kinds from documents group by grouping sets ((source), (source, lang))")
def q_seed_metadata(spark, sf):
    rows = table(spark, sf, "documents").select("source", "lang", (F.col("n_chars") % 5).cast("string").alias("kinds"))
    return scorecards.seed_metadata(rows, "source", "lang", ["kinds"]).withColumn("kinds", F.array_join("kinds", "|"))


@query("with f as (select p_type, p_size, p_partkey, row_number() over (partition by p_type order by p_size, p_partkey) n from part) select p_type, p_size, p_partkey from f where n = 1 order by p_size, p_partkey, p_type limit 6")
def q_reusable_plays(spark, sf):
    return scorecards.reusable_plays(table(spark, sf, "part").select("p_type", "p_size", "p_partkey"), "p_type", ["p_size", "p_partkey"])


@query("select l_partkey, count(distinct case when l_returnflag <> 'N' then l_returnflag || l_suppkey end) sources from lineitem group by 1")
def q_source_counts(spark, sf):
    name = F.when(F.col("l_returnflag") == "N", " Unknown ").otherwise(F.concat("l_returnflag", F.col("l_suppkey").cast("string")))
    return scorecards.source_counts(table(spark, sf, "lineitem").select("l_partkey", name.alias("source")), ["l_partkey"], "source")


@query("select c_mktsegment, round_even(max(c_acctbal) filter (c_acctbal > 0) / min(c_acctbal) filter (c_acctbal > 0), 6) span from customer group by 1")
def q_magnitude_span(spark, sf):
    return scorecards.magnitude_span(table(spark, sf, "customer"), ["c_mktsegment"], "c_acctbal").withColumn("span", F.bround("span", 6))


@query("select p_brand source, l_suppkey subject, count(*) as rows, p_brand || ': ' || count(*) || ' rows name no known subject: ' || l_suppkey warning from lineitem join part on l_partkey = p_partkey where l_suppkey not in (select s_suppkey from supplier where s_acctbal > 0) group by 1, 2")
def q_unresolved_names(spark, sf):
    rows = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey")).select(F.col("p_brand").alias("source"), F.col("l_suppkey").alias("subject"))
    return scorecards.unresolved_warnings(rows, "subject", table(spark, sf, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("subject")), "source")


@query(_FIELDS + ", o as (select distinct p_brand, field from gf where source_type = 'N') select distinct p_brand, field from gf where (p_brand, field) not in (select (p_brand, field) from o)")
def q_single_source_gaps(spark, sf):
    return scorecards.single_source_slice(_fields(spark, sf), "N", "p_brand", "field")[1]


@query("""with m as (select p_partkey, p_type supply, p_retailprice * 3 auv, p_size fte, p_partkey * 10 stores, p_size margin, p_size / 50.0::double share from part),
 k as (select p_partkey, list_filter([case when auv >= 3000 and fte >= 20 and margin >= 20 then 'premium_service:high' end, case when fte <= 12 and stores >= 2000 then 'throughput_model:medium' end,
 case when share >= 0.95 then 'franchise_standardized:high' when share >= 0.85 then 'franchise_standardized:medium' end, case when fte <= 15 then 'assembly_automation:medium' end], lambda x: x is not null) c, share from m)
 select p_partkey, case when len(c) > 0 then array_to_string(c, '|') when share >= 0.7 then 'franchise_standardized:low' else 'premium_service:low' end models from k""")
def q_operating_models(spark, sf):
    size = F.col("p_size")
    rows = table(spark, sf, "part").select("p_partkey", F.col("p_name").alias("category"), F.col("p_type").alias("supply"), (F.col("p_retailprice") * 3).alias("auv"), size.alias("fte"), (F.col("p_partkey") * 10).alias("stores"), size.alias("margin"), (size / 50.0).alias("share"))
    out = rules.operating_models(rows, "category", "supply", "auv", "fte", "stores", "margin", "share")
    return out.select("p_partkey", F.array_join(F.transform("models", lambda m: F.concat_ws(":", m["code"], m["confidence"])), "|").alias("models"))


@query("""select p_partkey + 2 row_number, 'parts' source_sheet, trim(p_name) brand_name, p_size::bigint as rank, p_size::double fte_min, p_size + 5.0::double fte_max, p_size + 2.5::double fte_mid from part""")
def q_core_normalised(spark, sf):
    size = F.col("p_size").cast("string")
    raw = table(spark, sf, "part").select(F.concat(F.lit("  "), "p_name").alias("Brand"), F.concat(F.lit("# "), size).alias("Rank"), F.concat(size, F.lit("-"), (F.col("p_size") + 5).cast("string")).alias("Staff"), "p_partkey")
    out = normalise.core_metrics(raw, {"Brand": "brand_name", "Rank": "rank", "Staff": "store_daily_equivalent_fte_range"}, "parts", "p_partkey")
    return out.select("row_number", "source_sheet", "brand_name", "rank", "fte_min", "fte_max", "fte_mid")


