"""Quality, parsing and resolution queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.functions import exprs
from ledgerlens.operators import quality, resolve
from ledgerlens.plans.base import query, table


def _orders_with_lines(spark, sf):
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.sum("l_extendedprice").alias("amount"), F.count("*").alias("lines"))
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")


_IMPLIED = """with l as (select l_orderkey, sum(l_extendedprice) amount, count(*) lines from lineitem group by 1),
 o as (select o_orderkey, o_totalprice, case when amount is not null and lines > 0 then amount / lines end expected from orders left join l on o_orderkey = l_orderkey),
 d as (select *, case when expected = 0 then case when o_totalprice = 0 then 0.0 end else abs(o_totalprice - expected) / expected end delta from o),
 s as (select *, case when expected is null then 'missing' when delta <= 0.05 then 'pass' else 'fail' end status from d)
"""


@query(_IMPLIED + "select o_orderkey, round_even(expected, 4) expected, round_even(delta, 6) delta, status from s")
def q_implied_value(spark, sf):
    out = quality.implied_value(_orders_with_lines(spark, sf), F.col("amount"), F.col("lines"), F.col("o_totalprice"))
    return out.select("o_orderkey", F.bround("expected", 4).alias("expected"), F.bround("delta", 6).alias("delta"), "status")


@query(_IMPLIED + """select * from (select 'error' severity, 'implied_value_mismatch' check_name, count(*) filter (status = 'fail') as rows from s union all
 select 'error', 'implied_value_missing', count(*) filter (status = 'missing') from s union all
 select 'info', 'implied_value_passed', count(*) filter (status = 'pass') from s) where rows > 0""")
def q_implied_summary(spark, sf):
    return quality.severity_counts(quality.implied_value(_orders_with_lines(spark, sf), F.col("amount"), F.col("lines"), F.col("o_totalprice")))


@query("select l_orderkey, l_linenumber, count(*) as rows from lineitem group by 1, 2 having count(*) > 1")
def q_key_uniqueness(spark, sf):
    return quality.duplicates(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""with b as (select distinct o_custkey k from orders where o_orderdate < timestamp '1995-07-01'), c as (select distinct c_custkey k from customer where c_acctbal > 0)
 select case when c.k is null then 'right_only' when b.k is null then 'left_only' else 'both' end side, count(*) as keys from c full join b on c.k = b.k group by 1""")
def q_cross_table_alignment(spark, sf):
    customers = table(spark, sf, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("key"))
    buyers = table(spark, sf, "orders").where(F.col("o_orderdate") < F.lit("1995-07-01").cast("timestamp")).select(F.col("o_custkey").alias("key"))
    return quality.alignment(customers, buyers, "key")


@query("""with p as (select l_partkey, min(l_extendedprice / l_quantity) low, avg(l_extendedprice / l_quantity) mid, max(l_extendedprice / l_quantity) high from lineitem group by 1)
 select p_partkey, round_even(low, 8) low, round_even(mid, 6) mid, round_even(high, 8) high, coalesce(low <= p_retailprice and p_retailprice <= high, false) as ordered from part left join p on p_partkey = l_partkey""")
def q_monotonic_range(spark, sf):
    unit = F.col("l_extendedprice") / F.col("l_quantity")
    lines = table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.min(unit).alias("low"), F.avg(unit).alias("mid"), F.max(unit).alias("high"))
    parts = table(spark, sf, "part").select("p_partkey", "p_retailprice").join(lines, F.col("p_partkey") == F.col("l_partkey"), "left")
    out = quality.monotonic(parts, F.col("low"), F.col("p_retailprice"), F.col("high"))
    return out.select("p_partkey", F.bround("low", 8).alias("low"), F.bround("mid", 6).alias("mid"), F.bround("high", 8).alias("high"), "ordered")


@query("""select * from (
 select 'c_acctbal' field_name, 'in_range(0,9000)' check_name, 'allowed_range' kind, count(*) filter (not (c_acctbal >= 0 and c_acctbal <= 9000)) violations, count(*) as rows from customer union all
 select 'c_name', 'str_length(20)', 'allowed_range', count(*) filter (not length(trim(c_name)) >= 20), count(*) from customer union all
 select 'c_mktsegment', 'equals', 'allowed_range', count(*) filter (not c_mktsegment = 'BUILDING'), count(*) from customer union all
 select 'c_nationkey', 'not_null', 'null', count(*) filter (c_nationkey is null), count(*) from customer union all
 select 'c_custkey', 'greater_than(5)', 'allowed_range', count(*) filter (not c_custkey > 5), count(*) from customer)""")
def q_schema_rules(spark, sf):
    rules = [quality.in_range("c_acctbal", 0, 9000), quality.text_length("c_name", 20), quality.equals("c_mktsegment", "BUILDING"), quality.not_null("c_nationkey"), quality.in_range("c_custkey", 5, strict=True)]
    return quality.rule_violations(table(spark, sf, "customer"), rules)


@query("""with r as (select c_custkey from customer where not (c_acctbal >= 0)), k as (select c_custkey, row_number() over (order by c_custkey) nth from r)
 select c_custkey, 'c_acctbal' field_name, 'in_range(0,None)' check_name, 'allowed_range' kind, nth::integer nth from k where nth <= 5""")
def q_first_violations(spark, sf):
    return quality.violating_rows(table(spark, sf, "customer"), [quality.in_range("c_acctbal", 0)], ["c_custkey"])


@query("""with t as (select p_partkey, p_size, case p_size % 5 when 0 then p_size || '-' || (p_size + 4) || '%' when 1 then p_size::varchar when 2 then '1,' || (200 + p_size) || '~1,400' when 3 then '-' || p_size else ' ' end txt from part)
 select p_partkey, case p_size % 5 when 0 then p_size::double when 1 then p_size::double when 2 then (1200 + p_size)::double when 3 then p_size::double end low,
 case p_size % 5 when 0 then (p_size + 4)::double when 1 then p_size::double when 2 then 1400.0::double when 3 then p_size::double end high,
 case p_size % 5 when 0 then p_size + 2.0::double when 1 then p_size::double when 2 then (2600 + p_size) / 2.0::double when 3 then p_size::double end mid from t""")
def q_range_parse(spark, sf):
    n = F.col("p_size")
    text = F.when(n % 5 == 0, F.concat(n, F.lit("-"), n + 4, F.lit("%"))).when(n % 5 == 1, n.cast("string")).when(n % 5 == 2, F.concat(F.lit("1,"), 200 + n, F.lit("~1,400"))).when(n % 5 == 3, F.concat(F.lit("-"), n)).otherwise(" ")
    return table(spark, sf, "part").select("p_partkey", exprs.numeric_range(text).alias("r")).select("p_partkey", "r.low", "r.high", "r.mid")


@query("""select p_partkey, regexp_replace(lower(p_brand || ' & ' || p_name), '[^a-z0-9]+', '', 'g') lookup_key, regexp_replace(replace(lower(trim(p_brand || ' & ' || p_name)), '&', 'and'), '[^a-z0-9]+', '', 'g') resolver_key,
 trim(regexp_replace(lower(p_brand || ' & ' || p_name), '[^a-z0-9]+', '-', 'g'), '-') slug from part""")
def q_key_normalise(spark, sf):
    name = F.concat("p_brand", F.lit(" & "), "p_name")
    return table(spark, sf, "part").select("p_partkey", exprs.lookup_key(name).alias("lookup_key"), exprs.resolver_key(name).alias("resolver_key"), exprs.slug(name).alias("slug"))


def _aliases(spark, sf):
    nations = table(spark, sf, "nation").select("n_name")
    full = nations.select(exprs.resolver_key(F.col("n_name")).alias("alias_key"), F.col("n_name").alias("canonical"))
    short = nations.select(F.substring(exprs.resolver_key(F.col("n_name")), 1, 4).alias("alias_key"), F.col("n_name").alias("canonical")).groupBy("alias_key").agg(F.min("canonical").alias("canonical"))
    return full.unionByName(short).groupBy("alias_key").agg(F.min("canonical").alias("canonical"))


@query("""with n as (select n_name, regexp_replace(replace(lower(trim(n_name)), '&', 'and'), '[^a-z0-9]+', '', 'g') k from nation),
 a as (select k, min(c) c from (select k, n_name c from n union all select substr(k, 1, 4), min(n_name) from n group by 1) group by 1),
 x as (select c_custkey, case c_custkey % 4 when 0 then ' ' || lower(n_name) || ' ' when 1 then substr(n_name, 1, 4) when 2 then n_name || 'x' else '' end nm from customer join nation on c_nationkey = n_nationkey)
 select c_custkey, a.c canonical, case when trim(nm) = '' then 'missing' when a.c is not null then 'exact_alias' else 'unmatched' end as match, case when trim(nm) <> '' and a.c is not null then 1.0::double else 0.0::double end match_confidence
 from x left join a on regexp_replace(replace(lower(trim(nm)), '&', 'and'), '[^a-z0-9]+', '', 'g') = a.k""")
def q_alias_resolve(spark, sf):
    return resolve.resolve(_written_names(spark, sf), _aliases(spark, sf), "name").select("c_custkey", "canonical", "match", "match_confidence")


def _written_names(spark, sf):
    k = F.col("c_custkey") % 4
    name = F.when(k == 0, F.concat(F.lit(" "), F.lower("n_name"), F.lit(" "))).when(k == 1, F.substring("n_name", 1, 4)).when(k == 2, F.concat("n_name", F.lit("x"))).otherwise("")
    return table(spark, sf, "customer").join(F.broadcast(table(spark, sf, "nation")), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", name.alias("name"))


@query()
def q_fuzzy_resolve(spark, sf):
    return resolve.resolve_fuzzy(_written_names(spark, sf), _aliases(spark, sf), "name").select("c_custkey", "canonical", "match", "match_confidence")


@query("""with m as (select conv_id, min(turn) f from conversations where role = 'assistant' group by 1), e as (select c.conv_id, min(c.turn) e from conversations c join m using (conv_id) where c.turn > m.f and trim(coalesce(c.text, '')) = '' group by 1)
 select c.conv_id, c.turn, case when c.turn > m.f and (e.e is null or c.turn < e.e) then 'finding' else 'note' end as section from conversations c left join m using (conv_id) left join e using (conv_id)
 where trim(coalesce(c.text, '')) <> '' and not (c.role = 'assistant' and c.turn = m.f and m.f is not null)""")
def q_section_split(spark, sf):
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    from pyspark.sql.window import Window

    first = F.min(F.when(F.col("role") == "assistant", F.col("turn"))).over(Window.partitionBy("conv_id"))
    rows = rows.withColumn("mark", F.coalesce(F.col("turn") == first, F.lit(False)))
    return quality.section_split(rows, ["conv_id"], "turn", F.col("mark"), F.trim(F.coalesce("text", F.lit(""))) == "").select("conv_id", "turn", "section")
