"""Signal queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.operators import signals
from ledgerlens.plans.base import query, table


def _digits_sql(lo: int, hi: int) -> str:
    k = len(str(lo)) - 1
    return f"""with v as (select 'l_extendedprice' f, l_extendedprice x from lineitem union all select 'l_tax', l_tax from lineitem),
 d as (select f, greatest({lo}, least({hi}, floor(x / pow(10.0, floor(log10(x)) - {k}))))::integer digit from v where x > 0),
 c as (select f, digit, count(*) o from d group by 1, 2), n as (select f, sum(o)::bigint n from c group by 1),
 g as (select f, unnest(generate_series({lo}, {hi}))::integer digit from (select distinct f from v)),
 x as (select g.f as field, g.digit, coalesce(o, 0)::bigint observed, n, log10(1 + 1.0::double / g.digit) e from g join n using (f) left join c on c.f = g.f and c.digit = g.digit)
"""


@query(_digits_sql(1, 9) + "select field, digit, observed, round_even(observed / n::double, 6) share, round_even(e, 6) expected from x")
def q_benford_first(spark, sf):
    out = signals.digit_histogram(table(spark, sf, "lineitem"), ["l_extendedprice", "l_tax"], 1)
    return out.select("field", "digit", "observed", F.bround(F.col("observed") / F.col("n"), 6).alias("share"), F.bround("expected", 6).alias("expected"))


@query(_digits_sql(10, 99) + "select field, max(n) n, round_even(avg(abs(observed / n::double - e)), 6) mad, round_even(sum((observed - e * n) * (observed - e * n) / (e * n)), 3) chi2 from x group by 1")
def q_benford_two(spark, sf):
    out = signals.benford(table(spark, sf, "lineitem"), ["l_extendedprice", "l_tax"], 2)
    return out.select("field", "n", F.bround("mad", 6).alias("mad"), F.bround("chi2", 3).alias("chi2"))


@query(_digits_sql(1, 9) + """, s as (select field, max(n) n, avg(abs(observed / n::double - e)) mad, sum((observed - e * n) * (observed - e * n) / (e * n)) chi2 from x group by 1),
 p as (select *, exp(-chi2 / 2) * (1 + chi2 / 2 + chi2 * chi2 / 8 + chi2 * chi2 * chi2 / 48) p_value from s)
 select field, n, round_even(mad, 6) mad, round_even(chi2, 3) chi2, case when p_value < 0.01 and mad >= 0.02 then 'moderate' when p_value < 0.05 or mad >= 0.015 then 'weak' else 'unknown' end strength from p""")
def q_benford_signal(spark, sf):
    out = signals.benford(table(spark, sf, "lineitem"), ["l_extendedprice", "l_tax"])
    return out.select("field", "n", F.bround("mad", 6).alias("mad"), F.bround("chi2", 3).alias("chi2"), "strength")


@query("""with v as (select l_quantity x from lineitem), d as (select (abs(round_even(x, 0)) % 10)::integer d from v), n as (select count(*) n, avg((d in (0, 5))::integer::double) share from d),
 c as (select sum((o - n / 10.0::double) * (o - n / 10.0::double) / (n / 10.0::double)) chi2 from (select g.d, count(d.d) o from (select unnest(range(10)) d) g left join d using (d) group by 1), n),
 z as (select *, (share - 0.2) / sqrt(0.16 / n) z from n, c)
 select 'l_quantity' field, n, round_even(share, 6) share, round_even(z, 4) z, round_even(chi2, 4) chi2, case when share >= 0.5 and z >= 3 then 'moderate' when share >= 0.35 and z >= 2 then 'weak' else 'unknown' end strength from z""")
def q_end_digit_heaping(spark, sf):
    out = signals.end_digit_heaping(table(spark, sf, "lineitem"), ["l_quantity"])
    return out.select("field", "n", F.bround("share", 6).alias("share"), F.bround("z", 4).alias("z"), F.bround("chi2", 4).alias("chi2"), "strength")


@query("""with v as (select 'l_quantity' field, l_quantity x from lineitem union all select 'l_extendedprice', l_extendedprice from lineitem),
 s as (select field, count(*) n, avg((round_even(x, 0) % 10 = 0 or round_even(x, 0) % 25 = 0)::integer::double) share from v group by 1), z as (select *, (share - 0.12) / sqrt(0.12 * 0.88 / n) z from s)
 select field, n, round_even(share, 6) share, round_even(z, 4) z, case when z >= 3 then 'moderate' when z >= 2 then 'weak' else 'unknown' end strength from z""")
def q_nice_numbers(spark, sf):
    out = signals.nice_numbers(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice"])
    return out.select("field", "n", F.bround("share", 6).alias("share"), F.bround("z", 4).alias("z"), "strength")


_CORR = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("with r as (" + " union all ".join(f"select '{a}' left_field, '{b}' right_field, corr({a}, {b}) r from lineitem" for i, a in enumerate(_CORR) for b in _CORR[i + 1 :]) + """)
 select left_field, right_field, round_even(r, 6) r, case when abs(r) >= 0.97 then 'weak' else 'unknown' end strength from r order by round_even(abs(r), 9) desc, left_field, right_field limit 3""")
def q_correlation_top3(spark, sf):
    return signals.correlations(table(spark, sf, "lineitem"), _CORR).withColumn("r", F.bround("r", 6))


@query("""with s as (select c_custkey, coalesce(sum(o_totalprice), 0)::double spend from customer left join orders on o_custkey = c_custkey group by 1),
 q as (select quantile_cont(spend, 0.25) a, quantile_cont(spend, 0.5) m, quantile_cont(spend, 0.75) b from s), d as (select median(abs(spend - m)) mad from s, q),
 x as (select c_custkey, spend, case when mad = 0 then 0.0 else 0.6745 * (spend - m) / mad end z, spend < a - 1.5 * (b - a) or spend > b + 1.5 * (b - a) outside from s, q, d)
 select c_custkey, round_even(spend, 2) spend, round_even(z, 5) robust_z, outside, case when outside and abs(z) >= 3 then 'moderate' else 'weak' end strength from x where outside or abs(z) >= 3""")
def q_outliers_robust(spark, sf):
    spend = table(spark, sf, "orders").groupBy("o_custkey").agg(F.sum("o_totalprice").alias("spend"))
    rows = table(spark, sf, "customer").select("c_custkey").join(spend, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", F.coalesce("spend", F.lit(0.0)).alias("spend"))
    out = signals.robust_outliers(rows, "c_custkey", "spend")
    return out.select("c_custkey", F.bround("spend", 2).alias("spend"), F.bround("robust_z", 5).alias("robust_z"), "outside", "strength")


@query()
def q_isolation_forest(spark, sf):
    lines = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.avg("l_quantity").alias("quantity"), F.sum("l_extendedprice").alias("revenue"), F.avg("l_discount").alias("discount"))
    rows = table(spark, sf, "supplier").select("s_suppkey", "s_acctbal").join(lines, F.col("s_suppkey") == F.col("l_suppkey"))
    return signals.isolation_forest(rows, "s_suppkey", ["s_acctbal", "quantity", "revenue", "discount"])


def _event_signals(spark, sf):
    kind = F.col("event_type")
    strength = F.when(kind == "error", "strong").when(kind == "purchase", "moderate").when(kind == "signup", "weak").otherwise("unknown")
    return table(spark, sf, "events").select("user_id", strength.alias("strength"), F.when(kind != "view", kind).alias("field_name"), F.lit("event").alias("signal_type"))


_EVENT_SQL = """with s as (select user_id, case event_type when 'error' then 45 when 'purchase' then 25 when 'signup' then 10 else 0 end c, nullif(event_type, 'view') f from events),
 p as (select user_id, {part} part, {name} k from s), g as (select user_id, sum(part)::bigint base, count(distinct k) fields, max(part)::bigint largest, count(*) signals from p group by 1),
 r as (select *, least(100, base + 5 * greatest(fields - 1, 0))::bigint score from g) select *, score >= 35 or largest >= 25 review from r"""


@query(_EVENT_SQL.format(part="case when f is null then greatest(5, c // 2) else c end", name="coalesce(f, 'event')"))
def q_signal_interpretation(spark, sf):
    return signals.interpret(_event_signals(spark, sf), ["user_id"])


@query(_EVENT_SQL.format(part="c", name="f"))
def q_signal_summary(spark, sf):
    return signals.interpret(_event_signals(spark, sf), ["user_id"], halve_unnamed=False)
