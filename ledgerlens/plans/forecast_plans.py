"""Panel and forecast queries: monthly revenue of each nation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.operators import forecast
from ledgerlens.plans.base import query, table


def _snapshots(spark, sf):
    buyers = table(spark, sf, "customer").join(F.broadcast(table(spark, sf, "nation")), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")
    orders = table(spark, sf, "orders").select("o_custkey", "o_totalprice", "o_orderstatus", F.trunc("o_orderdate", "month").alias("month"))
    rows = orders.join(buyers, F.col("o_custkey") == F.col("c_custkey"))
    # each order status is a later snapshot of the same month
    out = rows.groupBy("n_name", "month", F.col("o_orderstatus").alias("status")).agg(F.bround(F.sum("o_totalprice"), 2).alias("revenue"))
    return out


def _panel(spark, sf):
    return forecast.panel(_snapshots(spark, sf), "n_name", "month", "revenue", "status", ["F", "O"])


def _split(spark, sf):
    return forecast.time_split(_panel(spark, sf), "n_name", "month", 6, 12)


_PANEL = """with s as (select n_name, date_trunc('month', o_orderdate)::date as month, o_orderstatus status, round_even(sum(o_totalprice), 2) revenue from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by 1, 2, 3),
 p as (select n_name, month, arg_max(revenue, status) revenue, max(status) status from s where status in ('F', 'O') group by 1, 2),
 b as (select *, count(*) over (partition by n_name) n, row_number() over (partition by n_name order by month desc) k from p),
 t as (select *, case when n < 18 then 'dropped_short' when k <= 6 then 'test' else 'train' end part, case when n >= 18 and k <= 6 then (6 - k)::integer end step from b),
 tr as (select *, row_number() over (partition by n_name order by month desc) back, revenue - lag(revenue) over (partition by n_name order by month) gap, count(*) over (partition by n_name) m from t where part = 'train'),
 st as (select n_name, max(m) m, max(revenue) filter (back = 1) naive, avg(revenue) filter (back <= 3) rolling, sum(case when back = m then 1 else 0.5::double end * pow(0.5::double, back - 1) * revenue) smoothed, nullif(avg(abs(gap)), 0) scale from tr group by 1),
 f as (select t.n_name, t.month, t.step, t.revenue actual, st.*, (select revenue from tr where tr.n_name = t.n_name and tr.back = 12 - t.step % 12) seasonal from t join st on t.n_name = st.n_name where part = 'test'),
 l as (select n_name, month, step, scale, actual, unnest(['naive_last_value', 'rolling_mean', 'exp_smoothing_alpha_0_5', 'seasonal_naive']) baseline, unnest([naive, rolling, smoothed, seasonal]) forecast from f)
"""


@query(_PANEL + "select n_name, month, revenue, status from p")
def q_snapshot_panel(spark, sf):
    return _panel(spark, sf)


@query(_PANEL + "select n_name, month, part, step from t")
def q_time_split(spark, sf):
    return _split(spark, sf).select("n_name", "month", "part", "step")


def _named(name: str):
    sql = _PANEL + f"select n_name, month, round_even(forecast, 4) forecast, round_even(actual, 2) actual from l where baseline = '{name}'"

    def run(spark, sf):
        out = forecast.forecasts(_split(spark, sf), "n_name", "month", "revenue", season=12).where(F.col("baseline") == name)
        return out.select("n_name", "month", F.bround("forecast", 4).alias("forecast"), F.bround("actual", 2).alias("actual"))

    return sql, run


for _name, _baseline in (("q_forecast_naive", "naive_last_value"), ("q_forecast_rolling", "rolling_mean"), ("q_forecast_ses", forecast.SMOOTHED), ("q_forecast_seasonal", "seasonal_naive")):
    _sql, _run = _named(_baseline)
    _run.__name__ = _name
    query(_sql)(_run)


@query(_PANEL + """select baseline, count(*) as rows, round_even(avg(abs(forecast - actual) / scale), 6) mase, round_even(sum(abs(forecast - actual)) / sum(abs(actual)), 6) wape, round_even(avg(2 * abs(forecast - actual) / nullif(abs(forecast) + abs(actual), 0)), 6) smape,
 round_even(sqrt(avg((forecast - actual) * (forecast - actual))), 4) rmse, round_even(avg(forecast - actual), 4) bias from l group by 1""")
def q_forecast_metrics(spark, sf):
    out = forecast.metrics(forecast.forecasts(_split(spark, sf), "n_name", "month", "revenue", season=12), ["baseline"])
    return out.withColumns({"rmse": F.bround("rmse", 4), "bias": F.bround("bias", 4)})


@query("""with d as (select distinct user_id, ts::date d from events), g as (select user_id, d, d - lag(d) over w gap, (year(d) * 12 + month(d)) - lag(year(d) * 12 + month(d)) over w m from d window w as (partition by user_id order by d))
 select user_id, count(*) periods, count(*) >= 2 and (count(distinct gap) = 1 or (count(distinct m) = 1 and (bool_and(d = last_day(d)) or count(distinct day(d)) = 1))) regular from g group by 1""")
def q_cadence(spark, sf):
    return forecast.cadence(table(spark, sf, "events"), "user_id", "ts")


@query(_PANEL + "select count(*) filter (revenue is null) missing_value, count(*) filter (revenue is not null and status not in ('F', 'O')) status_excluded, count(*) filter (revenue is not null and status in ('F', 'O')) kept from s")
def q_panel_drops(spark, sf):
    return forecast.drop_counts(_snapshots(spark, sf), "revenue", ["F", "O"])


@query(_PANEL + ", nw as (select n_name, month, revenue + 1 revenue, status from p where month >= date '2001-01-01') select * from nw union all select n_name, month, revenue, status from p where month < date '2001-01-01'")
def q_snapshot_upsert(spark, sf):
    old = _panel(spark, sf)
    new = old.where(F.col("month") >= F.lit("2001-01-01").cast("date")).withColumn("revenue", F.col("revenue") + 1)
    return forecast.upsert(old, new, ["month"])
