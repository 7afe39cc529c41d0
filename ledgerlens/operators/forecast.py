"""Dated snapshots, panels, time splits and forecast baselines; the origin is fixed and holdouts are never fed back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Fixed value: the name of the smoothed baseline stays whatever its weight is.
SMOOTHED = "exp_smoothing_alpha_0_5"


def panel(snapshots: DataFrame, entity: str, date: str, value: str, sequence: str, statuses: list[str] | None = None) -> DataFrame:
    """One row for each entity and date, the last by sequence; rows without value or with another status are dropped."""
    rows = snapshots.where(F.col(value).isNotNull())
    if statuses is not None:
        rows = rows.where(F.col("status").isin(*statuses))
    rest = [c for c in rows.columns if c not in (entity, date)]
    return rows.groupBy(entity, date).agg(F.max_by(F.struct(*rest), F.col(sequence)).alias("r")).select(entity, date, "r.*")


def drop_counts(snapshots: DataFrame, value: str, statuses: list[str]) -> DataFrame:
    """How many rows a panel drops, by reason."""
    missing = F.col(value).isNull()
    status = ~F.coalesce(F.col("status").isin(*statuses), F.lit(False))
    return snapshots.agg(F.count_if(missing).alias("missing_value"), F.count_if(~missing & status).alias("status_excluded"), F.count_if(~missing & ~status).alias("kept"))


def time_split(rows: DataFrame, entity: str, date: str, holdout: int, least_train: int) -> DataFrame:
    """Adds part (train or test: the last ``holdout`` rows) and step (test rows, from 0); entities with fewer rows than
    both need are dropped_short."""
    w = Window.partitionBy(entity)
    back = F.row_number().over(w.orderBy(F.desc(date)))
    out = rows.withColumn("_n", F.count("*").over(w)).withColumn("_b", back)
    part = F.when(F.col("_n") < holdout + least_train, "dropped_short").when(F.col("_b") <= holdout, "test").otherwise("train")
    return out.withColumn("part", part).withColumn("step", F.when(F.col("part") == "test", holdout - F.col("_b"))).drop("_n", "_b")


def train_state(split: DataFrame, entity: str, date: str, value: str, alpha: float = 0.5, window: int = 3) -> DataFrame:
    """Of each entity's training rows: the values in order, last value, rolling mean, smoothed level and MASE scale."""
    train = split.where("part = 'train'")
    values = F.transform(F.array_sort(F.collect_list(F.struct(F.col(date).alias("d"), F.col(value).cast("double").alias("v")))), lambda x: x["v"])
    out = train.groupBy(entity).agg(values.alias("values"))
    n = F.size("values")
    last = F.slice("values", F.greatest(n - window + 1, F.lit(1)), F.lit(window))
    level = F.aggregate(F.slice("values", F.lit(2), F.greatest(n - 1, F.lit(0))), F.element_at("values", 1), lambda a, x: alpha * x + (1 - alpha) * a)
    gaps = F.zip_with(F.slice("values", F.lit(2), F.greatest(n - 1, F.lit(0))), F.slice("values", F.lit(1), F.greatest(n - 1, F.lit(0))), lambda a, b: F.abs(a - b))
    scale = F.nullif(F.try_divide(F.aggregate(gaps, F.lit(0.0), lambda a, x: a + x), F.size(gaps)), F.lit(0.0))
    return out.select(entity, "values", F.element_at("values", -1).alias("naive"), (F.aggregate(last, F.lit(0.0), lambda a, x: a + x) / F.size(last)).alias("rolling"), level.alias("smoothed"), scale.alias("scale"))


def forecasts(split: DataFrame, entity: str, date: str, value: str, alpha: float = 0.5, window: int = 3, season: int | None = None) -> DataFrame:
    """entity, date, step, baseline, forecast, actual, scale: all baselines of each test row.

    The seasonal one repeats the last season and is left out without a season above one or enough training rows.
    """
    state = train_state(split, entity, date, value, alpha, window)
    test = split.where("part = 'test'").select(entity, date, "step", F.col(value).cast("double").alias("actual"))
    joined = test.join(state, entity)
    named = [F.struct(F.lit("naive_last_value").alias("baseline"), F.col("naive").alias("forecast")), F.struct(F.lit("rolling_mean").alias("baseline"), F.col("rolling").alias("forecast")), F.struct(F.lit(SMOOTHED).alias("baseline"), F.col("smoothed").alias("forecast"))]
    if season and season > 1:
        n = F.size("values")
        at = n - season + F.col("step") % season + 1
        named.append(F.struct(F.lit("seasonal_naive").alias("baseline"), F.when(n >= season, F.try_element_at("values", at)).alias("forecast")))
    return joined.select(entity, date, "step", "actual", "scale", F.explode(F.array(*named)).alias("x")).select(entity, date, "step", "x.*", "actual", "scale").where(F.col("forecast").isNotNull())


def metrics(rows: DataFrame, by: list[str]) -> DataFrame:
    """MASE, WAPE, sMAPE, RMSE and bias, six places, half-even; undefined parts are left out of their mean."""
    gap = F.abs(F.col("forecast") - F.col("actual"))
    both = F.abs("forecast") + F.abs("actual")
    named = {
        "mase": F.avg(F.try_divide(gap, F.col("scale"))), "wape": F.try_divide(F.sum(gap), F.sum(F.abs("actual"))), "smape": F.avg(F.try_divide(2 * gap, F.nullif(both, F.lit(0.0)))),
        "rmse": F.sqrt(F.avg(gap * gap)), "bias": F.avg(F.col("forecast") - F.col("actual")),
    }
    return rows.groupBy(*by).agg(F.count("*").alias("rows"), *[F.bround(c, 6).alias(n) for n, c in named.items()])


def cadence(rows: DataFrame, entity: str, date: str) -> DataFrame:
    """periods and regular of each entity: all gaps equal in days, or equal in months on the same day or month ends."""
    w = Window.partitionBy(entity).orderBy(date)
    d = F.col(date).cast("date")
    base = rows.select(entity, d.alias(date)).distinct()
    before = F.lag(date).over(w)
    months = (F.year(date) * 12 + F.month(date)) - (F.year(before) * 12 + F.month(before))
    gaps = base.withColumns({"_d": F.datediff(F.col(date), before), "_m": F.when(before.isNotNull(), months), "_dom": F.dayofmonth(date), "_end": F.col(date) == F.last_day(date)})
    one = gaps.groupBy(entity).agg(F.count("*").alias("periods"), F.countDistinct("_d").alias("d"), F.countDistinct("_m").alias("m"), F.countDistinct("_dom").alias("dom"), F.bool_and("_end").alias("ends"))
    regular = (F.col("periods") >= 2) & ((F.col("d") == 1) | ((F.col("m") == 1) & (F.col("ends") | (F.col("dom") == 1))))
    return one.select(entity, "periods", regular.alias("regular"))


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """old without the keys of new, and new."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def seasonal(values: Column, season: int, step: Column) -> Column:
    return F.try_element_at(values, F.size(values) - season + step % season + 1)
