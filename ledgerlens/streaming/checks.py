"""The same checks on a stream: finding counts by window, and signals of each micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlens.operators.quality import Rule


def windowed_violations(stream: DataFrame, ts: str, rules: list[Rule], window: str = "1 day", late: str = "2 days") -> DataFrame:
    """window start, field_name, check_name and violations of each event-time window; later rows than ``late`` are dropped."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(r.holds, F.lit(False)), F.struct(F.lit(r.field).alias("field_name"), F.lit(r.name).alias("check_name"))) for r in rules]))
    rows = stream.withWatermark(ts, late).select(ts, F.explode(broken).alias("x"))
    return rows.groupBy(F.window(ts, window), "x.field_name", "x.check_name").agg(F.count("*").alias("violations")).select(F.col("window.start").alias("start"), "field_name", "check_name", "violations")


def each_batch(stream: DataFrame, operator: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> StreamingQuery:
    """Any batch operator on each micro-batch; a batch that is written again after a failure replaces its own folder."""

    def write(batch: DataFrame, number: int) -> None:
        operator(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
