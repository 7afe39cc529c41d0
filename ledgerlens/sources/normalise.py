"""From raw sheets to typed tables: renaming with lineage, cleaning, coercing casts, expanded ranges; paths of a corpus."""

from __future__ import annotations

from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions import exprs

FIRST_ROW = 2  # sheet row of the first record: the header is row 1


def with_lineage(df: DataFrame, names: dict[str, str], sheet: str, position: str) -> DataFrame:
    """Columns by ``names`` (given name -> new name), with source_sheet and row_number.

    ``position`` is the record's place in its file from 0, a stored column: a distributed reader has no order of its own.
    """
    if missing := [c for c in names if c not in df.columns]:
        raise ValueError(f"{sheet}: missing columns {', '.join(missing)}")
    return df.select(*[F.col(c).alias(n) for c, n in names.items()], F.lit(sheet).alias("source_sheet"), (F.col(position) + FIRST_ROW).cast("long").alias("row_number"))


def normalised(df: DataFrame, texts: list[str], whole: list[str], numbers: list[str], ranges: dict[str, tuple[str, str, str]]) -> DataFrame:
    """Texts cleaned, numbers coerced (what is no number is null), ranges expanded to (low, high, mid) columns."""
    out: dict[str, Column] = {c: exprs.clean_text(F.col(c).cast("string")) for c in texts}
    out |= {c: exprs.whole_number(exprs.safe_double(F.col(c).cast("string"))) for c in whole}
    out |= {c: exprs.safe_double(F.col(c).cast("string")) for c in numbers}
    for c, (low, high, mid) in ranges.items():
        r = exprs.numeric_range(F.col(c).cast("string"))
        out |= {low: r["low"], high: r["high"], mid: r["mid"]}
    return df.withColumns(out)


def core_metrics(df: DataFrame, names: dict[str, str], sheet: str, position: str) -> DataFrame:
    """The core table: lineage, cleaned texts, counts and amounts, staffing and margin ranges."""
    rows = with_lineage(df, names, sheet, position)
    texts = [c for c in ("brand_name", "category", "ownership_model", "central_kitchen_supply_chain_model") if c in rows.columns]
    whole = [c for c in ("rank", "us_store_count_2024") if c in rows.columns]
    numbers = [c for c in ("systemwide_revenue_usd_billions_2024", "average_unit_volume_usd_thousands") if c in rows.columns]
    ranges = {"store_daily_equivalent_fte_range": ("fte_min", "fte_max", "fte_mid"), "store_margin_range_pct": ("margin_min_pct", "margin_max_pct", "margin_mid_pct")}
    return normalised(rows, texts, whole, numbers, {c: x for c, x in ranges.items() if c in rows.columns})


def strategy_registry(df: DataFrame, names: dict[str, str], sheet: str, position: str) -> DataFrame:
    """The strategy table: lineage and cleaned texts; rows without a brand are left out."""
    rows = with_lineage(df, names, sheet, position)
    rows = normalised(rows, [n for n in names.values()], [], [], {})
    return rows.where(F.col("brand_name").isNotNull())


def corpus_path(spark: SparkSession, given: str, roots: list[str]) -> str:
    """The first place that exists: the path itself, else below each root in turn."""
    jvm = spark._jvm
    candidates = [given] if PurePosixPath(given).is_absolute() or "://" in given else [given, *(f"{r}/{given}" for r in roots)]
    for path in candidates:
        p = jvm.org.apache.hadoop.fs.Path(path)
        if p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
            return path
    raise FileNotFoundError(f"no corpus at {', '.join(candidates)}")


def dashboard_tables(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame | None]:
    """The tables of a dashboard; None for those that do not exist."""
    out: dict[str, DataFrame | None] = {}
    for name, path in paths.items():
        try:
            out[name] = spark.read.parquet(corpus_path(spark, path, []))
        except FileNotFoundError:
            out[name] = None
    return out
