"""Reading named tables: dispatch on the path, required and optional tables, CSV templates, JSON columns, dated snapshots."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions import exprs
from ledgerlens.sources import workbook


def _exists(spark: SparkSession, path: str) -> bool:
    """Asks the path's own file system, which need not be local."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _names(spark: SparkSession, path: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found, todo = [], [p]
    while todo:
        for s in fs.listStatus(todo.pop()):
            if s.isDirectory() and not s.getPath().getName().endswith(".parquet"):
                todo.append(s.getPath())
            else:
                found.append(s.getPath().toString())
    return sorted(found)


def read(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """Parquet, CSV (all columns text, blanks kept), JSON or the first sheet of a workbook, by the path's ending."""
    if path.endswith(".xlsx"):
        return workbook.read_sheet(spark, path)
    if path.endswith(".xls"):
        raise ValueError(f"{path}: save it as .xlsx, CSV or Parquet; the binary format is not read here")
    if path.endswith(".csv"):
        return spark.read.csv(path, header=header, inferSchema=False, nullValue="\u0000", emptyValue="", multiLine=True, escape='"')
    if path.endswith((".json", ".jsonl")):
        return spark.read.json(path, multiLine=path.endswith(".json"))
    return spark.read.parquet(path)


def load_tables(spark: SparkSession, folder: str, names: list[str], ending: str = "parquet") -> dict[str, DataFrame]:
    """All tables; one error that lists every missing one. A nested ``silver`` folder is found."""
    for base in (folder, f"{folder}/silver"):
        missing = [n for n in names if not _exists(spark, f"{base}/{n}.{ending}")]
        if not missing:
            return {n: read(spark, f"{base}/{n}.{ending}") for n in names}
    raise ValueError(f"{folder}: missing tables {', '.join(sorted(n for n in names if not _exists(spark, f'{folder}/{n}.{ending}')))}")


def load_optional(spark: SparkSession, folder: str, schemas: dict[str, T.StructType]) -> tuple[dict[str, DataFrame], list[str]]:
    """Tables that may be missing: an empty one with the schema stands in, and a warning says so."""
    out, warnings = {}, []
    for name, schema in schemas.items():
        path = f"{folder}/{name}.parquet"
        if _exists(spark, path):
            out[name] = read(spark, path)
        else:
            out[name] = spark.createDataFrame([], schema)
            warnings.append(f"{name} is missing")
    return out, warnings


def load_templates(spark: SparkSession, folder: str, templates: dict[str, list[str]]) -> tuple[DataFrame, list[str]]:
    """Union by name of the CSV files that fit a template (file name -> required headers); other names and extra columns
    warn, missing columns raise."""
    frames, warnings = [], []
    for path in _names(spark, folder):
        name = path.rsplit("/", 1)[-1]
        if not name.endswith(".csv"):
            continue
        if name not in templates:
            warnings.append(f"{name} is no known template")
            continue
        df = read(spark, path)
        if missing := [c for c in templates[name] if c not in df.columns]:
            raise ValueError(f"{name}: missing columns {', '.join(missing)}")
        warnings += [f"{name}: unexpected column {c}" for c in df.columns if c not in templates[name]]
        frames.append(df.withColumn("source_file", F.lit(name)))
    if not frames:
        return spark.createDataFrame([], "source_file string"), warnings
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames), warnings


def standardise(df: DataFrame, template: str, metrics: dict[str, list[str]], scope: dict[str, str] | None = None, comparable: str = "direct_comparable") -> DataFrame:
    """The unified reference columns: first non-blank of the alternative metric columns, only where the scope allows;
    rows without a name are skipped, the row's own canonical name wins over the given one."""
    def first(columns: list[str]) -> Column:
        present = [exprs.safe_double(F.col(c)) for c in columns if c in df.columns]
        return F.coalesce(*present) if present else F.lit(None).cast("double")

    out = df.where(exprs.clean_text(F.col("brand_name")).isNotNull())
    named = {m: F.when(F.lower(F.trim(F.col(scope[m]))) == comparable, first(c)) if scope and m in scope and scope[m] in df.columns else first(c) for m, c in metrics.items()}
    canonical = F.coalesce(exprs.clean_text(F.col("canonical_brand_name")), exprs.display_name(F.col("brand_name"))) if "canonical_brand_name" in df.columns else exprs.display_name(F.col("brand_name"))
    keep = [c for c in ("source_type", "source_name", "source_url_or_doc_id", "method_reported_or_estimated", "notes", "currency", "geography") if c in df.columns]
    dates = F.try_to_date(F.col("as_of_date"), "yyyy-MM-dd") if "as_of_date" in df.columns else F.lit(None).cast("date")
    confidence = exprs.clamped(exprs.safe_double(F.col("confidence_score"))) if "confidence_score" in df.columns else F.lit(None).cast("double")
    return out.select(F.trim("brand_name").alias("brand_name"), canonical.alias("canonical_brand_name"), F.lit(template).alias("template"), *[exprs.clean_text(F.col(c)).alias(c) for c in keep], dates.alias("as_of_date"), confidence.alias("confidence_score"), *[v.alias(m) for m, v in named.items()])


def parse_json_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Adds name_parsed by the given type; blank is null; text that is no such JSON stays in the original column."""
    return df.withColumns({f"{c}_parsed": F.from_json(exprs.clean_text(F.col(c)), t) for c, t in columns.items()})


def load_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """The dated snapshots; a filter on as_of_date prunes folders."""
    return spark.read.parquet(folder)


def load_query_fixture(text: str) -> list[dict]:
    """A list of queries, or an object with a list under ``queries``."""
    got = json.loads(text)
    got = got.get("queries") if isinstance(got, dict) else got
    if not isinstance(got, list) or not all(isinstance(x, dict) for x in got):
        raise ValueError("a query fixture is a list of objects, or an object with such a list under queries")
    return got


def corpus(parts: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """One text corpus of several tables: kind -> (table with doc_id and title, columns whose names and values make the text)."""
    rows = []
    for kind, (df, columns) in parts.items():
        lines = [F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{c}: "), F.col(c).cast("string"))) for c in columns]
        rows.append(df.select(F.concat(F.lit(f"{kind}:"), exprs.slug(F.col("doc_id").cast("string"))).alias("doc_id"), F.lit(kind).alias("source_kind"), F.col("title").cast("string").alias("title"), F.concat_ws("\n", F.col("title").cast("string"), *lines).alias("text")))
    return reduce(lambda a, b: a.unionByName(b), rows)
