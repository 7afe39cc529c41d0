"""Writing results: tables, publishable and blocked subsets, dated snapshots, manifests with digests, audit records."""

from __future__ import annotations

import json
from datetime import UTC, datetime
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def guard(path: str, allowed: str, forbidden: list[str]) -> str:
    """The path, if it lies under ``allowed`` and under none of ``forbidden``; roots may not overlap."""
    inside = lambda a, b: PurePosixPath(b) in [PurePosixPath(a), *PurePosixPath(a).parents]
    if ".." in PurePosixPath(path).parts:
        raise ValueError(f"{path} climbs out of its root")
    for root in forbidden:
        if inside(allowed, root) or inside(root, allowed):
            raise ValueError(f"the roots {allowed} and {root} overlap")
        if inside(path, root):
            raise ValueError(f"{path} lies under {root}")
    if not inside(path, allowed):
        raise ValueError(f"{path} lies outside {allowed}")
    return path


def flat(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, nulls kept."""
    nested = [f.name for f in df.schema if f.dataType.typeName() in ("array", "struct", "map")]
    return df.withColumns({c: F.to_json(c, {"ignoreNullFields": "false"}) for c in nested}) if nested else df


def write_table(df: DataFrame, path: str, also_csv: bool = False) -> None:
    out = flat(df)
    out.write.mode("overwrite").parquet(path)
    if also_csv:
        out.write.mode("overwrite").csv(path.removesuffix(".parquet") + ".csv", header=True)


def write_gate(decisions: DataFrame, folder: str) -> None:
    """All decisions once, partitioned by status; the publishable and blocked subsets are reads of their folders."""
    flat(decisions).write.mode("overwrite").partitionBy("status").parquet(f"{folder}/gold_publish_decisions")


def read_gate(spark: SparkSession, folder: str, status: str | None = None) -> DataFrame:
    df = spark.read.parquet(f"{folder}/gold_publish_decisions")
    return df if status is None else df.where(F.col("status") == status)


def write_snapshot(df: DataFrame, folder: str, as_of_date: str) -> None:
    """Replaces the date's folder and no other."""
    out = df.withColumn("as_of_date", F.lit(as_of_date).cast("date"))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("as_of_date").parquet(folder)


def snapshot_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(folder).groupBy("as_of_date").agg(F.count("*").alias("rows")).orderBy("as_of_date")


def write_corpus(chunks: DataFrame, folder: str) -> None:
    chunks.write.mode("overwrite").parquet(f"{folder}/corpus.parquet")
    chunks.write.mode("overwrite").json(f"{folder}/corpus.jsonl")


def digests(spark: SparkSession, path: str) -> DataFrame:
    """name and sha256 of every file below a path, computed where the files are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "length", F.sha2("content", 256).alias("sha256"))


def manifest(spark: SparkSession, command: str, outputs: list[str], counts: dict[str, int], upstream: list[str]) -> str:
    """JSON of what a command wrote: digests of its files, counts, and the manifests it used."""
    files = {p: [r.asDict() for r in digests(spark, p).orderBy("name").collect()] for p in outputs}
    return json.dumps({"command": command, "created_at": datetime.now(UTC).isoformat(), "outputs": files, "counts": counts, "upstream": upstream}, ensure_ascii=False, sort_keys=True)


def audit_record(command: str, error: BaseException | None = None) -> str:
    return json.dumps({"command": command, "at": datetime.now(UTC).isoformat(), "status": "failure" if error else "success", "error": type(error).__name__ if error else None})


def markdown(findings: DataFrame, title: str, limit: int = 50) -> str:
    """A short report of the first findings by severity."""
    rows = findings.orderBy("severity", "check_name").limit(limit).collect()
    lines = [f"# {title}", "", *(f"- **{r['severity']}** `{r['check_name']}`" for r in rows)]
    return "\n".join(lines) + "\n"


def redacted(settings: dict[str, str]) -> dict[str, str]:
    """Settings for a log: values of secret-looking names are masked."""
    secret = ("key", "token", "secret", "password")
    return {k: "***" if any(s in k.lower() for s in secret) and v else v for k, v in settings.items()}


# ---------------------------------------------------------------- small files of a run, through the tables' file system
def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small text file wherever Spark writes its tables."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def write_manifest(spark: SparkSession, folder: str, command: str, outputs: list[str], counts: dict[str, int], upstream: list[str]) -> str:
    """The manifest under its command and time, and again as latest.json of the command; its path."""
    text = manifest(spark, command, outputs, counts, upstream)
    path = f"{folder}/{command}/manifest-{datetime.now(UTC):%Y%m%dT%H%M%S%f}.json"
    put_text(spark, path, text)
    put_text(spark, f"{folder}/{command}/latest.json", text)
    return path


def write_audit(spark: SparkSession, folder: str, command: str, error: BaseException | None = None) -> str:
    """One file a command run."""
    path = f"{folder}/{command}-{datetime.now(UTC):%Y%m%dT%H%M%S%f}.json"
    put_text(spark, path, audit_record(command, error))
    return path


def write_reports(spark: SparkSession, folder: str, scorecards: DataFrame, subject: str, overall: str, limit: int = 1000) -> list[str]:
    """An index and a Markdown, HTML and JSON report of each subject, at most ``limit`` (more raise): one small row each."""
    from html import escape

    rows = scorecards.orderBy(subject).limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} subjects: write the scorecards as a table")
    names = []
    for n, row in enumerate(rows):
        facts = row.asDict(recursive=True)
        name = "".join(c if c.isalnum() else "-" for c in str(facts[subject]).lower()).strip("-") or "subject"
        name = f"{name}-{n}" if name in names else name
        names.append(name)
        shown = [(k, ", ".join(map(str, v)) if isinstance(v, list) else v) for k, v in facts.items() if k != subject]
        put_text(spark, f"{folder}/{name}.md", f"# {facts[subject]}\n\n" + "".join(f"- {k}: {v}\n" for k, v in shown))
        put_text(spark, f"{folder}/{name}.html", f"<h1>{escape(str(facts[subject]))}</h1><ul>" + "".join(f"<li>{escape(k)}: {escape(str(v))}</li>" for k, v in shown) + "</ul>")
        put_text(spark, f"{folder}/{name}.json", json.dumps(facts, ensure_ascii=False, default=str, sort_keys=True))
    put_text(spark, f"{folder}/index.md", overall + "\n" + "".join(f"- [{r[subject]}]({n}.md)\n" for r, n in zip(rows, names)))
    return names


def write_rollup(spark: SparkSession, df: DataFrame, folder: str, name: str, report: str) -> None:
    """A table with its Markdown report, and a JSON form of its rows beside it."""
    write_table(df, f"{folder}/{name}.parquet")
    flat(df).write.mode("overwrite").json(f"{folder}/{name}.jsonl")
    put_text(spark, f"{folder}/{name}.md", report)


def dashboard_json(tables: dict[str, DataFrame | None], limit: int = 200) -> str:
    """What a dashboard shows: the first rows of each table, or that it is missing."""
    return json.dumps({n: None if df is None else [r.asDict(recursive=True) for r in df.limit(limit).collect()] for n, df in tables.items()}, ensure_ascii=False, default=str)


def bundle(spark: SparkSession, tables: dict[str, str], folder: str) -> str:
    """Copies tables into one folder, with a manifest of their files; the manifest's path."""
    for name, path in tables.items():
        spark.read.parquet(path).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return write_manifest(spark, f"{folder}/manifests", "bundle", [f"{folder}/{n}.parquet" for n in tables], {}, list(tables.values()))
