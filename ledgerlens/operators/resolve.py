"""Entity resolution: exact aliases by an equi-join, close spellings by blocking and a similarity ratio."""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import exprs

HIGH, MEDIUM = 0.93, 0.85
BROADCAST = 100_000  # aliases


def resolve(names: DataFrame, aliases: DataFrame, name: str) -> DataFrame:
    """Adds canonical, match and match_confidence. aliases: (alias_key, canonical), keys unique.

    Blank names are missing (0.0), known keys exact_alias (1.0), others unmatched (0.0).
    """
    keyed = names.withColumn("_k", exprs.resolver_key(F.col(name)))
    n = aliases.count()
    side = aliases.select(F.col("alias_key"), F.col("canonical"))
    joined = keyed.join(F.broadcast(side) if n <= BROADCAST else side, F.col("_k") == F.col("alias_key"), "left")
    blank = F.coalesce(exprs.clean_text(F.col(name)), F.lit("")) == ""
    match = F.when(blank, "missing").when(F.col("canonical").isNotNull(), "exact_alias").otherwise("unmatched")
    return joined.withColumn("match", match).withColumn("match_confidence", F.when(F.col("match") == "exact_alias", 1.0).otherwise(0.0)).drop("_k", "alias_key")


def resolve_fuzzy(names: DataFrame, aliases: DataFrame, name: str) -> DataFrame:
    """As resolve, and for unmatched names the best alias by Ratcliff-Obershelp ratio: 0.9 fuzzy_high from 0.93,
    0.75 fuzzy_medium from 0.85.

    A ratio of r needs 2m / (a + b) >= r common letters, so only aliases that share one of the two-letter pieces and a
    near length are compared: an equi-join on the pieces, no cross join.
    """
    exact = resolve(names, aliases, name)
    open_ = exact.where(F.col("match") == "unmatched").select(exprs.resolver_key(F.col(name)).alias("k")).distinct()

    def pieces(c):
        return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - 1, F.lit(1))), lambda i: F.substr(c, i, F.lit(2))))

    left = open_.withColumn("piece", F.explode(pieces(F.col("k"))))
    right = aliases.withColumn("piece", F.explode(pieces(F.col("alias_key"))))
    near = F.least(F.length("k"), F.length("alias_key")) * 2 >= MEDIUM * (F.length("k") + F.length("alias_key"))
    # frequent pieces would make hot keys: a counted list of aliases is broadcast
    pairs = left.join(F.broadcast(right) if aliases.count() <= BROADCAST // 10 else right, "piece").where(near).select("k", "alias_key", "canonical").distinct()

    def ratios(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            r = [SequenceMatcher(None, x, y).ratio() for x, y in zip(b.column("k").to_pylist(), b.column("alias_key").to_pylist())]
            yield pa.record_batch({"k": b.column("k"), "canonical": b.column("canonical"), "alias_key": b.column("alias_key"), "r": pa.array(r, pa.float64())})

    scored = pairs.mapInArrow(ratios, "k string, canonical string, alias_key string, r double").where(F.col("r") >= MEDIUM)
    best = scored.groupBy("k").agg(F.max_by(F.struct("canonical", "r"), F.struct("r", F.col("alias_key"))).alias("b"))
    out = exact.withColumn("_k", exprs.resolver_key(F.col(name))).join(best, F.col("_k") == F.col("k"), "left")
    use = (F.col("match") == "unmatched") & F.col("b").isNotNull()
    kind = F.when(F.col("b.r") >= HIGH, "fuzzy_high").otherwise("fuzzy_medium")
    out = out.withColumn("canonical", F.when(use, F.col("b.canonical")).otherwise(F.col("canonical")))
    out = out.withColumn("match_confidence", F.when(use, F.when(F.col("b.r") >= HIGH, 0.9).otherwise(0.75)).otherwise(F.col("match_confidence")))
    return out.withColumn("match", F.when(use, kind).otherwise(F.col("match"))).drop("_k", "k", "b")
