"""Secret scans: candidate strings by pattern, false positives removed by a random forest; DataFrame functions and
the JVM's forest only. The forest is trained from labelled findings (``labelled_findings``), composed from fixed rules.
"""

from __future__ import annotations

import random
import string
from collections.abc import Iterator

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import cut, hundreds, maybe_broadcast, table

CANDIDATE = "[A-Za-z0-9_+/=-]{16,}"
LEFT, RIGHT = 48, 16  # characters of context on either side
THRESHOLD = 0.5
MASK = "[secret]"
TREES, DEPTH = 40, 8

#: Words next to a candidate that speak for and against a secret, and words of a path that do.
FOR_WORDS = "token secret apikey api_key api-key key passwd password pwd auth credential bearer private".split()
AGAINST_WORDS = "commit sha sha1 sha256 md5 checksum hash digest integrity uuid guid revision etag example sample dummy placeholder image".split()
TEST_PATHS = "test example sample fixture mock demo doc".split()
#: Words whose letters count as covered by a dictionary.
DICTIONARY = (
    "your here value example sample test change name user file path data index page content class string object value token secret password key "
    "api get set from environment config default client server request response header message number list array function method return version "
    "service account access public private local remote please insert enter replace with this that then the and for tion ing ent ther "
    "mente ción lich heit keit ung eaux elle tre aire"
).split()
CLASSES = "aA90"


# ---------------------------------------------------------------- labelled findings
def labelled_findings(seed: int = 11, n: int = 150) -> Iterator[tuple[str, str, int]]:
    """(text, path, is secret): ``n`` of each kind; each text has at least one candidate, all of one label."""
    rng = random.Random(seed)
    syllables = "the and er on in ti re th en st ou at ed is ing es ha nd or ble ci men de la ro sch ge ver".split()

    def chars(alphabet: str, k: int) -> str:
        return "".join(rng.choices(alphabet, k=k))

    def word(k: int = 0) -> str:
        w = "".join(rng.choices(syllables, k=k or rng.randint(1, 3)))
        return w.capitalize() if rng.random() < 0.15 else w

    def prose(k: int) -> str:
        return " ".join(word()[:14] for _ in range(k))

    hexes, alnum = "0123456789abcdef", string.ascii_letters + string.digits
    kinds = [
        lambda: chars(hexes, rng.choice((32, 40, 40, 64))), lambda: chars(hexes, rng.choice((32, 40))).upper(), lambda: chars(alnum, rng.randint(20, 64)),
        lambda: chars(alnum + "+/", rng.randint(24, 64)) + "=" * rng.randint(0, 2), lambda: chars(alnum + "_-", rng.randint(18, 40)),
    ]
    typed = [lambda: "AKIA" + chars(string.ascii_uppercase + string.digits, 16), lambda: "ghp_" + chars(alnum, 36), lambda: "sk_live_" + chars(alnum, 24), lambda: "xoxb-" + chars(string.digits, 12) + "-" + chars(alnum, 24), lambda: "eyJ" + chars(alnum, 40)]
    names = ["token", "secret", "api_key", "apikey", "password", "passwd", "pwd", "auth_token", "access_key", "client_secret", "private_key", "credential", "key"]
    forms = ['{} = "{}"', "{}: {}", "{}={}", '"{}": "{}"', "{} = '{}'", "{} {}"]
    shouts = (lambda s: s, lambda s: s, lambda s: s.upper() + "!!")
    for _ in range(n):
        for form in forms[:5]:
            yield prose(6) + " " + rng.choice(shouts)(form.format(rng.choice(names), rng.choice(kinds)())) + " " + prose(4), "src", 1
        yield prose(5) + " " + rng.choice(typed)() + " " + prose(3), "src", 1
        yield "Authorization: Bearer " + rng.choice(kinds)() + " " + prose(3), "app", 1
        # not secrets
        long = "".join(rng.choices(syllables, k=rng.randint(8, 12))) + "thention"
        yield prose(6) + " " + rng.choice((long, long.capitalize(), long.upper())) + " " + prose(4), "src", 0
        yield prose(5) + " " + word(1) * rng.randint(9, 20) + " " + prose(3), "src", 0
        yield prose(5) + " " + chars(string.digits, rng.choice((16, 16, 18, 20))) + " " + prose(3), "src", 0
        yield prose(3) + " " + "".join(word(2).capitalize() for _ in range(5)) + "Handler " + prose(2), "src", 0
        yield prose(3) + " " + "_".join(rng.choices(DICTIONARY[:60], k=5)) + " " + prose(2), "src", 0
        yield prose(2) + " " + rng.choice(("commit", "md5", "sha256:", "checksum", "revision", "hash")) + " " + rng.choice(("", '"', "= ")) + chars(hexes, rng.choice((32, 40, 64))) + " " + prose(3), "src", 0
        yield prose(2) + " id " + "-".join(chars(hexes, k) for k in (8, 4, 4, 4, 12)) + " uuid " + prose(3), "src", 0
        yield prose(2) + " /" + "/".join(word(2) for _ in range(5)) + "/index " + prose(2), "src", 0
        yield rng.choice(forms).format(rng.choice(names), rng.choice(("YOUR_TOKEN_GOES_HERE", "x" * rng.randint(16, 40), "example_secret_value", "insert-your-api-key-here", "changeme_changeme_changeme", "0" * 20, "get_token_from_environment", "REPLACE_WITH_PASSWORD"))), "src", 0
        yield rng.choice(forms).format(rng.choice(names), rng.choice(kinds)()), rng.choice(TEST_PATHS) + "s/data", 0
        yield "image data base64 " + chars(alnum + "+/", rng.randint(60, 200)) + " " + prose(2), "src", 0
        yield prose(4) + " " + "-" * rng.randint(16, 40) + " " + "=" * rng.randint(16, 40) + " " + prose(2), "src", 0


# ---------------------------------------------------------------- candidates and features
def candidates(texts: DataFrame) -> DataFrame:
    """Adds nth, start (code points from 0), secret, left and right: a row for each candidate of ``text``."""
    some = texts.where(F.col("text").rlike(CANDIDATE))
    # the text between candidates gives places and contexts without a second search
    parts = some.withColumn("_between", F.split("text", CANDIDATE, -1)).withColumn("_found", F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)))
    both = F.transform(
        "_found",
        lambda c, i: F.struct(
            i.alias("nth"), c.alias("secret"), F.element_at("_between", i + 1).substr(F.greatest(F.length(F.element_at("_between", i + 1)) - LEFT + 1, F.lit(1)), F.lit(LEFT)).alias("left"),
            F.substring(F.element_at("_between", i + 2), 1, RIGHT).alias("right"), (F.length(F.element_at("_between", i + 1))).alias("gap"), F.length(c).alias("length"),
        ),
    )
    placed = F.aggregate(
        both,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<nth:int,secret:string,left:string,right:string,start:int>>").alias("out")),
        lambda a, c: F.struct((a["at"] + c["gap"] + c["length"]).alias("at"), F.array_append(a["out"], F.struct(c["nth"], c["secret"], c["left"], c["right"], (a["at"] + c["gap"]).alias("start"))).alias("out")),
        lambda a: a["out"],
    )
    return parts.select(*texts.columns, F.explode(placed).alias("_c")).drop("text").select("*", "_c.*").drop("_c")


def features(path: Column) -> dict[str, Column]:
    c, left = F.col("secret"), F.lower("left")
    n = F.length(c).cast("double")
    kinds = F.translate(c, string.ascii_lowercase + string.ascii_uppercase + string.digits + "_+/=-", "a" * 26 + "A" * 26 + "9" * 10 + "0" * 5)
    out = {"f_length": n, "f_distinct": F.size(F.array_distinct(F.split(c, ""))) / n}
    for i, a in enumerate(CLASSES):
        out[f"f_share_{i}"] = F.regexp_count(kinds, F.lit(a)) / n
        for j, b in enumerate(CLASSES):
            out[f"f_from_{i}_{j}"] = F.regexp_count(kinds, F.lit(f"(?={a}{b})")) / n
    words = "|".join(sorted(set(DICTIONARY), key=len, reverse=True))
    out["f_words"] = 1 - F.length(F.regexp_replace(F.lower(c), words, "")) / n
    out["f_hex"] = F.regexp_count(c, F.lit("[0-9a-fA-F]")) / n
    out["f_typed"] = c.rlike("^(?:AKIA|gh[pousr]_|sk_live_|xox[abp]-|eyJ)").cast("double")
    out["f_for"] = left.rlike(f"(?:{'|'.join(FOR_WORDS)})").cast("double")
    out["f_for_near"] = left.rlike(rf"(?:{'|'.join(FOR_WORDS)})[\"']?\s*[:=]?\s*[\"']?$").cast("double")
    out["f_for_inside"] = F.lower(c).rlike(f"(?:{'|'.join(FOR_WORDS)})[^=]*=").cast("double")
    out["f_against"] = F.concat(left, F.lit(" "), F.lower("right")).rlike(rf"\b(?:{'|'.join(AGAINST_WORDS)})\b").cast("double")
    out["f_assigned"] = left.rlike("[:=]\\s*[\"']?$").cast("double")
    out["f_quoted"] = (F.col("left").rlike("[\"']$") & F.col("right").rlike("^[\"']")).cast("double")
    out["f_path"] = F.coalesce(F.lower(path).rlike("|".join(TEST_PATHS)).cast("double"), F.lit(0.0))
    return out


def train(spark: SparkSession, seed: int = 11) -> PipelineModel:
    """The forest on the labelled findings; a fixed seed and one partition give the same trees each time."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    rows = [(i, *r) for i, r in enumerate(labelled_findings(seed))]
    texts = spark.createDataFrame(rows, "id long, text string, path string, label int").coalesce(1)
    names = list(features(F.col("path")))
    data = cut(candidates(texts).withColumns(features(F.col("path"))).select(F.col("label").cast("double").alias("label"), *names))
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=7, featuresCol="f_all", labelCol="label", probabilityCol="f_probability", rawPredictionCol="f_raw", predictionCol="f_label")
    return Pipeline(stages=[VectorAssembler(inputCols=names, outputCol="f_all", handleInvalid="keep"), forest]).fit(data)


def judged(texts: DataFrame, model: PipelineModel) -> DataFrame:
    """Candidates of texts(text, path, ...) with their score, the forest's probability of a secret."""
    from pyspark.ml.functions import vector_to_array

    found = candidates(texts).withColumns(features(F.col("path")))
    scored = model.transform(found).withColumn("score", F.element_at(vector_to_array("f_probability"), 2))
    return scored.drop(*[c for c in scored.columns if c.startswith("f_")])


def scan(docs: DataFrame, model: PipelineModel | None = None) -> DataFrame:
    """One row for each secret found: doc_id, start, n_chars (its length), score, sha256 (of the secret, which is not
    itself returned).

    The path is docs.source where there is one. Null and empty texts have no findings; rows with null doc_ids and
    repeated rows are reported each; other columns are not read; an empty table gives no rows.
    """
    model = model or train(docs.sparkSession)
    path = F.col("source").cast("string") if "source" in docs.columns else F.lit("")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", path.alias("path"))
    found = judged(texts, model).where(F.col("score") >= THRESHOLD)
    return found.select("doc_id", F.col("start").cast("long").alias("start"), F.length("secret").cast("long").alias("n_chars"), "score", F.sha2("secret", 256).alias("sha256"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: secrets are masked in the text, n_chars (where there is one) counts anew; no document goes, no
    column changes its place.

    Equal texts of the same source (where there is one) are judged alike, so findings join documents on the hash of both.
    Null and empty texts and repeated rows stay as they are; columns of any name may follow; no documents give none.
    """
    source = F.col("source").cast("string") if "source" in docs.columns else F.lit("")
    key = F.md5(F.concat(F.coalesce("text", F.lit("")), F.lit("\n"), F.coalesce(source, F.lit(""))).cast("binary"))
    texts = docs.select("text", source.alias("path"), key.alias("_key"))
    found = judged(texts, train(spark)).where(F.col("score") >= THRESHOLD)
    # longer secrets first: one may be part of another
    per_text = found.groupBy("_key").agg(F.collect_set(F.struct((-F.length("secret")).alias("n"), "secret")).alias("_s"))
    per_text = cut(per_text.select(F.col("_key").alias("_found"), F.array_sort("_s")["secret"].alias("_secrets")))
    joined = docs.select(F.struct(*docs.columns).alias("_row"), key.alias("_key"))
    joined = joined.join(maybe_broadcast(per_text, hundreds(per_text, F.array_join("_secrets", ""))), F.col("_key") == F.col("_found"), "left")
    text = F.col("_row.text")
    masked = F.when(F.col("_secrets").isNull(), text).otherwise(F.aggregate("_secrets", text, lambda t, s: F.replace(t, s, F.lit(MASK))))
    out = joined.select("_row", "_secrets", masked.alias("_text"))
    changed = {"text": F.col("_text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("_secrets").isNull(), F.col("_row.n_chars")).otherwise(F.length("_text").cast(docs.schema["n_chars"].dataType))
    return out.select(*[changed.get(c, F.col("_row")[c]).alias(c) for c in docs.columns])


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
