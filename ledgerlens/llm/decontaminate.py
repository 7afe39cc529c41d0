"""Benchmark decontamination by templates, in DataFrame functions only.

Numbers, names and units become typed placeholders; windows of the template hash-join those of the benchmark items;
the slots of aligned windows must then map one to one. Equal values mean a verbatim copy, other consistent ones a
re-parameterised question; inconsistent ones are no match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import cut, maybe_broadcast, table

WINDOW = 8  # template tokens of a window
NEED = 13  # item tokens that matching windows must cover (all of a shorter item, all that its windows can cover)
LITERALS = 5  # windows need as many tokens that are no placeholders; items without such a window match as a whole

NUM, NAME, UNIT = "\ue001", "\ue002", "\ue003"  # private-use signs; those of the texts count as white space
SPACE_RE = r"[\s\ue001-\ue003]+"
#: Words that are units where they follow a number.
UNITS = (
    "mm cm m km inch inches foot feet ft yard yards mile miles mg g kg gram grams kilogram kilograms pound pounds lb lbs ounce ounces oz ton tons "
    "ml l litre litres liter liters gallon gallons s sec second seconds min minute minutes h hour hours day days week weeks month months year years "
    "percent dollar dollars euro euros cent cents usd eur degrees degree kmh mph watt watts volt volts joule joules newton newtons hz byte bytes kb mb gb"
).split()
#: Possessive repeats (``*+``): the JVM matches them in a loop; others recurse once a repeat and a long list ends the executor.
NUM_RE = r"[+-]?[0-9]+(?:[.,:/-][0-9]+)*+%?"
UNIT_RE = rf"(?<={NUM}) ?(?:{'|'.join(sorted(UNITS, key=len, reverse=True))})(?![\p{{L}}\p{{N}}])"
#: Words that are no names where a sentence starts with them.
STARTERS = (
    "the a an if in on at of to for from by with and or but so as is are was were be been has have had do does did will would can could may might must "
    "shall should it its he she they we you his her their our your my this that these those there here what which who whom whose when where why how "
    "then than not no all any each every some both few many much more most other such only own same let find given after before while during since "
    "until about between into over under again once suppose assume calculate determine"
).split()
NAME_WORD = r"(?=\p{Lu})(?<![\p{L}\p{M}])(?!(?:" + "|".join(sorted({w.capitalize() for w in STARTERS})) + r")(?!\p{L}))\p{Lu}\p{Ll}++(?!\p{L})"
NAME_RE = rf"{NAME_WORD}(?: {NAME_WORD})*+"


def _steps(text: Column, names: bool = True) -> tuple[Column, Column, Column]:
    """The text with numbers, then units, then names replaced."""
    numbers = F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_RE, " "), NUM_RE, NUM)
    units = F.regexp_replace(numbers, UNIT_RE, f" {UNIT}")
    return numbers, units, F.regexp_replace(units, NAME_RE, NAME) if names else units


def template(text: Column, names: bool = True) -> Column:
    """Lower-cased words and placeholders; punctuation separates. Without ``names`` they stay words."""
    plain = F.regexp_replace(_steps(text, names)[2], rf"([{NUM}{NAME}{UNIT}])", " $1 ")
    return F.filter(F.split(F.regexp_replace(F.lower(plain), rf"[^\p{{L}}\p{{M}}{NUM}{NAME}{UNIT}]+", " "), " "), lambda w: w != "")


def slots(text: Column, names: bool = True) -> Column:
    """The replaced values in order, by placeholder."""
    squeezed = F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_RE, " ")
    numbers, units, _ = _steps(text)
    of_names = F.regexp_extract_all(units, F.lit(NAME_RE), F.lit(0)) if names else F.array().cast("array<string>")
    return F.struct(F.regexp_extract_all(squeezed, F.lit(NUM_RE), F.lit(0)).alias("num"), F.regexp_extract_all(numbers, F.lit(UNIT_RE), F.lit(0)).alias("unit"), of_names.alias("name"))


def _text_key() -> Column:
    """128 bits, so that no two texts of any corpus share a key."""
    return F.md5(F.coalesce("text", F.lit("")).cast("binary"))


def _value(tokens: Column, values: Column, at: Column) -> Column:
    """The value behind the placeholder at a place (from 0), lower-cased."""
    mark = F.element_at(tokens, at + 1)
    nth = F.size(F.filter(F.slice(tokens, 1, at + 1), lambda w: w == mark))
    kinds = F.when(mark == NUM, values["num"]).when(mark == UNIT, values["unit"]).otherwise(values["name"])
    return F.trim(F.lower(F.try_element_at(kinds, nth)))


def _windows(tokens: Column, size: int | Column) -> Column:
    last = F.size(tokens) - size
    made = F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(i.alias("at"), F.xxhash64(F.slice(tokens, i + 1, size)).alias("h"), F.lit(size).alias("s")))
    return F.when(last >= 0, made).otherwise(F.array().cast("array<struct<at:int,h:bigint,s:int>>"))


def _covered(at: Column, size: Column) -> Column:
    """Aggregate: the number of places that windows cover."""
    return F.size(F.array_distinct(F.flatten(F.collect_list(F.sequence(at, at + size - 1)))))


def contaminated_texts(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(key, item_id, n_tokens, coverage, kind) of each text, by its ``_text_key``, and item that it holds."""
    # each item as a template with names, and one without (bare) for verbatim texts in other letter case; ``item`` tells them apart
    forms = F.explode(F.array(*[F.struct(template(F.col("text"), x).alias("tokens"), slots(F.col("text"), x).alias("values"), F.lit(not x).alias("bare")) for x in (True, False)])).alias("form")
    items = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    items = items.select("item_id", _text_key().alias("text_key"), forms).select("item_id", "form.*", F.md5(F.concat_ws(" ", "item_id", "text_key", F.array_join("form.tokens", " ")).cast("binary")).alias("item"))
    literals = lambda tokens: F.size(F.filter(tokens, lambda w: ~w.isin(NUM, NAME, UNIT)))
    items = items.withColumns({"n": F.size("tokens"), "few": literals("tokens") < LITERALS}).where((F.col("n") >= WINDOW) | ~F.col("few"))
    # alike: the values of placeholders must be the same, not only consistent
    items = cut(items.groupBy("item", "item_id", "tokens", "values", "n").agg(F.min(F.col("few") | F.col("bare")).alias("alike")))

    # items shorter than a window are one window of their own length
    size = F.least("n", F.lit(WINDOW))
    rows = items.select("item", "n", "alike", "tokens", F.explode(_windows(F.col("tokens"), size)).alias("w"))
    rows = rows.where(literals(F.slice("tokens", F.col("w.at") + 1, F.col("w.s"))) >= LITERALS)
    rows = rows.select("item", "n", "alike", F.col("w.s").alias("size"), F.col("w.at").alias("item_at"), F.col("w.h").alias("item_h"))
    reach = rows.groupBy("item").agg(_covered(F.col("item_at"), F.col("size")).alias("need"))
    rows = rows.join(reach, "item")
    # placeholder-rich items without a window: the whole template; with few literals the values must be the same
    whole = items.join(reach, "item", "left_anti").select("item", "n", F.col("n").alias("size"), F.lit(0).alias("item_at"), F.xxhash64("tokens").alias("item_h"), F.col("n").alias("need"), "alike")
    wanted = cut(rows.unionByName(whole).withColumn("need", F.least("need", "n", F.lit(NEED))))
    sizes = sorted(r["size"] for r in wanted.select("size").distinct().collect())
    if not sizes:
        return docs.sparkSession.createDataFrame([], "key string, item_id long, n_tokens long, coverage double, kind string")

    texts = docs.select(_text_key().alias("key"), template(F.col("text")).alias("tokens"))
    all_windows = F.concat(*[_windows(F.col("tokens"), s) for s in sizes])
    seen = texts.select("key", F.explode(all_windows).alias("w")).select("key", F.col("w.at").alias("at"), F.col("w.h").alias("h"), F.col("w.s").alias("s"))
    hits = seen.join(maybe_broadcast(wanted, wanted.count()), (F.col("h") == F.col("item_h")) & (F.col("s") == F.col("size")))
    hits = cut(hits.select("key", "item", "n", "need", "alike", "size", "item_at", (F.col("at") - F.col("item_at")).alias("shift")).distinct())

    # slots of the aligned tokens: read the texts that have hits once more
    marks = items.select(F.col("item").alias("m_item"), "tokens", "values", F.posexplode("tokens").alias("place", "token")).where(F.col("token").isin(NUM, NAME, UNIT))
    marks = cut(marks.select("m_item", "place", _value(F.col("tokens"), F.col("values"), F.col("place")).alias("theirs")))
    keys = hits.select("key").distinct()
    again = docs.select(_text_key().alias("key"), "text").join(maybe_broadcast(keys, keys.count()), "key", "left_semi").groupBy("key").agg(F.first("text").alias("text"))
    again = again.select("key", template(F.col("text")).alias("tokens"), slots(F.col("text")).alias("values"))
    placed = hits.join(maybe_broadcast(marks, marks.count()), (F.col("item") == F.col("m_item")) & F.col("place").between(F.col("item_at"), F.col("item_at") + F.col("size") - 1))
    placed = placed.select("key", "item", "shift", "place", "theirs").distinct()
    pairs = placed.join(again, "key").select("key", "item", "shift", "theirs", _value(F.col("tokens"), F.col("values"), F.col("place") + F.col("shift")).alias("ours"))
    # where a passage begins or ends, a name may run on into its neighbour
    theirs, ours, gap = F.col("theirs"), F.col("ours"), F.lit(" ")
    runs_on = ours.endswith(F.concat(gap, theirs)) | ours.startswith(F.concat(theirs, gap)) | theirs.endswith(F.concat(gap, ours)) | theirs.startswith(F.concat(ours, gap))
    pairs = pairs.withColumn("ours", F.when(runs_on, theirs).otherwise(ours))
    judged = pairs.groupBy("key", "item", "shift").agg(F.countDistinct("theirs").alias("a"), F.countDistinct("ours").alias("b"), F.countDistinct("theirs", "ours").alias("c"), F.min(F.col("theirs") == F.col("ours")).alias("same"))
    judged = judged.select(F.col("key").alias("j_key"), F.col("item").alias("j_item"), F.col("shift").alias("j_shift"), ((F.col("a") == F.col("b")) & (F.col("b") == F.col("c"))).alias("consistent"), "same")

    kept = hits.join(judged, (F.col("key") == F.col("j_key")) & (F.col("item") == F.col("j_item")) & (F.col("shift") == F.col("j_shift")), "left").where("(consistent or consistent is null) and (not alike or coalesce(same, true))")
    covered = _covered(F.col("item_at"), F.col("size"))
    out = kept.groupBy("key", "item").agg(covered.cast("long").alias("n_tokens"), F.max("n").alias("n"), F.max("need").alias("need"), F.min(F.coalesce("same", F.lit(True))).alias("same"))
    out = out.where(F.col("n_tokens") >= F.col("need")).withColumn("coverage", F.col("n_tokens") / F.col("n"))
    # of an item's forms, and of the items with one id, the one best covered
    best = F.max_by(F.struct("n_tokens", "coverage", "same"), F.struct("coverage", "n_tokens", "same")).alias("b")
    out = out.join(items.select("item", "item_id"), "item").groupBy("key", "item_id").agg(best)
    return cut(out.select("key", "item_id", "b.n_tokens", "b.coverage", F.when(F.col("b.same"), "verbatim").otherwise("re-parameterised").alias("kind")))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each row of docs and benchmark item that it holds: doc_id, item_id, n_tokens (of the item, that
    matching windows cover), coverage and kind.

    Null and empty texts hold nothing, nor do items whose text is null or has fewer than five words besides
    placeholders and fewer than eight with them. Only windows with five words besides placeholders are searched, and no
    more is asked than they can cover; items without such a window are found as a whole, those with fewer than five
    words besides placeholders only with the same values. Equal texts are judged once and every row of them is reported, those with a null doc_id too.
    A text is searched as a template with names and, for texts in other letter case, items also as one without.
    Repeated items count once, of different items with one id the best covered is reported; null item_ids and other
    columns are not read. Empty tables give no rows.
    """
    found = contaminated_texts(docs, benchmark)
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text_key().alias("key"))
    return keyed.join(maybe_broadcast(found, found.count()), "key").select("doc_id", "item_id", "n_tokens", "coverage", "kind")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that hold a benchmark item go. Columns and their order stay.

    Null and empty texts stay; repeated rows stay or go together; columns of any name may follow; no documents, or an
    empty benchmark, give the documents as they are.
    """
    keys = contaminated_texts(docs, table(spark, sf_dir, "benchmark")).select(F.col("key").alias("_key")).distinct()
    keyed = docs.select(F.struct(*docs.columns).alias("_row"), _text_key().alias("_text_key"))
    return keyed.join(maybe_broadcast(keys, keys.count()), F.col("_text_key") == F.col("_key"), "left_anti").select("_row.*")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
