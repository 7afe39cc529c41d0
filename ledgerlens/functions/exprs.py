"""Column helpers: parsing, cleaning, grading and digits, all inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Grade ladders, best first.
RELATIVE_GRADES = [(0.02, "A"), (0.05, "B"), (0.10, "C"), (0.20, "D")]
RANK_GRADES = [(0, "A"), (1, "B"), (3, "C"), (5, "D")]
CONFIDENCE_GRADES = [(0.9, "A"), (0.75, "B"), (0.6, "C"), (0.4, "D")]
GRADE_ORDER = ["A", "B", "C", "D", "F"]
#: Typographic signs and the ASCII ones they become; letters with accents and their bases.
SIGNS = ("‘’‚“”„‐‑‒–—―−", "'''\"\"\"-------")
ACCENTS = ("àáâãäåçèéêëìíîïñòóôõöùúûüýÿÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝ", "aaaaaaceeeeiiiinooooouuuuyyAAAAAACEEEEIIIINOOOOOUUUUY")


def clean_text(c: Column, nan_is_null: bool = False) -> Column:
    """Trimmed text, blank as null; optionally the word nan too."""
    t = F.nullif(F.trim(c), F.lit(""))
    return F.when(F.lower(t) != "nan", t) if nan_is_null else t


def normalise_newlines(c: Column) -> Column:
    return clean_text(F.regexp_replace(c, "\r\n?", "\n"))


def safe_double(c: Column) -> Column:
    """The number in a text: everything but digits, points and minus signs goes; what is then no number is null."""
    return F.regexp_replace(c, r"[^0-9.\-]", "").try_cast("double")


def whole_number(c: Column) -> Column:
    """Half-even rounding to a long."""
    return F.bround(c.try_cast("double"), 0).cast("long")


def numeric_range(c: Column) -> Column:
    """struct(low, high, mid) of texts like ``6-8`` or ``8–12%``; signs are separators, so ``-5`` is 5."""
    parts = F.filter(F.split(F.replace(F.trim(c), F.lit(","), F.lit("")), r"\s*[-–—~]\s*"), lambda p: F.trim(p) != "")
    numbers = F.transform(parts, safe_double)
    low, high = F.try_element_at(numbers, F.lit(1)), F.try_element_at(numbers, F.size(numbers))
    ok = F.size(numbers).between(1, 2) & low.isNotNull() & high.isNotNull()
    return F.struct(F.when(ok, low).alias("low"), F.when(ok, high).alias("high"), F.when(ok, (low + high) / 2).alias("mid"))


def plain_letters(c: Column) -> Column:
    """Typographic signs and accented letters as ASCII (a fixed map stands for compatibility decomposition)."""
    return F.translate(F.translate(c, *SIGNS), *ACCENTS)


def display_name(c: Column) -> Column:
    return F.trim(F.regexp_replace(plain_letters(c), r"\s+", " "))


def lookup_key(c: Column) -> Column:
    """Parser's key: ``&`` goes with all other signs."""
    return F.regexp_replace(F.lower(display_name(c)), "[^a-z0-9]+", "")


def resolver_key(c: Column) -> Column:
    """Resolver's key: ``&`` is ``and``; accents are dropped with their letters."""
    return F.regexp_replace(F.replace(F.lower(F.trim(c)), F.lit("&"), F.lit("and")), "[^a-z0-9]+", "")


def slug(c: Column, sign: str = "-") -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", sign), f"^{sign}+|{sign}+$", "")


def ladder(c: Column, steps: list, last: str, missing: str = "MISSING", falling: bool = False) -> Column:
    """The first step that c does not exceed (or, falling, reaches); null is missing."""
    out = F.when(c.isNull(), missing)
    for bound, name in steps:
        out = out.when(c >= bound if falling else c <= bound, name)
    return out.otherwise(last)


def relative_grade(error: Column) -> Column:
    return ladder(error, RELATIVE_GRADES, "F")


def rank_grade(difference: Column) -> Column:
    return ladder(difference, RANK_GRADES, "F")


def confidence_grade(score: Column) -> Column:
    return ladder(score, CONFIDENCE_GRADES, "F", falling=True)


def confidence_tier(score: Column) -> Column:
    return ladder(score, [(0.9, "high"), (0.75, "medium")], "low", "missing", falling=True)


def worst_grade(*grades: Column) -> Column:
    """The worst of the grades, MISSING left out; MISSING if there is no other."""
    places = [F.array_position(F.array(*map(F.lit, GRADE_ORDER)), g) for g in grades]
    at = F.greatest(*places) if len(places) > 1 else places[0]
    return F.when(at > 0, F.element_at(F.array(*map(F.lit, GRADE_ORDER)), F.greatest(at, F.lit(1)).cast("int"))).otherwise("MISSING")


def leading_digits(c: Column, n: int) -> Column:
    """The first n significant digits of a positive number, else null."""
    power = F.floor(F.log10(c))
    lead = F.floor(c / F.pow(F.lit(10.0), power - (n - 1)))
    return F.when(c > 0, F.greatest(F.lit(10 ** (n - 1)), F.least(F.lit(10**n - 1), lead)).cast("int"))


def end_digit(c: Column) -> Column:
    return (F.abs(F.rint(c)) % 10).cast("int")


def share_z(share: Column, expected: float, n: Column) -> Column:
    """z of a share against an expected proportion."""
    return F.try_divide(share - expected, F.sqrt(F.lit(expected * (1 - expected)) / n))


def franchise_share(c: Column) -> Column:
    """Share from texts such as ``95%加盟``: franchised, else licensed, else one minus company-operated."""

    def percent(word: str) -> Column:
        return F.nullif(F.regexp_extract(c, rf"([0-9]+(?:\.[0-9]+)?)\s*%{word}", 1), F.lit("")).try_cast("double") / 100

    own = percent("直营")
    return F.coalesce(percent("加盟"), percent("授权"), F.when(own.isNotNull(), F.greatest(F.lit(0.0), 1 - own)))


def json_list(c: Column) -> Column:
    """Null, blank or nan: empty; a JSON list; a list with bars; one value. Trimmed, blanks left out."""
    t = clean_text(c, nan_is_null=True)
    raw = F.when(t.isNull(), F.array().cast("array<string>")).when(t.startswith("["), F.from_json(t, "array<string>")).when(t.contains("|"), F.split(t, r"\|")).otherwise(F.array(t))
    return F.filter(F.transform(F.coalesce(raw, F.array(t)), lambda x: F.trim(x)), lambda x: x != "")


def parse_flag(c: Column) -> Column:
    """1, true, yes, y; 0, false, no, n or blank; anything else null (an error of the caller's)."""
    t = F.lower(F.trim(F.coalesce(c, F.lit(""))))
    return F.when(t.isin("1", "true", "yes", "y"), True).when(t.isin("0", "false", "no", "n", ""), False)


def distinct_texts(c: Column) -> Column:
    """Trimmed, without blanks and repeats, first occurrences in order."""
    return F.array_distinct(F.filter(F.transform(c, lambda x: F.trim(x)), lambda x: x != ""))


def tokens(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit("([a-z0-9']+)"), F.lit(1))


def clamped(c: Column, low: float = 0.0, high: float = 1.0) -> Column:
    """Within bounds; null stays null (least and greatest alone would take the bound)."""
    return F.when(c.isNotNull(), F.least(F.lit(high), F.greatest(F.lit(low), c)))


def half_even(c: Column, places: int = 6) -> Column:
    return F.bround(c, places)
