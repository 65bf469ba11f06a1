"""Spellings: door numbers, street names, zones, floors; and the likeness of names."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gablewise.model import MONTHS


def norm_door(text: Column) -> Column:
    """Upper case without white space, / for -, without a leading No.; and 16-Jul is 16/7, Jan-13 is 1/13."""
    s = F.upper(F.trim(text))
    months = F.array(*[F.lit(m) for m in MONTHS])
    day_first, month_first = F.regexp_extract(s, r"^([0-9]{1,2})-([A-Z]{3})$", 1), F.regexp_extract(s, r"^([A-Z]{3})-([0-9]{1,2})$", 2)
    m1 = F.array_position(months, F.regexp_extract(s, r"^([0-9]{1,2})-([A-Z]{3})$", 2))
    m2 = F.array_position(months, F.regexp_extract(s, r"^([A-Z]{3})-([0-9]{1,2})$", 1))
    number = lambda c: c.try_cast("int").cast("string")
    plain = F.regexp_replace(s, r"^(D\.?\s*NO\.?|DOOR\s*NO\.?|NO\.?|#)\s*[:.\-]?\s*", "")
    plain = F.replace(F.regexp_replace(plain, r"\s+", ""), F.lit("-"), F.lit("/"))
    return (
        F.when((day_first != "") & (m1 > 0), F.concat(number(day_first), F.lit("/"), m1.cast("string")))
        .when((month_first != "") & (m2 > 0), F.concat(m2.cast("string"), F.lit("/"), number(month_first)))
        .otherwise(plain)
    )


def norm_zone(text: Column) -> Column:
    """'ZONE-B' is B; anything but a zone of A, B or C is null."""
    return F.nullif(F.upper(F.regexp_extract(text, r"(?i)^\s*(?:zone[-\s]*)?([abc])\s*$", 1)), F.lit(""))


def norm_unit(text: Column) -> Column:
    """An id in upper case, with _p before a part's number."""
    return F.regexp_replace(F.upper(F.trim(text)), r"_P(\d+)$", "_p$1")


def name_key(text: Column) -> Column:
    """One key for the spellings of a street's name: letters and digits, no word for street at the end, no repeats, th for dh."""
    s = F.regexp_replace(F.lower(text), "[^a-z0-9]", "")
    cut = F.regexp_replace(s, r"(street|st|road|rd)(\d*)$", "$2")
    s = F.when(cut == "", s).otherwise(cut)
    return F.replace(F.regexp_replace(s, r"(.)\1+", "$1"), F.lit("dh"), F.lit("th"))


def tidy_spelling(text: Column) -> Column:
    """A spelling without marks at its ends; in title case if it is all of one case."""
    s = F.regexp_replace(text, r"^[ ,.;\-]+|[ ,.;\-]+$", "")
    return F.when((s == F.upper(s)) | (s == F.lower(s)), F.initcap(s)).otherwise(s)


def norm_usage(usage: Column) -> Column:
    """Letters in lower case; a missing usage is the word none, so that it differs from an empty one."""
    return F.regexp_replace(F.lower(F.coalesce(usage, F.lit("None"))), "[^a-z]", "")


def floors_text(floors: Column) -> Column:
    return F.when(floors == 0, F.lit("G")).when(floors.isNotNull(), F.concat(F.lit("G+"), floors.cast("string")))


@F.pandas_udf(T.DoubleType())
def likeness(a: pd.Series, b: pd.Series) -> pd.Series:
    """Twice the matching characters over all, by longest matching blocks; the order of the two matters."""
    return pd.Series([difflib.SequenceMatcher(None, x, y).ratio() if isinstance(x, str) and isinstance(y, str) else None for x, y in zip(a, b, strict=True)], dtype="float64")


#: Letters from rare to common; others come before them.
RARE_FIRST = "zqxjkvbpygfwmucldrhsnioate"


def letter_tokens(text: Column) -> Column:
    """The characters of a text, each with its number among its like: 'abca' has a1, a2, b1, c1. Rare ones come first.

    Texts have as many tokens in common as characters, so at least as many as match in any blocks. An empty text has one
    token of its own.
    """
    chars = F.array_sort(F.filter(F.split(text, ""), lambda c: c != ""))
    nth = lambda c, i: (i + 2 - F.array_position(chars, c)).cast("int")
    one = lambda c, i: F.struct((-nth(c, i)).alias("n"), F.instr(F.lit(RARE_FIRST), c).alias("rank"), c.alias("c"))
    tokens = F.transform(F.array_sort(F.transform(chars, one)), lambda t: F.concat(t.c, (-t.n).cast("string")))
    return F.when(F.size(tokens) == 0, F.array(F.lit(""))).otherwise(tokens)


def alike_candidates(names: DataFrame, text: Column, block: Column, percent: int = 85) -> DataFrame:
    """(a, b): a < b of one block, from (name), without any pair lost whose likeness in text may reach percent hundredths.

    A likeness is 2 m / (n + k) for m matching characters of texts of n and k, and m is at most what they have in common. So
    n and k are bounded by each other, and what each must have in common with the shortest partner leaves a prefix of its
    tokens that meets the partner's.
    """
    n, p = F.col("n"), percent
    shortest = F.ceil(n * p / F.lit(200 - p) - 1e-9)
    common = F.ceil((n + shortest) * p / F.lit(200) - 1e-9)
    x = names.select(F.col("name"), block.alias("block"), text.alias("plain")).where("name is not null and plain is not null").distinct()
    x = x.select("name", "block", F.length("plain").alias("n"), letter_tokens(F.col("plain")).alias("tokens"))
    x = x.withColumn("token", F.explode(F.slice("tokens", F.lit(1), F.greatest(F.lit(1), (n - common + 1).cast("int")))))
    a, b = x.withColumnsRenamed({"name": "a", "n": "na", "tokens": "ta"}), x.withColumnsRenamed({"name": "b", "n": "nb", "tokens": "tb"})
    fits = (F.col("a") < F.col("b")) & (200 * F.least("na", "nb") >= p * (F.col("na") + F.col("nb")))
    enough = 200 * F.size(F.array_intersect("ta", "tb")) >= p * (F.col("na") + F.col("nb"))
    return a.join(b, ["block", "token"]).where(fits).where(enough).select("a", "b").distinct()


def digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def similar_keys(a: Column, b: Column) -> Column:
    """Keys of one street: equal, or with the same digits, of four characters at least, and alike to 0.85."""
    close = (digits(a) == digits(b)) & (F.least(F.length(a), F.length(b)) >= 4)
    return (a == b) | (close & (F.when(close & (a != b), likeness(a, b)).otherwise(F.lit(0.0)) >= 0.85))
