"""What the text of a picture says: kind of sign, road names, door numbers, pin codes, shop lines. All are column expressions,
but for the likeness of two names.

The patterns, word lists and prefixes below are fixed values.
"""

from __future__ import annotations

import difflib
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gablewise.functions.text import likeness

ROAD_WORDS = r"(?:Main\s+Road|Cross\s+Street|Cross\s+Road|Cross|High\s+Road|Trunk\s+Road|Salai|Road|Rd|Street|St|Avenue|Ave|Lane|Ln|Layout|Nagar|Colony|Extension|Extn|Veethi)"
ROAD = r"(?i)((?:\b[A-Z0-9][A-Za-z0-9\.\(\)'&-]*\s+){0,6}?\b" + ROAD_WORDS + r")\b\.?(?:\s*[-,]?\s*(\d{1,2})\b)?"
TAMIL_ROAD = r"((?:[\u0B80-\u0BFF\.\d]+\s+){0,5}?(?:சாலை|தெரு|வீதி|நகர்|குறுக்கு|லேஅவுட்|காலனி))"
PIN = r"\b6\s?4\s?1\s?\d\s?\d\s?\d\b"
DOOR = r"(?i)(?<!GST\s)(?<!GSTIN\s)(?<!Ph\s)(?<!Phone\s)(?<!Cell\s)(?<!Mob\s)\b(?:Old\s+|New\s+)?No\.?\s*[:\-]?\s*(\d{1,4}[A-Za-z]?(?:\s*/\s*\d{1,4}[A-Za-z]?)*)(?![A-Za-z0-9])|\b(\d{1,4}\s*/\s*\d{1,4}[A-Za-z]?)\b"
BOARD = ("corporation", "municipal", "ccmc", "மாநகராட்சி", "கோயம்புத்தூர்", "coimbatore city")
NOISE = r"(?i)\b(?:coimbatore\s+city\s+municipal\s+corporation|municipal\s+corporation|corporation|ward|zone|division|pin\s*code|coimbatore|tamil\s*nadu)\b[\s:\-]*"
TAMIL_NOISE = r"(?:கோயம்புத்தூர்\s*மாநகராட்சி|கோயம்புத்தூர்|மாநகராட்சி|வார்டு\s*\d*|மண்டலம்)\s*"
NUMBER_FIRST = r"(?i)^(?:(?:old|new)?\s*no\.?\s*[\d/]+[A-Za-z]?\s*,?\s*)+"
PIN_LAST = r"[\s,\-]*6\s?4\s?1\s?\d\s?\d\s?\d\s*$"
SPELLINGS = (
    (r"(?i)\bRd\b\.?", "Road"), (r"(?i)\bSt\b\.?", "Street"), (r"(?i)\bAve\b\.?", "Avenue"), (r"(?i)\bLn\b\.?", "Lane"), (r"(?i)\bExtn\b\.?", "Extension"),
    (r"(?i)\bFirst\b", "1st"), (r"(?i)\bSecond\b", "2nd"), (r"(?i)\bThird\b", "3rd"), (r"(?i)\bFourth\b", "4th"), (r"(?i)\b(\d+)\s*(st|nd|rd|th)\b", "$1$2"),
)
VIEWER = r"(?i)search google maps|google street view|google maps|image capture|^©|^\(c\)|^goo[gl~]*e?\s*$|^\s*(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\s+20\d\d\s*$|^(?:view|zoom|ortho|screenshot|p)\s*\d*[\s/]*(?:of view)?\s*\d*\s+20\d\d|^view \d|^zoom of|^ortho"
PRIORITY = ("road", "street", "salai", "cross", "lane", "avenue", "veethi", "layout", "nagar", "colony", "extension")


def once(c: Column, of: Callable[[Column], Column]) -> Column:
    """of(c), with c evaluated once however often it is used there: what stands in a branch or a lambda is else evaluated at each use."""
    return F.get(F.transform(F.array(c), of), F.lit(0))


def _ends(c: Column) -> Column:
    return F.regexp_replace(c, r"^[ ,.\-]+|[ ,.\-]+$", "")


def normal_name(name: Column) -> Column:
    """A road's name in one spelling; null if nothing is left. Tamil names keep their letters as they are."""
    s = _ends(F.regexp_replace(name, r"\s+", " "))
    s = F.regexp_replace(F.regexp_replace(s, NOISE, " "), TAMIL_NOISE, "")
    s = F.regexp_replace(F.regexp_replace(_ends(s), NUMBER_FIRST, ""), PIN_LAST, "")
    for pattern, spelling in SPELLINGS:
        s = F.regexp_replace(s, pattern, spelling)
    s = _ends(F.regexp_replace(s, r"\s+", " "))
    keep = lambda w: w.rlike(r"^\d|\.") | ((w == F.upper(w)) & (w != F.lower(w)) & (F.length(w) <= 3))
    cased = lambda s: F.array_join(F.transform(F.split(s, " "), lambda w: F.when(keep(w), w).otherwise(F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, F.lit(2), F.length(w)))))), " ")
    return once(s, lambda s: F.when(s != "", F.when(s.rlike(r"[\u0B80-\u0BFF]"), s).otherwise(cased(s))))


def street_number(name: Column) -> Column:
    """The first number of one or two digits that stands alone, as an ordinal or after a word for road."""
    p = r"(?i)(?:^|\s)(\d{1,2})(?:st|nd|rd|th)?(?:\s|$)|(?:street|st|cross|road)\s*[-,]?\s*(\d{1,2})\b"
    return F.coalesce(F.nullif(F.regexp_extract(name, p, 1), F.lit("")), F.nullif(F.regexp_extract(name, p, 2), F.lit("")))


def road_letters(name: Column) -> Column:
    """What of a name in lower case its likeness is about."""
    return F.regexp_replace(name, r"[^a-z0-9\u0B80-\u0BFF]", "")


def same_road(a: Column, b: Column) -> Column:
    """Two spellings of one road: of one number, and alike in their letters to 0.85. A missing name is like none."""
    la, lb = F.lower(a), F.lower(b)
    close = street_number(la).eqNullSafe(street_number(lb)) & (F.when(la != lb, likeness(road_letters(la), road_letters(lb))) >= 0.85)
    return F.coalesce((la == lb) | close, F.lit(False))


def sign_lines(lines: Column) -> Column:
    """The lines that aren't blank or the viewer's own."""
    return F.filter(lines, lambda x: (F.trim(x) != "") & ~F.trim(x).rlike(VIEWER))


def sign_text(lines: Column) -> Column:
    return F.array_join(sign_lines(lines), " ")


def pins(text: Column) -> Column:
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(PIN), F.lit(0)), lambda p: F.regexp_replace(p, r"\s", ""))))


def doors(text: Column) -> Column:
    """Up to four door numbers in the order of the text; a pin code is none."""
    found = F.zip_with(F.regexp_extract_all(text, F.lit(DOOR), F.lit(1)), F.regexp_extract_all(text, F.lit(DOOR), F.lit(2)), lambda a, b: F.replace(F.when(F.coalesce(a, F.lit("")) != "", a).otherwise(b), F.lit(" "), F.lit("")))
    return F.slice(F.array_distinct(F.filter(found, lambda d: d.isNotNull() & (d != "") & ~d.rlike(f"^(?:{PIN})$"))), 1, 4)


def raw_roads(lines: Column) -> Column:
    """Names of roads as they stand in the lines and in all of the text: of two words at least, the longest first."""
    every = F.concat(sign_lines(lines), F.array(sign_text(lines)))
    name = lambda t: F.zip_with(F.regexp_extract_all(t, F.lit(ROAD), F.lit(1)), F.regexp_extract_all(t, F.lit(ROAD), F.lit(2)), lambda a, n: F.concat(F.trim(a), F.when(F.coalesce(n, F.lit("")) != "", F.concat(F.lit(" "), n)).otherwise("")))
    found = F.flatten(F.transform(every, lambda t: F.concat(name(t), F.transform(F.regexp_extract_all(t, F.lit(TAMIL_ROAD), F.lit(1)), lambda x: F.trim(x)))))
    found = F.array_distinct(F.filter(found, lambda x: F.size(F.split(x, r"\s+")) >= 2))
    return F.transform(F.array_sort(F.transform(found, lambda x: F.struct((-F.length(x)).alias("n"), x.alias("name")))), lambda s: s["name"])


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _unlike(lows: pd.Series, numbers: pd.Series, letters: pd.Series) -> pd.Series:
    """The places of names that are like none kept before them."""

    def kept(low: list[str], number: list[str | None], letter: list[str]) -> list[int]:
        out: list[int] = []
        for i in range(len(low)):
            like = lambda k: low[i] == low[k] or number[i] == number[k] and difflib.SequenceMatcher(None, letter[i], letter[k]).ratio() >= 0.85  # noqa: B023, E731
            if not any(map(like, out)):
                out.append(i)
        return out

    return pd.Series([kept(*x) if x[0] is not None else None for x in zip(lows, numbers, letters, strict=True)])


def road_names(lines: Column) -> Column:
    """Up to three roads that a sign names, each in one spelling: of names that mean one road the longest; roads before streets before others."""
    fine = F.filter(F.transform(raw_roads(lines), normal_name), lambda n: n.isNotNull() & (F.size(F.split(n, r"\s+")) >= 2))
    lows = F.transform(fine, F.lower)
    places = _unlike(lows, F.transform(lows, street_number), F.transform(lows, road_letters))
    first = F.transform(places, lambda i: F.struct(priority(F.get(fine, i)).alias("type"), i.alias("i")))
    return F.slice(F.transform(F.array_sort(first), lambda p: F.get(fine, p.i)), 1, 3)


def viewer_address(panel: Column) -> Column:
    """The road in the first line that the viewer itself drew and that names one."""
    hit = F.filter(panel, lambda x: x.rlike(ROAD) & ~x.rlike(VIEWER))
    return normal_name(F.regexp_extract(F.get(hit, F.lit(0)), ROAD, 1))


def sign_kind(lines: Column) -> Column:
    def kind(text: Column) -> Column:
        board = once(F.lower(text), lambda low: F.exists(F.array(*map(F.lit, BOARD)), lambda w: low.contains(w)))
        return F.when(board, "street_name_board").when((F.size(doors(text)) > 0) | (F.size(pins(text)) > 0), "shop_address").otherwise("other")

    return once(sign_text(lines), kind)


def shop_lines(lines: Column) -> Column:
    fine = lambda x: F.length(F.trim(x)).between(2, 40) & ~x.rlike(ROAD) & ~x.rlike(DOOR) & ~x.rlike(PIN) & x.rlike(r"[A-Za-z\u0B80-\u0BFF]{3}")
    return F.slice(F.transform(F.filter(sign_lines(lines), fine), lambda x: F.trim(x)), 1, 6)


def priority(name: Column) -> Column:
    out = F.lit(len(PRIORITY))
    for i in range(len(PRIORITY) - 1, -1, -1):
        out = F.when(F.lower(name).rlike(rf"\b{PRIORITY[i]}"), i).otherwise(out)
    return out
