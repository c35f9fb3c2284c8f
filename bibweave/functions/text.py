"""Column functions for catalog strings."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Rewrites of publisher and agency names (pattern, replacement), in order.
_EVERYWHERE = (
    (r"[,\.:;]|'S?", ""),
    (r"[\(\)\{\}\[\]]", ""),
    (r"FOR SALE BY.*", ""),
    (r"\b(THE) ", ""),
    (r"DEPARTMENT", "DEPT"),
    (r"DEPTOF", "DEPT OF"),
    (r"UNITED STATES( OF AMERICA)?", "US"),
    (r"U\sS\s|U S$", "US "),
    (r"GOVERNMENT", "GOVT"),
    (r" SPN$", ""),
)
_ONCE = (
    (r"(US\s?)?GOVT\s?PRINT(ING)?\s?OFF(ICE)?", "USGPO"),
    (r"U\s?S\s?G\s?P\s?O", "USGPO"),
    (r"US.*GO.+P.*O", "USGPO"),
    (r"^GPO$", "USGPO"),
)
#: The rewrite that agency names are spared.
_NOT_AGENCY = r"US.*GO.+P.*O"
# Dates in imprints, dates with unknown digits, and what else is cut from an imprint.
IMPRINT_DATE = r"c?-?\d{4}\??(\s*(-|i.\s*e.|or)?\s*c?\d{0,4})\??"
OPEN_DATE = r"c?-?[0-9u]{4}\??(\s*(-|i.\s*e.|or)?\s*c?[0-9u]{0,4})\??"
IMPRINT_JUNK = r"""[,:;\.\-\(\)\[\]\{\}<>\|\$!"'#\*\+/\\]"""


def _col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def replace_first(s, pattern: str, to: str) -> Column:
    """Replace the first match only."""
    if pattern.startswith("^"):
        return F.regexp_replace(s, pattern, to)
    return F.regexp_replace(s, f"^(.*?)(?:{pattern})", f"$1{to}")


def fold_spaces(s, limit: int = 750) -> Column:
    """Runs of spaces as one, one space cut at either end, at most ``limit`` characters."""
    s = F.regexp_replace(_col(s), r"\s+", " ")
    return F.substring(F.regexp_replace(s, r"^ | $", ""), 1, limit)


def _publisher(s: Column, agency: bool) -> Column:
    for pattern, to in _EVERYWHERE:
        s = F.regexp_replace(s, pattern, to)
    for pattern, to in _ONCE:
        if not (agency and pattern == _NOT_AGENCY):
            s = replace_first(s, pattern, to)
    s = F.regexp_replace(s, r" +", " ")
    return F.regexp_replace(s, r"^ | $", "")


def normalize_publisher(s) -> Column:
    """Publisher names in one form; upper-case input is expected, null gives an empty string."""
    return _publisher(F.coalesce(_col(s), F.lit("")), False)


def normalize_agency(s) -> Column:
    """Agency names, upper-cased first."""
    return _publisher(F.upper(F.coalesce(_col(s), F.lit(""))), True)


def stem_sudoc(s) -> Column:
    """What precedes the first period of a classification number; null for other kinds of number."""
    head = F.regexp_extract(_col(s), r"^([^.]+)", 1)
    stem = F.regexp_replace(F.upper(head), r"II0\s*A", "")
    return F.when(head.contains("-") | ~stem.rlike("[a-zA-Z]"), None).otherwise(stem)


def space_sudoc(s) -> Column:
    """A space between the letters and the digits of a short number."""
    return F.regexp_replace(_col(s), r"^([A-Z]+)([0-9]+)$", "$1 $2")


def fold_title(s) -> Column:
    """Lower case, only a-z, 0-9 and single spaces."""
    return F.regexp_replace(F.regexp_replace(F.lower(_col(s)), r"[^a-z0-9 ]", ""), r" +", " ")


def imprint_parts(s) -> Column:
    """The distinct pieces of an imprint between commas, colons and semicolons, without brackets."""
    pieces = F.transform(F.split(_col(s), "[,:;]"), lambda x: F.regexp_replace(F.trim(x), r"[\[\]<>\(\)]", ""))
    return F.array_distinct(pieces)


def imprint_date(s) -> Column:
    """The date in an imprint's last piece, null without one."""
    found = F.regexp_extract(F.element_at(imprint_parts(s), -1), IMPRINT_DATE, 0)
    return F.when(found != "", found)


def imprint_publishers(s) -> Column:
    """Distinct normalised publishers of an imprint, its date taken out."""
    parts, date = imprint_parts(s), imprint_date(s)
    last = F.when(date.isNull(), F.element_at(parts, -1)).otherwise(F.replace(F.element_at(parts, -1), date, F.lit("")))
    all_parts = F.concat(F.slice(parts, 1, F.size(parts) - 1), F.array(last))
    return F.filter(F.array_distinct(F.transform(all_parts, normalize_publisher)), lambda x: x != "")


def canonical_imprint(s) -> Column:
    """Imprint in lower case without dates, marks and sellers; null if no letter is left."""
    s = F.regexp_replace(F.lower(_col(s)), OPEN_DATE, "")
    s = F.regexp_replace(s, IMPRINT_JUNK, " ")
    s = F.regexp_replace(s, "for sale by.+", "")
    s = F.trim(F.regexp_replace(s, " +", " "))
    return F.when(s.rlike("[a-z]"), s)


def lenient_int(s) -> Column:
    """The whole number a string starts with, 0 without one."""
    digits = F.regexp_extract(_col(s), r"^\s*(\d+)", 1)
    return F.when(_col(s).isNotNull(), F.coalesce(F.try_to_number(F.when(digits != "", digits), F.lit("9" * 18)).cast("bigint"), F.lit(0).cast("bigint")))


def one_of(words: Sequence[str], whole: bool = False) -> str:
    """A pattern of alternatives; ``whole`` anchors it at both ends."""
    body = "|".join(words)
    return f"^({body})$" if whole else f"({body})"


@F.pandas_udf(StringType())
def unicode_fold(s: pd.Series) -> pd.Series:
    """NFKC, lower case and Latin letters without marks; punctuation becomes spaces.

    Covers Latin scripts with canonical decompositions and the letters listed in ``_PLAIN``; other scripts stay.
    """
    return s.map(lambda x: None if x is None else _fold(x))


# Latin letters without a decomposition, and their plain forms.
_PLAIN = str.maketrans({"ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "đ": "d", "ð": "d", "þ": "th", "ł": "l", "ħ": "h", "ı": "i", "ŋ": "n"})


def _fold(text: str) -> str:
    text = unicodedata.normalize("NFKC", text).lower().translate(_PLAIN)
    text = "".join(c for c in unicodedata.normalize("NFD", text) if not unicodedata.combining(c))
    out = []
    for c in unicodedata.normalize("NFC", text):
        mark = unicodedata.category(c)[0] == "P"
        if not (mark and out and out[-1] is None):
            out.append(None if mark else c)
    return "".join(" " if c is None else c for c in out)


def normalize_form(form: str):
    """A function that brings strings to one of the Unicode forms NFC, NFD, NFKC and NFKD."""
    if form not in ("NFC", "NFD", "NFKC", "NFKD"):
        raise ValueError(f"unknown form {form}")

    @F.pandas_udf(StringType())
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else unicodedata.normalize(form, x))

    return run
