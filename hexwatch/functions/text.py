"""Text cleaning columns (F1, F2, F3, F8, P13). Built-in expressions only, none of them outside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hexwatch.settings import CATEGORIES, CATEGORY_SPELLINGS, MISSING_TOKENS

# Every character that counts as white space, by rule rather than by list.
WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())
_BREAK = "\u0001 "


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def blank_to_null(c: Column) -> Column:
    """`''` and the literal text `nan` are missing."""
    return F.when(~c.isin("", "nan"), c)


def nan_to_null(c: Column) -> Column:
    """F8."""
    return F.nullif(c, F.lit("nan"))


def missing_to_null(c: Column) -> Column:
    """Cell texts that a CSV reader treats as missing."""
    return F.when(~c.isin(*MISSING_TOKENS), c)


def title_case(c: Column) -> Column:
    """Capitalise after every non-letter. `initcap` only breaks at spaces, so a removable break is put in front."""
    broken = F.regexp_replace(c, r"(?<=[^\p{L} ])(?=\p{L})", _BREAK)
    return F.replace(F.initcap(broken), F.lit(_BREAK), F.lit(""))


def clean_category(c: Column) -> Column:
    """known spellings map onto the domain, anything else is title-cased with a lower-case ` and `."""
    text = strip(c)
    lowered = F.lower(text)
    out = F.when(blank_to_null(text).isNull(), F.lit(None).cast("string"))
    for name in CATEGORIES:
        out = out.when(lowered.isin(*CATEGORY_SPELLINGS[name]), name)
    return out.otherwise(F.replace(title_case(text), F.lit(" And "), F.lit(" and ")))


def clean_neighbourhood(c: Column) -> Column:
    """drop a leading number and a trailing `(number)`. Trimming does the first: the text is stripped already, so
    white space in front can only be what followed the number."""
    text = F.ltrim(F.ltrim(strip(c), F.lit("0123456789")), F.lit(WHITESPACE))
    numbered = text.endswith(")")
    return blank_to_null(F.when(numbered, F.regexp_replace(text, r"\s*\(\d+\)$", "")).otherwise(text))


def clean_premise(c: Column) -> Column:
    """F3."""
    return blank_to_null(strip(c))


def truncate(c: Column, width: int) -> Column:
    """P13."""
    return F.left(c, F.lit(width))


def in_domain(c: Column) -> Column:
    """P14 as a flag: true when the category is one of the five."""
    return c.isin(*CATEGORIES)
