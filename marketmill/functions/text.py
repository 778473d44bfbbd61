"""Text clean-up and masking."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cell texts that a load reads as missing.
NULL_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# The same for seed files, where `NA` and `None` are ordinary texts.
SEED_NULL_TOKENS = ("", "null")

# The characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Fixed pattern: first character, then the rest of the local part, then the domain.
EMAIL_PATTERN = r"(?s)(^.{1})[^@]+(@.+$)"
# The same, but a one-character local part is hidden as well.
EMAIL_PATTERN_STRICT = r"(?s)(^.{1})[^@]*(@.+$)"


def as_column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def trimmed(col: Column | str) -> Column:
    """Without leading and trailing spaces (spaces only, no tabs or newlines)."""
    return F.trim(as_column(col))


def lower_trimmed(col: Column | str) -> Column:
    return F.lower(trimmed(col))


def upper_trimmed(col: Column | str) -> Column:
    return F.upper(trimmed(col))


def stripped(col: Column | str) -> Column:
    """Without any leading and trailing whitespace.

    A character-set trim, not a regular expression: it stays linear on long runs of
    whitespace inside a text.
    """
    return F.btrim(as_column(col), F.lit(WHITESPACE))


def null_if_token(col: Column | str, tokens: tuple[str, ...] = NULL_TOKENS) -> Column:
    """NULL where the cell holds one of the missing-value tokens."""
    col = as_column(col)
    return F.when(~col.isin(*tokens), col)


def masked_email(col: Column | str, strict: bool = False) -> Column:
    """First character, four stars, domain.

    A one-character local part is left readable, as the warehouse has always done;
    `strict=True` hides it too.
    """
    pattern = EMAIL_PATTERN_STRICT if strict else EMAIL_PATTERN
    return F.regexp_replace(as_column(col), pattern, "$1****$2")
