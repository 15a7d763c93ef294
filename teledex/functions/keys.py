"""Join keys that make titles and years from different sources comparable."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .regex import collapse_whitespace, first_match, strip, sub

# --- Fixed values: they decide the results and must stay as they are. -----------
PARENTHESISED = r"\([^)]*\)"
ARTICLES = r"\b(the|a|an)\b"
NOT_KEY_CHARACTER = r"[^a-z0-9\s]"
YEAR = r"\b(19\d{2}|20\d{2})\b"
# --------------------------------------------------------------------------------


def normalize_title(title: Column) -> Column:
    """Lower-cased title without articles, parentheses and punctuation; null gives ''."""
    key = F.lower(F.coalesce(title.cast("string"), F.lit("")))
    for pattern in (PARENTHESISED, ARTICLES, NOT_KEY_CHARACTER):
        key = sub(key, pattern, "")
    return collapse_whitespace(key)


def normalize_year(year: Column) -> Column:
    """First 1900-2099 token as a string, else null. Accepts numbers and text."""
    return first_match(strip(year.cast("string")), YEAR)
