"""Regular-expression helpers.

Patterns across the package are written in the usual Unicode dialect (``\\s``,
``\\d`` and ``\\b`` follow Unicode, only ``\\n`` ends a line). ``java_pattern`` turns
one into the pattern Spark's Java engine needs for the same matches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_WORD = r"[\p{L}\p{N}_]"
_BOUNDARY = rf"(?:(?<={_WORD})(?!{_WORD})|(?<!{_WORD})(?={_WORD}))"

# Every Unicode whitespace character (all lie below U+3001).
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def java_pattern(pattern: str, flags: str = "") -> str:
    """``d``: only \\n ends a line; ``U``: Unicode classes; ``flags``: any of ``ims``."""
    return f"(?dU{flags})" + pattern.replace(r"\b", _BOUNDARY)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(text: Column) -> Column:
    """Trim Unicode whitespace from both ends (plain ``trim`` removes only spaces)."""
    return F.btrim(text, F.lit(WHITESPACE))


def matches(text: Column, pattern: str, flags: str = "") -> Column:
    return text.rlike(java_pattern(pattern, flags))


def sub(text: Column, pattern: str, replacement: str, flags: str = "") -> Column:
    return F.regexp_replace(text, java_pattern(pattern, flags), replacement)


def collapse_whitespace(text: Column) -> Column:
    return strip(sub(text, r"\s+", " "))


def capture(text: Column, pattern: str, flags: str = "", group: int = 1) -> Column:
    """First match's group, ``''`` when there is none. Stops at the first match."""
    return F.regexp_extract(text, java_pattern(pattern, flags), group)


def first_match(text: Column, pattern: str, flags: str = "") -> Column:
    """First match's group 1, null when there is none.

    For patterns whose group cannot be empty, so that ``''`` means "no match".
    """
    return F.nullif(capture(text, pattern, flags), F.lit(""))


def first_match_or_empty(text: Column, pattern: str, flags: str = "") -> Column:
    """As :func:`first_match` for groups that may be empty: null only without a match."""
    return F.get(F.regexp_extract_all(text, F.lit(java_pattern(pattern, flags)), F.lit(1)), F.lit(0))


def find_all(text: Column, pattern: str, flags: str = "", group: int = 1) -> Column:
    """Group of every match as an array; empty array when nothing matches."""
    return F.regexp_extract_all(text, F.lit(java_pattern(pattern, flags)), F.lit(group))


def block_find_all(
    text: Column, block: str, item: str, block_flags: str = "", item_flags: str = ""
) -> Column:
    """All items inside the first captured block; no block gives an empty array."""
    return find_all(capture(text, block, block_flags), item, item_flags)


def to_int(text: Column) -> Column:
    return text.try_cast("int")
