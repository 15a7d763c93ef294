"""HTML character references -> characters, following the HTML5 rules."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# A reference, a run without any, or a lone ampersand.
_TOKEN = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)|[^&]+|&"

_PAIR_END, _KEY_END = "\u0001", "\u0002"
# Short names first: the lookup scans, and the common names are the short ones.
_NAMES = sorted(html5, key=lambda name: (len(name), name))
# Old names that also count without a semicolon; the longest one wins.
_BARE = "|".join(sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True))

_MAX_CODE_POINT = 0x10FFFF
_REPLACEMENT = 0xFFFD


def _windows_1252(code: int) -> int:
    try:
        return ord(bytes([code]).decode("cp1252"))
    except UnicodeDecodeError:
        return code


def _literal_map(pairs: dict[str, str]) -> Column:
    text = _PAIR_END.join(k + _KEY_END + v for k, v in pairs.items())
    return F.str_to_map(F.lit(text), F.lit(_PAIR_END), F.lit(_KEY_END))


def _named() -> Column:
    return _literal_map({name: html5[name] for name in _NAMES})


# Numeric references in the C1 range stand for Windows-1252 characters.
_RENUMBERED = {str(c): str(_windows_1252(c)) for c in range(0x80, 0xA0)} | {
    "0": str(_REPLACEMENT)
}


def _character(code: Column) -> Column:
    return F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")


def _code_point(token: Column) -> Column:
    digits = F.ltrim(F.regexp_replace(token, "[^0-9a-fA-F]", ""), F.lit("0"))
    is_hex = F.lower(F.substring(token, 3, 1)) == "x"
    value = F.when(is_hex, F.conv(digits, 16, 10)).otherwise(digits).try_cast("int")
    # More than eight significant digits is out of range in either base.
    return (
        F.when(digits == "", F.lit(0))
        .when(F.length(digits) > 8, F.lit(_MAX_CODE_POINT + 1))
        .otherwise(F.coalesce(value, F.lit(_MAX_CODE_POINT + 1)))
    )


def _numeric(token: Column) -> Column:
    def render(code: Column) -> Column:
        moved = F.try_element_at(_literal_map(_RENUMBERED), code.cast("string")).cast("int")
        unusable = (
            code.between(0x1, 0x8)
            | (code == 0xB)
            | code.between(0xE, 0x1F)
            | (code == 0x7F)
            | code.between(0xFDD0, 0xFDEF)
            | (code.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
        )
        return (
            F.when(moved.isNotNull(), _character(moved))
            .when(code.between(0xD800, 0xDFFF) | (code > _MAX_CODE_POINT), F.lit(chr(_REPLACEMENT)))
            .when(unusable, F.lit(""))
            .otherwise(_character(code))
        )

    return F.get(F.transform(F.array(_code_point(token)), render), F.lit(0))


def _by_name(token: Column) -> Column:
    body = F.substring(token, 2, 40)
    bare = F.regexp_extract(body, f"^(?:{_BARE})", 0)
    # Without a semicolon only the bare names can match, so other names look nothing up.
    return F.coalesce(
        F.when(body.endswith(";"), F.try_element_at(_named(), body)),
        F.when(
            bare != "",
            F.concat(F.try_element_at(_named(), bare), F.substr(body, F.length(bare) + 1)),
        ),
        token,
    )


def unescape_entities(text: Column) -> Column:
    """Decode named, decimal and hexadecimal references in one left-to-right pass."""

    def decode(token: Column) -> Column:
        plain = ~token.startswith("&") | (F.length(token) == 1)
        return (
            F.when(plain, token)
            .when(token.startswith("&#"), _numeric(token))
            .otherwise(_by_name(token))
        )

    tokens = F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0))
    return F.array_join(F.transform(tokens, decode), "")
