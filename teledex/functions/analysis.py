"""Text analysis for search: words, lower-cased, no stop words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .regex import let

# Words follow the Unicode word-break rules (UAX #29): letters, digits and
# underscores join; an apostrophe, full stop, colon or middle dot joins letters; a
# full stop, comma, semicolon or apostrophe joins digits. Chinese characters and
# hiragana stand alone. Possessive quantifiers keep matching iterative on any text.
_ALONE = r"[\p{IsIdeographic}\u3041-\u309f]"
_LETTER = r"[\p{L}\p{M}&&[^\p{IsIdeographic}\u3041-\u309f]]"
WORD = (
    rf"{_ALONE}\p{{M}}*+"
    rf"|(?:{_LETTER}++(?:['’.:·]{_LETTER}++)*+|\p{{N}}++(?:[.,;'’]\p{{N}}++)*+|_++(?=[\p{{L}}\p{{N}}_])"
    rf"|(?<=[\p{{L}}\p{{N}}])_++)++"
)
MAX_TOKEN_LENGTH = 255


def tokenize(text: Column) -> Column:
    """Array of tokens in text order; longer ones are split every 255 characters."""
    pieces = rf"(?s).{{1,{MAX_TOKEN_LENGTH}}}"

    def split_long(tokens: Column) -> Column:
        cut = F.transform(tokens, lambda t: F.regexp_extract_all(t, F.lit(pieces), F.lit(0)))
        has_long = F.exists(tokens, lambda t: F.octet_length(t) > MAX_TOKEN_LENGTH)
        return F.when(has_long, F.flatten(cut)).otherwise(tokens)

    return let(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)), split_long)


def term_groups(tokens: Column) -> Column:
    """Group one text's tokens: array of (term, positions), ordered by term.

    A text's tokens are all in its own row, so counting them needs no shuffle: sort
    (term, position) pairs, mark where each term starts, slice the runs.
    """

    def runs(pairs: Column) -> Column:
        last = F.size(pairs)
        starts = F.filter(
            F.sequence(F.lit(0), last - 1),
            lambda i: (i == 0) | (F.get(pairs, i)["term"] != F.get(pairs, i - 1)["term"]),
        )

        def group(start: Column, stop: Column) -> Column:
            run = F.slice(pairs, start + 1, stop - start)
            return F.struct(
                F.get(pairs, start)["term"].alias("term"), run["position"].alias("positions")
            )

        def between(starts: Column) -> Column:
            stops = F.array_append(F.slice(starts, F.lit(2), F.size(starts)), last)
            return F.zip_with(starts, stops, group)

        return let(starts, between)

    empty = F.array().cast("array<struct<term:string,positions:array<int>>>")
    numbered = F.arrays_zip(
        tokens.alias("term"), F.sequence(F.lit(0), F.size(tokens) - 1).alias("position")
    )
    return F.when(F.size(tokens) > 0, let(F.sort_array(numbered), runs)).otherwise(empty)
