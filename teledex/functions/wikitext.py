"""Wiki markup: cleaning, infobox fields, classification and lead paragraph.

All functions are Column expressions. Values used more than once are bound with
``let`` so that each expensive expression is evaluated once per row.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from .entities import unescape_entities
from .regex import capture, collapse_whitespace, find_all, let, matches, strip, sub

# --- Fixed values: they decide the results and must stay as they are. -----------
HTML_COMMENT = r"<!--.*?-->"  # s
NESTED_TEMPLATE = r"\{\{[^{}]*\}\}"
TEMPLATE_PASSES = 5
REF_TAG = r"<ref[^>]*>.*?</ref>"  # is
REF_SELF = r"<ref[^>]*/?>"  # i
HTML_TAG = r"<[^>]+>"
WIKI_LINK = r"\[\[(?:[^|\]]+\|)?([^\]]+)\]\]"
BOLD = r"'''([^']+)'''"
ITALIC = r"''([^']+)''"
LITERAL_REPLACEMENTS = [
    ("&nbsp;", " "),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&amp;", "&"),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("<br>", " "),
    ("<br/>", " "),
    ("<br />", " "),
]
PLACEHOLDERS = ["", "yes", "no", "n/a", "various", "tba", "tbd", "none", "present"]
LEFTOVER_PREFIXES = ["|", "{{", "<!--"]
SHORT_REF_LENGTH = 50

INFOBOX_START = r"\{\{Infobox television"  # i
INFOBOX_START_TEXT = "{{infobox television"
NUMERIC_FIELDS = ["num_seasons", "num_episodes"]
YEAR_FIELDS = ["first_aired", "released", "first aired"]
YEAR = r"\b(19\d{2}|20\d{2})\b"

SERIES_EXCLUSIONS = [  # tested on lower-cased text
    r"\{\{infobox (?:person|comedian|actor|actress|singer)",
    r"\(born \d{4}\)",
    r"is an? (?:american|british|canadian)?\s*(?:actor|actress|comedian|singer|musician)",
    r"\{\{infobox (?:video game|film|book)",
]
SEASON_TITLES = [  # i
    r"\((?:series|season)\s+\d+\)",
    r"\([a-z\s]+\s+(?:series|season)\s+\d+\)",
    r"^(?:season|series)\s+\d+$",
    r"\s+(?:season|series)\s+\d+$",
]
LEAD_INFOBOX = r"\{\{Infobox[^}]*\}\}"  # is
LEAD_SKIP_PREFIXES = [
    "{{", "[[Category", "[[File", "[[Image", "=", "|", "#", "*", ":", "{|", "<!--",
]
LEAD_MARKERS = ["<ref", "{{", "[[Category", "<!--"]
LEAD_MIN_LENGTH = 100
LEAD_MAX_LENGTH = 500
# --------------------------------------------------------------------------------


def _any(conditions: list[Column]) -> Column:
    return reduce(or_, conditions)


def _up_to_last(text: Column, end: str, change: Callable[[Column], Column]) -> Column:
    """Applies a change to the text up to its last ``end``. Behind it no pattern closed by
    ``end`` can match, and trying from every opening would cost the square of its length."""

    def split(text: Column) -> Column:
        rest = F.substring_index(text, end, -1)
        return F.concat(change(F.left(text, F.length(text) - F.length(rest))), rest)

    return let(text, lambda t: F.when(F.contains(t, F.lit(end)), split(t)).otherwise(t))


def strip_comments(text: Column) -> Column:
    return _up_to_last(text, "-->", lambda head: sub(head, HTML_COMMENT, "", "s"))


def strip_templates(text: Column) -> Column:
    """Remove innermost templates; each pass uncovers the next level."""
    for _ in range(TEMPLATE_PASSES):
        text = sub(text, NESTED_TEMPLATE, "")
    return text


def _or_skip(pattern: str, opening: str) -> str:
    """The pattern, or else its opening as one more group: an opening that fails is passed over as
    far as it reads, since any other opening inside it would fail at the same place."""
    return f"{pattern}|({opening})"


def strip_refs(text: Column) -> Column:
    """Pairs first, in the text up to the last closing tag: behind it no pair ends."""

    def pairs(text: Column, head: Column) -> Column:
        closed = sub(head, _or_skip(REF_TAG, r"<ref[^>]*+"), "$1", "is")
        return F.concat(closed, F.substr(text, F.length(head) + 1))

    def closed(text: Column) -> Column:
        head = F.regexp_extract(text, "(?is)^.*</ref>", 0)
        return let(head, lambda h: F.when(h != "", pairs(text, h)).otherwise(text))

    tagged = let(text, lambda t: F.when(F.contains(t, F.lit("<")), closed(t)).otherwise(t))
    return _up_to_last(tagged, ">", lambda head: sub(head, REF_SELF, "", "i"))


def strip_tags(text: Column) -> Column:
    return _up_to_last(text, ">", lambda head: sub(head, HTML_TAG, ""))


def replace_literals(text: Column) -> Column:
    for old, new in LITERAL_REPLACEMENTS:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def unwrap_markup(text: Column) -> Column:
    """Links become their label; bold and italic quotes go."""
    text = sub(text, _or_skip(WIKI_LINK, r"\[\[[^\]]*+"), "$1$2")
    return sub(sub(text, BOLD, "$1"), ITALIC, "$1")


def blank_placeholders(text: Column) -> Column:
    """Blank values that carry no information (placeholders, markup leftovers)."""
    lowered = F.lower(text)
    useless = (
        lowered.isin(PLACEHOLDERS)
        | _any([text.startswith(p) for p in LEFTOVER_PREFIXES])
        | (lowered.contains("ref") & (F.length(text) < SHORT_REF_LENGTH))
    )
    return F.when(useless, F.lit("")).otherwise(text)


def clean_text(text: Column) -> Column:
    """The full cleaner; the order of the steps is part of the result."""
    text = F.coalesce(text, F.lit(""))
    text = strip_tags(strip_refs(strip_templates(strip_comments(text))))
    text = replace_literals(unescape_entities(text))
    return let(collapse_whitespace(unwrap_markup(text)), blank_placeholders)


def infobox_body(wikitext: Column, balanced: bool = False) -> Column:
    """Text between the infobox opening and its closing braces; null if unclosed.

    Depth is counted over runs of equal braces. A run of n counts n-1 pairs
    (overlapping pairs), so ``}}}}`` closes three levels; ``balanced`` counts n/2.
    """
    tail = capture(wikitext, INFOBOX_START + ".*$", "is", group=0)
    opening = len(INFOBOX_START_TEXT)

    def state(depth: Column, position: Column, close: Column) -> Column:
        return F.struct(
            depth.cast("int").alias("depth"),
            position.cast("int").alias("position"),
            close.cast("int").alias("close"),
        )

    def step(acc: Column, chunk: Column) -> Column:
        # chunk = text without braces, then one run of equal braces (none at the end)
        braces = F.length(chunk) - F.length(F.rtrim(chunk, F.lit("{}")))
        pairs = F.floor(braces / 2) if balanced else braces - 1
        closing_pair = (acc["depth"] - 1) * (2 if balanced else 1)
        end = acc["position"] + F.length(chunk)
        none = F.lit(None)
        return (
            F.when(acc["close"].isNotNull() | (braces == 0), acc)
            .when(chunk.endswith("{"), state(acc["depth"] + pairs, end, none))
            .when(acc["depth"] > pairs, state(acc["depth"] - pairs, end, none))
            .otherwise(state(F.lit(0), end, end - braces + closing_pair))
        )

    def cut(tail: Column) -> Column:
        chunks = find_all(tail, r"[^{}]*+(?:\{++|\}++|\z)", group=0)
        start = state(F.lit(0), F.lit(0), F.lit(None))
        close = F.aggregate(chunks, start, step, lambda acc: acc["close"])
        return let(close, lambda c: F.substr(tail, F.lit(opening + 1), c - opening))

    return let(tail, cut)


def _spellings(field: str) -> list[str]:
    names = [field, field.replace("_", " "), field.replace("num_", "num ")]
    return list(dict.fromkeys(names))


def field_line(infobox: Column, field: str) -> Column:
    """Raw one-line value of an infobox parameter, null if it is not there.

    The first spelling that matches wins even when its value is blank. Whitespace
    after ``=`` includes line ends, so an empty parameter yields the next line.
    """

    def spelled(name: str) -> Column:
        value = capture(infobox, rf"^\s*\|\s*{name}\s*=\s*(.+?)$", "ims")
        return let(value, lambda v: F.when(v != "", v))

    return strip(F.coalesce(*[spelled(name) for name in _spellings(field)]))


def _checked_field(value: Column, field: str) -> Column:
    """Null for a cleaned value that is blank, malformed or lacks a needed digit."""
    head = F.substring(value, 1, 20)
    usable = (value != "") & ~(head.contains("|") & head.contains("="))
    if field in NUMERIC_FIELDS:
        usable = usable & matches(value, r"[\p{Nd}²³¹⁰⁴-⁹₀-₉]")
    return F.when(usable, value)


def field_values(infobox: Column, fields: list[str]) -> Column:
    """Struct of cleaned infobox parameters, null where absent or unusable."""
    lines = F.array(*[F.substring_index(field_line(infobox, f), "\n", 1) for f in fields])

    def struct(cleaned: Column) -> Column:
        return F.struct(
            *[_checked_field(F.get(cleaned, F.lit(i)), f).alias(f) for i, f in enumerate(fields)]
        )

    return let(F.transform(lines, clean_text), struct)


def infobox_year(infobox: Column) -> Column:
    years = [capture(field_line(infobox, f), YEAR) for f in YEAR_FIELDS]
    return F.coalesce(*[let(y, lambda v: F.when(v != "", v)) for y in years])


def season_title(title: Column) -> Column:
    """Titles of one season or series of a show rather than of the show."""
    return _any([matches(title, p, "i") for p in SEASON_TITLES])


def is_series(wikitext: Column) -> Column:
    """Television page that is not about a person, game, film or book."""

    def check(lowered: Column) -> Column:
        excluded = _any([matches(lowered, p) for p in SERIES_EXCLUSIONS])
        return lowered.contains(INFOBOX_START_TEXT) & ~excluded

    inner_title = F.lower(capture(wikitext, r"<title>(.+?)</title>"))
    return F.coalesce(let(F.lower(wikitext), check) & ~season_title(inner_title), F.lit(False))


def page_text(page: Column) -> Column:
    """Content of the ``<text>`` element, null when there is none."""
    element = capture(page, r"<text[^>]*>.*?</text>", "s", group=0)

    def body(element: Column) -> Column:
        opening = F.instr(element, ">")
        length = F.length(element) - opening - len("</text>")
        return F.when(element != "", F.substr(element, opening + 1, length))

    return let(element, body)


def page_accepted(title: Column, namespace: Column, wikitext: Column) -> Column:
    """Cheap page tests first: title shape, namespace, redirect.

    ``title`` and ``namespace`` are ``''`` when the element is missing.
    """
    return reduce(
        and_,
        [
            title != "",
            ~title.startswith("List of"),
            ~title.contains(":"),
            namespace.isin("", "0"),
            ~season_title(title),
            ~F.lower(strip(wikitext)).startswith("#redirect"),
        ],
    )


def lead_paragraph(wikitext: Column) -> Column:
    """First real paragraph before the first section, cleaned, at most 500 characters.

    The fold stops cleaning lines once one qualifies.
    """
    skip = "^(?:" + "|".join(re.escape(p) for p in LEAD_SKIP_PREFIXES) + ")"

    def lead_or_blank(line: Column) -> Column:
        def check(cleaned: Column) -> Column:
            marked = _any([cleaned.contains(m) for m in LEAD_MARKERS])
            good = (F.length(cleaned) > LEAD_MIN_LENGTH) & ~marked
            return F.when(good, F.substring(cleaned, 1, LEAD_MAX_LENGTH)).otherwise("")

        return let(clean_text(line), check)

    boxless = _or_skip(LEAD_INFOBOX, r"\{\{Infobox[^}]*+")
    text = strip_refs(sub(F.coalesce(wikitext, F.lit("")), boxless, "$1", "is"))
    lines = F.transform(F.split(F.substring_index(text, "\n==", 1), "\n"), strip)
    candidates = F.filter(lines, lambda x: (F.length(x) >= LEAD_MIN_LENGTH) & ~x.rlike(skip))
    return F.aggregate(
        candidates,
        F.lit(""),
        lambda found, line: F.when(found != "", found).otherwise(lead_or_blank(line)),
    )
