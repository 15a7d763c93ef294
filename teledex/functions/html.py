"""Fields of a crawled series page, one expression per field."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .regex import block_find_all, capture, find_all, first_match, let, strip, to_int

# --- Fixed values: they decide the results and must stay as they are. -----------
TITLE = r'<h2[^>]*>\s*<a[^>]*href="/tv/[^"]+"[^>]*>([^<]+)</a>'  # is
YEAR = r'<span class="tag release_date">\((\d{4})\)</span>'
CERTIFICATION = r'<span class="certification">\s*([^<\n]+)\s*</span>'
GENRES = r'<span class="genres">(.+?)</span>'  # is
LINK_GENRE = r">([^<]+)</a>"
CREATORS = r'<li[^>]*class="profile"[^>]*>\s*<p><a[^>]*>([^<]+)</a></p>\s*<p class="character">\s*Creator\s*</p>'  # is
USER_SCORE = r'<div[^>]*class="user_score_chart"[^>]*data-percent="(\d+)"'  # i
STATUS = r"<strong><bdi>Status</bdi></strong>\s*([^<]+)"
TYPE = r"<strong><bdi>Type</bdi></strong>\s*([^<]+)"
LANG = r"<strong><bdi>Original Language</bdi></strong>\s*([^<]+)"
KEYWORDS = r'<section[^>]*class="keywords[^>]*>.*?<ul>(.*?)</ul>'  # s
LINK_KEYWORD = r"<a[^>]*>([^<]+)</a>"
NO_KEYWORDS = "No keywords have been added."
CAST = r'<div id="cast_scroller"[^>]*>.*?<ol[^>]*>(.*?)</ol>'  # s
ACTOR = r'<p><a href="[^"]+">([^<]+)</a></p>'
# --------------------------------------------------------------------------------


def keywords(html: Column) -> Column:
    """Keyword links; the sentinel sentence anywhere in the matched section blanks them."""

    def links(section: Column) -> Column:
        listed = find_all(capture(section, KEYWORDS, "s"), LINK_KEYWORD)
        nothing = F.array().cast("array<string>")
        return F.when(section.contains(NO_KEYWORDS), nothing).otherwise(listed)

    return let(capture(html, KEYWORDS, "s", group=0), links)


def field_columns(html: Column) -> dict[str, Column]:
    """Field name -> expression, in record order."""
    return {
        "title": strip(first_match(html, TITLE, "is")),
        "year": to_int(first_match(html, YEAR)),
        "certification": strip(first_match(html, CERTIFICATION)),
        "genres": block_find_all(html, GENRES, LINK_GENRE, "is"),
        "score": to_int(first_match(html, USER_SCORE, "i")),
        "creator": find_all(html, CREATORS, "is"),
        "status": strip(first_match(html, STATUS)),
        "type": strip(first_match(html, TYPE)),
        "language": strip(first_match(html, LANG)),
        "keywords": keywords(html),
        "cast": block_find_all(html, CAST, ACTOR, "s"),
    }
