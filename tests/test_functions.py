"""Column functions on hand-written inputs; expected values worked out by hand or by
an independent implementation."""

import html
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from teledex.functions import analysis, keys
from teledex.functions import wikitext as wt
from teledex.functions.entities import unescape_entities
from teledex.functions.html import field_columns
from teledex.functions.regex import first_match, first_match_or_empty, java_pattern, strip, sub


def values(spark, expression, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return [r.v for r in df.select("i", expression(F.col("t")).alias("v")).orderBy("i").collect()]


def test_strip_removes_unicode_whitespace(spark):
    texts = ["  a b \n", "\x1cx\x85", "", " \t"]
    assert values(spark, strip, texts) == [t.strip() for t in texts]


def test_word_boundary_follows_unicode_letters(spark):
    pattern = java_pattern(r"\b(19\d{2})\b")
    texts = ["é1999", "(1999)", "1999s", "x 1999"]
    assert values(spark, lambda t: t.rlike(pattern), texts) == [False, True, False, True]


def test_first_match_tells_empty_from_absent(spark):
    texts = ["<a></a>", "<a>x</a><a>y</a>", "none"]
    assert values(spark, lambda t: first_match_or_empty(t, "<a>(.*?)</a>"), texts) == ["", "x", None]
    assert values(spark, lambda t: first_match(t, "<a>(.+?)</a>"), texts[1:]) == ["x", None]


def test_entities_equal_the_standard_library(spark):
    rng = random.Random(7)
    pieces = ["&", "amp", ";", "lt", "#", "x", "8211", "41", "nbsp", "copy", " ", "é", "notit", "#x1F600;",
              "&eacute;", "&#128;", "&#0;", "&#xD800;", "&#99999999999;", "&#x110000;", "&#xfdd0;",
              "&#x1ffff;", "&#11;", "&NotEqualTilde;", "&ampx", "&bogus;", "&AMP", "&#x0000041;"]
    texts = ["".join(rng.choices(pieces, k=rng.randint(1, 9))) for _ in range(600)]
    assert values(spark, unescape_entities, texts) == [html.unescape(t) for t in texts]


CLEANED = [
    (None, ""),
    ("  a   b\n", "a b"),
    ("a<!-- x\n y -->b", "ab"),
    ("a {{b {{c}} d}} e", "a e"),
    ("{{1{{2{{3{{4{{5{{6}}}}}}}}}}}}", ""),  # one level remains: starts with braces
    ("x<ref name=a>cite</ref>y<ref name=b/>z", "xyz"),
    ("a&nbsp;b &amp;amp; c", "a b & c"),
    ("A long value that stays &lt;ref&gt;even when a reference is escaped&lt;/ref&gt; in it",
     "A long value that stays <ref>even when a reference is escaped</ref> in it"),  # decoded last
    ("short &lt;ref&gt;x", ""),  # under 50 characters with "ref"
    ("preferred", ""),
    ("x" * 50 + "ref", "x" * 50 + "ref"),
    ("&lt;br&gt;a", "a"),
    ("[[Page|Label]] and [[Plain]]", "Label and Plain"),
    ("'''''both''''' '''bold''' ''it''", "both bold it"),
    ("TBA", ""), ("N/A ", ""), ("| x = y", ""), ("Various", ""), ("{{unclosed", ""),
]


def test_clean_text(spark):
    assert values(spark, wt.clean_text, [c[0] for c in CLEANED]) == [c[1] for c in CLEANED]


INFOBOXES = [
    ("x {{Infobox television\n| a = {{b}}\n}} y", "\n| a = {{b}}\n", "\n| a = {{b}}\n"),
    # Four braces close three levels when pairs overlap, two when balanced.
    ("{{Infobox television|a={{b|{{c}}}}|d=1}}", "|a={{b|{{c}}", "|a={{b|{{c}}}}|d=1"),
    ("{{infobox Television |x={y}}} z", " |x={y", " |x={y"),  # first pair of three
    ("{{Infobox television|a={{b}}", None, None),
    ("{{Infobox film|a}}", None, None),
    ("\U0001f600 {{Infobox television|é\U0001f600}}", "|é\U0001f600", "|é\U0001f600"),
]


def test_refs_and_links_equal_the_plain_patterns(spark):
    """Against Python's engine with one pattern after the other, on markup that breaks off."""
    rng = random.Random(8)
    quotes = ["'" * 3, "'" * 2]
    parts = ["<ref>", "</ref>", "<REF name=a>", "<ref ", "/>", ">", "</Ref>", "[[", "]]", "[", "]", "|", "a", "b c", "\n", "<ref/>", "é", *quotes]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(1500)]
    boxes = ["".join(rng.choices(["{{Infobox", "{{infobox x", "}", "}}", "{", "a", "\n"], k=8)) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in texts + boxes], "t string")
    boxless = sub(F.col("t"), wt._or_skip(wt.LEAD_INFOBOX, r"\{\{Infobox[^}]*+"), "$1", "is")
    rows = df.select("t", wt.strip_refs(F.col("t")).alias("refs"), wt.unwrap_markup(F.col("t")).alias("plain"), boxless.alias("box"))
    for t, refs, plain, box in rows.collect():
        want = re.sub(wt.REF_TAG, "", t, flags=re.I | re.S)
        assert refs == re.sub(wt.REF_SELF, "", want, flags=re.I), t
        want = re.sub(wt.WIKI_LINK, r"\1", t)
        assert plain == re.sub(wt.ITALIC, r"\1", re.sub(wt.BOLD, r"\1", want)), t
        assert box == re.sub(wt.LEAD_INFOBOX, "", t, flags=re.I | re.S), t


@pytest.mark.parametrize("part", ["<ref>", "<ref ", "<ref </ref", "[[a ", "[[a|", "[[", "<!--", "<", "{{", "{{Infobox "])
def test_cleaning_is_linear_in_markup_that_breaks_off(spark, part):
    size = F.length(wt.clean_text(F.col("t")))
    spark.createDataFrame([(part,)], "t string").select(size).collect()  # plan and compile once
    df = spark.createDataFrame([(part * (1_000_000 // len(part)),)], "t string")
    began = time.perf_counter()
    df.select(size).collect()
    assert time.perf_counter() - began < 4  # about half a second alone; the square would take hours


def test_infobox_body(spark):
    texts = [c[0] for c in INFOBOXES]
    assert values(spark, wt.infobox_body, texts) == [c[1] for c in INFOBOXES]
    balanced = values(spark, lambda t: wt.infobox_body(t, balanced=True), texts)
    assert balanced == [c[2] for c in INFOBOXES]


def test_infobox_body_is_linear_in_text_without_braces(spark):
    text = "{{Infobox television|a=1}}" + "word " * 200_000
    assert values(spark, wt.infobox_body, [text]) == ["|a=1"]


def test_field_line_spellings_and_blank_values(spark):
    box = "\n| num seasons = 5\n | Country = US \n| network =\n| runtime = 30\n| first_aired=\n| x = 1999\n| z ="
    line = lambda name: values(spark, lambda t: wt.field_line(t, name), [box])[0]
    assert line("num_seasons") == "5"
    assert line("country") == "US"
    assert line("network") == "| runtime = 30"  # the next line, since blanks include line ends
    assert line("z") is None
    assert line("absent") is None
    fields = values(spark, lambda t: wt.field_values(t, ["network", "country", "num_seasons"]), [box])[0]
    assert tuple(fields) == (None, "US", "5")
    assert values(spark, wt.infobox_year, [box]) == ["1999"]


def test_field_values_checks(spark):
    box = "\n| a = x|y=z and more\n| num_seasons = many\n| num_episodes = about 10\n| b = {{Plainlist|\n* c"
    names = ["a", "num_seasons", "num_episodes", "b"]
    fields = values(spark, lambda t: wt.field_values(t, names), [box])[0]
    assert tuple(fields) == (None, None, "about 10", None)


YEARS = [
    ("\n| first_aired = {{Start date|2008|1|20}}\n", "2008"),
    ("\n| first_aired = unknown\n| released = May 1999\n", "1999"),
    ("\n| first_aired = n\n| first aired = 2001\n", "2001"),
    ("\n| first_aired = 1850 or 12008\n", None),
]


def test_infobox_year(spark):
    assert values(spark, wt.infobox_year, [c[0] for c in YEARS]) == [c[1] for c in YEARS]


SERIES = [
    ("{{Infobox television\n|a}} drama", True),
    ("{{Infobox television episode}}", True),
    ("{{INFOBOX TELEVISION}} (Born 1950)", False),
    ("{{Infobox television}} is an American actor", False),
    ("{{Infobox television}} is a singer", False),
    ("{{Infobox television}} {{Infobox video game}}", False),
    ("<title>Show (season 2)</title>{{Infobox television}}", False),
    ("no box", False),
    (None, False),
]


def test_is_series(spark):
    assert values(spark, wt.is_series, [c[0] for c in SERIES]) == [c[1] for c in SERIES]


TITLES = ["Show (series 2)", "Show (UK season 12)", "Season 3", "Show Series 1", "Four Seasons", "Season of 3x"]


def test_season_titles(spark):
    assert values(spark, wt.season_title, TITLES) == [True, True, True, True, False, False]


def test_lead_paragraph(spark):
    long = "word " * 30
    cases = [
        (f"{{{{Infobox x|a}}}}\nshort\n* {long}\n{long}end\n== S ==\n", (long + "end")),
        (f"[[File:{long}\n  {long}''it''\n", long + "it"),
        ("x" * 100, ""),  # must exceed 100 once cleaned
        ("y" * 600, "y" * 500),
        (f"== first\n{long}", long.strip()),  # a heading on the first line is no cut
        (f"{long}&lt;ref&gt;x\nsecond {long}", f"second {long}".strip()),  # marker left over
        # The box is cut at its first closing brace; what is left can become the lead.
        ("{{Infobox t|a={{b}} tail " + long + "}}", "tail " + long + "}}"),
        (None, ""),
    ]
    assert values(spark, wt.lead_paragraph, [c[0] for c in cases]) == [c[1] for c in cases]


TITLE_KEYS = [
    ("The Law &amp; Order (US)", "law amp order"),
    ("A Team: an a-b", "team b"),
    ("Thé Ünder", "th nder"),
    ("thé x", "x"),  # a combining accent is no letter
    ("Theatre  Anthem", "theatre anthem"),
    (None, ""), ("The (a)", ""),
]


def test_title_key(spark):
    assert values(spark, keys.normalize_title, [c[0] for c in TITLE_KEYS]) == [c[1] for c in TITLE_KEYS]


def test_year_key(spark):
    texts = ["2008", "c. 1999–2001", "1850", "12008", "2100", None, "1990s"]
    assert values(spark, keys.normalize_year, texts) == ["2008", "1999", None, None, None, None, None]
    df = spark.createDataFrame([(2008,), (0,)], "y int")
    assert [r[0] for r in df.select(keys.normalize_year(F.col("y"))).collect()] == ["2008", None]


TOKENS = [
    ("It's O’Neil a.b 1,000.5 x.1 foo_bar", ["it's", "o’neil", "a.b", "1,000.5", "x", "1", "foo_bar"]),
    ("end. Next, (one-two) __ 3rd", ["end", "next", "one", "two", "3rd"]),
    ("東京 ÉTÉ é", ["東", "京", "été", "é"]),
    ("a" * 300, ["a" * 255, "a" * 45]),
    ("", []),
]


def test_tokenize(spark):
    assert values(spark, analysis.tokenize, [c[0] for c in TOKENS]) == [c[1] for c in TOKENS]


def test_tokenize_very_long_chains(spark):
    text = ".".join("ab" for _ in range(100_000))
    assert sum(map(len, values(spark, analysis.tokenize, [text])[0])) == len(text)


@pytest.mark.parametrize("seed", range(3))
def test_term_groups_count_every_token(spark, seed):
    rng = random.Random(seed)
    lists = [[rng.choice("abcdeé") * rng.randint(1, 2) for _ in range(rng.randint(0, 60))] for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(lists)), "i int, t array<string>")
    rows = df.select("i", analysis.term_groups(F.col("t")).alias("g")).collect()
    for row in rows:
        expected = {t: [p for p, x in enumerate(lists[row.i]) if x == t] for t in set(lists[row.i])}
        assert {g.term: g.positions for g in row.g} == expected


PAGE = """<h2 class="t"> <a class="x" href="/tv/1-x">
 Law &amp; Order </a></h2><span class="tag release_date">(2008)</span>
<span class="certification">
 TV-MA
</span><SPAN class="genres"><a href="/g">Drama</a>,&nbsp;<a href="/g"> Crime</a></span>
<li class="profile">
 <p><a href="/p">Ann</a></p>
 <p class="character"> creator </p></li><li class="profile"><p><a>Bob</a></p><p class="character">Writer</p></li>
<div class="user_score_chart" data-id="1" data-percent="89">
<strong><bdi>Status</bdi></strong> Ended <p><strong><bdi>Type</bdi></strong>
 Scripted</p><strong><bdi>Original Language</bdi></strong> English<br>
<section class="keywords right"><ul><li><a href="/k">kw one</a></li></ul></section>
<div id="cast_scroller" class="c"><ol class="p"><li><p><a href="/p">Actor</a></p></li><li><p><a class="z" href="/p">No</a></p></li></ol></div>"""


def test_html_fields(spark):
    sentinel = '<section class="keywords"><p>No keywords have been added.</p></section><ul><li><a>x</a></li></ul>'
    empty = {n: None for n in ("title", "year", "certification", "score", "status", "type", "language")}
    empty |= {n: [] for n in ("genres", "creator", "keywords", "cast")}
    df = spark.createDataFrame([(0, PAGE), (1, sentinel), (2, "")], "i int, h string")
    rows = df.select("i", *[c.alias(n) for n, c in field_columns(F.col("h")).items()]).orderBy("i").collect()
    assert rows[0].asDict() == {
        "i": 0, "title": "Law &amp; Order", "year": 2008, "certification": "TV-MA",
        "genres": ["Drama", " Crime"], "score": 89, "creator": ["Ann"], "status": "Ended",
        "type": "Scripted", "language": "English", "keywords": ["kw one"], "cast": ["Actor"],
    }
    assert rows[1].asDict() == {"i": 1, **empty}
    assert rows[2].asDict() == {"i": 2, **empty}
