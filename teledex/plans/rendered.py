"""Pages and records rendered from the base tables.

Rendering is a projection of the table, so the expected extraction result is plain
SQL over the same table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.html import NO_KEYWORDS
from ..storage import spread


# Tables whose rows are rendered, parsed or analyzed: CPU-bound work per row.
_KEYS = {"documents": "doc_id", "pages": "page_id", "part": "p_partkey"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(rows, _KEYS[name]) if name in _KEYS else rows


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _links(names: Column, before: str, after: str) -> Column:
    linked = F.transform(
        names, lambda n: F.concat(F.lit(f'{before}<a href="/x">'), n, F.lit(f"</a>{after}"))
    )
    return F.array_join(linked, " ")


def html_pages(part: DataFrame) -> DataFrame:
    """``(p_partkey, html)``: a series page per part; every seventh has no keywords and
    every fifth no creator."""
    key, name = F.col("p_partkey"), F.col("p_name")
    words = F.split(name, " ")
    keywords = F.when(key % 7 == 0, F.lit(f"<p>{NO_KEYWORDS}</p><ul></ul>")).otherwise(
        _text("<ul><li>", _links(words, "", "</li><li>"), "</li></ul>")
    )
    creator = F.when(key % 5 == 0, F.lit("")).otherwise(
        _text('<li class="profile">\n <p><a href="/p">', name, '</a></p>\n <p class="character">Creator</p></li>')
    )
    html = _text(
        '<html><h2 class="t"> <a class="n" href="/tv/', key, '-x"> ', name, "\n</a></h2>",
        '<span class="tag release_date">(', 1950 + F.col("p_size"), ")</span>",
        '<span class="certification"> ', F.col("p_brand"), "\n</span>",
        '<span class="genres">', _links(words, "", ","), "</span>",
        '<ol class="people">', creator,
        '<li class="profile"><p><a href="/p">Other</a></p><p class="character">Writer</p></li></ol>',
        '<div class="user_score_chart" data-id="1" data-percent="', F.col("p_size"), '"></div>',
        "<p><strong><bdi>Status</bdi></strong> ", F.when(key % 2 == 0, "Ended").otherwise("Returning Series"), "</p>",
        "<p><strong><bdi>Type</bdi></strong> ", F.col("p_type"), "</p>",
        F.when(key % 3 == 0, "").otherwise("<p><strong><bdi>Original Language</bdi></strong>\n English </p>"),
        '<section class="keywords right">', keywords, "</section>",
        '<div id="cast_scroller" class="c"><ol class="people">',
        _links(words, '<li class="card"><p>', "</p></li>"),
        "</ol></div></html>",
    )
    return part.select("p_partkey", html.alias("html"))


def escaped(text: Column) -> Column:
    """Text as it stands in a dump."""
    for old, new in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def wiki_pages(documents: DataFrame) -> DataFrame:
    """``(doc_id, page)``: a dump page per document, some of a kind to be rejected."""
    key = F.col("doc_id")
    title = (
        F.when(key % 11 == 3, _text("Doc ", key, " (season 2)"))
        .when(key % 11 == 5, _text("Talk:Doc ", key))
        .when(key % 13 == 7, _text("List of docs ", key))
        .otherwise(_text("Doc ", key, " &amp; co"))
    )
    aired = F.when(key % 7 == 0, _text("\n| released = ", 1950 + key % 70)).otherwise(
        _text("{{Start date|", 1950 + key % 70, "|1|20}}")
    )
    box = _text(
        "{{Infobox television\n| name = Doc\n| country = ", F.col("lang"),
        "\n| network = [[", F.col("source"), "|The ", F.col("source"), "]]",
        F.when(key % 2 == 0, "\n| num_seasons = ").otherwise("\n| num seasons = "),
        F.when(key % 9 == 0, "TBA").otherwise((key % 9).cast("string")),
        "\n| num_episodes = ", F.col("n_chars"), "<!-- now -->",
        "\n| runtime = '''", key % 60, "''' minutes",
        "\n| first_aired = ", aired, "\n}}\n",
    )
    body = _text(
        F.when(key % 19 == 6, "#REDIRECT [[Doc]]\n").otherwise(""),
        F.when(key % 23 == 8, "{{Infobox person\n| name = x\n}}\n").otherwise(""),
        F.when(key % 29 == 9, "").otherwise(box),
        escaped(F.col("text")),
        "\n== Cast ==\nnone",
    )
    page = _text(
        "  <page>\n    <title>", title, "</title>\n    <ns>", F.when(key % 17 == 4, "1").otherwise("0"),
        '</ns>\n    <revision>\n      <text bytes="', F.col("n_chars"), '" xml:space="preserve">',
        body, "</text>\n    </revision>\n  </page>",
    )
    return documents.select("doc_id", page.alias("page"))


def series_pages(part: DataFrame) -> DataFrame:
    """``(p_partkey, page)``: a dump page for every part; every third is under its own name."""
    key = F.col("p_partkey")
    name = F.when(key % 3 == 0, F.col("p_name")).otherwise(_text("Part ", key))
    page = _text(
        "<page><title>The ", name, "</title><ns>0</ns><text>{{Infobox television\n| network = ",
        F.col("p_brand"), "\n| first_aired = ", 1950 + F.col("p_size"), "\n| country = ",
        F.col("p_type"), "\n| num_episodes = ", F.col("p_size"), "\n}}\nPart ", key, " '''", name,
        "''' ", F.repeat(_text(F.col("p_type"), " "), 20), "</text></page>",
    )
    return part.select("p_partkey", page.alias("page"))


def html_records(part: DataFrame) -> DataFrame:
    """HTML-side records of the match: decorated titles, integer years, some null."""
    key = F.col("p_partkey")
    return part.select(
        _text("The ", F.col("p_name"), " (", F.col("p_brand"), ")").alias("title"),
        F.when(key % 10 != 9, 1950 + F.col("p_size")).alias("year"),
        F.col("p_brand").alias("certification"),
        F.split("p_name", " ").alias("genres"),
        (key % 100).cast("int").alias("score"),
        F.when(key % 4 != 0, F.array(F.col("p_type"))).alias("creator"),
        F.lit("Ended").alias("status"),
        F.col("p_type").alias("type"),
        F.lit("English").alias("language"),
        F.array(F.col("p_brand")).alias("keywords"),
        F.array(key.cast("string")).alias("cast"),
    )


def wiki_records(part: DataFrame) -> DataFrame:
    """Wiki-side records of every part, years as text. Every third has its own name,
    upper-cased, but for some titles that hold nothing but an article; others match none."""
    key = F.col("p_partkey")
    name = F.when(key % 3 == 0, F.upper("p_name")).otherwise(_text("PART ", key))
    return part.select(
        F.when(key % 30 == 0, "The (a)").otherwise(_text(name, "!")).alias("title"),
        F.when(key % 12 != 0, _text("c. ", 1950 + F.col("p_size"))).alias("year"),
        F.col("p_brand").alias("country"),
        (key % 8).cast("string").alias("num_seasons"),
        F.col("p_size").cast("string").alias("num_episodes"),
        F.lit("45 minutes").alias("runtime"),
        F.col("p_type").alias("network"),
        key.cast("string").alias("plot"),
    )


def catalogue(documents: DataFrame) -> DataFrame:
    """Merged-style records to index, one per document, with every searchable field."""
    key = F.col("doc_id")
    return documents.select(
        "doc_id",
        _text("Doc ", key).alias("title"),
        (1950 + key % 70).cast("int").alias("year"),
        F.when(key % 3 != 0, _text("TV ", key % 5)).alias("certification"),
        F.array("source", "lang").alias("genres"),
        (key % 5).cast("int").alias("score"),
        F.when(key % 4 != 0, F.array(_text("Creator ", key % 6))).alias("creator"),
        F.when(key % 2 == 0, "Ended").otherwise("").alias("status"),
        F.lit("Scripted").alias("type"),
        F.col("lang").alias("language"),
        F.when(key % 7 == 0, F.array().cast("array<string>")).otherwise(F.array(_text("kw", key % 9), F.lit("series"))).alias("keywords"),
        F.array(_text("Person ", key % 10)).alias("cast"),
        F.col("lang").alias("country"),
        (key % 8).cast("string").alias("num_seasons"),
        F.col("n_chars").cast("string").alias("num_episodes"),
        _text(20 + key % 50, " minutes").alias("runtime"),
        F.col("source").alias("network"),
        F.col("text").alias("plot"),
    )


def benchmark_queries(benchmark: DataFrame) -> DataFrame:
    """One query per benchmark text, with words of all other fields, and a blank one beside
    each under a negative id."""
    key = F.col("item_id")
    text = _text(F.col("text"), " ", 1950 + key % 70, " person creator minutes Ended kw", key % 9, " tv src", key % 20, " ", key % 10)
    blank = benchmark.select((-1 - key).alias("query_id"), F.lit("  ").alias("text"))
    return benchmark.select(key.alias("query_id"), text.alias("text")).unionByName(blank)
