"""Registered queries on wiki extraction, with their SQL equivalents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import wikitext as wt
from ..functions.entities import unescape_entities
from ..functions.regex import capture
from ..operators import wiki_records as op
from ..sources.text import find_dump, read_wiki_pages
from ..storage import new_path
from .rendered import _text, escaped, table, wiki_pages


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wiki_pages(_documents(spark, sf_dir))


def write_dump(pages: DataFrame, path: str, **options: str) -> None:
    """Page rows as dump files."""
    pages.select(F.col("page").alias("value")).write.options(**options).text(path)


def wiki_pages_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "dump")
    write_dump(_pages(spark, sf_dir), path)
    page = F.col("page")
    return read_wiki_pages(spark, path).select(
        capture(page, r"<title>(.+?)</title>").alias("title"),
        F.length(wt.page_text(page)).cast("bigint").alias("n_text"),
        F.md5(wt.page_text(page)).alias("text_md5"),
    )


def wiki_dump_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder with the dump in two forms, of which the packed one is read."""
    folder = new_path(spark, "dumps")
    write_dump(_pages(spark, sf_dir), f"{folder}/enwiki.xml.gz", compression="gzip")
    write_dump(_pages(spark, sf_dir), f"{folder}/plwiki.xml")
    page = F.col("page")
    return read_wiki_pages(spark, find_dump(spark, folder)).select(
        capture(page, r"<title>(.+?)</title>").alias("title"), F.md5(wt.page_text(page)).alias("text_md5")
    )


def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, lang, source = F.col("doc_id"), F.col("lang"), F.col("source")
    decorated = _text(
        " '''Doc ", key, "''' <!-- ", source, "\nhidden -->{{cite|{{nested|", lang, "}}|x}}",
        escaped(F.col("text")), '<ref name="a">see ', source, "\n</ref><ref name=b /> [[", source,
        "|label ", lang, "]] ''it'' <b>bold</b>&nbsp;&#8211;&amp;lt;\t",
    )
    leftover = (
        F.when(key % 4 == 0, " TBA\n")
        .when(key % 4 == 1, _text("| left ", key))
        .when(key % 4 == 2, _text("a ref ", key))
    )
    documents = _documents(spark, sf_dir)
    texts = documents.select("doc_id", decorated.alias("value"))
    texts = texts.unionByName(documents.select((-1 - key).alias("doc_id"), leftover.alias("value")))
    return texts.select("doc_id", wt.clean_text(F.col("value")).alias("cleaned"))


def clean_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    depth = (F.col("doc_id") % 7 + 1).cast("int")
    nested = _text(
        F.col("text"), F.repeat(F.lit("{{a "), depth), F.col("lang"), F.repeat(F.lit("}}"), depth)
    )
    return _documents(spark, sf_dir).select("doc_id", wt.strip_templates(nested).alias("stripped"))


def strip_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", wt.strip_tags(F.col("html")).alias("stripped"))


def unescape_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(
        "page_id", unescape_entities(F.col("html")).alias("decoded")
    )


def wiki_markup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = _text(
        "[[", F.col("source"), "]] [[Page|", F.col("lang"), "]] '''''", F.col("source"), "''''' ",
        F.col("text"), " ''", F.col("lang"), "'' [[a|b|c]]",
    )
    return _documents(spark, sf_dir).select("doc_id", wt.unwrap_markup(marked).alias("plain"))


def infobox_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four brace shapes: plain, nested, doubly nested (ends early), unclosed."""
    shape = F.col("doc_id") % 4
    start = F.when(F.col("doc_id") % 3 == 0, "{{infobox TELEVISION").otherwise("{{Infobox television")
    box = (
        F.when(shape == 0, _text("| a = ", F.col("source"), "\n}}"))
        .when(shape == 1, _text("| a = {{d|", F.col("source"), "}} {b}\n}}"))
        .when(shape == 2, _text("| a = {{x|{{y|", F.col("source"), "}}}}| b = 1\n}}"))
        .otherwise(_text("| a = {{d|", F.col("source"), "}}\n"))
    )
    text = _text("{{short}} ", F.col("lang"), start, box, F.col("text"), " {{other}}")
    titled = _documents(spark, sf_dir).select(
        F.col("doc_id").cast("string").alias("title"), text.alias("text")
    )
    return op.with_infobox(titled).select(F.col("title").cast("bigint").alias("doc_id"), "infobox")


def _boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Infobox bodies with spelling variants, blanks and malformed values."""
    key = F.col("doc_id")
    box = _text(
        "\n | Country = ", F.col("lang"), "<br />", F.col("source"), " ",
        "\n|network=", F.when(key % 3 == 0, "").otherwise(_text("[[", F.col("source"), "]]")),
        F.when(key % 2 == 0, "\n| num_seasons  =  ").otherwise("\n| num seasons = "),
        F.when(key % 5 == 0, "several").otherwise(_text("'''", key % 9, "'''")),
        "\n| num_episodes = a|b=", F.col("n_chars"),
        F.when(key % 4 == 0, "\n| first aired = ").otherwise("\n| first_aired = "),
        F.when(key % 6 == 0, "unknown").otherwise(_text("{{start|", 1950 + key % 70, "}}")),
        "\n| released = 20", F.lpad((key % 100).cast("string"), 2, "0"),
        "\n| runtime = ", F.when(key % 7 == 0, "{{Plainlist|").otherwise(_text(key % 60, " min&nbsp;x")),
        "\n| notes = ", escaped(F.col("text")), "\n* more\n",
    )
    return _documents(spark, sf_dir).select("doc_id", box.alias("box"))


def infobox_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["country", "network", "num_seasons", "num_episodes", "runtime", "notes"]
    values = wt.field_values(F.col("box"), names)
    return _boxes(spark, sf_dir).select("doc_id", F.inline(F.array(values)))


def infobox_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _boxes(spark, sf_dir).select("doc_id", wt.infobox_year(F.col("box")).alias("year"))


def page_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("doc_id")
    text = _text(
        F.when(key % 5 == 0, "{{Infobox Television episode\n").otherwise("{{infobox television\n"),
        F.when(key % 7 == 1, "{{Infobox Film\n").otherwise(""),
        F.when(key % 11 == 2, "Jo (Born 1950)").otherwise(""),
        F.when(key % 13 == 3, "She is an American  actress").otherwise(""),
        F.when(key % 17 == 4, "<title>Show Series 4</title>").otherwise(""),
        F.col("text"),
    )
    text = F.when(key % 19 == 5, F.col("text")).otherwise(text)
    return _documents(spark, sf_dir).select("doc_id", wt.is_series(text).alias("is_series"))


def lead_paragraph(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = _text(
        "{{Infobox television\n| a = b\n}}\n* a list ", F.repeat(F.lit("x "), 60), "\nshort\n  ",
        escaped(F.col("text")), "\n== Plot ==\n", F.repeat(F.lit("late "), 60),
    )
    return _documents(spark, sf_dir).select("doc_id", wt.lead_paragraph(text).alias("plot"))


def page_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.gate_pages(_pages(spark, sf_dir)).select("title", F.md5("text").alias("text_md5"))


def wiki_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.extract_wiki_records(_pages(spark, sf_dir))


def record_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = op.completeness(wiki_record(spark, sf_dir))
    return flags.select(
        "title", "has_year", "has_country", "has_num_seasons", "has_num_episodes", "has_network",
        "has_plot", "has_episode_data", "useful_count",
    )


def extract_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = op.partition_counts(wiki_record(spark, sf_dir))
    return counts.agg(F.sum("rows").alias("records"))


QUERIES = {
    "wiki_pages_split": wiki_pages_split,
    "wiki_dump_choice": wiki_dump_choice,
    "clean_text": clean_text,
    "clean_templates": clean_templates,
    "strip_tags": strip_tags,
    "unescape_entities": unescape_html,
    "wiki_markup": wiki_markup,
    "infobox_extract": infobox_extract,
    "infobox_fields": infobox_fields,
    "infobox_year": infobox_year,
    "page_classifier": page_classifier,
    "lead_paragraph": lead_paragraph,
    "page_gate": page_gate,
    "wiki_record": wiki_record,
    "record_completeness": record_completeness,
    "extract_counts": extract_counts,
}


def _escaped_sql(text: str) -> str:
    for old, new in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = f"replace({text}, '{old}', '{new}')"
    return text


def _collapsed_sql(text: str) -> str:
    return rf"trim(regexp_replace({text}, '\s+', ' ', 'g'))"


# Lead: first line of the text, as it stands in the dump, that is long enough and no
# list or table line; decoded and collapsed it must still be long enough.
_LEAD_SQL = rf"""
    SELECT doc_id, coalesce(list_filter(list_transform(list_filter(
            list_transform(string_split({_escaped_sql("text")}, chr(10)), lambda x: trim(x)),
            lambda x: length(x) >= 100
                AND NOT regexp_matches(x, '^(\{{\{{|\[\[Category|\[\[File|\[\[Image|[=|#*:]|<!--)')),
            lambda x: {_collapsed_sql("replace(replace(x, '&quot;', chr(34)), '&amp;', '&')")}),
        lambda x: length(x) > 100)[1][1:500], '') AS plot
    FROM documents"""

_TITLE_SQL = """
    CASE WHEN doc_id % 11 = 3 THEN 'Doc ' || doc_id || ' (season 2)'
        WHEN doc_id % 11 = 5 THEN 'Talk:Doc ' || doc_id
        WHEN doc_id % 13 = 7 THEN 'List of docs ' || doc_id
        ELSE 'Doc ' || doc_id || ' &amp; co' END"""
_GATE_SQL = "doc_id % 11 NOT IN (3, 5) AND doc_id % 13 <> 7 AND doc_id % 17 <> 4 AND doc_id % 19 <> 6"

_RECORD_SQL = f"""
    SELECT 'Doc ' || d.doc_id || ' &amp; co' AS title, CAST(1950 + d.doc_id % 70 AS VARCHAR) AS year,
        lang AS country,
        CASE WHEN d.doc_id % 9 = 0 THEN NULL ELSE CAST(d.doc_id % 9 AS VARCHAR) END AS num_seasons,
        CAST(n_chars AS VARCHAR) AS num_episodes, (d.doc_id % 60) || ' minutes' AS runtime,
        'The ' || source AS network, plot
    FROM documents d JOIN ({_LEAD_SQL}) p ON d.doc_id = p.doc_id
    WHERE {_GATE_SQL.replace("doc_id", "d.doc_id")} AND d.doc_id % 23 <> 8 AND d.doc_id % 29 <> 9"""

_PAGE_TEXT_SQL = f"""
            CASE WHEN doc_id % 19 = 6 THEN '#REDIRECT [[Doc]]' || chr(10) ELSE '' END
            || CASE WHEN doc_id % 23 = 8 THEN '{{{{Infobox person' || chr(10) || '| name = x'
                || chr(10) || '}}}}' || chr(10) ELSE '' END
            || CASE WHEN doc_id % 29 = 9 THEN '' ELSE
                concat_ws(chr(10), '{{{{Infobox television', '| name = Doc', '| country = ' || lang,
                    '| network = [[' || source || '|The ' || source || ']]',
                    CASE WHEN doc_id % 2 = 0 THEN '| num_seasons = ' ELSE '| num seasons = ' END
                        || CASE WHEN doc_id % 9 = 0 THEN 'TBA' ELSE CAST(doc_id % 9 AS VARCHAR) END,
                    '| num_episodes = ' || n_chars || '<!-- now -->',
                    '| runtime = ' || repeat(chr(39), 3) || (doc_id % 60) || repeat(chr(39), 3) || ' minutes',
                    '| first_aired = ' || CASE WHEN doc_id % 7 = 0
                        THEN chr(10) || '| released = ' || (1950 + doc_id % 70)
                        ELSE '{{{{Start date|' || (1950 + doc_id % 70) || '|1|20}}}}' END,
                    '}}}}', '') END
            || {_escaped_sql("text")} || chr(10) || '== Cast ==' || chr(10) || 'none'"""
_NOTES_SQL = _collapsed_sql(r"regexp_extract(text, '\S[^\n]*')")

ORACLES = {
    "wiki_pages_split": f"""
        SELECT {_TITLE_SQL} AS title, CAST(length({_PAGE_TEXT_SQL}) AS BIGINT) AS n_text,
            md5({_PAGE_TEXT_SQL}) AS text_md5
        FROM documents""",
    "wiki_dump_choice": f"SELECT {_TITLE_SQL} AS title, md5({_PAGE_TEXT_SQL}) AS text_md5 FROM documents",
    "clean_text": f"""
        SELECT doc_id,
            {_collapsed_sql("'Doc ' || doc_id || ' ' || text || ' label ' || lang || ' it bold –<'")}
            AS cleaned
        FROM documents UNION ALL SELECT -1 - doc_id, '' FROM documents""",
    "clean_templates": """
        SELECT doc_id, text
            || CASE WHEN doc_id % 7 < 5 THEN '' ELSE repeat('{{a ', CAST(doc_id % 7 - 4 AS INTEGER))
                || repeat('}}', CAST(doc_id % 7 - 4 AS INTEGER)) END AS stripped
        FROM documents""",
    "strip_tags": "SELECT page_id, regexp_replace(html, '<[^>]+>', '', 'g') AS stripped FROM pages",
    # These four also count without a semicolon, as where a title was cut off.
    "unescape_entities": """
        SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
            '&middot;?', '·', 'g'), '&copy;?', '©', 'g'), '&quot;?', '"', 'g'),
            '&amp;?', '&', 'g') AS decoded
        FROM pages""",
    "wiki_markup": """
        SELECT doc_id, source || ' ' || lang || ' ' || source || ' ' || text || ' ' || lang || ' b|c' AS plain
        FROM documents""",
    "infobox_extract": """
        SELECT doc_id, CASE doc_id % 4
            WHEN 0 THEN '| a = ' || source || chr(10)
            WHEN 1 THEN '| a = {{d|' || source || '}} {b}' || chr(10)
            ELSE '| a = {{x|{{y|' || source || '}}' END AS infobox
        FROM documents WHERE doc_id % 4 <> 3""",
    "infobox_fields": f"""
        SELECT doc_id, lang || source AS country,
            CASE WHEN doc_id % 3 = 0 THEN NULL ELSE source END AS network,
            CASE WHEN doc_id % 5 = 0 THEN NULL ELSE CAST(doc_id % 9 AS VARCHAR) END AS num_seasons,
            CAST(NULL AS VARCHAR) AS num_episodes,
            CASE WHEN doc_id % 7 = 0 THEN NULL ELSE (doc_id % 60) || ' min x' END AS runtime,
            CASE WHEN lower(notes) NOT IN ('', 'yes', 'no', 'n/a', 'various', 'tba', 'tbd', 'none', 'present')
                AND NOT (contains(lower(notes), 'ref') AND length(notes) < 50)
                AND NOT starts_with(notes, '|') AND NOT (contains(notes[1:20], '|') AND contains(notes[1:20], '='))
                THEN notes END AS notes
        FROM (SELECT *, {_NOTES_SQL} AS notes FROM documents)""",
    "infobox_year": """
        SELECT doc_id, CASE WHEN doc_id % 6 = 0 THEN '20' || lpad(CAST(doc_id % 100 AS VARCHAR), 2, '0')
            ELSE CAST(1950 + doc_id % 70 AS VARCHAR) END AS year
        FROM documents""",
    "page_classifier": """
        SELECT doc_id, doc_id % 19 <> 5 AND doc_id % 7 <> 1 AND doc_id % 11 <> 2 AND doc_id % 13 <> 3
            AND doc_id % 17 <> 4 AS is_series
        FROM documents""",
    "lead_paragraph": _LEAD_SQL,
    "page_gate": f"SELECT {_TITLE_SQL} AS title, md5({_PAGE_TEXT_SQL}) AS text_md5 FROM documents WHERE {_GATE_SQL}",
    "wiki_record": _RECORD_SQL,
    "record_completeness": f"""
        SELECT title, TRUE AS has_year, TRUE AS has_country, num_seasons IS NOT NULL AS has_num_seasons,
            TRUE AS has_num_episodes, TRUE AS has_network, length(plot) > 100 AS has_plot,
            TRUE AS has_episode_data,
            CAST(4 + CAST(num_seasons IS NOT NULL AS INTEGER)
                + CAST(length(plot) > 100 AS INTEGER) AS INTEGER) AS useful_count
        FROM ({_RECORD_SQL})""",
    "extract_counts": f"SELECT count(*) AS records FROM ({_RECORD_SQL})",
}
