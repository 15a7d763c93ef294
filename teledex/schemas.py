"""Record schemas of every stage. All fields are nullable."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType


def _struct(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields])


_TEXT, _INT, _LIST = StringType(), IntegerType(), ArrayType(StringType())

HTML_RECORD = _struct(
    ("title", _TEXT),
    ("year", _INT),
    ("certification", _TEXT),
    ("genres", _LIST),
    ("score", _INT),
    ("creator", _LIST),
    ("status", _TEXT),
    ("type", _TEXT),
    ("language", _TEXT),
    ("keywords", _LIST),
    ("cast", _LIST),
)

WIKI_RECORD = _struct(
    ("title", _TEXT),
    ("year", _TEXT),
    ("country", _TEXT),
    ("num_seasons", _TEXT),
    ("num_episodes", _TEXT),
    ("runtime", _TEXT),
    ("network", _TEXT),
    ("plot", _TEXT),
)

# Wiki fields a match adds to an HTML record.
WIKI_ADDITIONS = ["country", "num_seasons", "num_episodes", "runtime", "network", "plot"]

MERGED_RECORD = StructType(
    HTML_RECORD.fields + [WIKI_RECORD[name] for name in WIKI_ADDITIONS]
)
