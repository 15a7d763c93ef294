"""HTML pages -> typed series records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.html import field_columns
from ..schemas import HTML_RECORD


def extract_html_records(pages: DataFrame, html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """One record per page, narrow and without Python workers.

    Absent scalars are null and absent lists empty, so a page that is no series
    page still gives a row. ``keep`` names input columns to carry along.
    """
    fields = field_columns(F.col(html))
    typed = [fields[f.name].cast(f.dataType).alias(f.name) for f in HTML_RECORD]
    return pages.select(*(keep or []), *typed)
