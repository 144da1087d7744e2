"""Raw CSV sources: one declared format per file, bad lines set aside.

Eight sources are plain line files and split freely. Review text holds commas, quotes
and line breaks inside quotes: where a record ends can only be told from the start of its
file, so Spark's multi-line reader takes one task per file, whatever its size. It runs
in parallel over files; large exports of reviews should come as several.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from bazaarlake.sources.schemas import BRONZE

BAD_LINE = "_bad_line"
TIMESTAMP = "yyyy-MM-dd HH:mm:ss"


@dataclass(frozen=True)
class CsvSource:
    name: str
    line_end: str = "\n"
    line_breaks_in_text: bool = False

    @property
    def schema(self) -> StructType:
        return BRONZE[self.name]

    @property
    def landing_schema(self) -> StructType:
        """The declared columns, then the text of a line that does not fit them."""
        return StructType([*self.schema.fields, StructField(BAD_LINE, StringType())])


# ---- fixed values: line ends and quoting of the nine files -------------------------
SOURCES = {
    s.name: s
    for s in (
        CsvSource("category_translation", line_end="\r\n"),
        CsvSource("customers"),
        CsvSource("geolocation"),
        CsvSource("order_items"),
        CsvSource("order_payments"),
        CsvSource("order_reviews", line_end="\r\n", line_breaks_in_text=True),
        CsvSource("orders"),
        CsvSource("products"),
        CsvSource("sellers"),
    )
}


def _options(source: CsvSource, raw_quotes: bool) -> dict[str, str]:
    quoted = source.line_breaks_in_text or not raw_quotes
    return {
        "sep": ",",
        "encoding": "UTF-8",
        "quote": '"' if quoted else "",
        "escape": '"' if quoted else "\\",
        "lineSep": source.line_end,
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": BAD_LINE,
        "timestampNTZFormat": TIMESTAMP,
    }


def read_raw(
    spark: SparkSession,
    source: CsvSource,
    path: str,
    raw_quotes: bool = False,
    header: bool = True,
) -> DataFrame:
    """Typed rows plus ``_bad_line``: the text of a line that does not fit, else NULL.

    An empty field is NULL. ``raw_quotes`` keeps double quotes as part of the value
    and splits on every comma, as a loader without quote support does.
    """
    options = _options(source, raw_quotes)
    reader = spark.read.schema(source.landing_schema).options(header=header, **options)
    if not source.line_breaks_in_text:
        return reader.csv(path)
    return reader.option("multiLine", "true").csv(path)


def bad_lines(source: CsvSource) -> Column:
    """How many lines of its file a row stands for as a reject; 0 for a good row."""
    breaks = F.regexp_count(F.rtrim(BAD_LINE), F.lit("\r\n|\n"))
    lines = breaks + 1 if source.line_breaks_in_text else F.lit(1)
    return F.when(F.col(BAD_LINE).isNotNull(), lines).otherwise(0)


def accepted(landed: DataFrame) -> DataFrame:
    return landed.filter(F.col(BAD_LINE).isNull()).drop(BAD_LINE)


def rejected(landed: DataFrame, source_name: str) -> DataFrame:
    return landed.filter(F.col(BAD_LINE).isNotNull()).select(
        F.lit(source_name).alias("source_name"), F.col(BAD_LINE).alias("bad_line")
    )
