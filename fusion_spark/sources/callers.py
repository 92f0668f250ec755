"""Raw result tables of the fusion callers, all columns as text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fusion_spark.operators.calls import PARSERS, parse_tool
from fusion_spark.sources.text import read_delimited, read_lines, with_file_order

# Callers without a header row are read as lines and split by position.
HEADERLESS = ("mapsplice",)


def raw_calls(
    spark: SparkSession, tool: str, path: str | list[str], ordered: bool = False
) -> DataFrame:
    """The rows of a caller; ``ordered`` adds their arrival order ``_ord``."""
    rows = read_lines(spark, path) if tool in HEADERLESS else read_delimited(spark, path, "\t")
    return with_file_order(rows) if ordered else rows


def read_tool(
    spark: SparkSession, tool: str, path: str | list[str],
    summary_path: str | list[str] | None = None, ordered: bool = False,
) -> DataFrame:
    """Normalised calls of one tool; ``summary_path`` is the list with reciprocal marks.

    ``ordered`` carries the arrival order of the rows along as ``_ord``.
    """
    if tool not in PARSERS:
        return parse_tool(spark, tool, None)
    extra = read_lines(spark, summary_path) if summary_path else None
    return parse_tool(spark, tool, raw_calls(spark, tool, path, ordered), extra)
