"""Columns that hold Python literals or JSON as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from signalweave.functions.matching import as_column
from signalweave.sources.schemas import METRICS

# Python spellings, replaced only where they stand as a value (after : [ or ,).
_VALUE = r"([:\[,]\s*){}\b"


def as_json(c: Column | str) -> Column:
    column = as_column(c)
    spelled = column
    for python, json in (("None", "null"), ("True", "true"), ("False", "false")):
        spelled = F.regexp_replace(spelled, _VALUE.format(python), f"$1{json}")
    present = column.contains("None") | column.contains("True") | column.contains("False")
    return F.when(present, spelled).otherwise(column)


def parse_list(c: Column | str) -> Column:
    """`"['china', 'iran']"` to ARRAY<STRING>; text that is no list becomes a list of itself."""
    column = as_column(c)
    parsed = F.when(F.ltrim(column).startswith("["), F.from_json(column, "array<string>"))
    return F.coalesce(parsed, F.when(column.isNotNull(), F.array(column)))


def parse_metrics(c: Column | str) -> Column:
    """Engagement counters from a literal dict; a missing counter is NULL, not the whole row."""
    return F.from_json(as_json(c), METRICS)
