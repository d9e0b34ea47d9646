"""Casts from stored text to analytic values (float32 widened to double)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

BAD_VALUE_POLICIES = ("zero", "null", "drop")

# Measures read as decimals or as whole numbers, blank meaning 0.
DECIMAL_MEASURES = ("rain", "temp", "wetb", "dewpt", "vappr", "msl", "sun")
WHOLE_MEASURES = ("rhum", "wddir", "vis", "wdsp", "ww", "w", "clht", "clamt")

# Short and long names of the cell types.
CELL_TYPES = {
    "str": "string",
    "int": "int",
    "lng": "bigint",
    "long": "bigint",
    "flt": "float",
    "float": "float",
    "dbl": "double",
    "double": "double",
}


def as_float32(value: Column) -> Column:
    """Narrow to float32 precision, kept in a double column."""
    return value.cast("float").cast("double")


def _number(raw: Column, spark_type: str = "float") -> Column:
    """Text as a number, else NULL. Spark takes ``nan`` and ``inf`` in any case; only the exact
    spellings NaN and Infinity are numbers here. Words can only give a result that is not finite, so
    no other cell is searched for them."""
    text = F.trim(raw)
    number = F.when(text != "", text.try_cast(spark_type))  # a blank would fail by an exception in each cell
    if spark_type not in ("float", "double"):
        return number.cast("double")
    number = number.cast("double")
    not_finite = F.isnan(number) | (F.abs(number) == float("inf"))
    other_spelling = F.lower(text).rlike("^[+-]?(nan|inf|infinity)$") & ~text.rlike("^[+-]?(NaN|Infinity)$")
    return F.when(not_finite & other_spelling, F.lit(None)).otherwise(number)


def analytic_value(raw: Column, on_bad: str = "zero", spark_type: str = "float") -> Column:
    """Text to float32-widened double. Bad text becomes 0, or NULL for ``null`` and ``drop``."""
    if on_bad not in BAD_VALUE_POLICIES:
        raise ValueError(f"on_bad must be one of {BAD_VALUE_POLICIES}, not {on_bad!r}")
    number = as_float32(_number(raw, spark_type))
    if on_bad == "zero":
        return F.coalesce(number, F.when(raw.isNotNull(), F.lit(0.0)))
    return number


def blank_to_zero(raw: Column, measure: Column) -> Column:
    """Blank cells of the known numeric measures become 0; all other text is kept."""
    numeric = measure.isin(*DECIMAL_MEASURES, *WHOLE_MEASURES)
    return F.when(numeric & (F.trim(raw) == ""), F.lit("0")).otherwise(raw)


def parse_type_map(spec: str) -> list[tuple[str, str]]:
    """``type(regex),type(regex)`` to ``[(regex, spark type)]``; entries of another form are skipped."""
    rules = []
    for entry in spec.split(","):
        match = re.fullmatch(r"(\w{3,})\((.+)\)", entry.strip())  # fixed value: the form of an entry
        if match and match.group(1) in CELL_TYPES:
            rules.append((match.group(2), CELL_TYPES[match.group(1)]))
    return rules


def decode_cell(series: Column, raw: Column, rules: list[tuple[str, str]], on_bad: str = "zero") -> Column:
    """Decode a text cell by the first rule whose regex matches the whole series name.

    A series no rule matches decodes to NULL. Every type ends as a float32-widened double, and ``on_bad`` says what
    text becomes that is no such number.
    """
    decoded = F.lit(None).cast("double")
    for regex, spark_type in reversed(rules):
        value = analytic_value(raw, on_bad, "float" if spark_type == "string" else spark_type)
        decoded = F.when(series.rlike(f"^(?:{regex})$"), value).otherwise(decoded)
    return decoded
