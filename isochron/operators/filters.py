"""Row predicates and column choice."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import reduce
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Condition(NamedTuple):
    """``op`` is one of ``< <= = >= >``, ``in``, or ``None`` to keep every row.

    ``value`` is a scalar, a list (``<``/``<=`` compare with its least, ``>``/``>=`` with its greatest
    element, ``=`` and ``in`` test membership) or ``'max'``/``'min'`` of the column itself.
    """

    column: str
    op: str | None
    value: Any = None


def _compare(column: Column, op: str, target: Any) -> Column:
    return {
        "<": lambda: column < target,
        "<=": lambda: column <= target,
        "=": lambda: column == target,
        ">=": lambda: column >= target,
        ">": lambda: column > target,
    }[op]()


def predicate(condition: Condition) -> Column:
    """Column predicate of a condition on plain values."""
    name, op, value = condition
    column = F.col(name)
    if op is None:
        return F.lit(True)
    if op == "in" or (op == "=" and isinstance(value, (list, tuple, set))):
        return column.isin(*value)
    if isinstance(value, (list, tuple, set)):
        value = min(value) if op in ("<", "<=") else max(value)
    return _compare(column, op, value)


def _against_extreme(df: DataFrame, condition: Condition) -> DataFrame:
    """Compare with the column's own extreme, a scalar subquery that runs once."""
    extreme = (F.max if condition.value == "max" else F.min)(condition.column)
    return df.filter(_compare(F.col(condition.column), condition.op, df.agg(extreme).scalar()))


def keep_where(df: DataFrame, conditions: Condition | Iterable[Condition] | None = None) -> DataFrame:
    """Apply the conditions in order; plain ones next to each other become one filter."""
    if conditions is None:
        return df
    if isinstance(conditions, Condition):
        conditions = [conditions]
    pending: list[Column] = []

    def flush(frame: DataFrame) -> DataFrame:
        return frame.filter(reduce(lambda a, b: a & b, pending)) if pending else frame

    for condition in conditions:
        extreme = condition.op is not None and isinstance(condition.value, str) and condition.value in ("max", "min")
        if not extreme:
            pending.append(predicate(condition))
            continue
        df = _against_extreme(flush(df), condition)
        pending.clear()
    return flush(df)


def columns_matching(columns: Sequence[str], regexes: str | Sequence[str], never: Sequence[str] = ("date",)) -> list[str]:
    """Columns whose whole name matches one of the regexes (a list, or comma-separated)."""
    listed = regexes.split(",") if isinstance(regexes, str) else regexes
    return [c for c in columns if c not in never and any(re.fullmatch(r, c) for r in listed)]


def columns_with_prefix(columns: Sequence[str], prefixes: Sequence[str]) -> list[str]:
    """Columns starting with one of the prefixes: ``w`` also takes ``wetb`` and ``wdsp``."""
    return [c for c in columns if c.startswith(tuple(prefixes))]


def series_with_prefix(df: DataFrame, prefixes: Sequence[str], name: str = "series") -> DataFrame:
    """The same choice on long rows."""
    return df.filter(reduce(lambda a, b: a | b, [F.col(name).startswith(p) for p in prefixes]))


def drop_station_columns(df: DataFrame, station: int, prefixes: Sequence[str]) -> DataFrame:
    """Drop a station's columns that no prefix asks for."""
    own = [c for c in df.columns if re.fullmatch(rf".*_{station}", c)]
    kept = set(columns_with_prefix(own, prefixes))
    return df.drop(*[c for c in own if c not in kept])


def without_stat_rows(df: DataFrame, key: str = "key") -> DataFrame:
    """Drop statistics rows, whose key starts with ``#``."""
    return df.filter(~F.col(key).startswith("#"))
