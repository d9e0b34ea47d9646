"""Parsing of the short text forms used for parameters."""

from __future__ import annotations

import re

from pyspark.sql import Column


def range_spec(spec: str | int | list[int]) -> list[int]:
    """Whole numbers and inclusive ranges of them, separated by commas: ``'5'``, ``'1,2,3'``, ``'1-10'``, ``'1-3,7'``."""
    items = spec.split(",") if isinstance(spec, str) else [spec] if isinstance(spec, int) else spec
    found: list[int] = []
    for item in (str(i).strip() for i in items):
        match = re.fullmatch(r"(-?\d+)(?:-(\d+))?|", item)
        if not match or (not item and len(items) > 1):
            raise ValueError(f"neither a number nor a range: {item!r} in {spec!r}")
        if item:
            found.extend(range(int(match[1]), int(match[2] or match[1]) + 1))
    return found


def differencing_spec(spec: str) -> tuple[str, int]:
    """``'step,N'`` or ``'season,N'``; empty means pass-through, given as ``('step', 0)``."""
    if not spec:
        return "step", 0
    match = re.fullmatch(r"(step|season),(-?\d+)", spec, flags=re.IGNORECASE)
    if not match:
        raise ValueError(f"unrecognised differencing: {spec!r}")
    return match.group(1).lower(), int(match.group(2))


def year_spec(spec: int | str | None, column: Column) -> Column | None:
    """``1990``, ``'<1990'``, ``'<=1990'``, ``'=1990'``, ``'>=1990'``, ``'>1990'``; ``None``/``'none'`` keeps all."""
    if spec is None or spec == "none":
        return None
    if isinstance(spec, int):
        return column == spec
    match = re.fullmatch(r"(<=|>=|<|>|=)\s*(\d{4})\s*", spec)
    if not match:
        raise ValueError(f"malformed year filter: {spec!r}")
    year = int(match.group(2))
    return {
        "<": column < year,
        "<=": column <= year,
        "=": column == year,
        ">=": column >= year,
        ">": column > year,
    }[match.group(1)]
