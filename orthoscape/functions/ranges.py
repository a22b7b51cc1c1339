"""Readers of values with a range: for settings given as text, and for columns of text."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _read(kind: Callable, wanted: str, holds: Callable[[float], bool]) -> Callable:
    def read(value):
        try:
            out = kind(value)
        except (TypeError, ValueError):
            raise ValueError(f"expected {wanted}, got {value!r}") from None
        if not math.isfinite(out) or not holds(out):
            raise ValueError(f"expected {wanted}, got {value!r}")
        return out

    return read


positive_int = _read(int, "a positive integer", lambda x: x > 0)
nonnegative_int = _read(int, "an integer that isn't negative", lambda x: x >= 0)
positive_float = _read(float, "a positive number", lambda x: x > 0)
ratio = _read(float, "a number from 0 to 1", lambda x: 0 <= x <= 1)
field_of_view = _read(float, "a field of view between 0 and 179 degrees", lambda x: 0 < x < 179)


def boolean(value) -> bool:
    word = str(value).strip().lower()
    if word not in ("true", "false", "1", "0", "yes", "no", "on", "off"):
        raise ValueError(f"expected a truth value, got {value!r}")
    return word in ("true", "1", "yes", "on")


def fields_of_view(value: str) -> list[float]:
    """Distinct fields of view of a list with commas, ascending; an empty list is an error."""
    out = sorted({field_of_view(x) for x in str(value).split(",") if x.strip()})
    if not out:
        raise ValueError("expected one field of view at least")
    return out


def in_range(text: Column, low: float, high: float, low_open: bool = False, high_open: bool = False, whole: bool = False) -> Column:
    """The number that a text holds if it is finite and in range, else null."""
    x = F.trim(text).try_cast("double")
    ok = ((x > low) if low_open else (x >= low)) & ((x < high) if high_open else (x <= high)) & ~F.isnan(x) & (F.abs(x) != float("inf"))
    if whole:
        ok = ok & F.trim(text).rlike(r"^[+-]?[0-9]+$")
    return F.when(ok, x)
