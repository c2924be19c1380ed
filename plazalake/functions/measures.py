"""Numeric expressions shared by the gold and serving tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def relative_change(current: Column, base: Column) -> Column:
    """CH6/AG6: percent change rounded to 2 places; NULL unless the base is positive."""
    return F.when(base > 0, F.round((current - base) / base * 100.0, 2))


def lower_median(value: Column) -> Column:
    """AG2: discrete lower median. The sketch merges, so a hot group is pre-aggregated."""
    return F.percentile_approx(value, 0.5)


def weighted_mean(value: Column, weight: Column) -> Column:
    """AG10/AG11: sum(value * weight) / sum(weight)."""
    return F.sum(value * weight) / F.sum(weight)


def check_bounds(bounds: Sequence[float]) -> list[float]:
    """SV7: bracket bounds must be unique and ascending."""
    if list(bounds) != sorted(set(bounds)):
        raise ValueError("bracket bounds must be unique and ascending")
    return [float(b) for b in bounds]


def bracket_index(value: Column, bounds: Sequence[float]) -> Column:
    """SV6: number of bounds at or below the value."""
    reached = [F.when(value >= b, 1).otherwise(0) for b in check_bounds(bounds)]
    return sum(reached[1:], reached[0])


def bracket_labels(bounds: Sequence[float]) -> list[str]:
    """SV7: one label per bracket, lowest first."""
    b = check_bounds(bounds)
    middle = [f"S/ {low:,.0f} – {high - 1:,.0f}" for low, high in zip(b, b[1:])]
    return [f"Menos de S/ {b[0]:,.0f}", *middle, f"S/ {b[-1]:,.0f} o más"]


def bracket_label(index: Column, bounds: Sequence[float]) -> Column:
    """SV7: label of a bracket index."""
    return F.element_at(F.array(*[F.lit(label) for label in bracket_labels(bounds)]), index + 1)
