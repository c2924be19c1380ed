"""Lookup joins."""

from __future__ import annotations

from pyspark.sql import DataFrame


def lookup_join(fact: DataFrame, lookup: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Join a large frame with a lookup that is unique on ``on``.

    How the sides meet is left to adaptive execution, which knows their measured bytes: a
    small lookup is broadcast, and of a large one's join the partitions of a hot (or
    NULL) key are split. So ``how`` is one in which rows of ``fact`` may be split:
    each meets its lookup row once, and a lookup row may come in several tasks.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported lookup join: {how}")
    return fact.join(lookup, on, how)
