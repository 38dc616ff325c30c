"""Joins in which null keys match like any other key.

No side is broadcast by hint: adaptive execution measures the shuffled bytes of
a side and turns the join into a broadcast when they are below its threshold.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame

def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Join condition over keys in which null equals null."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def keep_matching(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of left whose key is in right."""
    return left.join(right, same_keys(left, right, keys), "left_semi")


def drop_matching(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of left whose key is not in right."""
    return left.join(right, same_keys(left, right, keys), "left_anti")
