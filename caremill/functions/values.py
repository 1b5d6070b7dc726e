"""Small expression helpers: lookups, keys and exact ratios."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def lookup(column: Column, mapping: Mapping[str, object]) -> Column:
    """Value for a short fixed mapping, NULL for anything else; no join."""
    (first, value), *rest = mapping.items()
    return reduce(
        lambda chain, item: chain.when(column == item[0], F.lit(item[1])),
        rest,
        F.when(column == first, F.lit(value)),
    )


def band(value: Column, floors: Mapping[int, str]) -> Column:
    """Label of the highest floor that ``value`` reaches; NULL below all floors or without a value."""
    chain = F
    for floor in sorted(floors, reverse=True):
        chain = chain.when(value >= floor, F.lit(floors[floor]))
    return chain


def blank_to_null(column: str) -> Column:
    return F.nullif(F.col(column), F.lit(""))


def row_key(*columns: str) -> Column:
    """Stable text key of a row; a NULL part differs from an empty one."""
    parts = [F.coalesce(F.col(name).cast("string"), F.lit("_null_")) for name in columns]
    return F.md5(F.concat_ws("-", *parts))


def exact_ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """Rounded quotient worked out in decimals, so no engine's float rounding shows; NULL over 0."""
    top = numerator.cast("decimal(30,6)")
    bottom = F.nullif(denominator.cast("decimal(18,0)"), F.lit(0).cast("decimal(18,0)"))
    return F.round(top / bottom, digits).cast("double")


def share(numerator: Column, denominator: Column) -> Column:
    """Unrounded quotient of two counts or sums as one float division; NULL over 0."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))
