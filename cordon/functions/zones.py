"""Zone predicates. Lists longer than 10 values are planned as an ``InSet`` hash probe."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def in_zone(c: str | Column, ids: Iterable[int]) -> Column:
    return _c(c).isin(list(ids))


def not_in_zone(c: str | Column, ids: Iterable[int]) -> Column:
    """SQL ``NOT IN``: a null id gives null, so the row is dropped by a filter."""
    return ~_c(c).isin(list(ids))


def entering(pickup: str | Column, dropoff: str | Column, ids: Iterable[int]) -> Column:
    """Outside pickup and inside drop-off."""
    ids = list(ids)
    return not_in_zone(pickup, ids) & in_zone(dropoff, ids)


def inside(pickup: str | Column, dropoff: str | Column, ids: Iterable[int]) -> Column:
    """Both ends in the zone."""
    ids = list(ids)
    return in_zone(pickup, ids) & in_zone(dropoff, ids)


def touching(pickup: str | Column, dropoff: str | Column, ids: Iterable[int]) -> Column:
    """Either end in the zone."""
    ids = list(ids)
    return in_zone(pickup, ids) | in_zone(dropoff, ids)
