"""Joins of points with day intervals, with the days as a second equi key.

``at BETWEEN start AND start + n days`` beside an equi key puts a hot key into one task and compares
each of its points with each of its intervals.  Here days are cut into bins as wide as the interval:
an interval touches at most two bins and a point lies in one, so each pair meets in exactly
one place, a hot key is spread over its bins, and a point meets the intervals near it only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _day(c: str) -> Column:
    return F.unix_date(F.to_date(F.col(c))).cast("long")


def day_interval_join(intervals: DataFrame, points: DataFrame, keys: Sequence[str], start: str, at: str, days: int,
                      out: str = "days_after") -> DataFrame:
    """Pairs of rows with equal ``keys`` whose ``at`` falls on one of the ``days`` days after ``start``'s day, or on it.

    Both sides' columns (the keys once) and ``out``, the number of days between.  Names must not clash.  NULL keys
    and times match nothing.
    """
    if days < 0:
        raise ValueError("days must not be negative")
    width = days + 1
    here = F.floor(_day(start) / width)
    left = (intervals.where(F.col(start).isNotNull())
            .withColumn("_bin", F.explode(F.sequence(here, F.floor((_day(start) + days) / width)))))
    right = points.where(F.col(at).isNotNull()).withColumn("_bin", F.floor(_day(at) / width))
    gap = _day(at) - _day(start)
    return left.join(right, [*keys, "_bin"]).withColumn(out, gap).where(F.col(out).between(0, days)).drop("_bin")
