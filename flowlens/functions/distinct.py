"""Distinct counts that roll up: exact bitmaps over dense ids.

A distinct count of a day cannot be added to one of a week.  A bitmap of the day's members can be
merged: ``distinct_bitmaps`` keeps, per group and block of 32,768 ids, one fixed-size bitmap a
measure; ``roll_up`` merges them to any coarser grouping and counts, without reading members again.

Bitmaps need dense whole numbers: ``dense_ids`` numbers the members from 1 without gaps, by the two-pass
ranks of ``functions/carry``.  With a time, members are numbered by their first time, so the members of
a day fill few blocks and a day's state stays small.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.functions.carry import carry
from flowlens.functions.sequence import DEFAULT_SLICE_ROWS

HASH_PERIODS = 4096


def dense_ids(df: DataFrame, key: str, *, at: str | None = None, out: str = "dense_id",
              slice_rows: int = DEFAULT_SLICE_ROWS) -> DataFrame:
    """(key, out): the distinct non-null keys numbered from 1, by first ``at`` (else by hash)."""
    place = F.pmod(F.xxhash64(key), F.lit(HASH_PERIODS)) if at is None else F.min(at)
    members = df.where(F.col(key).isNotNull())
    members = (members.select(key).distinct().withColumn("_place", place) if at is None
               else members.groupBy(key).agg(place.alias("_place")))
    period = F.col("_place") if at is None else F.to_date("_place")
    return carry(members, [], ["_place", key], rank=out, period=period, slice_rows=slice_rows).select(key, out)


def distinct_bitmaps(df: DataFrame, by: Sequence[str], dense_id: str, measures: Mapping[str, str | Column]) -> DataFrame:
    """One row per (by, block of ids): for every measure the bitmap of the ids with a true flag.

    Partial aggregation merges a hot group on the map side; a bitmap has 4,096 bytes whatever it holds.
    """
    position = F.bitmap_bit_position(F.col(dense_id))
    return (df.where(F.col(dense_id).isNotNull())
            .groupBy(*by, F.bitmap_bucket_number(F.col(dense_id)).alias("id_block"))
            .agg(*[F.bitmap_construct_agg(F.when(F.col(c) if isinstance(c, str) else c, position)).alias(name)
                   for name, c in measures.items()]))


def roll_up(bitmaps: DataFrame, by: Sequence[str | Column], measures: Sequence[str]) -> DataFrame:
    """Exact distinct counts per ``by`` (columns or aliased expressions over the groups of ``bitmaps``)."""
    merged = bitmaps.groupBy(*by, "id_block").agg(*[F.bitmap_or_agg(m).alias(m) for m in measures])
    names = [c for c in merged.columns if c not in ("id_block", *measures)]
    return merged.groupBy(*names).agg(*[F.sum(F.bitmap_count(m)).alias(m) for m in measures])
