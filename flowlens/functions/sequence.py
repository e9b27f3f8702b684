"""Skew-safe LAG / LEAD over an entity sequence.

``LEAD(v) OVER (PARTITION BY key ORDER BY order)`` puts every row of a key into one task.
If one key holds a third of all rows, that task sorts a third of the data.  ``with_neighbor``
gives the same result with slices of about equal *count*, by one algorithm at every size:

1. Splitters.  A row whose hash of (key, order columns) falls on one in ``slice_rows`` is a
   splitter of its key.  The choice depends on the row's values only, so it is the same
   wherever it is computed, and it follows the rows, not the clock: a burst or one wrong
   timestamp moves no bound.  A key has about ``n / slice_rows`` splitters, usually none.
2. Slices.  A row's slice is the number of its key's splitters before it, compared as a
   struct with null flags, which is exactly the window's NULLS LAST order for any column
   type (no arithmetic on the values, so no overflow).  For LEAD a splitter opens its slice,
   for LAG it closes it.
3. LAG/LEAD runs per (key, slice).  The row at the edge of a slice has the splitter itself
   as its neighbour, whose values travel with the splitters: no stitching join.

No job runs when the DataFrame is defined and no side is broadcast by hint; AQE broadcasts
the splitters when they are small at run time.  Rows equal in all order columns stay in one
slice: an order column that tells copies apart (a log id) keeps slices bounded.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_SLICE_ROWS = 1_000_000


def _rank(order: Sequence[str]) -> Column:
    """The order columns as one struct whose order is the window's, NULLS LAST."""
    return F.struct(*[c for i, o in enumerate(order) for c in (F.col(o).isNull().alias(f"n{i}"), F.col(o).alias(f"o{i}"))])


def _payload(values: Sequence[str]) -> Column:
    return F.struct(*[F.col(v).alias(f"v{i}") for i, v in enumerate(values)])


def is_splitter(keys: Sequence[str], order: Sequence[str], slice_rows: int) -> Column:
    """Whether a row cuts its key's sequence."""
    return F.pmod(F.xxhash64(*[F.col(c) for c in [*keys, *order]]), F.lit(slice_rows)) == 0


def splitters(order: Sequence[str], values: Sequence[str], when: Column) -> Column:
    """Aggregate: the sorted splitters of a key, among the rows where ``when`` holds."""
    return F.sort_array(F.collect_set(F.when(when, F.struct(_rank(order).alias("r"), _payload(values).alias("v")))))


def neighbor_in_slices(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str],
                       direction: str, prefix: str) -> DataFrame:
    """LAG/LEAD of ``df`` whose ``_bounds`` column holds the splitters of the row's key (or NULL)."""
    ahead = direction == "next"
    here = _rank(order)
    before = F.size(F.filter("_bounds", (lambda b: b["r"] <= here) if ahead else (lambda b: b["r"] < here)))
    at = F.coalesce(F.when(F.col("_bounds").isNotNull(), before), F.lit(0))
    # the explicit exchange spreads a hot key's slices even where the rows already lie by key
    rows = df.withColumn("_slice", at).repartition(*[F.col(k) for k in keys], F.col("_slice"))
    own = Window.partitionBy(*keys, "_slice").orderBy(*[F.col(o).asc_nulls_last() for o in order])
    inside = (F.lead if ahead else F.lag)(_payload(values)).over(own)
    edge = F.get(F.col("_bounds"), F.col("_slice") if ahead else F.col("_slice") - 1)["v"]
    found = rows.withColumn("_found", F.coalesce(inside, edge))
    out = [F.col(f"_found.v{i}").alias(prefix + v) for i, v in enumerate(values)]
    return found.select(*[c for c in df.columns if c != "_bounds"], *out)


def with_neighbor(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                  values: Sequence[str], direction: str = "next",
                  prefix: str | None = None, slice_rows: int = DEFAULT_SLICE_ROWS, null_keys: bool = True) -> DataFrame:
    """Add ``prefix + v`` = value of the previous/next row in the sequence.

    ``order`` is ascending with NULLs last and must be a total order within ``keys`` (pass a
    tie-break column).  Equivalent to LAG/LEAD over ``PARTITION BY keys ORDER BY order``; a
    caller that has no use for rows with a NULL key filters them first, since they are one
    sequence, and says ``null_keys=False``: the splitters are then joined by plain equality, which
    needs no exchange where the rows already lie by key.
    """
    if direction not in ("next", "prev"):
        raise ValueError("direction must be 'next' or 'prev'")
    prefix = prefix if prefix is not None else f"{direction}_"
    keys, order, values = list(keys), list(order), list(values)
    cuts = df.where(is_splitter(keys, order, slice_rows))
    bounds = (cuts.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
              .agg(splitters(order, values, F.lit(True)).alias("_bounds")))
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) if null_keys else F.col(k) == F.col(f"_k{i}") for i, k in enumerate(keys)]
    joined = df.join(bounds, same, "left").select(*df.columns, "_bounds")
    return neighbor_in_slices(joined, keys, order, values, direction, prefix)
