"""Ranks, running sums and last known values along sequences of any length.

``ROW_NUMBER``, ``SUM(...) OVER (... ROWS UNBOUNDED PRECEDING)`` and ``LAST_VALUE(... IGNORE NULLS)``
all put every row of a key (without a key: the whole table) into one task.  ``carry`` gives the same
results in two passes over bounded pieces:

1. *Cells.*  A key's rows are cut where ``period`` changes (any expression that never falls along the
   order, such as the day of a time) and at hash splitters (``functions/sequence``): a row is a
   splitter by the hash of its values, so about every ``slice_rows``-th row cuts its cell, wherever
   the rows lie.
2. *Carry.*  One partial aggregation per cell gives its number of rows, sums and last non-null
   values; a window over the cells of a key (never its rows) adds up what comes before each.
3. *Rows.*  Rows are exchanged by cell and numbered inside it; what the cell inherits arrives by one
   join with a small table that holds splitters and carries per (key, period).

Without a key the window over cells is one task with a row per period and splitter: give a
``period`` there, or a larger ``slice_rows``.  Orders are ascending, NULLs last, and must be total;
rows equal in all order columns stay in one cell.  No job runs when the DataFrame is defined.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlens.functions.semantics import col
from flowlens.functions.sequence import DEFAULT_SLICE_ROWS, _rank, is_splitter


def _same(a: Sequence[str], b: Sequence[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(x).eqNullSafe(F.col(y)) for x, y in zip(a, b, strict=True)], F.lit(True))


def _plus(inside: Column, before: Column) -> Column:
    """Sum of two partial sums; NULL only if neither has a value."""
    return F.coalesce(inside + before, inside, before)


def carry(df: DataFrame, keys: Sequence[str], order: Sequence[str], *, rank: str | None = None,
          sums: Mapping[str, str | Column] | None = None, known: Mapping[str, str | Column] | None = None,
          period: Column | None = None, slice_rows: int = DEFAULT_SLICE_ROWS, mark: Sequence[str] = ()) -> DataFrame:
    """``df`` with running columns per ``keys`` along ``order``.

    ``rank`` names the row number from 1; ``sums`` maps output names to values whose running sum is
    wanted, ``known`` to values whose last non-null one at or before the row is wanted.  ``mark``
    columns join the splitter hash: naming an aggregate there keeps Catalyst from pushing the splitter
    filter below that aggregation, so that both passes share its exchange.
    """
    sums, known = dict(sums or {}), dict(known or {})
    for name, value in known.items():
        if isinstance(value, str) and name in df.columns:
            raise ValueError(f"output {name} is a column already")
    keys, order = list(keys), list(order)
    cell = [*keys, "_period"]
    rows = df.withColumn("_period", F.lit(0) if period is None else period)
    for i, value in enumerate(sums.values()):
        rows = rows.withColumn(f"_sum{i}", col(value))
    for i, value in enumerate(known.values()):
        rows = rows.withColumn(f"_known{i}", col(value))
    sum_columns, known_columns = [f"_sum{i}" for i in range(len(sums))], [f"_known{i}" for i in range(len(known))]
    others = [f"_k{i}" for i in range(len(cell))]

    cuts = rows.where(is_splitter(cell, [*order, *mark], slice_rows))
    bounds = (cuts.groupBy(*[F.col(c).alias(o) for c, o in zip(cell, others, strict=True)])
              .agg(F.sort_array(F.collect_set(_rank(order))).alias("_bounds")))
    at = F.coalesce(F.size(F.filter("_bounds", lambda b: b <= _rank(order))), F.lit(0))
    # without periods a key with one cell has nothing to carry; an inner join leaves only the others
    cut_rows = rows.join(bounds, _same(cell, others), "inner" if period is None else "left")
    cells = (cut_rows.withColumn("_slice", F.when(F.col("_bounds").isNull(), 0).otherwise(at))
             .groupBy(*cell, "_slice")
             .agg(F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(c) for c in sum_columns],
                  *[F.max_by(c, F.when(F.col(c).isNotNull(), _rank(order))).alias(c) for c in known_columns]))
    earlier = (Window.partitionBy(*keys).orderBy(F.col("_period").asc_nulls_last(), "_slice")
               .rowsBetween(Window.unboundedPreceding, -1))
    before = F.struct(F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n"),
                      *[F.sum(c).over(earlier).alias(c) for c in sum_columns],
                      *[F.last(c, ignorenulls=True).over(earlier).alias(c) for c in known_columns])
    carried = (cells.select(*[F.col(c).alias(o) for c, o in zip(cell, others, strict=True)], "_slice", before.alias("_before"))
               .groupBy(*others).agg(F.map_from_entries(F.collect_list(F.struct("_slice", "_before"))).alias("_before")))
    again = [f"{o}b" for o in others]
    small = carried.join(bounds.select(*[F.col(o).alias(a) for o, a in zip(others, again, strict=True)], "_bounds"),
                         _same(others, again), "left").drop(*again)

    joined = rows.join(small, _same(cell, others), "left").drop(*others)
    # the explicit exchange spreads a hot key's cells even where the rows already lie by key
    placed = (joined.withColumn("_slice", F.when(F.col("_bounds").isNull(), 0).otherwise(at))
              .withColumn("_before", F.col("_before")[F.col("_slice")]).drop("_bounds")
              .repartition(*[F.col(c) for c in cell], F.col("_slice")))
    inside = Window.partitionBy(*cell, "_slice").orderBy(*[F.col(o).asc_nulls_last() for o in order])
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = []
    if rank:
        out.append((F.row_number().over(inside) + F.coalesce(F.col("_before._n"), F.lit(0))).cast("long").alias(rank))
    out += [_plus(F.sum(c).over(so_far), F.col(f"_before.{c}")).alias(name) for c, name in zip(sum_columns, sums, strict=True)]
    out += [F.coalesce(F.last(c, ignorenulls=True).over(so_far), F.col(f"_before.{c}")).alias(name)
            for c, name in zip(known_columns, known, strict=True)]
    return placed.select(*df.columns, *out)


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "rank", *, period: Column | None = None,
           slice_rows: int = DEFAULT_SLICE_ROWS) -> DataFrame:
    """ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order) for keys of any size."""
    return carry(df, keys, order, rank=out, period=period, slice_rows=slice_rows)


def quantiles(df: DataFrame, keys: Sequence[str], value: str, percents: Sequence[int], *,
              slice_rows: int = DEFAULT_SLICE_ROWS) -> DataFrame:
    """Count, average, exact discrete percentiles and maximum of a whole-number column per key.

    Percentile p is the least value with at least p % of the key's rows at or below it (PERCENTILE_DISC).
    Rows become counts per (key, value) by partial aggregation, so equal values cost nothing; the counts are
    summed along the values by ``carry``, cut into slices where a key has very many of them, and the
    first value that reaches each share is a minimum.  No list of values is built.  NULL values do not count.
    """
    keys = list(keys)
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_times"))
    upto = carry(counts, keys, [value], sums={"_upto": "_times"}, slice_rows=slice_rows, mark=["_times"])
    names = [f"_t{i}" for i in range(len(keys))]
    totals = counts.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)]).agg(
        F.sum("_times").alias("_all"), F.sum(F.col(value).cast("decimal(20,0)") * F.col("_times")).alias("_total"))
    both = upto.join(totals, _same(keys, names), "inner")
    return (both.groupBy(*keys).agg(
        F.max("_all").alias("n"),
        (F.max("_total").cast("double") / F.max("_all")).alias(f"avg_{value}"),
        *[F.min(F.when(F.col("_upto") * 100 >= F.col("_all") * p, F.col(value))).alias(f"p{p}_{value}") for p in percents],
        F.max(value).alias(f"max_{value}")))
