"""Column expressions shared by the operators.

All time values are ``timestamp_ntz`` (wall-clock, no zone).  Every helper
here is zone-free: it never goes through the session time zone, so results
do not change with ``spark.sql.session.timeZone`` and no DST gap can shift a
truncated value.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MICROS_PER_SECOND = 1_000_000


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_present(c: str | Column, dtype: T.DataType | None = None) -> Column:
    """Non-null and, for strings, non-blank (the reference treats '' as missing)."""
    c = col(c)
    if dtype is not None and not isinstance(dtype, T.StringType):
        return c.isNotNull()
    return c.isNotNull() & (c.cast("string") != F.lit(""))


def month_start(c: str | Column) -> Column:
    """First instant of the month as ``timestamp_ntz`` (DATE_TRUNC month)."""
    return F.trunc(F.to_date(col(c)), "MM").cast("timestamp_ntz")


def day_start(c: str | Column) -> Column:
    """Midnight of the day as ``timestamp_ntz`` (DATE_TRUNC day)."""
    return F.to_date(col(c)).cast("timestamp_ntz")


def plus_days(c: str | Column, days: int) -> Column:
    """Calendar-day arithmetic on ``timestamp_ntz`` (DATEADD day)."""
    return col(c) + F.make_dt_interval(days=F.lit(days))


def epoch_micros(c: str | Column) -> Column:
    """Microseconds since 1970-01-01 of a ``timestamp_ntz`` (zone-free).

    Built from calendar fields (days since the epoch of the date, then hour,
    minute and seconds with fraction).  ``timestamp_diff`` on NTZ values goes
    through the session zone and shifts wall-clock times that fall in a DST
    gap by an hour (e.g. 1995-10-15 00:00 in America/Sao_Paulo).
    """
    c = col(c)
    return (F.unix_date(F.to_date(c)).cast("long") * F.lit(86_400 * _MICROS_PER_SECOND)
            + F.hour(c).cast("long") * F.lit(3_600 * _MICROS_PER_SECOND)
            + F.minute(c).cast("long") * F.lit(60 * _MICROS_PER_SECOND)
            + (F.date_part(F.lit("SECOND"), c) * F.lit(_MICROS_PER_SECOND)).cast("long"))


def epoch_second_floor(c: str | Column) -> Column:
    """Whole seconds since the epoch, floored (exact for pre-1970 values too)."""
    micros = epoch_micros(c)
    return ((micros - F.pmod(micros, F.lit(_MICROS_PER_SECOND)))
            / F.lit(_MICROS_PER_SECOND)).cast("long")


def seconds_between(start: str | Column, end: str | Column) -> Column:
    """DATEDIFF('second', start, end) with warehouse semantics.

    The warehouse counts second *boundaries* crossed, not whole elapsed
    seconds: 10:00:00.9 -> 10:00:01.1 is 1.  So it is the difference of the
    floored epoch seconds.  NULL in, NULL out.
    """
    return epoch_second_floor(end) - epoch_second_floor(start)


def null_if_zero(c: str | Column) -> Column:
    """CASE WHEN x > 0 THEN x ELSE NULL END for counts."""
    c = col(c)
    return F.when(c > 0, c)


def running_total(df: DataFrame, order_col: str, value_col: str, out: str) -> DataFrame:
    """SUM(value) OVER (ORDER BY order_col ROWS UNBOUNDED PRECEDING..CURRENT ROW).

    There is no partition key, so Spark runs it in one task.  Only call it on
    inputs with one row per period (months), never on raw rows.  NULL order
    keys sort last, as in the warehouse dialect.
    """
    w = (Window.orderBy(F.col(order_col).asc_nulls_last())
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumn(out, F.sum(value_col).over(w))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                  values: Sequence[str], prefix: str = "") -> DataFrame:
    """Top-1 per key by ascending ``order`` as an aggregate, not a window.

    ``min(struct(order..., values...))`` is computed with partial (map-side)
    aggregation, so a key holding a third of all rows is reduced on every
    mapper before the shuffle; a ROW_NUMBER()=1 window would sort that key's
    rows in a single task.  NULL order values sort first inside a struct, so
    callers pass ``isNull`` flags first when they need NULLS LAST.
    """
    fields = [col(o).alias(f"_o{i}") for i, o in enumerate(order)]
    fields += [F.col(v).alias(v) for v in values]
    best = F.min(F.struct(*fields)).alias("_best")
    out = df.groupBy(*keys).agg(best)
    return out.select(*keys, *[F.col(f"_best.{v}").alias(prefix + v) for v in values])


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                   values: Sequence[str]) -> DataFrame:
    """Top-1 per key by descending ``order`` (``max`` of a struct)."""
    fields = [col(o).alias(f"_o{i}") for i, o in enumerate(order)]
    fields += [F.col(v).alias(v) for v in values]
    out = df.groupBy(*keys).agg(F.max(F.struct(*fields)).alias("_best"))
    return out.select(*keys, *[F.col(f"_best.{v}").alias(v) for v in values])


def newest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, out: str = "rank") -> DataFrame:
    """The k first rows per key in ``order``, numbered from 1 (QUALIFY ROW_NUMBER() <= k).

    Spark turns the ranked filter into a group limit that also runs before the exchange: every map task
    sends at most ``k`` rows a key, so a key with a third of all rows costs its reducer ``k`` rows a task.
    """
    ranked = df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col(out) <= k)


def unique_or_fail(df: DataFrame, keys: Sequence[str], name: str = "table") -> DataFrame:
    """``df`` with one row per key; a repeated key fails the query that reads it and names the key.

    The contract check happens in the aggregation itself: no job runs when the DataFrame is defined.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    shown = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])
    fault = F.raise_error(F.concat(F.lit(f"{name}: key {keys} is not unique: "), shown))
    held = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(F.lit(1).alias("_one"), *rest)).alias("_row"))
    # the struct depends on the check, so no column can be read without it
    checked = held.select(*keys, F.when(F.col("_n") == 1, F.col("_row")).otherwise(fault.cast(held.schema["_row"].dataType)).alias("_row"))
    return checked.where(F.col("_row._one") == 1).select(*[k if k in keys else F.col(f"_row.{k}").alias(k) for k in df.columns])


def assert_unique(df: DataFrame, keys: Iterable[str], name: str = "table") -> None:
    """Eager contract check: fail if ``keys`` repeat (runs one aggregation).

    Used for joins whose fan-out would silently double measures (a users
    table with two rows for one user_id, for instance).
    """
    keys = list(keys)
    dup = df.groupBy(*keys).count().where(F.col("count") > 1).limit(1).count()
    if dup:
        raise ValueError(f"{name}: key {keys} is not unique")
