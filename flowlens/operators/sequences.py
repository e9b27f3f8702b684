"""Ordered paths: each step is the first event strictly after the step before it.

The event paths of V6 compare *global* first touches, so an early touch blocks a later one for
good.  Here a path is walked as a reader would: step 1 is the user's first event of the first
kind, step k the first event of the k-th kind strictly later than step k-1; kinds may repeat.
Events of one instant cannot follow each other: an instant takes a user one step further at most.

The walk is an automaton over a user's time-ordered events, and its effect over a stretch of
them is a small table: for every number of steps already done, the times of the steps the
stretch adds.  Such tables compose, so a user's sequence is cut freely:

* one filtered scan; events of a (user, instant) become a bit mask of kinds by partial
  aggregation (copies and bursts collapse before the shuffle);
* a user's instants are cut at hash splitters (``functions/sequence``); each (user, slice)
  folds its sorted instants, at most about ``slice_rows`` of them, into the table of every path;
* a user's tables, one per slice, are composed in order.

No chain of joins, no user's whole sequence in one task, no job at definition.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.functions.semantics import seconds_between
from flowlens.functions.sequence import _rank, is_splitter

Path = Sequence[Sequence[str]]
SLICE_ROWS = 100_000
_TIMES = "array<timestamp_ntz>"


def _bits(kinds: Sequence[str]) -> dict[str, int]:
    if len(kinds) > 62:
        raise ValueError("at most 62 kinds of events")
    return {k: 1 << i for i, k in enumerate(kinds)}


def _mask(step: Sequence[str], bits: Mapping[str, int]) -> int:
    return reduce(lambda a, b: a | b, [bits[e] for e in step])


def _fold(steps: list[int]) -> Column:
    """Table of one path over sorted instants ``_instants`` (at, mask): per steps done, the times of further steps."""
    n = len(steps)
    empty = F.array(*[F.array().cast(_TIMES) for _ in range(n)])
    wanted = F.array(*[F.lit(m).cast("long") for m in steps])

    def advance(table: Column, instant: Column) -> Column:
        def row(times: Column, done: Column) -> Column:
            at = done + F.size(times)
            goes = (at < n) & (F.get(wanted, at).bitwiseAND(instant["mask"]) != 0)
            return F.when(F.coalesce(goes, F.lit(False)), F.concat(times, F.array(instant["at"]))).otherwise(times)
        return F.transform(table, row)
    return F.aggregate("_instants", empty, advance)


def _compose(name: str) -> Column:
    """Times of a path's steps from the start, over the tables of ``_slices`` in order."""
    return F.aggregate("_slices", F.array().cast(_TIMES), lambda times, s: F.concat(
        times, F.coalesce(F.get(s[name], F.size(times)), F.array().cast(_TIMES))))


def ordered_steps(events: DataFrame, paths: Mapping[str, Path], *, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """(user_id, path, times): the times of the steps a user made on each path, at least one.

    ``paths`` maps a name to its steps, each a list of event names that count for it.  Rows without a user, a
    time or a listed name are not read.
    """
    kinds = sorted({e for path in paths.values() for step in path for e in step})
    bits = _bits(kinds)
    names = {f"_p{i}": name for i, name in enumerate(paths)}
    mask = reduce(lambda a, b: a.when(F.col("event_name") == b, F.lit(bits[b]).cast("long")), kinds[1:],
                  F.when(F.col("event_name") == kinds[0], F.lit(bits[kinds[0]]).cast("long")))
    found = events.where(F.col("event_name").isin(*kinds) & F.col("user_id").isNotNull() & F.col("event_at").isNotNull())
    instants = found.groupBy("user_id", F.col("event_at").alias("at")).agg(F.bit_or(mask).alias("mask"))
    # the mask is part of the hash: the filter stays above the aggregation, whose exchange both branches share
    cuts = instants.where(is_splitter(["user_id"], ["at", "mask"], slice_rows))
    bounds = cuts.groupBy(F.col("user_id").alias("_user")).agg(F.sort_array(F.collect_set(_rank(["at"]))).alias("_bounds"))
    at = F.coalesce(F.size(F.filter("_bounds", lambda b: b <= _rank(["at"]))), F.lit(0))
    sliced = instants.join(bounds, F.col("user_id") == F.col("_user"), "left").select(
        "user_id", "at", "mask", F.when(F.col("_bounds").isNull(), 0).otherwise(at).alias("_slice"))
    tables = (sliced.groupBy("user_id", "_slice").agg(F.sort_array(F.collect_list(F.struct("at", "mask"))).alias("_instants"))
              .select("user_id", "_slice", *[_fold([_mask(s, bits) for s in paths[name]]).alias(c) for c, name in names.items()]))
    users = tables.groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct("_slice", *names))).alias("_slices"))
    walked = F.explode(F.array(*[F.struct(F.lit(name).alias("path"), _compose(c).alias("times")) for c, name in names.items()]))
    return users.select("user_id", walked.alias("_w")).select("user_id", "_w.path", "_w.times").where(F.size("times") > 0)


def ordered_paths(events: DataFrame, users: DataFrame, paths: Mapping[str, Path], *, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """(path, step_order, source, target, users, seconds): users per step of each path.

    ``source`` and ``target`` are the steps' event names joined by ``/``; ``seconds`` is the sum over users of the
    second boundaries between the two steps.  Only users in ``users`` count, each once.  Steps nobody made are absent.
    """
    labels = {name: ["/".join(step) for step in path] for name, path in paths.items()}
    chain = F.create_map(*[x for name, steps in labels.items() for x in (F.lit(name), F.array(*[F.lit(s) for s in steps]))])
    steps = (ordered_steps(events, paths, slice_rows=slice_rows)
             .join(users.select("user_id").distinct(), "user_id", "left_semi")
             .select("path", F.posexplode("times").alias("_i", "_at"), "times"))
    before = F.get("times", F.col("_i") - 1)
    return (steps.groupBy("path", (F.col("_i") + 1).alias("step_order"))
            .agg(F.count(F.lit(1)).alias("users"),
                 F.sum(F.when(F.col("_i") > 0, seconds_between(before, F.col("_at")))).alias("seconds"))
            .select("path", "step_order", F.get(chain[F.col("path")], F.col("step_order") - 2).alias("source"),
                    F.get(chain[F.col("path")], F.col("step_order") - 1).alias("target"), "users", "seconds"))
