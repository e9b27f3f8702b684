from flowlens.functions.carry import carry, quantiles, ranked
from flowlens.functions.semantics import (
    assert_unique,
    day_start,
    epoch_micros,
    epoch_second_floor,
    first_per_key,
    is_present,
    latest_per_key,
    month_start,
    newest_per_key,
    null_if_zero,
    plus_days,
    running_total,
    seconds_between,
    unique_or_fail,
)
from flowlens.functions.sequence import with_neighbor

__all__ = [
    "assert_unique",
    "carry",
    "day_start",
    "epoch_micros",
    "epoch_second_floor",
    "first_per_key",
    "is_present",
    "latest_per_key",
    "month_start",
    "newest_per_key",
    "null_if_zero",
    "plus_days",
    "running_total",
    "quantiles",
    "ranked",
    "seconds_between",
    "unique_or_fail",
    "with_neighbor",
]
