"""V2 state durations on hand-made rows (FIXTURES.md B)."""

import pytest

from flowlens.operators.durations import state_durations, state_periods
from tests.conftest import FOLLOWUPS_SCHEMA, LOGS_SCHEMA, USERS_SCHEMA, followup, ts

USERS = [("u1", "COV A", ts("2023-01-01"), False, "APP")]


def _log(lid, fid, when, field, updated, original=None):
    return (lid, fid, ts(when), field, original, updated)


LOGS = [
    # 1: normal path, sub-second start, responsible row in between, rows after COMPLETED
    _log(1, 1, "2024-01-01 01:00:00", "Sector", "SALES"),
    _log(2, 1, "2024-01-01 02:00:00.5", "Sector", "TYPING"),
    _log(3, 1, "2024-01-01 02:30:00", "Stage Responsible", "ana"),
    _log(4, 1, "2024-01-01 03:00:00", "Sector", "COMPLETED"),
    _log(5, 1, "2024-01-01 04:00:00", "Sector", "PROGRESS"),
    # 2: no stage change, only another field: one UNDEFINED period to last log
    _log(6, 2, "2024-01-01 05:00:00", "Stage Responsible", "bob"),
    # 3: no log at all -> dropped
    # 4: first change before creation -> negative UNDEFINED
    _log(7, 4, "2024-01-01 23:00:00", "Sector", "SALES"),
    _log(8, 4, "2024-01-02 01:00:00", "Sector", "TYPING"),
    # 5: boundary counting 00.9 -> 01.1 is one second
    _log(9, 5, "2024-01-01 10:00:01.1", "Sector", "SALES"),
    _log(10, 5, "2024-01-01 10:00:01.2", "Sector", "COMPLETED"),
    # 6: user missing -> dropped
    _log(11, 6, "2024-01-01 01:00:00", "Sector", "SALES"),
    # 7: unknown stage counts nowhere but keeps the row
    _log(12, 7, "2024-01-01 01:00:00", "Sector", "FOO"),
    # 8: NULL stage period dropped
    _log(13, 8, "2024-01-01 01:00:00", "Sector", None),
    _log(14, 8, "2024-01-01 02:00:00", "Sector", "SALES"),
    # 9: two COMPLETED rows: the first caps
    _log(15, 9, "2024-01-01 01:00:00", "Sector", "SALES"),
    _log(16, 9, "2024-01-01 02:00:00", "Sector", "COMPLETED"),
    _log(17, 9, "2024-01-01 03:00:00", "Sector", "COMPLETED"),
    # 10: equal log times, the tie-break orders them
    _log(18, 10, "2024-01-01 01:00:00", "Sector", "SALES"),
    _log(19, 10, "2024-01-01 01:00:00", "Sector", "TYPING"),
    _log(20, 10, "2024-01-01 02:00:00", "Sector", "CANCELED"),
]

FOLLOWUPS = [
    followup(1, "u1", "2024-01-01 00:00:00"),
    followup(2, "u1", "2024-01-01 00:00:00"),
    followup(3, "u1", "2024-01-01 00:00:00"),
    followup(4, "u1", "2024-01-02 00:00:00"),
    followup(5, "u1", "2024-01-01 10:00:00.9"),
    followup(6, "nobody", "2024-01-01 00:00:00"),
    followup(7, "u1", "2024-01-01 00:00:00"),
    followup(8, "u1", "2024-01-01 00:00:00"),
    followup(9, "u1", "2024-01-01 00:00:00"),
    followup(10, "u1", "2024-01-01 00:00:00"),
]

EXPECTED = {  # followup_id -> (undefined, sales, typing, formalization, progress, completed, canceled)
    1: (3600, 3600, 3600, 0, 0, 0, 0),
    2: (18000, 0, 0, 0, 0, 0, 0),
    4: (-3600, 7200, 0, 0, 0, 0, 0),
    5: (1, 0, 0, 0, 0, 0, 0),
    7: (3600, 0, 0, 0, 0, 0, 0),
    8: (3600, 0, 0, 0, 0, 0, 0),
    9: (3600, 3600, 0, 0, 0, 0, 0),
    10: (3600, 0, 3600, 0, 0, 0, 0),
}
COLS = ["time_undefined", "time_sales", "time_typing", "time_formalization",
        "time_progress", "time_completed", "time_canceled"]


@pytest.fixture(scope="module")
def inputs(spark):
    return (spark.createDataFrame(LOGS, LOGS_SCHEMA),
            spark.createDataFrame(FOLLOWUPS, FOLLOWUPS_SCHEMA),
            spark.createDataFrame(USERS, USERS_SCHEMA))


@pytest.mark.parametrize("slice_rows", [4_000_000, 1])
def test_state_durations_hand_cases(inputs, slice_rows):
    logs, fu, users = inputs
    out = state_durations(logs, fu, users, slice_rows=slice_rows)
    got = {r.followup_id: tuple(r[c] for c in COLS) for r in out.collect()}
    assert got == EXPECTED
    assert all(r.time_completed == 0 for r in out.collect())  # invariant (SURVEY 5)


def test_state_durations_output_schema(inputs):
    out = state_durations(*inputs)
    assert out.columns == ["followup_id", "followup_creation_date", "operation",
                           "origin_platform", "covenant", "commission", *COLS]
    assert all(t == "bigint" for c, t in out.dtypes if c.startswith("time_"))


@pytest.mark.parametrize("slice_rows", [4_000_000, 1])
def test_state_periods_sum_to_durations(inputs, slice_rows):
    periods = state_periods(*inputs, slice_rows=slice_rows)
    sums = {}
    for r in periods.collect():
        if r.state in ("UNDEFINED", "SALES", "TYPING", "FORMALIZATION", "PROGRESS",
                       "COMPLETED", "CANCELED"):
            key = r.followup_id
            vec = list(sums.get(key, [0] * 7))
            vec[COLS.index("time_" + r.state.lower())] += r.duration_seconds
            sums[key] = vec
        else:
            sums.setdefault(r.followup_id, [0] * 7)
    assert {k: tuple(v) for k, v in sums.items()} == EXPECTED
