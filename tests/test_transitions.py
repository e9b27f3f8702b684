"""V1 stage responsible on hand-made rows (FIXTURES.md B)."""

import pytest

from flowlens.operators.transitions import forward_conversions, stage_responsible
from tests.conftest import FOLLOWUPS_SCHEMA, LOGS_SCHEMA, USERS_SCHEMA, followup, ts

USERS = [("u1", "COV A", ts("2023-01-01"), False, "APP")]
S, R = "Sector", "Stage Responsible"
LOGS = [
    # sale 1, created on the cut-off day
    (1, 1, ts("2024-08-02 01:00:00"), R, None, "ana"),
    (2, 1, ts("2024-08-02 02:00:00"), S, "UNDEFINED", "SALES"),       # kept, forward
    (3, 1, ts("2024-08-02 03:00:00"), S, "SALES", "TYPING"),          # after a stage: dropped
    (4, 1, ts("2024-08-02 03:30:00"), "Status", "x", "y"),            # other field: invisible
    (5, 1, ts("2024-08-02 04:00:00"), R, "ana", "bob"),
    (6, 1, ts("2024-08-02 05:00:00"), S, "TYPING", "SALES"),          # kept, backward
    (7, 1, ts("2024-08-02 06:00:00"), R, "bob", "carl"),
    (8, 1, ts("2024-08-02 07:00:00"), S, "SALES", "TYPING"),          # kept, forward
    (9, 1, ts("2024-08-02 08:00:00"), R, "carl", "dan"),
    (10, 1, ts("2024-08-02 09:00:00"), S, "TYPING", "FORMALIZATION"),
    (11, 1, ts("2024-08-02 10:00:00"), R, "dan", "eve"),
    (12, 1, ts("2024-08-02 11:00:00"), S, "FORMALIZATION", "PROGRESS"),
    (13, 1, ts("2024-08-02 12:00:00"), R, "eve", "fay"),
    (14, 1, ts("2024-08-02 13:00:00"), S, "PROGRESS", "COMPLETED"),
    (15, 1, ts("2024-08-02 14:00:00"), S, "COMPLETED", "WEIRD"),      # after stage: dropped
    (16, 1, ts("2024-08-02 15:00:00"), S, "WEIRD", "SALES"),          # leak: 'WEIRD' responsible
    # sale 2 created before the cut-off: ignored
    (17, 2, ts("2024-08-02 01:00:00"), R, None, "gus"),
    (18, 2, ts("2024-08-02 02:00:00"), S, "UNDEFINED", "SALES"),
    # sale 3: first row is a stage change (no previous) -> dropped; tie on time
    (19, 3, ts("2024-08-05 01:00:00"), S, "UNDEFINED", "SALES"),
    (20, 3, ts("2024-08-05 01:00:00"), R, None, "hal"),
    (21, 3, ts("2024-08-05 02:00:00"), S, "SALES", "TYPING"),         # prev (tie-broken) hal
]
FOLLOWUPS = [followup(1, "u1", "2024-08-01"), followup(2, "u1", "2024-07-31 23:59:59"),
             followup(3, "u1", "2024-08-03")]

EXPECTED = {
    (1, 2): ("ana", 1), (1, 6): ("bob", 0), (1, 8): ("carl", 1), (1, 10): ("dan", 1),
    (1, 12): ("eve", 1), (1, 14): ("fay", 1), (1, 16): ("WEIRD", 0), (3, 21): ("hal", 1),
}


@pytest.fixture(scope="module")
def inputs(spark):
    return (spark.createDataFrame(LOGS, LOGS_SCHEMA),
            spark.createDataFrame(FOLLOWUPS, FOLLOWUPS_SCHEMA),
            spark.createDataFrame(USERS, USERS_SCHEMA))


@pytest.mark.parametrize("slice_rows", [4_000_000, 2])
def test_stage_responsible_hand_cases(inputs, slice_rows):
    logs, fu, users = inputs
    out = stage_responsible(logs, fu, users, slice_rows=slice_rows)
    ids = {(r.followup_id, r.log_date): r.log_id for r in logs.collect()}
    got = {(r.followup_id, ids[(r.followup_id, r.log_date)]): (r.stage_responsible, r.is_conversion)
           for r in out.collect()}
    assert got == EXPECTED
    assert out.columns[-3:] == ["stage_responsible", "is_conversion", "cancellation_reason"]


def test_forward_conversions(inputs):
    rows = {r.stage_responsible: (r.stage_changes, r.conversions)
            for r in forward_conversions(stage_responsible(*inputs)).collect()}
    assert rows["ana"] == (1, 1) and rows["bob"] == (1, 0) and rows["WEIRD"] == (1, 0)
