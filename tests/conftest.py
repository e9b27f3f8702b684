from __future__ import annotations

import datetime as dt
import os
import sys
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from flowlens.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=4, shuffle_partitions=4, app_name="flowlens-tests")
    yield session
    session.stop()


def ts(s: str | None) -> dt.datetime | None:
    """'2024-01-01 10:00:00.5' -> naive datetime (loads as timestamp_ntz)."""
    if s is None:
        return None
    fmt = "%Y-%m-%d %H:%M:%S.%f" if "." in s else ("%Y-%m-%d %H:%M:%S" if ":" in s else "%Y-%m-%d")
    return dt.datetime.strptime(s, fmt)


def money(x) -> Decimal | None:
    return None if x is None else Decimal(str(x)).quantize(Decimal("0.01"))


USERS_SCHEMA = ("user_id string, covenant string, created_at timestamp_ntz, "
                "is_blocked boolean, source_platform string")
FOLLOWUPS_SCHEMA = ("followup_id long, user_id string, created_at timestamp_ntz, "
                    "finalized_at timestamp_ntz, status string, commission decimal(18,2), "
                    "seller_id long, operation string, origin_platform string, "
                    "destination_bank string, cancellation_reason string")
LOGS_SCHEMA = ("log_id long, followup_id long, log_date timestamp_ntz, changed_field string, "
               "original_content string, updated_content string")
LEADS_SCHEMA = ("user_id string, lead_id string, covenant string, link_type int, eligible boolean, "
                "released boolean, has_representative boolean, has_alimony boolean, "
                "registry_no string, created_at timestamp_ntz, created_seq long")
EVENTS_SCHEMA = "event_id long, user_id string, event_at timestamp_ntz, event_name string, platform string"
CONTRACTS_SCHEMA = "client_key string, paid_at timestamp_ntz, commission decimal(18,2)"


def followup(fid, user, created, finalized=None, status="Em andamento", commission=100,
             seller=None, operation="new", platform="APP", bank=None, reason=None):
    return (fid, user, ts(created), ts(finalized), status, money(commission), seller,
            operation, platform, bank, reason)


def rows_as_dicts(df, key=None):
    out = [r.asDict() for r in df.collect()]
    return sorted(out, key=key) if key else out
