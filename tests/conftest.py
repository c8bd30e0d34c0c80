import json
import os
import sys
import tempfile
import uuid
from datetime import datetime, timezone

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerflow.session import build_session  # noqa: E402

NOW = datetime(2026, 4, 28, 14, 0, 0, tzinfo=timezone.utc)


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", shuffle_partitions=8)
    session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lf-test-ckpt-"))
    yield session
    session.stop()


@pytest.fixture()
def tmp_root():
    return tempfile.mkdtemp(prefix="lf-test-")


def txn(**overrides):
    """A valid payload dict (fields as the surveyed tests use)."""
    record = dict(
        transaction_id=str(uuid.uuid4()),
        card_id="4111111111111111",
        merchant_id="MERCH-ABCDEF12",
        amount=12.34,
        currency="USD",
        transaction_ts="2026-04-28T14:00:00+00:00",
        mcc_code="5411",
        auth_status="APPROVED",
        channel="POS",
    )
    for key, value in overrides.items():
        if value is DROP:
            record.pop(key, None)
        else:
            record[key] = value
    return record


DROP = object()


def as_bytes(payload):
    if isinstance(payload, (bytes, bytearray)):
        return bytes(payload)
    if isinstance(payload, str):
        return payload.encode("utf-8")
    return json.dumps(payload).encode("utf-8")
