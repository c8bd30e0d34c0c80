"""Decode branches: every outcome, byte round trip, one time per batch."""
import base64

import pytest
from pyspark.sql import functions as F

from conftest import NOW, as_bytes, txn
from ledgerflow.functions import decode as D
from ledgerflow.operators import route
from ledgerflow.plans.batch import raw_from_payloads


def decode_rows(spark, payloads):
    raw = raw_from_payloads(spark, [as_bytes(p) for p in payloads])
    out = D.decode(raw).select("_decode_kind", "_decode_reason", F.to_json("_payload").alias("p"))
    return [(r["_decode_kind"], r["_decode_reason"], r["p"]) for r in out.collect()]


@pytest.mark.parametrize("payload, reason", [
    (b"\xff\xfe\xff", "DECODE_ERROR:utf8:invalid utf-8"),
    (b"not json at all", "DECODE_ERROR:json:invalid json"),
    (b"", "DECODE_ERROR:json:invalid json"),
    (b"   ", "DECODE_ERROR:json:invalid json"),
    (b"{} x", "DECODE_ERROR:json:invalid json"),
    (b'{"a":1}{"b":2}', "DECODE_ERROR:json:invalid json"),
    (b"{}],[{}", "DECODE_ERROR:json:invalid json"),
    (b"{'a': 1}", "DECODE_ERROR:json:invalid json"),
    (b"\xef\xbb\xbf{}", "DECODE_ERROR:json:invalid json"),
    (b"[1, 2]", "DECODE_ERROR:not_dict:list"),
    (b"42", "DECODE_ERROR:not_dict:int"),
    (b"1.5", "DECODE_ERROR:not_dict:float"),
    (b"1e3", "DECODE_ERROR:not_dict:float"),
    (b'"text"', "DECODE_ERROR:not_dict:str"),
    (b"true", "DECODE_ERROR:not_dict:bool"),
    (b"null", "DECODE_ERROR:not_dict:NoneType"),
])
def test_decode_error_reasons(spark, payload, reason):
    [(kind, got, p)] = decode_rows(spark, [payload])
    assert got == reason
    assert p is None


def test_valid_objects_decode(spark):
    rows = decode_rows(spark, [txn(), b'  {"a": [1, "]"]}  '])
    assert [r[0] for r in rows] == ["ok", "ok"]
    assert all(r[1] is None for r in rows)


def test_duplicate_keys_keep_last(spark):
    [(kind, _, p)] = decode_rows(spark, [b'{"a": 1, "a": 2}'])
    assert kind == "ok" and p == '{"a":2}'


def test_raw_bytes_round_trip_and_one_timestamp(spark):
    payloads = [b"\xff\xfe\xff", b"[1]", b"plain", as_bytes(txn())]
    raw = raw_from_payloads(spark, payloads)
    c = route.classify(raw, now=F.lit(NOW).cast("timestamp"), request_id=F.lit("r1"))
    q = route.quarantine_rows(c).collect()
    assert len(q) == 3
    assert sorted(base64.b64decode(r["_raw_b64"]) for r in q) == sorted(payloads[:3])
    assert len({r["_quarantine_ts"] for r in q}) == 1


def test_long_payload_base64_has_no_line_breaks(spark):
    blob = b"\xff" + b"x" * 400
    raw = raw_from_payloads(spark, [blob])
    c = route.classify(raw, now=F.lit(NOW).cast("timestamp"))
    [row] = route.quarantine_rows(c).collect()
    assert "\n" not in row["_raw_b64"] and "\r" not in row["_raw_b64"]
    assert base64.b64decode(row["_raw_b64"]) == blob


def test_exact_parser_messages_on_quarantine(spark, tmp_root):
    from ledgerflow import schema as S
    from ledgerflow.operators import sinks
    from ledgerflow.plans.batch import process_batch
    lake = S.LakeSettings(root=tmp_root)
    payloads = [b"\xff\xfe\xff", b"not json at all", b"{} x", b"[1]", b"\xe2\x82", as_bytes(txn(amount=-1))]
    process_batch(spark, raw_from_payloads(spark, payloads), "r", lake, now=NOW,
                  exact_decode_messages=True)
    got = sorted(r["_quarantine_reason"][0] for r in sinks.read_quarantine(spark, lake.quarantine).collect())
    assert got == sorted([
        "DECODE_ERROR:utf8:invalid start byte", "DECODE_ERROR:json:Expecting value",
        "DECODE_ERROR:json:Extra data", "DECODE_ERROR:not_dict:list",
        "DECODE_ERROR:utf8:unexpected end of data", "INVALID_FIELD:amount:greater_than_equal"])
