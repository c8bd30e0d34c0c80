"""One raw record per event, cycling through every way a record can fail.

``raw_variants`` gives each event the payload template number
``event_id % len(TEMPLATES)``.  Templates are JSON texts around one valid
record; ``@ID@``, ``@TS@`` and ``@EPOCH@`` stand for the event's record id
and for its event time as ISO text (whole seconds, no offset) and as epoch
seconds.  Together they reach every reason code of every field rule and
every decode outcome.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .fixture import _hex_uuid

_VALID = {
    "transaction_id": '"@ID@"', "card_id": '"4111111111111111"', "merchant_id": '"MERCH-1"', "amount": "12.5",
    "currency": '"USD"', "transaction_ts": '"@TS@Z"', "mcc_code": '"5411"', "auth_status": '"APPROVED"',
    "channel": '"POS"',
}


def _record(**fields: str | None) -> str:
    merged = {**_VALID, **fields}
    return "{" + ",".join(f'"{k}":{v}' for k, v in merged.items() if v is not None) + "}"


# The numbers are the positions in this list; the expected outcome of each
# is part of the check, not of this module.
TEMPLATES = (
    _record(),
    _record(transaction_id='"@ID@\\n"'),
    _record(transaction_id='"not-a-uuid"'),
    _record(transaction_id="5"),
    _record(transaction_id=None),
    _record(transaction_id='"urn:uuid:@ID@"'),
    _record(transaction_id='"{@ID@}"'),
    _record(card_id='""'),
    _record(card_id="4111111111111111"),
    _record(card_id='"\\ud800"'),
    _record(card_id='"\\ud83d\\ude00"'),
    _record(merchant_id="null"),
    _record(merchant_id='"\\udc00x"'),
    _record(amount='"abc"'),
    _record(amount="[1]"),
    _record(amount="50000.01"),
    _record(amount="-0.01"),
    _record(amount="NaN"),
    _record(amount='"\\u00a012.5\\u2003"'),
    _record(amount="true"),
    _record(amount='"1_000.5"'),
    _record(amount="-Infinity"),
    _record(currency='"usd"'),
    _record(transaction_ts='"@TS@Z\\n"'),
    _record(transaction_ts='"@EPOCH@\\n"'),
    _record(transaction_ts='"+@EPOCH@"'),
    _record(transaction_ts='"@TS@,5Z"'),
    _record(transaction_ts='"@TS@−00:00"'),
    _record(transaction_ts='"0000-01-01T00:00:00Z"'),
    _record(transaction_ts='"@TS@"'),
    _record(transaction_ts='"2000-01-01T00:00:00Z"'),
    _record(transaction_ts="true"),
    _record(transaction_ts="1e30"),
    _record(mcc_code='"541"'),
    _record(mcc_code='"54111"'),
    _record(mcc_code="5411"),
    _record(auth_status='"OK"'),
    _record(channel='"WEB"'),
    _record(note="NaN"),
    _record(note='"NaN and \\"Infinity\\""', other="-Infinity"),
    _record(transaction_id=None, currency='"XXX"', channel=None),
    "12",
    "1.5",
    '"text"',
    "true",
    "null",
    "[]",
    '{"a":1} x',
    "NaN",
    _record(auth_status='"DECLINED"', channel='"RECURRING"'),
    _record(channel=None),
    _record(auth_status=None),
    _record(note='"\\\\ud800"'),
    _record(transaction_ts="@EPOCH@"),
    _record(transaction_ts="@EPOCH@000"),
    "",
)


def raw_variants(events: DataFrame) -> DataFrame:
    """``event_id, variant, now, data``: one templated record per event."""
    now = F.date_trunc("second", F.col("ts").cast("timestamp"))
    variant = (F.col("event_id") % len(TEMPLATES)).cast("int")
    rows = events.select("event_id", variant.alias("variant"), now.alias("now"),
                         _hex_uuid(F.md5(F.concat(F.lit("txn-"), F.col("event_id").cast("string")))).alias("id"))
    text = F.get(F.array(*[F.lit(t) for t in TEMPLATES]), "variant")
    text = F.replace(text, F.lit("@ID@"), F.col("id"))
    text = F.replace(text, F.lit("@TS@"), F.date_format("now", "yyyy-MM-dd'T'HH:mm:ss"))
    text = F.replace(text, F.lit("@EPOCH@"), F.unix_seconds("now").cast("string"))
    return rows.select("event_id", "variant", "now", text.cast("binary").alias("data"))
