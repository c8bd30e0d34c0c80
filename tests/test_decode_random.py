"""Randomised check of decode against Python's own UTF-8 and JSON decoding."""
import json
import random

from pyspark.sql import functions as F

from ledgerflow.functions import decode as D
from ledgerflow.plans.batch import raw_from_payloads

PIECES = ['{', '}', '[', ']', '"a"', ':', ',', '1', '1.5', '-2e3', 'true', 'null', ' ', 'x',
          '"]"', '"}"', '{"k": [1, {"z": "]"}]}', '[]', '{}', '"\\u00e9"', '\n', '""']


def python_kind(raw: bytes) -> str:
    try:
        text = raw.decode("utf-8")
    except UnicodeDecodeError:
        return "utf8"
    try:
        value = json.loads(text)
    except (ValueError, RecursionError):
        return "json"
    if isinstance(value, float) and value != value:
        return "json"          # NaN literals: Spark rejects them (a stated difference)
    return "ok" if isinstance(value, dict) else "not_dict:" + type(value).__name__


def samples(n=600, seed=7):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        roll = rng.random()
        if roll < 0.3:
            value = {"a": rng.choice([1, "s", None, [1, 2], {"b": "]"}]), "c": rng.random()}
            text = json.dumps(value)
            if rng.random() < 0.5:
                text += rng.choice([" x", "]", "}", "{}", " ", "\n", ",1", "]]"])
            out.append(text.encode())
        elif roll < 0.45:
            out.append(json.dumps(rng.choice([[1, "]"], 5, -1.5, "s", True, None, [{}]])).encode())
        elif roll < 0.55:
            raw = bytes(rng.randrange(256) for _ in range(rng.randrange(1, 6)))
            out.append(b'{"a": "' + raw + b'"}')
        else:
            out.append("".join(rng.choice(PIECES) for _ in range(rng.randrange(1, 8))).encode())
    return out


def test_decode_kind_matches_python(spark):
    payloads = samples()
    raw = raw_from_payloads(spark, payloads).withColumn("i", F.monotonically_increasing_id())
    kinds = D.decode(raw).select(
        "i", F.when(F.col("_decode_kind") == "not_dict",
                    F.regexp_extract("_decode_reason", r"(not_dict:.*)$", 1))
        .otherwise(F.col("_decode_kind")).alias("k"))
    got = [r["k"] for r in kinds.orderBy("i").collect()]
    want = [python_kind(p) for p in payloads]
    diffs = [(p, g, w) for p, g, w in zip(payloads, got, want) if g != w]
    assert not diffs, diffs[:10]
