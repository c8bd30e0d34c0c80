"""Seeded synthetic transactions.

Every random draw is a pure function of ``(seed, salt, row id)``: a
52-bit uniform read from the MD5 of that text.  A row's values do not
depend on partitioning, task order or retries, and the same numbers can
be recomputed by any engine with MD5.  Python's Mersenne sequence is
not reproduced.

* ``weighted_choice`` (G1): first item whose cumulative weight exceeds
  ``u * total``.
* ``long_tail_amount`` (G2): log-normal by Box-Muller, clamped, 2 decimals.
* ``generate_valid`` (G3): rejection sampling; rows that fail validation
  are drawn again with the next attempt number, at most ``max_attempts``.
* ``transactions`` (G4-G6): one transaction per input id.
"""

from __future__ import annotations

import math
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..session import stage

# ---------------------------------------------------------------------------
# Domain pools and weights of the transaction generator.
# ---------------------------------------------------------------------------
MCC_POOL = ("5411", "5812", "5541", "4111", "5732", "5311", "4899", "4511", "7011", "5999")
CURRENCY_WEIGHTS = (80.0, 8.0, 5.0, 4.0, 2.0, 1.0)      # USD EUR GBP CNY JPY CAD
AUTH_STATUS_WEIGHTS = (95.0, 4.0, 1.0)                  # APPROVED DECLINED PENDING
CHANNEL_WEIGHTS = (40.0, 50.0, 5.0, 3.0, 2.0)           # POS ECOM ATM PHONE RECURRING
AMOUNT_MU, AMOUNT_SIGMA, AMOUNT_FLOOR, AMOUNT_CAP = 3.5, 1.0, 0.01, 50000.0

_UNIFORM_DIGITS = 13                 # 13 hex digits = 52 bits
_UNIFORM_SCALE = float(16 ** _UNIFORM_DIGITS)


class GenerationError(ValueError):
    """Raised when rows still fail validation after every attempt."""


def hash_hex(seed: int, salt: str, row_id: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(salt), row_id.cast("string")))


def uniform(seed: int, salt: str, row_id: Column) -> Column:
    """Uniform double in [0, 1) from ``(seed, salt, row id)``."""
    digits = F.substring(hash_hex(seed, salt, row_id), 1, _UNIFORM_DIGITS)
    return F.conv(digits, 16, 10).cast("double") / F.lit(_UNIFORM_SCALE)


def weighted_choice(items: Sequence[str], weights: Sequence[float], u: Column) -> Column:
    """Pick an item with probability proportional to its weight (G1)."""
    if len(items) != len(weights):
        raise ValueError(f"length mismatch: {len(weights)} weights for {len(items)} items")
    if not items:
        raise ValueError("items must not be empty")
    total = float(sum(weights))
    target = u * F.lit(total)
    cumulative = 0.0
    choice = None
    for item, weight in zip(items[:-1], weights[:-1]):
        cumulative += float(weight)
        cond = target < F.lit(cumulative)
        choice = F.when(cond, F.lit(item)) if choice is None else choice.when(cond, F.lit(item))
    last = F.lit(items[-1])
    return last if choice is None else choice.otherwise(last)


def long_tail_amount(u1: Column, u2: Column, mu: float = AMOUNT_MU, sigma: float = AMOUNT_SIGMA,
                     floor: float = AMOUNT_FLOOR, cap: float = AMOUNT_CAP) -> Column:
    """Log-normal amount, clamped to ``[floor, cap]``, 2 decimals."""
    z = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - u1)) * F.cos(F.lit(2 * math.pi) * u2)
    raw = F.exp(F.lit(mu) + F.lit(sigma) * z)
    return F.round(F.least(F.greatest(raw, F.lit(floor)), F.lit(cap)), 2)


def card_number(seed: int, index: Column) -> Column:
    """16-digit card id of pool slot ``index``."""
    digits = F.substring(hash_hex(seed, "card", index), 1, 14)
    return F.lpad(F.pmod(F.conv(digits, 16, 10).cast("long"), F.lit(10 ** 16)).cast("string"),
                  16, "0")


def merchant_id(seed: int, index: Column) -> Column:
    """``MERCH-`` plus 8 upper-case hex digits of pool slot ``index``."""
    return F.concat(F.lit("MERCH-"), F.upper(F.substring(hash_hex(seed, "merchant", index), 1, 8)))


def uuid4_text(seed: int, salt: str, row_id: Column) -> Column:
    """Version-4 shaped UUID text from the row hash."""
    h = hash_hex(seed, salt, row_id)
    variant = F.substring(F.lit("89ab"),
                          (F.pmod(F.conv(F.substring(h, 17, 1), 16, 10).cast("int"), F.lit(4)) + 1),
                          1)
    return F.concat(F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-4"),
                    F.substring(h, 14, 3), F.lit("-"), variant, F.substring(h, 18, 3),
                    F.lit("-"), F.substring(h, 21, 12))


def transactions(ids: DataFrame, seed: int, *, id_col: str = "id", now: Column | None = None,
                 card_pool_size: int = 1000, merchant_pool_size: int = 200,
                 timestamp_drift_seconds: int = 60, attempt: int = 0) -> DataFrame:
    """One transaction per row of ``ids`` (G4), keeping the ``ids`` columns.

    ``now`` is the clock the time is drawn back from (default: query
    start); a draw of ``attempt`` > 0 uses fresh numbers for the row.
    """
    if card_pool_size < 1 or merchant_pool_size < 1:
        raise ValueError("pool sizes must be >= 1")
    rid = F.concat_ws(":", F.col(id_col).cast("string"), F.lit(str(attempt)))
    now = F.current_timestamp() if now is None else now.cast("timestamp")
    card_slot = F.floor(uniform(seed, "card-pick", rid) * card_pool_size).cast("long")
    merchant_slot = F.floor(uniform(seed, "merchant-pick", rid) * merchant_pool_size).cast("long")
    drift = F.floor(uniform(seed, "drift", rid) * (timestamp_drift_seconds + 1)).cast("long")
    mcc_slot = F.floor(uniform(seed, "mcc", rid) * len(MCC_POOL)).cast("int")
    mcc = F.element_at(F.array(*[F.lit(m) for m in MCC_POOL]), mcc_slot + 1)
    return ids.select(
        "*",
        uuid4_text(seed, "txn", rid).alias("transaction_id"),
        card_number(seed, card_slot).alias("card_id"),
        merchant_id(seed, merchant_slot).alias("merchant_id"),
        long_tail_amount(uniform(seed, "amount-1", rid), uniform(seed, "amount-2", rid))
        .alias("amount"),
        weighted_choice(S.CURRENCIES, CURRENCY_WEIGHTS, uniform(seed, "currency", rid))
        .alias("currency"),
        F.timestamp_micros(F.unix_micros(now) - drift * F.lit(1_000_000)).alias("transaction_ts"),
        mcc.alias("mcc_code"),
        weighted_choice(S.AUTH_STATUSES, AUTH_STATUS_WEIGHTS, uniform(seed, "auth", rid))
        .alias("auth_status"),
        weighted_choice(S.CHANNELS, CHANNEL_WEIGHTS, uniform(seed, "channel", rid))
        .alias("channel"),
    )


def generate_valid(ids: DataFrame, build: Callable[[DataFrame, int], DataFrame],
                   validate: Callable[[DataFrame], DataFrame], *, id_col: str = "id",
                   max_attempts: int = 5) -> DataFrame:
    """Rejection sampling.

    ``build(pending_ids, attempt)`` draws candidates, ``validate`` adds
    ``is_valid`` and ``reasons``.  Rows that fail are drawn again with the
    next attempt number; after ``max_attempts`` the remaining failures are
    raised with their reasons.  Each round is staged once and covers only the
    rows that are still pending, so work shrinks with every round and nothing
    is held in executor memory.
    """
    if max_attempts < 1:
        raise ValueError(f"max_attempts must be >= 1 for any row to be drawn (it is {max_attempts})")
    accepted: DataFrame | None = None
    pending = ids
    for attempt in range(max_attempts):
        checked = stage(validate(build(pending, attempt)), "generated")
        good = checked.filter(F.col("is_valid")).drop("is_valid", "reasons")
        accepted = good if accepted is None else accepted.unionByName(good)
        failed = checked.filter(~F.col("is_valid"))
        if failed.isEmpty():
            return accepted
        pending = failed.select(*ids.columns)
    sample = failed.select(id_col, "reasons").limit(3).collect()
    raise GenerationError(
        f"{failed.count()} rows failed validation after {max_attempts} attempts; "
        f"first: {[(r[id_col], list(r['reasons'])) for r in sample]}")


def validate_transactions(txns: DataFrame, now: Column | None = None) -> DataFrame:
    """Serialise generated rows and run them through decode + rules."""
    from . import route
    from .producer import to_stream_records

    checked = route.classify(to_stream_records(txns), now=now)
    return checked.select(*txns.columns, "is_valid", "reasons")
