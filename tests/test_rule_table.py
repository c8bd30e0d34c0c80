"""Rules from a table: equal to the built-in ones, faults refused, versions compared."""
import json

import pytest
from pyspark.sql import functions as F

from conftest import DROP, NOW, as_bytes, txn
from ledgerflow import schema as S
from ledgerflow.functions import decode as D
from ledgerflow.functions import rule_table as RT
from ledgerflow.functions import rules as R
from ledgerflow.operators import route

RECORDS = [
    txn(), txn(amount=-1), txn(amount=60000), txn(amount="x"), txn(currency="XXX"), txn(mcc_code="1"),
    txn(card_id=DROP), txn(merchant_id="SHOP-1"), txn(merchant_id=5), txn(transaction_id="no"),
    txn(transaction_ts="2026-04-28T14:00:00"), txn(transaction_ts="2026-04-28T12:00:00Z"), txn(channel="WEB"),
    txn(auth_status=None), txn(transaction_ts="later", channel=DROP),
]


def raw(spark):
    return spark.createDataFrame([(i, bytearray(as_bytes(r))) for i, r in enumerate(RECORDS)], "id int, data binary")


def table(spark, *rows):
    return spark.createDataFrame(list(rows), RT.RULE_TABLE_SCHEMA)


def outcomes(spark, rules):
    c = route.classify(raw(spark), now=F.lit(NOW).cast("timestamp"), rules=rules)
    return {r["id"]: (r["reasons"], r["warnings"]) for r in c.select("id", "reasons", "warnings").collect()}


def test_default_rows_are_the_built_in_rules(spark, tmp_root):
    RT.save_rules(spark, RT.default_rows(1), tmp_root + "/rules")
    RT.save_rules(spark, RT.default_rows(7)[:1], tmp_root + "/rules")     # another version beside it
    rules = RT.compile_rules(RT.read_rules(spark, tmp_root + "/rules"), 1)
    assert [(r.rule_id, r.field, r.stage, r.severity) for r in rules] \
        == [(r.rule_id, r.field, r.stage, r.severity) for r in R.default_rules()]
    assert outcomes(spark, rules) == outcomes(spark, None)


def test_position_gives_the_report_order(spark):
    rows = [(1, 2, "A", "card_id", "text", {}, S.SEVERITY_ERROR),
            (1, 1, "B", "currency", "one_of", {"values": '["EUR"]'}, S.SEVERITY_ERROR)]
    rules = RT.compile_rules(table(spark, *rows), 1)
    assert [r.rule_id for r in rules] == ["B", "A"]
    assert outcomes(spark, rules)[6][0] == ["INVALID_FIELD:currency:enum", "MISSING_FIELD:card_id"]


def test_pattern_and_thresholds(spark):
    rows = [(1, 1, "FORM", "merchant_id", "pattern", {"pattern": "^MERCH-"}, S.SEVERITY_WARNING),
            (1, 2, "TS", "transaction_ts", "datetime", {}, S.SEVERITY_ERROR),
            (1, 3, "FRESH", "transaction_ts", "freshness", {"threshold_seconds": "7200"}, S.SEVERITY_ERROR)]
    got = outcomes(spark, RT.compile_rules(table(spark, *rows), 1))
    assert got[7] == ([], ["INVALID_FIELD:merchant_id:string_pattern_mismatch"])
    assert got[8] == ([], [])                     # not a text: the pattern does not judge it
    assert got[11] == ([], [])                    # two hours old, allowed here
    assert got[0] == ([], [])


@pytest.mark.parametrize("row, fault", [
    (("X", "card_id", "luhn", {}, "ERROR"), "check 'luhn' is unknown"),
    (("X", "card", "text", {}, "ERROR"), "field 'card' is unknown"),
    (("X", None, "text", {}, "ERROR"), "field None is unknown"),
    (("X", "card_id", None, {}, "ERROR"), "check None is unknown"),
    (("X", "card_id", "text", {}, "FATAL"), "severity 'FATAL' is unknown"),
    (("X", "card_id", "text", {"min": "1"}, "ERROR"), "argument 'min' is unknown"),
    (("X", "card_id", "text", {"min_length": "one"}, "ERROR"), "argument 'min_length'"),
    (("X", "card_id", "text", {"min_length": "-1"}, "ERROR"), "argument 'min_length': is negative"),
    (("X", "card_id", "text", {"min_length": "5", "max_length": "4"}, "ERROR"), "min_length is above max_length"),
    (("X", "card_id", "number_range", {"low": "0", "high": "1"}, "ERROR"), "can't judge field 'card_id'"),
    (("X", "amount", "number_range", {"low": "0"}, "ERROR"), "argument 'high' is missing"),
    (("X", "amount", "number_range", {"low": "0", "high": "inf"}, "ERROR"), "argument 'high': is not finite"),
    (("X", "currency", "one_of", {"values": "USD"}, "ERROR"), "argument 'values'"),
    (("X", "currency", "one_of", {"values": "[]"}, "ERROR"), "argument 'values'"),
    (("X", "currency", "one_of", None, "ERROR"), "argument 'values' is missing"),
    (("X", "card_id", "pattern", {"pattern": "("}, "ERROR"), "is not a regular expression"),
    ((None, "card_id", "text", {}, "ERROR"), "rule_id is empty"),
])
def test_faults_are_refused_before_records_are_read(spark, row, fault):
    with pytest.raises(RT.RuleTableError) as refused:
        RT.compile_rules(table(spark, (1, 1, *row)), 1)
    assert fault in str(refused.value)


def test_all_faults_are_reported_and_versions_stand_alone(spark):
    rows = table(spark, (1, 1, "A", "card_id", "luhn", {}, "ERROR"), (1, 1, "A", "cards", "text", {}, "ERROR"),
                 (2, 1, "A", "card_id", "text", {}, "ERROR"), (3, None, "A", "card_id", "text", {}, "ERROR"))
    with pytest.raises(RT.RuleTableError) as refused:
        RT.compile_rules(rows, 1)
    for fault in ("check 'luhn'", "field 'cards'", "rule_id 'A' is repeated", "position 1 is repeated"):
        assert fault in str(refused.value)
    assert len(RT.compile_rules(rows, 2)) == 1
    with pytest.raises(RT.RuleTableError, match="position is empty"):
        RT.compile_rules(rows, 3)
    with pytest.raises(RT.RuleTableError, match="version 9 has no rules"):
        RT.compile_rules(rows, 9)


def test_a_version_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(RT, "MAX_RULES", 3)
    with pytest.raises(RT.RuleTableError, match="more than 3 rules"):
        RT.compile_rules(table(spark, *RT.default_rows(1)), 1)


def test_versions_side_by_side_equal_each_alone(spark):
    second = [(2, 1, "A", "amount", "number_range", {"low": "0", "high": "10"}, S.SEVERITY_ERROR),
              (2, 2, "C", "channel", "one_of", {"values": json.dumps(["POS"])}, S.SEVERITY_WARNING),
              (2, 3, "T", "transaction_ts", "datetime", {}, S.SEVERITY_ERROR),
              (2, 4, "F", "transaction_ts", "freshness", {}, S.SEVERITY_WARNING)]
    stored = table(spark, *RT.default_rows(1), *second)
    versions = {v: RT.compile_rules(stored, v) for v in (1, 2)}
    compared = RT.compare_versions(D.split(raw(spark))[0], versions, F.lit(NOW).cast("timestamp"))
    rows = compared.select("id", F.inline("outcomes")).collect()
    assert len(rows) == 2 * len(RECORDS)
    for version, rules in versions.items():
        alone = outcomes(spark, rules)
        assert {r["id"]: (r["errors"], r["warnings"]) for r in rows if r["version"] == version} == alone
