import pytest
from conftest import document

from kilnstream.functions import text, variants
from kilnstream.operators import messages
from pyspark.sql import functions as F


def parsed_by_offset(frame, column):
    return {row["offset"]: row[column] for row in frame.collect()}


def test_message_bytes_become_text(spark):
    rows = spark.createDataFrame([(bytearray("알람".encode()),)], "value binary")
    assert messages.message_text(rows).first()["value"] == "알람"


@pytest.mark.parametrize("blanks, left", [(0, 0), (1, 1), (2, 0), (3, 1)])
def test_exactly_two_closing_blanks_are_removed(texts, blanks, left):
    rows = texts('{"5": "L' + " " * blanks + '", "6": 1, "9": "x  "}')
    assert messages.repair_lot(rows).first()["value"] == (
        '{"5": "L' + " " * left + '", "6": 1, "9": "x  "}'
    )


def test_repair_acts_on_every_occurrence(texts):
    rows = texts('{"a": "x  ", "6": 1, "b": "y  ", "6": 2}')
    assert messages.repair_lot(rows).first()["value"] == '{"a": "x", "6": 1, "b": "y", "6": 2}'


def test_bad_messages_are_quarantined_with_a_reason(texts):
    rows = texts(
        document(),
        "{broken",
        '{test: 1}',
        '{"5": "a", "5": "b"}',
        None,
        '{"6": 1}',
        '{"5": 7}',
        '{"5": null}',
        "[1, 2]",
    )
    parsed = messages.parse_machine_messages(rows)
    reasons = parsed_by_offset(parsed, "reject_reason")
    assert reasons == {
        0: None, 1: messages.NOT_JSON, 2: messages.NOT_JSON, 3: messages.NOT_JSON,
        4: messages.NOT_JSON, 5: messages.NO_LOT, 6: messages.NO_LOT, 7: messages.NO_LOT,
        8: messages.NO_LOT,
    }
    assert messages.accepted(parsed).count() == 1
    kept = parsed_by_offset(messages.quarantined(parsed), "payload")
    assert kept[1] == "{broken" and len(kept) == 8


def test_failfast_raises(texts):
    parsed = messages.parse_machine_messages(texts("{broken"), mode=messages.FAILFAST)
    with pytest.raises(Exception, match=messages.NOT_JSON):
        messages.accepted(parsed).collect()
    good = messages.parse_machine_messages(texts(document()), mode=messages.FAILFAST)
    assert messages.accepted(good).count() == 1
    with pytest.raises(ValueError):
        messages.parse_machine_messages(texts("{}"), mode="other")


def test_asset_id_comes_from_characters_of_the_lot(texts):
    rows = texts(*[document(lot=lot) for lot in ("LOT__042_9", "LOT__04", "LOT", "")])
    parsed = messages.accepted(messages.parse_machine_messages(rows))
    assert parsed_by_offset(parsed, "asset_id") == {
        0: "Machine042", 1: "Machine04", 2: "Machine", 3: "Machine"
    }
    first = parsed.where("offset = 0").first()
    assert first["oper_stat"] == "1" and first["crt_dtm"] is not None


def test_payload_is_repaired_and_not_enriched(texts):
    payload = messages.parse_machine_messages(texts(document())).first()["payload"]
    assert '"LOT__001_1", "6"' in payload and "operStat" not in payload


def test_status_asset_id_drops_the_prefix(texts):
    rows = texts('{"machineid": "KR1_Machine001"}', '{"machineid": "KR"}', '{"machineid": 5}')
    parsed = messages.parse_status_messages(rows)
    assert parsed_by_offset(parsed, "asset_id") == {0: "Machine001", 1: "", 2: None}
    assert parsed_by_offset(parsed, "reject_reason")[2] == messages.NO_MACHINE


def test_value_types(texts):
    members = {
        "a": "9", "b": "9.0", "c": "1e3", "d": '"9"', "e": "null", "f": "true", "g": "[1.0]",
        "h": '{"x": 1}', "i": '{"$date": "2024-01-01T00:00:00Z"}', "j": '{"$date": 1700000000000}',
        "k": "9999999999", "l": '{"$numberDouble": "NaN"}', "m": '{"$numberLong": "5"}',
        "n": '{"$numberInt": "5"}', "o": '{"$date": 1, "x": 2}', "p": "-0.0",
        "q": '{"$date": {"$numberLong": "1700000000000"}}',
    }
    body = ", ".join(f'"{key}": {value}' for key, value in members.items())
    docs = messages.accepted(messages.parse_machine_messages(texts(document(body))))
    types = {row["key"]: row["value_type"] for row in messages.value_types(docs).collect()}
    expected = {
        "a": "INT32", "b": "DOUBLE", "c": "DOUBLE", "d": "STRING", "e": "NULL", "f": "BOOLEAN",
        "g": "ARRAY", "h": "DOCUMENT", "i": "DATE_TIME", "j": "DATE_TIME", "k": "INT64",
        "l": "DOUBLE", "m": "INT64", "n": "INT32", "o": "DOCUMENT", "p": "DOUBLE",
        "q": "DATE_TIME",
    }
    assert {key: types[key] for key in expected} == expected


def test_typed_access_demands_the_type(texts):
    body = '"a": 1.5, "b": "1.5", "c": 1'
    docs = messages.parse_machine_messages(texts(document(body)))
    row = docs.select(
        *[F.expr(variants.double_member("members", k)).alias(f"d_{k}") for k in "abcx"],
        *[F.expr(variants.string_member("members", k)).alias(f"s_{k}") for k in "abcx"],
    ).first()
    assert row.asDict() == {
        "d_a": 1.5, "d_b": None, "d_c": None, "d_x": None,
        "s_a": None, "s_b": "1.5", "s_c": None, "s_x": None,
    }


def test_padding_and_whole_parts(spark):
    rows = spark.createDataFrame([("7", 1.9), ("12", 12.0), ("100", -1.5), ("", None)],
                                 "k string, n double")
    out = rows.select(
        F.expr(text.pad_single("k")).alias("k"), F.expr(text.whole_part("n")).alias("n")
    ).collect()
    assert [tuple(r) for r in out] == [("07", "1"), ("12", "12"), ("100", "-1"), ("", None)]


def test_literals_and_names_are_escaped(spark):
    odd = "a'b\\c`d"
    row = spark.range(1).selectExpr(f"{text.quoted(odd)} AS {text.name(odd)}").first()
    assert row.asDict() == {odd: odd}
