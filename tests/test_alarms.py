import math

from conftest import DAY, SITE, document, tag
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kilnstream import fixed
from kilnstream.operators import alarms, cells, messages
from kilnstream.plans import batch

ASSETS = [(SITE, "Machine001", "Y")]
LIMITS = ["2", "150", "1", "250", "0.5", "400"]


def accepted(rows):
    return messages.accepted(messages.parse_machine_messages(rows))


def levels(masters, rows, **options):
    pairs = cells.document_tags(accepted(rows), alarms.limited_tags(masters.tags))
    return {r["offset"]: r["alarm_level_cd"] for r in
            alarms.alarm_levels(pairs, **options).collect()}


def test_levels(masters_of, texts):
    masters = masters_of(ASSETS, [tag("Machine001", "T1", "7", "c7", limits=LIMITS)])
    values = ["2.0", "150.0", "1.9", "150.1", "0.9", "250.5", "0.4", "400.5", "9", '"0.1"',
              "null", '{"$numberDouble": "NaN"}', '{"$numberDouble": "Infinity"}', "0"]
    rows = texts(*[document(f'"7": {value}') for value in values], document())
    assert levels(masters, rows) == {
        2: "0", 3: "0", 4: "1", 5: "1", 6: "2", 7: "2", 12: "2"
    }
    assert levels(masters, rows, widen_ints=True)[13] == "2"


def test_worst_level_wins_whatever_side(masters_of, texts):
    masters = masters_of(ASSETS, [
        tag("Machine001", "T1", "7", "c7", limits=[None, "10", None, None, "20", None])
    ])
    assert levels(masters, texts(document('"7": 15.0'))) == {0: "2"}


def test_absent_and_unreadable_limits_never_fire(masters_of, texts):
    masters = masters_of(ASSETS, [
        tag("Machine001", "T1", "7", "a"),
        tag("Machine001", "T2", "7", "b", limits=["x", " ", "", "NaN"]),
    ])
    assert levels(masters, texts(document('"7": 1e300'), document('"7": -1e300'))) == {}


def test_alarm_record(masters_of, texts):
    masters = masters_of(ASSETS, [
        tag("Machine001", "T1", "7", "a", limits=[None, "1"]),
        tag("Machine001", "T2", "12", "b", limits=[None, "1"]),
        tag("Machine001", "T3", "100", "c", limits=[None, "1"]),
    ])
    day = '"0": 5.0, "1": 12.0, "2": 1.9, "3": 23.0, "4": 0.0'
    rows = texts(document('"7": 2.0, "12": 100.0, "100": 1.5', day=day))
    history = batch.machine_alarms(accepted(rows), masters)
    found = {r["tag_id"]: r for r in history.collect()}
    assert {t: r["alarm_id"] for t, r in found.items()} == {
        "T1": "LOT__001_1_2051201230007", "T2": "LOT__001_1_2051201230012",
        "T3": "LOT__001_1_20512012300100",
    }
    row = found["T2"]
    assert (row["site_id"], row["asset_id"], row["alarm_val"], row["alarm_level_cd"]) == (
        SITE, "Machine001", 100.0, "0")
    assert (row["alarm_desc"], row["confirm_yn"]) == ("알람 발생 값 = 100.0", "N")
    assert row["alarm_date_time"] is not None


def test_missing_time_parts_give_no_alarm_id(masters_of, texts):
    masters = masters_of(ASSETS, [tag("Machine001", "T1", "7", "a", limits=[None, "1"])])
    rows = texts(
        document('"7": 2.0', day=DAY.replace("24.0", "24")),
        document('"7": 2.0', day='"0": 24.0'),
        document('"7": 2.0'),
    )
    history = batch.machine_alarms(accepted(rows), masters)
    ids = {r["offset"]: r["alarm_id"] for r in history.collect()}
    assert ids[0] is None and ids[1] is None and ids[2] is not None
    issues = {(r["offset"], r["issue"]) for r in alarms.alarm_issues(history).collect()}
    assert issues == {(0, alarms.NO_TIME), (1, alarms.NO_TIME)}


def expected_level(value, limits):
    """The six checks one after the other, later ones overwriting."""
    level = None
    for code, low, high in (("0", *limits[:2]), ("1", *limits[2:4]), ("2", *limits[4:])):
        if low is not None and value < low:
            level = code
        if high is not None and value > high:
            level = code
    return level


number = st.one_of(st.floats(-5, 5), st.sampled_from([math.inf, -math.inf, math.nan, 0.0]))
limit = st.one_of(st.none(), st.integers(-4, 4).map(float))


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(cases=st.lists(st.tuples(number, *[limit] * 6), min_size=40, max_size=80))
def test_level_equals_sequential_checks(spark, cases):
    columns = ", ".join(f"{c} double" for c in ("i", "value", *fixed.LIMIT_COLUMNS))
    frame = spark.createDataFrame([(float(i), *case) for i, case in enumerate(cases)], columns)
    rows = frame.select("i", F.expr(alarms.level_of("value")).alias("level")).collect()
    assert {int(r["i"]): r["level"] for r in rows} == {
        i: expected_level(case[0], case[1:]) for i, case in enumerate(cases)
    }
