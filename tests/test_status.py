from conftest import SITE, asset_frame, message_rows
from pyspark.sql import functions as F

from kilnstream.operators import messages, status

def now():
    return F.lit("2024-05-05 00:00:00").cast("timestamp")


def status_text(machine, a, b='"s"', c='"g"'):
    return (f'{{"machineid": "KR1_{machine}", "status": {a}, "seqStatus": {b}, '
            f'"growStatus": {c}, "datetime": "x"}}')


def latest_of(rows):
    return status.latest_status(messages.accepted(messages.parse_status_messages(rows)))


def test_last_message_wins_as_a_whole(messages_of):
    rows = message_rows([status_text("A", '"old"'), status_text("A", '"new"', "null", "5")])
    rows += message_rows([status_text("A", '"other"')], partition=1, minute=0)
    latest = latest_of(messages_of(rows))
    assert [tuple(r)[:4] for r in latest.collect()] == [("A", "new", None, None)]
    issues = {r["column_nm"] for r in status.status_issues(latest).collect()}
    assert issues == {"seq_proc_stat_cd", "grow_proc_stat_cd"}


def test_ties_of_time_go_to_the_higher_partition_then_offset(messages_of):
    rows = message_rows([status_text("A", '"p0"')], partition=0, first=9)
    rows += message_rows([status_text("A", '"p1"')], partition=1, first=1)
    assert latest_of(messages_of(rows)).first()["asset_stat_cd"] == "p1"


def test_master_update(spark, messages_of):
    master = asset_frame(spark, [
        (SITE, "A", "Y"), (SITE, "A", "N"), (SITE, "B", "Y"), ("S2", "A", "Y")
    ])
    first = latest_of(messages_of(message_rows(
        [status_text("A", '"one"'), status_text("Z", '"none"')], minute=5)))
    updated = status.apply_status(master, first, SITE, now())
    found = {tuple(r)[:4] for r in updated.collect()}
    assert found == {(SITE, "A", "Y", "one"), (SITE, "A", "N", "one"), (SITE, "B", "Y", None),
                     ("S2", "A", "Y", None)}
    older = latest_of(messages_of(message_rows([status_text("A", '"older"')], minute=1)))
    assert status.apply_status(updated, older, SITE, now()).where(
        "asset_stat_cd = 'older'").count() == 0
    newer = latest_of(messages_of(message_rows([status_text("A", "null")], minute=6)))
    again = status.apply_status(updated, newer, SITE, now()).where("site_id = 'S1'")
    assert again.where("asset_id = 'A' AND asset_stat_cd IS NULL").count() == 2
    assert again.where("asset_id = 'B' AND stat_chg_dtm IS NULL").count() == 1
