"""What jobs keep between batches: offsets, versions, masters of a batch, chart data."""

import random

from conftest import SITE, asset_frame, code_frame, document, message_rows, tag, tag_frame

from kilnstream import schemas
from kilnstream.operators import lots, messages
from kilnstream.plans import batch
from kilnstream.sinks import compaction, ledger, relational
from kilnstream.sinks.tables import BatchTables, drop_replayed
from kilnstream.sinks.versions import RecordedMasters, VersionedTable
from kilnstream.sources import streams
from kilnstream.streaming import jobs

PLACE = "topic string, partition int, `offset` bigint"
ASSETS = [(SITE, "Machine001", "Y"), (SITE, "Machine002", "N")]


def test_runs_of_offsets_are_merged(spark, monkeypatch):
    monkeypatch.setattr(ledger, "SPAN", 10)
    random.seed(1)
    offsets = sorted(random.sample(range(200), 90))
    places = [("t", 0, n) for n in offsets + offsets[:20]] + [("t", 1, 7), (None, None, 3),
                                                              ("t", 2, None)]
    found = ledger.covered(spark.createDataFrame(places, PLACE)).collect()
    inside = [(r["topic"], r["partition"], n) for r in found
              for n in range(r["min_offset"], r["max_offset"] + 1)]
    assert sorted(inside, key=repr) == sorted({p for p in places if p[2] is not None}, key=repr)
    of_one = sorted((r["min_offset"], r["max_offset"]) for r in found if r["partition"] == 0)
    assert all(low > high + 1 for (_, high), (low, _) in zip(of_one, of_one[1:]))


def test_only_recorded_offsets_are_dropped(spark, tmp_path, messages_of, monkeypatch):
    monkeypatch.setattr(ledger, "SPAN", 8)
    rows = messages_of(message_rows(["{}"] * 60) + message_rows(["{}"] * 60, partition=1)
                       + [(None, None, None, None, "{}")])
    tables = BatchTables(str(tmp_path))
    tables.commit(rows.where("partition = 0 AND `offset` BETWEEN 20 AND 45"), 0)
    tables.commit(rows.where("partition = 0 AND `offset` % 5 = 0"), 1)
    tables.commit(rows.where("partition IS NULL"), 2)
    left = drop_replayed(rows, tables)
    assert left.columns == rows.columns
    expected = {(0, n) for n in range(60) if not 20 <= n <= 45 and n % 5} \
        | {(1, n) for n in range(60)} | {(None, None)}
    found = [(r["partition"], r["offset"]) for r in left.collect()]
    assert set(found) == expected and len(found) == len(expected)
    assert tables.last_batch(spark) == 2


def test_versions_of_a_table(spark, tmp_path):
    versions = VersionedTable(BatchTables(str(tmp_path)), "master", every=4)
    assert versions.newest(spark) is None

    def rows(n):
        return [("a", n, None), ("a", n, None), (None, 0, "x"), ("b", n // 7, "y")]

    schema = "name string, n int, more string"
    most = 0
    for number in range(50):
        versions.write(spark.createDataFrame(rows(number), schema), number)
        pointer = versions.newest(spark)
        most = max(most, len(versions.files(pointer)))
        if number % 10 == 9:
            found = versions.read(spark, pointer).collect()
            assert sorted(map(tuple, found), key=repr) == sorted(rows(number), key=repr)
    assert most == 5  # a base and four batches of changes, however many batches there were
    again = spark.createDataFrame(rows(99)[:1], schema)
    versions.write(again, 49)
    assert [tuple(r) for r in versions.read(spark, versions.newest(spark)).collect()] == rows(99)[:1]
    assert versions.newest(spark, before=49)["batch_id"] == 48
    old = versions.read(spark, versions.recorded(spark, 20)).collect()
    assert sorted(map(tuple, old), key=repr) == sorted(rows(20), key=repr)
    versions.write(again.withColumnRenamed("more", "other"), 50)
    assert versions.read(spark, versions.newest(spark)).columns == ["name", "n", "other"]


def test_a_batch_that_runs_again_has_its_first_masters(spark, tmp_path, messages_of):
    tables, limits = BatchTables(str(tmp_path)), ["10"]

    def load(session):
        tags = [tag("Machine001", "T1", "7", "c7", limits=[None, limits[-1]])]
        return asset_frame(session, ASSETS), tag_frame(session, tags), code_frame(session)

    masters = RecordedMasters(load, tables, SITE)

    def run(number):
        rows = messages_of(message_rows([document('"7": 15.0')], first=number))
        jobs.write_documents_batch(rows, number, masters, tables, with_alarms=True)
        return sorted(r["offset"] for r in tables.read(spark, batch.ALARMS).collect())

    assert run(0) == [0]
    limits.append("20")
    assert run(1) == [0]
    assert run(0) == [0] and run(1) == [0]
    limits.append("5")
    assert run(1) == [0] and run(2) == [0, 2]


def test_chart_data_of_batches_is_put_together(spark, tmp_path, masters_of, messages_of):
    tables = BatchTables(str(tmp_path))
    of_one = masters_of([(SITE, "Machine001", "Y")], [tag("Machine001", "T1", "7", "c7")])
    texts = [document(f'"7": {value}') for value in ("3.0", "1.0", "9.5", '"x"', "2.5")]
    rows = message_rows(texts)
    for number, part in enumerate((rows[3:], rows[:1], rows[1:3])):
        jobs.write_documents_batch(messages_of(part), number, lambda _: of_one, tables, False,
                                   charts=True, command=["cat"])
    whole = lots.chart_series(
        messages.accepted(messages.parse_machine_messages(messages_of(rows))), of_one).collect()
    assert [r.asDict() for r in jobs.read_charts(spark, tables).collect()] \
        == [r.asDict() for r in whole]
    assert whole[0]["last_val"] == 2.5 and whole[0]["n"] == 4
    lines = tables.read(spark, batch.LOT_LINES).collect()
    assert sorted((r["batch_id"], r["line_no"]) for r in lines) == [
        (0, 0), (0, 1), (1, 0), (2, 0), (2, 1)]
    assert {r["error"] for r in lines} == {None}


def test_compacted_batches_are_the_same_rows_in_fewer_files(spark, tmp_path, masters_of,
                                                            messages_of):
    tables = BatchTables(str(tmp_path))
    of_one = masters_of([(SITE, "Machine001", "Y")], [tag("Machine001", "T1", "7", "c7")])

    def run(number):
        texts = [document(lot=f"LOT__00{n}_1") for n in range(3)]
        rows = messages_of(message_rows(texts, first=10 * number))
        jobs.write_documents_batch(rows.repartition(3), number, lambda _: of_one, tables, False)

    def rows():
        found = compaction.read_table(spark, tables, batch.DOCUMENTS)
        return found, sorted((r["offset"], r["asset_id"], r["batch_id"]) for r in found.collect())

    assert compaction.compact(spark, tables, batch.DOCUMENTS) is None
    for number in range(5):
        run(number)
    before, expected = rows()
    assert len(expected) == 15
    assert compaction.compact(spark, tables, batch.DOCUMENTS, ("asset_id",)) == 3
    after, found = rows()
    assert found == expected and set(after.columns) == set(before.columns)
    assert len(after.inputFiles()) < len(before.inputFiles())
    assert sorted(r["offset"] for r in before.collect()) == [row[0] for row in expected]
    run(4)  # the newest batch may be written again
    run(5)
    assert rows()[1][:15] == expected and len(rows()[1]) == 18
    assert compaction.compact(spark, tables, batch.DOCUMENTS, ("asset_id",), 2) == 4
    assert rows()[1][:15] == expected and len(rows()[1]) == 18


def test_order_text_does_not_follow_the_clock_change(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        times = ["2024-10-27T00:30:00Z", "2024-10-27T01:10:00.000007Z", "1969-12-31T23:59:59.5Z"]
        orders = spark.createDataFrame([(time,) for time in times], "t string").selectExpr(
            "named_struct('timestamp', CAST(t AS timestamp), 'partition', 3, 'offset', 12L) "
            "AS stat_order").select(relational.order_text().alias("o")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    tail = "0000000003" + "00000000000000000012"
    assert [r["o"] for r in orders] == [
        f"20241027003000000000{tail}", f"20241027011000000007{tail}", f"19691231235959500000{tail}"]


def test_messages_sent_again_are_dropped(spark, tmp_path):
    rows = message_rows(["{}", "{}"]) + [(None, None, None, message_rows(["{}"])[0][3], text)
                                         for text in ("a", "a", "b", None)]
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    for number in range(2):
        spark.createDataFrame(rows + message_rows(["{}"], partition=5 + number), schemas.MESSAGE) \
            .write.mode("append").parquet(folder)
        streams.without_repeats(streams.file_stream(spark, folder), "1 hour").writeStream.format(
            "parquet").option("path", out).option("checkpointLocation", f"{out}_c").trigger(
            availableNow=True).start().awaitTermination()
    found = [(r["partition"], r["offset"], r["value"])
             for r in spark.read.schema(schemas.MESSAGE).parquet(out).collect()]
    assert sorted(found, key=repr) == sorted(
        [(0, 0, "{}"), (0, 1, "{}"), (5, 0, "{}"), (6, 0, "{}"), (None, None, "a"),
         (None, None, "b"), (None, None, None)], key=repr)


def test_offsets_to_go_on_from(spark):
    commits = spark.createDataFrame(
        [("t", 0, 0, 9), ("t", 0, 10, 19), ("t", 0, 25, 30), ("t", 1, 4, 4), ("u", 2, 0, 0),
         (None, None, None, None)],
        "topic string, partition int, min_offset bigint, max_offset bigint")
    assert streams.resume_offsets(commits) == \
        '{"t": {"0": 20, "1": 5}, "u": {"2": 1}}'
