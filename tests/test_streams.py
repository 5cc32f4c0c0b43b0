"""Jobs as streams: equal to the batch plans, replayed, restarted, with changing masters."""

import pytest
from conftest import SITE, asset_frame, code_frame, document, message_rows, tag, tag_frame
from test_status import status_text

from kilnstream import schemas
from kilnstream.operators import assets, cells, messages
from kilnstream.plans import batch
from kilnstream.sinks.tables import BatchTables, drop_replayed
from kilnstream.sources import streams
from kilnstream.streaming import jobs

ASSETS = [(SITE, "Machine001", "Y"), (SITE, "Machine002", "N")]


class Feed:
    """A message folder, a job's tables and masters that a test can change."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, str(folder)
        self.tables = BatchTables(f"{self.folder}/out")
        self.limit = "10"

    def add(self, rows):
        frame = self.spark.createDataFrame(rows, schemas.MESSAGE)
        frame.coalesce(1).write.mode("append").parquet(f"{self.folder}/in")

    def masters(self, spark):
        tags = [tag("Machine001", "T1", "7", "c7", limits=[None, self.limit])]
        return assets.load_masters(
            asset_frame(spark, ASSETS), tag_frame(spark, tags), code_frame(spark), SITE, keep=True
        )

    def run(self, job, tables=None, max_files=None, **options):
        query = job(
            streams.file_stream(self.spark, f"{self.folder}/in", max_files), self.masters,
            tables or self.tables, f"{self.folder}/checkpoint", available_now=True, **options
        )
        query.awaitTermination()
        return query

    def rows(self, table, *columns):
        return sorted(map(tuple, self.tables.read(self.spark, table).select(*columns).collect()))


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def texts_with(values, lot="LOT__001_1"):
    return [document(f'"7": {value}', lot=lot) for value in values]


def test_machine_job_equals_the_batch_plan(spark, feed):
    rows = message_rows(texts_with(["5.0", "15.0"])) + message_rows(
        texts_with(["25.0"], "LOT__002_1") + ["{bad"], partition=1) + message_rows(
        texts_with(["35.0", "3.0"]), partition=2)
    for partition in (0, 1, 2):
        feed.add([r for r in rows if r[1] == partition])
    feed.run(jobs.machine_job, max_files=1)
    assert feed.tables.last_batch(spark) == 2
    parsed = messages.parse_machine_messages(spark.createDataFrame(rows, schemas.MESSAGE))
    plan = batch.machine_plan(parsed, feed.masters(spark))
    for table, columns in {
        batch.DOCUMENTS: ["partition", "offset", "asset_id", "oper_stat"],
        batch.WIDE: ["partition", "offset", "asset_id", "cells.c7"],
        batch.CELLS: ["partition", "offset", "tag_id", "cell"],
        batch.ALARMS: ["partition", "offset", "alarm_id", "alarm_val", "alarm_level_cd"],
        batch.QUARANTINE: ["partition", "offset", "reject_reason", "payload"],
    }.items():
        expected = sorted(map(tuple, plan[table].select(*columns).collect()))
        assert expected and feed.rows(table, *columns) == expected
    assert len(feed.rows(batch.DOCUMENTS, "offset")) == 5
    assert dict(feed.tables.read(spark, batch.DOCUMENTS).dtypes)["doc"] == "variant"


def test_restart_adds_nothing_and_new_files_go_on(spark, feed):
    feed.add(message_rows(texts_with(["15.0"])))
    feed.run(jobs.machine_job)
    before = feed.rows(batch.ALARMS, "offset", "batch_id")
    feed.run(jobs.machine_job)
    assert feed.rows(batch.ALARMS, "offset", "batch_id") == before
    feed.add(message_rows(texts_with(["16.0"]), first=1))
    feed.run(jobs.machine_job)
    assert feed.rows(batch.ALARMS, "offset", "batch_id") == [*before, (1, 1)]


def test_replay_of_a_batch_changes_nothing(spark, feed, messages_of):
    rows = messages_of(message_rows(texts_with(["15.0", "5.0"])))
    for _ in range(2):
        jobs.write_documents_batch(rows, 0, feed.masters, feed.tables, with_alarms=True)
        assert feed.rows(batch.ALARMS, "offset") == [(0,)]
        assert feed.rows(batch.WIDE, "offset", "cells.c7") == [(0, "15.0"), (1, "5.0")]
    empty = rows.where("offset < 0")
    jobs.write_documents_batch(empty, 1, feed.masters, feed.tables, with_alarms=True)
    assert feed.tables.last_batch(spark) == 0


def test_a_batch_that_fails_halfway_stays_invisible(spark, feed):
    class Failing(BatchTables):
        def write(self, rows, table, batch_id, partition_by=()):
            if table == batch.ALARMS and batch_id == 1 and feed.limit == "fail":
                raise OSError("disk")
            super().write(rows, table, batch_id, partition_by)

    failing = Failing(feed.tables.root)
    feed.add(message_rows(texts_with(["15.0"])))
    feed.run(jobs.machine_job, failing)
    feed.add(message_rows(texts_with(["16.0"]), first=1))
    feed.limit = "fail"
    with pytest.raises(Exception, match="disk"):
        feed.run(jobs.machine_job, failing)
    assert feed.rows(batch.DOCUMENTS, "offset") == [(0,)]
    feed.limit = "10"
    feed.run(jobs.machine_job, failing)
    assert feed.rows(batch.DOCUMENTS, "offset") == [(0,), (1,)]
    assert feed.rows(batch.ALARMS, "offset") == [(0,), (1,)]


def test_masters_are_read_anew_for_every_batch(feed):
    for i, limit in enumerate(["10", "20"]):
        feed.limit = limit
        feed.add(message_rows(texts_with(["15.0"]), first=i))
        feed.run(jobs.machine_job)
    assert feed.rows(batch.ALARMS, "batch_id") == [(0,)]


def test_learning_job_writes_no_alarms(spark, feed):
    seen = []
    feed.add(message_rows(texts_with(["15.0"])))
    feed.run(jobs.learning_job, after=lambda rows, i: seen.append((i, rows.count())))
    wide = cells.wide_view(feed.tables.read(spark, batch.WIDE), ["c7"], {"c7"})
    assert [(r["asset_id"], r["c7"]) for r in wide.collect()] == [("Machine001", 15.0)]
    assert seen == [(0, 1)]
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        feed.tables.read(spark, batch.ALARMS)


def test_two_jobs_run_side_by_side(spark, feed, tmp_path):
    feed.add(message_rows(texts_with(["15.0"])))
    started = [
        jobs.machine_job(
            streams.file_stream(spark, f"{feed.folder}/in"), feed.masters,
            BatchTables(f"{tmp_path}/{n}"), f"{tmp_path}/c{n}", name=name, every="1 second",
        ) for n, name in enumerate([None, "second"])
    ]
    for query in started:
        query.processAllAvailable()
    assert [query.name for query in started] == [None, "second"]
    for n, query in enumerate(started):
        query.stop()
        assert BatchTables(f"{tmp_path}/{n}").read(spark, batch.ALARMS).count() == 1


def test_failfast_stops_the_job(feed):
    feed.add(message_rows(["{bad"]))
    with pytest.raises(Exception, match=messages.NOT_JSON):
        feed.run(jobs.machine_job, mode=messages.FAILFAST)


def test_status_job_keeps_versions(spark, feed):
    jobs.start_asset_versions(asset_frame(spark, ASSETS), feed.tables)
    steps = [
        ([status_text("Machine001", '"one"'), status_text("Machine002", '"no"')], 5, "one"),
        ([status_text("Machine001", '"older"')], 1, "one"),
        ([status_text("Machine001", '"two"'), status_text("Machine009", '"no"')], 9, "two"),
    ]
    for i, (texts, minute, expected) in enumerate(steps):
        feed.add(message_rows(texts, first=10 * i, minute=minute))
        feed.run(jobs.status_job)
        found = {r["asset_id"]: r["asset_stat_cd"]
                 for r in jobs.current_assets(spark, feed.tables).collect()}
        assert found == {"Machine001": expected, "Machine002": None}
    rows = spark.createDataFrame(message_rows(steps[2][0], first=20, minute=9), schemas.MESSAGE)
    jobs.write_status_batch(rows, 2, feed.masters, feed.tables)
    assert jobs.current_assets(spark, feed.tables).count() == 2


def test_status_job_needs_a_first_version(spark, feed, messages_of):
    rows = messages_of([status_text("Machine001", '"x"')])
    with pytest.raises(ValueError, match="start_asset_versions"):
        jobs.write_status_batch(rows, 0, feed.masters, feed.tables)


def test_replayed_offsets_are_dropped(spark, feed, messages_of):
    rows = messages_of(message_rows(texts_with(["1.0", "2.0", "3.0"])))
    assert drop_replayed(rows, feed.tables).count() == 3
    feed.tables.commit(rows.where("offset < 2"), 0)
    left = drop_replayed(rows.unionAll(messages_of(message_rows(["{}"], partition=5))), feed.tables)
    assert sorted((r["partition"], r["offset"]) for r in left.collect()) == [(0, 2), (5, 0)]


def test_staging_suffix(feed):
    staged = BatchTables(feed.tables.root, "_temp")
    assert staged.path(batch.WIDE).endswith("/wide_rows_temp")
