"""Steps whose work or partitions must not grow faster than their input."""

from datetime import datetime

import pytest
from conftest import SITE, document, message_rows, tag

from kilnstream.operators import cells
from kilnstream.plans import batch, message_queries
from kilnstream.sinks.tables import BatchTables
from kilnstream.sources import spread
from kilnstream.streaming import jobs


@pytest.fixture
def folder(spark, tmp_path):
    """Events of two machines, and 90 parts, 60 of them of these machines."""
    events = [(n, datetime(2024, 1, 1, 3, n), n % 2, ["error", "click"][n // 3 % 2], n + 0.5,
               f'{{"k": {n}}}') for n in range(12)]
    spark.createDataFrame(
        events, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
        "value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    parts = [(n // 2 * 20 + n % 2 if n < 60 else n * 20 + 5,) for n in range(90)]
    spark.createDataFrame(parts, "p_partkey bigint").write.parquet(f"{tmp_path}/part.parquet")
    return str(tmp_path)


def test_messages_meet_a_large_master_once_per_key(spark, folder, monkeypatch):
    met, pair = [], cells.document_tags
    monkeypatch.setattr(cells, "document_tags", lambda rows, tags, **options: (
        met.append(tags.frame.count()), pair(rows, tags, **options))[1])
    found = message_queries.document_tags_large_master(spark, folder).collect()
    assert met == [2 * 3]
    assert len(found) == 60 * 3
    assert {(r["tag_id"][-1], r["n"], r["n_values"]) for r in found} \
        == {("6", 6, 6), ("7", 6, 6), ("9", 6, 0)}


def test_wide_rows_are_made_of_one_alias_per_class(spark, folder, monkeypatch):
    met, wide = [], cells.wide_cells
    monkeypatch.setattr(cells, "wide_cells", lambda rows, masters: (
        met.append(masters.tags.frame.count()), wide(rows, masters))[1])
    found = message_queries.wide_rows_many_aliases(spark, folder).collect()
    assert met == [2 * 3]
    assert sorted((r["event_id"], r["n_aliases"], r["n_filled"], r["first_cell"]) for r in found) \
        == [(n, 90, 60, "click" if n // 3 % 2 else "0.0") for n in range(12)]


def test_alias_classes_keep_owner_key_and_type(masters_of):
    masters = masters_of([(SITE, "Machine001", "Y")], [
        tag("Machine001", "T1", "7", "b"), tag("Machine001", "T2", "7", "a"),
        tag("Machine001", "T3", "8", "a"), tag("Machine001", "T4", "7", "c", code="D02"),
        tag("Machine001", "T5", None, "d"), tag("Machine001", "T6", "7", None)])
    found = cells.alias_classes(masters.tags.frame).collect()
    assert {(r["alias"], r["tag_id"], r["mapping_key"], r["n_aliases"]) for r in found} == {
        ("a", "T2", "7", 2), ("c", "T4", "7", 1), ("d", "T5", None, 1)}


def test_kept_batches_lie_in_bounded_partitions(spark, tmp_path, masters_of, messages_of,
                                                monkeypatch):
    monkeypatch.setattr(spread, "TASK_BYTES", 2000)
    masters = masters_of([(SITE, "Machine001", "Y")], [tag("Machine001", "T1", "7", "c7")])
    own = message_rows([document('"7": 1.0')] * 60)
    own += own[:2] + [(None, None, None, None, document('"7": 2.0'))] * 2
    rows = messages_of(own).coalesce(1)
    kept, parse = [], jobs.messages.parse_machine_messages

    def noted(given, *options):
        kept.append(given.rdd.getNumPartitions())
        return parse(given, *options)

    monkeypatch.setattr(jobs.messages, "parse_machine_messages", noted)
    tables = BatchTables(str(tmp_path))
    jobs.write_documents_batch(rows, 0, lambda _: masters, tables, with_alarms=False)
    assert kept[0] > 3
    found = tables.read(spark, batch.DOCUMENTS).select("offset").collect()
    assert sorted(map(repr, (r["offset"] for r in found))) == sorted(repr(r[2]) for r in own)
    assert spread.bounded(messages_of(own[:3])).count() == 3


def test_batches_in_few_partitions_are_dealt_to_all_cores(spark, messages_of, monkeypatch):
    rows = messages_of(message_rows([document('"7": 1.0')] * 200))
    assert spread.bounded(rows.coalesce(3)).rdd.getNumPartitions() == 3
    monkeypatch.setattr(spread, "LITTLE_BYTES", 1000, raising=False)
    for few in (1, 3):
        dealt = spread.bounded(rows.coalesce(few))
        assert dealt.rdd.getNumPartitions() == 4
        assert dealt.exceptAll(rows).isEmpty() and dealt.count() == 200
    even = spread.bounded(rows.repartition(4, "offset"))
    assert even.rdd.getNumPartitions() == 4
    monkeypatch.setattr(spread, "TASK_BYTES", 4000)
    dealt = spread.bounded(rows.coalesce(2)).rdd.getNumPartitions()
    assert dealt > 4 and dealt % 4 == 0
    assert spread.bounded(rows.where("false")).isEmpty()


def test_messages_are_typed_before_outputs_are_written_side_by_side(
        tmp_path, masters_of, messages_of, monkeypatch):
    masters = masters_of([(SITE, "Machine001", "Y")], [tag("Machine001", "T1", "7", "c7")])
    frames, loaded = [], []
    typed, write = cells.typed_messages, jobs._write_all
    monkeypatch.setattr(cells, "typed_messages", lambda *given: (
        frames.append(typed(*given)), frames[-1])[1])
    monkeypatch.setattr(jobs, "_write_all", lambda *given: (loaded.append(
        frames[-1]._jdf.queryExecution().withCachedData().cacheBuilder()
        .isCachedColumnBuffersLoaded()), write(*given))[1])
    rows = messages_of(message_rows([document('"7": 1.0')] * 20)).repartition(3, "offset")
    jobs.write_documents_batch(rows, 0, lambda _: masters, BatchTables(str(tmp_path)), True)
    assert loaded == [True]


@pytest.mark.parametrize("task_bytes, in_memory", [(spread.TASK_BYTES, True), (200, False)])
def test_a_large_batch_is_kept_on_disk_only(
        spark, tmp_path, masters_of, messages_of, monkeypatch, task_bytes, in_memory):
    monkeypatch.setattr(spread, "TASK_BYTES", task_bytes)
    masters = masters_of([(SITE, "Machine001", "Y")], [tag("Machine001", "T1", "7", "c7")])
    kept, parse, typed = [], jobs.messages.parse_machine_messages, cells.typed_messages
    monkeypatch.setattr(jobs.messages, "parse_machine_messages", lambda *given: (
        kept.append(parse(*given)), kept[-1])[1])
    monkeypatch.setattr(cells, "typed_messages", lambda *given: (
        kept.append(typed(*given)), kept[-1])[1])
    levels, write = [], jobs._write_all
    monkeypatch.setattr(jobs, "_write_all", lambda *given: (
        levels.extend(frame.storageLevel for frame in kept), write(*given))[1])
    rows = messages_of(message_rows([document('"7": 1.0')] * 40))
    tables = BatchTables(str(tmp_path))
    jobs.write_documents_batch(rows, 0, lambda _: masters, tables, True)
    assert [(level.useDisk, level.useMemory) for level in levels] == [(True, in_memory)] * 2
    assert tables.read(spark, batch.CELLS).count() == 40
