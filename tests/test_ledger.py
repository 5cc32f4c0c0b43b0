"""Intervals of written offsets: spans, masks, and no task that gets all of them."""

import random

from kilnstream.sinks import ledger
from kilnstream.sinks.tables import COMMITS, BatchTables

PLACE = "topic string, partition int, `offset` bigint"
INTERVAL = "topic string, partition int, min_offset bigint, max_offset bigint"


def random_intervals(n, seed):
    rng = random.Random(seed)
    found = []
    for _ in range(n):
        low = rng.randrange(-200, 400)
        found.append((rng.choice(["t", None]), rng.randrange(2), low,
                      low + rng.choice([0, 0, 1, 2, 5, 40])))
    return found


def test_merged_intervals_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ledger, "SPAN", 10)
    rows = random_intervals(60, 3)
    held = {}
    for topic, partition, low, high in rows:
        held.setdefault((topic, partition), set()).update(range(low, high + 1))
    expected = []
    for key, numbers in held.items():
        for low in (n for n in numbers if n - 1 not in numbers):
            high = low
            while high + 1 in numbers:
                high += 1
            expected.append((*key, low, high))
    found = ledger.merged(spark.createDataFrame(rows, INTERVAL)).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)


def test_messages_meet_masks_of_a_fixed_size(spark, monkeypatch):
    monkeypatch.setattr(ledger, "SPAN", 100)
    measured, measure = [], ledger.measure
    monkeypatch.setattr(ledger, "measure", lambda *frames: (measured.extend(frames), measure(*frames))[1])
    rows = random_intervals(30, 4)
    places = [(topic, partition, n) for topic in ("t", None) for partition in (0, 1)
              for n in [*range(-210, 450, 3), None]]
    written = {(p, n) for t, p, low, high in rows if t for n in range(low, high + 1)}
    left = ledger.outside(spark.createDataFrame(places, PLACE), spark.createDataFrame(rows, INTERVAL))
    expected = [p for p in places if p[0] is None or (p[1], p[2]) not in written]
    assert sorted(map(tuple, left.collect()), key=repr) == sorted(expected, key=repr)
    assert [field.dataType.simpleString() for frame in measured for field in frame.schema] \
        == ["string", "int", "bigint", "bigint"]


def test_a_commit_is_not_written_by_one_task(spark, tmp_path, monkeypatch):
    tables, plans = BatchTables(str(tmp_path)), []
    write = BatchTables.write

    def noted(self, rows, table, batch_id, partition_by=()):
        if table == COMMITS:
            plans.append(rows._jdf.queryExecution().toString())
        write(self, rows, table, batch_id, partition_by)

    monkeypatch.setattr(BatchTables, "write", noted)
    tables.commit(spark.createDataFrame([("t", 0, n) for n in (1, 2, 3, 7)], PLACE), 5)
    [plan] = plans
    assert "Coalesce 1" not in plan and "Repartition 1," not in plan
    found = tables.commits(spark).select("min_offset", "max_offset", "n", "batch_id").collect()
    assert sorted(map(tuple, found)) == [(1, 3, 3, 5), (7, 7, 1, 5)]
