from collections import defaultdict

import pandas as pd
from conftest import SITE, document, message_rows, tag
from pyspark.sql import functions as F

from kilnstream.operators import lots, messages


def accepted(rows):
    return messages.accepted(messages.parse_machine_messages(rows))


def hot_and_small_lots():
    """A lot with most messages in two partitions, many small ones scattered among them."""
    rows = []
    for partition in (0, 1):
        texts = [document(lot="HOT__001" if i % 5 else f"S{i % 3}___001") for i in range(400)]
        rows += message_rows(texts, partition=partition, first=7)
    return rows


def piece_and_lot():
    """Functions of a piece and of a lot: all positions in order, and the largest piece."""
    def piece(rows):
        assert rows["offset"].is_monotonic_increasing
        text = "".join(f"{p}:{o};" for p, o in zip(rows["partition"], rows["offset"]))
        return pd.DataFrame({"positions": [text], "most": [len(rows)]})

    def lot(parts):
        return pd.DataFrame({"positions": ["".join(parts["positions"])],
                             "most": [parts["most"].max()]})

    return piece, lot, "positions string, most bigint"


def test_a_lot_has_one_result_whatever_the_cuts(messages_of):
    rows = hot_and_small_lots()
    expected = defaultdict(str)
    for _, partition, offset, _, text in rows:
        expected[text.split('"5": "')[1].split("  ")[0]] += f"{partition}:{offset};"
    for chunk in (1, 30, 10_000):
        out = lots.apply_to_lots(
            accepted(messages_of(rows)), *piece_and_lot(), chunk
        ).collect()
        assert {r["lot_no"]: r["positions"] for r in out} == expected
        assert len(out) == len(expected) and all(r["most"] <= chunk for r in out)


def test_blocks_of_pieces_are_put_together_in_order(messages_of, monkeypatch):
    monkeypatch.setattr(lots, "RANGE", 4)
    monkeypatch.setattr(lots, "RANGE_BLOCK", 3)
    rows = message_rows([document(lot="A____001") for _ in range(50)], first=90)
    [out] = lots.apply_to_lots(
        accepted(messages_of(rows)), *piece_and_lot(), 3
    ).collect()
    assert out["positions"] == "".join(f"0:{90 + n};" for n in range(50))


def test_messages_without_position_are_kept(messages_of):
    rows = [(topic, partition, offset, time, text) for (_, _, offset, time, text), (topic, partition)
            in zip(message_rows([document(lot="A____001") for _ in range(8)]),
                   [(None, 0), (None, None), ("t", None), ("t", 1)] * 2)]
    count = lots.apply_to_lots(
        accepted(messages_of(rows)), lambda piece: pd.DataFrame({"n": [len(piece)]}),
        lambda parts: pd.DataFrame({"n": [parts["n"].sum()]}), "n bigint", 3,
    )
    assert [tuple(r) for r in count.collect()] == [("A____001", 8)]
    lines = lots.run_on_lots(accepted(messages_of(rows)), ["cat"], 3).collect()
    assert sorted(r["line_no"] for r in lines) == list(range(8))


def test_command_per_lot_reports_errors_as_rows(messages_of):
    rows = message_rows([document(lot="A____001"), document(lot="B____001").replace(", ", ",\n ")])
    good = lots.run_on_lots(accepted(messages_of(rows)), ["cat"]).collect()
    assert {(r["lot_no"], r["line_no"], r["error"]) for r in good} == {
        ("A____001", 0, None), ("B____001  ", 0, None)
    }
    bad = lots.run_on_lots(
        accepted(messages_of(rows)), ["sh", "-c", "head -c 1; echo; echo no >&2; exit 3"]
    ).collect()
    assert sorted((r["lot_no"].strip(), r["line"], r["error"]) for r in bad if r["error"]) == [
        ("A____001", None, "exit 3: no\n"), ("B____001", None, "exit 3: no\n")
    ]
    assert sum(r["line"] == "{" for r in bad) == 2


def test_payloads_are_made_once_for_the_count_and_the_commands(spark, messages_of):
    made = spark.sparkContext.accumulator(0)
    rows = accepted(messages_of(message_rows([document(lot=f"L{n % 3}___001") for n in range(30)])))
    names = ["lot_no", "topic", "partition", "offset", "timestamp", "payload"]

    def counted(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    payloads = rows.select(*names)
    lines = lots.run_on_lots(payloads.mapInArrow(counted, payloads.schema), ["cat"], 4).collect()
    assert len(lines) == 30 and made.value == 30
    assert sorted(r["line_no"] for r in lines if r["lot_no"].startswith("L0")) == list(range(10))


def test_a_program_is_looked_for_once():
    lots._found.cache_clear()
    for text in ("a\n", "b\nc\n"):
        assert lots._output(["cat"], text, None) == (text.splitlines(), None)
    assert (lots._found.cache_info().misses, lots._found.cache_info().hits) == (1, 1)
    assert lots._found("cat").startswith("/")
    assert lots._output(["no-such-program"], "", None)[1].startswith("not started: ")


def test_commands_that_cannot_start_end_or_write_text(messages_of):
    docs = accepted(messages_of(message_rows([document(lot="A____001")])))

    def run(*command, **options):
        return [(r["line"], r["error"]) for r in lots.run_on_lots(docs, command, **options).collect()]

    [(line, error)] = run("/no/such/command")
    assert line is None and error.startswith("not started: ")
    assert run("sleep", "60", seconds=0.5) == [(None, "stopped after 0.5 s")]
    assert run("printf", "\\377\\n") == [("\ufffd", None)]
    assert run("printf", "a\\302\\205b\\342\\200\\250c\\n\\nd") == [
        ("a\x85b\u2028c", None), ("", None), ("d", None)]


def test_pipe_keeps_arrival_order_of_a_lot(messages_of):
    rows = message_rows([document(f'"n": {i}', lot=f"L{i % 2}___001") for i in range(40)])
    lines = [r["line"] for r in lots.pipe_lots(accepted(messages_of(rows)), "cat").collect()]
    for lot in ("L0___001", "L1___001"):
        numbers = [int(x.rsplit(": ", 1)[1].rstrip("}")) for x in lines if x.startswith(lot)]
        assert numbers == sorted(numbers) and len(numbers) == 20


def test_chart_series_of_a_shared_alias_shows_its_owner(masters_of, messages_of):
    masters = masters_of(
        [(SITE, "Machine001", "Y")],
        [tag("Machine001", "T2", "8", "c7"), tag("Machine001", "T1", "7", "c7")],
    )
    rows = message_rows([document('"7": 3.0, "8": 9.0')])
    series = lots.chart_series(accepted(messages_of(rows)), masters).collect()
    assert [(r["alias"], r["n"], r["max_val"]) for r in series] == [("c7", 1, 3.0)]


def test_the_pipe_runs_without_python(messages_of, capsys):
    lots.pipe_lots(accepted(messages_of(message_rows([document()]))), "cat").explain()
    plan = capsys.readouterr().out
    assert "ScriptTransformation" in plan and "Python" not in plan


def test_chart_series(masters_of, messages_of):
    masters = masters_of([(SITE, "Machine001", "Y")], [tag("Machine001", "T1", "7", "c7")])
    texts = [document(f'"7": {v}') for v in ("3.0", "1.0", "2", "2.5", '"x"')]
    row = lots.chart_series(accepted(messages_of(message_rows(texts))), masters).first()
    assert row.asDict() == {
        "lot_no": "LOT__001_1", "minute": "202401020304", "alias": "c7", "n": 3,
        "min_val": 1.0, "max_val": 3.0, "last_val": 2.5,
    }


def test_counts(messages_of):
    docs = accepted(messages_of(hot_and_small_lots()))
    assert sum(r["n"] for r in lots.count_by(docs, "lot_no").collect()) == 800
    assert {r["asset_id"]: r["n"] for r in lots.count_by(docs, "asset_id").collect()} == {
        "Machine001": 800
    }


def test_lots_are_dealt_to_many_tasks_by_weight(messages_of):
    rows = message_rows([document(lot=f"A{i % 40}____001") for i in range(900)])
    rows += message_rows([document(lot="HOT__001") for _ in range(600)], partition=1)
    parts = lots._parts(accepted(messages_of(rows)))
    counts = [r["count"] for r in
              parts.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    assert parts.rdd.getNumPartitions() == 8 and len(counts) >= 6
    assert sorted(counts)[-1] == 600 and sorted(counts)[-2] < 400


def test_heavy_parts_are_packed_evenly():
    weights = [(key, weight) for key, weight in enumerate([90, 50, 40, 30, 30, 30, 20, 10])]
    found = lots.packed(weights, 3)
    held = [sum(weight for key, weight in weights if found[key] == task) for task in range(3)]
    assert sorted(held) == [100, 100, 100]
    assert lots.packed([], 1) == {}


def test_no_messages(messages_of):
    none = accepted(messages_of(message_rows([document()]))).where("false")
    assert lots.apply_to_lots(none, *piece_and_lot()).count() == 0
    assert lots.run_on_lots(none, ["cat"]).count() == 0
