from conftest import SITE, document, message_rows, tag
from pyspark.sql import functions as F

from kilnstream import schemas
from kilnstream.operators import assets, cells, lookup, messages
from kilnstream.operators.lookup import Lookup


def test_measured_size_covers_the_text(spark):
    frame = spark.createDataFrame([("a" * 100, 1), ("b" * 50, None), (None, 3)], "s string, n int")
    empty = frame.where("n > 10")
    sizes = [x.n_bytes for x in lookup.measure(frame, empty)]
    assert sizes == [150 + 3 * 2 * lookup.FIELD_OVERHEAD, 0]


def test_salted_join_equals_broadcast_join(spark, texts):
    docs = messages.accepted(messages.parse_machine_messages(
        texts(*[document(lot=f"LOT__00{i % 7 and 1}_1") for i in range(60)])
    )).select("topic", "partition", "offset", "asset_id")
    master = spark.createDataFrame([("Machine001", "a"), ("Machine001", "b"), ("X", "c")],
                                   "asset_id string, v string")
    for how in ("inner", "left", "left_semi", "left_anti"):
        small = lookup.join_lookup(docs, Lookup(master, 10), ["asset_id"], how)
        large = lookup.join_lookup(docs, Lookup(master, 10), ["asset_id"], how, limit=1, salts=8)
        assert "BroadcastHashJoin" in small._jdf.queryExecution().toString()
        assert small.columns == large.columns
        assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))


def test_large_masters_give_the_same_cells(masters_of, texts, monkeypatch):
    masters = masters_of([(SITE, "Machine001", "Y")], [tag("Machine001", "T1", "7", "c7")])
    rows = messages.accepted(messages.parse_machine_messages(texts(document('"7": 1.5'))))
    monkeypatch.setattr(lookup.join_lookup, "__defaults__", ("inner", -1, 4))
    pairs = cells.typed_cells(cells.document_tags(rows, masters.tags))
    assert [(r["tag_id"], r["cell"]) for r in pairs.collect()] == [("T1", "1.5")]
    assert cells.wide_rows(rows, masters).first()["c7"] == "1.5"
    assert assets.modelled(rows, masters).count() == 1


def test_only_master_rows_of_hot_machines_are_repeated(spark):
    rows = message_rows(["{}"] * 900)
    frame = spark.createDataFrame(rows, schemas.MESSAGE).withColumn(
        "asset_id", F.expr("IF(`offset` % 3 = 0, 'HOT', concat('M', `offset` % 300))"))
    hot = lookup.hot_keys(frame, ["asset_id"], 30)
    assert [tuple(row) for row in hot.collect()] == [("HOT", 10)]
    master = spark.createDataFrame([("HOT", 1)] + [(f"M{n}", n) for n in range(300)],
                                   "asset_id string, n int")
    copies = lookup.salted_copies(master, hot, ["asset_id"])
    assert copies.count() == 310
    assert sorted(r["_salt"] for r in copies.where("asset_id = 'HOT'").collect()) == list(range(10))
    [measured] = lookup.measure(master)
    for how, n in (("inner", 900), ("left_semi", 900), ("left_anti", 0)):
        joined = lookup.join_lookup(frame, measured, ["asset_id"], how, limit=0, salts=30)
        assert joined.count() == n
    assert lookup.hot_keys(frame.where("false"), ["asset_id"], 30).count() == 0
