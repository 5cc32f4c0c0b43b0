"""Relational reads and writes against a database inside this process."""

import uuid

import pytest
from conftest import (
    ASSET_COLUMNS, SITE, asset_frame, code_frame, document, message_rows, tag, tag_frame,
)
from pyspark.sql import functions as F
from test_status import status_text

from kilnstream import schemas
from kilnstream.operators import assets, cells, messages
from kilnstream.plans import batch
from kilnstream.sinks import relational
from kilnstream.sinks.tables import BatchTables
from kilnstream.sources import jdbc
from kilnstream.streaming import jobs

OPTIONS = {
    "url": "jdbc:derby:memory:tests;create=true",
    "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver",
}
STATUS = ["asset_stat_cd", "seq_proc_stat_cd", "grow_proc_stat_cd"]


@pytest.fixture
def table():
    return f"t_{uuid.uuid4().hex[:12]}"


def varchars(*names):
    return ", ".join(f"{name} VARCHAR(64)" for name in names)


def test_site_scan_is_pushed_to_the_store(spark, table):
    tags = tag_frame(spark, [tag("A", "T1", "7", "x", limits=["1"]),
                             tag("B", "T2", "7", "y", site="S2", limits=["1"])])
    full = tags.fillna("0")
    jdbc.append(full, OPTIONS, table, createTableColumnTypes=varchars(*full.columns))
    scan = jdbc.read_site_rows(spark, OPTIONS, table, SITE, schemas.TAG_SCAN_COLUMNS)
    assert [r["tag_id"] for r in scan.collect()] == ["T1"]
    plan = scan._jdf.queryExecution().toString()
    assert "EqualTo(site_id,S1)" in plan and "alarm_info_min_val" not in plan.split("Physical")[1]


def test_partitioned_scan_reads_every_row(spark, table):
    rows = spark.range(100).select(F.col("id").alias("ID"))
    jdbc.append(rows, OPTIONS, table)
    scan = jdbc.read_table(spark, OPTIONS, table, '"ID"', 4)
    assert scan.rdd.getNumPartitions() == 4
    assert scan.agg(F.sum("ID")).first()[0] == 4950


def test_append_and_overwrite(spark, table):
    rows = spark.range(3)
    jdbc.append(rows, OPTIONS, table)
    jdbc.append(rows, OPTIONS, table)
    assert jdbc.read_table(spark, OPTIONS, table).count() == 6
    jdbc.overwrite_rows(rows, OPTIONS, table)
    assert jdbc.read_table(spark, OPTIONS, table).count() == 3


def test_batch_publication_is_atomic_and_replay_safe(spark, table):
    alarms, wide = f"{table}_a", f"{table}_w"
    for name in (alarms, wide):
        empty = spark.range(0).selectExpr("id", "0L AS batch_id")
        jdbc.append(empty, OPTIONS, name)
        jdbc.append(empty, OPTIONS, f"{name}_stage")

    def frames(n, batch_id):
        rows = spark.range(n).selectExpr("id", f"{batch_id}L AS batch_id")
        return {alarms: rows, wide: rows}

    def counts():
        return [jdbc.read_table(spark, OPTIONS, name).count() for name in (alarms, wide)]

    relational.write_batch(spark, OPTIONS, frames(3, 0), 0)
    relational.write_batch(spark, OPTIONS, frames(2, 1), 1)
    relational.write_batch(spark, OPTIONS, frames(2, 1), 1)
    assert counts() == [5, 5]
    statements = relational.publish_statements(alarms, f"{alarms}_stage", ["id", "batch_id"], 1)
    with pytest.raises(Exception, match="(?i)missing_table"):
        relational.run_in_transaction(
            spark, OPTIONS, [*statements, statements[1], "DELETE FROM missing_table"]
        )
    assert counts() == [5, 5]


def test_one_table_per_asset(spark, masters_of, texts):
    masters = masters_of([(SITE, "Machine001", "Y"), (SITE, "Machine002", "Y"),
                          (SITE, "Machine003", "Y")],
                         [tag("Machine001", "T1", "7", "c7"), tag("Machine002", "T2", "8", "c8")])
    rows = messages.accepted(messages.parse_machine_messages(texts(
        document('"7": 1.5, "8": 2.5'), document('"7": 3.5, "8": 4.5', lot="LOT__002_1"))))
    suffix = f"_{uuid.uuid4().hex[:12]}"
    ids = ["Machine001", "Machine002", "Machine003"]
    frames = relational.asset_frames(cells.wide_cells(rows, masters), masters, ids, 4, suffix)
    assert sorted(frames) == [f"Machine001{suffix}", f"Machine002{suffix}"]
    for name, frame in frames.items():
        for made in (name, f"{name}_stage"):
            jdbc.append(frame.limit(0), OPTIONS, made)
    relational.write_batch(spark, OPTIONS, frames, 4)
    found = jdbc.read_table(spark, OPTIONS, f"Machine002{suffix}").select("offset", "c8").collect()
    assert [tuple(r) for r in found] == [(1, "4.5")]


def stored_masters(spark, name):
    """Load masters of the store; one asset with one limited tag."""
    made = {
        "asset": asset_frame(spark, [(SITE, "Machine001", "Y")]).select(
            *schemas.ASSET_SCAN_COLUMNS),
        "tag": tag_frame(spark, [tag("Machine001", "T1", "7", "c7", limits=["0", "10"])])
        .fillna("x"),
        "code": code_frame(spark),
    }
    for kind, rows in made.items():
        jdbc.append(rows, OPTIONS, f"{name}_{kind}", createTableColumnTypes=varchars(*rows.columns))
    return lambda session: assets.load_masters(
        *jdbc.read_masters(session, OPTIONS, SITE, *(f"{name}_{kind}" for kind in made)), SITE)


def test_machine_job_writes_alarms_and_a_table_of_the_asset(spark, table, tmp_path, messages_of):
    load = stored_masters(spark, table)
    targets = relational.RelationalTargets(
        OPTIONS, {batch.ALARMS: "alarms"}, ("Machine001",), suffix=f"_{table}")
    rows = messages_of([document('"7": 15.0'), document('"7": 5.0', lot="LOT__009_1")])
    masters = load(spark)
    plan = batch.machine_plan(messages.parse_machine_messages(rows), masters)
    frames = {f"alarms_{table}": plan[batch.ALARMS].withColumn("batch_id", F.lit(0).cast("bigint"))}
    frames |= relational.asset_frames(
        plan[batch.WIDE], masters, ["Machine001"], 0, f"_{table}")
    for name, frame in frames.items():
        for made in (name, f"{name}_stage"):
            jdbc.append(frame.limit(0), OPTIONS, made)
    for _ in range(2):
        jobs.write_documents_batch(
            rows, 0, load, BatchTables(str(tmp_path)), with_alarms=True, relational=targets)
        found = jdbc.read_table(spark, OPTIONS, f"alarms_{table}").collect()
        assert [(r["asset_id"], r["alarm_val"], r["batch_id"]) for r in found] == [
            ("Machine001", 15.0, 0)]
        wide = jdbc.read_table(spark, OPTIONS, f"Machine001_{table}").collect()
        assert [(r["offset"], r["c7"]) for r in wide] == [(0, "15.0")]


def test_status_job_updates_the_store_but_not_with_older_messages(
    spark, table, tmp_path, messages_of
):
    load = stored_masters(spark, table)
    master = asset_frame(spark, [(SITE, "Machine001", "Y")])
    tables = BatchTables(str(tmp_path))
    jobs.start_asset_versions(master, tables)
    stored = master.withColumn("stat_order", F.lit("")).fillna("")
    names = ["site_id", "asset_id", "model_confirm_yn", *STATUS, "stat_order"]
    jdbc.append(stored, OPTIONS, table, createTableColumnTypes=varchars(*names))
    jdbc.append(stored.drop("model_confirm_yn").limit(0), OPTIONS, f"{table}_stage",
                createTableColumnTypes=varchars(*[n for n in names if n != "model_confirm_yn"]))
    targets = relational.RelationalTargets(OPTIONS, asset_master=table)
    for number, (text, minute, expected) in enumerate(
        [("one", 5, "one"), ("older", 1, "one"), ("two", 9, "two")]
    ):
        rows = messages_of(message_rows(
            [status_text("Machine001", f'"{text}"', '"S"', '"G"')], first=number, minute=minute))
        jobs.write_status_batch(rows, number, load, tables, relational=targets)
        assert jdbc.read_table(spark, OPTIONS, table).first()["asset_stat_cd"] == expected


def test_status_update_in_place(spark, table):
    master = spark.createDataFrame(
        [(SITE, "A", "Y"), (SITE, "B", "Y"), ("S2", "A", "Y")], ASSET_COLUMNS
    ).select("*", *[F.lit("old").alias(c) for c in STATUS], F.current_timestamp().alias(
        "stat_chg_dtm"), F.lit(None).cast("string").alias("stat_order"))
    names = ["site_id", "asset_id", "model_confirm_yn", *STATUS, "stat_order"]
    jdbc.append(master.fillna(""), OPTIONS, table, createTableColumnTypes=varchars(*names))
    latest = spark.createDataFrame(
        [(SITE, "A", "run", "S1", "G1"), (SITE, "Z", "run", "S1", "G1")],
        ["site_id", "asset_id", *STATUS],
    ).withColumn("stat_chg_dtm", F.current_timestamp()).withColumn(
        "stat_order", F.expr("named_struct('timestamp', now(), 'partition', 0, 'offset', 5L)"))
    jdbc.append(latest.withColumn("stat_order", F.lit("")).limit(0), OPTIONS, f"{table}_stage",
                createTableColumnTypes=varchars("site_id", "asset_id", *STATUS, "stat_order"))
    relational.update_status(spark, OPTIONS, latest, table)
    found = {(r["site_id"], r["asset_id"]): r["asset_stat_cd"]
             for r in jdbc.read_table(spark, OPTIONS, table).collect()}
    assert found == {(SITE, "A"): "run", (SITE, "B"): "old", ("S2", "A"): "old"}
