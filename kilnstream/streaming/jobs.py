"""The three streaming jobs.

Each micro-batch reads the masters once, parses its messages and types their values
once, and writes its outputs under its batch id.  A job that dies runs its last batch again with
the same id and replaces what it wrote, so every output holds each message once.
"""

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kilnstream.operators import cells, lots, messages, status
from kilnstream.operators.assets import Masters
from kilnstream.plans import batch as plans
from kilnstream.sinks.relational import RelationalTargets
from kilnstream.sinks.tables import BatchTables
from kilnstream.sinks.versions import EVERY, RecordedMasters, VersionedTable
from kilnstream.sources.spread import bounded_batch

MASTER = "asset_master"
LATEST = "latest_status"
INITIAL_VERSION = -1

LoadMasters = Callable[[SparkSession], Masters] | RecordedMasters
BatchHook = Callable[[DataFrame, int], None]


def _now():
    return F.lit(datetime.now(timezone.utc))


def _start(
    stream: DataFrame,
    on_batch: BatchHook,
    checkpoint: str,
    available_now: bool = False,
    name: str | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Start a job; ``every`` is the time between batches, without it they follow at once."""
    writer = (
        stream.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(on_batch)
    )
    if name is not None:
        writer = writer.queryName(name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif every is not None:
        writer = writer.trigger(processingTime=every)
    return writer.start()


def _masters(load_masters: LoadMasters, spark: SparkSession, batch_id: int) -> Masters:
    """The masters as they are now, or as they were when a recorded batch first ran."""
    if isinstance(load_masters, RecordedMasters):
        return load_masters.as_of(spark, batch_id)
    return load_masters(spark)


def _write_all(tables: BatchTables, frames: dict[str, DataFrame], batch_id: int) -> None:
    """Write the outputs of a batch side by side; small ones do not wait for large ones."""
    with ThreadPoolExecutor(len(frames)) as pool:
        writes = [
            pool.submit(tables.write, frame, table, batch_id, plans.PARTITIONS.get(table, ()))
            for table, frame in frames.items()
        ]
    for write in writes:
        write.result()


def write_documents_batch(
    rows: DataFrame,
    batch_id: int,
    load_masters: LoadMasters,
    tables: BatchTables,
    with_alarms: bool,
    mode: str = messages.QUARANTINE,
    widen_ints: bool = False,
    after: BatchHook | None = None,
    relational: RelationalTargets | None = None,
    charts: bool = False,
    command: list[str] | None = None,
) -> None:
    """One batch of the machine or the learning job, streamed or backfilled.

    ``charts`` adds the batch's share of the chart series, which ``read_charts`` puts
    together; ``command`` runs on the batch's messages of every lot and its lines and
    errors are stored too.
    """
    batch, level = bounded_batch(rows)
    parsed = messages.parse_machine_messages(batch, _now(), mode).persist(level)
    if parsed.isEmpty():
        parsed.unpersist()
        return
    masters = _masters(load_masters, rows.sparkSession, batch_id)
    accepted = messages.accepted(parsed)
    typed = cells.typed_messages(accepted, masters, widen_ints).persist(level)
    try:
        plan = plans.machine_plan if with_alarms else plans.learning_plan
        frames = plan(parsed, masters, widen_ints, typed)
        if charts:
            frames[plans.CHARTS] = lots.chart_partials(accepted, masters, widen_ints)
        if command is not None:
            frames[plans.LOT_LINES] = lots.run_on_lots(accepted, command, kept=True)
        typed.count()  # once, before several outputs ask for the same partitions side by side
        _write_all(tables, frames, batch_id)
        if relational is not None:
            relational.write(frames, frames[plans.WIDE], masters, batch_id)
        if after is not None:
            after(accepted, batch_id)
        tables.commit(parsed, batch_id)
    finally:
        typed.unpersist()
        parsed.unpersist()
        masters.release()


def machine_job(
    stream: DataFrame,
    load_masters: LoadMasters,
    tables: BatchTables,
    checkpoint: str,
    available_now: bool = False,
    name: str | None = None,
    every: str | None = None,
    **options,
) -> StreamingQuery:
    """Documents, cells, wide rows and alarms of machine messages.

    ``after`` gets the accepted messages of every batch; ``charts`` and ``command`` store
    chart data and the output of per-lot work.
    """
    def on_batch(rows: DataFrame, batch_id: int) -> None:
        write_documents_batch(rows, batch_id, load_masters, tables, True, **options)

    return _start(stream, on_batch, checkpoint, available_now, name, every)


def learning_job(
    stream: DataFrame,
    load_masters: LoadMasters,
    tables: BatchTables,
    checkpoint: str,
    available_now: bool = False,
    name: str | None = None,
    every: str | None = None,
    **options,
) -> StreamingQuery:
    """Documents, cells and wide rows of learning messages."""
    def on_batch(rows: DataFrame, batch_id: int) -> None:
        write_documents_batch(rows, batch_id, load_masters, tables, False, **options)

    return _start(stream, on_batch, checkpoint, available_now, name, every)


def start_asset_versions(assets: DataFrame, tables: BatchTables) -> None:
    """Write the version of the asset master that the status job starts from."""
    spark = assets.sparkSession
    first = assets.withColumn(status.ORDER_COLUMN, status.empty_order())
    VersionedTable(tables, MASTER).write(first, INITIAL_VERSION)
    no_message = spark.range(1).select(
        F.lit(None).cast("string").alias("topic"),
        F.lit(None).cast("int").alias("partition"),
        F.lit(None).cast("bigint").alias("offset"),
    )
    tables.commit(no_message, INITIAL_VERSION)


def current_assets(
    spark: SparkSession, tables: BatchTables, before: int | None = None
) -> DataFrame:
    """The newest version of the asset master, optionally before a batch."""
    versions = VersionedTable(tables, MASTER)
    version = versions.newest(spark, before)
    if version is None:
        raise ValueError("no version of the asset master; call start_asset_versions first")
    return versions.read(spark, version)


def read_charts(spark: SparkSession, tables: BatchTables) -> DataFrame:
    """The chart series of all committed batches."""
    return lots.combined_charts(tables.read(spark, plans.CHARTS))


def write_status_batch(
    rows: DataFrame,
    batch_id: int,
    load_masters: LoadMasters,
    tables: BatchTables,
    mode: str = messages.QUARANTINE,
    relational: RelationalTargets | None = None,
    every: int = EVERY,
) -> None:
    """One batch of the status job: the next version of the asset master.

    Only rows that change are written; every ``every`` versions a whole one is.
    """
    spark = rows.sparkSession
    batch, level = bounded_batch(rows)
    parsed = messages.parse_status_messages(batch, mode).persist(level)
    if parsed.isEmpty():
        parsed.unpersist()
        return
    masters = _masters(load_masters, spark, batch_id)
    try:
        before = current_assets(spark, tables, before=batch_id)
        now = _now()
        updated, latest = plans.status_plan(parsed, masters, before, now)
        frames = {
            plans.QUARANTINE: messages.quarantined(parsed),
            plans.ISSUES: status.status_issues(latest),
        }
        _write_all(tables, frames, batch_id)
        if relational is not None:
            relational.update(latest, masters.site, now)
        VersionedTable(tables, MASTER, every).write(updated, batch_id)
        tables.commit(parsed, batch_id)
    finally:
        parsed.unpersist()
        masters.release()


def status_job(
    stream: DataFrame,
    load_masters: LoadMasters,
    tables: BatchTables,
    checkpoint: str,
    available_now: bool = False,
    name: str | None = None,
    every: str | None = None,
    **options,
) -> StreamingQuery:
    """In-place update of the asset master from status messages."""
    def on_batch(rows: DataFrame, batch_id: int) -> None:
        write_status_batch(rows, batch_id, load_masters, tables, **options)

    return _start(stream, on_batch, checkpoint, available_now, name, every)
