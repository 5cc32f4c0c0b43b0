"""Registered queries that write tables and read them back.

Tables go to a fresh folder below the one the cluster shares.  The relational
queries use the database named by the session setting ``kilnstream.jdbc.url``;
without it they use a database inside the driver process, which other
processes cannot see, so on a cluster of several processes the setting is
needed.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kilnstream import fixed, schemas
from kilnstream.operators import cells, lots
from kilnstream.operators.assets import Masters
from kilnstream.plans import batch, inputs
from kilnstream.plans.message_queries import event_id
from kilnstream.sinks.tables import BatchTables
from kilnstream.sources import derived, documents, jdbc, streams
from kilnstream.sources.shared import shared_folder
from kilnstream.streaming import jobs

# Number of batches the streaming queries run.
BATCHES = 3


# --- documents ---------------------------------------------------------------

def _stored_documents(spark: SparkSession, sf_dir: str, suffix: str = "") -> BatchTables:
    tables = BatchTables(shared_folder(spark), suffix)
    accepted = inputs.accepted(spark, sf_dir)
    tables.write(batch.stored_documents(accepted), batch.DOCUMENTS, 0, ("asset_id",))
    tables.commit(inputs.machine_messages(spark, sf_dir), 0)
    return tables


def document_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _stored_documents(spark, sf_dir)
    return lots.count_by(tables.read(spark, batch.DOCUMENTS), "asset_id")


def document_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _stored_documents(spark, sf_dir)
    return tables.read(spark, batch.DOCUMENTS).select(event_id(), "asset_id")


def document_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _stored_documents(spark, sf_dir)
    return tables.read(spark, batch.DOCUMENTS).agg(F.count("*").alias("n"))


def document_json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents saved as JSON text and read back with an inferred schema."""
    path = shared_folder(spark)
    accepted = inputs.accepted(spark, sf_dir)
    documents.save_documents(accepted.select(F.col("payload").alias("value")), path, "text")
    scanned = documents.read_documents(spark, path)
    return scanned.select(
        F.col("`8`").alias("event_id"), F.col("`5`").alias("lot_no"), F.col("`7`").alias("n7")
    )


def staging_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The machine outputs written to staging targets, counted by target."""
    tables = BatchTables(shared_folder(spark), fixed.STAGING_SUFFIX)
    jobs.write_documents_batch(
        inputs.machine_messages(spark, sf_dir), 0,
        lambda session: inputs.masters(session, sf_dir), tables, with_alarms=True,
    )
    counts = None
    for table in (batch.DOCUMENTS, batch.WIDE, batch.ALARMS):
        target = tables.path(table).rsplit("/", 1)[1]
        n = tables.read(spark, table).agg(F.count("*").alias("n")).select(
            F.lit(target).alias("target"), "n"
        )
        counts = n if counts is None else counts.unionAll(n)
    return counts


def generate_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents made of the events, saved and read back."""
    path = shared_folder(spark)
    made = derived.events(spark, sf_dir).select(
        F.col("event_id").alias("test"), F.struct("user_id", "event_type").alias("by")
    )
    documents.save_documents(made, path)
    schema = "test bigint, by struct<user_id: bigint, event_type: string>"
    return documents.read_documents(spark, path, schema=schema).select(
        "test", "by.user_id", "by.event_type"
    )


# --- relational tables -------------------------------------------------------

def _connection(spark: SparkSession) -> dict[str, str]:
    url = spark.conf.get("kilnstream.jdbc.url", None)
    if url is None:
        return {
            "url": "jdbc:derby:memory:kilnstream;create=true",
            "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver",
        }
    options = {"url": url}
    for name in ("user", "password", "driver"):
        value = spark.conf.get(f"kilnstream.jdbc.{name}", None)
        if value is not None:
            options[name] = value
    return options


def _fresh(name: str) -> str:
    return f"{name}_{uuid.uuid4().hex[:12]}"


TAG_INFO_TYPES = ", ".join(
    f"{name} VARCHAR(255)" for name in ("TAG_ID", "TAG_NM", "DATA_TYPE", "TAG_DESC", "IMPORTANCE",
                                        "ALIAS", "FORMAT")
)

# The rows the relational examples insert.
INSERTED_TAG = ("VTAG_NM00_14", "NM00 TEMP_14", "Double", "스파크에서 INSERT", 28000, "14",
                "TEMP_14", 9, 1400, "Sparktest")
APPENDED_TAG = ("VTAG_NM00_11", "NM00 TEMP_11", "Double", "스파크에서 INSERT", 18000, "8",
                "TEMP_8", 8, 8000, "Spark")
INSERTED_DAY = ("2021", "09", "25") + (None,) * 12

DAY_COLUMNS = [f"c{i:02d}" for i in range(1, 16)]


def _literal(value) -> str:
    if value is None:
        return "NULL"
    return f"'{value}'" if isinstance(value, str) else str(value)


def values_list(row: tuple) -> str:
    return ", ".join(_literal(value) for value in row)


def _tag_table(spark: SparkSession, sf_dir: str) -> tuple[dict[str, str], str]:
    options, table = _connection(spark), _fresh("tb_tag_info")
    rows = derived.tag_info(spark, sf_dir)
    jdbc.append(rows, options, table, createTableColumnTypes=TAG_INFO_TYPES)
    return options, table


def _read_tags(spark: SparkSession, options: dict[str, str], table: str) -> DataFrame:
    quoted = '"CYCLE"' if "derby" in options["url"] else "CYCLE"
    return jdbc.read_table(spark, options, table, quoted, spark.sparkContext.defaultParallelism)


def _one_tag(spark: SparkSession) -> DataFrame:
    columns = ", ".join(schemas.TAG_INFO_COLUMNS)
    row = spark.sql(f"SELECT * FROM VALUES ({values_list(APPENDED_TAG)}) AS t({columns})")
    return row.withColumns({
        "MIN_VALUE": F.col("MIN_VALUE").cast("double"),
        "MAX_VALUE": F.col("MAX_VALUE").cast("double"),
    })


def jdbc_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read_tags(spark, *_tag_table(spark, sf_dir))


def sql_range_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    options, table = _tag_table(spark, sf_dir)
    jdbc.register_view(_read_tags(spark, options, table), table)
    return spark.sql(f"SELECT * FROM {table} WHERE cycle > 8000")


def limit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 50 rows; the report is the feature."""
    options, table = _tag_table(spark, sf_dir)
    return _read_tags(spark, options, table).orderBy("TAG_ID").limit(50)


def sql_insert_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    options, table = _tag_table(spark, sf_dir)
    jdbc.register_view(_read_tags(spark, options, table), table)
    spark.sql(f"INSERT INTO {table} VALUES ({values_list(INSERTED_TAG)})")
    return spark.sql(f"SELECT * FROM {table} WHERE cycle > 8000")


def sql_insert_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row of three values and twelve NULLs added to a table of event days."""
    options, table = _connection(spark), _fresh("testmachine")
    day = F.col("ts")
    parts = [F.date_format(day, form) for form in ("yyyy", "MM", "dd")]
    rest = [F.lit(None).cast("string")] * 12
    rows = derived.events(spark, sf_dir).select(
        [column.alias(name) for name, column in zip(DAY_COLUMNS, parts + rest)]
    )
    jdbc.append(rows, options, table)
    jdbc.register_view(jdbc.read_table(spark, options, table), table)
    spark.sql(f"INSERT INTO {table} VALUES ({values_list(INSERTED_DAY)})")
    return spark.table(table)


def jdbc_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    options, table = _tag_table(spark, sf_dir)
    jdbc.append(_one_tag(spark), options, table)
    return _read_tags(spark, options, table)


def jdbc_truncate_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    options, table = _tag_table(spark, sf_dir)
    jdbc.append(_one_tag(spark), options, table)
    jdbc.overwrite_rows(derived.tag_info(spark, sf_dir), options, table)
    return _read_tags(spark, options, table)


# --- streams -----------------------------------------------------------------

def _message_folder(spark: SparkSession, rows: DataFrame) -> str:
    path = shared_folder(spark)
    rows.select(*schemas.MESSAGE.names).write.parquet(path)
    return path


def stream_source_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _message_folder(spark, inputs.machine_messages(spark, sf_dir))
    out = shared_folder(spark)
    query = (
        streams.file_stream(spark, folder).select(event_id(), "value")
        .writeStream.format("parquet").option("path", f"{out}/rows")
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema("event_id bigint, value string").parquet(f"{out}/rows")


def _files_per_batch(spark: SparkSession) -> int:
    """Files of a spread folder that make up one of ``BATCHES`` micro-batches."""
    return -(-spark.sparkContext.defaultParallelism // BATCHES)


def _run_documents_job(spark: SparkSession, sf_dir: str, start) -> BatchTables:
    folder = _message_folder(spark, inputs.machine_messages(spark, sf_dir))
    tables = BatchTables(shared_folder(spark))
    query = start(
        streams.file_stream(spark, folder, _files_per_batch(spark)),
        lambda session: inputs.masters(session, sf_dir),
        tables, f"{tables.root}/checkpoint", available_now=True,
    )
    query.awaitTermination()
    return tables


def stream_machine_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _run_documents_job(spark, sf_dir, jobs.machine_job)
    return tables.read(spark, batch.ALARMS).select(event_id(), *schemas.ALARM_COLUMNS)


def stream_learning_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _run_documents_job(spark, sf_dir, jobs.learning_job)
    columns = cells.wide_columns(inputs.masters(spark, sf_dir).tags.frame)
    return _wide(cells.wide_view(tables.read(spark, batch.WIDE), columns))


def _wide(rows: DataFrame) -> DataFrame:
    return rows.withColumnRenamed("offset", "event_id").drop("topic", "partition", "batch_id")


def _run_parts(spark: SparkSession, rows: DataFrame, parts: list, tables: BatchTables, run) -> None:
    """Feed the rows that meet each condition to ``run(stream, number)``, one batch each."""
    folder = shared_folder(spark)
    for number, part in enumerate(parts):
        rows.where(part).select(*schemas.MESSAGE.names).write.mode("append").parquet(folder)
        run(streams.file_stream(spark, folder), number).awaitTermination()


def stream_alias_added(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide rows while every batch knows one tag more than the one before."""
    tables = BatchTables(shared_folder(spark))
    known = [row[0] for row in derived.TAG_TEMPLATE]

    def run(stream: DataFrame, number: int):
        return jobs.learning_job(
            stream, lambda s: inputs.masters_with_tags(s, sf_dir, known[:number + 1]),
            tables, f"{tables.root}/checkpoint", available_now=True,
        )

    _run_parts(spark, inputs.machine_messages(spark, sf_dir),
               [F.col("offset") % BATCHES == i for i in range(BATCHES)], tables, run)
    columns = [row[2] for row in derived.TAG_TEMPLATE[:BATCHES]]
    return _wide(cells.wide_view(tables.read(spark, batch.WIDE), columns))


def stream_status_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The asset master when the messages of the first half of each month come last."""
    tables = BatchTables(shared_folder(spark))
    jobs.start_asset_versions(derived.asset_master(spark, sf_dir), tables)

    def run(stream: DataFrame, number: int):
        return jobs.status_job(
            stream, lambda session: inputs.masters(session, sf_dir),
            tables, f"{tables.root}/checkpoint", available_now=True,
        )

    late = F.dayofmonth("timestamp") < 15
    _run_parts(spark, inputs.status_messages(spark, sf_dir), [~late, late], tables, run)
    return jobs.current_assets(spark, tables).drop("stat_order", "stat_chg_dtm")


def stream_status_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _message_folder(spark, inputs.status_messages(spark, sf_dir))
    tables = BatchTables(shared_folder(spark))
    jobs.start_asset_versions(derived.asset_master(spark, sf_dir), tables)
    query = jobs.status_job(
        streams.file_stream(spark, folder, _files_per_batch(spark)),
        lambda session: inputs.masters(session, sf_dir),
        tables, f"{tables.root}/checkpoint", available_now=True,
    )
    query.awaitTermination()
    return jobs.current_assets(spark, tables).drop("stat_order", "stat_chg_dtm")


# Upper info limit of the limited tags in each batch of the refresh query.
INFO_MAX_BY_BATCH = ("150", "60", "20")


def stream_dim_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alarms per batch while the masters' info limits change between batches.

    Every message goes into exactly one of the batches.
    """
    rows = inputs.machine_messages(spark, sf_dir)
    folder, tables = shared_folder(spark), BatchTables(shared_folder(spark))
    limits: list[str] = []

    def load(session: SparkSession) -> Masters:
        return inputs.masters_with_info_max(session, sf_dir, limits[-1])

    for i, info_max in enumerate(INFO_MAX_BY_BATCH):
        part = rows.where(F.col("offset") % BATCHES == i).select(*schemas.MESSAGE.names)
        part.write.mode("append").parquet(folder)
        limits.append(info_max)
        query = jobs.machine_job(
            streams.file_stream(spark, folder), load, tables, f"{tables.root}/checkpoint",
            available_now=True,
        )
        query.awaitTermination()
    counts = lots.count_by(tables.read(spark, batch.ALARMS), "batch_id")
    return counts.select(F.col("batch_id").cast("bigint").alias("batch_id"), "n")


QUERIES = {
    f.__name__: f
    for f in (
        document_routing, document_scan, document_count, document_json_scan, staging_targets,
        generate_documents, jdbc_scan, sql_range_filter, limit_rows, sql_insert_values,
        sql_insert_nulls, jdbc_append, jdbc_truncate_overwrite, stream_source_replay,
        stream_machine_job, stream_learning_job, stream_alias_added, stream_status_job,
        stream_status_late, stream_dim_refresh,
    )
}
