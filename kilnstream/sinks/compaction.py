"""Committed batches of a table rewritten to fewer files, under a manifest that is swapped whole.

The rewritten rows go to a folder of their own, and then the manifest names it; a
reader looks the manifest up once, so it sees the batches' own files or the rewritten
ones, never both.  The newest committed batch stays out, because a restarted job may
write it again.  Folders that the manifest no longer needs are left to the operator of
the store: readers that started earlier still use them.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kilnstream.sinks.tables import BatchTables
from kilnstream.sinks.versions import VersionedTable

ROWS_PER_FILE = 1_000_000


def _manifest(tables: BatchTables, table: str) -> VersionedTable:
    return VersionedTable(tables, f"{table}_manifest", every=0)


def compact(
    spark: SparkSession,
    tables: BatchTables,
    table: str,
    partition_by: tuple[str, ...] = (),
    rows_per_file: int = ROWS_PER_FILE,
) -> int | None:
    """Rewrite all committed batches but the newest; the last one that was, if any."""
    newest = tables.last_batch(spark)
    upto = None if newest is None else tables.last_batch(spark, before=newest)
    if upto is None:
        return None
    rows = read_table(spark, tables, table).where(F.col("batch_id") <= upto)
    folder = f"{tables.path(table)}_compact/{upto}"
    (
        rows.hint("rebalance", *partition_by).write.mode("overwrite")
        .option("maxRecordsPerFile", rows_per_file).partitionBy(*partition_by).parquet(folder)
    )
    named = spark.createDataFrame([(upto, folder)], "upto bigint, folder string")
    _manifest(tables, table).write(named, upto)
    return upto


def read_table(spark: SparkSession, tables: BatchTables, table: str) -> DataFrame:
    """All committed rows of a table, with ``batch_id``, from as few files as there are."""
    manifest = _manifest(tables, table)
    pointer = manifest.newest(spark)
    if pointer is None:
        return tables.read(spark, table)
    upto, folder = manifest.read(spark, pointer).first()
    merging = spark.read.option("mergeSchema", True)
    rows = merging.parquet(folder)
    newer = tables.commits(spark).where(F.col("batch_id") > upto) \
        .select("batch_id").distinct().collect()
    if not newer:
        return rows
    paths = [f"{tables.path(table)}/batch_id={row['batch_id']}" for row in newer]
    later = merging.option("basePath", tables.path(table)).parquet(*paths)
    return rows.unionByName(later, allowMissingColumns=True)
