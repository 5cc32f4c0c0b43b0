"""Replay-safe file tables, one folder per batch.

A batch writes ``<root>/<table>/batch_id=<n>/`` in overwrite mode, so running it
again replaces its own rows and nothing else.  When all its tables are written
it records the offsets it covered under ``commits``; readers see committed
batches only.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from kilnstream.sinks import ledger

COMMITS = "commits"
COMMIT_SCHEMA = (
    "topic string, partition int, min_offset bigint, max_offset bigint, n bigint, "
    "batch_id bigint"
)


@dataclass(frozen=True)
class BatchTables:
    """The output tables of one job below ``root``; ``suffix`` makes staging targets."""

    root: str
    suffix: str = ""

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}{self.suffix}"

    def write(
        self, rows: DataFrame, table: str, batch_id: int, partition_by: tuple[str, ...] = ()
    ) -> None:
        """Write one batch of a table.

        Rows are first brought together by their folder; adaptive execution
        splits a folder with many rows over several tasks and files.
        """
        target = f"{self.path(table)}/batch_id={batch_id}"
        if partition_by:
            rows = rows.hint("rebalance", *partition_by)
        rows.write.mode("overwrite").partitionBy(*partition_by).parquet(target)

    def commit(self, messages: DataFrame, batch_id: int) -> None:
        """Record the offsets of a written batch, by runs of consecutive ones.

        A source partition of which no message has an offset has a row without them.
        Offsets that do not follow each other make as many rows as messages, so the record
        has as many files as its size asks for, one for most batches.
        """
        covered = ledger.covered(messages).withColumn(
            "n", F.expr("max_offset - min_offset + 1"))
        none = F.lit(None).cast("bigint")
        without = messages.groupBy(*ledger.SOURCE).agg(F.count("offset").alias("n")) \
            .where("n = 0").select(*ledger.SOURCE, none.alias("min_offset"),
                                   none.alias("max_offset"), "n")
        self.write(covered.unionByName(without).hint("rebalance"), COMMITS, batch_id)

    def commits(self, spark: SparkSession) -> DataFrame | None:
        """Committed offsets by batch, or None before the first commit."""
        try:
            return spark.read.schema(COMMIT_SCHEMA).parquet(self.path(COMMITS))
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def last_batch(self, spark: SparkSession, before: int | None = None) -> int | None:
        commits = self.commits(spark)
        if commits is None:
            return None
        if before is not None:
            commits = commits.where(F.col("batch_id") < before)
        return commits.select(F.max("batch_id")).first()[0]

    def read(
        self,
        spark: SparkSession,
        table: str,
        schema: str | None = None,
    ) -> DataFrame:
        """All committed rows of a table, with ``batch_id``.

        Columns that only some batches have are NULL in the others.
        """
        last = self.last_batch(spark)
        reader = spark.read.option("mergeSchema", schema is None)
        if schema is not None:
            reader = reader.schema(f"{schema}, batch_id bigint")
        rows = reader.parquet(self.path(table))
        return rows.where(F.col("batch_id") <= F.lit(last))

    def read_batch(self, spark: SparkSession, table: str, batch_id: int) -> DataFrame:
        return spark.read.parquet(f"{self.path(table)}/batch_id={batch_id}")


def drop_replayed(messages: DataFrame, tables: BatchTables) -> DataFrame:
    """Messages that no committed batch holds, whatever the order they came in."""
    commits = tables.commits(messages.sparkSession)
    return messages if commits is None else ledger.outside(messages, commits)
