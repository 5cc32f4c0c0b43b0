"""Versions of a table that changes a little with every batch.

A version is a base and the changes of up to ``every`` batches since; after that
the next batch writes a new base.  Bases and changes hold distinct rows with the
number of times that they are added (or, below zero, taken away), so tables need
no key and may repeat rows.  A small pointer per batch names its base and changes;
the two newest pointers also stand in two slots, so that finding and reading the
current version takes the same few files however many batches there were.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from kilnstream.operators import assets
from kilnstream.operators.assets import Masters
from kilnstream.sinks.tables import BatchTables

POINTER_SCHEMA = "batch_id bigint, slot int, base bigint, changes array<bigint>, columns array<string>"
CHANGE = "_change"
EVERY = 16


@dataclass(frozen=True)
class VersionedTable:
    """A table below the root of ``tables`` with one version per batch."""

    tables: BatchTables
    table: str
    every: int = EVERY

    def _path(self, kind: str, number: int) -> str:
        return f"{self.tables.path(self.table)}_{kind}/{number}"

    def _pointer(self, spark: SparkSession, kind: str, number: int) -> Row | None:
        try:
            return spark.read.schema(POINTER_SCHEMA).parquet(self._path(kind, number)).first()
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def newest(self, spark: SparkSession, before: int | None = None) -> Row | None:
        """Pointer of the newest version, or of the newest before a batch that runs again."""
        found = [self._pointer(spark, "slots", slot) for slot in (0, 1)]
        found = [p for p in found if p is not None and (before is None or p["batch_id"] < before)]
        return max(found, key=lambda p: p["batch_id"], default=None)

    def recorded(self, spark: SparkSession, batch_id: int) -> Row | None:
        """Pointer of a batch's version."""
        return self._pointer(spark, "pointers", batch_id)

    def files(self, pointer: Row) -> list[str]:
        """Folders that make up a version."""
        return [self._path("bases", pointer["base"]),
                *[self._path("changes", number) for number in pointer["changes"]]]

    def read(self, spark: SparkSession, pointer: Row) -> DataFrame:
        """The rows of a version."""
        rows = self._counted(spark, pointer).where(f"{CHANGE} > 0")
        copies = F.expr(f"explode(sequence(1, CAST({CHANGE} AS int)))")
        return rows.withColumn("_copy", copies).select(*pointer["columns"])

    def _counted(self, spark: SparkSession, pointer: Row) -> DataFrame:
        log = spark.read.parquet(*self.files(pointer))
        return log.groupBy(*pointer["columns"]).agg(F.sum(CHANGE).alias(CHANGE))

    def write(self, rows: DataFrame, batch_id: int) -> None:
        """Make ``rows`` the table's content from this batch on.

        A batch that runs again replaces its own version.
        """
        spark = rows.sparkSession
        before = self.newest(spark, before=batch_id)
        counted = rows.groupBy(*rows.columns).agg(F.count("*").alias(CHANGE))
        if before is None or len(before["changes"]) >= self.every \
                or before["columns"] != rows.columns:
            counted.write.mode("overwrite").parquet(self._path("bases", batch_id))
            base, changes = batch_id, []
        else:
            gone = self._counted(spark, before).withColumn(CHANGE, -F.col(CHANGE))
            changed = counted.unionByName(gone).groupBy(*rows.columns) \
                .agg(F.sum(CHANGE).alias(CHANGE)).where(f"{CHANGE} <> 0")
            changed.coalesce(1).write.mode("overwrite").parquet(self._path("changes", batch_id))
            base, changes = before["base"], [*before["changes"], batch_id]
        slot = 0 if before is None else 1 - before["slot"]
        pointer = spark.createDataFrame([(batch_id, slot, base, changes, rows.columns)],
                                        POINTER_SCHEMA).coalesce(1)
        for kind, number in (("pointers", batch_id), ("slots", slot)):
            pointer.write.mode("overwrite").parquet(self._path(kind, number))


class RecordedMasters:
    """Masters by batch: a batch that runs again gets the masters of its first run.

    ``load_rows(spark)`` returns the rows of assets, tags and codes as they are now.
    """

    NAMES = ("asset_versions", "tag_versions", "code_versions")

    def __init__(self, load_rows, tables: BatchTables, site: str, every: int = EVERY):
        self.load_rows, self.site = load_rows, site
        self.versions = [VersionedTable(tables, name, every) for name in self.NAMES]

    def as_of(self, spark: SparkSession, batch_id: int) -> Masters:
        """The masters of a batch; what is current is recorded on its first run.

        The codes are recorded last, so a batch whose recording broke off records anew.
        """
        if self.versions[-1].recorded(spark, batch_id) is None:
            for version, rows in zip(self.versions, self.load_rows(spark), strict=True):
                version.write(rows, batch_id)
        frames = [version.read(spark, version.recorded(spark, batch_id))
                  for version in self.versions]
        return assets.load_masters(*frames, self.site, keep=True)
