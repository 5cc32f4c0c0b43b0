"""Replay-safe writes to relational tables.

Spark appends a batch to staging tables in parallel; one short transaction on
the driver then moves the staged rows to their targets.  Rows a failed run of
the same batch left behind are removed in that transaction, so wide rows and
alarms of a batch appear together and once.
"""

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kilnstream import fixed
from kilnstream.operators import cells, status
from kilnstream.operators.assets import Masters, alias_tags
from kilnstream.sources import jdbc


def run_in_transaction(
    spark: SparkSession, options: dict[str, str], statements: list[str]
) -> None:
    """Run statements on one connection of the driver and commit them together."""
    java = spark._jvm.java
    if "driver" in options:
        loader = java.lang.Thread.currentThread().getContextClassLoader()
        java.lang.Class.forName(options["driver"], True, loader)
    properties = java.util.Properties()
    for name, value in options.items():
        if name not in ("url", "driver"):
            properties.setProperty(name, value)
    connection = java.sql.DriverManager.getConnection(options["url"], properties)
    try:
        connection.setAutoCommit(False)
        try:
            for text in statements:
                statement = connection.createStatement()
                statement.executeUpdate(text)
                statement.close()
            connection.commit()
        except BaseException:
            connection.rollback()
            raise
    finally:
        connection.close()


def _quoted(names: list[str], quote: str) -> list[str]:
    return [f"{quote}{name}{quote}" for name in names]


def publish_statements(
    table: str, stage: str, columns: list[str], batch_id: int, quote: str = '"'
) -> list[str]:
    """Statements that replace a batch's rows of ``table`` by the staged ones."""
    listed = ", ".join(_quoted(columns, quote))
    mark = _quoted(["batch_id"], quote)[0]
    return [
        f"DELETE FROM {table} WHERE {mark} = {int(batch_id)}",
        f"INSERT INTO {table} ({listed}) SELECT {listed} FROM {stage}",
    ]


def write_batch(
    spark: SparkSession,
    options: dict[str, str],
    frames: dict[str, DataFrame],
    batch_id: int,
    quote: str = '"',
) -> None:
    """Append frames (by target table, each with ``batch_id``) as one transaction.

    Every target and its ``<table>_stage`` twin must exist.
    """
    statements = []
    for table, rows in frames.items():
        stage = f"{table}_stage"
        jdbc.overwrite_rows(rows, options, stage)
        statements += publish_statements(table, stage, rows.columns, batch_id, quote)
    run_in_transaction(spark, options, statements)


def asset_columns(masters: Masters, asset_ids: list[str]) -> dict[str, list[str]]:
    """Aliases of the named assets, each in the order of its tags, read in one pass."""
    rows = (
        alias_tags(masters.tags.frame).where(F.col("asset_id").isin(asset_ids))
        .groupBy("asset_id")
        .agg(F.sort_array(F.collect_list(F.struct("tag_id", "alias"))).alias("tags")).collect()
    )
    return {row["asset_id"]: [tag["alias"] for tag in row["tags"]] for row in rows}


def asset_frames(
    wide: DataFrame, masters: Masters, asset_ids: list[str], batch_id: int, suffix: str = ""
) -> dict[str, DataFrame]:
    """Wide rows for stores that keep one table per asset, by table name.

    ``wide`` are ``wide_cells``, computed once and cached by the caller.  Each table
    has just its asset's aliases.  Writing costs a job per asset, so this is for the
    assets whose tables somebody needs; the file tables hold all assets.
    """
    return {
        f"{asset_id}{suffix}": cells.wide_view(
            wide.where(F.col("asset_id") == asset_id).drop("asset_id"), columns
        ).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        for asset_id, columns in asset_columns(masters, asset_ids).items()
    }


@dataclass(frozen=True)
class RelationalTargets:
    """Relational tables that a job writes besides its files.

    ``tables`` names the target of an output (say, the alarms); ``asset_ids`` are the
    assets with a wide table of their own, named by the id and ``suffix``;
    ``asset_master`` is the table that the status job updates.
    """

    options: dict[str, str]
    tables: dict[str, str] = field(default_factory=dict)
    asset_ids: tuple[str, ...] = ()
    asset_master: str | None = None
    suffix: str = ""
    quote: str = '"'

    def write(
        self, frames: dict[str, DataFrame], wide: DataFrame, masters: Masters, batch_id: int
    ) -> None:
        """One transaction with all relational outputs of a batch."""
        spark = wide.sparkSession
        mark = F.lit(batch_id).cast("bigint")
        chosen = {f"{target}{self.suffix}": frames[output].withColumn("batch_id", mark)
                  for output, target in self.tables.items() if output in frames}
        wide = wide.persist()
        try:
            chosen |= asset_frames(wide, masters, list(self.asset_ids), batch_id, self.suffix)
            if chosen:
                write_batch(spark, self.options, chosen, batch_id, self.quote)
        finally:
            wide.unpersist()

    def update(self, latest: DataFrame, site: str, changed_at) -> None:
        """Write the batch's statuses into the asset master, in place."""
        if self.asset_master is not None:
            staged = latest.withColumn("site_id", F.lit(site)).withColumn(
                "stat_chg_dtm", changed_at)
            update_status(latest.sparkSession, self.options, staged, self.asset_master, self.quote)


def order_text() -> Column:
    """Arrival order of a status as text that sorts the same way.

    The time is UTC whatever the session's zone: local time runs twice where clocks change.
    """
    order = F.col(status.ORDER_COLUMN)
    micros = F.unix_micros(order["timestamp"])
    day_micros = 86_400_000_000
    day = F.date_from_unix_date(F.floor(micros / day_micros).cast("int")).cast("string")
    rest = F.pmod(micros, F.lit(day_micros))
    second = F.floor(rest / 1_000_000)
    clock = F.floor(second / 3600) * 10_000 + F.floor(second / 60) % 60 * 100 + second % 60
    return F.concat(
        F.replace(day, F.lit("-"), F.lit("")),
        F.lpad(clock.cast("string"), 6, "0"),
        F.lpad((rest % 1_000_000).cast("string"), 6, "0"),
        F.lpad(order["partition"].cast("string"), 10, "0"),
        F.lpad(order["offset"].cast("string"), 20, "0"),
    )


def status_statement(
    table: str, stage: str, quote: str = '"', changed_at: str = "stat_chg_dtm"
) -> str:
    """One UPDATE of the asset master from staged statuses; it never inserts.

    A row that already has a status of a later message keeps it.
    """
    site, asset, order = _quoted(["site_id", "asset_id", status.ORDER_COLUMN], quote)
    match = f"s.{site} = {table}.{site} AND s.{asset} = {table}.{asset}"
    newer = f"({table}.{order} IS NULL OR s.{order} > {table}.{order})"
    settings = ", ".join(
        f"{name} = (SELECT s.{name} FROM {stage} s WHERE {match})"
        for name in _quoted(
            [*fixed.STATUS_COLUMNS.values(), changed_at, status.ORDER_COLUMN], quote
        )
    )
    return (
        f"UPDATE {table} SET {settings} "
        f"WHERE EXISTS (SELECT 1 FROM {stage} s WHERE {match} AND {newer})"
    )


def update_status(
    spark: SparkSession,
    options: dict[str, str],
    latest: DataFrame,
    table: str,
    quote: str = '"',
) -> None:
    """Update the asset master in place from ``latest``.

    It has site, asset, three codes, time and the arrival order of the message,
    which the master keeps as text.
    """
    stage = f"{table}_stage"
    columns = ["site_id", "asset_id", *fixed.STATUS_COLUMNS.values(), "stat_chg_dtm"]
    staged = latest.select(*columns, order_text().alias(status.ORDER_COLUMN))
    jdbc.overwrite_rows(staged, options, stage)
    run_in_transaction(spark, options, [status_statement(table, stage, quote)])
