"""Latest status of every machine and the update of the asset master."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kilnstream import fixed, schemas
from kilnstream.functions import variants

# Issues found in status messages.
STATUS_MISSING = "status value missing"

# Arrival order of the message that set a master row's status.
ORDER_COLUMN = "stat_order"


def arrival_order() -> Column:
    return F.struct(*schemas.ARRIVAL)


def empty_order() -> Column:
    return F.lit(None).cast("struct<timestamp:timestamp,partition:int,offset:bigint>")


def latest_status(messages: DataFrame) -> DataFrame:
    """Status of the last message of every machine, in arrival order.

    The whole message wins: a value it lacks is NULL, never an older one.
    """
    message = F.struct(
        *[F.expr(variants.string_member("members", key)).alias(name)
          for key, name in fixed.STATUS_COLUMNS.items()],
        arrival_order().alias(ORDER_COLUMN),
    )
    return (
        messages.select("asset_id", message.alias("m"))
        .groupBy("asset_id")
        .agg(F.max_by("m", f"m.{ORDER_COLUMN}").alias("m"))
        .select("asset_id", "m.*")
    )


def apply_status(
    assets: DataFrame, latest: DataFrame, site: str, processing_ts: Column
) -> DataFrame:
    """The asset master with newer statuses written in; no row is added.

    ``latest`` holds modelled assets of ``site``, each once.  A status older
    than the one a row already has is ignored.
    """
    if ORDER_COLUMN not in assets.columns:
        assets = assets.withColumn(ORDER_COLUMN, empty_order())
    update = latest.select(
        F.lit(site).alias("site_id"), "asset_id",
        F.struct(*[c for c in latest.columns if c != "asset_id"]).alias("new"),
    )
    joined = assets.join(update, ["site_id", "asset_id"], "left")
    newer = F.col("new").isNotNull() & (
        F.col(ORDER_COLUMN).isNull() | (F.col(f"new.{ORDER_COLUMN}") > F.col(ORDER_COLUMN))
    )
    changed = {
        name: F.col(f"new.{name}") for name in [*fixed.STATUS_COLUMNS.values(), ORDER_COLUMN]
    }
    changed["stat_chg_dtm"] = processing_ts
    return joined.select([
        F.when(newer, changed[name]).otherwise(F.col(name)).alias(name)
        if name in changed else F.col(name)
        for name in assets.columns
    ])


def status_issues(latest: DataFrame) -> DataFrame:
    """Machines whose last message lacks one of the three values."""
    missing = F.array_compact(F.array(*[
        F.when(F.col(name).isNull(), F.lit(name)) for name in fixed.STATUS_COLUMNS.values()
    ]))
    return latest.select(
        "asset_id", F.explode(missing).alias("column_nm"), F.lit(STATUS_MISSING).alias("issue")
    )
