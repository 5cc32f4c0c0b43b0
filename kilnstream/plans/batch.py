"""The three jobs as plans over one batch of messages.

Streaming and backfill run these same functions; they only declare frames.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kilnstream import schemas
from kilnstream.operators import alarms, assets, cells, messages, status
from kilnstream.operators.assets import Masters

DOCUMENTS = "documents"
WIDE = "wide_rows"
CELLS = "cells"
ALARMS = "alarm_history"
QUARANTINE = "quarantine"
ISSUES = "issues"
MASTER_ISSUES = "master_issues"
CHARTS = "chart_series"
LOT_LINES = "lot_lines"

# Folder columns of each output table.
PARTITIONS = {
    DOCUMENTS: ("asset_id",), WIDE: ("asset_id",), CELLS: ("asset_id",),
    ALARMS: ("asset_id",),
}


def stored_documents(accepted: DataFrame) -> DataFrame:
    """What the document store keeps, of every asset, modelled or not."""
    return accepted.select(
        *schemas.MESSAGE_KEY, "timestamp", "asset_id", "lot_no", "doc", "crt_dtm", "oper_stat"
    )


def learning_plan(
    parsed: DataFrame, masters: Masters, widen_ints: bool = False, typed: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Documents, cells and wide rows (as maps) of parsed machine messages.

    ``typed`` are their typed messages, if these are at hand.
    """
    accepted = messages.accepted(parsed)
    if typed is None:
        typed = cells.typed_messages(accepted, masters, widen_ints)
    return {
        DOCUMENTS: stored_documents(accepted),
        WIDE: cells.wide_of(typed),
        CELLS: cells.cells_of(typed),
        QUARANTINE: messages.quarantined(parsed),
        ISSUES: cells.issues_of(typed),
        MASTER_ISSUES: assets.master_issues(masters),
    }


def machine_alarms(
    accepted: DataFrame, masters: Masters, widen_ints: bool = False
) -> DataFrame:
    """Alarm records of accepted machine messages."""
    pairs = cells.document_tags(accepted, alarms.limited_tags(masters.tags))
    return alarms.alarm_history(alarms.alarm_levels(pairs, widen_ints))


def machine_plan(
    parsed: DataFrame, masters: Masters, widen_ints: bool = False, typed: DataFrame | None = None
) -> dict[str, DataFrame]:
    """The learning outputs and the alarms."""
    if typed is None:
        typed = cells.typed_messages(messages.accepted(parsed), masters, widen_ints)
    frames = learning_plan(parsed, masters, widen_ints, typed)
    history = cells.alarms_of(typed)
    frames[ALARMS] = history
    frames[ISSUES] = frames[ISSUES].unionByName(alarms.alarm_issues(history))
    return frames


def status_plan(
    parsed: DataFrame, masters: Masters, asset_rows: DataFrame, processing_ts: Column
) -> tuple[DataFrame, DataFrame]:
    """The updated asset master, and the statuses written into it."""
    modelled = assets.modelled(messages.accepted(parsed), masters)
    latest = status.latest_status(modelled)
    return status.apply_status(asset_rows, latest, masters.site, processing_ts), latest


def batch_clock() -> Column:
    """One processing time for a whole batch."""
    return F.current_timestamp()
