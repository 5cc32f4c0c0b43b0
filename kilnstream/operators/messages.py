"""From message bytes to parsed, enriched documents.

The result of ``parse_machine_messages`` keeps bad messages in the same frame,
marked by ``reject_reason``: one pass over the stream feeds both the good and
the quarantine branch.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kilnstream import fixed, schemas
from kilnstream.functions import text, variants
from kilnstream.functions.text import quoted
from kilnstream.operators.once import once

# Reasons for quarantine.
NOT_JSON = "not a JSON document"
NO_LOT = "lot number missing or not a string"
NO_MACHINE = "machine id missing or not a string"

QUARANTINE = "quarantine"
FAILFAST = "failfast"


def message_text(rows: DataFrame) -> DataFrame:
    """Message bytes as text, position columns kept."""
    return rows.withColumn("value", F.col("value").cast("string"))


def repair_lot(rows: DataFrame) -> DataFrame:
    return rows.withColumn("value", F.expr(text.repair_lot_blanks("value")))


def _reject_reason(key: str, key_reason: str, mode: str) -> str:
    reason = (f"CASE WHEN doc IS NULL THEN {quoted(NOT_JSON)} "
              f"WHEN {key} IS NULL THEN {quoted(key_reason)} END")
    if mode == QUARANTINE:
        return reason
    if mode != FAILFAST:
        raise ValueError(f"unknown mode {mode!r}")
    position = ", ".join(text.name(column) for column in schemas.MESSAGE_KEY)
    message = f"concat_ws(' ', {reason}, 'at', {position})"
    return (f"CASE WHEN doc IS NULL OR {key} IS NULL "
            f"THEN CAST(raise_error({message}) AS STRING) END")


def _parsed(texts: DataFrame) -> DataFrame:
    documents = once(texts, doc=variants.parse("payload"))
    return once(documents, members=variants.members("doc"))


def parse_machine_messages(
    rows: DataFrame, processing_ts: Column | None = None, mode: str = QUARANTINE
) -> DataFrame:
    """Repair, parse and enrich machine messages (text in ``value``).

    Adds ``payload`` (repaired text, not enriched), ``doc`` and its ``members``,
    ``lot_no``, ``asset_id``, ``crt_dtm``, ``oper_stat`` and ``reject_reason``.
    """
    clock = F.current_timestamp() if processing_ts is None else processing_ts
    texts = rows.selectExpr(
        *map(text.name, schemas.MESSAGE_KEY), "timestamp",
        f"{text.repair_lot_blanks('value')} AS payload",
    )
    keyed = once(_parsed(texts), lot_no=variants.string_member("members", fixed.KEY_LOT))
    return keyed.select(
        "*",
        F.expr(text.asset_id_from_lot("lot_no")).alias("asset_id"),
        clock.alias("crt_dtm"),
        F.lit(fixed.OPER_STAT).alias("oper_stat"),
        F.expr(_reject_reason("lot_no", NO_LOT, mode)).alias("reject_reason"),
    )


def parse_status_messages(rows: DataFrame, mode: str = QUARANTINE) -> DataFrame:
    """Parse status messages: ``doc``, ``members``, ``asset_id``, ``reject_reason``."""
    texts = rows.selectExpr(
        *map(text.name, schemas.MESSAGE_KEY), "timestamp", "value AS payload"
    )
    parsed = _parsed(texts)
    keyed = once(
        parsed, machine_id=variants.string_member("members", fixed.KEY_MACHINE_ID)
    )
    return keyed.selectExpr(
        *map(text.name, parsed.columns),
        f"{text.asset_id_from_machine_id('machine_id')} AS asset_id",
        f"{_reject_reason('machine_id', NO_MACHINE, mode)} AS reject_reason",
    )


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where("reject_reason IS NULL").drop("reject_reason")


def quarantined(parsed: DataFrame) -> DataFrame:
    """Rejected messages with their text, for repair and replay."""
    return parsed.where("reject_reason IS NOT NULL").select(
        *schemas.MESSAGE_KEY, "timestamp", "payload", "reject_reason"
    )


def value_types(documents: DataFrame) -> DataFrame:
    """One row per member of every document with the type of its value."""
    kept = documents.select(*schemas.MESSAGE_KEY, F.explode("members").alias("key", "value"))
    typed = once(kept, value_schema=variants.schema_text("value"))
    return typed.select(
        *schemas.MESSAGE_KEY, "key",
        F.expr(variants.type_name("value", "value_schema")).alias("value_type"),
    )
