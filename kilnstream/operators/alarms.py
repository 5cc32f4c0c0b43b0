"""Limit checks and alarm records."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kilnstream import fixed, schemas
from kilnstream.functions import text, variants
from kilnstream.functions.text import quoted
from kilnstream.operators.lookup import Lookup
from kilnstream.operators.once import once

# Issues found in alarms.
NO_TIME = "alarm time parts missing"

# Worst first, so that the first match of a CASE is the alarm's level.
_WORST_FIRST = (
    (fixed.LEVEL_EMERGENCY, "emer"),
    (fixed.LEVEL_WARNING, "worm"),
    (fixed.LEVEL_INFO, "info"),
)


def level_of(value: str, of: str = "") -> str:
    """Level of the worst limit pair the value lies strictly outside of, or NULL.

    NaN is outside of nothing; Spark would order it above every limit.  ``of`` stands
    before the limits' names.
    """
    branches = " ".join(
        f"WHEN {value} < {of}alarm_{name}_min_val OR {value} > {of}alarm_{name}_max_val "
        f"THEN '{code}'"
        for code, name in _WORST_FIRST
    )
    return f"CASE WHEN isnan({value}) THEN NULL {branches} END"


def limited_tags(tags: Lookup) -> Lookup:
    """Tags with at least one limit; the others cannot raise an alarm."""
    any_limit = f"coalesce({', '.join(fixed.LIMIT_COLUMNS)}) IS NOT NULL"
    return tags.narrowed(tags.frame.where(any_limit))


def alarm_levels(pairs: DataFrame, widen_ints: bool = False) -> DataFrame:
    """Message and tag pairs that fire, with ``alarm_val`` and ``alarm_level_cd``."""
    number = variants.double_value("value", "value_schema", widen_ints)
    return (
        once(pairs, alarm_val=number)
        .withColumn("alarm_level_cd", F.expr(level_of("alarm_val")))
        .where("alarm_level_cd IS NOT NULL")
    )


def with_minute(rows: DataFrame) -> DataFrame:
    """Add ``minute_key``, ``20yyMMddHHmm`` of a message; NULL unless all parts are DOUBLE."""
    keys = fixed.TIME_KEYS
    timed = once(rows, **{
        f"_v{key}": variants.member("members", quoted(key)) for key in keys
    })
    timed = once(timed, **{f"_s{key}": variants.schema_text(f"_v{key}") for key in keys})
    timed = once(timed, **{
        f"_p{key}": text.whole_part(variants.double_value(f"_v{key}", f"_s{key}")) for key in keys
    })
    year, *others = [f"_p{key}" for key in keys]
    padded = ", ".join(text.pad_single(part) for part in others)
    minute = f"concat({quoted(fixed.CENTURY)}, {year}, {padded})"
    return once(timed, minute_key=minute).drop(*[f"_{c}{key}" for c in "vsp" for key in keys])


def alarm_history(fired: DataFrame) -> DataFrame:
    """Alarm records; the message key makes them unique where the alarm id does not."""
    return alarm_records(with_minute(fired))


def alarm_records(timed: DataFrame) -> DataFrame:
    """Alarm records of fired pairs that have their ``minute_key``."""
    return timed.selectExpr(
        *map(text.name, schemas.MESSAGE_KEY),
        "concat(lot_no, '_', minute_key, key_part) AS alarm_id",
        "site_id", "asset_id", "tag_id",
        "crt_dtm AS alarm_date_time",
        "alarm_val", "alarm_level_cd",
        f"concat({quoted(fixed.ALARM_TEXT)}, CAST(alarm_val AS STRING)) AS alarm_desc",
        f"{quoted(fixed.ALARM_UNCONFIRMED)} AS confirm_yn",
    )


def alarm_issues(alarms: DataFrame) -> DataFrame:
    """Alarms without an id, because the message lacks its time parts."""
    return alarms.where(F.col("alarm_id").isNull()).select(
        *schemas.MESSAGE_KEY, "asset_id", "tag_id", F.lit(NO_TIME).alias("issue")
    )
