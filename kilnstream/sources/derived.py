"""Machine messages and masters derived from an event table.

Every row of ``events`` becomes one machine message (and one status message);
the masters hold one row per machine seen in the events.  All of it is a plain
projection, so it reads and scales like the event table itself.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kilnstream import fixed, schemas
from kilnstream.functions.text import quoted
from kilnstream.sources.spread import spread

SITE = "SITE_00001"
OTHER_SITE = "SITE_00002"

# Tag template, one row per tag of every machine
# (tag_id, mapping_key, alias, type code, info min/max, warning min/max, emergency min/max).
TAG_TEMPLATE = [
    ("T06", "6", "c6", "D02", None, None, None, None, None, None),
    ("T06D", "6", "c6d", "D01", None, None, None, None, None, None),
    ("T07", "7", "c7", "D01", "2.5", "150", "1.0", "250", "0.2", "400"),
    ("T08", "8", "c8", "D01", None, "1", None, None, None, None),
    ("T100", "100", "c100", "D01", None, "50", None, None, None, "90"),
]

# Type codes (group, code, name).
TYPE_CODES = [
    ("DATA_TYPE_CD", "D01", "DOUBLE"),
    ("DATA_TYPE_CD", "D02", "STRING"),
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events")


def _machine_number(user_id: str) -> str:
    return f"lpad(CAST({user_id} % 20 AS STRING), 3, '0')"


PROP_K = """CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT)"""


def _key(topic: str) -> list[str]:
    return [
        f"'{topic}' AS topic", "CAST(user_id % 3 AS INT) AS `partition`",
        "event_id AS `offset`",
        # the events' times have no zone; they mean UTC whatever the session's zone is
        "CAST(concat(CAST(ts AS STRING), ' UTC') AS TIMESTAMP) AS `timestamp`",
    ]


def _double(whole: str) -> str:
    """Text of a whole number as a double."""
    return f"concat(CAST({whole} AS STRING), '.0')"


def _text(value: str) -> str:
    return f"concat('\"', {value}, '\"')"


def _json(members: list[tuple[str, str]]) -> str:
    parts = [f"concat('\"{key}\": ', {value})" for key, value in members]
    return f"concat('{{', concat_ws(', ', {', '.join(parts)}), '}}')"


def machine_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One machine message per event; the offset is the event id."""
    number = _machine_number("user_id")
    user = "CASE WHEN user_id < 10000 THEN lpad(CAST(user_id AS STRING), 5, '0') " \
           "ELSE CAST(user_id AS STRING) END"
    lot_no = f"concat('LOT__', {number}, '_', {user})"
    value = _json([
        ("0", _double("year(ts) - 2000")),
        ("1", _double("month(ts)")),
        ("2", _double("day(ts)")),
        ("3", _double("hour(ts)")),
        ("4", _double("minute(ts)")),
        ("5", _text(f"concat({lot_no}, '  ')")),
        ("6", _text("CASE WHEN event_type = 'error' THEN '' ELSE event_type END")),
        ("7", "CAST(value AS STRING)"),
        ("8", "CAST(event_id AS STRING)"),
        ("100", _double(PROP_K)),
    ])
    rows = spread(events(spark, sf_dir), "event_id")
    return rows.selectExpr(*_key("dispMachine"), f"{value} AS value")


def status_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One machine status message per event."""
    machine_id = f"concat('KR1_', '{fixed.ASSET_PREFIX}', {_machine_number('user_id')})"
    value = _json([
        ("machineid", _text(machine_id)),
        ("status", _text("event_type")),
        ("seqStatus", _text(f"concat('S', {PROP_K} % 3)")),
        ("growStatus", _text(f"concat('G', {PROP_K} % 2)")),
        ("datetime", _text("CAST(ts AS STRING)")),
    ])
    rows = spread(events(spark, sf_dir), "event_id")
    return rows.selectExpr(*_key("dispMachineStatus"), f"{value} AS value")


def _machines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Machine numbers seen in the events."""
    return events(spark, sf_dir).select((F.col("user_id") % 20).alias("mm")).distinct()


def _asset_id() -> Column:
    return F.expr(f"concat('{fixed.ASSET_PREFIX}', {_machine_number('mm')})")


def _both_sites() -> Column:
    return F.explode(F.array(F.lit(SITE), F.lit(OTHER_SITE)))


def asset_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every machine at two sites; a quarter unconfirmed at the first one."""
    unconfirmed = (F.col("site_id") == SITE) & (F.col("mm") % 4 == 3)
    empty = F.lit(None).cast("string")
    return (
        _machines(spark, sf_dir)
        .select(_both_sites().alias("site_id"), "mm")
        .select(
            "site_id",
            _asset_id().alias("asset_id"),
            F.when(unconfirmed, F.lit("N")).otherwise(F.lit("Y")).alias("model_confirm_yn"),
            *[empty.alias(name) for name in fixed.STATUS_COLUMNS.values()],
            F.lit(None).cast("timestamp").alias("stat_chg_dtm"),
        )
    )


def tag_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tag template for every machine; the second site has no limits."""
    names = ["tag_id", "mapping_key", "alias", "data_type_cd", *fixed.LIMIT_COLUMNS]
    structs = []
    for row in TAG_TEMPLATE:
        cells = ["CAST(NULL AS STRING)" if cell is None else quoted(cell) for cell in row]
        fields = ", ".join(f"'{name}', {cell}" for name, cell in zip(names, cells))
        structs.append(f"named_struct({fields})")
    template = F.expr(f"array({', '.join(structs)})")
    rows = (
        _machines(spark, sf_dir)
        .select(_both_sites().alias("site_id"), "mm")
        .select("site_id", _asset_id().alias("asset_id"), F.explode(template).alias("t"))
    )
    limits = [f"CASE WHEN site_id = '{SITE}' THEN t.{name} END AS {name}"
              for name in fixed.LIMIT_COLUMNS]
    return rows.selectExpr(
        "site_id", "asset_id", "t.tag_id", "upper(t.alias) AS tag_nm", "t.alias",
        "t.mapping_key", *limits, "t.data_type_cd",
    ).select(*schemas.TAG_LIMIT_SCAN_COLUMNS)


# Mapping keys of a part's tags; no message has the last.
PART_KEYS = ["6", "7", "9"]


def part_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tag master as large as ``part``: one tag for every part and key, no limits."""
    machine = _machine_number("p_partkey")
    keys = ", ".join(f"'{key}'" for key in PART_KEYS)
    rows = _table(spark, sf_dir, "part").selectExpr(
        "p_partkey", f"concat('{fixed.ASSET_PREFIX}', {machine}) AS asset_id",
        f"explode(array({keys})) AS mapping_key",
    )
    tag_id = "concat('P', lpad(CAST(p_partkey AS STRING), 12, '0'), '_', mapping_key)"
    limits = [f"CAST(NULL AS STRING) AS {name}" for name in fixed.LIMIT_COLUMNS]
    return rows.selectExpr(
        f"'{SITE}' AS site_id", "asset_id", f"{tag_id} AS tag_id", f"{tag_id} AS tag_nm",
        f"lower({tag_id}) AS alias", "mapping_key", *limits, "'D01' AS data_type_cd",
    ).select(*schemas.TAG_LIMIT_SCAN_COLUMNS)


def type_codes(spark: SparkSession) -> DataFrame:
    rows = ", ".join(str(row) for row in TYPE_CODES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS codes({', '.join(schemas.CODE.names)})")


def tag_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten-column tag table of the relational examples, from ``part``."""
    part = _table(spark, sf_dir, "part")
    key = F.col("p_partkey").cast("string")
    return part.select(
        F.concat(F.lit("VTAG_"), key).alias("TAG_ID"),
        F.col("p_name").alias("TAG_NM"),
        F.lit("Double").alias("DATA_TYPE"),
        F.col("p_type").alias("TAG_DESC"),
        (F.col("p_size") * 1000).alias("CYCLE"),
        F.col("p_size").cast("string").alias("IMPORTANCE"),
        F.concat(F.lit("TEMP_"), key).alias("ALIAS"),
        F.col("p_size").cast("double").alias("MIN_VALUE"),
        F.col("p_retailprice").alias("MAX_VALUE"),
        F.col("p_brand").alias("FORMAT"),
    )
