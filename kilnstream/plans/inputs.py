"""Inputs of the registered queries: messages and masters of a data folder."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kilnstream import fixed
from kilnstream.operators import assets, messages
from kilnstream.operators.assets import Masters
from kilnstream.sources import derived

SITE = derived.SITE


def machine_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.machine_messages(spark, sf_dir)


def wide_ints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages whose "8" is a whole number beyond 64 bits, 1.0, 100.0 or 9e0, in turn."""
    number = F.expr("""CASE `offset` % 4
        WHEN 0 THEN concat('9223372036854775', lpad(CAST(`offset` AS STRING), 12, '0'))
        WHEN 1 THEN '1.0' WHEN 2 THEN '100.0' ELSE '9e0' END""")
    rows = machine_messages(spark, sf_dir)
    key = F.lit('"8": ')
    return rows.withColumn("value", F.replace(
        "value", F.concat(key, F.col("offset").cast("string")), F.concat(key, number)
    ))


def status_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.status_messages(spark, sf_dir)


def masters(spark: SparkSession, sf_dir: str) -> Masters:
    """Measured masters, cached: queries on the same folder share them."""
    return assets.load_masters(
        derived.asset_master(spark, sf_dir),
        derived.tag_master(spark, sf_dir),
        derived.type_codes(spark),
        SITE,
        keep=True,
    )


def tags_with_info_max(spark: SparkSession, sf_dir: str, info_max: str) -> DataFrame:
    limit = fixed.LIMIT_COLUMNS[1]
    return derived.tag_master(spark, sf_dir).withColumn(
        limit, F.when(F.col(limit).isNotNull(), F.lit(info_max))
    )


def masters_with_info_max(spark: SparkSession, sf_dir: str, info_max: str) -> Masters:
    """Masters whose info limits have another upper value."""
    return assets.load_masters(
        derived.asset_master(spark, sf_dir), tags_with_info_max(spark, sf_dir, info_max), derived.type_codes(spark), SITE, keep=True
    )


def masters_with_shared_alias(spark: SparkSession, sf_dir: str) -> Masters:
    """Masters in which two tags of every machine have the alias ``c7``."""
    tags = derived.tag_master(spark, sf_dir).withColumn(
        "alias", F.when(F.col("alias") == "c100", F.lit("c7")).otherwise(F.col("alias"))
    )
    return assets.load_masters(
        derived.asset_master(spark, sf_dir), tags, derived.type_codes(spark), SITE, keep=True
    )


def masters_with_tags(spark: SparkSession, sf_dir: str, tag_ids: list[str]) -> Masters:
    """Masters that know only some tags."""
    tags = derived.tag_master(spark, sf_dir).where(F.col("tag_id").isin(tag_ids))
    return assets.load_masters(
        derived.asset_master(spark, sf_dir), tags, derived.type_codes(spark), SITE, keep=True
    )


def part_masters(spark: SparkSession, sf_dir: str) -> Masters:
    """Masters that grow with ``part``: three tags of every part, dealt to the machines."""
    return assets.load_masters(
        derived.asset_master(spark, sf_dir), derived.part_tags(spark, sf_dir),
        derived.type_codes(spark), SITE, keep=True,
    )


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.parse_machine_messages(machine_messages(spark, sf_dir))


def accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.accepted(parsed(spark, sf_dir))


def modelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assets.modelled(accepted(spark, sf_dir), masters(spark, sf_dir))


def accepted_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.accepted(messages.parse_status_messages(status_messages(spark, sf_dir)))
