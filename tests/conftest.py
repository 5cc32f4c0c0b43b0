import os
import sys
from datetime import datetime, timezone

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from kilnstream import schemas  # noqa: E402
from kilnstream.operators import assets  # noqa: E402

SITE = "S1"
NOON = datetime(2024, 1, 1, 12, tzinfo=timezone.utc)


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def message_rows(texts, topic="t", partition=0, first=0, minute=0):
    """Message tuples of texts, at consecutive offsets and seconds."""
    return [
        (topic, partition, first + i, NOON.replace(minute=minute, second=i % 60), text)
        for i, text in enumerate(texts)
    ]


@pytest.fixture
def messages_of(spark):
    def build(rows):
        rows = [r if isinstance(r, tuple) else message_rows([r])[0] for r in rows]
        return spark.createDataFrame(rows, schemas.MESSAGE)
    return build


@pytest.fixture
def texts(spark):
    def build(*values, **where):
        return spark.createDataFrame(message_rows(values, **where), schemas.MESSAGE)
    return build


ASSET_COLUMNS = "site_id string, asset_id string, model_confirm_yn string"


def asset_frame(spark, rows):
    """Full asset rows from (site, asset, confirmed)."""
    frame = spark.createDataFrame(rows, ASSET_COLUMNS)
    return frame.select(
        "*",
        *[F.lit(None).cast("string").alias(c)
          for c in ("asset_stat_cd", "seq_proc_stat_cd", "grow_proc_stat_cd")],
        F.lit(None).cast("timestamp").alias("stat_chg_dtm"),
    )


def tag(asset, tag_id, key, alias, code="D01", site=SITE, limits=()):
    """A tag row; ``limits`` are up to six limit texts, mildest first."""
    padded = list(limits) + [None] * (6 - len(limits))
    return (site, asset, tag_id, tag_id, alias, key, *padded, code)


def tag_frame(spark, rows):
    return spark.createDataFrame(rows, schemas.TAG)


def code_frame(spark):
    rows = [("DATA_TYPE_CD", "D01", "DOUBLE"), ("DATA_TYPE_CD", "D02", "STRING"),
            ("OTHER", "D01", "WRONG")]
    return spark.createDataFrame(rows, schemas.CODE)


@pytest.fixture
def masters_of(spark):
    def build(asset_rows, tag_rows):
        return assets.load_masters(
            asset_frame(spark, asset_rows), tag_frame(spark, tag_rows), code_frame(spark), SITE
        )
    return build


DAY = '"0": 24.0, "1": 1.0, "2": 2.0, "3": 3.0, "4": 4.0'


def document(members="", lot="LOT__001_1", day=DAY):
    """Machine message text with the padded lot number and extra members."""
    tail = f", {members}" if members else ""
    return f'{{{day}, "5": "{lot}  ", "6": ""{tail}}}'
