"""Schemas of the tables the jobs read and write."""

from pyspark.sql import types as T

from kilnstream.fixed import LIMIT_COLUMNS


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


# What a position-keeping message stream delivers; the first four columns are
# the message key and its arrival time.
MESSAGE = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("value", T.StringType()),
])

MESSAGE_KEY = ["topic", "partition", "offset"]

# Total arrival order of messages.
ARRIVAL = ["timestamp", "partition", "offset"]

ASSET = T.StructType(
    _strings("site_id", "asset_id", "model_confirm_yn",
             "asset_stat_cd", "seq_proc_stat_cd", "grow_proc_stat_cd")
    + [T.StructField("stat_chg_dtm", T.TimestampType())]
)

ASSET_SCAN_COLUMNS = ["site_id", "asset_id", "model_confirm_yn"]

TAG_SCAN_COLUMNS = ["site_id", "asset_id", "tag_id", "tag_nm", "alias", "mapping_key",
                    "data_type_cd"]

TAG_LIMIT_SCAN_COLUMNS = TAG_SCAN_COLUMNS[:-1] + list(LIMIT_COLUMNS) + ["data_type_cd"]

TAG = T.StructType(_strings(*TAG_LIMIT_SCAN_COLUMNS))

CODE = T.StructType(_strings("code_group", "code", "code_name"))

ALARM_COLUMNS = ["alarm_id", "site_id", "asset_id", "tag_id", "alarm_val", "alarm_level_cd",
                 "alarm_desc", "confirm_yn"]

TAG_INFO_COLUMNS = ["TAG_ID", "TAG_NM", "DATA_TYPE", "TAG_DESC", "CYCLE", "IMPORTANCE",
                    "ALIAS", "MIN_VALUE", "MAX_VALUE", "FORMAT"]
