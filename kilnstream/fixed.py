"""Fixed values.

Everything here must equal what the machines, the message producers and the
existing stores already use; changing one of them changes results.
"""

# Keys of a machine document.
TIME_KEYS = ("0", "1", "2", "3", "4")  # year of the century, month, day, hour, minute
KEY_LOT = "5"

# Keys of a status document and the master columns they feed.
KEY_MACHINE_ID = "machineid"
STATUS_COLUMNS = {
    "status": "asset_stat_cd",
    "seqStatus": "seq_proc_stat_cd",
    "growStatus": "grow_proc_stat_cd",
}

# The producer pads the lot number with two blanks.
PADDED_LOT_END = '  ", "6":'
CLEAN_LOT_END = '", "6":'

# How an asset id is spelled.
ASSET_PREFIX = "Machine"
LOT_ASSET_START = 6  # 1-based position in the lot number
LOT_ASSET_LENGTH = 3
STATUS_ASSET_START = 5  # 1-based position in the machine id

# Columns added to every stored document.
OPER_STAT = "1"

# Asset and code masters.
CONFIRMED = "Y"
TYPE_CODE_GROUP = "DATA_TYPE_CD"
DOUBLE_TYPE_WORD = "DOUBLE"
EMPTY_DOUBLE_CELL = "0.0"

# Alarm records.
LEVEL_INFO = "0"
LEVEL_WARNING = "1"
LEVEL_EMERGENCY = "2"
CENTURY = "20"
ALARM_TEXT = "알람 발생 값 = "
ALARM_UNCONFIRMED = "N"

# The six limit columns of the tag master, mildest first.
LIMIT_COLUMNS = (
    "alarm_info_min_val",
    "alarm_info_max_val",
    "alarm_worm_min_val",
    "alarm_worm_max_val",
    "alarm_emer_min_val",
    "alarm_emer_max_val",
)

# Ending of the names of staging targets.
STAGING_SUFFIX = "_temp"
