"""Text expressions: lot repair, asset ids, padding.

Like all of ``functions``, these take and return SQL expression text.  A plan
may hold an expression per tag of the master; as text, each costs one call into
the JVM, where building it node by node from Python would cost dozens.
"""

from kilnstream import fixed


def quoted(text: str) -> str:
    """A string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def name(column: str) -> str:
    """A column name."""
    return "`" + column.replace("`", "``") + "`"


def repair_lot_blanks(value: str) -> str:
    """Drop the two blanks that close the lot number; a third one stays."""
    return f"replace({value}, {quoted(fixed.PADDED_LOT_END)}, {quoted(fixed.CLEAN_LOT_END)})"


def asset_id_from_lot(lot_no: str) -> str:
    part = f"substring({lot_no}, {fixed.LOT_ASSET_START}, {fixed.LOT_ASSET_LENGTH})"
    return f"concat({quoted(fixed.ASSET_PREFIX)}, {part})"


def asset_id_from_machine_id(machine_id: str) -> str:
    return f"substring({machine_id}, {fixed.STATUS_ASSET_START})"


def pad_single(text: str) -> str:
    """Put a zero before one character; longer text is never cut."""
    return f"CASE WHEN length({text}) = 1 THEN concat('0', {text}) ELSE {text} END"


def whole_part(number: str) -> str:
    """Integer part of a double as text, NULL when there is none."""
    return f"CAST(try_cast({number} AS INT) AS STRING)"
