"""Typed access to the values of a parsed document.

A document is a VARIANT, so ``9`` and ``9.0`` stay different: only the second
is a DOUBLE and may raise an alarm.  Casting a variant would hide that, hence
every read is guarded by the type of the value itself.  Expressions are SQL
text (see ``functions.text``).
"""

from kilnstream.functions.text import quoted

# Names of value types.
DOUBLE = "DOUBLE"
STRING = "STRING"
DATE_TIME = "DATE_TIME"
INT32 = "INT32"
INT64 = "INT64"
BOOLEAN = "BOOLEAN"
WIDE_INT = "INT_OVER_64"
NULL = "NULL"
ARRAY = "ARRAY"
DOCUMENT = "DOCUMENT"

# Single-member objects that stand for a typed value.
DATE_MEMBER = "$date"
DOUBLE_MEMBER = "$numberDouble"
LONG_MEMBER = "$numberLong"
INT_MEMBER = "$numberInt"


def parse(value: str) -> str:
    """The document, or NULL for text that is not one JSON value."""
    return f"try_parse_json({value})"


def members(doc: str) -> str:
    """Members of an object as a map; NULL for any other document.

    One walk over the document serves every later key, and a key taken from the
    tag master is looked up as it is, with no path to build and parse per row.
    """
    return f"try_variant_get({doc}, '$', 'map<string,variant>')"


def member(of: str, key: str) -> str:
    """Value under a key (an expression) of ``members``, NULL when it is missing."""
    return f"try_element_at({of}, {key})"


def schema_text(value: str) -> str:
    return f"schema_of_variant({value})"


def _wraps(schema: str, member_name: str) -> str:
    return (f"(startswith({schema}, 'OBJECT<`{member_name}`: ') "
            f"AND NOT contains({schema}, ', '))")


def _plain_double(schema: str) -> str:
    return f"(startswith({schema}, 'DECIMAL') OR {schema} IN ('DOUBLE', 'FLOAT'))"


def wide_int(value: str, schema: str) -> str:
    """Whether a value is a number without fraction that 64 bits cannot hold.

    Inside 64 bits an integer literal is a BIGINT, and a decimal without fraction was
    written with a point.  Outside, both are the same decimal, so it is taken for the
    integer that it may be.
    """
    number = f"try_variant_get({value}, '$', 'decimal(38,0)')"
    return (f"(startswith({schema}, 'DECIMAL') AND endswith({schema}, ',0)') "
            f"AND {number} NOT BETWEEN -9223372036854775808 AND 9223372036854775807)")


def type_name(value: str, schema: str) -> str:
    """Type of a value by its own form; SQL NULL for a missing key."""
    fits_int = f"try_variant_get({value}, '$', 'int') IS NOT NULL"
    return f"""CASE
        WHEN {schema} IS NULL THEN NULL
        WHEN {wide_int(value, schema)} THEN '{WIDE_INT}'
        WHEN {_plain_double(schema)} OR {_wraps(schema, DOUBLE_MEMBER)} THEN '{DOUBLE}'
        WHEN {schema} = 'STRING' THEN '{STRING}'
        WHEN {schema} = 'BIGINT' THEN CASE WHEN {fits_int} THEN '{INT32}' ELSE '{INT64}' END
        WHEN {schema} = 'BOOLEAN' THEN '{BOOLEAN}'
        WHEN {schema} = 'VOID' THEN '{NULL}'
        WHEN startswith({schema}, 'ARRAY') THEN '{ARRAY}'
        WHEN {_wraps(schema, DATE_MEMBER)} THEN '{DATE_TIME}'
        WHEN {_wraps(schema, INT_MEMBER)} THEN '{INT32}'
        WHEN {_wraps(schema, LONG_MEMBER)} THEN '{INT64}'
        ELSE '{DOCUMENT}' END"""


def double_value(value: str, schema: str, widen_ints: bool = False) -> str:
    """The number when the value is a DOUBLE, else NULL."""
    plain = f"({_plain_double(schema)} AND NOT {wide_int(value, schema)})"
    if widen_ints:
        plain = f"({_plain_double(schema)} OR {schema} = 'BIGINT')"
    wrapped = f"try_variant_get({value}, '$.{DOUBLE_MEMBER}', 'string')"
    return f"""CASE
        WHEN {plain} THEN try_variant_get({value}, '$', 'double')
        WHEN {_wraps(schema, DOUBLE_MEMBER)} THEN try_cast({wrapped} AS DOUBLE) END"""


def string_value(value: str, schema: str) -> str:
    return f"CASE WHEN {schema} = 'STRING' THEN try_variant_get({value}, '$', 'string') END"


def date_time_value(value: str, schema: str) -> str:
    """Timestamp of ``{"$date": text | milliseconds | {"$numberLong": text}}``."""
    date = f"$.{DATE_MEMBER}"
    long_text = f"try_variant_get({value}, '{date}.{LONG_MEMBER}', 'string')"
    return f"""CASE
        WHEN {schema} = {quoted(f'OBJECT<`{DATE_MEMBER}`: BIGINT>')}
          THEN timestamp_millis(try_variant_get({value}, '{date}', 'bigint'))
        WHEN {schema} = {quoted(f'OBJECT<`{DATE_MEMBER}`: STRING>')}
          THEN try_variant_get({value}, '{date}', 'timestamp')
        WHEN {_wraps(schema, DATE_MEMBER)}
          THEN timestamp_millis(try_cast({long_text} AS BIGINT)) END"""


def double_member(of: str, key: str) -> str:
    """The DOUBLE under a fixed key, else NULL."""
    value = member(of, quoted(key))
    return double_value(value, schema_text(value))


def string_member(of: str, key: str) -> str:
    """The STRING under a fixed key, else NULL."""
    value = member(of, quoted(key))
    return string_value(value, schema_text(value))
