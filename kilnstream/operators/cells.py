"""Typed cells and wide rows.

A cell is one tag's value in one message.  Cells come in long form
(``document_tags`` / ``typed_cells``, one row per message and tag) and in wide
form, one row per message: as a map from alias to cell (``wide_cells``), which is
what is stored, or with one column per alias (``wide_view`` of it, ``wide_rows``).
The map holds just the aliases of the message's own asset, however many there are
elsewhere and whenever they were added.  The wide forms read each alias straight
from the document, so nothing is shuffled.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kilnstream import fixed, schemas
from kilnstream.functions import text, variants
from kilnstream.functions.text import quoted
from kilnstream.operators.alarms import alarm_records, level_of, with_minute
from kilnstream.operators.assets import Masters, alias_tags
from kilnstream.operators.lookup import (
    BROADCAST_LIMIT, FIELD_OVERHEAD, Lookup, join_lookup,
)
from kilnstream.operators.once import once

# Issues found in messages.
KEY_MISSING = "mapped key missing"
NUMBER_TOO_WIDE = "number without fraction beyond 64 bits"

# Wide columns computed by one step of generated code, and most columns done so.
COLUMNS_PER_STEP = 2
MAX_STEPWISE_COLUMNS = 32


def cell_text(value: str, schema: str, double_tag: str, widen_ints: bool = False) -> str:
    """Cell of a value: NULL unless it is a DOUBLE, a STRING or a DATE_TIME."""
    return cell_of(variants.double_value(value, schema, widen_ints), value, schema, double_tag)


def cell_of(number: str, value: str, schema: str, double_tag: str) -> str:
    """Cell of a value whose number is known."""
    string = variants.string_value(value, schema)
    empty = f"{double_tag} AND {schema} = 'STRING' AND ({string}) = ''"
    return f"""CASE
        WHEN {empty} THEN {quoted(fixed.EMPTY_DOUBLE_CELL)}
        WHEN {schema} = 'STRING' THEN {string}
        ELSE coalesce(CAST({number} AS STRING),
                      CAST({variants.date_time_value(value, schema)} AS STRING)) END"""


def document_tags(
    messages: DataFrame, tags: Lookup, limit: int = BROADCAST_LIMIT
) -> DataFrame:
    """One row per message of a modelled asset and tag, with the tag's ``value``.

    A missing key keeps its row with a NULL value.  The document and its text stay
    behind; its members are all that the tags need.
    """
    lean = messages.drop("doc", "payload")
    paired = join_lookup(lean, tags, ["asset_id"], limit=limit)
    valued = once(paired, value=variants.member("members", "mapping_key"))
    return once(valued, value_schema=variants.schema_text("value"))


def key_tags(tags: DataFrame) -> DataFrame:
    """The first prepared tag of every asset and mapping key: one for each value of a message."""
    columns = [c for c in tags.columns if c not in ("asset_id", "mapping_key")]
    return (
        tags.groupBy("asset_id", "mapping_key")
        .agg(F.min_by(F.struct(*columns), F.col("tag_id")).alias("t"))
        .select("asset_id", "mapping_key", "t.*").select(*tags.columns)
    )


def issue_of(value: str, schema: str, mapping_key: str) -> str:
    return f"""CASE
        WHEN {schema} IS NULL AND {mapping_key} IS NOT NULL THEN {quoted(KEY_MISSING)}
        WHEN {variants.wide_int(value, schema)} THEN {quoted(NUMBER_TOO_WIDE)} END"""


# What the outputs need of a tag, besides its key and its limits.
TAG_FIELDS = ("site_id", "tag_id", "alias", "key_part")


def typed_messages(messages: DataFrame, masters: Masters, widen_ints: bool = False) -> DataFrame:
    """One row per message of a modelled asset with tags: ``typed``, its tags' values.

    Every value is looked up and typed once, whatever the outputs: ``typed`` holds for each
    tag its cell, number, alarm level and issue, and whether the tag owns its alias.  The
    time of a message with an alarm is in ``minute_key``.
    """
    tags = masters.tags
    by_alias = Window.partitionBy("asset_id", "alias").orderBy("tag_id", "mapping_key")
    owner = F.col("alias").isNotNull() & (F.row_number().over(by_alias) == 1)
    fields = [*TAG_FIELDS, "mapping_key", "double_tag", *fixed.LIMIT_COLUMNS, "owner"]
    by_asset = tags.frame.withColumn("owner", owner).groupBy("asset_id").agg(
        F.collect_list(F.struct(*fields)).alias("asset_tags"))
    rows = messages.select(*schemas.MESSAGE_KEY, "timestamp", "asset_id", "lot_no", "crt_dtm",
                           "members")
    rows = join_lookup(rows, tags.widened(by_asset, tags.n_bytes), ["asset_id"])
    rows = once(rows, _values=(
        f"transform(asset_tags, t -> struct(t, {variants.member('members', 't.mapping_key')} AS v))"
    ))
    rows = once(rows, _schemas=(
        f"transform(_values, x -> struct(x.t, x.v, {variants.schema_text('x.v')} AS s))"))
    rows = once(rows, _numbers=(
        "transform(_schemas, x -> struct(x.t, x.v, x.s, "
        f"{variants.double_value('x.v', 'x.s', widen_ints)} AS n))"))
    kept = ", ".join(f"'{name}', x.t.{name}" for name in (*TAG_FIELDS, "owner"))
    rows = once(rows, typed=(
        f"transform(_numbers, x -> named_struct({kept}, 'number', x.n, "
        f"'cell', {cell_of('x.n', 'x.v', 'x.s', 'x.t.double_tag')}, "
        f"'level', {level_of('x.n', 'x.t.')}, "
        f"'issue', {issue_of('x.v', 'x.s', 'x.t.mapping_key')}))"))
    fired = "exists(typed, x -> x.level IS NOT NULL)"
    rows = rows.drop("_values", "_schemas", "_numbers", "asset_tags") \
        .withColumn("members", F.expr(f"IF({fired}, members, NULL)"))
    return with_minute(rows).drop("members")


def _of_typed(typed: DataFrame, condition: str = "true") -> DataFrame:
    """One row per message and typed tag that meets the condition."""
    own = F.explode(F.expr(f"filter(typed, x -> {condition})")).alias("x")
    return typed.select(*[name for name in typed.columns if name != "typed"], own) \
        .select("*", "x.*").drop("x")


def cells_of(typed: DataFrame) -> DataFrame:
    """Long form: the cell of every message and tag."""
    return _of_typed(typed).select(*schemas.MESSAGE_KEY, "asset_id", "tag_id", "alias", "cell")


def issues_of(typed: DataFrame) -> DataFrame:
    """Messages that lack a key their tags ask for, or hold a number that is no DOUBLE for sure."""
    return _of_typed(typed, "x.issue IS NOT NULL").select(
        *schemas.MESSAGE_KEY, "asset_id", "tag_id", "issue")


def wide_of(typed: DataFrame) -> DataFrame:
    """Wide form: the cells of a message as a map by alias."""
    return typed.selectExpr(
        *map(text.name, [*schemas.MESSAGE_KEY, "asset_id"]),
        "map_from_entries(transform(filter(typed, x -> x.owner), x -> struct(x.alias, x.cell))) "
        "AS cells",
    ).where("size(cells) > 0")


def alarms_of(typed: DataFrame) -> DataFrame:
    """Alarm records."""
    fired = _of_typed(typed, "x.level IS NOT NULL")
    return alarm_records(fired.withColumnsRenamed({"number": "alarm_val", "level": "alarm_level_cd"}))


def typed_cells(pairs: DataFrame, widen_ints: bool = False) -> DataFrame:
    """Long form: the cell of every message and tag."""
    return once(pairs, cell=cell_text("value", "value_schema", "double_tag", widen_ints))


def cell_issues(pairs: DataFrame) -> DataFrame:
    """Messages that lack a key their tags ask for, or hold a number that is no DOUBLE for sure."""
    issue = issue_of("value", "value_schema", "mapping_key")
    return pairs.select(
        *schemas.MESSAGE_KEY, "asset_id", "tag_id", F.expr(issue).alias("issue")
    ).where("issue IS NOT NULL")


def wide_columns(tags: DataFrame) -> list[str]:
    """Aliases of the prepared tags, ordered by tag id: the columns of a wide view.

    A frame's columns are named by the driver, so this is for views; the stored
    form does not need it.
    """
    rows = (
        tags.where(F.col("alias").isNotNull())
        .groupBy("alias").agg(F.min("tag_id").alias("first_tag"))
        .orderBy("first_tag", "alias")
        .collect()
    )
    return [row["alias"] for row in rows]


def double_columns(tags: DataFrame, columns: list[str]) -> set[str]:
    """Wide columns whose every tag is of DOUBLE type."""
    rows = (
        tags.where(F.col("alias").isin(columns))
        .groupBy("alias").agg(F.every("double_tag").alias("all_double"))
        .where("all_double").limit(len(columns)).collect()
    )
    return {row["alias"] for row in rows}


def _tags_by_column(masters: Masters, columns: list[str]) -> Lookup:
    """One row per asset: for every wide column its tag, or NULL."""
    tags = masters.tags
    listed = ", ".join(quoted(alias) for alias in columns)
    by_asset = (
        tags.frame.where("alias IS NOT NULL")
        .groupBy("asset_id")
        .agg(F.array_sort(F.collect_list(
            F.struct("tag_id", "mapping_key", "double_tag", "alias")
        )).alias("tags"))
    )
    first_tag = "try_element_at(filter(tags, t -> t.alias = column), 1)"
    column_tags = f"transform(array({listed}), column -> {first_tag})"
    slots = masters.confirmed.most_rows * len(columns)
    return tags.widened(
        by_asset.selectExpr("asset_id", f"{column_tags} AS column_tags"), slots * FIELD_OVERHEAD
    )


def _cells_in_steps(rows: DataFrame, n: int, widen_ints: bool) -> tuple[DataFrame, list[str]]:
    """Cells of ``n`` columns, a few at a time: generated code stays small enough to be fast."""
    for start in range(0, n, COLUMNS_PER_STEP):
        step = range(start, min(start + COLUMNS_PER_STEP, n))
        rows = once(rows, **{
            f"_v{i}": variants.member("members", f"column_tags[{i}].mapping_key") for i in step
        })
        rows = once(rows, **{f"_s{i}": variants.schema_text(f"_v{i}") for i in step})
        rows = once(rows, **{
            f"_c{i}": cell_text(f"_v{i}", f"_s{i}", f"column_tags[{i}].double_tag", widen_ints)
            for i in step
        }).drop(*[f"_{x}{i}" for x in "vs" for i in step])
    return rows, [f"_c{i}" for i in range(n)]


def wide_cells(messages: DataFrame, masters: Masters, widen_ints: bool = False) -> DataFrame:
    """One row per message of a modelled asset with tags: ``cells``, a map by alias."""
    tags = masters.tags
    by_asset = alias_tags(tags.frame).groupBy("asset_id").agg(F.collect_list(
        F.struct("alias", "mapping_key", "double_tag")
    ).alias("asset_tags"))
    rows = messages.select(*schemas.MESSAGE_KEY, "asset_id", "members")
    rows = join_lookup(rows, tags.widened(by_asset, 0), ["asset_id"])
    rows = once(rows, _values=(
        "transform(asset_tags, t -> named_struct('a', t.alias, 'd', t.double_tag, "
        f"'v', {variants.member('members', 't.mapping_key')}))"
    ))
    rows = once(rows, _typed=(
        "transform(_values, x -> named_struct('a', x.a, 'd', x.d, 'v', x.v, "
        f"'s', {variants.schema_text('x.v')}))"
    ))
    cell = cell_text("x.v", "x.s", "x.d", widen_ints)
    return rows.selectExpr(
        *map(text.name, [*schemas.MESSAGE_KEY, "asset_id"]),
        f"map_from_entries(transform(_typed, x -> struct(x.a, {cell}))) AS cells",
    )


def alias_classes(tags: DataFrame) -> DataFrame:
    """Prepared tags of the first alias of each class, with ``n_aliases``, the size of the class.

    A class holds the aliases of an asset whose tags have one mapping key and type, so they
    have one cell in every message.
    """
    own = alias_tags(tags).select(*tags.columns)
    columns = [c for c in own.columns if c not in ("asset_id", "mapping_key", "double_tag")]
    return (
        own.groupBy("asset_id", "mapping_key", "double_tag")
        .agg(F.min_by(F.struct(*columns), F.col("alias")).alias("t"),
             F.count("*").alias("n_aliases"))
        .select("asset_id", "mapping_key", "double_tag", "t.*", "n_aliases")
        .select(*own.columns, "n_aliases")
    )


def wide_view(rows: DataFrame, columns: list[str], doubles: set[str] = frozenset()) -> DataFrame:
    """Rows with ``cells`` as rows with one column per alias; ``doubles`` become numbers."""
    cells = [f"try_element_at(cells, {quoted(alias)})" for alias in columns]
    return rows.selectExpr(
        *[text.name(name) for name in rows.columns if name != "cells"],
        *_named(columns, cells, doubles),
    )


def _named(columns: list[str], cells: list[str], doubles: set[str]) -> list[str]:
    return [
        f"{f'try_cast({cell} AS DOUBLE)' if alias in doubles else cell} AS {text.name(alias)}"
        for alias, cell in zip(columns, cells)
    ]


def wide_rows(
    messages: DataFrame,
    masters: Masters,
    columns: list[str] | None = None,
    typed: bool = False,
    widen_ints: bool = False,
) -> DataFrame:
    """One row per message of a modelled asset with tags, one column per alias."""
    tags = masters.tags
    columns = wide_columns(tags.frame) if columns is None else columns
    doubles = double_columns(tags.frame, columns) if typed else set()
    if len(columns) > MAX_STEPWISE_COLUMNS:
        return wide_view(wide_cells(messages, masters, widen_ints), columns, doubles)
    rows = join_lookup(messages, _tags_by_column(masters, columns), ["asset_id"])
    rows, cells = _cells_in_steps(rows, len(columns), widen_ints)
    return rows.selectExpr(
        *map(text.name, [*schemas.MESSAGE_KEY, "asset_id"]), *_named(columns, cells, doubles)
    )


def wide_rows_by_pivot(cells: DataFrame, tags: DataFrame, columns: list[str]) -> DataFrame:
    """The same rows from long form; costs a shuffle on the message key."""
    owned = cells.join(
        alias_tags(tags).select("asset_id", "alias", "tag_id"),
        ["asset_id", "alias", "tag_id"], "left_semi",
    )
    return (
        owned.groupBy(*schemas.MESSAGE_KEY, "asset_id")
        .pivot("alias", columns)
        .agg(F.first("cell"))
    )
