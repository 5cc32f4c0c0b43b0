"""Quotation linking: quoted passages joined to the messages they come from.

A line whose first characters are ``>`` marks, with white space between them or
not, is quoted; the number of marks is its level.  Consecutive lines of one level
are a passage.  Lines are normalised (lower case, runs of all but letters and
digits as one space) and hashed.  A quoted line belongs to the earliest message of
its conversation in which the same line stands unquoted, if that is earlier than
the quoting message.  A passage belongs to the message that most of its lines
belong to (the latest of equals), and a message answers the message that its first
linked passage of the lowest level belongs to.

The conversation is rebuilt without quotes: quoted lines, and a line that says who
wrote them, are removed, and every message gets the first message of its thread.
Ordered by ``conv_id, root_turn, turn``, each thread is together and each reply
comes after what it answers.

Only DataFrame functions are used.  A line meets at most one row of the index of
unquoted lines, so no join multiplies rows; nothing gathers a conversation.

* null text: no lines, text stays null; empty text stays empty;
* null ``conv_id`` or ``turn``: nothing is linked;
* lines without letters and digits are never linked;
* rows that repeat conversation and turn are judged by their own text; the earliest
  answered turn of them is the one that others' threads follow;
* an empty table gives an empty one; other columns are kept by ``rebuild``.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kilnstream.llm.linking import Workbench

QUOTED = r"^[ \t]*>"
MARKS = r"^([ \t]*>)+"
ATTRIBUTION = r"^[ \t]*On .+ wrote:[ \t]*$"
MESSAGE = ["conv_id", "turn", "text_hash"]
PASSAGE = [*MESSAGE, "passage"]


def sql_text(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\") + "'"


def is_attribution() -> str:
    """SQL for "line ``i`` names the author of the quoted line after it"."""
    return (f"(line RLIKE {sql_text(ATTRIBUTION)} "
            f"AND coalesce(get(lines, i + 1), '') RLIKE {sql_text(QUOTED)})")


def normalised(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(line), r"[^\p{L}\p{N}]+", " "))


def _lines(messages: DataFrame) -> DataFrame:
    """``conv_id, turn, text_hash, line_no, line``; attributions are empty."""
    rows = messages.select(
        "conv_id", "turn", F.xxhash64("text").alias("text_hash"),
        F.split("text", "\n", -1).alias("lines"),
    )
    kept = f"transform(lines, (line, i) -> if({is_attribution()}, '', line))"
    return rows.select(*MESSAGE, F.posexplode(F.expr(kept)).alias("line_no", "line"))


def passages(messages: DataFrame) -> DataFrame:
    """Quoted lines with ``level, passage`` and the hash of their normal form.

    ``passage`` is the line number at which the passage begins; it is found among
    the lines of one message.
    """
    marks = F.regexp_extract("line", MARKS, 0)
    quoted = _lines(messages).where(F.col("line").rlike(QUOTED)).select(
        *MESSAGE, "line_no",
        F.length(F.regexp_replace(marks, "[^>]", "")).alias("level"),
        normalised(F.regexp_replace("line", MARKS, "")).alias("form"),
    )
    before = Window.partitionBy(*MESSAGE).orderBy("line_no")
    goes_on = (F.lag("line_no").over(before) == F.col("line_no") - 1) & (
        F.lag("level").over(before) == F.col("level"))
    begins = F.when(~F.coalesce(goes_on, F.lit(False)), F.col("line_no"))
    return quoted.distinct().select(
        "*", F.last(begins, ignorenulls=True).over(before).alias("passage"),
        F.when(F.col("form") != "", F.xxhash64("form")).alias("line_hash"),
    )


def linked_passages(messages: DataFrame) -> DataFrame:
    """One row per passage: level, lines, ``passage_hash`` and ``origin_turn`` if it is known."""
    quoted = passages(messages)
    own = _lines(messages).where(~F.col("line").rlike(QUOTED)) \
        .select("conv_id", "turn", F.xxhash64(normalised(F.col("line"))).alias("line_hash"))
    index = own.groupBy("conv_id", "line_hash").agg(F.min("turn").alias("origin_turn"))
    found = quoted.join(index, ["conv_id", "line_hash"], "left").withColumn(
        "origin_turn", F.when(F.col("origin_turn") < F.col("turn"), F.col("origin_turn"))
    )
    parts = found.groupBy(*PASSAGE, "level", "origin_turn").agg(
        F.count("*").alias("n"),
        F.collect_list(F.struct("line_no", "form")).alias("forms"),
    )
    best = F.max_by("origin_turn", F.when(
        F.col("origin_turn").isNotNull(), F.struct("n", "origin_turn")))
    return parts.groupBy(*PASSAGE, "level").agg(
        F.sum("n").alias("n_lines"), best.alias("origin_turn"),
        F.xxhash64(F.array_join(F.transform(
            F.sort_array(F.flatten(F.collect_list("forms"))), lambda line: line["form"]
        ), " ")).alias("passage_hash"),
    )


def roots(bench: Workbench, parents: DataFrame) -> DataFrame:
    """``conv_id, turn, root_turn`` of the messages that answer another, by pointer jumping."""
    steps = bench.keep(parents.select("conv_id", "turn", F.col("parent_turn").alias("root_turn")))
    while True:
        onward = steps.select("conv_id", F.col("turn").alias("root_turn"),
                              F.col("root_turn").alias("further"))
        moved = bench.keep(steps.join(onward, ["conv_id", "root_turn"], "left"))
        if moved.where("further IS NOT NULL").isEmpty():
            return steps
        steps = moved.select("conv_id", "turn", F.coalesce("further", "root_turn")
                             .alias("root_turn"))


def without_quotes() -> Column:
    """``text`` of a message without quoted lines and attributions."""
    return F.expr(
        f"array_join(filter(lines, (line, i) -> NOT line RLIKE {sql_text(QUOTED)} "
        f"AND NOT {is_attribution()}), '\\n')"
    )


def rebuild(messages: DataFrame) -> DataFrame:
    """Every message, all columns, with its quotes cut out of ``text``, as ``message``.

    Beside it: ``n_quoted, n_passages, n_linked, parent_turn, root_turn``.
    """
    bench = Workbench(messages.sparkSession)
    linked = bench.keep(linked_passages(messages))
    answered = F.when(F.col("origin_turn").isNotNull(), F.struct("level", "passage"))
    counts = bench.keep(linked.groupBy(*MESSAGE).agg(
        F.sum("n_lines").alias("n_quoted"), F.count("*").alias("n_passages"),
        F.count("origin_turn").alias("n_linked"),
        F.min_by("origin_turn", answered).alias("parent_turn"),
    ))
    parents = counts.where("parent_turn IS NOT NULL").groupBy("conv_id", "turn") \
        .agg(F.min("parent_turn").alias("parent_turn"))
    threads = roots(bench, parents)
    notes = counts.join(threads, ["conv_id", "turn"], "left").select(F.struct("*").alias("note"))

    rows = messages.select(F.struct("*").alias("m"))
    joined = rows.join(
        notes,
        F.col("m.conv_id").eqNullSafe(F.col("note.conv_id"))
        & F.col("m.turn").eqNullSafe(F.col("note.turn"))
        & (F.xxhash64("m.text") == F.col("note.text_hash")), "left",
    ).withColumn("lines", F.split("m.text", "\n", -1))
    left = F.when(F.col("note").isNull(), F.col("m.text")).otherwise(without_quotes())
    parent = F.col("note.parent_turn")
    return joined.select(
        F.struct(*[(left if name == "text" else F.col("m").getField(name)).alias(name)
                   for name in messages.columns]).alias("message"),
        *[F.coalesce(f"note.{name}", F.lit(0)).cast("bigint").alias(name)
          for name in ("n_quoted", "n_passages", "n_linked")],
        parent.alias("parent_turn"),
        F.when(parent.isNull(), F.col("m.turn")).otherwise(F.col("note.root_turn"))
        .alias("root_turn"),
    )


def op1_quotation_linking(spark, sf_dir) -> DataFrame:
    """Every message without quotes, with what it quotes and answers."""
    return rebuild(spark.read.parquet(f"{sf_dir}/conversations.parquet")).select(
        "message.conv_id", "message.turn", "message.role", "message.text",
        "n_quoted", "n_passages", "n_linked", "parent_turn", "root_turn",
    )


ORACLE = r"""
WITH RECURSIVE split AS (
  SELECT conv_id, turn, role, text, string_split(text, chr(10)) AS lines FROM conversations
), lines AS (
  SELECT conv_id, turn, i - 1 AS line_no, lines[i] AS line,
    regexp_matches(lines[i], '^[ \t]*On .+ wrote:[ \t]*$')
      AND regexp_matches(coalesce(lines[i + 1], ''), '^[ \t]*>') AS attribution
  FROM (SELECT *, unnest(range(1, len(lines) + 1)) AS i FROM split)
), forms AS (
  SELECT conv_id, turn, line_no, line, attribution,
    regexp_matches(line, '^[ \t]*>') AS quoted,
    len(regexp_replace(regexp_extract(line, '^([ \t]*>)+'), '[^>]', '', 'g')) AS level,
    trim(regexp_replace(lower(regexp_replace(line, '^([ \t]*>)+', '')),
      '[^\p{L}\p{N}]+', ' ', 'g')) AS form
  FROM lines
), runs AS (
  SELECT *, line_no - row_number() OVER (PARTITION BY conv_id, turn, level ORDER BY line_no) AS run
  FROM forms WHERE quoted
), index AS (
  SELECT conv_id, form, min(turn) AS origin FROM forms
  WHERE NOT quoted AND NOT attribution AND form <> '' GROUP BY 1, 2
), parts AS (
  SELECT r.conv_id, turn, level, run, min(line_no) AS passage, count(*) AS n,
    CASE WHEN origin < turn THEN origin END AS origin
  FROM runs r LEFT JOIN index x ON r.conv_id = x.conv_id AND r.form = x.form
  GROUP BY ALL
), passages AS (
  SELECT conv_id, turn, level, run, min(passage) AS passage, sum(n) AS n_lines,
    (max((n, origin)) FILTER (origin IS NOT NULL))[2] AS origin
  FROM parts GROUP BY ALL
), counts AS (
  SELECT conv_id, turn, sum(n_lines) AS n_quoted, count(*) AS n_passages,
    count(origin) AS n_linked, arg_min(origin, (level, passage)) FILTER (origin IS NOT NULL)
      AS parent_turn
  FROM passages GROUP BY ALL
), threads AS (
  SELECT conv_id, turn, parent_turn AS root_turn FROM counts WHERE parent_turn IS NOT NULL
  UNION ALL
  SELECT t.conv_id, t.turn, c.parent_turn FROM threads t
  JOIN counts c ON c.conv_id = t.conv_id AND c.turn = t.root_turn AND c.parent_turn IS NOT NULL
), own AS (
  SELECT conv_id, turn, string_agg(line, chr(10) ORDER BY line_no) AS text
  FROM forms WHERE NOT quoted AND NOT attribution GROUP BY ALL
)
SELECT s.conv_id, s.turn, s.role,
  CASE WHEN c.conv_id IS NULL THEN s.text ELSE coalesce(o.text, '') END AS text,
  coalesce(n_quoted, 0)::BIGINT AS n_quoted, coalesce(n_passages, 0)::BIGINT AS n_passages,
  coalesce(n_linked, 0)::BIGINT AS n_linked, parent_turn,
  coalesce(r.root_turn, s.turn) AS root_turn
FROM split s LEFT JOIN counts c USING (conv_id, turn) LEFT JOIN own o USING (conv_id, turn)
LEFT JOIN (SELECT conv_id, turn, min(root_turn) AS root_turn FROM threads GROUP BY ALL) r
  USING (conv_id, turn)
"""
