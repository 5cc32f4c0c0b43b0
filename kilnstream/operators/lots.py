"""Work per lot: counts, payload hand-over to outside code, chart series.

One lot may hold a large share of all messages, so none of these brings a whole
lot into one task.  Every lot, whatever its size, is cut by one rule: what one
source partition holds of it in one range of ``RANGE`` offsets is a part, which
goes to one task, and there every ``chunk`` messages are a piece.  Offsets are
unique in a source partition, so a part is bounded.  Parts are counted and dealt to
tasks by their weight.  What outside code makes of the pieces is put together again
per lot.
"""

import functools
import heapq
import shutil
import subprocess
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from kilnstream import schemas
from kilnstream.functions import variants
from kilnstream.functions.text import quoted
from kilnstream.operators.alarms import with_minute
from kilnstream.operators.assets import Masters, alias_tags
from kilnstream.operators.cells import document_tags
from kilnstream.operators.once import once
from kilnstream.sources.shared import shared_folder

CHUNK = 100_000
RANGE = 1_000_000
# Results that are put together at a time.
RANGE_BLOCK = 64
# Messages that a task takes, and tasks for each core of a small input.
TASK_ROWS = 200_000
TASKS_PER_CORE = 2
# A part with this share of a task's messages, or more, is placed by its weight.
HEAVY = 4
# Rows of results given out at a time.
RESULT_ROWS = 10_000

PART = ["lot_no", "topic", "partition", "offset_range"]
PIECE = [*PART, "piece"]
PIECE_SCHEMA = "lot_no string, topic string, partition int, offset_range bigint, piece bigint"
ROW = "_row"

# Field end of piped lines; no JSON text has it.
FIELD_END = "\\u0001"

PieceFunction = Callable[[pd.DataFrame], pd.DataFrame]


def count_by(messages: DataFrame, key: str) -> DataFrame:
    return messages.groupBy(key).agg(F.count("*").alias("n"))


def lot_payloads(messages: DataFrame) -> DataFrame:
    """Repaired, unenriched message texts by lot."""
    return messages.select("lot_no", *schemas.MESSAGE_KEY, "timestamp", "payload")


def packed(weights: list[tuple[int, int]], bins: int) -> dict[int, int]:
    """The bin of every (key, weight): the heaviest first, each to the lightest bin so far."""
    filled = [(0, number) for number in range(bins)]
    found = {}
    for key, weight in sorted(weights, key=lambda row: (-row[1], row[0])):
        held, number = heapq.heappop(filled)
        found[key] = number
        heapq.heappush(filled, (held + weight, number))
    return found


def _placed(rows: DataFrame, key: Column, task_rows: int) -> tuple[DataFrame, int]:
    """Rows with ``_task``, where all rows of a key are, and the number of tasks.

    Tasks are as many as the rows need, and enough for all cores.  Keys that would
    take a good share of a task are packed by weight on the driver: there are at
    most ``HEAVY`` of them for each task.  The many light ones are dealt by hash.
    """
    spark = rows.sparkSession
    keyed = rows.withColumn("_key", key)
    counted = keyed.groupBy("_key").agg(F.count("*").alias("n")).persist()
    try:
        total, n_keys = counted.agg(F.sum("n"), F.count("*")).first()
        total = total or 0
        cores = spark.sparkContext.defaultParallelism
        tasks = max(1, min(n_keys, max(-(-total // task_rows), TASKS_PER_CORE * cores)))
        heavy = counted.where(F.col("n") * tasks * HEAVY >= total).collect() if n_keys else []
    finally:
        counted.unpersist()
    weight = sum(row["n"] for row in heavy)
    bins = min(len(heavy), max(1, round(tasks * weight / total))) if heavy else 0
    rest = max(1, tasks - bins) if len(heavy) < n_keys else 0
    where = packed([(row["_key"], row["n"]) for row in heavy], bins) if bins else {}
    places = spark.createDataFrame(list(where.items()), "_key bigint, _heavy int")
    hashed = F.pmod(F.col("_key"), F.lit(max(rest, 1))) + bins
    return (
        keyed.join(F.broadcast(places), "_key", "left")
        .withColumn("_task", F.coalesce("_heavy", hashed.cast("int"))).drop("_key", "_heavy"),
        max(bins + rest, 1),
    )


def _parts(messages: DataFrame) -> DataFrame:
    """Payloads by lot and offset range, each part in one task and in arrival order."""
    rows = lot_payloads(messages).withColumn("offset_range", F.expr(f"`offset` div {RANGE}"))
    placed, tasks = _placed(rows, F.xxhash64(*PART), TASK_ROWS)
    return (
        placed.repartitionById(tasks, "_task").drop("_task")
        .sortWithinPartitions(*PART, "offset")
    )


def _starts(batch: pa.RecordBatch, names: list[str]) -> np.ndarray:
    """Rows whose key differs from the row before; missing values are equal to each other."""
    changed = np.zeros(batch.num_rows, bool)
    changed[:1] = True
    for name in names:
        codes = batch.column(name).dictionary_encode(null_encoding="encode")
        changed[1:] |= np.diff(codes.indices.to_numpy(zero_copy_only=False)) != 0
    return np.flatnonzero(changed)


def _runs(batches: Iterator[pa.RecordBatch], names: list[str]):
    """Key and rows of each run of equal keys in a batch; a run may go on in the next one."""
    for batch in batches:
        starts = _starts(batch, names).tolist()
        frame = batch.to_pandas()
        keys = zip(*(batch.column(name).take(pa.array(starts, pa.int64())).to_pylist()
                     for name in names), strict=True)
        for key, first, last in zip(keys, starts, [*starts[1:], batch.num_rows], strict=True):
            yield key, frame.iloc[first:last]


class _Results:
    """Results of outside code under their keys, given out as Arrow batches."""

    def __init__(self, names: list[str], schema: pa.Schema):
        self.names, self.schema, self.keys, self.frames, self.rows = names, schema, [], [], 0

    def add(self, key: tuple, frame: pd.DataFrame) -> Iterator[pa.RecordBatch]:
        self.keys.append(key)
        self.frames.append(frame)
        self.rows += len(frame)
        if self.rows >= RESULT_ROWS or len(self.frames) >= RESULT_ROWS:
            yield from self.given()

    def given(self) -> Iterator[pa.RecordBatch]:
        if self.frames:
            sizes = np.array([len(frame) for frame in self.frames])
            number = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            own = pd.concat(self.frames, ignore_index=True)
            repeated = np.repeat(np.arange(len(sizes)), sizes)
            columns = []
            for field in self.schema:
                if field.name == ROW:
                    columns.append(pa.array(number, field.type))
                elif field.name in self.names:
                    place = self.names.index(field.name)
                    values = pa.array([key[place] for key in self.keys], field.type)
                    columns.append(values.take(pa.array(repeated)))
                else:
                    columns.append(pa.Array.from_pandas(own[field.name], type=field.type))
            yield pa.RecordBatch.from_arrays(columns, schema=self.schema)
        self.keys, self.frames, self.rows = [], [], 0


def _by_piece(
    messages: DataFrame, function: PieceFunction, schema: str, chunk: int,
    combine: PieceFunction | None = None, numbered: bool = True,
) -> DataFrame:
    """What ``function`` makes of every piece, or ``combine`` of the pieces of every part.

    Pieces that are not ``numbered`` come without ``piece``, under the index of their batch.
    """
    if chunk < 1:
        raise ValueError("chunk must be positive")
    kept = f"{PIECE_SCHEMA}, {ROW} bigint, {schema}"
    parts = _parts(messages)
    arrow = to_arrow_schema(StructType.fromDDL(kept))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        results = _Results(PIECE, arrow)
        held, key, piece, made = None, None, 0, []

        def call(rows: pd.DataFrame):
            nonlocal piece
            out = function(rows.reset_index(drop=True).assign(piece=piece) if numbered else rows)
            if combine is None:
                yield from results.add((*key, piece), out)
            else:
                made.append(out)
                if len(made) >= RANGE_BLOCK:
                    made[:] = [combine(pd.concat(made, ignore_index=True))]
            piece += 1

        def close():
            nonlocal held, piece
            if held is not None:
                yield from call(held)
            if made:
                whole = made[0] if len(made) == 1 else combine(pd.concat(made, ignore_index=True))
                yield from results.add((*key, 0), whole)
                made.clear()
            held, piece = None, 0

        for own, rows in _runs(batches, PART):
            if own != key:
                yield from close()
                key = own
            if held is not None:
                rows = pd.concat([held, rows])
            while len(rows) > chunk:
                yield from call(rows.iloc[:chunk])
                rows = rows.iloc[chunk:]
            held = rows
        yield from close()
        yield from results.given()

    return parts.mapInArrow(run, kept)


def apply_to_lots(
    messages: DataFrame,
    function: PieceFunction,
    combine: PieceFunction,
    schema: str,
    chunk: int = CHUNK,
) -> DataFrame:
    """Rows of ``lot_no`` and ``schema``: what ``combine`` makes of a lot's pieces.

    ``function`` gets a piece (``lot_no, topic, partition, offset, timestamp, payload``
    and more), messages in arrival order, and returns rows of ``schema``.  ``combine``
    gets such rows of neighbouring pieces, or its own results for them, in order, and
    returns rows of ``schema`` again; few, because a lot's meet in one task, where they
    are put together as they come in.  A lot in several source
    partitions is ordered by topic and partition, missing ones first.
    """
    pieces = _by_piece(messages, function, schema, chunk, combine)
    made = f"lot_no string, {schema}"
    arrow = to_arrow_schema(StructType.fromDDL(made))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        results = _Results(["lot_no"], arrow)
        held, key = [], None

        def close():
            if held:
                yield from results.add(key, combine(pd.concat(held, ignore_index=True)))
                held.clear()

        for own, rows in _runs(batches, ["lot_no"]):
            if own != key:
                yield from close()
                key = own
            held.append(rows.drop(columns=[*PIECE, ROW]))
            if sum(map(len, held)) >= RANGE_BLOCK:
                held[:] = [combine(pd.concat(held, ignore_index=True))]
        yield from close()
        yield from results.given()

    tasks = TASKS_PER_CORE * messages.sparkSession.sparkContext.defaultParallelism
    tasks = max(tasks, int(messages.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return (
        pieces.repartition(tasks, "lot_no").sortWithinPartitions(*PIECE, ROW).mapInArrow(run, made)
    )


@functools.cache
def _found(program: str) -> str:
    """The program's file, looked for once and not at every start."""
    return shutil.which(program) or program


def _output(command: list[str], text: str, seconds: float | None) -> tuple[list[str], str | None]:
    """Lines of a command and what went wrong, if anything did."""
    try:
        done = subprocess.run(command, input=text.encode(), capture_output=True, timeout=seconds,
                              executable=_found(command[0]), close_fds=False)
    except subprocess.TimeoutExpired:
        return [], f"stopped after {seconds} s"
    except OSError as error:
        return [], f"not started: {error}"
    lines = done.stdout.decode(errors="replace").split("\n")
    if lines[-1] == "":
        lines.pop()
    failed = f"exit {done.returncode}: {done.stderr.decode(errors='replace')}"
    return lines, failed if done.returncode else None


def run_on_lots(
    messages: DataFrame, command: list[str], chunk: int = CHUNK, seconds: float | None = None,
    kept: bool = False,
) -> DataFrame:
    """Start ``command`` for every piece of every lot, payloads on its input.

    Its output lines become rows, numbered along the lot.  A command that fails,
    cannot be started or takes longer than ``seconds`` becomes a row with ``error``
    set and does not stop the others.  The lines are written down, so that no
    command runs again to number them.  Payloads are kept on disk between the count of
    the parts and the commands, unless the messages are ``kept`` already.
    """
    def run(piece: pd.DataFrame) -> pd.DataFrame:
        lines, failed = _output(command, "".join(x + "\n" for x in piece["payload"]), seconds)
        out = pd.DataFrame({"line": pd.Series(lines, dtype=object), "error": None})
        if failed:
            out.loc[len(out)] = [None, failed]
        return out

    one_line = lot_payloads(messages).withColumn("payload", F.translate("payload", "\r\n", "  "))
    if not kept:
        one_line = one_line.persist(StorageLevel.DISK_ONLY)
    try:
        found = _by_piece(one_line, run, "line string, error string", chunk, numbered=False)
        folder = shared_folder(messages.sparkSession)
        found.write.parquet(folder)
    finally:
        if not kept:
            one_line.unpersist()
    lines = messages.sparkSession.read.schema(found.schema).parquet(folder)

    earlier = Window.partitionBy("lot_no").orderBy(*PIECE[1:]).rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = (
        lines.groupBy(*PIECE).agg(F.count("line").alias("n"))
        .select(*[F.col(name).alias(f"_{name}") for name in PIECE],
                F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    )
    same = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in PIECE]
    return lines.join(starts, same).withColumn("line_no", F.col("start") + F.col(ROW)).select(
        *PIECE, "line_no", "line", "error"
    )


def pipe_lots(messages: DataFrame, command: str) -> DataFrame:
    """Pipe ``lot<TAB>payload`` lines through ``command``, one process per task.

    A task gets whole offset ranges of lots, each in arrival order; lines go from the JVM to the
    command and back.  A failing command fails its task.
    """
    lines = _parts(messages).select(
        F.concat_ws("\t", "lot_no", F.translate("payload", "\r\n", "  ")).alias("line")
    )
    form = f"ROW FORMAT DELIMITED FIELDS TERMINATED BY '{FIELD_END}'"
    return messages.sparkSession.sql(
        f"SELECT TRANSFORM(line) {form} USING {quoted(command)} AS (line STRING) {form} "
        "FROM {lines}", lines=lines,
    )


def chart_series(
    messages: DataFrame, masters: Masters, widen_ints: bool = False
) -> DataFrame:
    """Per lot, minute and alias: count, least, greatest and last DOUBLE value.

    An alias shows the tag that owns its wide column.  Combined before the shuffle,
    so a large lot costs its own tasks only.
    """
    return chart_partials(messages, masters, widen_ints).drop("last_order")


def chart_partials(
    messages: DataFrame, masters: Masters, widen_ints: bool = False
) -> DataFrame:
    """Chart series of some of a lot's messages, with the arrival of the last value."""
    owners = masters.tags.narrowed(alias_tags(masters.tags.frame))
    pairs = document_tags(with_minute(messages), owners)
    numbered = once(pairs, number=variants.double_value("value", "value_schema", widen_ints))
    points = numbered.where("number IS NOT NULL").withColumnRenamed("minute_key", "minute")
    return points.groupBy("lot_no", "minute", "alias").agg(
        F.count("*").alias("n"),
        F.min("number").alias("min_val"),
        F.max("number").alias("max_val"),
        F.max_by("number", F.struct(*schemas.ARRIVAL)).alias("last_val"),
        F.max(F.struct(*schemas.ARRIVAL)).alias("last_order"),
    )


def combined_charts(partials: DataFrame) -> DataFrame:
    """The chart series of all messages from those of their batches."""
    return partials.groupBy("lot_no", "minute", "alias").agg(
        F.sum("n").alias("n"), F.min("min_val").alias("min_val"), F.max("max_val").alias("max_val"),
        F.max_by("last_val", "last_order").alias("last_val"),
    )
