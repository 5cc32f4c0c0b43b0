"""Message sources: a broker topic, or files with the same columns."""

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kilnstream import schemas
from kilnstream.operators.messages import message_text
from kilnstream.sinks.ledger import SOURCE, merged


def broker_stream(
    spark: SparkSession, servers: str, topic: str, starting_offsets: str = "earliest", **options
) -> DataFrame:
    """A topic as a stream of messages with their positions."""
    reader = spark.readStream.format("kafka").options(**options)
    return _positioned(
        reader.option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .load()
    )


def broker_range(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting_offsets: str = "earliest",
    ending_offsets: str = "latest",
    **options,
) -> DataFrame:
    """A bounded range of a topic, for backfill with the batch plans."""
    reader = spark.read.format("kafka").options(**options)
    return _positioned(
        reader.option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("endingOffsets", ending_offsets)
        .load()
    )


def file_stream(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Parquet files of messages as a stream."""
    reader = spark.readStream.schema(schemas.MESSAGE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def _positioned(rows: DataFrame) -> DataFrame:
    return message_text(rows).select(*schemas.MESSAGE.names)


def without_repeats(stream: DataFrame, delay: str) -> DataFrame:
    """Each message once, though the source sends some again within ``delay``.

    A message is known by its position, one without a position by its time and text.
    Keys are kept until the newest message is ``delay`` later; one that comes later than
    that is dropped, so the state is bounded and ``delay`` must cover the source's lateness.
    """
    unplaced = F.expr(" OR ".join(f"`{name}` IS NULL" for name in schemas.MESSAGE_KEY))
    own = F.when(unplaced, F.sha2(F.to_json(F.struct("timestamp", "value")).cast("binary"), 256))
    return (
        stream.withColumn("_own", own).withWatermark("timestamp", delay)
        .dropDuplicatesWithinWatermark([*schemas.MESSAGE_KEY, "_own"])
        .drop("_own")
    )


def starting_offsets(intervals: list[tuple[str, int, int]]) -> str:
    """``startingOffsets`` of a broker source that goes on after committed offsets.

    ``intervals`` are (topic, partition, greatest committed offset).
    """
    starts: dict[str, dict[str, int]] = {}
    for topic, partition, greatest in intervals:
        own = starts.setdefault(topic, {})
        own[str(partition)] = max(own.get(str(partition), 0), greatest + 1)
    return json.dumps(starts, sort_keys=True)


def resume_offsets(commits: DataFrame) -> str:
    """``starting_offsets`` of a job's commits: before the first gap of every source partition.

    What lies behind a gap is read again; ``drop_replayed`` leaves out what is written.
    """
    first = merged(commits).groupBy(*SOURCE).agg(
        F.min_by("max_offset", "min_offset").alias("greatest"))
    return starting_offsets([tuple(row) for row in first.collect()])
