"""Parallelism of narrow scans, and of batches that are kept."""

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Text of the messages of a partition that is parsed and kept; parsed it is about five times as much.
TASK_BYTES = 32 * 1024 * 1024
# Text that a core parses in less time than a shuffle takes.
LITTLE_BYTES = 2 * 1024 * 1024
# How many times the time of busy cores a step may take before a shuffle is worth it.
MOST_IDLE = 1.25


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows over all cores when their scan would keep most cores idle.

    Parsing costs far more than reading here, so a scan of one or a few files
    is worth a shuffle of its raw rows.  A scan with enough partitions, which
    any large input has, is left as it is.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    if 2 * rows.rdd.getNumPartitions() > cores:
        return rows
    return rows.repartition(cores, *keys)


def bounded(messages: DataFrame) -> DataFrame:
    """Messages in partitions that are bounded and keep all cores busy."""
    return bounded_batch(messages)[0]


def bounded_batch(messages: DataFrame) -> tuple[DataFrame, StorageLevel]:
    """Messages in partitions of at most about ``TASK_BYTES`` of text, which keep all cores busy.

    Also where to keep what is made of them: on disk only if they are more than ``TASK_BYTES`` for
    each core, so that an executor's memory does not grow with the batch.

    A source's partitions are bounded by compressed bytes or row groups, and a kept batch is read
    again partition by partition.  Messages that lie in small enough partitions stay there, unless
    cores would be idle for long, because these are few or uneven.  Others are dealt to a whole
    number of partitions for every core, so that no step ends with a few tasks and idle cores.
    """
    sizes = messages.groupBy(F.spark_partition_id()).agg(
        F.sum(F.octet_length("value") + 64).alias("n_bytes"))
    most, total, n = sizes.agg(F.max("n_bytes"), F.sum("n_bytes"), F.count("n_bytes")).first()
    if most is None:
        return messages, StorageLevel.MEMORY_AND_DISK_DESER
    cores = messages.sparkSession.sparkContext.defaultParallelism
    longest = min(-(-n // cores) * most, total / cores + most)  # bytes that one core goes through
    idle = most > LITTLE_BYTES and longest * cores > MOST_IDLE * total
    rounds = -(-total // (TASK_BYTES * cores))
    level = StorageLevel.MEMORY_AND_DISK_DESER if rounds < 2 else StorageLevel.DISK_ONLY
    if most <= 2 * TASK_BYTES and not idle:
        return messages, level
    return messages.repartition(rounds * cores, *messages.columns), level
