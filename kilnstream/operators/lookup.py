"""Joining a message stream to a master of checked size.

Messages are keyed by machine, and one machine may send a third of them.  A
master that fits the limit is broadcast, so the messages never move.  A larger
one is joined by a shuffle.  Machines with more than one ``SALTS``-th of the messages
are counted out first; their messages are spread by as many salts as their share asks
for, and only their master rows are repeated, once per salt.
"""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kilnstream import schemas
from kilnstream.functions.text import name

# Largest master that is broadcast, by measured bytes.
BROADCAST_LIMIT = 64 * 1024 * 1024
SALTS = 64
# Allowance for row and field overhead in memory.
FIELD_OVERHEAD = 16


@dataclass(frozen=True)
class Lookup:
    """A master frame with its measured size."""

    frame: DataFrame
    n_bytes: int

    def narrowed(self, frame: DataFrame) -> "Lookup":
        """A projection or filter of the same rows: the size stays an upper bound."""
        return Lookup(frame, self.n_bytes)

    def widened(self, frame: DataFrame, extra_bytes: int) -> "Lookup":
        """The same rows rearranged, with at most ``extra_bytes`` more."""
        return Lookup(frame, self.n_bytes + extra_bytes)

    @property
    def most_rows(self) -> int:
        """An upper bound of the number of rows: every row has at least one field."""
        return self.n_bytes // FIELD_OVERHEAD


def _row_bytes(frame: DataFrame) -> str:
    widths = [str(FIELD_OVERHEAD * len(frame.columns))]
    for field in frame.schema.fields:
        column = name(field.name)
        if isinstance(field.dataType, T.StringType):
            widths.append(f"coalesce(octet_length({column}), 0)")
        elif not isinstance(field.dataType, T.AtomicType):
            widths.append(f"coalesce(octet_length(to_json(struct({column}))), 0)")
    return f"CAST({' + '.join(widths)} AS BIGINT)"


def measure(*frames: DataFrame) -> list[Lookup]:
    """Sizes of frames, by one job over all of them."""
    sizes = reduce(DataFrame.unionAll, [
        frame.selectExpr(f"{i} AS i", f"coalesce(sum({_row_bytes(frame)}), 0) AS n_bytes")
        for i, frame in enumerate(frames)
    ])
    n_bytes = {row["i"]: row["n_bytes"] for row in sizes.collect()}
    return [Lookup(frame, n_bytes[i]) for i, frame in enumerate(frames)]


def join_lookup(
    rows: DataFrame,
    lookup: Lookup,
    keys: list[str],
    how: str = "inner",
    limit: int = BROADCAST_LIMIT,
    salts: int = SALTS,
) -> DataFrame:
    """Join messages (with their message key) to a master on ``keys``."""
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join {how!r}")
    if lookup.n_bytes <= limit:
        return rows.join(F.broadcast(lookup.frame), keys, how)
    hot = hot_keys(rows, keys, salts)
    return _with_salts(rows, hot, keys).withColumn(
        "_salt", F.pmod(F.xxhash64(*schemas.MESSAGE_KEY), F.col("_salts"))
    ).drop("_salts").join(salted_copies(lookup.frame, hot, keys), [*keys, "_salt"], how) \
        .drop("_salt")


def hot_keys(rows: DataFrame, keys: list[str], salts: int) -> DataFrame:
    """Keys with more than one ``salts``-th of the rows, fewer than ``salts`` of them.

    ``_salts`` tells over how many places a key's rows should be spread.  Counts are
    combined before the shuffle, so a hot key is no hot task here.
    """
    spark = rows.sparkSession
    counted = rows.groupBy(*keys).agg(F.count("*").alias("n")).persist()
    try:
        total = counted.agg(F.sum("n")).first()[0] or 0
        found = counted.where(F.col("n") * salts > total).collect()
        schema = T.StructType([*counted.select(*keys).schema.fields,
                               T.StructField("_salts", T.LongType())])
    finally:
        counted.unpersist()
    return spark.createDataFrame(
        [(*row[:-1], -(-row["n"] * salts // total)) for row in found], schema)


def _with_salts(rows: DataFrame, hot: DataFrame, keys: list[str]) -> DataFrame:
    one = F.coalesce("_salts", F.lit(1).cast("bigint"))
    return rows.join(F.broadcast(hot), keys, "left").withColumn("_salts", one)


def salted_copies(master: DataFrame, hot: DataFrame, keys: list[str]) -> DataFrame:
    """Master rows with ``_salt``: those of hot keys once per salt, the others once."""
    salt = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_salts") - 1))
    return _with_salts(master, hot, keys).withColumn("_salt", salt).drop("_salts")
