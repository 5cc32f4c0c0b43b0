"""Which offsets are written: merged intervals per source partition.

A batch need not cover consecutive offsets, so a ledger of intervals, not one
number per source partition, tells what a replay may leave out.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kilnstream.operators.lookup import join_lookup, measure

SOURCE = ["topic", "partition"]
# Offsets that are looked at together, and those of one mask.
SPAN = 100_000
BLOCK_BITS = 6
BLOCK = 1 << BLOCK_BITS


def _span(offset: str) -> Column:
    """Number of the span that an offset lies in, below zero too."""
    return F.expr(f"{offset} div {SPAN} - IF({offset} % {SPAN} < 0, 1, 0)")


def covered(messages: DataFrame) -> DataFrame:
    """``topic, partition, min_offset, max_offset``: runs of consecutive offsets."""
    places = (
        messages.where("`offset` IS NOT NULL").select(*SOURCE, "offset").distinct()
        .withColumn("span", _span("`offset`"))
    )
    in_order = Window.partitionBy(*SOURCE, "span").orderBy("offset")
    runs = (
        places.withColumn("run", F.col("offset") - F.row_number().over(in_order))
        .groupBy(*SOURCE, "span", "run")
        .agg(F.min("offset").alias("min_offset"), F.max("offset").alias("max_offset"))
        .drop("run")
    )
    return _across_spans(runs)


def merged(intervals: DataFrame) -> DataFrame:
    """Intervals that touch or overlap as one."""
    in_order = Window.partitionBy(*SOURCE, "span").orderBy("min_offset", "max_offset")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, -1)
    apart = F.col("reach").isNull() | (F.col("min_offset") > F.col("reach") + 1)
    of_span = (
        intervals.where("min_offset IS NOT NULL").withColumn("span", _span("min_offset"))
        .withColumn("reach", F.max("max_offset").over(so_far))
        .withColumn("number", F.sum(apart.cast("int")).over(in_order))
        .groupBy(*SOURCE, "span", "number")
        .agg(F.min("min_offset").alias("min_offset"), F.max("max_offset").alias("max_offset"))
        .drop("number")
    )
    return _across_spans(of_span)


def _across_spans(intervals: DataFrame) -> DataFrame:
    """Intervals that lie apart within the ``span`` they begin in, merged across spans.

    Only the spans of a source partition, not its intervals, are put in order together:
    ``reach`` is how far those before a span go, ``begin`` where the last run of them begins.
    """
    earlier = Window.partitionBy(*SOURCE).orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = (
        intervals.groupBy(*SOURCE, "span")
        .agg(F.max("max_offset").alias("top"), F.max("min_offset").alias("last"))
        .withColumn("reach", F.max("top").over(earlier))
        .withColumn("own", F.expr("IF(reach IS NULL OR last > reach + 1, last, NULL)"))
        .withColumn("begin", F.max("own").over(earlier))
        .select(*[F.col(name).alias(f"_{name}") for name in (*SOURCE, "span")], "reach", "begin")
    )
    same = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in (*SOURCE, "span")]
    return (
        intervals.join(spans, same)
        .withColumn("begin", F.expr("IF(reach IS NULL OR min_offset > reach + 1, min_offset, begin)"))
        .groupBy(*SOURCE, "begin")
        .agg(F.min("min_offset").alias("min_offset"), F.max("max_offset").alias("max_offset"))
        .drop("begin")
    )


def outside(messages: DataFrame, done: DataFrame) -> DataFrame:
    """Messages whose offset lies in no interval of ``done``; these may touch or overlap.

    Only the parts of the intervals in spans that the messages touch are joined to
    them, as one mask for each ``BLOCK`` offsets.  A message without a position cannot
    have been recorded and stays.
    """
    block = F.expr(f"shiftright(`offset`, {BLOCK_BITS})")
    touched = messages.select(*SOURCE, _span("`offset`").alias("_span")).distinct()
    masks = (
        done.where("min_offset IS NOT NULL")
        .withColumn("_first", _span("min_offset")).withColumn("_last", _span("max_offset"))
        .withColumn("_span", F.expr("explode(sequence(_first, _last))"))
        .join(touched, [*SOURCE, "_span"], "left_semi")
        .withColumn("_low", F.expr(f"greatest(min_offset, _span * {SPAN})"))
        .withColumn("_high", F.expr(f"least(max_offset, _span * {SPAN} + {SPAN - 1})"))
        .withColumn("_block", F.expr(f"explode(sequence(shiftright(_low, {BLOCK_BITS}), "
                                     f"shiftright(_high, {BLOCK_BITS})))"))
        .withColumn("_from", F.expr(f"CAST(greatest(_low - _block * {BLOCK}, 0) AS INT)"))
        .withColumn("_to", F.expr(f"CAST(least(_high - _block * {BLOCK}, {BLOCK - 1}) AS INT)"))
        .groupBy(*SOURCE, "_block").agg(F.expr(
            f"bit_or(shiftleft(shiftrightunsigned(-1L, {BLOCK - 1} - _to + _from), _from))"
        ).alias("_done"))
    )
    [lookup] = measure(masks)
    marked = join_lookup(
        messages.withColumn("_block", block), lookup, [*SOURCE, "_block"], "left")
    written = f"bit_get(_done, CAST(`offset` & {BLOCK - 1} AS INT)) = 1"
    return marked.where(f"NOT coalesce({written}, false)").select(*messages.columns)
