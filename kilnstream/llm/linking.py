"""Groups of linked rows, and lineage cuts between the steps that find them."""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kilnstream.sources.shared import shared_folder


class Workbench:
    """Tables of one run in a fresh folder that driver and executors share."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = shared_folder(spark)

    def keep(self, rows: DataFrame) -> DataFrame:
        """The rows, written down: nothing before them runs again, whatever is lost."""
        place = f"{self.folder}/{uuid.uuid4().hex}"
        rows.write.parquet(place)
        return self.spark.read.schema(rows.schema).parquet(place)


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first())


def components(bench: Workbench, edges: DataFrame) -> DataFrame:
    """``node, component`` of every node of the edges ``a, b``; the least node names the group.

    Large-star and small-star steps in turn, each a minimum by node combined
    before the shuffle and a join, until nothing changes: every node then points
    to the least of its group.  No group is ever gathered in one place.
    """
    edges = bench.keep(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    before = None
    while (now := _fingerprint(edges)) != before:
        before = now
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("least"))
        edges = bench.keep(
            both.where("b > a").join(least, "a")
            .select(F.col("b").alias("a"), F.col("least").alias("b"))
            .distinct()
        )
        least = edges.groupBy("a").agg(F.min("b").alias("least"))
        edges = bench.keep(
            edges.join(least, "a")
            .select(F.explode(F.array(F.struct("a", F.col("least").alias("b")),
                                      F.struct(F.col("b").alias("a"), F.col("least").alias("b"))))
                    .alias("edge"))
            .select("edge.*").where("a <> b").distinct()
        )
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
