"""Hard negatives by a multiway hyperplane tree whose split points know their siblings' distances.

Vectors of whole numbers get one more component that makes all of them equally long; a
larger inner product with an anchor then means a smaller distance, and a window of
scores is an annulus around the anchor (which has 0 as the further component).

1. The tree's split points come from a sample of at most ``SAMPLE`` rows.  A node has up
   to ``ARITY`` of them, far from each other; every row goes to the nearest, ``LEVELS``
   times, which makes leaves.  All rows are dealt to leaves, and for every split point
   and every sibling subtree the least and greatest distance of its rows is taken over
   all rows (an aggregate; the tree has a bounded number of such ranges).
2. A search knows a window of scores.  At each node it leaves out every sibling whose
   range from some split point does not meet the annulus as seen from there.
3. The leaves left are searched exactly: blocks of rows of a leaf against blocks of
   anchors.  A leaf of any size is many blocks, so equal vectors are no hot task.

Every search has two rounds: in the first, one leaf gives ``k`` rows, whose last score
narrows the window for the others.  The first searches find an anchor's positives, the
second ones the negatives below each positive.  The results are exact.

* rows with a null id, label or vector, or with a null or non-finite component take no
  part, nor do vectors with a component beyond ``MOST``, whose scores are no exact numbers;
* rows that share an id count once, with the least label and then the least vector;
* a shorter vector has zeros for what it lacks; an empty one scores 0 with all;
* ties go to the smaller id; an anchor without rows of its label has no result;
* an empty table gives an empty one; other columns are not looked at.
"""

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kilnstream.llm.linking import Workbench

#: Rows from which split points are chosen, those of a node, and the tree's depth.
SAMPLE, ARITY, LEVELS = 4096, 12, 2
#: Rows and searches of a block.
ROW_BLOCK, SEARCH_BLOCK = 8192, 8192
#: Searches whose scores with a block of rows are held at once.
AT_ONCE = 256
#: Greatest size of a component times 256.
MOST = 1 << 27
#: Relative allowance for rounding where distances are compared.
SLACK = 1e-6


class Node(NamedTuple):
    """Split points of a node, as lifted vectors; children by split point, none in a last node."""

    number: int
    points: np.ndarray
    children: list


class Tree(NamedTuple):
    """All nodes, the common length of lifted vectors, and the leaves' first number."""

    root: Node | None
    square: float
    width: int
    n_leaves: int


def scored_type(most: int, width: int) -> type:
    """Floats where all scores are whole numbers below 2**53, else 64-bit integers."""
    return np.float64 if max(width, 1) * most * most < 1 << 53 else np.int64


def padded(column: pa.ListArray, width: int) -> np.ndarray:
    """Vectors as rows of a matrix, filled up with zeros."""
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy()
    sizes = np.diff(offsets)
    out = np.zeros((len(sizes), width), np.int64)
    place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[np.repeat(np.arange(len(sizes)), sizes), place] = values[offsets[0]:offsets[-1]]
    return out


def lifted(vectors: np.ndarray, square: float) -> np.ndarray:
    """The vectors with the component that makes all of them equally long."""
    vectors = vectors.astype(np.float64)
    rest = np.maximum(square - np.einsum("ij,ij->i", vectors, vectors), 0)
    return np.hstack([vectors, np.sqrt(rest)[:, None]])


def distances(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    squares = np.einsum("ij,ij->i", rows, rows)[:, None] + np.einsum("ij,ij->i", points, points)
    return np.sqrt(np.maximum(squares - 2 * (rows @ points.T), 0))


def plant(sample: np.ndarray, square: float, width: int, arity: int, levels: int) -> Tree:
    """The tree of split points of a sample; the same sample gives the same tree."""
    counts = {"nodes": 0, "leaves": 0}

    def grow(rows: np.ndarray, level: int) -> Node | int:
        if level == levels or not len(rows):
            counts["leaves"] += 1
            return counts["leaves"] - 1
        chosen, nearest = [0], distances(rows, rows[:1])[:, 0]
        while len(chosen) < min(arity, len(rows)) and nearest.max() > 0:
            chosen.append(int(nearest.argmax()))
            nearest = np.minimum(nearest, distances(rows, rows[chosen[-1:]])[:, 0])
        points = rows[chosen]
        number, counts["nodes"] = counts["nodes"], counts["nodes"] + 1
        home = distances(rows, points).argmin(axis=1)
        return Node(number, points, [grow(rows[home == n], level + 1) for n in range(len(points))])

    root = grow(lifted(sample, square), 0)
    return Tree(root if isinstance(root, Node) else None, square, width, max(counts["leaves"], 1))


def homes(tree: Tree, rows: np.ndarray, seen=None) -> np.ndarray:
    """The leaf of every lifted row.  ``seen(node, child, distances)`` is told of each step."""
    leaf = np.zeros(len(rows), np.int64)

    def descend(node: Node | int, own: np.ndarray):
        if not isinstance(node, Node):
            leaf[own] = node
        elif len(own):
            apart = distances(rows[own], node.points)
            home = apart.argmin(axis=1)
            for child in np.unique(home):
                inside = home == child
                if seen is not None:
                    seen(node.number, int(child), apart[inside])
                descend(node.children[child], own[inside])

    if tree.root is not None:
        descend(tree.root, np.arange(len(rows)))
    return leaf


def surviving(tree: Tree, ranges: dict, around: np.ndarray, low: np.ndarray, high: np.ndarray):
    """Pairs of search and leaf that the ranges do not rule out.

    ``around`` are the searches' centres, ``low`` and ``high`` the radii of their annuli.
    """
    pairs = []
    allowance = SLACK * (np.sqrt(tree.square) + 1)

    def descend(node: Node | int, own: np.ndarray):
        if not len(own):
            return
        if not isinstance(node, Node):
            pairs.append((own, np.full(len(own), node)))
            return
        to_points = distances(around[own], node.points)
        for child, below in enumerate(node.children):
            open_ones = np.ones(len(own), bool)
            for point in range(len(node.points)):
                least, greatest = ranges.get((node.number, child, point), (np.inf, -np.inf))
                nearest = np.maximum(to_points[:, point] - high[own], low[own] - to_points[:, point])
                open_ones &= (nearest <= greatest + allowance) \
                    & (to_points[:, point] + high[own] >= least - allowance)
            descend(below, own[open_ones])

    if tree.root is None:
        descend(0, np.arange(len(around)))
    else:
        descend(tree.root, np.arange(len(around)))
    if not pairs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([own for own, _ in pairs]), np.concatenate([leaf for _, leaf in pairs])


def usable(rows: DataFrame) -> DataFrame:
    """``vec_id, label, vector`` of the rows that take part, in whole numbers."""
    fit = F.expr(
        "forall(embedding, x -> x IS NOT NULL AND NOT isnan(x)"
        f" AND abs(floor(256 * CAST(x AS double))) <= {MOST})")
    relabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = F.expr("transform(embedding, x -> CAST(floor(256 * CAST(x AS double)) AS int))")
    return (
        rows.select("vec_id", "label", "embedding")
        .where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").where(fit)
        .select("vec_id", relabelled.cast("bigint").alias("label"), whole.alias("vector"))
        .groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("least"))
        .select("vec_id", "least.*")
    )


class Index:
    """The tree over a table, its rows by leaf and block, and the ranges of its subtrees."""

    def __init__(self, bench: Workbench, rows: DataFrame, sample: int, arity: int, levels: int):
        self.bench, self.rows = bench, rows
        sizes = rows.agg(
            F.count("*"), F.max(F.size("vector")),
            F.max(F.expr("aggregate(vector, 0L, (m, x) -> greatest(m, abs(CAST(x AS bigint))))")),
            F.max(F.expr("aggregate(vector, 0D, (m, x) -> m + CAST(x AS double) * x)")),
        ).first()
        self.count, self.width, most = sizes[0], sizes[1] or 0, sizes[2] or 0
        self.kind = scored_type(most, self.width)
        square = (sizes[3] or 0.0) * (1 + SLACK) + 1
        share = min(1.0, sample / max(self.count, 1) * 0.9)
        picked = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) < int(share * (1 << 30))) \
            .select("vec_id", "vector").orderBy("vec_id").limit(sample).toArrow()
        self.tree = plant(
            padded(picked["vector"].combine_chunks(), self.width) if len(picked)
            else np.zeros((0, self.width), np.int64), square, self.width, arity, levels)
        placed = bench.keep(self._placed(rows))
        counts = {row["leaf"]: row["count"] for row in placed.groupBy("leaf").count().collect()}
        self.blocks = {leaf: -(-count // ROW_BLOCK) for leaf, count in counts.items()}
        blocks = F.element_at(F.create_map(*[F.lit(v) for pair in self.blocks.items()
                                             for v in pair]), F.col("leaf")) \
            if self.blocks else F.lit(1)
        self.placed = placed.withColumn(
            "block", F.pmod(F.xxhash64("vec_id"), F.greatest(blocks, F.lit(1))).cast("int"))
        self.ranges = self._ranges(rows)

    def _placed(self, rows: DataFrame) -> DataFrame:
        tree = self.tree

        def run(batches):
            for batch in batches:
                leaf = homes(tree, lifted(padded(batch["vector"], tree.width), tree.square))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf, pa.int32())],
                                                 names=[*batch.schema.names, "leaf"])

        return rows.mapInArrow(run, "vec_id bigint, label bigint, vector array<int>, leaf int")

    def _ranges(self, rows: DataFrame) -> dict:
        """Least and greatest distance of the rows below each child from each split point."""
        tree = self.tree

        def run(batches):
            found: dict = {}

            def seen(node, child, apart):
                low, high = apart.min(axis=0), apart.max(axis=0)
                before = found.get((node, child))
                found[node, child] = (low, high) if before is None else (
                    np.minimum(low, before[0]), np.maximum(high, before[1]))

            for batch in batches:
                homes(tree, lifted(padded(batch["vector"], tree.width), tree.square), seen)
            rows = [(node, child, point, low, high) for (node, child), ends in found.items()
                    for point, (low, high) in enumerate(zip(*ends, strict=True))]
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("node", "child", "point", "low", "high"), row, strict=True))
                 for row in rows],
                pa.schema([("node", pa.int32()), ("child", pa.int32()), ("point", pa.int32()),
                           ("low", pa.float64()), ("high", pa.float64())]))

        ends = rows.select("vector").mapInArrow(
            run, "node int, child int, point int, low double, high double")
        return {(row["node"], row["child"], row["point"]): (row["low"], row["high"])
                for row in ends.groupBy("node", "child", "point")
                .agg(F.min("low").alias("low"), F.max("high").alias("high")).collect()}

    def targets(self, searches: DataFrame, home: bool) -> DataFrame:
        """The anchors' searches, once for each leaf and block that one of them has to look at.

        With ``home``, only the leaf to which the anchor itself is nearest.
        """
        tree, ranges, blocks = self.tree, self.ranges, self.blocks
        names = searches.columns

        def run(batches):
            for batch in batches:
                vectors = padded(batch["vector"], tree.width).astype(np.float64)
                around = np.hstack([vectors, np.zeros((len(vectors), 1))])
                if home:
                    own, leaf = np.arange(len(vectors)), homes(tree, around)
                else:
                    anchor = np.repeat(np.arange(len(vectors)), pc.list_value_length(batch["lows"]))
                    most = np.einsum("ij,ij->i", vectors, vectors)[anchor] + tree.square
                    low, high = (np.sqrt(np.maximum(
                        most - 2.0 * batch[name].flatten().to_numpy(), 0)) for name in ("highs", "lows"))
                    own, leaf = surviving(tree, ranges, around[anchor], low, high)
                    own, leaf = np.unique(np.stack([anchor[own], leaf]), axis=1)
                n_blocks = np.array([blocks.get(int(n), 0) for n in leaf], np.int64)
                own, leaf = np.repeat(own, n_blocks), np.repeat(leaf, n_blocks)
                block = np.arange(len(own)) - np.repeat(np.cumsum(n_blocks) - n_blocks, n_blocks)
                taken = batch.take(pa.array(own, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*taken.columns, pa.array(leaf, pa.int32()), pa.array(block, pa.int32())],
                    names=[*names, "leaf", "block"])

        schema = T.StructType([*searches.schema.fields, T.StructField("leaf", T.IntegerType()),
                               T.StructField("block", T.IntegerType())])
        return searches.mapInArrow(run, schema)

    def search(self, anchors: DataFrame, windows: DataFrame, same: bool, k: int, home: bool):
        """``anchor_id, positive_id, found_id, score``: the ``k`` best rows of every window.

        ``anchors`` have ``anchor_id, label, vector``; ``windows`` have ``anchor_id,
        positive_id, low, high``: rows of the anchor's label if ``same``, else of the
        others, with a score from ``low`` to ``high``.
        """
        width, kind = self.width, self.kind
        packed = windows.groupBy("anchor_id").agg(F.sort_array(F.collect_list(
            F.struct("positive_id", "low", "high"))).alias("own"))
        searches = anchors.join(packed, "anchor_id").select(
            "anchor_id", "label", "vector", F.col("own.positive_id").alias("positives"),
            F.col("own.low").alias("lows"), F.col("own.high").alias("highs"))
        n_parts = max(1, -(-self.count // 100 // SEARCH_BLOCK))
        aimed = self.bench.keep(self.targets(searches, home).withColumn(
            "part", F.pmod(F.xxhash64("anchor_id"), F.lit(n_parts)).cast("int")))
        wanted = aimed.select("leaf", "block", F.col("part").alias("for_part")).distinct()
        rows = self.placed.join(wanted, ["leaf", "block"]).select(
            "vec_id", "label", "vector", F.col("leaf").alias("of_leaf"),
            F.col("block").alias("of_block"), "for_part")

        def run(_, rows, searches):
            found = [[], [], [], []]
            ids, labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
            order = np.argsort(ids)
            ids, labels = ids[order], labels[order]
            matrix = padded(rows["vector"].combine_chunks(), width)[order].astype(kind).T
            for first in range(0, len(searches), AT_ONCE):
                part = searches.slice(first, AT_ONCE).combine_chunks()
                scores = (padded(part["vector"].combine_chunks(), width).astype(kind)
                          @ matrix).astype(np.int64)
                for own, anchor, label, *own_windows in zip(
                        scores, *(part[name].to_pylist() for name in
                                  ("anchor_id", "label", "positives", "lows", "highs")), strict=True):
                    allowed = (labels == label) & (ids != anchor) if same else labels != label
                    for positive, low, high in zip(*own_windows, strict=True):
                        places = np.flatnonzero(allowed & (own >= low) & (own <= high))
                        if len(places) > k:
                            least = -np.partition(-own[places], k - 1)[k - 1]
                            places = places[own[places] >= least]
                        best = places[np.argsort(-own[places], kind="stable")][:k]
                        for column, values in zip(found, (
                                np.full(len(best), anchor), np.full(len(best), positive),
                                ids[best], own[best]), strict=True):
                            column.append(values)
            return pa.table({name: np.concatenate([np.zeros(0, np.int64), *values])
                             for name, values in zip(FOUND, found, strict=True)})

        found = rows.groupBy("of_leaf", "of_block", "for_part").cogroup(
            aimed.groupBy("leaf", "block", "part")).applyInArrow(
            run, ", ".join(f"{name} bigint" for name in FOUND))
        rank = "row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, found_id)"
        return self.bench.keep(found.withColumn("rank", F.expr(rank)).where(f"rank <= {k}"))

    def best(self, anchors: DataFrame, windows: DataFrame, same: bool, k: int) -> DataFrame:
        """The ``k`` best rows of every window, exactly, as ``search`` gives them, with ``rank``."""
        keys = ["anchor_id", "positive_id"]
        reached = self.search(anchors, windows, same, k, home=True).where(f"rank = {k}") \
            .select(*keys, F.col("score").alias("reached"))
        narrowed = windows.join(reached, keys, "left") \
            .withColumn("low", F.greatest("low", F.coalesce("reached", "low"))).drop("reached")
        return self.search(anchors, narrowed, same, k, home=False)


FOUND = ("anchor_id", "positive_id", "found_id", "score")


def mine(
    rows: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10,
    percent: tuple[int, int] = (30, 90), sample: int = SAMPLE, arity: int = ARITY,
    levels: int = LEVELS,
) -> DataFrame:
    """Hard negatives of every anchor's positives.

    Anchors are the rows whose id ``every`` divides.  A negative's score is within
    ``percent`` of the positive's.
    """
    bench = Workbench(rows.sparkSession)
    whole = bench.keep(usable(rows))
    index = Index(bench, whole, sample, arity, levels)
    limit = (1 << 62) - 1
    anchors = bench.keep(whole.where(F.col("vec_id") % every == 0)
                         .select(F.col("vec_id").alias("anchor_id"), "label", "vector"))
    every_score = anchors.select("anchor_id", F.col("anchor_id").alias("positive_id"),
                                 F.lit(-limit).alias("low"), F.lit(limit).alias("high"))
    chosen = index.best(anchors, every_score, True, positives).select(
        "anchor_id", F.col("found_id").alias("positive_id"), F.col("score").alias("positive_score"))
    least, most = (f"({share} * positive_score)" for share in percent)
    windows = bench.keep(chosen.select(
        "anchor_id", "positive_id",
        F.expr(f"-((-{least} - pmod(-{least}, 100)) div 100)").alias("low"),
        F.expr(f"({most} - pmod({most}, 100)) div 100").alias("high")).where("low <= high"))
    return index.best(anchors, windows, False, negatives) \
        .join(chosen, ["anchor_id", "positive_id"]).select(
            "anchor_id", "positive_id", F.col("rank").cast("int"),
            F.col("found_id").alias("negative_id"), "positive_score",
            F.col("score").alias("negative_score"))


def op12_hard_negatives(spark, sf_dir) -> DataFrame:
    return mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


#: All scores of all anchors, ranked.
ORACLE = """
WITH whole AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           [CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS vector
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
           CAST(list_inner_product(a.vector, b.vector) AS BIGINT) AS score
    FROM whole a JOIN whole b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score
    FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id
                               ORDER BY score DESC, other_id) AS INTEGER) AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) <= 10
"""
