"""N-gram Jaccard join by PartEnum signatures: sets of similar size share one of a few signatures.

1. Every text becomes its set of distinct word shingles, each a 64-bit hash.  Texts of
   equal sets are one class, named by a hash of the set.
2. Set sizes fall into bands whose ends are in the ratio of the threshold, so two
   similar sets are in one band or in neighbouring ones.  For a band and the next one,
   similar sets differ in at most ``k`` shingles (``Plan``).
3. The domain of shingles is dealt to ``parts`` parts, each to ``pieces`` pieces, and
   a set has a signature for every part and every choice of all its pieces but one.  In
   at most ``k // 2`` parts there are two differences or more; elsewhere the sets agree
   but for one piece at most, so that they share a signature.  There are more parts than
   the method needs, and a part that is spoilt takes two differences: similar sets share
   ``2 * parts - k`` signatures or more, ``spare`` and one.  So every set goes without
   the ``spare`` ones that most others share, common passages and empty pieces above
   all, and a set that shares no more than these with anyone has no partner.
4. Under each signature the set that shares most is compared with all others, on the full
   sets made from the whole texts again; what these links join is one group.
5. Pairs under a signature that are still in different groups are then compared as well,
   so that no link between groups is lost.  Where both have been compared with one and
   the same set, what they did not share with it tells how many shingles they do not
   share with each other; the others are compared on the full sets.  Maps of 256 bits
   leave out most pairs before that, none of them similar.

* null or empty text, or one without words: no shingles, linked with nothing;
* fewer words than a shingle: the whole sequence is one shingle;
* ties and repeated rows: equal sets are one class, the least id names the group;
* a null id cannot be linked: its component is null;
* very long texts have as many more signatures as they have shingles;
* an empty table gives an empty one; other columns are not looked at.
"""

from contextlib import contextmanager
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kilnstream.llm import bytetext
from kilnstream.llm.linking import Workbench, components
from kilnstream.llm.membership import bit_map, may_have

SHINGLE = 5
PERCENT = 80
#: Up to this many differences a part has three pieces, beyond it two.
THREE_PIECES = 24
#: One part more than the method needs for each so many differences.
EXTRA_STEP = 4
#: Words of 64 bits in the maps that tell unlike arrays apart.
WORDS = 4
#: Differences are kept if they are at most one in so many of both sets' shingles.
SMALL = 2
#: Class names that a task remembers, so that copies in it are looked at once.
REMEMBERED = 200_000

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_OTHER = np.uint64(0xA0761D6478BD642F)
_PIECE = np.uint64(0xE7037ED1A0B428DB)


class Plan(NamedTuple):
    """How the sets of a band and of the next one are dealt out."""

    parts: int
    pieces: int
    spare: int


@lru_cache(maxsize=None)
def band_ends(percent: int, largest: int) -> np.ndarray:
    """The greatest size of every band, up to the band of ``largest``."""
    ends = [1]
    while ends[-1] < largest:
        ends.append((ends[-1] + 1) * 100 // percent)
    return np.array(ends, np.int64)


def band_of(size: int, percent: int) -> int:
    largest = 1 << max(10, int(size).bit_length())
    return int(np.searchsorted(band_ends(percent, largest), size))


@lru_cache(maxsize=None)
def plan(band: int, percent: int) -> Plan:
    """The plan of a band and the next: the smaller set of a pair is in the band itself."""
    largest = 1 << 10
    while len(band_ends(percent, largest)) <= band:
        largest <<= 1
    end = int(band_ends(percent, largest)[band])
    differences = (end + end * 100 // percent) * (100 - percent) // (100 + percent)
    pieces = 3 if differences <= THREE_PIECES else 2
    parts = differences // 2 + 2 + differences // EXTRA_STEP
    return Plan(parts, pieces, 2 * parts - differences - 1)


def signatures(found: np.ndarray, percent: int) -> np.ndarray:
    """The signatures of a set.

    A set belongs to the plan of its band and to that of the band before.  The lowest
    bit of a signature says whether its band is odd.
    """
    own, out = band_of(len(found), percent), []
    spread = bytetext.mixed(found ^ _OTHER)
    content = bytetext.mixed(found ^ _PIECE)
    for band in {own, max(own - 1, 0)}:
        parts, pieces, _ = plan(band, percent)
        cell = (spread % np.uint64(parts * pieces)).astype(np.int64)
        sums = np.zeros(parts * pieces, np.uint64)
        np.add.at(sums, cell, content)
        sums = sums.reshape(parts, pieces)
        chosen = sums.sum(axis=1, dtype=np.uint64)[:, None] - sums
        place = np.arange(parts * pieces, dtype=np.uint64).reshape(parts, pieces)
        named = bytetext.mixed(bytetext.mixed(place + (np.uint64(band) << np.uint64(40))) ^ chosen)
        out.append((named.ravel() & ~np.uint64(1)) | np.uint64(band % 2))
    return np.concatenate(out)


def shingle_sets(column: pa.Array, size: int):
    """Sorted distinct shingle hashes of every text, in order."""
    for first, last, data, bounds in bytetext.chunks(column):
        lowered = bytetext.LOWER[data]
        begin, end, text = bytetext.words(lowered, bounds, bytetext.NOT_SPACE)
        hashes = bytetext.span_hashes(lowered, begin, end)
        windows, place = bytetext.window_hashes(hashes, text, size)
        rows = np.arange(last - first + 1)
        words, stops = np.searchsorted(text, rows), np.searchsorted(text[place], rows)
        for row in range(last - first):
            low, high = words[row], words[row + 1]
            if 0 < high - low < size:
                yield bytetext.window_hashes(hashes[low:high], text[low:high], int(high - low))[0]
            else:
                yield np.unique(windows[stops[row]:stops[row + 1]])


def name_of(found: np.ndarray) -> int:
    """The 64-bit name of a class: a hash of its set."""
    total = bytetext.mixed(found).sum(dtype=np.uint64) + np.uint64(len(found))
    return int(bytetext.mixed(np.array([total], np.uint64)).view(np.int64)[0])


def lists_of(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0] + [len(values) for values in arrays])
    values = np.concatenate([np.zeros(0, np.uint64), *arrays]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))


@contextmanager
def freed_shuffles(spark):
    """Shuffle files of the jobs inside go when their job ends; the results are on disk then."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


class TidyBench(Workbench):
    """A workbench that leaves no shuffle files of the steps whose results it keeps."""

    def keep(self, rows: DataFrame) -> DataFrame:
        with freed_shuffles(self.spark):
            return super().keep(rows)


def class_names(docs: DataFrame, size: int) -> DataFrame:
    """``doc_id, n_shingles, node``; no ``node`` for an empty set."""
    def run(batches):
        for batch in batches:
            found = list(shingle_sets(batch["text"], size))
            yield pa.RecordBatch.from_arrays([
                batch["doc_id"], pa.array([len(own) for own in found], pa.int64()),
                pa.array([name_of(own) if len(own) else None for own in found], pa.int64()),
            ], names=["doc_id", "n_shingles", "node"])

    rows = docs.select("doc_id", "text")
    schema = rows.select("doc_id").schema.add("n_shingles", "long").add("node", "long")
    return rows.mapInArrow(run, schema)


def _of_classes(docs: DataFrame, size: int, schema: str, made) -> DataFrame:
    """``made`` for the sets of the texts, once for each class and task.

    ``made`` takes the names and sets of a batch and gives its columns.
    """
    kept = docs.where("doc_id IS NOT NULL").select("text")

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            new, sets = [], []
            for found in shingle_sets(batch["text"], size):
                if len(found):
                    name = name_of(found)
                    if name not in seen:
                        seen.add(name)
                        new.append(name)
                        sets.append(found)
            if len(seen) > REMEMBERED:
                seen.clear()
            yield made(new, sets)

    return kept.mapInArrow(run, schema)


def entries(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """``node, sig`` for all signatures of all classes, some of them repeatedly."""
    def made(names, sets):
        lists = [signatures(found, percent) for found in sets]
        return pa.RecordBatch.from_arrays([
            pa.array(np.repeat(np.array(names, np.int64), [len(own) for own in lists])),
            pa.array(np.concatenate([np.zeros(0, np.uint64), *lists]).view(np.int64)),
        ], names=["node", "sig"])

    return _of_classes(docs, size, "node bigint, sig bigint", made)


def band_spares(classes: DataFrame, percent: int) -> Column:
    """For ``n`` and the band's parity ``odd`` the number of spare signatures, by a lookup."""
    largest = classes.agg(F.max("n")).first()[0] or 1
    top = band_of(largest, percent)
    ends = band_ends(percent, 1 << max(10, int(largest).bit_length()))[:top + 1].tolist()
    spares = [plan(band, percent).spare for band in range(top + 1)]
    band = F.size(F.filter(F.lit(ends), lambda end: end < F.col("n")))
    wanted = F.when(band % 2 == F.col("odd"), band).otherwise(F.greatest(band - 1, F.lit(0)))
    return F.element_at(F.lit(spares), wanted + 1)


def postings(bench: Workbench, docs: DataFrame, classes: DataFrame, size: int, percent: int):
    """``node, n, odd, weight, sigs``: under which signatures every class meets others.

    Similar classes have all but fewer than ``beyond`` signatures of each other; ``held0``
    and so on are a map of all that others have too.

    A signature that only one class has leads nowhere.  Of the others, each class goes
    without the ``spare`` ones that are the most frequent; similar classes share more
    than ``spare`` signatures of a band, so that the rarest of these stays with both.
    """
    # equal rows come from tasks that met copies; the frequency may count them, the same for all
    whole = "PARTITION BY sig"
    shared = (
        entries(docs, size, percent)
        .select("sig", "node", F.expr(f"count(*) OVER ({whole})").alias("df"),
                F.expr(f"min(node) OVER ({whole})").alias("low"),
                F.expr(f"max(node) OVER ({whole})").alias("high"))
        .where("low < high").select("sig", "node", "df")
    )
    odd = F.expr("CAST(sig & 1 AS int)")
    held = (
        bench.keep(shared).groupBy("node", odd.alias("odd"))
        .agg(F.sort_array(F.collect_set(F.struct("df", "sig"))).alias("held"))
        .join(classes.select("node", "n"), "node")
        .withColumn("spare", band_spares(classes, percent))
        .where("size(held) > spare")
        .select("node", "n", "odd", F.expr("aggregate(held, 0L, (total, x) -> total + x.df)")
                .alias("weight"), F.expr("slice(held, 1, size(held) - spare).sig").alias("sigs"),
                (F.size("held") - F.col("spare")).alias("beyond"), *bit_map_of("held.sig", "held"))
    )
    return bench.keep(held)


def bit_map_of(values: str, name: str) -> list[Column]:
    """A map of ``WORDS`` columns of 64 bits, in which each value of the array sets one."""
    return [F.expr(
        f"coalesce(aggregate({values}, 0L, (map, x) -> IF(pmod(shiftright(x, 7), {WORDS}) <> {word},"
        " map, map | shiftleft(1L, CAST(shiftright(x, 1) & 63 AS int)))), 0L)"
    ).alias(f"{name}{word}") for word in range(WORDS)]


def alone(name: str, one: str, other: str) -> Column:
    """At least so many values of one side's array the other's does not have, by their maps."""
    return F.expr(" + ".join(f"bit_count({name}{word}_{one} & ~{name}{word}_{other})"
                             for word in range(WORDS)))


def full_sets(docs: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """``node, shingles`` of the wanted classes, from the whole texts again.

    A map of fixed size picks the sets, some of them needlessly or repeatedly; the
    joins that follow see to it.
    """
    held = docs.sparkSession.sparkContext.broadcast(bit_map(nodes, "node"))

    def made(names, sets):
        names = np.array(names, np.int64)
        chosen = np.flatnonzero(may_have(held.value, names)) if len(names) else []
        return pa.RecordBatch.from_arrays(
            [pa.array(names[chosen]), lists_of([sets[n] for n in chosen])],
            names=["node", "shingles"])

    return _of_classes(docs, size, "node bigint, shingles array<bigint>", made)


def compared(bench: Workbench, pairs: DataFrame, docs: DataFrame, size: int, percent: int):
    """``a, b, linked`` and, if it is small, ``difference``: what is in one set only."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = bench.keep(
        full_sets(docs, wanted, size).join(wanted, "node", "left_semi")
        .groupBy("node").agg(F.first("shingles").alias("shingles"))
    )

    def side(name: str) -> DataFrame:
        return sets.select(F.col("node").alias(name), F.col("shingles").alias(f"of_{name}"))

    common = F.size(F.array_intersect("of_a", "of_b"))
    apart = F.concat(F.array_except("of_a", "of_b"), F.array_except("of_b", "of_a"))
    both = pairs.join(side("b"), "b").join(side("a"), "a") \
        .withColumn("total", F.size("of_a") + F.size("of_b")) \
        .withColumn("unlike", F.col("total") - 2 * common)
    return bench.keep(both.select(
        "a", "b", linked(F.col("total"), F.col("unlike"), percent).alias("linked"),
        F.when(F.col("unlike") * SMALL <= F.col("total"), apart).alias("difference")))


def linked(total: Column, unlike: Column, percent: int) -> Column:
    """Whether two sets of ``total`` shingles are similar if ``unlike`` are in one only."""
    return 100 * (total - unlike) >= percent * (total + unlike)


def class_links(bench: Workbench, docs: DataFrame, classes: DataFrame, size: int, percent: int):
    """``node, component`` of all classes that are linked with another one."""
    maps = [f"{name}{word}" for name in ("held", "unlike") for word in range(WORDS)]
    near = F.expr(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")
    lists = postings(bench, docs, classes, size, percent)
    under = lists.select("node", "n", "odd", "weight", F.explode("sigs").alias("sig"))

    def side(rows: DataFrame, suffix: str, *more: str) -> DataFrame:
        return rows.select("sig", *[F.col(name).alias(f"{name}_{suffix}")
                                    for name in ("node", "n", *more)])

    leaders = under.groupBy("sig").agg(
        F.min_by(F.struct("node", "n", "weight"), F.struct(-F.col("weight"), "node"))
        .alias("leader"), F.count("*").alias("length"),
    ).where("length > 1").select("sig", "leader.*")
    first = bench.keep(
        side(leaders, "a", "weight").join(side(under, "b"), "sig")
        .where("node_a <> node_b").where(near)
        .groupBy(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
        .agg(F.max("weight_a").alias("weight"))
    )
    met = compared(bench, first.select("a", "b"), docs, size, percent)
    links = met.where("linked").select("a", "b")
    groups = bench.keep(components(bench, links))
    bases = bench.keep(
        met.where("difference IS NOT NULL").join(first, ["a", "b"])
        .groupBy(F.col("b").alias("node"))
        .agg(F.max_by(F.struct(F.col("a").alias("base"), "difference"),
                      F.struct("weight", "a")).alias("found")).select("node", "found.*")
    )

    grouped = bench.keep(
        under.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
        .drop("weight")
    )
    mixed = grouped.groupBy("sig").agg(
        F.min("component").alias("low"), F.max("component").alias("high")
    ).where("low < high").select("sig")
    open_lists = bench.keep(
        grouped.join(mixed, "sig")
        .join(leaders.select("sig", F.col("node").alias("leader")), "sig")
        .where("node <> leader").drop("leader")
        .join(lists.drop("n", "weight", "sigs"), ["node", "odd"])
        .join(bases.select("node", "base", *bit_map_of("difference", "unlike")), "node", "left")
        .fillna(0, maps[WORDS:])
    )
    both = side(open_lists, "a", "component", "beyond", "base", *maps) \
        .join(side(open_lists, "b", "component", "beyond", "base", *maps), "sig")
    total = F.col("n_a") + F.col("n_b")
    known = F.expr("coalesce(base_a = base_b, false)")
    enough = (alone("held", "a", "b") < F.col("beyond_a")) \
        & (alone("held", "b", "a") < F.col("beyond_b"))
    least = alone("unlike", "a", "b") + alone("unlike", "b", "a")
    rest = bench.keep(
        both.where(F.col("component_a") < F.col("component_b")).where(near).where(enough)
        .where(~known | linked(total, least, percent))
        .select(F.col("node_a").alias("a"), F.col("node_b").alias("b"), known.alias("known"),
                total.alias("total")).distinct()
    )

    def apart(name: str) -> DataFrame:
        return bases.select(F.col("node").alias(name), F.col("difference").alias(f"of_{name}"))

    exactly = F.size("of_a") + F.size("of_b") - 2 * F.size(F.array_intersect("of_a", "of_b"))
    more = rest.where("known").join(apart("a"), "a").join(apart("b"), "b") \
        .where(linked(F.col("total"), exactly, percent)).select("a", "b")
    unknown = compared(bench, rest.where("NOT known").select("a", "b"), docs, size, percent)
    more_links = more.union(unknown.where("linked").select("a", "b"))
    return components(bench, links.union(more_links))


def similar_texts(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document."""
    bench = TidyBench(docs.sparkSession)
    names = bench.keep(class_names(docs, size))
    classes = bench.keep(
        names.where("node IS NOT NULL AND doc_id IS NOT NULL").groupBy("node").agg(
            F.first("n_shingles").alias("n"), F.min("doc_id").alias("least_id"))
    )
    groups = bench.keep(class_links(bench, docs, classes, size, percent))
    least = groups.join(classes, "node").groupBy("component") \
        .agg(F.min("least_id").alias("group_id"))
    named = classes.join(groups, "node", "left").join(least, "component", "left").select(
        "node", F.coalesce("group_id", "least_id").alias("group_id"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("group_id", "doc_id"))
    return names.join(named, "node", "left").select(
        "doc_id", "n_shingles", component.alias("component_id"))


def op13_jaccard_join(spark, sf_dir) -> DataFrame:
    return similar_texts(spark.read.parquet(f"{sf_dir}/documents.parquet"), 4, 85)


def similar_sql(size: int, percent: int) -> str:
    """Shingles as texts, links by counting common ones, groups by following links."""
    return f"""
WITH RECURSIVE worded AS (
    SELECT doc_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x20\\x09-\\x0D]+') AS words
    FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN words IS NULL OR len(words) = 0 THEN CAST([] AS VARCHAR[])
        WHEN len(words) < {size} THEN [array_to_string(words, ' ')]
        ELSE list_distinct([array_to_string(words[i:i + {size - 1}], ' ') FOR i IN range(1, len(words) - {size - 2})])
        END AS shingles
    FROM worded
), single AS (
    SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM single a JOIN single b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    WHERE 100 * least(a.n, b.n) >= {percent} * greatest(a.n, b.n)
    GROUP BY a.doc_id, b.doc_id, a.n, b.n
    HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))
), reached AS (
    SELECT a AS doc_id, a AS other FROM links
    UNION
    SELECT reached.doc_id, links.b FROM reached JOIN links ON reached.other = links.a
), named AS (
    SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id
)
SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles,
       coalesce(component_id, doc_id) AS component_id
FROM sets LEFT JOIN named USING (doc_id)
"""


ORACLE = similar_sql(4, 85)
