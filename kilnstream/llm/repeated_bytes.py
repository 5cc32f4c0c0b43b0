"""Suffix-array dedup: repeated byte strings by longest previous factors, over all documents.

A place of a text is a suffix; suffixes in an order that puts equal first
``length`` bytes side by side, and then earlier before later ones, have their
previous and next smaller positions next to them.  The longest previous factor of
a place reaches ``length`` exactly if its predecessor in this order has the same
first ``length`` bytes.  Cut off at ``length``, this order is that of fingerprints
of the ``length`` bytes, so no suffix is ever compared byte by byte.

The order is never built for whole documents:

1. Every string of ``length`` bytes has an anchor, its least ``GRAM``-byte
   substring by hash (the leftmost of equals).  Consecutive places with one anchor
   are a run; equal strings have equal anchors at the same distance, so only runs
   of an anchor that stands in several runs can repeat.
2. Runs whose whole stretch of text is the same are one class: a class of several
   runs repeats throughout.
3. Only classes that share their anchor with another class are ordered by suffix,
   one of each, together with all of that anchor.  An anchor with more than
   ``most_classes`` classes is not gathered: its places are counted and joined by
   fingerprint instead, which gives the same.

Fingerprints have 64 bits; equal ones are taken as equal strings.

``keep="none"`` removes every byte in a string that also starts elsewhere;
``keep="first"`` removes only copies that come later by document id, text and place.

* null or empty text, and texts shorter than ``length``, have no place and stay whole;
* repeated rows are copies of each other, whether they share an id or not;
* rows that repeat id and text get the same result; null ids come first;
* an empty table gives an empty one; other columns are not looked at, and
  ``remove_repeats`` keeps them;
* bytes of a character cut in half are dropped from texts by ``remove_repeats``;
  the digests are those of the bytes.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kilnstream.llm import bytetext
from kilnstream.llm.linking import Workbench
from kilnstream.llm.membership import bit_map, may_have

LENGTH = 400
GRAM = 128
MOST_CLASSES = 10_000
CHUNK = 1_000_000
#: Classes, and documents with their spans, that a Python worker unfolds at once.
STEP = 1000

_FIRST, _LAST = np.uint64(0x9FB21C651E98DF25), np.uint64(0xC2B2AE3D27D4EB4F)
HIGH = np.uint64(0xFFFFFFFF00000000)
LOW = np.uint64(0xFFFFFFFF)


def text_hashes(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    whole = bytetext.span_hashes(data, bounds[:-1], bounds[1:])
    return bytetext.mixed(whole + np.diff(bounds).astype(np.uint64)).view(np.int64)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` consecutive values."""
    reach = 1
    while 2 * reach <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(values[:len(values) - rest], values[rest:]) if rest else values


class Runs:
    """Runs of one chunk of texts: text number, first and last place, anchor and class."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, length: int, gram: int):
        places = np.zeros(len(data) + 1, np.int64)
        long_enough = np.flatnonzero(np.diff(bounds) >= length)
        np.add.at(places, bounds[long_enough], 1)
        np.add.at(places, bounds[long_enough + 1] - length + 1, -1)
        start = np.flatnonzero(np.cumsum(places[:-1]))
        if not len(start):
            self.text = self.first = self.last = np.zeros(0, np.int64)
            self.anchor = self.same = np.zeros(0, np.int64)
            return
        running, back = bytetext.prefix_hash(data), bytetext.powers(len(data) + 1)[1]
        grams = bytetext.mixed((running[gram:] - running[:-gram]) * back[:len(data) - gram + 1])
        tagged = grams & HIGH | np.arange(len(grams), dtype=np.uint64)
        anchor = (sliding_least(tagged, length - gram + 1)[start] & LOW).astype(np.int64)
        new = np.ones(len(start), bool)
        new[1:] = (np.diff(anchor) != 0) | (np.diff(start) != 1)
        begins = np.flatnonzero(new)
        self.first = start[begins]
        self.last = start[np.append(begins[1:], len(start)) - 1]
        at = anchor[begins]
        self.anchor = grams[at].view(np.int64)
        content = (running[self.last + length] - running[self.first]) * back[self.first]
        shape = (at - self.first).astype(np.uint64) * _FIRST \
            + (self.last - self.first).astype(np.uint64) * _LAST
        self.same = bytetext.mixed(bytetext.mixed(content) + shape).view(np.int64)
        self.text = np.searchsorted(bounds, self.first, "right") - 1


def _runs(docs: DataFrame, length: int, gram: int, wanted: np.ndarray | None = None) -> DataFrame:
    """Runs as ``doc_id, text_hash, first, last, anchor, same``.

    With ``wanted``, a map of anchors, only their runs, and with their ``content``.
    """
    needed = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches):
        for batch in batches:
            for low, _, data, bounds in bytetext.chunks(batch["text"], CHUNK):
                runs = Runs(data, bounds, length, gram)
                hashes = text_hashes(data, bounds)
                chosen = np.arange(len(runs.text)) if needed.value is None \
                    else np.flatnonzero(may_have(needed.value, runs.anchor))
                own = runs.text[chosen]
                first, last = runs.first[chosen], runs.last[chosen]
                arrays = [
                    batch["doc_id"].take(pa.array(low + own)), pa.array(hashes[own]),
                    pa.array(first - bounds[own]), pa.array(last - bounds[own]),
                    pa.array(runs.anchor[chosen]), pa.array(runs.same[chosen]),
                ]
                if needed.value is not None:
                    whole = data.tobytes()
                    arrays.append(pa.array(
                        [whole[a:b + length] for a, b in zip(first.tolist(), last.tolist(),
                                                             strict=True)], pa.binary()))
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    rows = docs.select("doc_id", "text")
    schema = rows.select("doc_id").schema
    for name in ("text_hash", "first", "last", "anchor", "same"):
        schema = schema.add(name, T.LongType())
    if wanted is not None:
        schema = schema.add("content", T.BinaryType())
    return rows.mapInArrow(run, schema)


def flagged_spans(flags: np.ndarray, owner: np.ndarray, place: np.ndarray, length: int):
    """Owner, start and end of what the flagged places cover, one span for each stretch."""
    at = np.flatnonzero(flags)
    if not len(at):
        return at, at, at
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(owner[at]) != 0) | (np.diff(place[at]) != 1)
    begins = np.flatnonzero(new)
    ends = np.append(begins[1:], len(at)) - 1
    return owner[at[begins]], place[at[begins]], place[at[ends]] + length


def windows_of(batch: pa.Table, length: int):
    """Of every place of every class: row number, place in the text, fingerprint."""
    lengths = np.array([len(content.as_py()) for content in batch["content"]], np.int64)
    data = np.frombuffer(b"".join(batch["content"].to_pylist()), np.uint8)
    begin = np.cumsum(lengths) - lengths
    counts = lengths - length + 1
    owner = np.repeat(np.arange(len(counts)), counts)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = begin[owner] + offset
    place = batch["first"].to_numpy()[owner] + offset
    return owner, place, bytetext.span_hashes(data, start, start + length)


def repeats_in_order(
    owner: np.ndarray, place: np.ndarray, prints: np.ndarray, document: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Places whose longest previous factor, and longest following one, reach the length."""
    order = np.lexsort((place, document[owner], prints))
    same = prints[order[1:]] == prints[order[:-1]]
    previous, following = np.zeros((2, len(order)), bool)
    previous[order[1:]] = same
    following[order[:-1]] = same
    return previous, following


def document_ranks(batch: pa.Table) -> np.ndarray:
    """Order of the rows' documents: null ids first, then by id and text hash."""
    keys = sorted(set(zip(batch["doc_id"].to_pylist(), batch["text_hash"].to_pylist(),
                          strict=True)),
                  key=lambda key: (key[0] is not None, key[0] or 0, key[1]))
    ranks = {key: rank for rank, key in enumerate(keys)}
    return np.array([ranks[key] for key in zip(batch["doc_id"].to_pylist(),
                                               batch["text_hash"].to_pylist(), strict=True)],
                    np.int64)


def suffix_spans(classes: DataFrame, length: int, keep: str, schema: T.StructType) -> DataFrame:
    """Covered spans of the classes' runs; all classes of an anchor are looked at together."""
    def answer(table: pa.Table):
        if not len(table):
            return
        owner, place, prints = windows_of(table, length)
        previous, following = repeats_in_order(owner, place, prints, document_ranks(table))
        flags = previous if keep == "first" else previous | following
        row, start, end = flagged_spans(flags, owner, place, length)
        rows = pa.array(row)
        yield pa.RecordBatch.from_arrays([
            table["doc_id"].combine_chunks().take(rows),
            table["text_hash"].combine_chunks().take(rows), pa.array(start), pa.array(end),
        ], names=schema.names)

    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            if held is not None:
                table = pa.concat_tables([held, table]).combine_chunks()
            anchors = table["anchor"].to_numpy()
            begins = np.flatnonzero(np.append(True, anchors[1:] != anchors[:-1]))
            low = 0
            while low < begins[-1]:
                # whole anchors, at least one and about STEP classes
                high = int(begins[max(np.searchsorted(begins, low + STEP, "right") - 1,
                                      np.searchsorted(begins, low) + 1)])
                yield from answer(table.slice(low, high - low).combine_chunks())
                low = high
            held = table.slice(low).combine_chunks()
        if held is not None:
            yield from answer(held)

    return classes.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, schema)


def counted_spans(classes: DataFrame, length: int, keep: str, schema: T.StructType) -> DataFrame:
    """The same for anchors of too many classes: every place by its fingerprint."""
    def run(batches):
        for whole in batches:
            for low in range(0, whole.num_rows, STEP):
                batch = whole.slice(low, STEP)
                owner, place, prints = windows_of(pa.Table.from_batches([batch]), length)
                rows = pa.array(owner)
                yield pa.RecordBatch.from_arrays([
                    batch["doc_id"].take(rows), batch["text_hash"].take(rows),
                    pa.array(place), pa.array(prints.view(np.int64)),
                ], names=["doc_id", "text_hash", "start", "print"])

    places = classes.mapInArrow(run, T.StructType(
        [*schema.fields[:3], T.StructField("print", T.LongType())]
    ))
    where = F.struct("doc_id", "text_hash", "start")
    repeated = places.groupBy("print").agg(
        F.count("*").alias("times"), F.min(where).alias("earliest")
    ).where("times > 1").drop("times")
    found = places.join(repeated, "print")
    if keep == "first":
        found = found.where(where != F.col("earliest"))
    return found.select("doc_id", "text_hash", "start", (F.col("start") + length).alias("end"))


def repeated_spans(
    docs: DataFrame, length: int, gram: int, keep: str, most_classes: int
) -> DataFrame:
    """``doc_id, text_hash, start, end`` of bytes to remove; spans may overlap."""
    if keep not in ("none", "first"):
        raise ValueError(f"keep is 'none' or 'first', not {keep!r}")
    bench = Workbench(docs.sparkSession)
    runs = _runs(docs, length, gram)
    anchors = bench.keep(
        runs.groupBy("anchor").agg(F.count("*").alias("times"), F.min("same").alias("low"),
                                   F.max("same").alias("high"))
        .where("times > 1").select("anchor", F.expr("low < high").alias("mixed"))
    )
    shared = bench.keep(runs.join(anchors, "anchor"))

    where = F.struct("doc_id", "text_hash", "first")
    classes = bench.keep(shared.groupBy("anchor", "same").agg(
        F.count("*").alias("times"), F.min(where).alias("earliest"),
        F.first("mixed").alias("mixed"),
    ))
    inside = shared.join(classes.where("times > 1").drop("mixed"), ["anchor", "same"])
    if keep == "first":
        inside = inside.where(where != F.col("earliest"))
    inside = inside.select("doc_id", "text_hash", F.col("first").alias("start"),
                           (F.col("last") + length).alias("end"))

    mixed = classes.where("mixed").select("anchor", "same", "times")
    n_classes = mixed.groupBy("anchor").agg(F.count("*").alias("n_classes"))
    wanted = bit_map(anchors.where("mixed"), "anchor")
    content = bench.keep(
        _runs(docs, length, gram, wanted)
        .groupBy("anchor", "same").agg(
            F.min(F.struct("doc_id", "text_hash", "first", "content")).alias("one"))
        .join(mixed, ["anchor", "same"]).join(n_classes, "anchor")
        .select("anchor", "times", "n_classes", "one.*")
    )
    place = inside.schema
    few, many = (content.where(F.col("n_classes") <= most_classes),
                 content.where(F.col("n_classes") > most_classes))
    return bench.keep(
        inside.union(suffix_spans(few, length, keep, place))
        .union(counted_spans(many, length, keep, place))
    )


def cut(content: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """What is left without the spans, the bytes removed and the number of removed stretches."""
    out, at, n_spans, removed = [], 0, 0, 0
    for start, end in sorted(spans):
        if start > at or not n_spans:
            out.append(content[at:start])
            n_spans += 1
            removed += end - start
            at = end
        elif end > at:
            removed += end - at
            at = end
    out.append(content[at:])
    return b"".join(out), removed, n_spans


def with_spans(docs: DataFrame, spans: DataFrame, answer, schema: T.StructType) -> DataFrame:
    """``answer(batch of documents, spans of each)``; only texts with spans are moved."""
    held = spans.sparkSession.sparkContext.broadcast(bit_map(spans, "text_hash"))
    packed = docs.select(F.struct("*").alias("doc"))

    def hashed(batches):
        for batch in batches:
            texts = pa.RecordBatch.from_struct_array(batch["doc"])["text"]
            for first, last, data, bounds in bytetext.chunks(texts, CHUNK):
                hashes = text_hashes(data, bounds)
                yield pa.RecordBatch.from_arrays(
                    [batch["doc"].slice(first, last - first), pa.array(hashes),
                     pa.array(may_have(held.value, hashes))],
                    names=["doc", "text_hash", "maybe"],
                )

    def run(batches):
        for whole in batches:
            for low in range(0, whole.num_rows, STEP):
                batch = whole.slice(low, STEP)
                lists = [[(s["start"], s["end"]) for s in found or []]
                         for found in batch["spans"].to_pylist()]
                yield answer(pa.RecordBatch.from_struct_array(batch["doc"]), lists)

    hashed_schema = T.StructType([*packed.schema.fields, T.StructField("text_hash", T.LongType()),
                                  T.StructField("maybe", T.BooleanType())])
    rows = packed.mapInArrow(hashed, hashed_schema)
    by_text = spans.groupBy(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")) \
        .agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    none = F.lit(None).cast("array<struct<start: bigint, end: bigint>>")
    joined = rows.where("maybe").join(
        by_text, (F.col("text_hash") == F.col("hash")) & F.col("doc.doc_id").eqNullSafe(F.col("id")),
        "left",
    ).select("doc", "spans")
    return joined.union(rows.where("NOT maybe").select("doc", none.alias("spans"))) \
        .mapInArrow(run, schema)


def repeats(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, keep: str = "none",
    most_classes: int = MOST_CLASSES,
) -> DataFrame:
    """Bytes, removed bytes and stretches, and the digest of what is left, of every document."""
    def answer(batch, lists):
        sizes, removed, stretches, digests = [], [], [], []
        for text, spans in zip(batch["text"], lists, strict=True):
            content = (text.as_py() or "").encode()
            left, n_removed, n_spans = cut(content, spans)
            sizes.append(len(content))
            removed.append(n_removed)
            stretches.append(n_spans)
            digests.append(hashlib.sha256(left).hexdigest())
        return pa.RecordBatch.from_arrays(
            [batch["doc_id"], *(pa.array(n, pa.int64()) for n in (sizes, removed, stretches)),
             pa.array(digests, pa.string())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )

    rows = docs.select("doc_id", "text")
    schema = rows.select("doc_id").schema
    for name in ("n_bytes", "n_removed", "n_spans"):
        schema = schema.add(name, T.LongType())
    spans = repeated_spans(rows, length, gram, keep, most_classes)
    return with_spans(rows, spans, answer, schema.add("kept_sha256", T.StringType()))


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, keep: str = "first",
    most_classes: int = MOST_CLASSES,
) -> DataFrame:
    """The documents, all columns, without the repeated bytes."""
    at = docs.columns.index("text")

    def answer(batch, lists):
        texts = [text if not spans else cut(text.encode(), spans)[0].decode(errors="ignore")
                 for text, spans in zip(batch["text"].to_pylist(), lists, strict=True)]
        return batch.set_column(at, batch.schema.field(at), pa.array(texts, pa.string()))

    spans = repeated_spans(docs.select("doc_id", "text"), length, gram, keep, most_classes)
    return with_spans(docs, spans, answer, docs.schema)


def op8_repeated_bytes(spark, sf_dir) -> DataFrame:
    """What each document loses, and in ``repeated`` whether it loses anything."""
    return repeats(spark.read.parquet(f"{sf_dir}/documents.parquet")) \
        .withColumn("repeated", F.col("n_removed") > 0)
