"""Benchmark decontamination: benchmark word windows found in documents.

Words are runs of digits, a-z and characters beyond ASCII after A-Z is
lower-cased.  Every ``width`` consecutive words of a benchmark item are a
window; an item with fewer words is one window of its own length.  The windows
become a hash set that is broadcast; whole documents are scanned against it,
and a hash hit counts only if the words are equal.

The set is broadcast in blocks of at most ``block`` windows.  A benchmark of
any size works: one block is one pass over the documents, and with more blocks
each pass adds its hits to rows that are written in between.

* null or empty text: no words, no hits, not contaminated;
* an item with null text or without words has no window; windows of an item
  without id mark words, but name no item;
* an item id on several rows is one item; repeated documents are judged alike;
* no benchmark rows: nothing is hit; no documents: no rows;
* other columns of the documents are kept by ``decontaminate`` and not looked at.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kilnstream.llm import bytetext
from kilnstream.sources.shared import shared_folder

WIDTH = 13
#: Windows in one broadcast block; at some 200 bytes each about 60 MB.
BLOCK = 300_000
#: A document is contaminated if one word in so many is hit.
WORDS_PER_HIT = 20

GRAM = pa.schema([("size", pa.int32()), ("gram", pa.binary()), ("item_id", pa.string())])


def read_words(data: np.ndarray, bounds: np.ndarray):
    """Lower-cased bytes with start, end and text number of the words."""
    lowered = bytetext.LOWER[data]
    return lowered, *bytetext.words(lowered, bounds, bytetext.ALPHANUMERIC)


def gram(content: bytes, begin: np.ndarray, end: np.ndarray) -> bytes:
    return b" ".join(content[b:e] for b, e in zip(begin.tolist(), end.tolist(), strict=True))


def benchmark_grams(benchmark: DataFrame, width: int) -> DataFrame:
    """Distinct windows of the items: size, words joined by a space, item id as text."""
    def run(batches):
        for batch in batches:
            ids = batch["item_id"].to_pylist()
            out = []
            for first, last, data, bounds in bytetext.chunks(batch["text"]):
                lowered, begin, end, text = read_words(data, bounds)
                content = lowered.tobytes()
                stops = np.searchsorted(text, np.arange(last - first + 1))
                for row in range(last - first):
                    low, high = int(stops[row]), int(stops[row + 1])
                    size = min(width, high - low)
                    for at in range(low, high - size + 1 if size else low):
                        words = slice(at, at + size)
                        out.append((size, gram(content, begin[words], end[words]),
                                    ids[first + row]))
            yield pa.RecordBatch.from_pylist(
                [dict(zip(GRAM.names, row, strict=True)) for row in out], schema=GRAM
            )

    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    return items.mapInArrow(run, "size int, gram binary, item_id string").distinct()


class GramTable:
    """One block of windows, looked up by hash and confirmed by words."""

    def __init__(self, rows: list[tuple[int, bytes, str | None]]):
        self.items: dict[bytes, set[str]] = {}
        by_size: dict[int, list[bytes]] = {}
        for size, words, item in rows:
            words = bytes(words)
            if words not in self.items:
                by_size.setdefault(size, []).append(words)
            found = self.items.setdefault(words, set())
            if item is not None:
                found.add(item)
        self.hashes = {size: np.unique(self._hashes(size, grams))
                       for size, grams in by_size.items()}
        self.marks = {size: self._marks(hashes) for size, hashes in self.hashes.items()}

    @staticmethod
    def _hashes(size: int, grams: list[bytes]) -> np.ndarray:
        lengths = np.array([0] + [len(words) for words in grams])
        data = np.frombuffer(b"".join(grams), np.uint8)
        begin, end, text = bytetext.words(data, np.cumsum(lengths), bytetext.ALPHANUMERIC)
        return bytetext.window_hashes(bytetext.span_hashes(data, begin, end), text, size)[0]

    @staticmethod
    def _marks(hashes: np.ndarray) -> np.ndarray:
        """Bitmap of the top 20 bits: most windows of a document end here."""
        marks = np.zeros(1 << 20, bool)
        marks[hashes >> np.uint64(44)] = True
        return marks

    def hits(self, lowered, begin, end, text):
        """First word, size and words of every window of the table found in the texts."""
        word_hashes = bytetext.span_hashes(lowered, begin, end)
        content = None
        for size, hashes in self.hashes.items():
            found, first = bytetext.window_hashes(word_hashes, text, size)
            maybe = np.flatnonzero(self.marks[size][found >> np.uint64(44)])
            place = np.searchsorted(hashes, found[maybe])
            place[place == len(hashes)] = 0
            for at in first[maybe[hashes[place] == found[maybe]]].tolist():
                content = content or lowered.tobytes()
                words = gram(content, begin[at:at + size], end[at:at + size])
                if words in self.items:
                    yield at, size, words


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans with those that touch or overlap joined."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


class Findings:
    """Of one batch: words per text, hit words and their bytes as spans, items."""

    def __init__(self, column: pa.Array, table: GramTable):
        n = len(column)
        self.n_words = np.zeros(n, np.int64)
        self.words: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        self.bytes: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        self.items: list[set[str]] = [set() for _ in range(n)]
        for first, last, data, bounds in bytetext.chunks(column):
            lowered, begin, end, text = read_words(data, bounds)
            self.n_words[first:last] = bytetext.words_per_text(text, last - first)
            first_word = np.searchsorted(text, np.arange(last - first))
            for at, size, words in table.hits(lowered, begin, end, text):
                own = int(text[at])
                row, word, base = first + own, at - int(first_word[own]), int(bounds[own])
                self.words[row].append((word, word + size))
                self.bytes[row].append((int(begin[at]) - base, int(end[at + size - 1]) - base))
                self.items[row] |= table.items[words]


HITS = "struct<words: array<bigint>, bytes: array<bigint>, items: array<string>>"
HITS_TYPE = pa.struct([("words", pa.list_(pa.int64())), ("bytes", pa.list_(pa.int64())),
                       ("items", pa.list_(pa.string()))])


def flat(spans: list[tuple[int, int]]) -> list[int]:
    return [edge for span in spans for edge in span]


def paired(edges: list[int]) -> list[tuple[int, int]]:
    return list(zip(edges[::2], edges[1::2], strict=True))


class Verdict:
    """What is known of one document after its last pass."""

    def __init__(self, n_words: int, words, cut, items):
        self.n_words = n_words
        self.n_hit = sum(high - low for low, high in merged(words))
        self.cut = merged(cut)
        self.items = sorted(items)
        self.contaminated = self.n_hit > 0 and WORDS_PER_HIT * self.n_hit >= n_words


def scan(docs: DataFrame, benchmark: DataFrame, answer, schema, width: int, block: int):
    """``answer(batch, verdicts)`` over all documents, after the passes of all blocks.

    The rows carry the document in one column and the hits so far in another,
    so that no name of a document's column can clash.  They are looked at, and leave the
    worker, some at a time, so that neither side holds a batch of texts twice.
    """
    spark = docs.sparkSession
    folder = shared_folder(spark)
    benchmark_grams(benchmark, width).write.parquet(f"{folder}/grams")
    grams = spark.read.schema("size int, gram binary, item_id string").parquet(f"{folder}/grams")
    n_blocks = max(1, -(-grams.count() // block))
    rows = docs.select(F.struct("*").alias("doc"),
                       F.lit(None).cast(HITS).alias("hits"))
    carried = rows.schema

    for number in range(n_blocks):
        own = grams.where(F.pmod(F.xxhash64("gram"), F.lit(n_blocks)) == number)
        table = spark.sparkContext.broadcast([tuple(row) for row in own.collect()])
        final = number == n_blocks - 1

        def run(batches, table=table, final=final):
            lookup = GramTable(table.value)
            for batch in bytetext.steps(batches):
                yield search(batch, lookup, answer if final else None)

        rows = rows.mapInArrow(run, schema if final else carried)
        if not final:
            rows.write.parquet(f"{folder}/pass-{number}")
            rows = spark.read.schema(carried).parquet(f"{folder}/pass-{number}")
    return rows


def search(batch: pa.RecordBatch, table: GramTable, answer) -> pa.RecordBatch:
    """One pass over one batch: the rows with more hits, or the answer if one is asked for."""
    docs = pa.RecordBatch.from_struct_array(batch["doc"])
    found = Findings(docs["text"], table)
    verdicts, hits = [], []
    for row, earlier in enumerate(batch["hits"].to_pylist()):
        earlier = earlier or {"words": [], "bytes": [], "items": []}
        words = merged(paired(earlier["words"]) + found.words[row])
        cut = merged(paired(earlier["bytes"]) + found.bytes[row])
        items = found.items[row].union(earlier["items"])
        if answer is None:
            hits.append({"words": flat(words), "bytes": flat(cut), "items": sorted(items)})
        else:
            verdicts.append(Verdict(int(found.n_words[row]), words, cut, items))
    if answer is not None:
        return answer(docs, verdicts)
    return pa.RecordBatch.from_arrays(
        [batch["doc"], pa.array(hits, HITS_TYPE)], names=["doc", "hits"]
    )


def contamination(
    docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, block: int = BLOCK
) -> DataFrame:
    """Word counts, hit items and verdict of every document."""
    def answer(batch, verdicts):
        joined = [",".join(verdict.items) for verdict in verdicts]
        return pa.RecordBatch.from_arrays([
            batch["doc_id"],
            pa.array([verdict.n_words for verdict in verdicts], pa.int64()),
            pa.array([verdict.n_hit for verdict in verdicts], pa.int64()),
            pa.array([len(verdict.items) for verdict in verdicts], pa.int64()),
            pa.array([hashlib.sha256(ids.encode()).hexdigest() for ids in joined], pa.string()),
            pa.array([verdict.contaminated for verdict in verdicts], pa.bool_()),
        ], names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return scan(rows, benchmark, answer, (
        f"doc_id {kind}, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, "
        "contaminated boolean"
    ), width, block)


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    remove: str = "documents",
    width: int = WIDTH,
    block: int = BLOCK,
) -> DataFrame:
    """The documents, all columns, without contamination.

    ``remove="documents"`` drops contaminated documents; ``remove="spans"`` keeps
    every document and cuts the hit words, with what stands between them, out of
    its text.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove is 'documents' or 'spans', not {remove!r}")
    at = docs.columns.index("text")

    def answer(batch, verdicts):
        if remove == "documents":
            return batch.filter(pa.array([not v.contaminated for v in verdicts], pa.bool_()))
        texts = [cut(text, verdict.cut) for text, verdict in
                 zip(batch["text"].to_pylist(), verdicts, strict=True)]
        return batch.set_column(at, batch.schema.field(at), pa.array(texts, pa.string()))

    return scan(docs, benchmark, answer, docs.schema, width, block)


def cut(text: str | None, spans: list[tuple[int, int]]) -> str | None:
    """The text without the byte spans, which never split a character."""
    if not spans:
        return text
    content, out, at = text.encode(), [], 0
    for low, high in spans:
        out.append(content[at:low])
        at = high
    return b"".join([*out, content[at:]]).decode()


def op2_decontamination(spark, sf_dir) -> DataFrame:
    return contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                         spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS = (
    f"regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
ORACLE = f"""
WITH docs AS (SELECT doc_id, coalesce({WORDS}, []) AS w FROM documents),
items AS (SELECT item_id, {WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), {WIDTH}) AS size,
    array_to_string(list_slice(w, i, i + least(len(w), {WIDTH}) - 1), ' ') AS g
  FROM (SELECT *, unnest(range(1, len(w) - least(len(w), {WIDTH}) + 2)) AS i
        FROM items WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT size FROM windows),
places AS (
  SELECT doc_id, size, i, array_to_string(list_slice(w, i, i + size - 1), ' ') AS g
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM docs, sizes)
), hits AS (
  SELECT doc_id, item_id, i, p.size FROM places p JOIN windows x ON p.g = x.g AND p.size = x.size
), hit_words AS (
  SELECT doc_id, count(DISTINCT n) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS n FROM hits) GROUP BY 1
), hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hits WHERE item_id IS NOT NULL)
  GROUP BY 1
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND {WORDS_PER_HIT} * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""
