"""Language ID by partial matching: code lengths under byte context trees.

For every language a tree of byte contexts holds the counts of the byte that
follows; the trees share their nodes.  A byte is coded in its longest known
context; one that was never seen there costs an escape (method C: as likely as
the number of different bytes seen there) and is then coded in the context that
is one byte shorter, down to equal chances for all 256 bytes.  The statistics
are frozen, so the code length of a text is a sum over its bytes; it is kept in
steps of 2**-``SCALE`` bit and so is exact and the same on every machine.  The
language with the shortest code wins.

The fit takes a bounded, documented sample: about ``MOST_DOCS`` documents over
all languages, in equal parts, and ``MOST_CHARS`` characters of each, in pieces from
all over a longer text.  Every text is scored whole.

* null text, or one without a letter: ``und`` with score 0;
* equal code lengths: the language that sorts first;
* nothing to learn from: ``und`` for all; an empty table gives an empty one;
* a null id is neither learned from nor held out; repeated rows are scored alike;
  other columns are not looked at.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kilnstream.llm import bytetext, samples

UNKNOWN = "und"
ORDER = 3
MOST_DOCS = 2400
MOST_CHARS = 8000
LEAST_COUNT = 2
SCALE = 16
FOLDS, HELD_OUT = 4, 2

ASCII_LETTER = bytetext.byte_set((0x41, 0x5A), (0x61, 0x7A))


@dataclass(frozen=True)
class Trees:
    """Nodes of all languages by depth; row 0 of every table stands for "never seen".

    ``child[d]`` leads from a node of depth d and a symbol to a node of depth d + 1.
    ``cost[d]`` is the code length of a node's last byte after the bytes before it;
    ``escape[d]`` that of leaving the node's context; one column a language.
    """

    langs: list[str]
    symbol: np.ndarray
    child: list[np.ndarray]
    cost: list[np.ndarray]
    escape: list[np.ndarray]

    @property
    def order(self) -> int:
        return len(self.child) - 1

    def nodes(self, data: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
        """For every depth and place, the node of the bytes that end there, or 0."""
        symbols = self.symbol[data]
        found, before = [symbols], symbols
        width = self.child[1].shape[1] if self.order else 0
        for depth in range(1, self.order + 1):
            now = np.zeros(len(data), np.int32)
            np.take(self.child[depth].ravel(), before[:-1] * width + symbols[1:], out=now[1:])
            for near in range(depth):
                inside = starts + near
                now[inside[inside < len(data)]] = 0
            found.append(now)
            before = now
        return found

    def code_lengths(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Length of every text in every language, in steps of 2**-SCALE bit."""
        total = np.zeros((len(data) + 1, len(self.langs)), np.int64)
        if len(data):
            found = self.nodes(data, bounds[:-1])
            cost = self.cost[self.order][found[-1]]
            open_places = np.flatnonzero(found[-1] == 0)
            cost[open_places] = 0
            for depth in range(self.order - 1, -1, -1):
                # open_places are those whose depth + 2 bytes were never seen together
                context = found[depth][open_places - 1]
                context[open_places == 0] = 0
                at_start = np.isin(open_places, bounds[:-1])
                context[at_start] = 0
                cost[open_places] += self.escape[depth][context]
                node = found[depth][open_places]
                known = node > 0 if depth else np.ones(len(node), bool)
                cost[open_places[known]] += self.cost[depth][node[known]]
                open_places = open_places[~known]
            np.cumsum(cost, axis=0, dtype=np.int64, out=total[1:])
        return total[bounds[1:]] - total[bounds[:-1]]


def fit(texts: list[bytes], labels: list[str], order: int = ORDER) -> Trees:
    """Trees of the texts' languages; contexts seen fewer than twice are left out."""
    langs = sorted(set(labels))
    data = np.frombuffer(b"".join(texts), np.uint8)
    lengths = np.array([len(text) for text in texts], np.int64)
    starts = (np.cumsum(lengths) - lengths)[lengths > 0]
    lang = np.repeat([langs.index(label) for label in labels], lengths)
    seen = np.unique(data)
    symbol = np.zeros(256, np.int32)
    symbol[seen] = np.arange(1, len(seen) + 1)
    width, n = len(seen) + 1, len(langs)

    def tally(nodes: np.ndarray, size: int) -> np.ndarray:
        keys, times = np.unique(nodes.astype(np.int64) * n + lang, return_counts=True)
        out = np.zeros((size, n), np.int64)
        out[keys // n, keys % n] = times
        out[0] = 0
        return out

    def bits(chance: np.ndarray) -> np.ndarray:
        return np.round(-np.log2(chance) * (1 << SCALE)).astype(np.int32)

    symbols = symbol[data]
    levels, child = [symbols], [np.zeros((1, width), np.int32)]
    counts = [tally(symbols, width)]
    shorter = [np.zeros(width, np.int32)]
    context = [np.zeros(width, np.int32)]
    before = symbols
    for depth in range(1, order + 1):
        valid = np.ones(len(data), bool)
        for near in range(depth):
            inside = starts + near
            valid[inside[inside < len(data)]] = False
        valid[1:] &= before[:-1] > 0
        keys = np.zeros(len(data), np.int64)
        keys[1:] = before[:-1].astype(np.int64) * width + symbols[1:]
        names, first, times = np.unique(keys[valid], return_index=True, return_counts=True)
        kept = times >= LEAST_COUNT
        names, first = names[kept], np.flatnonzero(valid)[first[kept]]
        table = np.zeros((counts[-1].shape[0], width), np.int32)
        table.ravel()[names] = np.arange(1, len(names) + 1)
        now = np.where(valid, table.ravel()[np.where(valid, keys, 0)], 0).astype(np.int32)
        shorter.append(np.concatenate([[0], levels[-1][first]]).astype(np.int32))
        context.append(np.concatenate([[0], names // width]).astype(np.int32))
        counts.append(tally(now, len(names) + 1))
        levels.append(now)
        child.append(table)
        before = now

    cost, escape = [], []
    for depth in range(order + 1):
        n_contexts = counts[depth - 1].shape[0] if depth else 1
        follow, kinds = np.zeros((2, n_contexts, n), np.int64)
        np.add.at(follow, context[depth], counts[depth])
        np.add.at(kinds, context[depth], counts[depth] > 0)
        if depth:
            follow[0] = kinds[0] = 0
        with np.errstate(divide="ignore", invalid="ignore"):
            leave = np.where(follow > 0, bits(kinds / (follow + kinds)), 0).astype(np.int32)
            own = bits(counts[depth] / (follow + kinds)[context[depth]])
        fallback = cost[depth - 1][shorter[depth]] if depth else np.int32(8 << SCALE)
        cost.append(np.where(counts[depth] > 0, own, leave[context[depth]] + fallback)
                    .astype(np.int32))
        if depth:
            escape.append(leave)
    return Trees(langs, symbol, child, cost, escape)


def has_letter(column: pa.Array, row: int) -> bool:
    return any(map(str.isalpha, column[row].as_py() or ""))


def predict(
    docs: DataFrame, trees: Trees | None, columns: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """``columns`` of the documents with ``lang_pred`` and ``score``, the winner's posterior."""
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(trees)

    def run(batches):
        trees = model.value
        for batch in batches:
            n = batch.num_rows
            names, scores = np.full(n, UNKNOWN, object), np.zeros(n)
            if trees is not None:
                for first, last, data, bounds in bytetext.chunks(batch["text"]):
                    letters = np.concatenate([[0], np.cumsum(ASCII_LETTER[data])])
                    judged = letters[bounds[1:]] > letters[bounds[:-1]]
                    for row in np.flatnonzero(~judged):
                        judged[row] = has_letter(batch["text"], first + int(row))
                    length = trees.code_lengths(data, bounds)
                    best = length.argmin(axis=1)
                    more = (length - length.min(axis=1, keepdims=True)) / (1 << SCALE)
                    chance = 1 / np.exp2(-np.minimum(more, 1000)).sum(axis=1)
                    names[first:last][judged] = np.array(trees.langs, object)[best[judged]]
                    scores[first:last][judged] = chance[judged]
            yield pa.RecordBatch.from_arrays(
                [*(batch[name] for name in columns), pa.array(names, pa.string()),
                 pa.array(scores, pa.float64())],
                names=[*columns, "lang_pred", "score"],
            )

    schema = docs.select(*columns).schema.add("lang_pred", "string").add("score", "double")
    return docs.select(*columns, "text").mapInArrow(run, schema)


def learn(
    labelled: DataFrame, order: int = ORDER, most_docs: int = MOST_DOCS,
    most_chars: int = MOST_CHARS,
) -> Trees | None:
    """Trees fitted to a bounded sample of rows with ``doc_id, text, lang``."""
    rows = labelled.where("text IS NOT NULL AND lang IS NOT NULL AND doc_id IS NOT NULL")
    n_langs = max(1, rows.select("lang").distinct().count())
    texts = samples.bounded(rows, "lang", max(1, most_docs // n_langs), most_chars)
    if not texts:
        return None
    return fit([text.encode() for _, text, _ in texts], [lang for _, _, lang in texts], order)


def identify(docs: DataFrame, order: int = ORDER, most_docs: int = MOST_DOCS) -> DataFrame:
    """Learn from the rows of the other folds, then predict every row."""
    fold = samples.remainder(FOLDS)
    trees = learn(docs.select("doc_id", "text", "lang").where(fold != HELD_OUT), order, most_docs)
    rows = docs.select(
        "doc_id", F.coalesce(fold == HELD_OUT, F.lit(False)).alias("held_out"), "text"
    )
    return predict(rows, trees, ("doc_id", "held_out"))


def op6_language_id(spark, sf_dir) -> DataFrame:
    return identify(spark.read.parquet(f"{sf_dir}/documents.parquet"))
