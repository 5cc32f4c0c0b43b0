"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

A word's input is the sum of two embeddings: that of its hashed form and that of
its hashed character pieces with marks for the word's ends.  Two gated recurrent
passes, one in each direction, read a window of ``WINDOW`` words; attention over
their states gives one vector and one logit a window.  All overlapping windows of
a whole text are scored, and the text's score is the calibrated greatest logit.

The fit takes a bounded, documented sample: about ``MOST_LABELLED`` labelled
documents of each class that have a text, however long: of more than ``MOST_CHARS``
characters, so many in pieces spread evenly over the whole text.  A toxic document
need have only one toxic window, so after the first epoch only the window with the
greatest logit of every document is learned from.  There are ``EPOCHS`` epochs, or
as many as give ``LEAST_STEPS`` steps.

* null or empty text, or one without words: one window of blanks, learned as clean;
* shorter texts than a window are filled up with blanks; long texts have as many
  windows as they need, the last one ending with the text;
* a label that is null is not learned from; of several labels of an id the
  greatest counts; a null id is not held out and has no label;
* without labels of both classes on texts that are not held out, every score is the share of toxic labels (0
  without any);
* repeated rows are scored alike; an empty table gives an empty one; other
  columns are not looked at, and are kept by ``keep_clean``.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kilnstream.llm import bytetext, samples
from kilnstream.llm.samples import spread

WINDOW, STRIDE = 32, 16
STATE, EMBEDDING = 8, 12
WORD_ROWS, PIECE_ROWS = 1 << 14, 1 << 14
PIECES = (3, 4)
MOST_LABELLED, MOST_CHARS = 1200, 12_000
EPOCHS, BATCH, RATE, DECAY = 6, 48, 0.012, 1e-4
#: A small sample has more epochs, so that it takes as many steps.
LEAST_STEPS = 150
#: Blank texts that are learned as clean beside the labelled ones.
BLANKS = 16
#: Windows that are scored in step.
LANES = 2048
FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.7
#: Bytes of texts that are scored at a time: the arrays of a chunk are about sixty times as large.
SCORED_BYTES = 500_000

BLANK_BYTE, END_BYTE = 1, 2


class Words:
    """Words of some texts: rows of the distinct words and their character pieces."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        lowered = bytetext.LOWER[data]
        begin, end, text = bytetext.words(lowered, bounds, bytetext.ALPHANUMERIC)
        hashes = bytetext.span_hashes(lowered, begin, end)
        known, first, self.word = np.unique(hashes, return_index=True, return_inverse=True)
        self.n = len(known)
        self.row = (known % np.uint64(WORD_ROWS)).astype(np.int64)
        self.stops = np.searchsorted(text, np.arange(len(bounds)))
        self._pieces(lowered, begin[first], end[first])

    def _pieces(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> None:
        """Rows of the character pieces, word after word, and where each word's begin."""
        size = end - begin + 2
        stop = np.cumsum(size)
        owner = np.repeat(np.arange(len(size)), size)
        place = np.arange(len(owner)) - np.repeat(stop - size, size)
        marked = np.where(place == 0, BLANK_BYTE, END_BYTE).astype(np.uint64)
        inside = (place > 0) & (place < size[owner] - 1)
        marked[inside] = data[begin[owner[inside]] + place[inside] - 1]
        rows, owners = [], []
        for length in PIECES:
            count = max(0, len(owner) - length + 1)
            value = np.full(count, np.uint64(length))
            for offset in range(length):
                value = value * np.uint64(259) + marked[offset:offset + count]
            whole = owner[:count] == owner[length - 1:] if count else np.zeros(0, bool)
            rows.append((bytetext.mixed(value[whole]) % np.uint64(PIECE_ROWS)).astype(np.int64))
            owners.append(owner[:count][whole])
        rows, owners = np.concatenate(rows), np.concatenate(owners)
        order = np.argsort(owners, kind="stable")
        self.piece, self.owner = rows[order], owners[order]
        self.piece_stops = np.searchsorted(self.owner, np.arange(self.n))
        self.n_pieces = np.bincount(self.owner, minlength=self.n)

    def windows(self, stride: int) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of all windows (``n`` for a blank) and the text of each."""
        counts = np.diff(self.stops)
        n_windows = 1 + np.maximum(0, -(-(counts - WINDOW) // stride))
        text = np.repeat(np.arange(len(counts)), n_windows)
        number = np.arange(len(text)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
        first = np.minimum(number * stride, np.maximum(0, counts[text] - WINDOW))
        place = first[:, None] + np.arange(WINDOW)
        filled = place < counts[text][:, None]
        words = np.append(self.word, self.n)
        source = np.where(filled, self.stops[text][:, None] + place, len(words) - 1)
        return words[source], text


@dataclass
class Network:
    """Weights; ``forth`` and ``back`` are the two directions."""

    weights: dict[str, np.ndarray]
    scale: float = 1.0
    shift: float = 0.0

    def inputs(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Embedding of every distinct word and of the blank, and its gate inputs."""
        w = self.weights
        vectors = np.zeros((words.n + 1, EMBEDDING), np.float32)
        if words.n:
            vectors[:-1] = np.add.reduceat(w["piece"][words.piece], words.piece_stops, axis=0)
            vectors[:-1] /= np.sqrt(words.n_pieces, dtype=np.float32)[:, None]
            vectors[:-1] += w["word"][words.row]
        return vectors, vectors @ w["in"] + w["in_bias"]

    def states(self, gates: np.ndarray, windows: np.ndarray, side: int, trace: list | None = None):
        """States of one direction at every place of the windows, places first."""
        w, n = self.weights, len(windows)
        own = np.ascontiguousarray(gates[:, 3 * STATE * side:3 * STATE * (side + 1)])
        u_gate, u_new = w["gate"][side], w["new"][side]
        h = np.zeros((n, STATE), np.float32)
        out = np.empty((WINDOW, n, STATE), np.float32)
        for step in range(WINDOW):
            place = step if side == 0 else WINDOW - 1 - step
            row = own[windows[:, place]]
            gate = h @ u_gate
            gate += row[:, :2 * STATE]
            gate *= 0.5
            np.tanh(gate, out=gate)
            gate += 1
            gate *= 0.5
            keep, reset = gate[:, :STATE], gate[:, STATE:]
            new = (reset * h) @ u_new
            new += row[:, 2 * STATE:]
            np.tanh(new, out=new)
            if trace is not None:
                trace.append((place, h, keep, reset, new))
            h = new + keep * (h - new)
            out[place] = h
        return out

    def pooled(self, gates: np.ndarray, windows: np.ndarray, traces: tuple = (None, None)):
        """Both directions' states, the attention over places and the pooled vector."""
        both = np.concatenate([self.states(gates, windows, side, traces[side])
                               for side in (0, 1)], axis=2)
        weight = both @ self.weights["look"]
        weight -= weight.max(axis=0)
        np.exp(weight, out=weight)
        weight /= weight.sum(axis=0)
        return both, weight, np.einsum("tb,tbs->bs", weight, both)

    def logits(self, gates: np.ndarray, windows: np.ndarray) -> np.ndarray:
        out = np.empty(len(windows), np.float32)
        for low in range(0, len(windows), LANES):
            pooled = self.pooled(gates, windows[low:low + LANES])[2]
            out[low:low + LANES] = pooled @ self.weights["out"] + self.weights["bias"][0]
        return out

    def text_logits(self, data: np.ndarray, bounds: np.ndarray, stride: int = STRIDE):
        """Greatest logit over all windows of every text."""
        words = Words(data, bounds)
        windows, text = words.windows(stride)
        logits = self.logits(self.inputs(words)[1], windows)
        return np.maximum.reduceat(logits, np.searchsorted(text, np.arange(len(bounds) - 1)))

    def scores(self, logits: np.ndarray) -> np.ndarray:
        scaled = self.scale * logits.astype(np.float64) + self.shift
        return np.round(0.5 * (1 + np.tanh(0.5 * scaled)), 6)

    def gradients(self, words: Words, windows: np.ndarray, target: np.ndarray):
        """Gradients of the mean logistic loss over the windows."""
        w, n = self.weights, len(windows)
        vectors, gates = self.inputs(words)
        traces = ([], [])
        both, weight, pooled = self.pooled(gates, windows, traces)
        chance = 1 / (1 + np.exp(-(pooled @ w["out"] + w["bias"][0])))
        d_logit = ((chance - target) / n).astype(np.float32)
        grads = {name: np.zeros_like(value) for name, value in w.items()}
        grads["out"] = pooled.T @ d_logit
        grads["bias"][0] = d_logit.sum()
        d_pooled = d_logit[:, None] * w["out"]
        d_weight = np.einsum("bs,tbs->tb", d_pooled, both)
        d_look = weight * (d_weight - (weight * d_weight).sum(axis=0))
        grads["look"] = np.einsum("tb,tbs->s", d_look, both)
        d_both = weight[:, :, None] * d_pooled + d_look[:, :, None] * w["look"]
        d_gates = np.zeros_like(gates)
        for side in (0, 1):
            self._back(side, traces[side], d_both[:, :, STATE * side:STATE * (side + 1)],
                       windows, grads, d_gates)
        grads["in"], grads["in_bias"] = vectors.T @ d_gates, d_gates.sum(axis=0)
        d_vectors = (d_gates @ w["in"].T)[:-1]
        np.add.at(grads["word"], words.row, d_vectors)
        d_vectors /= np.sqrt(words.n_pieces, dtype=np.float32)[:, None]
        np.add.at(grads["piece"], words.piece, d_vectors[words.owner])
        return grads

    def _back(self, side, trace, d_states, windows, grads, d_gates) -> None:
        u_gate, u_new = self.weights["gate"][side], self.weights["new"][side]
        d_h = np.zeros((len(windows), STATE), np.float32)
        columns = slice(3 * STATE * side, 3 * STATE * (side + 1))
        for place, before, keep, reset, new in reversed(trace):
            d_h = d_h + d_states[place]
            d_new = d_h * (1 - keep) * (1 - new * new)
            d_product = d_new @ u_new.T
            d_gate = np.concatenate([
                d_h * (before - new) * keep * (1 - keep),
                d_product * before * reset * (1 - reset),
            ], axis=1)
            grads["gate"][side] += before.T @ d_gate
            grads["new"][side] += (reset * before).T @ d_new
            np.add.at(d_gates[:, columns], windows[:, place],
                      np.concatenate([d_gate, d_new], axis=1))
            d_h = d_h * keep + d_product * reset + d_gate @ u_gate.T


def new_network(random: np.random.Generator) -> Network:
    def normal(*shape: int, size: float) -> np.ndarray:
        return (random.standard_normal(shape) * size).astype(np.float32)

    return Network({
        "word": normal(WORD_ROWS, EMBEDDING, size=0.05),
        "piece": normal(PIECE_ROWS, EMBEDDING, size=0.05),
        "in": normal(EMBEDDING, 6 * STATE, size=EMBEDDING**-0.5),
        "in_bias": np.zeros(6 * STATE, np.float32),
        "gate": normal(2, STATE, 2 * STATE, size=STATE**-0.5),
        "new": normal(2, STATE, STATE, size=STATE**-0.5),
        "look": normal(2 * STATE, size=0.1),
        "out": normal(2 * STATE, size=0.3),
        "bias": np.zeros(1, np.float32),
    })


def packed(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    content = [text.encode() for text in texts]
    bounds = np.concatenate([[0], np.cumsum([len(text) for text in content])]).astype(np.int64)
    return np.frombuffer(b"".join(content), np.uint8), bounds


def fit(texts: list[str], toxic: list[int], epochs: int = EPOCHS, seed: int = 7) -> Network:
    """The network for texts with labels 0 and 1, both present."""
    texts, toxic = texts + [""] * BLANKS, toxic + [0] * BLANKS
    random = np.random.default_rng(seed)
    network = new_network(random)
    weights = network.weights
    mean = {name: np.zeros_like(value) for name, value in weights.items()}
    square = {name: np.zeros_like(value) for name, value in weights.items()}
    labels, steps = np.array(toxic, np.float32), 0
    epochs = max(epochs, -(-LEAST_STEPS * BATCH // len(texts)))
    for epoch in range(epochs):
        order = random.permutation(len(texts))
        for low in range(0, len(order), BATCH):
            chosen = order[low:low + BATCH]
            words = Words(*packed([texts[at] for at in chosen]))
            windows, text = words.windows(WINDOW)
            if epoch:
                logits = network.logits(network.inputs(words)[1], windows)
                by_logit = np.lexsort((logits, text))
                picked = by_logit[np.searchsorted(text, np.arange(len(chosen)), "right") - 1]
                windows, text = windows[picked], text[picked]
            grads = network.gradients(words, windows, labels[chosen][text])
            steps += 1
            rate = RATE * (1 - 0.9 * epoch / epochs)
            for name, grad in grads.items():
                mean[name] += 0.1 * (grad - mean[name])
                square[name] += 0.01 * (grad * grad - square[name])
                step = mean[name] / (1 - 0.9**steps)
                step /= np.sqrt(square[name] / (1 - 0.99**steps)) + 1e-7
                weights[name] -= rate * (step + DECAY * weights[name])
    calibrate(network, sample_logits(network, texts), labels)
    return network


def sample_logits(network: Network, texts: list[str]) -> np.ndarray:
    """Logits of the texts of a sample, a chunk at a time: the driver holds no more of them either."""
    return np.concatenate([
        network.text_logits(data, bounds)
        for _, _, data, bounds in bytetext.chunks(pa.array(texts, pa.string()), SCORED_BYTES)
    ])


def calibrate(network: Network, logits: np.ndarray, labels: np.ndarray) -> None:
    """Scale and shift that make the scores of the fitted texts likeliest, held back a little."""
    x, scale, shift = logits.astype(np.float64), 1.0, 0.0
    for _ in range(50):
        chance = 1 / (1 + np.exp(-np.clip(scale * x + shift, -30, 30)))
        slope, curve = chance - labels, chance * (1 - chance)
        gradient = np.array([(slope * x).sum() + 0.5 * (scale - 1), slope.sum() + 0.05 * shift])
        hessian = np.array([[(curve * x * x).sum() + 0.5, (curve * x).sum()],
                            [(curve * x).sum(), curve.sum() + 0.05]])
        move = np.clip(np.linalg.solve(hessian, gradient), -0.5, 0.5)
        scale, shift = scale - move[0], shift - move[1]
    network.scale, network.shift = max(float(scale), 0.05), float(shift)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, most: int, most_chars: int
) -> tuple[list[str], list[int]]:
    """Texts and labels of the sample; the ids are chosen among labels that have a text."""
    texts = docs.where(F.length("text") > 0).select("doc_id", "text")
    usable = (
        labels.where((samples.remainder(FOLDS) != HELD_OUT) & F.col("toxic").isin(0, 1))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .join(texts.select("doc_id"), "doc_id", "left_semi")
    )
    shares = {row[0]: min(1.0, most / row[1])
              for row in usable.groupBy("toxic").count().collect()}
    taken = F.lit(0)
    for label, share in shares.items():
        taken = F.when(F.col("toxic") == label, int(share * samples.STEPS)).otherwise(taken)
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(samples.STEPS))
    ids = usable.where(place < taken)
    chosen = docs.sparkSession.createDataFrame(
        [tuple(row) for row in ids.collect()], usable.schema
    )
    rows = (
        texts.join(F.broadcast(chosen), "doc_id")
        .select("doc_id", spread("text", most_chars).alias("text"), "toxic").groupBy("doc_id")
        .agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).collect()
    )
    rows.sort(key=lambda row: (str(row["doc_id"]), row["text"]))
    return [row["text"] for row in rows], [int(row["toxic"]) for row in rows]


def learn(
    docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED, most_chars: int = MOST_CHARS
) -> Network | float:
    """The fitted network, or one score for all where there is nothing to tell apart."""
    texts, toxic = labelled_sample(docs, labels, most, most_chars)
    if len(set(toxic)) < 2:
        return float(toxic[0]) if toxic else 0.0
    return fit(texts, toxic)


def chunk_scores(
    model: Network | float, column: pa.Array
) -> Iterator[tuple[int, int, np.ndarray]]:
    """Rows ``first`` to ``last`` with their scores, a chunk of texts at a time."""
    for first, last, data, bounds in bytetext.chunks(column, SCORED_BYTES):
        yield first, last, (model.scores(model.text_logits(data, bounds))
                            if isinstance(model, Network) else np.full(last - first, model))


def batch_scores(model: Network | float, column: pa.Array) -> np.ndarray:
    out = np.zeros(len(column))
    for first, last, scores in chunk_scores(model, column):
        out[first:last] = scores
    return out


def score(docs: DataFrame, model: Network | float) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            scores = batch_scores(shared.value, batch["text"])
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["held_out"], pa.array(scores),
                 pa.array((scores >= THRESHOLD).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    held_out = F.coalesce(samples.remainder(FOLDS) == HELD_OUT, F.lit(False)).alias("held_out")
    rows = docs.select("doc_id", held_out, "text")
    schema = rows.drop("text").schema.add("score", T.DoubleType()) \
        .add("predicted", T.IntegerType())
    return rows.mapInArrow(run, schema)


def keep_clean(docs: DataFrame, model: Network | float) -> DataFrame:
    """The documents, all columns, whose score is below the threshold.

    They leave the worker in chunks, so that neither side holds a batch of texts twice.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for first, last, scores in chunk_scores(shared.value, batch["text"]):
                yield batch.slice(first, last - first).filter(pa.array(scores < THRESHOLD))

    return docs.mapInArrow(run, docs.schema)


def op3_toxicity(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(docs, learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
