"""What a Python worker holds at a time."""

import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa

from kilnstream.llm import byte_bpe, bytetext, decontamination, near_duplicates, toxicity


class Sizes(toxicity.Network):
    """Notes the bytes of every chunk; the score of a text is 1 / (1 + its length)."""

    def __init__(self):
        self.seen = []

    def text_logits(self, data, bounds):
        self.seen.append(len(data))
        return np.diff(bounds)

    def scores(self, logits):
        return 1 / (1 + logits)


def test_texts_are_scored_in_small_chunks():
    texts = ["x" * (9_000 + n) for n in range(200)] + [None, "", "y" * 1_200_000, "z"]
    network = Sizes()
    found = toxicity.batch_scores(network, pa.array(texts))
    assert found.tolist() == [1 / (1 + len(text or "")) for text in texts]
    assert sum(network.seen) == sum(len(text or "") for text in texts)
    assert sorted(network.seen)[-2] <= 500_000 and max(network.seen) <= 1_200_000


def test_the_sample_is_calibrated_in_small_chunks():
    texts = ["x" * (9_000 + n) for n in range(200)] + ["", "y" * 1_200_000, "z"]
    network = Sizes()
    assert toxicity.sample_logits(network, texts).tolist() == [len(text) for text in texts]
    assert sorted(network.seen)[-2] <= 500_000 and max(network.seen) <= 1_200_000


def test_sets_of_shingles_are_made_in_small_chunks():
    words = [" ".join(f"w{(7 * n + at) % 9973}" for at in range(300)) for n in range(1500)]
    column = pa.array([None, "", *words])
    tracemalloc.start()
    sizes = [len(found) for found in near_duplicates.shingle_sets(column, 5)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sizes == [0, 0] + [296] * 1500
    assert peak < 40_000_000


def test_sketches_leave_in_small_steps():
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(2500))})
    parts = list(near_duplicates.steps([batch, batch.slice(0, 0)]))
    assert [part.num_rows for part in parts] == [1000, 1000, 500]
    assert [n for part in parts for n in part["doc_id"].to_pylist()] == list(range(2500))


def test_memory_goes_back_after_the_chunks_of_a_batch(monkeypatch):
    calls = []
    monkeypatch.setattr(bytetext, "give_back", lambda: calls.append(1))
    found = [last for _, last, _, _ in bytetext.chunks(pa.array(["abc", None, "defg"]), 3)]
    assert found == [2, 3] and calls == [1]
    monkeypatch.undo()
    bytetext.give_back()


def test_decontaminated_texts_leave_in_small_steps(spark):
    docs = spark.range(2500).selectExpr("id AS doc_id", "concat('w', id) AS text").coalesce(1)
    items = spark.createDataFrame([("a", "w7"), ("b", "w2400 w2401")], "item_id string, text string")

    def answer(batch, verdicts):
        return pa.RecordBatch.from_pydict(
            {"n": [batch.num_rows], "hits": [sum(verdict.n_hit for verdict in verdicts)]})

    rows = decontamination.scan(docs, items, answer, "n bigint, hits bigint", 13, 1000).collect()
    assert [row["n"] for row in rows] == [1000, 1000, 500]
    assert [row["hits"] for row in rows] == [1, 0, 0]


def test_words_are_remembered_once():
    bpe = byte_bpe.ByteBPE(byte_bpe.tokenizer(public_tokenizers.path(byte_bpe.RANKS)).ranks,
                           public_tokenizers.PATTERN)
    fresh = byte_bpe.ByteBPE(bpe.ranks, "(?:" + public_tokenizers.PATTERN + ")")
    texts = ["so zyxwv qqq's end ", "so  zyxwv\n qqq's zyxwv \t end", " zyxwv", "", " \n zyxwv's"]
    for text in texts:
        assert bpe.encode(text) == fresh.encode(text)
    assert "zyxwv" in bpe.after_space and " zyxwv" not in bpe.known
