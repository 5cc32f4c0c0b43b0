"""Language ID, toxicity, quotations and the pipeline."""

import math
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from corpus_cases import documents, found  # noqa: F401

import corpus_pipeline
from kilnstream.llm import bytetext, language_id, quotations, toxicity

SYLLABLES = {"aa": ["ka", "to", "mi", "ra"], "bb": ["sch", "ung", "ei", "pf"], "cc": ["é", "eau", "x"]}
INSULT = "grumblefoul"


def prose(lang, n, rng):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4)))
                    for _ in range(n))


def brute_bits(texts, labels, order, text, lang):
    """Code length in bits: counts and escapes straight from their definition."""
    every, own = Counter(), Counter()
    for sample, label in zip(texts, labels, strict=True):
        for size in range(1, order + 2):
            for at in range(len(sample) - size + 1):
                every[sample[at:at + size]] += 1
                own[sample[at:at + size]] += label == lang
    known = {s for s, n in every.items() if len(s) == 1 or n >= language_id.LEAST_COUNT}
    known = {s for s in known if all(s[:k] in known for k in range(1, len(s)))}

    def bits(chance):
        return round(-math.log2(chance) * (1 << language_id.SCALE))

    total = 0
    for at in range(len(text)):
        for size in range(min(order, at), -1, -1):
            context, byte = text[at - size:at], text[at:at + 1]
            follow = [own[context + bytes([b])] for b in range(256) if context + bytes([b]) in known]
            n, kinds = sum(follow), sum(1 for x in follow if x)
            if n and context + byte in known and own[context + byte]:
                total += bits(own[context + byte] / (n + kinds))
                break
            if n:
                total += bits(kinds / (n + kinds))
        else:
            total += 8 << language_id.SCALE
    return total


def test_code_lengths_equal_definition():
    rng = random.Random(1)
    labels = ["aa", "bb", "cc"] * 4
    texts = [prose(lang, 12, rng).encode() for lang in labels]
    trees = language_id.fit(texts, labels, 3)
    asked = [prose("aa", 5, rng).encode(), b"", b"schqq ka", "eau\x00é".encode(), b"s"]
    bounds = np.cumsum([0] + [len(text) for text in asked])
    found = trees.code_lengths(np.frombuffer(b"".join(asked), np.uint8), bounds)
    assert found.tolist() == [
        [brute_bits(texts, labels, 3, text, lang) for lang in trees.langs] for text in asked]


def test_language_id(documents):
    rng = random.Random(2)
    rows = [(n, prose(lang, rng.randint(3, 40), rng), lang)
            for n, lang in enumerate(rng.choice(list(SYLLABLES)) for _ in range(300))]
    rows += [(900, None, "aa"), (901, "", "bb"), (902, "12 3!", "cc"), (903, "ka " * 20_000, None),
             (904, "漢", None), (None, "kato", "aa"), (903, "ka " * 20_000, None)]
    result = {row["doc_id"]: row for row in language_id.identify(documents(rows)).collect()}
    assert len(result) == len(rows) - 1
    for doc_id, _, lang in rows[:300]:
        assert result[doc_id]["lang_pred"] == lang
        assert result[doc_id]["held_out"] == (zlib.crc32(str(doc_id).encode()) % 4 == 2)
    for doc_id in (900, 901, 902):
        assert (result[doc_id]["lang_pred"], result[doc_id]["score"]) == ("und", 0.0)
    assert result[903]["lang_pred"] == "aa" and 0 < result[904]["score"] <= 1
    nothing = documents([(1, "some words"), (2, None)])
    assert {row["lang_pred"] for row in language_id.identify(nothing).collect()} == {"und"}
    assert language_id.identify(nothing.where("false")).count() == 0


def test_gradients_equal_differences():
    network = toxicity.new_network(np.random.default_rng(1))
    for name in network.weights:
        network.weights[name] = network.weights[name].astype(np.float64) * 3
    words = toxicity.Words(*toxicity.packed(["one two " * 20, "", "three"]))
    windows, text = words.windows(toxicity.WINDOW)
    target = np.array([1, 0, 1])[text]

    def loss():
        pooled = network.pooled(network.inputs(words)[1], windows)[2]
        logits = pooled @ network.weights["out"] + network.weights["bias"][0]
        return np.mean(np.log1p(np.exp(logits)) - target * logits)

    for name, grad in network.gradients(words, windows, target).items():
        weight, at = network.weights[name], np.unravel_index(np.abs(grad).argmax(), grad.shape)
        before = weight[at]
        weight[at] = before + 2e-4
        up = loss()
        weight[at] = before - 2e-4
        slope = (up - loss()) / 4e-4
        weight[at] = before
        assert grad[at] == pytest.approx(slope, rel=0.05, abs=1e-3)


def test_windows_cover_every_word():
    texts = ["", "a", " ".join("abcdefgh"[n % 8] * (n % 5 + 1) for n in range(101))]
    words = toxicity.Words(*toxicity.packed(texts))
    windows, text = words.windows(toxicity.STRIDE)
    assert text.tolist() == [0, 1] + [2] * 6
    assert (windows[0] == words.n).all() and (windows[1] != words.n).sum() == 1
    assert windows[-1].tolist() == words.word[-toxicity.WINDOW:].tolist()


@pytest.fixture(scope="module")
def toxic_rows():
    rng = random.Random(3)
    rows = []
    for n in range(420):
        words = prose(rng.choice(["aa", "bb"]), rng.randint(10, 120), rng).split()
        toxic = n % 3 == 0
        for _ in range(2 * toxic):
            words.insert(rng.randrange(len(words)), INSULT + rng.choice(["", "er", "ly"]))
        rows.append((n, " ".join(words), int(toxic)))
    return rows


def test_language_is_learned_from_all_of_a_long_text(documents):
    """Starts that say nothing, longer than what is taken of a text."""
    random.seed(9)
    words = {"aa": ["dorun", "kelam", "vosti"], "bb": ["pshet", "grazh", "wyncz"]}

    def text(lang, size):
        return " ".join(random.choice(words[lang]) for _ in range(size))

    rows = [(n, "0 " * 8000 + text(lang, 4000), lang)
            for n, lang in enumerate(["aa", "bb"] * 6)]
    docs = documents([row[:2] for row in rows])
    labelled = docs.sparkSession.createDataFrame(rows, "doc_id bigint, text string, lang string")
    trees = language_id.learn(labelled)
    asked = documents([(n, text(lang, 12)) for n, lang in enumerate(["aa", "bb"] * 4)])
    assert {row["doc_id"]: row["lang_pred"]
            for row in language_id.predict(asked, trees).collect()} == {
        n: lang for n, lang in enumerate(["aa", "bb"] * 4)}


def test_toxicity(spark, documents, toxic_rows):
    clean = " ".join(text for _, text, toxic in toxic_rows[:300] if not toxic)
    rows = [row[:2] for row in toxic_rows] + [
        (900, None), (901, ""), (902, clean), (903, f"{clean} {INSULT} {clean}"), (904, "###"),
        (None, clean), (902, clean)]
    labels = spark.createDataFrame(
        [(n, 0, toxic) for n, _, toxic in toxic_rows] + [(5, 0, None), (None, 0, 1), (901, 0, 0)],
        "doc_id bigint, quality int, toxic int")
    docs = documents(rows)
    model = toxicity.learn(docs, labels)
    result = {row["doc_id"]: row for row in toxicity.score(docs, model).collect()}
    held = [(toxic, result[n]["predicted"]) for n, _, toxic in toxic_rows if result[n]["held_out"]]
    assert len(held) > 100 and sum(a == b for a, b in held) >= 0.97 * len(held)
    assert all(result[n]["held_out"] == (zlib.crc32(str(n).encode()) % 3 == 1) for n in range(420))
    assert all(0 <= row["score"] <= 1 for row in result.values())
    assert result[900]["score"] == result[901]["score"] == result[904]["score"]
    assert result[902]["predicted"] == 0 and result[903]["predicted"] == 1
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == sum(1 for i, _ in rows if result[i]["predicted"] == 0)
    assert toxicity.score(docs.where("false"), model).count() == 0
    assert toxicity.learn(docs, labels.where("false")) == 0.0


def test_toxicity_learns_from_long_texts(spark, documents, toxic_rows):
    """One class has long texts only; then both have."""
    rng = random.Random(9)
    tail = prose("aa", 900, rng)
    labels = spark.createDataFrame([(n, 0, toxic) for n, _, toxic in toxic_rows],
                                   "doc_id bigint, quality int, toxic int")
    for longer in ({1}, {0, 1}):
        docs = documents([(n, f"{text} {tail}" if toxic in longer else text)
                          for n, text, toxic in toxic_rows])
        texts, toxic = toxicity.labelled_sample(docs, labels, 1200, 3000)
        assert len(texts) == sum(zlib.crc32(str(n).encode()) % 3 != 1 for n, *_ in toxic_rows)
        assert set(toxic) == {0, 1} and all(0 < len(text) <= 3100 for text in texts)
        assert isinstance(toxicity.learn(docs, labels), toxicity.Network)
    ends = documents([(0, "first " + "x " * 50_000 + "last")])
    text = ends.select(toxicity.spread("text", 3000).alias("text")).first()["text"]
    assert len(text) > 2500 and set(text.split()) <= {"first", "x", "last"}


SMALL = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test data")
def test_toxicity_of_few_labels_finds_held_out_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    scored = toxicity.score(docs, toxicity.learn(docs, labels)).where("held_out")
    rows = scored.join(labels.select("doc_id", "toxic"), "doc_id").collect()
    toxic = [row["predicted"] for row in rows if row["toxic"] == 1]
    clean = [row["predicted"] for row in rows if row["toxic"] == 0]
    assert len(toxic) >= 10 and sum(toxic) >= 0.7 * len(toxic)
    assert sum(clean) <= 0.05 * len(clean)


def test_quotations(spark, found):
    rows = [
        ("c", 0, "a", "First line.\nSecond line!"),
        ("c", 1, "b", "> first LINE\n>second line\nMy answer"),
        ("c", 2, "a", "On Monday B wrote:\n> > First line.\n> My answer\nThanks"),
        ("c", 3, "b", "> never said\nWhat?"),
        ("c", 4, "a", "> Thanks\nIndeed\n> Thanks"),
        ("d", 1, "a", ">> First line."), ("d", 2, None, None), (None, 3, "a", "> Thanks"),
        ("d", None, "a", "> Thanks\nx"), ("d", 9, "a", ""), ("d", 9, "a", ""),
        ("e", 0, "a", "long " * 9000 + "\n" + ">" * 70 + " deep"),
    ]
    frame = spark.createDataFrame(
        [(*row, "note") for row in rows],
        "conv_id string, turn bigint, role string, text string, note string")
    result = quotations.rebuild(frame)
    assert result.select("message.*").columns == frame.columns
    got = found(result.select("message.conv_id", "message.turn", "message.text", "n_quoted",
                              "n_passages", "n_linked", "parent_turn", "root_turn"))
    assert got == sorted([
        ("c", 0, "First line.\nSecond line!", 0, 0, 0, None, 0),
        ("c", 1, "My answer", 2, 1, 1, 0, 0),
        ("c", 2, "Thanks", 2, 2, 2, 1, 0),
        ("c", 3, "What?", 1, 1, 0, None, 3),
        ("c", 4, "Indeed", 2, 2, 2, 2, 0),
        ("d", 1, "", 1, 1, 0, None, 1), ("d", 2, None, 0, 0, 0, None, 2),
        (None, 3, "", 1, 1, 0, None, 3), ("d", None, "x", 1, 1, 0, None, None),
        ("d", 9, "", 0, 0, 0, None, 9), ("d", 9, "", 0, 0, 0, None, 9),
        ("e", 0, "long " * 9000, 1, 1, 0, None, 0),
    ], key=repr)
    assert quotations.rebuild(frame.where("false")).count() == 0


def test_pipeline_stages(spark, tmp_path, toxic_rows):
    rng = random.Random(7)
    exam = prose("cc", 40, rng)
    repeated = prose("aa", 12, rng)
    base = "\n".join(prose("bb", 2, rng) for _ in range(150))  # lines too short to be removed
    rows = [(n, text, "aa", "s", len(text)) for n, text, _ in toxic_rows]
    rows += [(800, repeated + "\n" + prose("aa", 60, rng), "aa", "s", 1),
             (801, repeated + "\n" + prose("bb", 60, rng), "aa", "s", 1),
             (802, base, "bb", "s", 1), (803, base + "\nka", "bb", "s", 1),
             (804, prose("aa", 30, rng) + " " + exam, "cc", "s", 1), (805, None, None, None, None)]
    docs = spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(n, 0, toxic) for n, _, toxic in toxic_rows],
                          "doc_id bigint, quality int, toxic int") \
        .write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, exam)], "item_id bigint, text string") \
        .write.parquet(f"{folder}/benchmark.parquet")
    seen = {}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, folder)
        docs.write.parquet(f"{folder}/stage-{number}")
        docs = spark.read.parquet(f"{folder}/stage-{number}")
        seen[name] = {row["doc_id"]: row for row in docs.collect()}
        if name != "byte_bpe":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    left = seen["toxicity"]
    assert all(n in left for n in range(800, 806))
    assert sum(n in left for n, _, toxic in toxic_rows if toxic) <= 5
    assert sum(n in left for n, _, toxic in toxic_rows if not toxic) >= 275
    assert seen["line_dedup"][800]["text"].startswith(repeated)
    assert not seen["line_dedup"][801]["text"].startswith(repeated)
    assert seen["line_dedup"][801]["n_chars"] == len(seen["line_dedup"][801]["text"])
    assert 802 in seen["near_duplicates"] and 803 not in seen["near_duplicates"]
    assert 804 in seen["near_duplicates"] and 804 not in seen["decontamination"]
    assert seen["byte_bpe"].keys() == seen["decontamination"].keys() >= {800, 801, 802, 805}
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line_dedup", "near_duplicates", "decontamination", "byte_bpe"]
    assert corpus_pipeline.run(spark, folder).count() == len(seen["byte_bpe"])
