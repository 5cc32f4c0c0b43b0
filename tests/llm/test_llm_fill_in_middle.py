"""Fill-in-middle against the rules on whole texts."""

import hashlib
import random
import re

import numpy as np
import pytest
from corpus_cases import documents, found  # noqa: F401

from kilnstream.llm import bytetext, fill_in_middle
from kilnstream.llm.fill_in_middle import Chunks, Text, boundaries

MARKS = (b"<P>", b"<S>", b"<M>")


def brute(doc_id, text, rate=100, spm=50, seed=7):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]
    n = len(units)
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= rate:
        return (doc_id, n, "plain", None, None, text)
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = ("".join(part) for part in (units[:low], units[low:high], units[high:]))
    form = "spm" if h[3] % 100 < spm else "psm"
    output = (f"<S>{suffix}<P>{prefix}<M>{middle}" if form == "spm"
              else f"<P>{prefix}<S>{suffix}<M>{middle}")
    return (doc_id, n, form, len(prefix), len(middle), output)


def cases():
    random.seed(11)
    pieces = ["line", "é日本", "𝄞", "\n", "\n\n", "<P", "S>", "<S", ">", " ", "word " * 40, "\r"]
    shared = "".join(random.choice("abcdefgh \n") for _ in range(6000))
    rows = [(n, "".join(random.choice(pieces) for _ in range(random.randint(0, 60))))
            for n in range(200)]
    rows += [(200 + n, f"own {n}\n{shared[n * 11:]}tail {n}") for n in range(40)]
    rows += [(300, None), (301, ""), (302, "\n"), (303, "\n\n\n"), (304, "no end"),
             (305, "x<P>y\nz"), (306, "a" * 40_000 + "\n" + "b" * 9000 + "<M>"),
             (307, "a" * 40_000 + "\n" + "b" * 9000), (None, "null\nid\n"),
             (308, "one\ntwo\n"), (308, "one\ntwo\n"), (309, "z" * 300_000 + "\n" * 5000 + "é" * 50_000)]
    # sentinels across every place at which a run of one byte is cut
    rows += [(400 + n, "q" * (fill_in_middle.MOST_CHUNK - 4 + n) + "<S>" + "q\n" * 20)
             for n in range(6)]
    return rows


@pytest.mark.parametrize("rate, spm", [(100, 50), (40, 0), (0, 50)])
def test_cuts_equal_brute_force(documents, found, rate, spm):
    rows = cases()
    docs = documents(rows)
    expected = [brute(i, text, rate, spm) for i, text in rows]
    result = fill_in_middle.cut_texts(docs, rate, spm)
    assert found(result) == sorted(expected, key=repr)
    if rate == 100:
        assert {row[2] for row in expected} == {"plain", "psm", "spm"}
        digests = fill_in_middle.cut_texts(docs, digests=True)
        assert found(digests.select("doc_id", "output_sha256", "restored_sha256")) == sorted(
            ((row[0], hashlib.sha256(row[5].encode()).hexdigest(),
              hashlib.sha256((text or "").encode()).hexdigest())
             for row, (_, text) in zip(expected, rows, strict=True)), key=repr)
        changed = fill_in_middle.transform(docs)
        assert changed.columns == docs.columns
        assert found(changed.select("doc_id", "text", "score")) == sorted(
            ((row[0], None if text is None else row[5], "own")
             for row, (_, text) in zip(expected, rows, strict=True)), key=repr)


def test_nothing_and_clashing_names(spark, documents):
    docs = documents([(1, "a\nb")])
    assert fill_in_middle.cut_texts(docs.where("false")).count() == 0
    assert fill_in_middle.transform(docs.where("false")).columns == docs.columns
    odd = spark.createDataFrame([(1, "a\nb", 3, "f")], "doc_id bigint, text string, n int, form string")
    assert fill_in_middle.cut_texts(odd).columns == [
        "doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert tuple(fill_in_middle.transform(odd).first())[2:] == (3, "f")


def test_shared_passages_are_summarised_once():
    random.seed(2)
    passage = bytes(random.choice(b"abcdefghij \n") for _ in range(60_000))
    texts = [bytes(random.choice(b"klmn") for _ in range(n * 37)) + passage for n in range(1, 9)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    bounds = np.cumsum([0] + [len(text) for text in texts])
    ends = boundaries(data, bounds)
    assert [int(own[-1]) for own in ends] == bounds[1:].tolist()
    sizes = np.concatenate([np.diff(own, prepend=low) for own, low in zip(ends, bounds, strict=False)])
    assert sizes.max() <= fill_in_middle.MOST_CHUNK
    chunks = Chunks(MARKS)
    for own, low in zip(ends, bounds.tolist(), strict=False):
        for end in own.tolist():
            content = data[low:end].tobytes()
            chunks.of(hash(content), content)
            low = end
    assert chunks.misses < len(ends[0]) + 8 * 6
    assert chunks.hits > 6 * len(ends[0]) // 2


def test_equal_names_of_unequal_chunks_do_no_harm():
    chunks = Chunks(MARKS, most=30)
    assert chunks.of(1, b"a\nb").feeds == 1
    assert chunks.of(1, b"<P>\n\n") == (b"<P>\n\n", 2, 5, True)
    assert chunks.of(1, "é".encode()).chars == 1
    for name in range(2, 20):
        chunks.of(name, b"0123456789")
    assert chunks.held == sum(len(s.content) for s in chunks.known.values()) <= 30


def test_a_sentinel_across_tiny_chunks_is_seen():
    parts = [fill_in_middle.summarise(bytes([byte]), MARKS) for byte in b"ab<S>c\n"]
    text = Text(parts, MARKS)
    assert text.marked and text.units == 1 and text.after(1) == (7, 7)
    assert not Text([fill_in_middle.summarise(b"<S", MARKS)] * 2, MARKS).marked


def test_empty_batch():
    import pyarrow as pa
    assert list(fill_in_middle.texts_of(pa.array([], pa.string()), Chunks(MARKS))) == []
    assert list(bytetext.chunks(pa.array([], pa.string()))) == []
