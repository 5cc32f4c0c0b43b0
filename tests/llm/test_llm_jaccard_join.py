"""N-gram Jaccard join against all pairs, and what its signatures promise."""

import random
import re

import numpy as np
import pytest
from corpus_cases import documents, found  # noqa: F401

from kilnstream.llm import bytetext, jaccard_join
from kilnstream.llm.jaccard_join import band_ends, band_of, plan, signatures

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if 0 < len(words) < size:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1))


def brute(rows, size, percent):
    sets = [(i, shingles(text, size)) for i, text in rows]
    group = {i: i for i, _ in sets if i is not None}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for n, (i, one) in enumerate(sets):
        for j, other in sets[:n]:
            if None not in (i, j) and one and other \
                    and 100 * len(one & other) >= percent * len(one | other):
                low, high = sorted((root(i), root(j)))
                group[high] = low
    return sorted(((i, len(own), None if i is None else root(i)) for i, own in sets), key=repr)


def changed(words, share):
    return [f"x{random.random()}" if random.random() < share else word for word in words]


def corpus():
    """Groups of copies of all degrees, some of a common passage and cut at either end."""
    random.seed(13)
    passage = [f"common{n}" for n in range(70)]
    rows = []
    for n in range(14):
        own = [f"w{random.randint(0, 4000)}" for _ in range(random.choice([5, 9, 16, 40, 150, 400]))]
        own = own + passage if n % 3 == 0 else own
        rows.append(own)
        rows += [changed(own, random.choice([0, 0.005, 0.01, 0.02, 0.04])) for _ in range(10)]
        rows += [own[:len(own) * cut // 100] for cut in (84, 86, 93)]
    random.shuffle(rows)
    texts = [(7 * n + 2, " ".join(words)) for n, words in enumerate(rows)]
    return texts + [(9000, None), (9001, ""), (9002, " \n\t"), (9003, "one"), (9004, "ONE"),
                    (9005, "one two"), (None, texts[0][1]), (9006, texts[0][1]),
                    (9006, texts[0][1]), (-5, texts[9][1].upper())]


@pytest.mark.parametrize("size, percent", [(4, 85), (5, 80), (1, 60)])
def test_equal_brute_force(documents, found, size, percent):
    rows = corpus()
    result = jaccard_join.similar_texts(documents(rows, 4), size, percent)
    expected = brute(rows, size, percent)
    assert len({row[2] for row in expected}) < len(expected) - 60
    assert found(result) == expected


def test_a_large_group_of_copies_that_are_not_all_linked(documents, found):
    """Changed copies of one text: linked with it or not, hardly ever with each other."""
    random.seed(5)
    own = [f"w{n}" for n in range(120)]
    rows = [(0, " ".join(own))]
    rows += [(n, " ".join(changed(own, random.choice([0.015, 0.03, 0.05])))) for n in range(1, 140)]
    assert found(jaccard_join.similar_texts(documents(rows), 4, 85)) == brute(rows, 4, 85)


def test_a_very_long_text_and_its_copy(documents):
    words = [f"v{n}" for n in range(120_000)]
    rows = [(5, " ".join(words)), (4, " ".join(words[9000:])), (3, " ".join(words[:80_000]))]
    result = {row[0]: row[1:] for row in jaccard_join.similar_texts(documents(rows), 4, 85).collect()}
    assert result == {5: (119_997, 4), 4: (110_997, 4), 3: (79_997, 3)}


def test_nothing(documents):
    empty = documents([(1, "")])
    assert jaccard_join.similar_texts(empty.where("false")).count() == 0
    assert tuple(jaccard_join.similar_texts(empty).first()) == (1, 0, 1)


@pytest.mark.parametrize("percent", [60, 80, 85, 95])
def test_similar_sets_share_more_than_the_spare_signatures(percent):
    rng = np.random.default_rng(percent)
    for _ in range(300):
        size = int(rng.integers(1, 400))
        one = np.unique(bytetext.mixed(rng.integers(0, 1 << 62, size).astype(np.uint64)))
        size = len(one)
        gone = int(rng.integers(0, size * (100 - percent) // 100 + 1))
        new = int(rng.integers(0, size * (100 - percent) // 100 + 1))
        other = np.sort(np.concatenate(
            [one[gone:], bytetext.mixed(rng.integers(0, 1 << 62, new).astype(np.uint64))]))
        common = size - gone
        if 100 * common < percent * (size + new):
            continue
        low, high = sorted((len(one), len(other)))
        assert high <= int(band_ends(percent, 1024)[min(band_of(low, percent) + 1, len(
            band_ends(percent, 1024)) - 1)])
        shared = np.intersect1d(signatures(one, percent), signatures(other, percent))
        band = band_of(low, percent)
        assert (shared % 2 == band % 2).sum() > plan(band, percent).spare
