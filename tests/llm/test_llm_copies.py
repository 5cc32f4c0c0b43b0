"""Near duplicates, line dedup, repeated bytes, groups of links."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from corpus_cases import documents, found  # noqa: F401

from kilnstream.llm import edit_distance, line_dedup, near_duplicates, repeated_bytes
from kilnstream.llm.linking import Workbench, components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class Groups:
    def __init__(self, nodes):
        self.parent = {node: node for node in nodes}

    def find(self, node):
        while self.parent[node] != node:
            node = self.parent[node]
        return node

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.parent[b] = a


def test_components(spark, found):
    random.seed(1)
    edges = [(n, n + 1) for n in range(40)] + [(100, n) for n in range(200, 260)]
    edges += [(random.randint(300, 400), random.randint(300, 400)) for _ in range(60)]
    groups = Groups({node for edge in edges for node in edge})
    for a, b in edges:
        groups.join(a, b)
    named = {a for a, b in edges if a != b} | {b for a, b in edges if a != b}
    frame = spark.createDataFrame(edges, "a bigint, b bigint")
    assert found(components(Workbench(spark), frame)) == sorted(
        ((node, groups.find(node)) for node in named), key=repr)
    assert components(Workbench(spark), frame.where("false")).count() == 0


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if 0 < len(words) < size:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1))


def changed(words, share):
    return [random.choice("uvwxyz") * 9 if random.random() < share else word for word in words]


@pytest.fixture(scope="module")
def copies():
    """Originals with near copies of all degrees, a shared passage, and edge cases."""
    random.seed(8)
    rows = []
    passage = [f"common{n}" for n in range(60)]
    for n in range(12):
        own = [f"w{random.randint(0, 5000)}" for _ in range(random.choice([6, 30, 90, 250]))]
        rows.append(own + passage * (n % 2))
        rows += [changed(rows[-1], random.choice([0, 0.004, 0.01, 0.02, 0.05])) for _ in range(9)]
    random.shuffle(rows)
    rows = [(n * 3 + 1, " ".join(words)) for n, words in enumerate(rows)]
    return rows + [(900, None), (901, ""), (902, " \n"), (903, "one"), (904, "ONE"),
                   (905, "one two"), (None, rows[0][1]), (906, rows[0][1]), (906, rows[0][1])]


@pytest.mark.parametrize("size, percent, k", [(3, 85, 192), (5, 80, 64)])
def test_near_duplicates_equal_brute_force(copies, documents, found, size, percent, k):
    sets = [(i, shingles(text, size)) for i, text in copies if i is not None]
    groups = Groups({i for i, _ in sets})
    for n, (i, one) in enumerate(sets):
        for j, other in sets[:n]:
            if one and other and 100 * len(one & other) >= percent * len(one | other):
                groups.join(i, j)
    expected = []
    for i, text in copies:
        component = None if i is None else groups.find(i)
        expected.append((i, len(shingles(text, size)), component, i == component or i is None))
    docs = documents(copies)
    assert found(near_duplicates.near_duplicates(docs, size, percent, k)) == sorted(
        expected, key=repr)
    if size == 5:
        kept = near_duplicates.drop_near_duplicates(docs)
        assert kept.columns == docs.columns
        assert found(kept.select("doc_id")) == sorted(
            [(row[0],) for row in expected if row[3]], key=repr)


@pytest.mark.parametrize("size, percent", [(3, 85), (5, 80)])
def test_truncated_copies_at_the_threshold_are_found(documents, size, percent):
    """Each copy is its original without the end, just above the threshold."""
    random.seed(percent)
    rows = []
    for n in range(120):
        sets = 200 + 250 * n // 120
        own = [f"t{n}w{at}" for at in range(sets + size - 1)]
        cut = -(-sets * percent // 100) + size - 1
        rows += [(2 * n, " ".join(own)), (2 * n + 1, " ".join(own[:cut]))]
        one, other = (shingles(text, size) for _, text in rows[-2:])
        assert 100 * len(one & other) >= percent * len(one | other)
    result = near_duplicates.near_duplicates(documents(rows), size, percent, 192).collect()
    assert {row["doc_id"]: row["component_id"] for row in result} == {
        i: i - i % 2 for i, _ in rows}


def test_near_duplicates_of_nothing(documents):
    empty = documents([(1, "")])
    assert near_duplicates.near_duplicates(empty.where("false")).count() == 0
    assert tuple(near_duplicates.near_duplicates(empty).first()) == (1, 0, 1, True)


def normal(line):
    digits = line.translate(LOWER).translate(str.maketrans("123456789", "000000000"))
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", digits)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(row[j] + 1, now[-1] + 1, row[j - 1] + (x != y)))
        row = now
    return row[-1]


def test_edit_distance():
    random.seed(2)
    for _ in range(500):
        a, b = ("".join(random.choice("abc") for _ in range(random.randint(0, 14)))
                for _ in range(2))
        assert edit_distance.edit_distance(a, b) == distance(a, b)


def test_edit_distance_stops_only_above_the_limit():
    random.seed(3)
    for _ in range(300):
        a = [random.choice("abcdé") for _ in range(random.randint(0, 90))]
        b = list(a)
        for _ in range(random.randint(0, 30) if a else 0):
            b[random.randrange(len(b))] = random.choice(["", "x", "a", "bc"])
        a, b = "".join(a), "".join(b)
        exact = distance(a, b)
        for most in (0, 5, exact - 1, exact, exact + 1):
            assert (edit_distance.edit_distance(a, b, most) <= most) == (exact <= most)


@pytest.mark.parametrize("percent", [0, 70, 85, 100])
def test_distances_of_many_pairs_equal_brute_force(percent, monkeypatch):
    monkeypatch.setattr(edit_distance, "LONGEST", 150)
    monkeypatch.setattr(edit_distance, "MATCHES", 400)
    random.seed(6)
    pairs = [("", ""), ("", "ab"), ("ab", None), (None, None), ("a" * 64, "b" * 64)]
    for size in [0, 1, 15, 16, 17, 63, 64, 65, 128, 129, 200] * 12:
        one = [random.choice("abcé中\U0001F600 ") for _ in range(size)]
        other = list(one)
        for _ in range(int(size * random.choice([0, 0.02, 0.1, 0.15, 0.17, 0.4]))):
            other[random.randrange(len(other))] = random.choice(["", "x", "a", "bc"])
        pairs.append(("".join(one), "".join(other)))
    found = edit_distance.alike(*[pa.array(side, pa.string()) for side in zip(*pairs)], percent)
    assert found.tolist() == [
        None not in (a, b)
        and distance(a, b) <= (100 - percent) * max(len(a), len(b)) // 100 for a, b in pairs
    ]
    assert edit_distance.alike(pa.array([], pa.string()), pa.array([], pa.string()), 85).size == 0


def test_edit_tables_hold_only_the_rows_near_the_diagonal(monkeypatch):
    held = []
    counted = np.bitwise_count

    def noted(words):
        held.append(words.size)
        return counted(words)

    monkeypatch.setattr(np, "bitwise_count", noted)
    random.seed(23)
    one = "".join(random.choices("abcdefgh ", k=6400))
    other = "x" + "".join(random.choice("yz") if n % 40 == 0 else c for n, c in enumerate(one)) + "w"
    assert edit_distance.alike(pa.array([one]), pa.array([other]), 85).tolist() == [True]
    assert 0 < max(held) <= 20  # 100 words hold all rows, 15 those that 15 % of edits can reach


def test_long_texts_alone_have_the_same_distance_in_a_band():
    random.seed(31)
    one = "".join(random.choices("abcde", k=700))
    for n_edits in (0, 3, 40, 100, 160):
        other = list(one)
        for _ in range(n_edits):
            other[random.randrange(len(other))] = random.choice(["", "x", "ab"])
        other = "".join(other)
        exact = edit_distance.edit_distance(one, other)
        for most in (exact - 1, exact, exact + 5, 105):
            found = edit_distance.edit_distance(one, other, max(most, 0))
            assert found == exact if exact <= most else found > most


def test_simhash_is_the_majority_of_bits():
    random.seed(5)
    sizes = np.array([1, 3, 254, 255, 256, 700, 5, 70_000])
    hashes = np.array([random.getrandbits(64) for _ in range(sizes.sum())], np.uint64)
    found, at = line_dedup.simhash(hashes, sizes), 0
    for size, sim in zip(sizes, found, strict=True):
        bits = np.unpackbits(hashes[at:at + size].view(np.uint8).reshape(-1, 8), axis=1)
        assert np.packbits(2 * bits.sum(axis=0) > size).view(np.int64)[0] == sim
        at += size


def brute_lines(rows):
    """Places by normal form, and places that go, by edit similarity alone."""
    where = defaultdict(list)
    for doc_id, text in rows:
        for n, line in enumerate((text or "").split("\n")):
            words = normal(line)
            if len(words) >= line_dedup.LEAST_WORDS:
                where[" ".join(words)].append((doc_id, n))
    groups, forms = Groups(where), list(where)
    for n, one in enumerate(forms):
        for other in forms[:n]:
            most = (100 - line_dedup.SIMILAR_PERCENT) * max(len(one), len(other))
            if 100 * abs(len(one) - len(other)) <= most \
                    and 100 * edit_distance.edit_distance(one, other, most // 100) <= most:
                groups.join(one, other)
    members = defaultdict(list)
    for form, places in where.items():
        members[groups.find(form)] += places
    gone = {place for places in members.values() for place in set(places) - {min(places)}}
    return where, gone


def test_line_dedup_equals_brute_force(documents, found):
    """Nothing goes that edit similarity keeps, repeats go, and nearly all near copies do."""
    random.seed(4)
    lines = []
    for n in range(60):
        words = [random.choice(["an", "le"]) if random.random() < 0.3
                 else f"w{random.choice('öxyz')}rd{random.choice('abcdefgh') * 3}{n}"
                 for n in range(random.choice([2, 4, 14, 40]))]
        lines += [" ".join(words), "  ".join(words).upper() + "!!"]
        lines += [" ".join(changed(words, 0.04)) for _ in range(3)]
    rows = [(n, "\n".join(random.choice([*lines, ""]) for _ in range(random.randint(1, 9))))
            for n in range(80)]
    rows += [(90, None), (91, ""), (92, "\n"), (93, lines[0] + "\n"),
             (94, " ".join(f"t{n}" for n in range(9000)))]
    docs = documents(rows + [rows[0]])
    kept = line_dedup.dedup_lines(docs)
    assert kept.columns == docs.columns
    where, gone = brute_lines(rows)
    removed = {(row["doc_id"], n) for row in line_dedup.removals(
        docs, line_dedup.SIMILAR_PERCENT, line_dedup.MOST_BITS).collect() for n in row["removed"]}
    assert removed <= gone and len(removed) >= 0.9 * len(gone) > 100
    for places in where.values():
        assert set(places) - {min(places)} <= removed
    expected = [(doc_id, None if text is None else "\n".join(
        line for n, line in enumerate(text.split("\n")) if (doc_id, n) not in removed))
        for doc_id, text in rows + [rows[0]]]
    assert found(kept.select("doc_id", "text")) == sorted(expected, key=repr)
    assert line_dedup.dedup_lines(docs.where("false")).count() == 0


def linked_share(documents, pairs):
    """Share of the pairs (original, copy), alike by edit similarity alone, that are linked."""
    alike = [(one, other) for one, other in pairs
             if one != other and 100 * distance(one, other) <= 15 * max(len(one), len(other))]
    rows = [(2 * n + side, line) for n, pair in enumerate(alike) for side, line in enumerate(pair)]
    kept = {row["doc_id"]: row["text"]
            for row in line_dedup.dedup_lines(documents(rows)).select("doc_id", "text").collect()}
    assert all(kept[2 * n] == one for n, (one, _) in enumerate(alike))
    return len(alike), sum(kept[2 * n + 1] == "" for n in range(len(alike))) / len(alike)


def unlike_lines(n, sizes, short):
    """Lines of distinct letters-only words; those that are ``short`` have 2 to 4 letters."""
    def word():
        return "".join(random.choice("abcdefghijklmnop")
                       for _ in range(random.randint(*((2, 4) if short else (3, 10)))))
    return [" ".join(word() for _ in range(random.choice(sizes))) for _ in range(n)]


def one_letter(line):
    at = random.choice([n for n, char in enumerate(line) if char != " "])
    return line[:at] + "z" + line[at + 1:]


def test_lines_of_short_words_have_near_copies(documents):
    random.seed(11)
    lines = unlike_lines(80, [8, 12, 20], short=True) + unlike_lines(40, [5, 6, 7], short=False)
    count, share = linked_share(documents, [(line, one_letter(line)) for line in lines])
    assert count == 120 and share >= 0.9
    everywhere = line_dedup.dedup_lines(documents([(1, "a b c"), (2, "A  B, C"), (3, "a b")]))
    assert {row["doc_id"]: row["text"] for row in everywhere.collect()} == {
        1: "a b c", 2: "", 3: "a b"}


def test_line_dedup_finds_plain_near_copies(documents):
    """One letter, one word, letters all over: against edit similarity alone."""
    random.seed(12)

    def without_word(line):
        words = line.split(" ")
        del words[random.randrange(len(words))]
        return " ".join(words)

    def some_letters(line):
        for _ in range(max(1, len(line) // 25)):
            line = one_letter(line)
        return line

    lines = unlike_lines(150, [12, 20, 45, 80], short=False)
    for change, least in ((one_letter, 0.97), (without_word, 0.9), (some_letters, 0.9)):
        count, share = linked_share(documents, [(line, change(line)) for line in lines])
        assert count > 100 and share >= least, change.__name__


def test_normal_forms_come_from_the_wanted_lines_only(spark, documents, monkeypatch):
    texts = ["A b  C\n\nd1 e2 f3\nno no", "", None, "x Y-z\n", "\n\nq w e r", "d0 e0 f0\nlast one here"]
    rows = documents(list(enumerate(texts))).selectExpr("doc_id", "text", "xxhash64(text) AS text_hash")
    wanted = {0: [2], 3: [0], 4: [2], 5: [1]}
    places = []
    for doc_id, text, text_hash in rows.collect():
        for number in wanted.get(doc_id, []):
            data = np.frombuffer(text.split("\n")[number].encode(), np.uint8)
            [node] = line_dedup.Lines(data, np.array([0, len(data)])).hash.tolist()
            places.append((node, text_hash, number))
    places = spark.createDataFrame(places, "node bigint, text_hash bigint, line_no int")
    lines = line_dedup.Lines

    class Noted(lines):
        def __init__(self, data, bounds):
            super().__init__(data, bounds)
            assert len(self.owner) <= 4

    monkeypatch.setattr(line_dedup, "Lines", Noted)
    found = line_dedup.normal_forms(rows.coalesce(1), places).collect()
    assert {form for _, form in found} == {"d0 e0 f0", "x y z", "q w e r", "last one here"}
    assert {node for node, _ in found} == {row["node"] for row in places.collect()}


def test_groups_linked_as_wholes_are_those_of_all_links(spark):
    bench = line_dedup.Workbench(spark)
    one = [(2, 1), (3, 1), (5, 4), (9, 8)]
    more = [(3, 5), (6, 7), (9, 10), (10, 11)]

    def edges(rows):
        return spark.createDataFrame(rows, "a bigint, b bigint")

    groups = line_dedup.components(bench, edges(one))
    for links in (more, []):
        found = line_dedup.joined_groups(bench, groups, edges(links))
        exact = line_dedup.components(bench, edges(one + links))
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, exact.collect()))


def test_lines_meet_under_each_of_their_keys(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "GATHERED", 40)
    monkeypatch.setattr(line_dedup, "PACK", 3)
    random.seed(41)
    rows = []
    for n in range(60):
        keys = np.array([random.getrandbits(32) for _ in range(line_dedup.BANDS)], np.uint32)
        keys[n % line_dedup.BANDS] = 0xFFFFFFFF - n // 20
        rows.append((n, 5, 100, bytearray(keys.tobytes())))
    lines = spark.createDataFrame(rows, "node bigint, sim bigint, chars bigint, bands binary")
    found = line_dedup.neighbours(lines.repartition(3), 85, 3).collect()
    assert sorted((row["node"], row["held_with"]) for row in found) == [(n, 2) for n in range(60)]
    assert all(row["key"] == (row["node"] % line_dedup.BANDS) << 32 | 0xFFFFFFFF - row["node"] // 20
               for row in found)


def test_a_crowded_key_loses_no_neighbour(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "HELD", 3)
    rows = [(7, n, n % 2, 100) for n in range(40)]
    rows += [(8, 50, 0, 100), (9, 60, 1, 100), (9, 61, 255, 100)]
    rows += [(10, 70, 1, 100), (10, 71, 1, 118), (11, 80, 1, 100), (11, 81, 1, 117)]
    entries = spark.createDataFrame(
        rows, "key bigint, node bigint, sim bigint, chars bigint").coalesce(1)
    assert {row["node"] for row in line_dedup.neighbours(entries, 85, 3).collect()} >= {
        *range(40), 80, 81}
    monkeypatch.undo()
    assert {row["node"] for row in line_dedup.neighbours(entries, 85, 3).collect()} == {
        *range(40), 80, 81}


def test_copies_of_a_line_are_compared_with_one_of_them(documents, found, monkeypatch):
    random.seed(29)
    seen, similar = [], line_dedup.similar

    def noted(pairs, forms, percent):
        seen.append(pairs.count())
        return similar(pairs, forms, percent)

    monkeypatch.setattr(line_dedup, "similar", noted)
    original = ["".join(random.choices("abcdefghijklmnopqrstuvwxyz", k=8)) for _ in range(30)]
    rows = [(0, " ".join(original))]
    for n in range(1, 201):
        words = list(original)
        words[n % 30] = "".join(random.choices("abcdefghijklmnopqrstuvwxyz", k=8))
        rows.append((n, " ".join(words)))
    left = {row[0]: row[1] for row in found(line_dedup.dedup_lines(documents(rows)))}
    assert left == {0: rows[0][1], **{n: "" for n in range(1, 201)}}
    assert sum(seen) <= 400


def test_least_edits_never_exceed_the_distance():
    random.seed(30)
    words = ["".join(random.choices("abcá \u0161", k=random.randint(1, 12))) for _ in range(400)]
    one, other = edit_distance.Texts(words[:200]), edit_distance.Texts(words[200:])
    least = edit_distance._least_edits(one.codes, one.size, other.codes, other.size)
    exact = [edit_distance.edit_distance(a, b) for a, b in zip(words[:200], words[200:], strict=True)]
    assert (least <= exact).all() and (least == exact).sum() > 20 and least.max() > 5


def brute_bytes(rows, length, keep):
    places = defaultdict(list)
    for n, (_, text) in enumerate(rows):
        content = (text or "").encode()
        for at in range(len(content) - length + 1):
            places[content[at:at + length]].append((n, at))
    covered = [bytearray(len((text or "").encode())) for _, text in rows]
    for found in places.values():
        if len(found) > 1:
            for n, at in found[1:] if keep == "first" else found:
                covered[n][at:at + length] = b"\1" * length
    out = []
    for (doc_id, text), flags in zip(rows, covered, strict=True):
        content = (text or "").encode()
        left = bytes(byte for byte, flag in zip(content, flags, strict=True) if not flag)
        stretches = sum(1 for n, flag in enumerate(flags) if flag and (not n or not flags[n - 1]))
        out.append((doc_id, len(content), sum(flags), stretches,
                    hashlib.sha256(left).hexdigest()))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def overlapping():
    random.seed(5)
    base = ["".join(random.choice("abcdé ") for _ in range(200)) for _ in range(4)]
    rows = []
    for n in range(50):
        text = "".join(random.choice("abc") for _ in range(random.randint(0, 60)))
        for _ in range(random.randint(0, 3)):
            at = random.randint(0, 120)
            text += random.choice(base)[at:at + random.randint(10, 80)]
            text += "".join(random.choice("xyz") for _ in range(random.randint(0, 5)))
        rows.append((n, text))
    return rows + [(100, "a" * 300), (101, None), (102, ""), (103, "ab" * 2000),
                   (104, rows[3][1]), (105, rows[3][1]), (106, rows[7][1] + "q")]


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("gram, most_classes", [(8, 10_000), (8, 2), (30, 10_000)])
def test_repeated_bytes_equal_brute_force(
    documents, found, overlapping, keep, gram, most_classes
):
    result = repeated_bytes.repeats(documents(overlapping), 30, gram, keep, most_classes)
    assert found(result) == brute_bytes(overlapping, 30, keep)


def test_small_steps_give_the_same(documents, found, overlapping, monkeypatch):
    monkeypatch.setattr(repeated_bytes, "STEP", 3)
    result = repeated_bytes.repeats(documents(overlapping, 1), 30, 8, "first", 6)
    assert found(result) == brute_bytes(overlapping, 30, "first")


def test_repeated_rows_and_columns_of_repeats(documents, found):
    rows = [(1, "é" * 250), (1, "é" * 250), (None, "z" * 10), (2, "tail " + "é" * 250)]
    docs = documents(rows)
    result = repeated_bytes.repeats(docs)
    assert found(result) == brute_bytes(rows, 400, "none")
    left = repeated_bytes.remove_repeats(docs, keep="none")
    assert left.columns == docs.columns
    assert found(left.select("doc_id", "text"))[2][1] in ("tail ", "z" * 10)
    assert repeated_bytes.repeats(docs.where("false")).count() == 0


@pytest.mark.parametrize("length, n_spans", [(399, 0), (400, 1)])
def test_passages_of_many_words_are_removed_from_400_bytes_on(
    documents, found, length, n_spans
):
    passage = " ".join(f"w{n:04}" for n in range(70))[:length]
    assert len(passage.split()) > 50
    rows = [(1, "1" + passage + "2"), (2, "3" + passage + "4"), (3, passage[:200] + "5" * 399)]
    result = repeated_bytes.repeats(documents(rows))
    assert found(result) == brute_bytes(rows, 400, "none")
    assert [r["n_spans"] for r in result.orderBy("doc_id").collect()] == [n_spans, n_spans, 0]
