"""Fill-in-middle: texts cut into prefix, middle and suffix at line ends and put in another order.

A text's units are its lines, each with its line feed.  Two numbers drawn from the
hash of seed and id say after how many units prefix and middle end.  To find these
places without counting every text anew, texts are cut into chunks where a rolling
hash of the last ``WINDOW`` bytes says so; texts that share a passage share the
chunks inside it.  A worker remembers chunks by their hash, compares the content on
a hit, and keeps a summary of each: its line feeds, its code points, whether it
holds a sentinel, and the bytes at its ends, where a sentinel may span two chunks.
The summaries' running counts give the number of units of a text and the chunk in
which a unit ends; only inside that chunk line feeds are looked for.

* null or empty text: no units, plain, empty output;
* a text that contains a sentinel is left plain, as are the texts beyond ``rate``;
* a text of one unit, and equal draws, give empty parts, which are kept;
* a null id is hashed as no digits; rows that repeat an id are cut alike;
* very long texts are handled whole, in time and memory that follow their length;
* an empty table gives an empty one; other columns are kept where documents are
  returned and not looked at; ``output`` replaces a column of that name.
"""

import hashlib
from collections import OrderedDict
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from kilnstream.llm import bytetext

SENTINELS = ("<P>", "<S>", "<M>")
SEED = 7
#: Percent of texts that are cut, and of these the share in the order suffix, prefix, middle.
RATE, SPM_SHARE = 100, 50
#: Bytes that the rolling hash covers; a chunk ends where its low bits are zero.
WINDOW, CUT_BITS = 16, 10
LEAST_CHUNK, MOST_CHUNK = 128, 8192
#: Bytes of chunks that a worker remembers.
REMEMBERED = 16_000_000

_FOLLOWING = bytes(range(0x80, 0xC0))


class Summary(NamedTuple):
    """What a chunk adds to the texts that hold it."""

    content: bytes
    feeds: int
    chars: int
    sentinel: bool


def summarise(content: bytes, sentinels: tuple[bytes, ...]) -> Summary:
    return Summary(content, content.count(b"\n"), len(content.translate(None, _FOLLOWING)),
                   any(mark in content for mark in sentinels))


class Chunks:
    """Summaries of the chunks seen last, found by hash and compared by content."""

    def __init__(self, sentinels: tuple[bytes, ...], most: int = REMEMBERED):
        self.sentinels, self.most, self.held = sentinels, most, 0
        self.known: OrderedDict[int, Summary] = OrderedDict()
        self.hits = self.misses = 0

    def of(self, name: int, content: bytes) -> Summary:
        found = self.known.get(name)
        if found is not None and found.content == content:
            self.hits += 1
            self.known.move_to_end(name)
            return found
        self.misses += 1
        made = summarise(content, self.sentinels)
        if found is None:
            self.held += len(content)
        else:
            self.held += len(content) - len(found.content)
        self.known[name] = made
        while self.held > self.most:
            self.held -= len(self.known.popitem(last=False)[1].content)
        return made


def boundaries(data: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """The places at which each text's chunks end; the last is the text's end.

    A place depends on the ``WINDOW`` bytes before it and on the chunk's start, so
    after a change the places of two texts soon agree again.
    """
    running = bytetext.prefix_hash(data)
    if len(data) > WINDOW:
        backwards = bytetext.powers(len(data) + 1)[1]
        rolled = (running[WINDOW:] - running[:-WINDOW]) * backwards[:len(running) - WINDOW]
        free = np.uint64((1 << CUT_BITS) - 1)
        places = np.flatnonzero(bytetext.mixed(rolled) & free == 0) + WINDOW
    else:
        places = np.zeros(0, np.int64)
    starts = np.searchsorted(places, bounds)
    out = []
    for text in range(len(bounds) - 1):
        begin, end = int(bounds[text]), int(bounds[text + 1])
        ends = []
        for place in places[starts[text]:starts[text + 1]].tolist():
            while place - begin > MOST_CHUNK:
                begin += MOST_CHUNK
                ends.append(begin)
            if place - begin >= LEAST_CHUNK:
                begin = place
                ends.append(begin)
        while end - begin > MOST_CHUNK:
            begin += MOST_CHUNK
            ends.append(begin)
        if end > begin:
            ends.append(end)
        out.append(np.array(ends, np.int64))
    return out


class Text:
    """One text as its chunks' summaries, with running counts of bytes, line feeds, code points."""

    def __init__(self, parts: list[Summary], sentinels: tuple[bytes, ...]):
        self.parts = parts
        counts = np.array([(len(p.content), p.feeds, p.chars) for p in parts],
                          np.int64).reshape(-1, 3)
        self.bytes, self.feeds, self.chars = (
            np.concatenate([[0], np.cumsum(counts[:, column])]) for column in range(3)
        )
        open_end = bool(parts) and not parts[-1].content.endswith(b"\n")
        self.units = int(self.feeds[-1]) + open_end
        self.marked = any(p.sentinel for p in parts) or self._marked_across(sentinels)

    def _marked_across(self, sentinels: tuple[bytes, ...]) -> bool:
        """Whether a sentinel spans chunks: their ends put together, sentinels long."""
        reach = max(map(len, sentinels)) - 1
        before = b""
        for part in self.parts:
            seam = before + part.content[:reach]
            if any(mark in seam for mark in sentinels):
                return True
            before = (before + part.content[-reach:] if len(part.content) < reach
                      else part.content[-reach:])[-reach:]
        return False

    def after(self, units: int) -> tuple[int, int]:
        """Bytes and code points of the first ``units`` units."""
        if units == 0:
            return 0, 0
        if units > self.feeds[-1]:
            return int(self.bytes[-1]), int(self.chars[-1])
        number = int(np.searchsorted(self.feeds, units)) - 1
        content, place = self.parts[number].content, -1
        for _ in range(units - int(self.feeds[number])):
            place = content.index(b"\n", place + 1)
        head = content[:place + 1]
        return (int(self.bytes[number]) + len(head),
                int(self.chars[number]) + len(head.translate(None, _FOLLOWING)))


def draws(seed: int, doc_id: object) -> list[int]:
    """Four numbers from the hash of seed and id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * n:8 * n + 8], 16) for n in range(4)]


def restore(output: bytes, form: str, sentinels: tuple[bytes, ...]) -> bytes:
    """The text from which an output of the form was made."""
    prefix, suffix, middle = sentinels
    if form == "plain":
        return output
    first, second = (prefix, suffix) if form == "psm" else (suffix, prefix)
    one, rest = output[len(first):].split(second, 1)
    other, last = rest.split(middle, 1)
    return one + last + other if form == "psm" else other + last + one


def rearranged(text: Text, content: bytes, doc_id: object, seed: int, rate: int,
               spm_share: int, sentinels: tuple[bytes, ...]):
    """Output, form, and the code points of prefix and middle (None in a plain text)."""
    one, other, chosen, order = draws(seed, doc_id)
    if not content or text.marked or chosen % 100 >= rate:
        return content, "plain", None, None
    cuts = sorted((one % (text.units + 1), other % (text.units + 1)))
    (head, head_chars), (stop, stop_chars) = map(text.after, cuts)
    prefix, middle, suffix = content[:head], content[head:stop], content[stop:]
    p, s, m = sentinels
    if order % 100 < spm_share:
        return s + suffix + p + prefix + m + middle, "spm", head_chars, stop_chars - head_chars
    return p + prefix + s + suffix + m + middle, "psm", head_chars, stop_chars - head_chars


def texts_of(column: pa.Array, chunks: Chunks):
    """Every text of the column in order, as chunks and as bytes."""
    for first, last, data, bounds in bytetext.chunks(column):
        ends = boundaries(data, bounds)
        begins = [np.concatenate([[bounds[n]], own[:-1]]) for n, own in enumerate(ends)]
        begin = np.concatenate([np.zeros(0, np.int64), *[b[:len(e)] for b, e in
                                                         zip(begins, ends, strict=True)]])
        names = bytetext.span_hashes(data, begin.astype(np.int64),
                                     np.concatenate([np.zeros(0, np.int64), *ends])).tolist()
        whole, at = data.tobytes(), 0
        for row in range(last - first):
            stops = ends[row].tolist()
            parts, low = [], int(bounds[row])
            for stop in stops:
                parts.append(chunks.of(names[at], whole[low:stop]))
                low, at = stop, at + 1
            yield Text(parts, chunks.sentinels), whole[bounds[row]:bounds[row + 1]]


def cut_texts(
    docs: DataFrame, rate: int = RATE, spm_share: int = SPM_SHARE, seed: int = SEED,
    sentinels: tuple[str, str, str] = SENTINELS, digests: bool = False,
) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars`` and ``output`` of every document.

    ``sentinels`` stand before prefix, suffix and middle.  With ``digests`` the output's
    and the restored text's digests take the place of ``output``.
    """
    marks = tuple(mark.encode() for mark in sentinels)

    def run(batches):
        chunks = Chunks(marks)
        for batch in batches:
            rows = []
            for doc_id, (text, content) in zip(batch["doc_id"].to_pylist(),
                                               texts_of(batch["text"], chunks), strict=True):
                output, form, head, middle = rearranged(
                    text, content, doc_id, seed, rate, spm_share, marks)
                made = (output.decode(),)
                if digests:
                    made = (hashlib.sha256(output).hexdigest(),
                            hashlib.sha256(restore(output, form, marks)).hexdigest())
                rows.append((text.units, form, head, middle, *made))
            columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *[pa.array(values, kind) for values, kind
                                    in zip(columns, kinds, strict=True)]], names=names)

    made = ["output_sha256", "restored_sha256"] if digests else ["output"]
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", *made]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), *[pa.string()] * len(made)]
    rows = docs.select("doc_id", "text")
    schema = rows.select("doc_id").schema.add("n", "long").add("form", "string") \
        .add("prefix_chars", "long").add("middle_chars", "long")
    for name in made:
        schema = schema.add(name, "string")
    return rows.mapInArrow(run, schema)


def transform(
    docs: DataFrame, rate: int = RATE, spm_share: int = SPM_SHARE, seed: int = SEED,
    sentinels: tuple[str, str, str] = SENTINELS,
) -> DataFrame:
    """The documents, all columns, with the rearranged text in place of ``text``.

    A null text stays null.
    """
    marks = tuple(mark.encode() for mark in sentinels)

    def run(batches):
        chunks = Chunks(marks)
        for batch in batches:
            place = batch.schema.get_field_index("text")
            outputs = [
                rearranged(text, content, doc_id, seed, rate, spm_share, marks)[0].decode()
                for doc_id, (text, content) in zip(batch["doc_id"].to_pylist(),
                                                   texts_of(batch["text"], chunks), strict=True)
            ]
            absent = batch["text"].is_null().to_numpy(zero_copy_only=False)
            yield batch.set_column(place, batch.schema.field(place),
                                   pa.array(outputs, batch["text"].type, mask=absent))

    return docs.mapInArrow(run, docs.schema)


def op11_fill_in_middle(spark, sf_dir) -> DataFrame:
    return cut_texts(spark.read.parquet(f"{sf_dir}/documents.parquet"), digests=True)


#: The rules on lists of lines; line feeds join them again.
ORACLE = """
WITH lined AS (
    SELECT doc_id, coalesce(text, '') AS body, string_split(coalesce(text, ''), chr(10)) AS lines,
           sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest
    FROM documents
), counted AS (
    SELECT *, CAST(len(lines) - (lines[-1] = '')::INT AS BIGINT) AS n,
           [CAST('0x' || digest[8 * g + 1:8 * g + 8] AS BIGINT) FOR g IN range(4)] AS h
    FROM lined
), placed AS (
    SELECT *, CASE WHEN body = '' OR contains(body, '<P>') OR contains(body, '<S>')
                        OR contains(body, '<M>') OR h[3] % 100 >= 100 THEN 'plain'
                   WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form,
           least(h[1] % (n + 1), h[2] % (n + 1)) AS low,
           greatest(h[1] % (n + 1), h[2] % (n + 1)) AS high
    FROM counted
), parts AS (
    SELECT doc_id, body, n, form,
           array_to_string(lines[1:low], chr(10))
               || CASE WHEN low > 0 AND low < len(lines) THEN chr(10) ELSE '' END AS prefix,
           array_to_string(lines[low + 1:high], chr(10))
               || CASE WHEN high > low AND high < len(lines) THEN chr(10) ELSE '' END AS middle,
           array_to_string(lines[high + 1:], chr(10)) AS suffix
    FROM placed
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN body
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END)
           AS output_sha256,
       sha256(body) AS restored_sha256
FROM parts
"""
