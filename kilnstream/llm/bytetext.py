"""Texts of an Arrow batch as byte arrays: words, their hashes, windows of words.

A batch is cut into chunks of whole texts, so that memory follows the chunk and
the longest text, not the batch.
"""

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2_000_000
#: Texts, or sets and sketches of texts, that a Python worker holds and hands over at once.
STEP = 1000

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_WINDOW = np.uint64(0xD6E8FEB86659FD93)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """Mask over the 256 byte values; both ends of a range belong to it."""
    mask = np.zeros(256, bool)
    for low, high in ranges:
        mask[low:high + 1] = True
    return mask


#: Words between white space: every byte but \x20 and \x09-\x0D.
NOT_SPACE = ~byte_set((0x20, 0x20), (0x09, 0x0D))
#: Words of letters, digits and all bytes beyond ASCII, after lower-casing A-Z.
ALPHANUMERIC = byte_set((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
#: Lower-cases A-Z and leaves every other byte.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, at least ``size`` of them."""
    if len(_powers[0]) < size:
        for slot, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base)
            steps[0] = 1
            _powers[slot] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


def mixed(values: np.ndarray) -> np.ndarray:
    """64-bit values spread evenly over their range."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(29)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(32)
    return values


def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of ``STEP`` rows."""
    for batch in batches:
        for low in range(0, batch.num_rows, STEP):
            yield batch.slice(low, STEP)


#: Gives free pages at any place of the heap back; not every C library has it.
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Give memory that is no longer used back to the system.

    Workers live on from stage to stage, and what the arrays of one took is otherwise kept
    beside the arrays of the next.
    """
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def chunks(
    column: pa.Array, limit: int = CHUNK_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows ``first`` to ``last`` with their bytes and the n + 1 bounds of the texts.

    A null text has no bytes.  Memory of earlier chunks goes back when the last one is done.
    """
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:][:len(column) + 1]
    content = column.buffers()[2]
    data = np.frombuffer(content, np.uint8) if content is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(column))
        begin, end = offsets[first], offsets[last]
        yield first, last, data[begin:end], offsets[first:last + 1] - begin
        first = last
    give_back()


def words(
    data: np.ndarray, bounds: np.ndarray, word_bytes: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every word; a word never crosses two texts."""
    inside = word_bytes[data]
    breaks = np.zeros(len(data) + 1, bool)
    breaks[bounds] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | breaks[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | breaks[1:-1]
    begin = np.flatnonzero(starts)
    text = np.searchsorted(bounds, begin, "right") - 1
    return begin, np.flatnonzero(ends) + 1, text


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial hash; entry i covers the first i bytes."""
    running = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data))[0][:len(data)],
              out=running[1:])
    return running


def span_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each span's bytes, the same wherever the span stands."""
    running = prefix_hash(data)
    return mixed((running[end] - running[begin]) * powers(len(data) + 1)[1][begin])


def window_hashes(word_hashes: np.ndarray, text: np.ndarray, width: int):
    """Hashes of ``width`` consecutive words and the first word of each window."""
    count = len(word_hashes) - width + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(count, np.uint64)
    for offset in range(width):
        total *= _WINDOW
        total += word_hashes[offset:offset + count]
    first = np.flatnonzero(text[:count] == text[width - 1:])
    return mixed(total[first] + np.uint64(width)), first


def words_per_text(text: np.ndarray, n_texts: int) -> np.ndarray:
    return np.bincount(text, minlength=n_texts)
