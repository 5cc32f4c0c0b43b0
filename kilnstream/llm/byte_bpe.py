"""Byte-level BPE: encoding by a hierarchical-bitmap queue of merge ranks, and decoding.

Every pre-token is a linked list of parts.  A bucket per rank holds the list
positions of the pairs that merge at it, and a bitmap over the ranks, with a
second one over its words, names the lowest bucket that is not empty with two
find-first-set steps.  An entry whose pair has changed since is stale and is
skipped.  A pre-token of n bytes costs O(n log n) at worst, however long it is.

A null text is encoded as the empty text: no tokens, no bytes.  Texts are
independent of each other, so repeated rows repeat their results, an empty
table gives an empty one, and other columns are not looked at.  The ranks come
from a file of the installed vocabulary package; ``path`` is a parameter.
"""

import base64
import hashlib
import re
from functools import lru_cache
from heapq import heappop, heappush
from itertools import chain
from operator import itemgetter

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from kilnstream.llm import bytetext

RANKS = "byte_bpe_50k.tiktoken"
#: Bits of one bitmap word, as a power of two.
SHIFT = 8
MASK = (1 << SHIFT) - 1
#: Pre-tokens, and words after a space, that a Python worker remembers; the longest of them.
REMEMBERED = 700_000
REMEMBERED_LENGTH = 64
#: White space of any kind next to white space.
WHITE_RUN = re.compile(r"\s\s")


def picked(items: list, places: list[int]) -> tuple | list:
    """The items at the places; one call for all is much faster than one for each."""
    return itemgetter(*places)(items) if len(places) > 1 else [items[at] for at in places]


class ByteBPE:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        size = max(ranks.values()) + 1
        self.tokens = [b""] * size
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.digits = [str(rank) for rank in range(size)]
        self.bits = [0] * ((size >> SHIFT) + 1)
        self.by_spaces = pattern == public_tokenizers.PATTERN
        self.known: dict[str, tuple[int, ...]] = {}
        self.after_space: dict[str, tuple[int, ...]] = {}

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Token ids of one pre-token.

        ``bits`` has a bit per rank with a bucket, in words of 2 ** ``SHIFT`` bits;
        ``summary`` has a bit per word that is not 0.  Both are 0 again at the end.
        The queue is written out here because short pre-tokens are many.
        """
        rank_of, bits, summary = self.ranks.get, self.bits, 0
        whole = rank_of(piece)
        if whole is not None:
            return (whole,)
        n = len(piece)
        ends = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        pair = [rank_of(piece[at:at + 2], -1) for at in range(n)]
        pair[-1] = -1
        buckets: dict[int, list[int]] = {}
        for at, rank in enumerate(pair):
            if rank in buckets:
                buckets[rank].append(at)
            elif rank >= 0:
                buckets[rank] = [at]
                bits[rank >> SHIFT] |= 1 << (rank & MASK)
                summary |= 1 << (rank >> SHIFT)
        while summary:
            word = (summary & -summary).bit_length() - 1
            ranks_here = bits[word]
            rank = (word << SHIFT) + (ranks_here & -ranks_here).bit_length() - 1
            bucket = buckets[rank]
            if len(bucket) > 1:
                at = heappop(bucket)
            else:
                at = bucket[0]
                del buckets[rank]
                bits[word] = ranks_here = ranks_here & (ranks_here - 1)
                if not ranks_here:
                    summary &= summary - 1
            if pair[at] != rank:
                continue
            gone = ends[at]
            end = ends[at] = ends[gone]
            pair[gone] = pair[at] = -1
            left = before[at]
            if end < n:
                before[end] = at
                rank = rank_of(piece[at:ends[end]], -1)
                if rank in buckets:
                    pair[at] = rank
                    heappush(buckets[rank], at)
                elif rank >= 0:
                    pair[at] = rank
                    buckets[rank] = [at]
                    bits[rank >> SHIFT] |= 1 << (rank & MASK)
                    summary |= 1 << (rank >> SHIFT)
            if left >= 0:
                rank = pair[left] = rank_of(piece[left:end], -1)
                if rank in buckets:
                    heappush(buckets[rank], left)
                elif rank >= 0:
                    buckets[rank] = [left]
                    bits[rank >> SHIFT] |= 1 << (rank & MASK)
                    summary |= 1 << (rank >> SHIFT)
        ids, at = [], 0
        while at < n:
            ids.append(rank_of(piece[at:ends[at]]))
            at = ends[at]
        return tuple(ids)

    def pieces(self, text: str) -> list[tuple[int, ...]]:
        """Token ids of every match of the pattern."""
        known, found = self.known, []
        for piece in self.pattern.findall(text):
            ids = known.get(piece)
            if ids is None and piece[:1] == " ":
                ids = self.after_space.get(piece[1:])
            if ids is None:
                ids = self.merge(piece.encode())
                if len(piece) <= REMEMBERED_LENGTH and len(known) < REMEMBERED:
                    known[piece] = ids
            found.append(ids)
        return found

    def spaced(self, word: str) -> tuple[int, ...]:
        """Token ids of a space and the word after it.

        What is remembered here is not remembered as a pre-token too: one that begins with
        a space is a pre-token on its own as well, so its ids are those of the word after it.
        """
        whole = " " + word
        if whole in self.known:
            ids = self.known[whole]
        elif len(found := self.pattern.findall(whole)) == 1:
            ids = self.merge(found[0].encode())
        else:
            ids = tuple(chain.from_iterable(self.pieces(whole)))
        if len(word) <= REMEMBERED_LENGTH and len(self.after_space) < REMEMBERED:
            self.after_space[word] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        """Token ids of a text.

        The usual pattern never matches across a single line feed, nor across
        the place before a single space, so texts without runs of white space
        are looked up by space-separated words.
        """
        if not self.by_spaces or WHITE_RUN.search(text):
            return list(chain.from_iterable(self.pieces(text)))
        parts: list[tuple[int, ...]] = []
        for number, line in enumerate(text.split("\n")):
            if number:
                parts.extend(self.pieces("\n"))
            words = line.split(" ")
            parts.extend(self.pieces(words[0]))
            ids = list(map(self.after_space.get, words[1:]))
            if not all(ids):
                ids = [self.spaced(word) if found is None else found
                       for word, found in zip(words[1:], ids, strict=True)]
            parts.extend(ids)
        return list(chain.from_iterable(parts))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(picked(self.tokens, ids))


@lru_cache(maxsize=2)
def tokenizer(path: str, pattern: str = public_tokenizers.PATTERN) -> ByteBPE:
    """The tokenizer of a rank file, built once per worker."""
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        return ByteBPE({base64.b64decode(token): int(rank) for token, rank in pairs}, pattern)


def encode_texts(
    docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN
) -> DataFrame:
    """Token ids of every text, as ``doc_id, ids``."""
    path = path or public_tokenizers.path(RANKS)

    def run(batches):
        bpe = tokenizer(path, pattern)
        for batch in batches:
            ids = [bpe.encode(text.as_py() or "") for text in batch["text"]]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"]
            )

    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(run, f"doc_id {_type(rows)}, ids array<int>")


def decode_ids(rows: DataFrame, path: str | None = None) -> DataFrame:
    """Bytes of every list of token ids, as ``doc_id, content``; null ids have no bytes."""
    path = path or public_tokenizers.path(RANKS)

    def run(batches):
        bpe = tokenizer(path)
        for batch in batches:
            content = [bpe.decode(ids.as_py() or []) for ids in batch["ids"]]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(content, pa.binary())], names=["doc_id", "content"]
            )

    kept = rows.select("doc_id", "ids")
    return kept.mapInArrow(run, f"doc_id {_type(kept)}, content binary")


def round_trip(
    docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN
) -> DataFrame:
    """Encode and decode every text: token count and the digests of ids and decoded bytes."""
    path = path or public_tokenizers.path(RANKS)

    def run(batches):
        bytetext.give_back()
        bpe = tokenizer(path, pattern)
        for batch in batches:
            counts, of_ids, of_bytes = [], [], []
            for text in batch["text"]:
                ids = bpe.encode(text.as_py() or "")
                counts.append(len(ids))
                joined = " ".join(picked(bpe.digits, ids))
                of_ids.append(hashlib.sha256(joined.encode()).hexdigest())
                of_bytes.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()),
                 pa.array(of_bytes, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(
        run, f"doc_id {_type(rows)}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )


def _type(rows: DataFrame) -> str:
    return rows.schema["doc_id"].dataType.simpleString()


def op5_byte_bpe(spark, sf_dir) -> DataFrame:
    return round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet"))
