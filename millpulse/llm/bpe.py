"""Byte-level byte-pair encoding and decoding.

A text is cut into pre-tokens by the vocabulary's pattern. A minimal perfect hash over the vocabulary answers at once
for a pre-token that is a token itself; any other is merged from its bytes, which form a linked list, taking the
pair of least rank from a heap until no neighbours merge. Each worker keeps a bounded cache of pre-tokens.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from millpulse.llm.ship import Memo, ship, unpack

CACHED_TOKENS = 300_000
KEYS_PER_BUCKET = 2
MAX_SEED = 1 << 20


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file (base64 token and rank per line) by rank; ranks must be 0, 1, 2 and so on."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    found = {int(rank): base64.b64decode(token) for token, rank in pairs}
    if sorted(found) != list(range(len(found))):
        raise ValueError("the ranks of a vocabulary must be consecutive from 0")
    return [found[i] for i in range(len(found))]


class PerfectHash:
    """A minimal perfect hash of byte strings: n keys, n slots, no empty slot and no collision.

    Keys fall into small buckets. Starting with the largest, each bucket gets the first seed that sends its keys to
    free slots; a bucket of one key gets the slot itself, stored as a negative number. `find` compares the key at the
    slot, so a string outside the set is never taken for a member.
    """

    def __init__(self, keys: list[bytes]):
        n = len(keys)
        self.n_buckets = max(1, n // KEYS_PER_BUCKET)
        self.seeds = [0] * self.n_buckets
        self.slots: list[int] = [-1] * n
        self.keys = keys
        buckets: list[list[int]] = [[] for _ in range(self.n_buckets)]
        hashes = [xxhash.xxh3_64_intdigest(key) for key in keys]
        for i, h in enumerate(hashes):
            buckets[h % self.n_buckets].append(i)
        next_free = 0
        for b in sorted(range(self.n_buckets), key=lambda b: (-len(buckets[b]), b)):
            members = buckets[b]
            if not members:
                break
            if len(members) == 1:
                while self.slots[next_free] >= 0:
                    next_free += 1
                self.slots[next_free] = members[0]
                self.seeds[b] = -next_free - 1
                continue
            for seed in range(MAX_SEED):
                at = {self._slot(hashes[i], seed, n) for i in members}
                if len(at) == len(members) and all(self.slots[s] < 0 for s in at):
                    break
            else:
                raise ValueError("no seed found; are there equal keys?")
            self.seeds[b] = seed
            for i in members:
                self.slots[self._slot(hashes[i], seed, n)] = i

    @staticmethod
    def _slot(h: int, seed: int, n: int) -> int:
        mixed = ((h >> 17) ^ (seed * 0x9E3779B97F4A7C15)) * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF
        return (mixed >> 29) % n

    def find(self, key: bytes) -> int:
        """The key's number, or -1."""
        if not self.keys:
            return -1
        h = xxhash.xxh3_64_intdigest(key)
        seed = self.seeds[h % self.n_buckets]
        i = self.slots[-seed - 1 if seed < 0 else self._slot(h, seed, len(self.keys))]
        return i if self.keys[i] == key else -1


class Codec:
    """Encodes and decodes with one vocabulary; `tokens` are its byte strings by rank."""

    def __init__(self, tokens: list[bytes], pattern: str, whole: PerfectHash | None = None):
        self.tokens, self.pattern = tokens, pattern
        self.whole = whole or PerfectHash(tokens)
        self.ranks = {token: i for i, token in enumerate(tokens)}
        self.split = regex.compile(pattern).findall
        self.memo = Memo(self._packed, CACHED_TOKENS)

    def __reduce__(self):
        return Codec, (self.tokens, self.pattern, self.whole)

    def merge(self, piece: bytes) -> list[int]:
        """The ranks of a byte string that is no token, by merging neighbours in order of rank, leftmost first."""
        ranks, n = self.ranks, len(piece)
        stop = list(range(1, n + 1))  # where the part that starts here ends; 0 once it is merged away
        before = list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            rank = ranks.get(piece[i:i + 2])
            if rank is not None:
                heap.append((rank, i, i + 2))
        heapq.heapify(heap)
        while heap:
            _, i, end = heapq.heappop(heap)
            middle = stop[i]
            if not middle or middle >= n or stop[middle] != end:
                continue  # one of the two has changed since
            stop[i], stop[middle] = end, 0
            if end < n:
                before[end] = i
                rank = ranks.get(piece[i:stop[end]])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, stop[end]))
            j = before[i]
            if j >= 0:
                rank = ranks.get(piece[j:end])
                if rank is not None:
                    heapq.heappush(heap, (rank, j, end))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i:stop[i]]])
            i = stop[i]
        return out

    def _packed(self, pretoken: str) -> bytes:
        piece = pretoken.encode("utf-8", "surrogatepass")
        found = self.whole.find(piece)
        return np.array([found] if found >= 0 else self.merge(piece), "<u4").tobytes()

    def encode(self, text: str | None) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers; none for NULL or an empty text."""
        self.memo.trim()
        return b"".join(map(self.memo.__getitem__, self.split(text or "")))

    def decode(self, packed: bytes) -> bytes:
        """The bytes that ids stand for; an id outside the vocabulary is an error."""
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(packed, "<u4").tolist()))


def encode(docs: DataFrame, vocabulary: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """The rows of `docs` with a binary column `ids`; a column of that name is replaced, NULL texts have no ids.

    `vocabulary` is the path of a rank file that the driver can read; it is sent to the tasks.
    """
    return _with_column(docs.drop(ids), vocabulary, pattern, text, ids, "encode")


def decode(rows: DataFrame, vocabulary: str, pattern: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """The rows with the bytes that `ids` stand for."""
    return _with_column(rows.drop(decoded), vocabulary, pattern, ids, decoded, "decode")


def _with_column(rows: DataFrame, vocabulary: str, pattern: str, source: str, target: str, method: str) -> DataFrame:
    codec = ship(rows.sparkSession, Codec(read_ranks(vocabulary), pattern))
    schema = T.StructType([*rows.schema.fields, T.StructField(target, T.BinaryType())])
    column = rows.columns.index(source)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        convert = getattr(unpack(codec), method)
        for batch in batches:
            made = pa.array([convert(x) for x in batch.column(column).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, made], names=[*batch.schema.names, target])

    return rows.mapInArrow(run, schema)


def digests(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each document: encoded, then decoded from its ids, in one pass."""
    codec = ship(docs.sparkSession, Codec(read_ranks(vocabulary), pattern))
    rows = docs.select("doc_id", "text")
    schema = T.StructType([
        rows.schema["doc_id"], T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = unpack(codec)
        for batch in batches:
            counts, coded, decoded = [], [], []
            for text in batch.column(1):
                ids = held.encode(text.as_py())
                counts.append(len(ids) // 4)
                coded.append(hashlib.sha256(ids).hexdigest())
                decoded.append(hashlib.sha256(held.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())],
                names=schema.names,
            )

    return rows.mapInArrow(run, schema)
