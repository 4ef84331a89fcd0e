"""Byte-level BPE: encoding by a two-tier lookup, and decoding.

Most pre-tokens of a text are tokens of the vocabulary. These are resolved at once by a minimal
perfect hash: each key has a slot of its own and there are no other slots, so a lookup is one
displacement, one slot and one comparison. What misses is merged byte pair by byte pair: the
bytes are a linked list, and a heap gives the pair of the lowest rank. Both happen once for each
distinct pre-token of a batch; ids and decoded bytes of whole texts are then gathered by arrays.

Ids are stored as little-endian unsigned 32-bit integers in a binary column. Defined results: a
null or empty text has no ids and decodes to an empty text; bytes that are not UTF-8 count as
U+FFFD; a vocabulary without all 256 bytes, or ids outside the vocabulary, raise an error.
Equal rows give equal rows.
"""

from __future__ import annotations

import base64
import heapq
from dataclasses import dataclass, field

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import DataFrame, functions as F

from stayline.llm.pretokens import Pretokens, pretokens_of
from stayline.llm.words import annotate, mixed, text_buffer

CACHED = 400_000  # distinct misses that a Python worker remembers
PIECE_BYTES = 2 << 20  # of text that is encoded at once: what is made of it takes some 40 times as much


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file; it is read on the driver, its path is a parameter of all operators."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


def _hash(keys: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))


_STEP = np.uint64(0x9E3779B97F4A7C15)


class PerfectHash:
    """A minimal perfect hash by displacement: ``n`` keys, ``n`` slots.

    Keys fall into buckets of about four. Bucket by bucket, the largest first, a displacement is
    sought that sends all its keys to free slots; buckets of one key name their slot outright.
    """

    def __init__(self, keys: list[bytes]) -> None:
        n = max(1, len(keys))
        self.n, self.n_buckets = n, max(1, n // 4)
        hashes = _hash(keys)
        bucket = (hashes % np.uint64(self.n_buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        groups = np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if len(keys) else []
        self.shift = np.zeros(self.n_buckets, np.int64)
        self.key_at = np.full(n, -1, np.int64)
        free = np.ones(n, bool)
        groups.sort(key=len, reverse=True)
        for group in (g for g in groups if len(g) > 1):
            d = 0
            while True:
                tries = np.arange(d, d + 64, dtype=np.uint64)[:, None]
                slots = self._slots(hashes[group][None, :], tries)
                good = free[slots].all(axis=1)
                if len(group) > 1:
                    good &= (np.diff(np.sort(slots, axis=1), axis=1) > 0).all(axis=1)
                if good.any():
                    k = int(good.argmax())
                    self._take(bucket[group[0]], d + k, slots[k], group, free)
                    break
                d += 64
        left = iter(np.flatnonzero(free))
        for group in (g for g in groups if len(g) == 1):
            slot = np.array([next(left)])
            self._take(bucket[group[0]], -1 - int(slot[0]), slot, group, free)

    def _slots(self, hashes: np.ndarray, shift: np.ndarray) -> np.ndarray:
        return (mixed(hashes + shift * _STEP) % np.uint64(self.n)).astype(np.int64)

    def _take(self, bucket, shift: int, slots: np.ndarray, group: np.ndarray, free) -> None:
        self.shift[bucket] = shift
        self.key_at[slots] = group
        free[slots] = False

    def find(self, keys: list[bytes]) -> np.ndarray:
        """For each key the number of the only stored key it can be."""
        hashes = _hash(keys)
        shift = self.shift[(hashes % np.uint64(self.n_buckets)).astype(np.int64)]
        moved = self._slots(hashes, np.maximum(shift, 0).astype(np.uint64))
        return self.key_at[np.where(shift < 0, -1 - shift, moved)]


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a pre-token: always the pair of lowest rank is merged, the leftmost of equals."""
    n = len(piece)
    after = list(range(1, n + 1))  # where the part that begins here ends
    before = list(range(-1, n - 1))
    before.append(n - 1)
    get = ranks.get
    heap = []
    for i in range(n - 1):
        rank = get(piece[i : i + 2])
        if rank is not None:
            heap.append((rank, i, i + 1, i + 2))
    heapq.heapify(heap)
    while heap:
        _, a, b, c = heapq.heappop(heap)
        if after[a] != b or b >= n or after[b] != c:
            continue  # one of both is merged already
        after[a] = c
        after[b] = -1
        if c < n:
            before[c] = a
            end = after[c]
            rank = get(piece[a:end])
            if rank is not None:
                heapq.heappush(heap, (rank, a, c, end))
        if a > 0:
            left = before[a]
            rank = get(piece[left:c])
            if rank is not None:
                heapq.heappush(heap, (rank, left, a, c))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : after[i]]])
        i = after[i]
    return out


@dataclass
class Vocabulary:
    """Tokens by rank, with the first tier of the lookup."""

    ranks: dict[bytes, int]
    pattern: str = public_tokenizers.PATTERN
    missed: dict[bytes, list[int]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.tokens = list(self.ranks)
        self.ids = np.fromiter(self.ranks.values(), np.int64, len(self.tokens))
        self.first_tier = PerfectHash(self.tokens)
        lack = [b for b in range(256) if bytes([b]) not in self.ranks]
        if lack:
            raise ValueError(f"the vocabulary lacks {len(lack)} of 256 bytes")

    def __getstate__(self) -> dict:
        return self.__dict__ | {"missed": {}}

    def encode_distinct(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pre-tokens one after the other, and where each begins."""
        at = self.first_tier.find(pieces) if pieces else np.zeros(0, np.int64)
        tokens, ids, missed = self.tokens, self.ids.tolist(), self.missed
        out: list[int] = []
        lengths = np.ones(len(pieces), np.int64)
        for i, (piece, k) in enumerate(zip(pieces, at.tolist(), strict=True)):
            if tokens[k] == piece:
                out.append(ids[k])
                continue
            merged = missed.get(piece)
            if merged is None:
                merged = merge_bytes(piece, self.ranks)
                if len(missed) >= CACHED:
                    missed.clear()
                missed[piece] = merged
            out.extend(merged)
            lengths[i] = len(merged)
        return np.array(out, np.int64), np.concatenate([[0], np.cumsum(lengths)])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text begins."""
        found = pretokens_of(texts)
        if len(found.unsure):
            found = _split_again(found, regex.compile(self.pattern))
        ids, begins = self.encode_distinct(found.distinct.to_pylist())
        return gather(ids, begins, found.codes, found.offsets)


def gather(
    ids: np.ndarray, begins: np.ndarray, codes: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Ids of texts from the ids of their pre-tokens: the flat ids, and where each text begins."""
    lists = pa.LargeListArray.from_arrays(pa.array(begins), pa.array(ids.astype(np.uint32)))
    flat = np.asarray(lists.take(pa.array(codes)).flatten())
    total = np.concatenate([[0], np.cumsum(np.diff(begins)[codes])])
    return flat, total[offsets]


def _split_again(found: Pretokens, pattern: regex.Pattern) -> Pretokens:
    """Documents with doubtful characters are split by the pattern itself."""
    extra = dict.fromkeys(found.unsure.tolist())
    distinct = found.distinct.to_pylist()
    place = {p: i for i, p in enumerate(distinct)}
    codes = []
    for d in range(len(found.texts)):
        if d in extra:
            split = [p.encode() for p in pattern.findall(found.texts[d].as_py())]
            codes.append(np.array([place.setdefault(p, len(place)) for p in split], np.int64))
        else:
            codes.append(found.codes[found.offsets[d] : found.offsets[d + 1]])
    offsets = np.concatenate([[0], np.cumsum([len(c) for c in codes])])
    empty = np.zeros(0, np.int64)
    return Pretokens(
        np.concatenate([empty, *codes]),
        offsets,
        pa.array(list(place), pa.large_binary()),
        empty,
        found.texts,
    )


def id_column(ids: np.ndarray, begins: np.ndarray) -> pa.Array:
    """A binary column of little-endian unsigned 32-bit ids."""
    data = pa.py_buffer(np.ascontiguousarray(ids, "<u4"))
    places = pa.py_buffer((begins * 4).astype(np.int32))
    return pa.BinaryArray.from_buffers(pa.binary(), len(begins) - 1, [None, places, data])


def encode(
    df: DataFrame, path: str, keep: list[str] | None = None, column: str = "text"
) -> DataFrame:
    """``df`` with ``ids`` (binary) of its texts, by the ranks in the file ``path``."""
    shared = df.sparkSession.sparkContext.broadcast(Vocabulary(read_ranks(path)))
    return annotate(
        df,
        "ids binary",
        lambda texts: [id_column(*shared.value.encode(texts))],
        keep,
        column,
        PIECE_BYTES,
    )


def decode(
    df: DataFrame, path: str, keep: list[str] | None = None, column: str = "ids"
) -> DataFrame:
    """``df`` with ``decoded`` (binary), the bytes of its ids."""
    ranks = read_ranks(path)
    table: list[bytes | None] = [None] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    shared = df.sparkSession.sparkContext.broadcast(table)
    tables: list[tuple[pa.Array, np.ndarray]] = []

    def expand(ids: pa.Array) -> list[pa.Array]:
        if not tables:
            whole = pa.array(shared.value, pa.large_binary())
            sizes = pc.binary_length(whole).fill_null(-1)
            tables.append((whole, np.asarray(sizes, np.int64)))
        tokens, sizes = tables[0]
        data, at = text_buffer(ids)
        flat = np.ascontiguousarray(data).view("<u4").astype(np.int64)
        if len(flat) and (flat.max() >= len(sizes) or sizes[flat].min() < 0):
            raise ValueError("an id is not in the vocabulary")
        taken = tokens.take(pa.array(flat))
        ends = np.concatenate([[0], np.cumsum(sizes[flat])])[at // 4]
        out = pa.BinaryArray.from_buffers(
            pa.binary(), len(ids), [None, pa.py_buffer(ends.astype(np.int32)), taken.buffers()[2]]
        )
        return [out]

    return annotate(df, "decoded binary", expand, keep, column, size=8 << 20)


def token_digests(df: DataFrame, path: str) -> DataFrame:
    """Count and digests of the ids of each document, and of what they decode to."""
    encoded = encode(df, path, ["doc_id"])
    decoded = decode(encoded, path, ["doc_id", "ids"])
    return decoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
