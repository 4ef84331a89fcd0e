"""Token ids in a compact file format, and back.

Ids are replaced by their rank of frequency over all documents, so most take one byte. Ranks are
written in whole bytes, one to four each: four lengths of two bits make a control byte. Control
bytes and data bytes are kept apart, which lets a table of 256 rows turn control bytes into
lengths, and lengths into places, for a whole block at once.

A token file is a folder: ``ranks`` (the id of each rank) and ``blocks``. A block is a row with
consecutive documents in ascending doc_id order, their ids (as ``ids``, each document ended by
``end_id``) as control and data bytes, and how many ids of its part lie before it. Parts follow
each other in doc_id order. Parquet is the container, so files are committed whole, can lie in
any store Spark writes, and a lost task is written again.

Defined results: a null or empty text has the end id only; a null doc_id comes first; documents
with the same doc_id follow each other in the order of a hash of their ids; other columns are
left out. An empty table gives a file without blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from tokenizers import Tokenizer

from stayline.llm.bytepairs import gather
from stayline.llm.pretokens import pretokens_of
from stayline.llm.words import annotate, shards_for, ship_package
from stayline.session import durable, scratch_path

END_ID = 2
BLOCK_IDS = 1 << 18
PART_BYTES = 128 << 20
GROUP_BYTES = 8 << 20  # of a row group: readers hold one whole, as its rows are few and long
MAX_SENT_PARTS = 500_000  # rows of the table of parts that are broadcast
CACHED = 400_000  # distinct pre-tokens that a Python worker remembers


class LibraryTokenizer:
    """A tokenizer file of the ``tokenizers`` library with a byte-level pre-tokenizer.

    The library encodes each distinct pre-token once. Pre-tokens of a space and letters are
    handed over in one string, which it splits in the same places again. A text with characters
    that Unicode versions disagree on goes to the library as it is.
    """

    def __init__(self, config: str) -> None:
        self.config = config
        self._tokenizer: Tokenizer | None = None
        self._forget()

    def __getstate__(self) -> str:
        return self.config

    def __setstate__(self, config: str) -> None:
        self.__init__(config)

    def _forget(self) -> None:
        self.slot: dict[bytes, int] = {}  # of each known pre-token
        self.flat = np.zeros(0, np.uint32)  # ids, slot after slot
        self.begins = np.zeros(1, np.int64)

    @property
    def tokenizer(self) -> Tokenizer:
        if self._tokenizer is None:
            made = Tokenizer.from_str(self.config)
            made.encode_special_tokens = True
            made.no_padding()
            made.no_truncation()
            names = made.get_vocab(with_added_tokens=True)
            self.size = np.zeros(max(names.values()) + 1, np.int64)
            for name, k in names.items():  # a character for each byte
                self.size[k] = len(name)
            self._tokenizer = made
        return self._tokenizer

    def _whole(self, texts: list[str]) -> list[list[int]]:
        encode = self.tokenizer.encode
        return [encode(t, add_special_tokens=False).ids for t in texts]

    def _learn(self, pieces: list[bytes]) -> None:
        joined, other = [], []
        for piece in pieces:
            (joined if piece[0] == 0x20 and _letters(piece[1:]) else other).append(piece)
        groups = [joined[k : k + 500] for k in range(0, len(joined), 500)]
        made = self._whole([b"".join(g).decode() for g in groups])
        learned, flat, counts = [], [], []
        for group, ids in zip(groups, made, strict=True):
            own = np.array(ids, np.uint32)
            until = np.cumsum(self.size[own])
            ends = np.cumsum([len(p) for p in group])
            after = np.searchsorted(until, ends) + 1
            if until[-1] == ends[-1] and (until[after - 1] == ends).all():
                learned += group
                flat.append(own)
                counts.append(np.diff(after, prepend=0))
            else:
                other += group
        for piece, ids in zip(other, self._whole([p.decode() for p in other]), strict=True):
            learned.append(piece)
            flat.append(np.array(ids, np.uint32))
            counts.append(np.array([len(ids)]))
        self.slot.update(zip(learned, range(len(self.slot), len(self.slot) + len(learned))))
        self.flat = np.concatenate([self.flat, *flat])
        ends = np.cumsum(np.concatenate([self.begins[-1:], *counts]))
        self.begins = np.concatenate([self.begins[:-1], ends])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text begins."""
        found = pretokens_of(texts)
        pieces = found.distinct.to_pylist()
        if len(self.slot) > CACHED:
            self._forget()
        slots = np.fromiter(map(self.slot.get, pieces, repeat(-1)), np.int64, len(pieces))
        new = np.flatnonzero(slots < 0)
        unknown = [pieces[i] for i in new.tolist()]
        self._learn(unknown)
        slots[new] = np.fromiter(map(self.slot.__getitem__, unknown), np.int64, len(new))
        codes = slots[found.codes] if len(pieces) else slots
        flat, at = gather(self.flat, self.begins, codes, found.offsets)
        if not len(found.unsure):
            return flat, at
        parts = np.split(flat, at[1:-1])
        again = found.unsure.tolist()
        for d, own in zip(again, self._whole([found.texts[d].as_py() for d in again]), strict=True):
            parts[d] = np.array(own, flat.dtype)
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])


def _letters(piece: bytes) -> bool:
    return piece.isalpha() or (not piece.isascii() and piece.decode().isalpha())


def _lengths() -> np.ndarray:
    codes = np.arange(256)
    return np.stack([(codes >> (2 * k) & 3) + 1 for k in range(4)], axis=1)


LENGTHS = _lengths()  # bytes of the four numbers of each control byte


def pack(numbers: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit numbers."""
    x = numbers.astype(np.uint32)
    size = 1 + (x >= 1 << 8).astype(np.int64) + (x >= 1 << 16) + (x >= 1 << 24)
    codes = np.zeros(-(-len(x) // 4) * 4, np.int64)
    codes[: len(x)] = size - 1
    control = (codes.reshape(-1, 4) << np.array([0, 2, 4, 6])).sum(axis=1).astype(np.uint8)
    place = np.cumsum(size) - size
    data = np.zeros(int(size.sum()), np.uint8)
    for k in range(4):
        here = size > k
        data[place[here] + k] = (x[here] >> np.uint32(8 * k)) & np.uint32(0xFF)
    return control.tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    size = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    place = np.cumsum(size) - size
    raw = np.frombuffer(data, np.uint8)
    out = raw[place].astype(np.uint32)
    for k in range(1, 4):
        here = np.flatnonzero(size > k)
        if len(here):
            out[here] |= raw[place[here] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def encode(df: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``packed``, the ids compressed as they come."""
    with open(path, encoding="utf-8") as file:
        shared = df.sparkSession.sparkContext.broadcast(LibraryTokenizer(file.read()))

    def run(texts: pa.Array) -> list[pa.Array]:
        ids, at = shared.value.encode(texts)
        ids = np.insert(ids, at[1:], end_id)  # after each text
        at = at + np.arange(len(at))
        squeeze = zstandard.ZstdCompressor(level=1).compress
        small = len(ids) == 0 or int(ids.max()) < 1 << 16
        data = memoryview(ids.astype("<u2" if small else "<u4")).cast("B")
        places = ((2 if small else 4) * at).tolist()
        packed = [squeeze(data[a:b]) for a, b in zip(places[:-1], places[1:], strict=True)]
        return [pa.array(np.diff(at), pa.int64()), pa.array(packed, pa.binary())]

    return annotate(df, "n_tokens long, packed binary", run, ["doc_id"])


def _wide(packed: bytes, n: int) -> np.ndarray:
    """Ids of a text: two bytes each if the length says so, or four."""
    raw = zstandard.decompress(packed)
    return np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4")


def id_counts(encoded: DataFrame) -> DataFrame:
    """``id`` and how often it occurs in all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("n_tokens", "packed"))
            texts = [_wide(packed, n) for n, packed in zip(*columns, strict=True)]
            own = np.bincount(np.concatenate(texts)) if texts else total[:0]
            longer, shorter = (own, total) if len(own) > len(total) else (total, own)
            longer[: len(shorter)] += shorter
            total = longer
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], ["id", "n"])

    parts = encoded.select("n_tokens", "packed").mapInArrow(count, "id long, n long")
    return parts.groupBy("id").agg(F.sum("n").alias("n"))


def write(df: DataFrame, vocabulary: str, path: str, end_id: int = END_ID) -> None:
    """Encode the texts of ``df`` and write them as a token file."""
    spark = df.sparkSession
    encoded = durable(encode(df, vocabulary, end_id))
    # One row for each id of the vocabulary at most.
    counts = id_counts(encoded).toPandas().sort_values(["n", "id"], ascending=[False, True])
    order = counts["id"].to_numpy(np.int64)
    ranks = spark.createDataFrame(
        [(r, int(i)) for r, i in enumerate(order)], "rank long, id long"
    )
    ranks.coalesce(1).write.parquet(f"{path}/ranks")
    rank = np.zeros(int(order.max()) + 1 if len(order) else 1, np.uint32)
    rank[order] = np.arange(len(order))
    shared = spark.sparkContext.broadcast(rank)
    doc_kind = df.schema["doc_id"].dataType.simpleString()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before, number = TaskContext.get().partitionId(), 0, 0
        docs, ids, held = [], [], 0

        def block() -> pa.RecordBatch:
            control, data = pack(shared.value[np.concatenate(ids)])
            row = {
                "part": part, "block": number, "before": before, "n_ids": held, "doc_ids": docs,
                "lengths": [len(x) for x in ids], "control": control, "data": data,
            }
            return pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            kind = batch.schema.field("doc_id").type
            schema = pa.schema(
                [
                    ("part", pa.int64()), ("block", pa.int64()), ("before", pa.int64()),
                    ("n_ids", pa.int64()), ("doc_ids", pa.list_(kind)),
                    ("lengths", pa.list_(pa.int64())), ("control", pa.binary()),
                    ("data", pa.binary()),
                ]
            )
            columns = (batch.column(c).to_pylist() for c in ("doc_id", "n_tokens", "packed"))
            for doc, n, packed in zip(*columns, strict=True):
                docs.append(doc)
                ids.append(_wide(packed, n))
                held += n
                if held >= BLOCK_IDS:
                    yield block()
                    before, number = before + held, number + 1
                    docs, ids, held = [], [], 0
        if ids:
            yield block()

    n_bytes = encoded.agg(F.sum(F.octet_length("packed"))).first()[0] or 0
    n_parts = max(shards_for(n_bytes, PART_BYTES), spark.sparkContext.defaultParallelism)
    tie = F.xxhash64("packed").alias("tie")
    ordered = encoded.select("doc_id", tie, "n_tokens", "packed")
    ordered = ordered.repartitionByRange(n_parts, "doc_id", "tie")
    ordered = ordered.sortWithinPartitions("doc_id", "tie").drop("tie")
    made = ordered.mapInArrow(
        blocks,
        f"part long, block long, before long, n_ids long, doc_ids array<{doc_kind}>,"
        " lengths array<long>, control binary, data binary",
    )
    small_groups = {"parquet.block.size": GROUP_BYTES, "parquet.page.size.row.check.min": 1}
    made.write.options(compression="zstd", **small_groups).parquet(f"{path}/blocks")


def read(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids``.

    ``ids`` are little-endian unsigned 32-bit integers, the end id included.
    """
    ship_package(spark)
    blocks = spark.read.parquet(f"{path}/blocks")
    order = spark.read.parquet(f"{path}/ranks").orderBy("rank").toPandas()["id"]
    shared = spark.sparkContext.broadcast(order.to_numpy(np.uint32))
    sizes = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # A row for each part, not for each document, passes this window.
    base = sizes.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    base = durable(base)
    if base.count() <= MAX_SENT_PARTS:
        base = F.broadcast(base)
    placed = blocks.join(base, "part").withColumn("before", F.col("before") + F.col("base"))
    doc_kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                lengths = np.asarray(batch.column("lengths")[k].values, np.int64)
                control, data = (batch.column(c)[k].as_py() for c in ("control", "data"))
                ids = shared.value[unpack(control, data, int(lengths.sum()))].astype("<u4")
                at = np.concatenate([[0], np.cumsum(lengths)])
                column = pa.BinaryArray.from_buffers(
                    pa.binary(),
                    len(lengths),
                    [None, pa.py_buffer((4 * at).astype(np.int32)), pa.py_buffer(ids)],
                )
                start = pa.array(batch.column("before")[k].as_py() + at[:-1])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_ids")[k].values, start, pa.array(lengths), column],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    return placed.select("before", "doc_ids", "lengths", "control", "data").mapInArrow(
        documents, f"doc_id {doc_kind}, start long, n_tokens long, ids binary"
    )


def round_trip(df: DataFrame, vocabulary: str) -> DataFrame:
    """Write a token file in the shared folder and give back what is read from it."""
    path = scratch_path(df.sparkSession, "tokens")
    write(df, vocabulary, path)
    return read(df.sparkSession, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )
