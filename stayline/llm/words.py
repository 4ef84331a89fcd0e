"""Words of a text column as numpy arrays, a batch of documents at a time.

Spark hands over Arrow batches; their UTF-8 buffers are read in place, so splitting and
hashing words costs no Python object per word. Separators are ASCII bytes throughout, which
never occur inside a multi-byte character.
"""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

BATCH_BYTES = 4 << 20
BATCH_ROWS = 2048

#: Separators of ``[^\x20\x09-\x0D]+``.
BLANKS = np.zeros(256, bool)
BLANKS[[0x20, *range(0x09, 0x0E)]] = True

#: Separators of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``, for text in lower case.
NOT_ALNUM = np.zeros(256, bool)
NOT_ALNUM[[*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


@dataclass
class Words:
    """Words of ``len(offsets) - 1`` documents; a null document has none."""

    codes: np.ndarray  # of each word: its place in ``vocabulary``
    offsets: np.ndarray  # document d has the words offsets[d]:offsets[d + 1]
    starts: np.ndarray  # bytes of each word in ``data``
    ends: np.ndarray
    vocabulary: pa.Array  # distinct words
    data: np.ndarray
    at: np.ndarray  # document d has the bytes at[d]:at[d + 1]

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        of = xxhash.xxh3_64_intdigest
        distinct = np.fromiter(
            (of(w.as_buffer()) for w in self.vocabulary), np.uint64, len(self.vocabulary)
        )
        return distinct[self.codes]

    def per_doc(self, flags: np.ndarray) -> np.ndarray:
        """How many bytes of each document are flagged."""
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return np.diff(total[self.at])

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.offsets))


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text array, one document after the other, and where each begins."""
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or not len(at):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


@dataclass
class Places:
    """Where the words of documents are in their bytes."""

    data: np.ndarray
    at: np.ndarray  # document d has the bytes at[d]:at[d + 1]
    inside: np.ndarray  # which bytes are of words
    starts: np.ndarray  # bytes of each word in ``data``
    ends: np.ndarray
    offsets: np.ndarray  # document d has the words offsets[d]:offsets[d + 1]

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.offsets))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes, eight at a time, without a list of the words."""
        lengths = self.ends - self.starts
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        eight = np.ndarray(len(self.data) + 1, "<u8", padded, strides=(1,))
        low = np.uint64(256) ** np.arange(9, dtype=np.uint64) - np.uint64(1)  # 256^8 is 0
        out = mixed(eight[self.starts] & low[np.minimum(lengths, 8)]) ^ lengths.astype(np.uint64)
        left = np.flatnonzero(lengths > 8)
        for k in range(8, int(lengths.max(initial=0)), 8):
            left = left[lengths[left] > k]
            part = eight[self.starts[left] + k] & low[np.minimum(lengths[left] - k, 8)]
            out[left] = mixed(out[left] * np.uint64(0x9E3779B97F4A7C15) ^ part)
        return out

    def words(self) -> Words:
        lengths = np.zeros(len(self.starts) + 1, np.int64)
        np.cumsum(self.ends - self.starts, out=lengths[1:])
        column = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(),
            len(self.starts),
            [None, pa.py_buffer(lengths), pa.py_buffer(self.data[self.inside])],
        ).dictionary_encode()
        codes = np.asarray(column.indices)
        return Words(
            codes, self.offsets, self.starts, self.ends, column.dictionary, self.data, self.at
        )


def places_of(texts: pa.Array, separators: np.ndarray = BLANKS, lower: bool = False) -> Places:
    data, at = text_buffer(texts)
    if lower:
        data = _LOWER[data]
    inside = ~separators[data]
    begins, last = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = at[1:-1]  # a document ends the word before it
    edges = edges[(edges > 0) & (edges < len(data))]
    begins[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(last) + 1
    return Places(data, at, inside, starts, ends, np.searchsorted(starts, at))


def words_of(texts: pa.Array, separators: np.ndarray = BLANKS, lower: bool = False) -> Words:
    return places_of(texts, separators, lower).words()


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def window_hashes(hashes: np.ndarray, width: int, factor: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """A 64-bit hash of each run of ``width`` neighbours, at its first place.

    Polynomials of runs of 1, 2, 4, ... neighbours are put together, so the work grows with the
    logarithm of ``width``.
    """
    n = max(0, len(hashes) - width + 1)
    out, power, size = hashes, factor, 1
    done, done_size = None, 0
    left = width
    while left:
        if left & 1:
            if done is None:
                done = out
            else:
                m = max(0, len(hashes) - done_size - size + 1)
                done = done[:m] * np.uint64(power) + out[done_size : done_size + m]
            done_size += size
        left >>= 1
        if left:
            m = max(0, len(hashes) - 2 * size + 1)
            out = out[:m] * np.uint64(power) + out[size : size + m]
            power, size = power * power % (1 << 64), 2 * size
    return mixed(done[:n])


def pieces(batch: pa.RecordBatch, column: str, size: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``size`` bytes of text, or one document if it is longer.

    None has more than ``BATCH_ROWS`` rows, so what takes memory for each row is bounded, too.
    """
    lengths = np.asarray(
        pc.fill_null(pc.binary_length(batch.column(column)), 0), np.int64
    )
    part = (np.cumsum(lengths) - lengths) // size
    steps = np.flatnonzero(np.diff(part)) + 1
    cuts = np.unique([0, *steps.tolist(), *range(0, len(lengths), BATCH_ROWS), len(lengths)])
    cuts = cuts.tolist()
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b > a:
            yield batch.slice(a, b - a)


def bound_batches(spark: SparkSession) -> None:
    """From now on Spark sends batches of no more rows than a piece has, and of about its bytes.

    An executor and its worker hold a batch whole, however small the pieces it is cut into. The
    setting is the session's; one that is there already stays.
    """
    own = spark.conf.getAll
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{name}"
        if key not in own:
            spark.conf.set(key, str(most))


def give_back() -> None:
    """Return freed memory to the system: a worker goes on to other stages, and keeps its heap."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each application.

    They need not have it on their path then; Spark serves the archive from the driver.
    """
    context = spark.sparkContext
    root = Path(__file__).resolve().parents[1]
    if context.applicationId in _SHIPPED or not root.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="stayline-")) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def map_texts(
    df: DataFrame,
    schema: str,
    f: Callable[[pa.RecordBatch], pa.RecordBatch | None],
    column: str = "text",
) -> DataFrame:
    """``f`` over slices of ``df`` of bounded size; no row leaves its partition."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, column):
                out = f(piece)
                if out is not None:
                    yield out
        give_back()

    return df.mapInArrow(run, schema)


def annotate(
    df: DataFrame,
    fields: str,
    f: Callable[[pa.Array], list[pa.Array]],
    keep: Sequence[str] | None = None,
    column: str = "text",
    size: int = BATCH_BYTES,
) -> DataFrame:
    """``df`` with columns that ``f`` makes of a text column.

    ``keep`` names the columns to go on with, all of them if not given; of columns with the
    same name, the new one stays. Rows are packed into one column meanwhile, so no name of
    ``df`` matters. ``column`` may also be a field of a kept struct (``row.text``).
    """
    ship_package(df.sparkSession)
    kept = list(df.columns if keep is None else keep)
    row = F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row")
    path = [column] if column in df.columns else column.split(".")
    carried = path[0] in kept  # then the text is sent once, within its row
    packed = df.select(row) if carried else df.select(row, F.col(f"`{column}`").alias("text"))
    new = StructType.fromDDL(fields)
    schema = StructType([packed.schema["row"], *new.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("row")
            texts = pc.struct_field(rows, path) if carried else batch.column("text")
            both = pa.RecordBatch.from_arrays([rows, texts], ["row", "text"])
            for piece in pieces(both, "text", size):
                made = f(piece.column("text"))
                yield pa.RecordBatch.from_arrays([piece.column("row"), *made], schema.names)
        give_back()

    out = packed.mapInArrow(run, schema)
    names = new.names
    return out.select(*[F.col(f"row.`{c}`") for c in kept if c not in names], *names)


def text_bytes(df: DataFrame, column: str = "text") -> int:
    """Bytes of text in all rows."""
    return df.agg(F.sum(F.octet_length(column))).first()[0] or 0


def shards_for(n_bytes: int, shard_bytes: int) -> int:
    return max(1, -(-n_bytes // shard_bytes))
