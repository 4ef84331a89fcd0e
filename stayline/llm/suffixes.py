"""Substring deduplication by suffix arrays kept as a logarithmic index family.

Texts are UTF-8 bytes. A byte goes if it lies in a string of ``length`` bytes that also starts in a
document with a smaller doc_id; strings never cross documents and are judged on the input.

Which suffixes can matter. Every string of ``length`` bytes has an anchor, the leftmost of its
``GRAM``-byte grams with the least hash, so equal strings have equal anchors. Neighbouring strings
share theirs: about one byte in eighteen is an anchor. A string reaches at least half of what it has
beside the gram to one side of it, so it holds the anchor's right or its left half: the gram and
that many bytes after or before it (33 or 34 for strings of 50). An anchor's *context*, the bytes of
its strings that hold a half which another document has too, is what is sent. Documents are dealt
into shards of bounded size; each sends hashes of its halves (4 bytes each, in blocks), hears by a
bit for each which of them others have, and sends the contexts of those, compressed, each different
one once with its least doc_id. Grams of a few words are in other documents by chance, the more so
the larger the corpus is; halves are much less.

The index. Contexts are dealt into parts by their gram, so all strings that could be equal meet in
one part. What has the whole context of a smaller doc_id goes by that, and a gram with one context
left has no other to meet. The strings of all others, in bounded numbers by gram, go into families:
levels of sorted suffixes, cut at ``length`` bytes, with the least doc_id of each. The contexts of a
family come as batches in the order of doc_id. A batch gets its suffix array, is merge-scanned
against all existing levels (a match of ``length`` bytes in a smaller doc_id marks the string), and
becomes a level; levels that hold equally many batches are merged, so a suffix is merged once for
each doubling. A scan looks up the batch in levels that are much longer, so it costs a batch the
logarithm of what came before, not all of it. Only these scans and whole contexts mark strings;
marks go back to the shards as one bit for each string.

Bytes are compared as bytes; a hash only decides who meets. A passage in a third of all documents
is one context per shard. Parts and shards grow in number, not in size.

Defined results: a null text is empty; texts shorter than ``length`` lose nothing; rows with the
same doc_id aren't smaller than each other and lose nothing by each other; a row without a doc_id
loses nothing and takes nothing from others. Other columns are kept whatever their names; new
columns replace old ones of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from stayline.llm.passages import _distinct, _whole, _with
from stayline.llm.words import mixed, shards_for, ship_package, text_buffer, text_bytes

LENGTH = 50
GRAM = 16
SHARD_BYTES = 8 << 20  # of text that is looked at together
PARTITION_BYTES = 32 << 20  # of text in a task: its shards come one after the other
BLOCK_BYTES = 32 << 20  # of text for each block of hashes
PART_BYTES = 16 << 20  # of text for each part of the index
FAMILY = 1 << 21  # strings in a family, about
BATCH = 1 << 16  # strings in a batch, at least
CHUNK = 1 << 15  # bytes whose grams are hashed at once, what a core's cache holds
LONGER = 8  # times a batch: levels of that length are looked up instead of merged


def _run_hashes(data: np.ndarray, width: int, at: np.ndarray | None = None) -> np.ndarray:
    """A 64-bit hash of ``width`` bytes from each of the places ``at``, from all if not given."""
    n = max(0, len(data) - width + 1)
    if not n:
        return np.zeros(0, np.uint64)
    if width < 8:
        data = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) - 7, "<u8", np.ascontiguousarray(data), strides=(1,))

    def words(k: int) -> np.ndarray:
        return eight[k : k + n] if at is None else eight[at + k]

    out = words(0).astype(np.uint64)
    if width < 8:
        return mixed(out & np.uint64(256**width - 1))
    for k in [*range(8, width - 7, 8), *([width - 8] if width % 8 else [])]:
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += words(k)
    return mixed(out)


def gram_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of each run of ``width`` bytes, at its first place."""
    return _run_hashes(data, width)


def sliding_argmin(x: np.ndarray, width: int) -> np.ndarray:
    """The place of the leftmost least of each run of ``width`` neighbours.

    Numbers and places are put into 64 bits, so numbers have as many less as places need.
    """
    bits = np.uint64(len(x).bit_length())
    x, size, n = x << bits, 1, max(0, len(x) - width + 1)
    x |= np.arange(len(x), dtype=np.uint64)
    while 2 * size <= width and n:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    least = np.minimum(x[:n], x[width - size : width - size + n])
    return (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


class Anchors:
    """Of the documents of a shard: each anchor's gram and the run of strings that have it."""

    def __init__(self, texts: pa.Array, ids: np.ndarray, length: int) -> None:
        """``ids`` are masked where a row has no doc_id."""
        self.data, self.at = text_buffer(texts)
        self.length = length
        self.gram = gram = min(GRAM, length)
        n = len(self.data)
        edge = np.zeros(n + 1, np.int32)  # strings that would cross an end or lack a doc_id
        blocked = np.maximum(self.at[1:] - length + 1, self.at[:-1])
        blocked = np.where(np.ma.getmaskarray(ids), self.at[:-1], blocked)
        np.add.at(edge, blocked, 1)
        np.add.at(edge, self.at[1:], -1)
        inside = np.cumsum(edge[:-1], dtype=np.int32) == 0
        none = np.zeros(0, np.int64)
        keys, places, firsts, lasts = [none.astype(np.uint64)], [none], [none], [none]
        for a in range(0, n - length + 1, CHUNK):
            b = min(a + CHUNK, n - length + 1)
            grams = gram_hashes(self.data[a : b + length - 1], gram)
            place = sliding_argmin(grams >> np.uint64(24), length - gram + 1)
            within = inside[a:b]
            new = np.flatnonzero((place[1:] != place[:-1]) | (within[1:] != within[:-1])) + 1
            first, last = np.append(0, new), np.append(new, b - a) - 1
            runs = within[first]
            first, last = first[runs], last[runs]
            keys.append(grams[place[first]])
            places.append(place[first] + a)
            firsts.append(first + a)
            lasts.append(last + a)
        key, place, first, last = map(np.concatenate, (keys, places, firsts, lasts))
        # A run that a chunk's end has cut is one run.
        cut = (place[1:] != place[:-1]) | (first[1:] != last[:-1] + 1)
        begins, ends = np.append(True, cut)[: len(key)], np.append(cut, True)[: len(key)]
        self.keys, self.place = key[begins], place[begins]
        self.first, self.last = first[begins], last[ends]
        doc = np.searchsorted(self.at, self.first, side="right") - 1
        self.doc = np.asarray(np.ma.filled(ids, 0), np.int64)[doc]
        self.half = (length - gram) // 2
        self.right = np.flatnonzero(self.place - self.last <= self.half)
        self.left = np.flatnonzero(self.place - self.first > self.half)

    def halves(self, n_blocks: int) -> np.ndarray:
        """Block and 32 bits of a hash of each right half, then of each left half."""
        right = _run_hashes(self.data, self.length - self.half, self.place[self.right])
        at = self.place[self.left] - self.half - 1
        left = _run_hashes(self.data, self.half + 1 + self.gram, at)
        hashes = np.concatenate([right, left])
        block = mixed(hashes ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(n_blocks)
        return block << np.uint64(32) | hashes >> np.uint64(32)

    def entries(self, known: dict[int, bytes], n_blocks: int, parts: int) -> Entries:
        """What the shard sends to the parts, the same at each call.

        ``known`` has a bit for each half of a block that the shard has sent.
        """
        codes = self.halves(n_blocks)
        order = np.argsort(codes)
        code = codes[order]
        new = np.append(True, code[1:] != code[:-1])[: len(code)]
        group = np.cumsum(new) - 1
        names, n = np.unique(code[new] >> np.uint64(32), return_counts=True)
        bits = [
            np.unpackbits(np.frombuffer(known[block], np.uint8), count=k)
            for block, k in zip(names.tolist(), n.tolist(), strict=True)
        ]
        shared = np.concatenate([np.zeros(0, np.uint8), *bits]).astype(bool)
        # What two doc_ids of the shard have needs no other shard.
        doc = np.concatenate([self.doc[self.right], self.doc[self.left]])[order]
        shared[group[1:][~new[1:] & (doc[1:] != doc[:-1])]] = True
        flags = np.empty(len(codes), bool)
        flags[order] = shared[group]
        right, left = np.zeros(len(self.keys), bool), np.zeros(len(self.keys), bool)
        right[self.right] = flags[: len(self.right)]
        left[self.left] = flags[len(self.right) :]
        middle = self.place - self.half  # the first string that holds the right half
        first = np.where(left, self.first, np.maximum(self.first, middle))
        last = np.where(right, self.last, np.minimum(self.last, middle - 1))
        chosen = np.flatnonzero(right | left)
        return Entries(self, chosen, first[chosen], last[chosen], parts)


class Entries:
    """Different contexts with their least doc_id, by part; ``of`` names each anchor's entry."""

    def __init__(
        self, anchors: Anchors, chosen: np.ndarray, first: np.ndarray, last: np.ndarray, parts: int
    ) -> None:
        self.anchors, self.first, self.last = anchors, first, last
        raw = anchors.data.tobytes() if len(chosen) else b""
        ends = last + anchors.length
        seen: dict[bytes, int] = {}
        of = [
            seen.setdefault(raw[a:b], len(seen))
            for a, b in zip(first.tolist(), ends.tolist(), strict=True)
        ]
        self.of = np.array(of, np.int64)
        self.contexts = list(seen)
        # Documents come in the order of their ids, so an entry's first anchor has its least one.
        _, own = np.unique(self.of, return_index=True)
        self.all_docs = anchors.doc[chosen]
        self.doc = self.all_docs[own]
        self.strings = (last - first + 1)[own]
        self.offset = (anchors.place[chosen] - first)[own]  # of the gram in the context
        part = mixed(anchors.keys[chosen[own]] ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(parts)
        self.part = part.astype(np.int64)

    def blocks(self) -> Iterator[tuple[int, np.ndarray]]:
        """The entries of each part."""
        order = np.argsort(self.part, kind="stable")
        names, first = np.unique(self.part[order], return_index=True)
        if len(names):
            yield from zip(names.tolist(), np.split(order, first[1:]), strict=True)

    def table(self, shard: int) -> pa.Table:
        small = np.min_scalar_type(self.anchors.length)

        def packed(own: np.ndarray) -> bytes:
            joined = b"".join([self.contexts[i] for i in own.tolist()])
            return pa.compress(joined, "zstd", asbytes=True)

        rows = [
            (
                part,
                shard,
                packed(own),
                self.strings[own].astype(small).tobytes(),
                self.offset[own].astype(small).tobytes(),
                self.doc[own].tobytes(),
            )
            for part, own in self.blocks()
        ]
        return pa.Table.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 6, _TYPES, strict=True)],
            _NAMES,
        )

    def covered(self, marks: dict[int, bytes]) -> np.ndarray:
        """Which bytes lie in a marked string; ``marks`` has a bit for each string of a part."""
        begin = np.concatenate([[0], np.cumsum(self.strings)])
        flag = np.zeros(int(begin[-1]), bool)
        for part, own in self.blocks():
            n = self.strings[own]
            bits = np.unpackbits(np.frombuffer(marks[part], np.uint8), count=int(n.sum()))
            flag[_ranges(begin[own], n)] = bits.astype(bool)
        # Later documents of the shard have the whole context from the entry's own document.
        later = self.all_docs > self.doc[self.of]
        size = len(self.anchors.data)
        edge = np.zeros(size + 1, np.int8)
        edge[self.first[later]] += 1  # runs don't overlap, but may touch
        edge[self.last[later] + 1] -= 1
        gone = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
        first, n = self.first[~later], (self.last - self.first + 1)[~later]
        gone[_ranges(first, n)] = flag[_ranges(begin[self.of[~later]], n)]
        # A byte is covered if a marked string starts there or less than a length before.
        count = np.cumsum(gone, dtype=np.int32)
        length = self.anchors.length
        count[length:] -= count[:-length].copy()
        return count > 0


_NAMES = ["part", "shard", "contexts", "strings", "offsets", "docs"]
_TYPES = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
SENT = "part long, shard long, contexts binary, strings binary, offsets binary, docs binary"


def _sent_halves(shard: int, codes: np.ndarray) -> pa.Table:
    """The distinct halves of a shard, a row for each block."""
    codes = _distinct(np.sort(codes))
    names, first = np.unique(codes >> np.uint64(32), return_index=True)
    runs = np.split(codes.astype(np.uint32), first[1:]) if len(names) else []
    return pa.table(
        {
            "block": pa.array(names.astype(np.int64), pa.int64()),
            "shard": pa.array([shard] * len(names), pa.int64()),
            "halves": pa.array([r.tobytes() for r in runs], pa.binary()),
        }
    )


def _shared_halves(table: pa.Table) -> pa.Table:
    """Of one block: for each shard, a bit for each of its halves, set if another has it, too."""
    runs = [np.frombuffer(b.as_buffer(), np.uint32) for b in _whole(table["halves"])]
    halves = np.concatenate(runs).astype(np.uint64) << np.uint64(32)
    halves |= np.arange(len(halves), dtype=np.uint64)
    halves.sort()
    same = halves[1:] >> np.uint64(32) == halves[:-1] >> np.uint64(32)
    place = halves.astype(np.uint32)
    shared = np.zeros(len(halves), bool)
    shared[place[1:][same]] = True
    shared[place[:-1][same]] = True
    ends = np.cumsum([len(r) for r in runs])[:-1]
    bits = [np.packbits(own).tobytes() for own in np.split(shared, ends)]
    return pa.table(
        {"shard": table["shard"], "block": table["block"], "bits": pa.array(bits, pa.binary())}
    )


def _ranges(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """All of first[0], first[0] + 1, ... n[0] of them, then the next."""
    ends = np.cumsum(n)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(first - (ends - n), n)


class Family:
    """Levels of sorted different suffixes with their least doc_id, each with a count of batches."""

    def __init__(self) -> None:
        self.levels: list[tuple[int, np.ndarray, np.ndarray]] = []

    def add(self, suffixes: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Take a batch; whether each suffix is in a smaller doc_id, of levels or of the batch.

        Suffixes come in the order of ``docs``, in and between batches.
        """
        order = np.argsort(suffixes, kind="stable")  # by doc_id where suffixes are equal
        ranked = suffixes[order]
        new = np.append(True, ranked[1:] != ranked[:-1])
        own, least = ranked[new], docs[order][new]
        for _, level, known in self.levels:
            here, there = _meet(own, level)
            least[here] = np.minimum(least[here], known[there])
        out = np.empty(len(docs), bool)
        out[order] = least[np.cumsum(new) - 1] < docs[order]
        self._push(1, own, least)
        return out

    def _push(self, n: int, suffixes: np.ndarray, docs: np.ndarray) -> None:
        while self.levels and self.levels[-1][0] == n:
            held, older, of_older = self.levels.pop()
            suffixes, docs = _merged(older, of_older, suffixes, docs)
            n += held
        self.levels.append((n, suffixes, docs))


def _merge_order(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two sorted runs as one: the order, and where a suffix of ``a`` is followed by its equal."""
    both = np.concatenate([a, b])
    order = np.argsort(both, kind="stable")  # merges sorted runs in linear time
    both = both[order]
    return order, both[1:] == both[:-1]


def _meet(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of common suffixes in ``a`` and ``b``, by one merge scan or by looking up ``a``."""
    if len(b) > LONGER * len(a):
        at = np.minimum(np.searchsorted(b, a), len(b) - 1)
        same = b[at] == a
        return np.flatnonzero(same), at[same]
    order, same = _merge_order(a, b)
    return order[:-1][same], order[1:][same] - len(a)


def _merged(
    a: np.ndarray, of_a: np.ndarray, b: np.ndarray, of_b: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    order, same = _merge_order(a, b)
    docs = np.concatenate([of_a, of_b])[order]
    docs[:-1][same] = np.minimum(docs[:-1][same], docs[1:][same])
    first = np.append(True, ~same)
    return np.concatenate([a, b])[order[first]], docs[first]


def mark(table: pa.Table, length: int, batch: int = BATCH, family: int = FAMILY) -> pa.Table:
    """Bits for all strings that the shards sent to one part."""
    table = table.sort_by("shard")
    small = np.min_scalar_type(length)

    def runs(name: str, kind: type) -> list[np.ndarray]:
        return [np.frombuffer(b.as_buffer(), kind).astype(np.int64) for b in _whole(table[name])]

    counts = runs("strings", small)
    strings, offsets = np.concatenate(counts), np.concatenate(runs("offsets", small))
    docs = np.concatenate(runs("docs", np.int64))
    size = strings + length - 1
    sent = [int(n.sum()) + len(n) * (length - 1) for n in counts]
    packed = zip(_whole(table["contexts"]), sent, strict=True)
    data = [np.frombuffer(pa.decompress(b.as_buffer(), n, "zstd"), np.uint8) for b, n in packed]
    data = np.concatenate(data)
    at = np.cumsum(size) - size
    begin = np.cumsum(strings) - strings
    # Each different context is looked at once, with its least doc_id.
    order = np.argsort(docs, kind="stable")
    raw, seen = data.tobytes(), {}
    bounds = zip(order.tolist(), at[order].tolist(), (at + size)[order].tolist(), strict=True)
    first = np.empty(len(docs), np.int64)
    first[order] = [seen.setdefault(raw[a:b], i) for i, a, b in bounds]
    del raw, seen
    order = order[first[order] == order]
    # Equal strings have equal grams, so a gram's only context has none to meet.
    grams = _run_hashes(data, min(GRAM, length), (at + offsets)[order])
    _, of, n = np.unique(grams, return_inverse=True, return_counts=True)
    meets = n[of] > 1
    order, grams = order[meets], grams[meets]
    marked = np.zeros(int(strings.sum()), bool)
    families = int(strings[order].sum()) // family + 1
    of = mixed(grams ^ np.uint64(0x2545F4914F6CDD1D)) % np.uint64(families)
    windows = np.lib.stride_tricks.sliding_window_view(data, length)
    for name in range(families):
        chosen, index = order[of == name], Family()
        cuts = np.flatnonzero(np.diff(np.cumsum(strings[chosen]) // batch)) + 1
        for own in np.split(chosen, cuts) if len(chosen) else []:
            n = strings[own]
            suffixes = windows[_ranges(at[own], n)].view(f"S{length}").ravel()
            marked[_ranges(begin[own], n)] = index.add(suffixes, np.repeat(docs[own], n))
    found = marked[_ranges(begin[first], strings)]
    found |= np.repeat(docs > docs[first], strings)  # what the smaller doc_id has as it is
    ends = np.cumsum([int(n.sum()) for n in counts])[:-1]
    marks = [np.packbits(bits).tobytes() for bits in np.split(found, ends)]
    return pa.table(
        {"shard": table["shard"], "part": table["part"], "marks": pa.array(marks, pa.binary())}
    )


FIELDS = "n_bytes long, n_removed long, n_spans long, kept_bytes binary"


def _left(texts: pa.Array, anchors: Anchors, covered: np.ndarray) -> list[pa.Array]:
    """Per document: bytes, removed bytes, removed runs, and what stays."""
    begins, last = covered.copy(), covered.copy()
    begins[1:] &= ~covered[:-1]
    last[:-1] &= ~covered[1:]
    edges = anchors.at[1:-1]  # a document ends the run before it
    edges = edges[(edges > 0) & (edges < len(covered))]
    begins[edges] = covered[edges]
    last[edges - 1] = covered[edges - 1]
    starts = np.flatnonzero(begins)
    runs = np.searchsorted(starts, anchors.at)
    total = np.concatenate([[0], np.cumsum(np.flatnonzero(last) + 1 - starts)])[runs]
    kept = anchors.data[~covered]
    ends = (anchors.at - total).astype(np.int64)
    column = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(texts), [None, pa.py_buffer(ends), pa.py_buffer(kept)]
    )
    counts = [pa.array(np.diff(x).astype(np.int64)) for x in (anchors.at, total, runs)]
    return [*counts, column.cast(pa.binary())]


def remove_seen(
    df: DataFrame,
    keep: list[str] | None = None,
    length: int = LENGTH,
    shard_bytes: int = SHARD_BYTES,
    part_bytes: int = PART_BYTES,
    column: str = "text",
) -> DataFrame:
    """``df`` with ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_bytes``.

    ``keep`` names the columns to go on with, all of them if not given.
    """
    ship_package(df.sparkSession)
    kept = list(df.columns if keep is None else keep)
    cores = df.sparkSession.sparkContext.defaultParallelism
    n_bytes = text_bytes(df, column)
    n = max(2 * cores, shards_for(n_bytes, shard_bytes))
    blocks = max(2 * cores, shards_for(n_bytes, BLOCK_BYTES))
    parts = max(2 * cores, shards_for(n_bytes, part_bytes))
    partitions = max(2 * cores, shards_for(n_bytes, PARTITION_BYTES))
    text = F.col(f"`{column}`")
    dealt = df.select(
        F.pmod(F.xxhash64(F.col("doc_id"), text), F.lit(n)).alias("shard"),
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"),
        F.col("doc_id").cast("long").alias("id"),
        text.alias("text"),
    ).repartition(partitions, "shard")  # one exchange, which the three passes share

    def ordered(table: pa.Table) -> tuple[pa.Table, Anchors]:
        """Rows in an order that doesn't depend on how they came."""
        texts = _whole(table["text"])
        digest = [xxhash.xxh3_128_digest(t.as_buffer()) if t.is_valid else b"" for t in texts]
        table = table.append_column("digest", pa.array(digest, pa.binary()))
        table = table.sort_by([("id", "ascending"), ("digest", "ascending")])
        ids = _whole(table["id"])
        masked = np.ma.masked_array(
            ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(False)
        )
        return table, Anchors(_whole(table["text"]), masked, length)

    def send_halves(table: pa.Table) -> pa.Table:
        return _sent_halves(table["shard"][0].as_py(), ordered(table)[1].halves(blocks))

    def send_contexts(table: pa.Table, known: pa.Table) -> pa.Table:
        bits = dict(zip(known["block"].to_pylist(), known["bits"].to_pylist(), strict=True))
        return ordered(table)[1].entries(bits, blocks, parts).table(table["shard"][0].as_py())

    new = StructType.fromDDL(FIELDS)
    schema = StructType([dealt.schema["row"], *new.fields])

    def cut(table: pa.Table, answers: pa.Table) -> pa.Table:
        table, anchors = ordered(table)
        said = zip(answers["part"].to_pylist(), answers["marks"].to_pylist(), strict=True)
        marks, known = {}, {}
        for part, bits in said:
            (marks if part >= 0 else known)[part if part >= 0 else -1 - part] = bits
        covered = anchors.entries(known, blocks, parts).covered(marks)
        return pa.Table.from_arrays(
            [table["row"], *_left(_whole(table["text"]), anchors, covered)], schema.names
        )

    sent = dealt.groupBy("shard").applyInArrow(
        send_halves, "block long, shard long, halves binary"
    )
    known = sent.groupBy("block").applyInArrow(
        _shared_halves, "shard long, block long, bits binary"
    )
    contexts = _with(dealt, known, send_contexts, SENT)
    marks = contexts.groupBy("part").applyInArrow(
        lambda table: mark(table, length), "shard long, part long, marks binary"
    )
    # A shard finds its entries again from the same bits, which come with parts below 0.
    answers = marks.union(known.select("shard", -1 - F.col("block"), "bits"))
    out = _with(dealt, answers, cut, schema)
    return out.select(*[F.col(f"row.`{c}`") for c in kept if c not in new.names], *new.names)
