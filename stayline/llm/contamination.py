"""Benchmark decontamination as a prefix-filtered containment join.

Benchmark items are cut into windows of ten words (an item of fewer words is one window).
The words are ordered by how many documents' words they make up, rarest first. A window is
contained in a document only whole, so the necessary prefix of its ordered words is one: its
rarest word. Documents meet a window only where they have that word; the word's place in the
window fixes where the window would have to begin (positional bound), which has to leave room
inside the document (length bound). What remains is compared word by word.

Items are a stated query set: they are sent to all tasks in blocks of bounded size, one pass
over the documents for each block, so neither side is ever shuffled by word.

Defined results: a null or empty text has no words and no hits; an item without words has no
windows; items that repeat each other's windows count once each; a null item_id can be hit and
counts once among ``n_items``, but isn't listed. Repeated documents are judged row by row. Other
columns of either table are ignored, or kept (``decontaminate``), whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stayline.llm.words import NOT_ALNUM, annotate, map_texts, words_of
from stayline.session import durable

WINDOW = 10
BLOCK_BYTES = 4 << 20  # of benchmark text sent to a task at once: an index of some 50 MB


def item_blocks(items: DataFrame, block_bytes: int) -> Iterator[list[tuple]]:
    """Items (id, text) in blocks; the driver holds one block and one partition at a time."""
    block: list[tuple] = []
    held = 0
    for row in items.select("item_id", "text").where("text is not null").toLocalIterator():
        size = len(row.text.encode())
        if block and held + size > block_bytes:
            yield block
            block, held = [], 0
        block.append((row.item_id, row.text))
        held += size
    if block:
        yield block


def word_counts(documents: DataFrame, known: list[bytes]) -> dict[bytes, int]:
    """How often each of ``known`` words occurs in all documents."""
    place = {w: i for i, w in enumerate(known)}
    shared = documents.sparkSession.sparkContext.broadcast(place)

    def count(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        words = words_of(batch.column("text"), NOT_ALNUM, lower=True)
        n = np.bincount(words.codes, minlength=len(words.vocabulary))
        at = [shared.value.get(w, -1) for w in words.vocabulary.to_pylist()]
        found = np.array(at, np.int64)
        here = found >= 0
        return pa.RecordBatch.from_arrays(
            [pa.array(found[here], pa.int64()), pa.array(n[here], pa.int64())], ["word", "n"]
        )

    counted = map_texts(documents.select("text"), "word long, n long", count)
    totals = counted.groupBy("word").agg(F.sum("n").alias("n")).toPandas()
    out = dict.fromkeys(known, 0)
    for word, n in zip(totals["word"], totals["n"], strict=True):
        out[known[word]] = int(n)
    return out


class WindowIndex:
    """Different windows of a block of items in arrays, by their rarest word.

    A window takes some 60 bytes, as words are numbers by rarity.
    """

    def __init__(self, items: list[tuple], counts: dict[bytes, int], window: int) -> None:
        found = words_of(pa.array([t for _, t in items], pa.string()), NOT_ALNUM, lower=True)
        vocabulary = found.vocabulary.to_pylist()
        order = sorted(range(len(vocabulary)), key=lambda i: (counts[vocabulary[i]], vocabulary[i]))
        rank = np.empty(len(vocabulary), np.int32)
        rank[order] = np.arange(len(vocabulary), dtype=np.int32)
        self.rank = {vocabulary[i]: r for r, i in enumerate(order)}
        self.ids = [None if i is None else str(i) for i, _ in items]
        n = np.diff(found.offsets)
        width = np.minimum(n, window)
        per_item = np.where(n > 0, n - width + 1, 0)
        item = np.repeat(np.arange(len(n), dtype=np.int32), per_item)
        begin = np.cumsum(per_item) - per_item
        start = found.offsets[:-1][item] + np.arange(len(item)) - begin[item]
        cells = np.full((len(item), window), -1, np.int32)  # short windows end in -1
        ranked = rank[found.codes]
        for k in range(window):
            held = width[item] > k
            cells[held, k] = ranked[start[held] + k]
        self.windows, of = np.unique(cells, axis=0, return_inverse=True)
        pairs = np.unique(np.stack([of.ravel(), item], axis=1), axis=0)
        self.items = pairs[:, 1]
        self.items_at = np.searchsorted(pairs[:, 0], np.arange(len(self.windows) + 1))
        self.length = (self.windows >= 0).sum(axis=1)
        hidden = np.where(self.windows < 0, np.iinfo(np.int32).max, self.windows)
        self.offset = hidden.argmin(axis=1)
        rarest = hidden.min(axis=1)
        self.by_rarest = np.argsort(rarest, kind="stable")
        self.at = np.searchsorted(rarest[self.by_rarest], np.arange(len(self.rank) + 1))

    def hits(self, words) -> tuple[np.ndarray, np.ndarray]:
        """(first word, window) of each occurrence in a batch of documents."""
        known = np.array([self.rank.get(w, -1) for w in words.vocabulary.to_pylist()], np.int64)
        ranks = known[words.codes] if len(known) else np.zeros(0, np.int64)
        held = np.append(np.diff(self.at) > 0, False)
        places = np.flatnonzero(held[ranks])
        starts, windows = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        doc = np.searchsorted(words.offsets, places, side="right") - 1
        lo, hi = words.offsets[doc], words.offsets[doc + 1]
        by_word = np.argsort(ranks[places], kind="stable")
        cuts = np.flatnonzero(np.diff(ranks[places][by_word])) + 1
        for group in np.split(by_word, cuts) if len(places) else []:
            r = int(ranks[places[group[0]]])
            for i in self.by_rarest[self.at[r] : self.at[r + 1]].tolist():
                length = int(self.length[i])
                start = places[group] - self.offset[i]
                start = start[(start >= lo[group]) & (start + length <= hi[group])]
                for k in np.argsort(self.windows[i][:length]):  # rarest words first: most end here
                    if not len(start):
                        break
                    start = start[ranks[start + k] == self.windows[i][k]]
                starts.append(start)
                windows.append(np.full(len(start), i))
        return np.concatenate(starts), np.concatenate(windows)


SPAN = pa.struct([("start", pa.int64()), ("length", pa.int64())])
HITS = "spans array<struct<start:bigint,length:bigint>>, items array<string>"


def contamination(
    documents: DataFrame,
    items: DataFrame,
    keep: Sequence[str] | None = None,
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``documents`` with ``n_words``, ``spans`` and ``items``.

    ``spans`` are (first word, words) of runs that windows cover, ``items`` the different items (as
    text) whose windows occur. ``keep`` names the columns of documents to go on with.
    """
    kept = list(documents.columns if keep is None else keep)
    found, earlier = documents, []
    blocks = item_blocks(items, block_bytes)
    block = next(blocks, [])
    while True:
        after = next(blocks, None)
        # All but the last pass carry the text on, and are stored to keep one pass in memory.
        here = [*kept, *[c for e in earlier for c in e]] if after is None else None
        found = annotate(found, f"n_words long, {HITS}", _looker(documents, block, window), here)
        if after is None:
            break
        earlier.append((f"_spans_{len(earlier)}", f"_items_{len(earlier)}"))
        renamed = dict(zip(("spans", "items"), earlier[-1], strict=True))
        found = durable(found.withColumnsRenamed(renamed))
        block = after
    if not earlier:
        return found
    spans, names = zip(*earlier, strict=True)
    return found.withColumns(
        {
            "spans": F.concat(*[F.col(c) for c in [*spans, "spans"]]),
            "items": F.array_distinct(F.concat(*[F.col(c) for c in [*names, "items"]])),
        }
    ).drop(*spans, *names)


def _looker(documents: DataFrame, block: list[tuple], window: int):
    own = words_of(pa.array([t for _, t in block], pa.string()), NOT_ALNUM, lower=True)
    counts = word_counts(documents, own.vocabulary.to_pylist()) if block else {}
    shared = documents.sparkSession.sparkContext.broadcast(WindowIndex(block, counts, window))

    def look(texts: pa.Array) -> list[pa.Array]:
        words = words_of(texts, NOT_ALNUM, lower=True)
        of, n = shared.value, len(texts)
        start, window = of.hits(words)
        edge = np.zeros(len(words.codes) + 1, np.int64)
        np.add.at(edge, start, 1)
        np.subtract.at(edge, start + of.length[window], 1)
        inside = np.cumsum(edge[:-1]) > 0
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        cuts = words.offsets[1:-1]  # a run ends where its document does
        cuts = cuts[(cuts > 0) & (cuts < len(inside))]
        begins[cuts], ends[cuts - 1] = inside[cuts], inside[cuts - 1]
        first, last = np.flatnonzero(begins), np.flatnonzero(ends)
        at = np.searchsorted(first, words.offsets).astype(np.int32)
        doc = np.searchsorted(words.offsets, first, side="right") - 1
        runs = pa.StructArray.from_arrays(
            [pa.array(first - words.offsets[doc]), pa.array(last + 1 - first)], fields=list(SPAN)
        )
        # Each window once for a document, however often it occurs there.
        doc = np.searchsorted(words.offsets, start, side="right") - 1
        named: list[dict[str | None, None]] = [{} for _ in range(n)]
        for d, w in np.unique(np.stack([doc, window], axis=1), axis=0).tolist():
            for i in of.items[of.items_at[w] : of.items_at[w + 1]].tolist():
                named[d][of.ids[i]] = None
        return [
            pa.array(np.diff(words.offsets), pa.int64()),
            pa.ListArray.from_arrays(pa.array(at), runs),
            pa.array([list(x) for x in named], pa.list_(pa.string())),
        ]

    return look


def summary(found: DataFrame) -> DataFrame:
    """Counts and the digest of items of each document, from :func:`contamination`.

    Hit words are counted without Python: spans are sorted, and each adds what reaches beyond
    those before it.
    """
    spans = F.array_sort(
        F.transform(
            "spans",
            lambda h: F.struct(h["start"].alias("a"), (h["start"] + h["length"]).alias("b")),
        )
    )
    none = F.lit(0).cast("long")
    covered = F.aggregate(
        spans,
        F.struct(none.alias("end"), none.alias("n")),
        lambda seen, x: F.struct(
            F.greatest(seen["end"], x["b"]).alias("end"),
            (seen["n"] + F.greatest(none, x["b"] - F.greatest(seen["end"], x["a"]))).alias("n"),
        ),
    )
    listed = F.array_sort(F.filter("items", lambda i: i.isNotNull()))
    return found.select(
        "doc_id",
        "n_words",
        covered["n"].alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", listed), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def decontaminate(documents: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without any hit, with their own columns."""
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row")
    packed = documents.select(F.col("text"), row)
    found = contamination(packed, items, ["row"], window=window)
    return found.where(F.size("spans") == 0).select("row.*")
