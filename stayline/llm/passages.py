"""Substring deduplication: every occurrence of a passage that recurs anywhere in the corpus.

A window is ``width`` consecutive words of one document. Documents are dealt into shards of
bounded size. Two exchanges of hashes choose candidates, a third one confirms passages word by
word, and automata of confirmed passages find where they occur:

1. Equal windows have equal minimizers, the least hash of their runs of ``GRAM`` words. Each
   shard sends its distinct minimizers, about one for 14 words, and learns which of them other
   shards have as well.
2. Of windows with such a minimizer, each shard sends the distinct hashes, and learns which other
   shards have, too. These, and those it has twice itself, are its candidates.
3. Neighbouring candidates with the same minimizer make up a piece of text. A shard sends each
   different piece (twice, if it has it more than once) to the one owner of that minimizer, which
   compares all windows of its pieces word by word. Runs of windows that occur twice are
   confirmed passages, and go back to the shards that sent them.
4. Each shard compiles the passages it is sent into Aho-Corasick automata, a bounded number of
   words at a time, and streams all its documents through them. Words inside an occurrence are
   removed. What a shard thought to be candidates has no say in this.

Every window of a recurring passage is in one piece, and equal windows have the same owner, so
none is missed; no hash decides, so none is removed wrongly. A hash or piece travels once for each
shard that has it, so a passage in a third of all documents is no heavier than any other. Where
more than ``BUSY`` shards have a minimizer, as of a common phrase, windows go to owners by their
own hash, so the texts around a phrase are spread. A piece has at most ``LONGEST`` windows.

Defined results: null and empty texts, and those shorter than a window, lose nothing (null stays
null in ``kept_text``, other texts are their words joined by a space); of repeated rows all lose
the repeated words, as windows are judged on the input, not on what is left. Other columns are
kept whatever their names; new columns replace old ones of the same name.
"""

from __future__ import annotations

import itertools
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable
from functools import cached_property

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from stayline.llm.words import (
    Places,
    Words,
    mixed,
    places_of,
    shards_for,
    ship_package,
    text_bytes,
    window_hashes,
    words_of,
)
from stayline.session import durable

WINDOW = 35
GRAM = 8
SHARD_BYTES = 8 << 20  # of text that is looked at together
PARTITION_BYTES = 128 << 20  # of text in a task: its shards come one after the other
AUTOMATON_WORDS = 200_000
BASE = 63  # of the digits that spell a word
BUSY = 1024  # shards with the same minimizer
LONGEST = 256  # windows of a piece


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each run of ``width`` neighbours, at its first place."""
    n, size = max(0, len(x) - width + 1), 1
    while 2 * size <= width:
        x = np.minimum(x[:-size], x[size:]) if len(x) > size else x[:0]
        size *= 2
    return np.minimum(x[:n], x[width - size : width - size + n])


class Shard:
    """The words of a shard's documents and their windows."""

    def __init__(self, texts: pa.Array, width: int) -> None:
        self.places: Places = places_of(texts)
        self.width = width
        self.hashes = self.places.hashes()
        doc = self.places.doc_of()
        n = max(0, len(doc) - width + 1)
        self.inside = np.flatnonzero(doc[:n] == doc[width - 1 :]) if n else np.zeros(0, np.int64)

    @cached_property
    def words(self) -> Words:
        return self.places.words()

    def minimizers(self) -> np.ndarray:
        """Of each window inside a document."""
        gram = min(GRAM, self.width)
        least = sliding_min(window_hashes(self.hashes, gram), self.width - gram + 1)
        return mixed(least[self.inside])

    def windows(self) -> np.ndarray:
        return window_hashes(self.hashes, self.width)[self.inside]

    def recurring(self, elsewhere: np.ndarray) -> np.ndarray:
        """Which windows another shard has, or this one has twice, as far as hashes tell."""
        own = self.windows()
        order = np.argsort(own)
        own = own[order]
        chosen = _among(own, elsewhere)
        twice = own[1:] == own[:-1]
        chosen[1:] |= twice
        chosen[:-1] |= twice
        found = np.zeros(len(own), bool)
        found[order[chosen]] = True
        return found

    def repeated(self) -> np.ndarray:
        """Which windows occur twice, word by word."""
        own, codes = self.windows(), self.words.codes
        order = np.argsort(own)
        new = np.append(True, own[order[1:]] != own[order[:-1]])[: len(own)]
        group = np.cumsum(new) - 1
        at = self.inside[order]
        first = at[new][group]
        same = np.ones(len(at), bool)
        for k in range(self.width):
            same &= codes[at + k] == codes[first + k]
        twice = same & (np.bincount(group, same)[group] >= 2) if len(at) else same
        others = defaultdict(list)  # that only share the hash with the first of their group
        for k in np.flatnonzero(~same).tolist():
            others[codes[at[k] : at[k] + self.width].tobytes()].append(k)
        for places in others.values():
            twice[places] = len(places) >= 2
        found = np.zeros(len(at), bool)
        found[order[twice]] = True
        return found

    def runs(self, chosen: np.ndarray, keys: np.ndarray | None = None, longest: int = 0):
        """First word and end of each run of neighbouring chosen windows with the same key."""
        starts = self.inside[chosen]
        if not len(starts):
            return starts, starts
        cut = np.diff(starts) != 1
        cut |= np.diff(self.places.doc_of()[starts]) != 0
        if keys is not None:
            cut |= keys[chosen][1:] != keys[chosen][:-1]
        first = np.append(0, np.flatnonzero(cut) + 1)
        if longest:
            lengths = np.diff(np.append(first, len(starts)))
            place = np.arange(len(starts)) - np.repeat(first, lengths)
            first = np.flatnonzero(place % longest == 0)
        last = np.append(first[1:] - 1, len(starts) - 1)
        return starts[first], starts[last] + self.width

    def joined(self) -> tuple[np.ndarray, np.ndarray]:
        """All words with a blank after each, and where each begins."""
        lengths = self.places.ends - self.places.starts
        at = np.concatenate([[0], np.cumsum(lengths + 1)])
        blank = np.zeros(at[-1], bool)
        blank[at[1:] - 1] = True
        out = np.full(at[-1], ord(" "), np.uint8)
        out[~blank] = self.places.data[self.places.inside]
        return out, at


def _spans(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` places lie in a span; spans do not overlap, but may touch."""
    edge = np.zeros(n + 1, np.int8)
    edge[starts] += 1
    edge[ends] -= 1
    return np.cumsum(edge[:-1], dtype=np.int8) > 0


def _among(x: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Whether each of ``x`` is in a sorted array."""
    if not len(ordered):
        return np.zeros(len(x), bool)
    return ordered[np.minimum(np.searchsorted(ordered, x), len(ordered) - 1)] == x


def _distinct(ordered: np.ndarray) -> np.ndarray:
    return ordered[np.append(True, ordered[1:] != ordered[:-1])[: len(ordered)]]


def _hashes_of(table: pa.Table, column: str = "hashes") -> np.ndarray:
    held = (b.as_buffer() for c in table[column].chunks for b in c if b.is_valid)
    blocks = [np.frombuffer(b, np.uint64) for b in held]
    return np.sort(np.concatenate([np.zeros(0, np.uint64), *blocks]))


def _block_of(hashes: np.ndarray, n_blocks: int) -> np.ndarray:
    return (mixed(hashes ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(n_blocks)).astype(np.int64)


def _blocks(shard: int, hashes: np.ndarray, n_blocks: int) -> pa.Table:
    """Distinct hashes of a shard, a row for each block."""
    hashes = _distinct(np.sort(hashes))
    block = _block_of(hashes, n_blocks)
    order = np.argsort(block, kind="stable")
    names, first = np.unique(block[order], return_index=True)
    parts = np.split(hashes[order], first[1:]) if len(names) else []
    return pa.table(
        {
            "block": pa.array(names, pa.int64()),
            "shard": pa.array([shard] * len(names), pa.int64()),
            "hashes": pa.array([p.tobytes() for p in parts], pa.binary()),
        }
    )


def _shared(table: pa.Table) -> pa.Table:
    """Of one block of hashes: for each shard, those that another has too, and that many have."""
    distinct, n = np.unique(_hashes_of(table), return_counts=True)
    common, busy = distinct[n > 1], distinct[n > BUSY]
    shards, out, out_busy = [], [], []
    for shard, raw in zip(table["shard"].to_pylist(), table["hashes"].to_pylist(), strict=True):
        own = np.frombuffer(raw, np.uint64)
        own = own[_among(own, common)]
        if len(own):
            shards.append(shard)
            out.append(own.tobytes())
            out_busy.append(own[_among(own, busy)].tobytes())
    return pa.table(
        {
            "shard": pa.array(shards, pa.int64()),
            "hashes": pa.array(out, pa.binary()),
            "busy": pa.array(out_busy, pa.binary()),
        }
    )


def shared_hashes(sent: DataFrame) -> DataFrame:
    return sent.groupBy("block").applyInArrow(_shared, "shard long, hashes binary, busy binary")


def _packed(name: str, texts: dict[int, Iterable[bytes]]) -> pa.Table:
    """Texts without line ends, compressed, a row for each number."""
    raw = [b"\n".join(t) for t in texts.values()]
    return pa.table(
        {
            name: pa.array(texts, pa.int64()),
            "size": pa.array([len(r) for r in raw], pa.int64()),
            "texts": pa.array([pa.compress(r, "zstd", asbytes=True) for r in raw], pa.binary()),
        }
    )


def _unpacked(table: pa.Table) -> list[list[bytes]]:
    rows = zip(table["texts"].to_pylist(), table["size"].to_pylist(), strict=True)
    return [pa.decompress(raw, size, "zstd", asbytes=True).split(b"\n") for raw, size in rows]


def candidates(own: Shard, elsewhere: np.ndarray, busy: np.ndarray, n_blocks: int) -> pa.Table:
    """Pieces of a shard whose windows may recur, a row for each block of owners."""
    keys = own.minimizers()
    keys = np.where(_among(keys, busy), mixed(own.windows()), keys)
    first, end = own.runs(own.recurring(elsewhere), keys, LONGEST)
    block = _block_of(keys[np.searchsorted(own.inside, first)], n_blocks).tolist()
    joined, at = own.joined()
    data, a, b = joined.tobytes(), at[first].tolist(), (at[end] - 1).tolist()
    counts = Counter((k, data[i:j]) for k, i, j in zip(block, a, b, strict=True))
    out = defaultdict(list)
    for (k, text), n in counts.items():
        out[k] += [text] * min(n, 2)
    return _packed("block", out)


def confirmed(shards: list[int], texts: list[list[bytes]], width: int) -> dict[int, set[bytes]]:
    """Passages whose windows all occur twice in the pieces, for each shard that sent them."""
    flat = pa.array([t for own in texts for t in own], pa.large_binary())
    of = [s for s, own in zip(shards, texts, strict=True) for _ in own]
    owner = Shard(flat, width)
    words = owner.words
    first, end = owner.runs(owner.repeated())
    piece = words.doc_of()[first].tolist()
    data = words.data.tobytes()
    a, b = words.starts[first].tolist(), words.ends[end - 1].tolist()
    out = defaultdict(set)
    for k, i, j in zip(piece, a, b, strict=True):
        out[of[k]].add(data[i:j])
    return out


def passages(words: Words, texts: Iterable[bytes]) -> list[np.ndarray]:
    """Texts as codes of the words of a shard."""
    found = words_of(pa.array(list(texts), pa.large_binary()))
    place = pc.index_in(found.vocabulary, words.vocabulary)
    codes = np.asarray(pc.fill_null(place, -1))[found.codes]
    runs = np.split(codes, found.offsets[1:-1]) if len(codes) else []
    return [run for run in runs if run.min(initial=0) >= 0]


def _spelling(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Characters of each word of a vocabulary, and how many it has, few if it is frequent.

    A word's rank is written in digits. Characters tell the first place from later ones, and the
    last digit from others, so an occurrence begins where a word does and ends where one does. A
    node of an automaton, which looks at its children one by one, has at most ``2 * BASE``. Words
    with no count are in no passage: one character is enough for all of them.
    """
    order = np.argsort(-counts, kind="stable")
    rank = np.empty(len(counts), np.int64)
    rank[order] = np.arange(len(counts))
    size, digits = np.ones(len(counts), np.int64), 1
    while BASE**digits < np.count_nonzero(counts):
        size += rank >= BASE**digits
        digits += 1
    place = np.arange(digits)
    spelled = rank[:, None] // BASE**place % BASE
    spelled += BASE * (place < size[:, None] - 1) + 2 * BASE * (place > 0)
    spelled[counts == 0], size[counts == 0] = 4 * BASE, 1
    return spelled.astype(np.uint8), size


def occurrences(words: Words, found: list[np.ndarray], limit: int = AUTOMATON_WORDS) -> np.ndarray:
    """Which words lie inside an occurrence of any passage."""
    if not found:
        return np.zeros(len(words.codes), bool)
    codes, lengths = np.concatenate(found), [len(run) for run in found]
    counts = np.bincount(words.codes, minlength=len(words.vocabulary))
    absent = np.ones(len(counts), bool)
    absent[codes] = False
    counts[absent] = 0
    spelled, size = _spelling(counts)

    def spell(codes: np.ndarray, cuts: np.ndarray) -> tuple[str, np.ndarray, list[int]]:
        chosen = np.arange(spelled.shape[1]) < size[codes][:, None]
        at = np.concatenate([[0], np.cumsum(size[codes])])
        return spelled[codes][chosen].tobytes().decode("latin-1"), at, at[cuts].tolist()

    text, at, bounds = spell(words.codes, words.offsets)
    passage, _, cuts = spell(codes, np.concatenate([[0], np.cumsum(lengths)]))
    edge = np.zeros(len(words.codes) + 1, np.int64)
    held, automaton = 0, ahocorasick.Automaton(ahocorasick.STORE_INTS)
    texts = (passage[i:j] for i, j in itertools.pairwise(cuts))
    parts = sorted(zip(texts, lengths, strict=True))
    for k, (part, n) in enumerate(parts, 1):
        automaton.add_word(part, n)
        held += n
        if held < limit and k < len(parts):
            continue
        automaton.make_automaton()
        ends, sizes = [], []
        for a, b in itertools.pairwise(bounds):
            for last, n_words in automaton.iter(text[a:b]):
                ends.append(a + last + 1)
                sizes.append(n_words)
        end = np.searchsorted(at, np.array(ends, np.int64))
        np.add.at(edge, end - np.array(sizes, np.int64), 1)
        np.add.at(edge, end, -1)
        held, automaton = 0, ahocorasick.Automaton(ahocorasick.STORE_INTS)
    return np.cumsum(edge[:-1]) > 0


def _kept_text(texts: pa.Array, words: Words, covered: np.ndarray) -> pa.Array:
    stay = ~covered
    places = np.concatenate([[0], np.cumsum(words.ends - words.starts)])
    inside = _spans(words.starts, words.ends, len(words.data))
    column = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(),
        len(words.starts),
        [None, pa.py_buffer(places.astype(np.int64)), pa.py_buffer(words.data[inside])],
    ).filter(pa.array(stay))
    at = np.concatenate([[0], np.cumsum(stay)])[words.offsets]
    lists = pa.LargeListArray.from_arrays(pa.array(at.astype(np.int64)), column)
    joined = pc.binary_join(lists, pa.scalar(b" ", pa.large_binary()))
    return pc.if_else(texts.is_null(), None, joined).cast(pa.string())


FIELDS = "n_words long, n_removed long, kept_text string"


def remove_repeats(
    df: DataFrame,
    keep: list[str] | None = None,
    width: int = WINDOW,
    shard_bytes: int = SHARD_BYTES,
    column: str = "text",
) -> DataFrame:
    """``df`` with ``n_words``, ``n_removed`` and ``kept_text``.

    ``keep`` names the columns to go on with, all of them if not given.
    """
    ship_package(df.sparkSession)
    kept = list(df.columns if keep is None else keep)
    cores = df.sparkSession.sparkContext.defaultParallelism
    n_bytes = text_bytes(df, column)
    n = max(2 * cores, shards_for(n_bytes, shard_bytes))
    partitions = max(2 * cores, shards_for(n_bytes, PARTITION_BYTES))
    text = F.col(f"`{column}`")
    by = [F.col("`doc_id`"), text] if "doc_id" in df.columns else [text]
    dealt = df.select(
        F.pmod(F.xxhash64(*by), F.lit(n)).alias("shard"),
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"),
        text.alias("text"),
    ).repartition(partitions, "shard")  # one exchange, which all passes share
    sent = "block long, shard long, hashes binary"

    def shard_of(table: pa.Table) -> Shard:
        return Shard(_whole(table["text"]), width)

    def send_minimizers(table: pa.Table) -> pa.Table:
        return _blocks(table["shard"][0].as_py(), shard_of(table).minimizers(), n)

    def send_windows(table: pa.Table, known: pa.Table) -> pa.Table:
        own = shard_of(table)
        shared = _among(own.minimizers(), _hashes_of(known))
        return _blocks(table["shard"][0].as_py(), own.windows()[shared], n)

    def send_pieces(table: pa.Table, known: pa.Table) -> pa.Table:
        busy = _distinct(_hashes_of(known, "busy"))
        out = candidates(shard_of(table), _hashes_of(known), busy, n)
        shard = pa.array([table["shard"][0].as_py()] * len(out), pa.int64())
        return out.add_column(1, "shard", shard)

    def confirm(table: pa.Table) -> pa.Table:
        return _packed("shard", confirmed(table["shard"].to_pylist(), _unpacked(table), width))

    new = StructType.fromDDL(FIELDS)
    schema = StructType([dealt.schema["row"], *new.fields])

    def locate(table: pa.Table, known: pa.Table) -> pa.Table:
        words = words_of(_whole(table["text"]))
        found = {text for texts in _unpacked(known) for text in texts}
        covered = occurrences(words, passages(words, found))
        removed = np.concatenate([[0], np.cumsum(covered)])[words.offsets]
        return pa.Table.from_arrays(
            [
                table["row"],
                pa.array(np.diff(words.offsets), pa.int64()),
                pa.array(np.diff(removed), pa.int64()),
                _kept_text(_whole(table["text"]), words, covered),
            ],
            schema.names,
        )

    by_shard = dealt.groupBy("shard")
    minimizers = durable(shared_hashes(by_shard.applyInArrow(send_minimizers, sent)))
    windows = shared_hashes(_with(dealt, minimizers, send_windows, sent))
    none = F.lit(None).cast("binary")
    known = windows.withColumn("busy", none).union(minimizers.withColumn("hashes", none))
    pieces = _with(dealt, known, send_pieces, "block long, shard long, size long, texts binary")
    found = pieces.groupBy("block").applyInArrow(confirm, "shard long, size long, texts binary")
    out = _with(dealt, found, locate, schema)
    return out.select(*[F.col(f"row.`{c}`") for c in kept if c not in new.names], *new.names)


def _whole(column: pa.ChunkedArray) -> pa.Array:
    joined = column.combine_chunks()
    return joined.chunk(0) if isinstance(joined, pa.ChunkedArray) else joined


def _with(
    dealt: DataFrame, known: DataFrame, f: Callable[[pa.Table, pa.Table], pa.Table], schema
) -> DataFrame:
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if len(left):
            return f(left, right)
        raise ValueError("a shard without documents was answered")

    return dealt.groupBy("shard").cogroup(known.groupBy("shard")).applyInArrow(run, schema)
