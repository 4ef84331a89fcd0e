"""Quality rules: counts of each text, and its divergence from what its language looks like.

Two histograms of a document, of character classes and of common words, are compared to those
of each language by the Jensen-Shannon distance (the root of the divergence in bits, 0 to 1). A
language's histograms are summed over all documents that name it and pass the counting rules.
A document is kept if at least one language is near enough in both. Short texts have histograms
by chance, so each comparison has a least length, and what is near enough shrinks with length.

Defined results: a null or empty text has no words and fails the counting rules; a document too
short for a comparison passes it; without any reference (no document of a known language, or too
few words in it) nothing is rejected by divergence. Equal texts get equal verdicts whatever
their other columns are. Repeated rows stay.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stayline.llm.words import Words, annotate, mixed, window_hashes, words_of
from stayline.session import durable

# Frequent words of each language.
COMMON = {
    "en": "the of and to in is that for it as was with be by on not he at are this or from an have"
    " you a but they which one all we there their has will more can said been if were",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es"
    " an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über",
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il"
    " sont avec ou son cette aux elle mais comme on nous leur ses être fait deux",
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero sus"
    " le ha me si sin sobre este ya entre cuando todo esta ser son dos",
}
SYMBOLS = b"#*$%&|<>"
SENTENCE_MARKS = b".,;:!?'\"()-"
REPEAT_WINDOW = 8

_BINS = {w.encode(): i for i, w in enumerate(dict.fromkeys(" ".join(COMMON.values()).split()))}
N_CLASSES = 7


def _class_table() -> np.ndarray:
    """The class of each first byte of a character; continuation bytes have none (7)."""
    table = np.full(256, 5, np.uint8)  # other ASCII
    table[ord("a") : ord("z") + 1] = 0
    table[ord("A") : ord("Z") + 1] = 1
    table[ord("0") : ord("9") + 1] = 2
    table[[0x20, *range(0x09, 0x0E)]] = 3
    table[list(SENTENCE_MARKS)] = 4
    table[0x80:0xC0] = 7
    table[0xC0:] = 6
    return table


_CLASS = _class_table()
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True


def repeated_lines(words: Words) -> np.ndarray:
    """Lines with a word that are equal to an earlier line of their document."""
    data, at, n_docs = words.data, words.at, len(words.at) - 1
    if not len(data):
        return np.zeros(n_docs, np.int64)
    breaks = np.flatnonzero(data == 0x0A)
    begins = np.union1d(breaks + 1, at[:-1])
    begins = begins[begins < len(data)]
    gone = np.searchsorted(breaks, begins)  # line breaks left out before each line
    places = np.append(begins - gone, len(data) - len(breaks))
    lines = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(),
        len(begins),
        [None, pa.py_buffer(places.astype(np.int64)), pa.py_buffer(data[data != 0x0A])],
    ).dictionary_encode()
    ends = np.append(begins[1:], len(data))
    full = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, begins)
    doc = np.searchsorted(at, begins, side="right") - 1
    key = doc[full] * len(lines.dictionary) + np.asarray(lines.indices)[full]
    first = np.unique(key) // len(lines.dictionary)
    return np.bincount(doc[full], minlength=n_docs) - np.bincount(first, minlength=n_docs)


def repeated_words(words: Words, width: int = REPEAT_WINDOW) -> np.ndarray:
    """Words of each document in ``width``-word windows that it has twice or more."""
    n_docs = len(words.offsets) - 1
    codes, doc = words.codes, words.doc_of()
    spread = mixed(np.arange(1, len(words.vocabulary) + 1, dtype=np.uint64))
    hashes = window_hashes(spread[codes], width) + mixed(doc[: max(0, len(codes) - width + 1)].astype(np.uint64))
    whole = np.flatnonzero(doc[: len(hashes)] == doc[width - 1 :]) if len(hashes) else doc[:0]
    order = whole[np.argsort(hashes[whole], kind="stable")]
    same = hashes[order[1:]] == hashes[order[:-1]]
    a, b = order[:-1][same], order[1:][same]
    equal = doc[a] == doc[b]
    for k in range(width):
        equal &= codes[a + k] == codes[b + k]
    if not equal.all():  # two windows share a hash: tell them apart by their words
        rows = np.column_stack([doc[whole], *(codes[whole + k] for k in range(width))])
        _, inverse, n = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
        found = whole[n[inverse.ravel()] > 1]
    else:
        found = np.union1d(a, b)
    edge = np.zeros(len(codes) + 1, np.int64)
    np.add.at(edge, found, 1)
    np.add.at(edge, found + width, -1)
    covered = np.cumsum(edge[:-1]) > 0
    return np.bincount(doc[covered], minlength=n_docs)


def common_words(words: Words) -> np.ndarray:
    """Counts of common words in each document; the last column counts all others."""
    width = len(_BINS) + 1
    bins = np.fromiter(
        (
            _BINS.get(w.lower().strip(SENTENCE_MARKS), width - 1)
            for w in words.vocabulary.to_pylist()
        ),
        np.int64,
        len(words.vocabulary),
    )
    key = words.doc_of() * width + bins[words.codes]
    return np.bincount(key, minlength=(len(words.offsets) - 1) * width).reshape(-1, width)


def class_counts(words: Words) -> np.ndarray:
    doc = np.repeat(np.arange(len(words.at) - 1), np.diff(words.at))
    key = doc * (N_CLASSES + 1) + _CLASS[words.data]
    counts = np.bincount(key, minlength=(len(words.at) - 1) * (N_CLASSES + 1))
    return counts.reshape(-1, N_CLASSES + 1)[:, :N_CLASSES]


FIELDS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
    " classes array<int>, common array<int>"
)


def _lists(rows: np.ndarray) -> pa.Array:
    ends = np.arange(0, rows.size + 1, max(1, rows.shape[1]), dtype=np.int32)
    return pa.ListArray.from_arrays(ends, pa.array(rows.astype(np.int32).ravel()))


def text_counts(texts: pa.Array) -> list[pa.Array]:
    words = words_of(texts)
    own = np.zeros(len(words.data) + 1, np.int64)
    np.add.at(own, words.starts, 1)
    np.add.at(own, words.ends, -1)
    inside = np.cumsum(own[:-1]) > 0
    columns = (
        np.diff(words.offsets),
        words.per_doc(inside & ((words.data & 0xC0) != 0x80)),
        words.per_doc(_SYMBOL[words.data]),
        repeated_lines(words),
        repeated_words(words),
    )
    numbers = [pa.array(c, pa.int64()) for c in columns]
    return [*numbers, _lists(class_counts(words)), _lists(common_words(words))]


def base_failed():
    n, repeated = F.col("n_words"), F.col("n_repeat_words")
    return (n < 20) | (100 * repeated > 30 * n)


@dataclass
class References:
    """A row for each language: its shares of character classes and of common words."""

    classes: np.ndarray
    common: np.ndarray


def language_references(
    counted: DataFrame, lang: str = "lang", min_words: int = 1000
) -> References:
    """Histograms of the languages of :data:`COMMON`, over all rows that pass the base rules."""
    good = counted.where(~base_failed() & F.col(lang).isin(*COMMON))
    long = good.select(
        lang, F.posexplode(F.concat("classes", "common")).alias("bin", "n")
    )
    sums = long.groupBy(lang, "bin").agg(F.sum("n").alias("n")).collect()
    table: dict[str, np.ndarray] = {}
    for row in sums:
        table.setdefault(row[0], np.zeros(N_CLASSES + len(_BINS) + 1))[row["bin"]] = row["n"]
    known = [v for _, v in sorted(table.items()) if v[N_CLASSES:].sum() >= min_words]
    rows = np.array(known).reshape(-1, N_CLASSES + len(_BINS) + 1)
    return References(_shares(rows[:, :N_CLASSES]), _shares(rows[:, N_CLASSES:]))


def _shares(counts: np.ndarray) -> np.ndarray:
    return counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Of each row of ``p`` from each row of ``q``: (rows of p, rows of q), 0 to 1."""

    def information(x: np.ndarray) -> np.ndarray:
        return np.where(x > 0, x * np.log2(np.where(x > 0, x, 1)), 0).sum(axis=-1)

    middle = (p[:, None, :] + q[None, :, :]) / 2
    divergence = (information(p)[:, None] + information(q)[None, :]) / 2 - information(middle)
    return np.sqrt(np.clip(divergence, 0, 1))


@dataclass(frozen=True)
class Limits:
    """What is near enough: ``most`` + ``slack`` / sqrt(length), from a least length on."""

    class_most: float = 0.2
    class_slack: float = 1.5
    min_chars: int = 200
    common_most: float = 0.25
    common_slack: float = 2.5
    min_words: int = 50


def quality_rules(
    documents: DataFrame, limits: Limits = Limits(), references: References | None = None
) -> DataFrame:
    """The counts of each document, its distances and whether it is kept.

    The counts are stored, as the references are sums over all of them.
    """
    columns = [c for c in ("doc_id", "lang") if c in documents.columns]
    counted = durable(annotate(documents, FIELDS, text_counts, columns))
    of = references or language_references(counted)
    shared = documents.sparkSession.sparkContext.broadcast(of)

    def judge(batches):
        for batch in batches:
            ref = shared.value
            n = len(batch)
            classes = np.asarray(batch.column("classes").flatten()).reshape(n, -1)
            common = np.asarray(batch.column("common").flatten()).reshape(n, -1)
            if len(ref.classes):
                by_class = js_distance(_shares(classes), ref.classes)
                by_word = js_distance(_shares(common), ref.common)
                chars, words = classes.sum(axis=1), common.sum(axis=1)
                ok = by_class <= (
                    limits.class_most + limits.class_slack / np.sqrt(np.maximum(chars, 1))
                )[:, None]
                ok |= (chars < limits.min_chars)[:, None]
                near = by_word <= (
                    limits.common_most + limits.common_slack / np.sqrt(np.maximum(words, 1))
                )[:, None]
                near |= (words < limits.min_words)[:, None]
                like, c, w = (ok & near).any(axis=1), by_class.min(axis=1), by_word.min(axis=1)
            else:
                like, c, w = np.ones(n, bool), np.zeros(n), np.zeros(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(c), pa.array(w), pa.array(like)],
                ["row", "class_distance", "word_distance", "like_language"],
            )

    row = F.struct(*[c for c in counted.columns if c not in ("classes", "common")]).alias("row")
    packed = counted.select(row, "classes", "common")
    kind = packed.schema["row"].dataType.simpleString()
    judged = packed.mapInArrow(
        judge, f"row {kind}, class_distance double, word_distance double, like_language boolean"
    ).select("row.*", "class_distance", "word_distance", "like_language")
    return judged.withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & F.col("like_language")
    )
