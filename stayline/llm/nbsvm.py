"""Quality classifier: a linear support vector machine on n-grams scaled by class ratios.

A text is the set of its hashed n-grams: words and word pairs, and runs of one to three word
shapes (``Aa!`` and ``***`` rather than letters, and
a sign of their own for words said twice). Each indicator is scaled by the log-count
ratio of its n-gram between the two classes, and each text to unit length. On that a hinge-loss
model is fitted by dual coordinate descent, one training text at a time, and its margins are
turned into probabilities on texts it didn't see.

The model is fitted on the driver, on at most ``SAMPLE`` labelled rows, taken in the order of a hash
of their doc_id, each with at most ``ROW_GRAMS`` n-grams, chosen by hash from its whole text. All
texts are scored, whole.

Defined results: a null or empty text has no n-grams and gets the score of the bare intercept;
without labels of both classes every score is the share of class 1 (0.5 without any label);
labels repeated for a doc_id count once, by their least value, and rows without a label or doc_id
teach nothing. Equal texts get equal scores, whatever their other columns are.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from stayline.llm.words import annotate, mixed, words_of

DIMENSION = 1 << 18
SAMPLE = 6_000
ROW_GRAMS = 3_000  # of one training text
PIECE_BYTES = 1 << 20  # of text that is cut into n-grams at once
EPOCHS = 12
COST = 1.0
SMOOTH = 1.0

#: The shape of a word that its text has just before.
_REPEATED = np.uint64(0x5245504541544544)

_UPPER = re.compile(rb"[A-Z]+")
_LOWER = re.compile(rb"[a-z\x80-\xff]+")
_DIGITS = re.compile(rb"[0-9]+")


def shape(word: bytes) -> bytes:
    """``Word,`` -> ``Aa,``; marks stay, runs of letters or digits become one."""
    return _DIGITS.sub(b"0", _LOWER.sub(b"a", _UPPER.sub(b"A", word)))


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, n-gram) of a batch, in order."""
    words = words_of(texts)
    doc = words.doc_of()
    shapes: dict[bytes, int] = {}
    of_shape = np.fromiter(
        (shapes.setdefault(shape(w), len(shapes)) for w in words.vocabulary.to_pylist()),
        np.int64,
        len(words.vocabulary),
    )
    kinds = pa.array(list(shapes), pa.large_binary())
    form = _hashes(kinds)[of_shape][words.codes]
    again = np.flatnonzero((words.codes[1:] == words.codes[:-1]) & (doc[1:] == doc[:-1])) + 1
    form[again] = _REPEATED
    word = words.hashes()
    keys = []
    for salt, hashes, n in ((1, word, 1), (2, word, 2), (3, form, 1), (4, form, 2), (5, form, 3)):
        m = max(0, len(hashes) - n + 1)
        key = np.full(m, salt, np.uint64)
        for k in range(n):
            key = key * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + m]
        whole = doc[:m] == doc[n - 1 :]
        place = (mixed(key) % np.uint64(DIMENSION)).astype(np.int64)
        keys.append(np.unique((doc[:m] * DIMENSION + place)[whole]))
    found = np.unique(np.concatenate(keys))
    return found // DIMENSION, found % DIMENSION


def _hashes(values: pa.Array) -> np.ndarray:
    of = xxhash.xxh3_64_intdigest
    return np.fromiter((of(v.as_buffer()) for v in values), np.uint64, len(values))


@dataclass
class Model:
    """``weights`` already hold the ratios; ``squares`` are those of the ratios."""

    weights: np.ndarray
    squares: np.ndarray
    bias: float
    slope: float
    offset: float

    def margins(self, doc: np.ndarray, gram: np.ndarray, n: int) -> np.ndarray:
        total = np.bincount(doc, self.weights[gram], minlength=n)
        length = np.sqrt(np.bincount(doc, self.squares[gram], minlength=n))
        return total / np.maximum(length, 1e-9) + self.bias

    def scores(self, texts: pa.Array) -> np.ndarray:
        doc, gram = grams(texts)
        margin = self.margins(doc, gram, len(texts))
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -30, 30)))


def constant_model(share: float) -> Model:
    zero = np.zeros(DIMENSION)
    share = min(max(share, 1e-6), 1 - 1e-6)
    return Model(zero, zero, 0.0, 0.0, float(np.log(share / (1 - share))))


def ratios(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Log-count ratios of n-grams: how much likelier in class 1 than in class 0."""
    both = []
    for label in (1, 0):
        own = [r for r, y in zip(rows, labels, strict=True) if y == label]
        count = SMOOTH + np.bincount(np.concatenate(own), minlength=DIMENSION)
        both.append(np.log(count / count.sum()))
    return both[0] - both[1]


def descend(
    rows: list[np.ndarray], values: list[np.ndarray], labels: np.ndarray, epochs: int, cost: float
) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the hinge loss: weights and bias of a linear model."""
    weights, bias = np.zeros(DIMENSION), 0.0
    dual = np.zeros(len(rows))
    sign = np.where(labels == 1, 1.0, -1.0)
    norm = np.array([v @ v + 1 for v in values])
    rng = np.random.default_rng(7)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            slope = sign[i] * (weights[rows[i]] @ values[i] + bias) - 1
            now = min(max(dual[i] - slope / norm[i], 0.0), cost)
            step = (now - dual[i]) * sign[i]
            if step:
                weights[rows[i]] += step * values[i]
                bias += step
                dual[i] = now
    return weights, bias


def calibrate(
    margins: np.ndarray, labels: np.ndarray, weights: np.ndarray | None = None
) -> tuple[float, float]:
    """Slope and offset of a logistic curve through margins, by Newton steps."""
    weights = np.ones(len(labels)) if weights is None else weights
    n1, n0 = int(labels.sum()), int((1 - labels).sum())
    target = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.column_stack([margins, np.ones_like(margins)])
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (weights * (p - target)) + 1e-3 * beta
        hessian = (x * (weights * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        move = np.linalg.solve(hessian, gradient)
        beta -= np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def held_back(labels: np.ndarray, every: int) -> np.ndarray:
    """One text in ``every`` of each class, and one at least of a class that has two."""
    out = np.zeros(len(labels), bool)
    for label in set(labels.tolist()):
        own = np.flatnonzero(labels == label)
        out[own[every - 1 :: every] if len(own) >= every else own[1:][-1:]] = True
    return out


def fit(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    """A model of texts given as arrays of distinct n-grams."""
    labels = np.asarray(labels, np.int64)
    learn = ~held_back(labels, 5)
    for part in (learn, ~learn):
        if len(set(labels[part].tolist())) < 2:
            return constant_model(float(labels.mean()) if len(labels) else 0.5)
    taught = [r for r, use in zip(rows, learn, strict=True) if use]
    ratio = ratios(taught, labels[learn])
    values = [(ratio[r] / max(np.sqrt(ratio[r] @ ratio[r]), 1e-9)).astype(np.float32) for r in taught]
    weights, bias = descend(taught, values, labels[learn], EPOCHS, COST)
    model = Model(weights * ratio, ratio * ratio, bias, 1.0, 0.0)
    rest = [r for r, use in zip(rows, learn, strict=True) if not use]
    doc = np.repeat(np.arange(len(rest)), [len(r) for r in rest])
    margin = model.margins(doc, np.concatenate(rest), len(rest))
    model.slope, model.offset = calibrate(margin, labels[~learn])
    return model


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the doc_id as text, modulo ``folds``; null without a doc_id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds


def labelled_rows(
    documents: DataFrame, labels: DataFrame, label: str, use: Column, limit: int
) -> DataFrame:
    """(order, label, text) of at most ``limit`` labelled documents for which ``use`` holds.

    The ids are chosen from the labels first and sent to the documents: they are at most
    ``limit`` rows.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & use)
    once = known.groupBy("doc_id").agg(F.min(label).cast("int").alias("label"))
    order = F.xxhash64("doc_id").alias("order")
    chosen = once.select("doc_id", "label", order).orderBy("order", "doc_id").limit(limit)
    found = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return found.select("order", "label", "text")


def train(documents: DataFrame, labels: DataFrame, use: Column, sample: int = SAMPLE) -> Model:
    rows = labelled_rows(documents, labels, "quality", use, sample)

    def extract(texts: pa.Array) -> list[pa.Array]:
        doc, gram = grams(texts)
        hashed = mixed(gram.astype(np.uint64))
        ranked = np.lexsort((hashed, doc))  # documents stay in order
        begin = np.searchsorted(doc, np.arange(len(texts)))
        stay = ranked[np.arange(len(doc)) - begin[doc[ranked]] < ROW_GRAMS]
        stay.sort()
        ends = np.searchsorted(doc[stay], np.arange(len(texts) + 1)).astype(np.int32)
        return [pa.ListArray.from_arrays(ends, pa.array(gram[stay].astype(np.int32)))]

    taken = annotate(rows, "grams array<int>", extract, ["order", "label"], size=PIECE_BYTES)
    # Rows are bounded each before they meet: at most 12 KB for each of the sample.
    taken = taken.orderBy("order", F.xxhash64("grams"), "label").limit(sample)
    got = taken.select("label", "grams").toArrow()
    grams_of = [np.asarray(g.values) for c in got["grams"].chunks for g in c]
    return fit(grams_of, got["label"].to_numpy())


def score(
    documents: DataFrame, model: Model, keep: list[str] | None = None, column: str = "text"
) -> DataFrame:
    """``documents`` with ``score``, the probability of label 1."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    return annotate(
        documents,
        "score double",
        lambda texts: [pa.array(shared.value.scores(texts), pa.float64())],
        keep,
        column,
        PIECE_BYTES,
    )


FOLDS, HELD_OUT = 3, 1


def quality_scores(
    documents: DataFrame,
    labels: DataFrame,
    keep: list[str] | None = None,
    column: str = "text",
) -> DataFrame:
    """``documents`` with ``held_out``, ``score`` and ``predicted``.

    The scored texts are in ``column``, which may be a field of a kept struct.
    """
    model = train(documents, labels, fold("doc_id", FOLDS) != HELD_OUT)
    return score(documents, model, keep, column).withColumns(
        {
            "held_out": F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)),
            "predicted": (F.col("score") >= 0.5).cast("int"),
        }
    )
