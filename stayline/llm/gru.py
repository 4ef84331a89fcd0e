"""Toxicity: a bidirectional gated recurrent network with attention over windows of words.

Each word enters as a vector: a learned vector of the word, the mean of learned vectors of its
character n-grams, and two fixed numbers, the log-count ratios of the word and of its most
telling character n-gram between the classes. Two gated recurrent layers read a window in either
direction, attention pools their states, and a linear unit gives the window's margin. Windows
overlap and cover the whole text; a text is as toxic as its worst window. Margins become
probabilities on labelled texts that the network didn't learn from.

Ratios are counted by text on the labelled sample. Where the network is trained (numpy, Adam) each
text is left out of the ratios it sees, as it will be with new texts. A toxic text teaches by its
worst window. The sample is at most ``SAMPLE`` rows of each class, taken in the order of a hash of the
doc_id. A text of more than ``TEXT_WORDS`` words teaches by runs of ``RUN`` words, chosen by hash from
all of it. All texts are scored, whole.

Defined results: a null or empty text has no window and gets the least margin seen in training;
without labels of both classes every score is the share of label 1 (0.5 without any label);
labels repeated for a doc_id count once, by their least value; rows without a label or doc_id
teach nothing. Equal texts get equal scores, whatever their other columns are.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from stayline.llm.nbsvm import calibrate, fold, held_back
from stayline.llm.words import Words, annotate, mixed, text_buffer, words_of
from stayline.session import durable

SAMPLE = 2000
TEXT_WORDS, RUN = 1536, 48
LENGTH, STRIDE = 24, 8
BUCKETS = 1 << 16  # of words, and of character n-grams
WIDTH = 6  # of learned vectors
HIDDEN = 8
GRAMS = (3, 5, 7)  # bytes, word ends included
EPOCHS, BATCH, RATE = 8, 64, 0.01
CHUNK = 2048  # windows that go through the network at once
SMOOTH = 1.0

FLOAT = np.float32


@dataclass
class Inputs:
    """Distinct words of a batch: their buckets and those of their character n-grams."""

    word: np.ndarray
    gram: np.ndarray  # flat
    begins: np.ndarray  # the first n-gram of each word


def inputs_of(vocabulary: pa.Array) -> Inputs:
    words = vocabulary.to_pylist()
    of = xxhash.xxh3_64_intdigest
    hashes = np.fromiter((of(w.lower()) for w in words), np.uint64, len(words))
    marked = pa.array([b"<" + w.lower() + b">" for w in words], pa.large_binary())
    data, at = text_buffer(marked)
    codes, grams, owners = data.astype(np.uint64) + np.uint64(1), [], []
    owner = np.repeat(np.arange(len(words), dtype=np.int32), np.diff(at))
    for n in GRAMS:
        m = max(0, len(codes) - n + 1)
        key = np.full(m, n, np.uint64)
        for k in range(n):
            key = key * np.uint64(1099511628211) + codes[k : k + m]
        whole = owner[:m] == owner[n - 1 :]
        grams.append((mixed(key) % np.uint64(BUCKETS)).astype(np.int32)[whole])
        owners.append(owner[:m][whole])
    gram, of_word = np.concatenate(grams), np.concatenate(owners)
    order = np.argsort(of_word, kind="stable")
    begins = np.searchsorted(of_word[order], np.arange(len(words)))
    return Inputs((hashes % np.uint64(BUCKETS)).astype(np.int32), gram[order], begins)


def windows_of(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, first word and length of all overlapping windows."""
    n = np.diff(offsets)
    per_doc = np.where(n == 0, 0, 1 + np.maximum(0, -(-(n - LENGTH) // STRIDE)))
    doc = np.repeat(np.arange(len(n)), per_doc)
    first = np.concatenate([[0], np.cumsum(per_doc)])[:-1]
    start = offsets[:-1][doc] + STRIDE * (np.arange(len(doc)) - first[doc])
    return doc, start, np.minimum(LENGTH, offsets[1:][doc] - start)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    x *= FLOAT(0.5)
    np.tanh(x, out=x)
    x += FLOAT(1)
    x *= FLOAT(0.5)
    return x


@dataclass
class Network:
    """Weights by name; ``least`` is the margin of a text without words."""

    weights: dict[str, np.ndarray]
    word_ratio: np.ndarray
    gram_ratio: np.ndarray
    least: float = -1.0
    slope: float = 0.0
    offset: float = 0.0
    share: dict = field(default_factory=dict)

    def vectors(self, inputs: Inputs, ratios: tuple | None = None) -> np.ndarray:
        """Of distinct words; ``ratios`` stand in for the network's own."""
        n = len(inputs.word)
        word_ratio, gram_ratio = ratios or (self.word_ratio, self.gram_ratio)
        out = np.empty((n, 2 * WIDTH + 2), FLOAT)
        if not n:
            return out
        size = np.diff(np.append(inputs.begins, len(inputs.gram)))
        out[:, :WIDTH] = self.weights["words"][inputs.word]
        sums = np.add.reduceat(self.weights["grams"][inputs.gram], inputs.begins, axis=0)
        out[:, WIDTH : 2 * WIDTH] = sums / size[:, None]
        out[:, -2] = word_ratio[inputs.word]
        out[:, -1] = np.maximum.reduceat(gram_ratio[inputs.gram], inputs.begins)
        return out

    def margins(self, table: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Of windows given as codes (windows, LENGTH) into a table of word vectors."""
        w = self.weights
        sides = [(table @ w[f"W{s}"] + w[f"b{s}"]).astype(FLOAT) for s in "fb"]
        out = np.empty(len(codes), FLOAT)
        for a in range(0, len(codes), CHUNK):
            part, size = codes[a : a + CHUNK], lengths[a : a + CHUNK]
            states = np.empty((LENGTH, len(part), 2 * HIDDEN), FLOAT)
            full = bool((size == LENGTH).all())
            for s, projected in enumerate(sides):
                u = w["U" + "fb"[s]]
                h = np.zeros((len(part), HIDDEN), FLOAT)
                for t in range(LENGTH) if s == 0 else range(LENGTH - 1, -1, -1):
                    x, g = projected[part[:, t]], h @ u
                    gates = _sigmoid(x[:, : 2 * HIDDEN] + g[:, : 2 * HIDDEN])
                    z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
                    c = np.tanh(x[:, 2 * HIDDEN :] + r * g[:, 2 * HIDDEN :])
                    new = c + z * (h - c)
                    h = new if full else np.where((t < size)[:, None], new, h)
                    states[t, :, s * HIDDEN : (s + 1) * HIDDEN] = h
            energy = states @ w["q"]
            energy[np.arange(LENGTH)[:, None] >= size[None, :]] = -1e9
            weight = np.exp(energy - energy.max(axis=0))
            weight /= weight.sum(axis=0)
            out[a : a + CHUNK] = np.einsum("tn,tn->n", weight, states @ w["o"]) + w["b"][0]
        return out

    def text_margins(self, words: Words) -> np.ndarray:
        doc, start, size = windows_of(words.offsets)
        worst = np.full(len(words.offsets) - 1, self.least, FLOAT)
        if len(doc):
            table = self.vectors(inputs_of(words.vocabulary))
            place = np.minimum(start[:, None] + np.arange(LENGTH), len(words.codes) - 1)
            found = self.margins(table, words.codes[place], size)
            first = np.flatnonzero(np.diff(doc, prepend=-1))
            worst[doc[first]] = np.maximum.reduceat(found, first)
        return worst

    def scores(self, texts: pa.Array) -> np.ndarray:
        margin = self.text_margins(words_of(texts)).astype(float)
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -30, 30)))


@dataclass
class Ratios:
    """Log-count ratios of the buckets of words or n-grams, from counts by text."""

    seen: np.ndarray  # (label, bucket): texts with the bucket
    texts: np.ndarray  # by label

    def without(self, label: int | None = None) -> np.ndarray:
        """As a text sees them; one of the counted texts, with this label, doesn't see itself."""
        seen, texts = self.seen.astype(float), self.texts.astype(float)
        if label is not None:
            seen[label] = np.maximum(seen[label] - 1, 0)
            texts[label] -= 1
        share = np.log((seen + SMOOTH) / (texts[:, None] + 2 * SMOOTH))
        return np.where(seen.sum(axis=0) > 0, share[1] - share[0], 0).astype(FLOAT)


def count_classes(words: Words, labels: np.ndarray) -> tuple[Ratios, Ratios]:
    """Ratios of word buckets and of n-gram buckets."""
    inputs = inputs_of(words.vocabulary)
    size = np.diff(np.append(inputs.begins, len(inputs.gram)))
    seen = [np.zeros(2 * BUCKETS, np.int64) for _ in range(2)]
    for d in range(len(labels)):
        code = np.unique(words.codes[words.offsets[d] : words.offsets[d + 1]])
        reps = size[code]
        at = np.repeat(inputs.begins[code] - np.cumsum(reps) + reps, reps)
        gram = inputs.gram[at + np.arange(reps.sum())]
        for total, bucket in zip(seen, (inputs.word[code], gram), strict=True):
            total[labels[d] * BUCKETS + np.unique(bucket).astype(np.int64)] += 1
    texts = np.bincount(labels, minlength=2)
    return Ratios(seen[0].reshape(2, -1), texts), Ratios(seen[1].reshape(2, -1), texts)


def new_network(word_ratio: np.ndarray, gram_ratio: np.ndarray) -> Network:
    rng = np.random.default_rng(11)
    d = 2 * WIDTH + 2

    def draw(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(FLOAT)

    weights = {"words": draw(BUCKETS, WIDTH, scale=0.02), "grams": draw(BUCKETS, WIDTH, scale=0.02)}
    for s in "fb":
        weights[f"W{s}"] = draw(d, 3 * HIDDEN, scale=0.3)
        weights[f"U{s}"] = draw(HIDDEN, 3 * HIDDEN, scale=0.3)
        weights[f"b{s}"] = np.zeros(3 * HIDDEN, FLOAT)
    weights |= {"q": draw(2 * HIDDEN, scale=0.3), "o": draw(2 * HIDDEN, scale=0.3)}
    weights["b"] = np.zeros(1, FLOAT)
    return Network(weights, word_ratio, gram_ratio)


def gradients(
    net: Network, x: np.ndarray, size: np.ndarray, labels: np.ndarray
) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Of the mean log loss of windows ``x`` (n, LENGTH, inputs); also with respect to ``x``."""
    w, n = net.weights, len(x)
    states = np.zeros((LENGTH, n, 2 * HIDDEN), FLOAT)
    kept: dict[str, list] = {"f": [None] * LENGTH, "b": [None] * LENGTH}
    here = np.arange(LENGTH)[:, None] < size[None, :]
    for s, name in enumerate("fb"):
        h = np.zeros((n, HIDDEN), FLOAT)
        for t in range(LENGTH) if s == 0 else range(LENGTH - 1, -1, -1):
            p, g = x[:, t] @ w["W" + name] + w["b" + name], h @ w["U" + name]
            gates = _sigmoid(p[:, : 2 * HIDDEN] + g[:, : 2 * HIDDEN])
            z, r, gc = gates[:, :HIDDEN], gates[:, HIDDEN:], g[:, 2 * HIDDEN :]
            c = np.tanh(p[:, 2 * HIDDEN :] + r * gc)
            m = here[t][:, None]
            new = np.where(m, c + z * (h - c), h)
            kept[name][t] = (h, z, r, gc, c, m)
            h = new
            states[t, :, s * HIDDEN : (s + 1) * HIDDEN] = h
    energy = np.where(here, states @ w["q"], FLOAT(-1e9))
    weight = np.exp(energy - energy.max(axis=0))
    weight /= weight.sum(axis=0)
    value = states @ w["o"]
    margin = (weight * value).sum(axis=0) + w["b"][0]
    slope = ((1 / (1 + np.exp(-margin)) - labels) / n).astype(FLOAT)
    pooled = (weight[:, :, None] * states).sum(axis=0)
    out = {"b": np.array([slope.sum()], FLOAT), "o": slope @ pooled}
    by_energy = weight * (value - (weight * value).sum(axis=0)) * slope
    out["q"] = np.einsum("tn,tnh->h", by_energy, states)
    by_state = (weight * slope)[:, :, None] * w["o"] + by_energy[:, :, None] * w["q"]
    by_x = np.zeros_like(x)
    for s, name in enumerate("fb"):
        big_w, u = w["W" + name], w["U" + name]
        dw, du, db = np.zeros_like(big_w), np.zeros_like(u), np.zeros(3 * HIDDEN, FLOAT)
        dh = np.zeros((n, HIDDEN), FLOAT)
        for t in range(LENGTH - 1, -1, -1) if s == 0 else range(LENGTH):
            h, z, r, gc, c, m = kept[name][t]
            dh = dh + by_state[t, :, s * HIDDEN : (s + 1) * HIDDEN]
            d = np.where(m, dh, 0)
            dc = d * (1 - z) * (1 - c * c)
            dz = d * (h - c) * z * (1 - z)
            dr = dc * gc * r * (1 - r)
            dp = np.concatenate([dz, dr, dc], axis=1)
            dg = np.concatenate([dz, dr, dc * r], axis=1)
            dw += x[:, t].T @ dp
            du += h.T @ dg
            db += dp.sum(axis=0)
            by_x[:, t] += dp @ big_w.T
            dh = np.where(m, d * z, dh) + dg @ u.T
        out |= {"W" + name: dw, "U" + name: du, "b" + name: db}
    return out, by_x


def fit(texts: pa.Array, labels: np.ndarray, shares: dict[int, int] | None = None) -> Network:
    """A network of labelled texts; ``shares`` are the true sizes of the classes."""
    labels = np.asarray(labels, np.int64)
    check = held_back(labels, 6)
    if any(len(set(labels[p].tolist())) < 2 for p in (~check, check)):
        share = float(labels.mean()) if len(labels) else 0.5
        if shares and sum(shares.values()):
            share = shares[1] / sum(shares.values())
        share = min(max(share, 1e-6), 1 - 1e-6)
        zero = np.zeros(BUCKETS, FLOAT)
        return _constant(new_network(zero, zero), share)
    learn = words_of(texts.filter(pa.array(~check)))
    counted = count_classes(learn, labels[~check])
    net = new_network(*(r.without() for r in counted))
    _train(net, learn, labels[~check], [tuple(r.without(k) for r in counted) for k in (0, 1)])
    y = labels[check]
    margin = net.text_margins(words_of(texts.filter(pa.array(check)))).astype(float)
    net.least = float(margin.min())
    weight = np.ones(len(y))
    if shares:
        for label in (0, 1):
            weight[y == label] = shares[label] / max(1, int((labels == label).sum()))
        weight *= len(y) / weight.sum()
    net.slope, net.offset = calibrate(margin, y, weight)
    return net


def _constant(net: Network, share: float) -> Network:
    net.slope, net.offset = 0.0, float(np.log(share / (1 - share)))
    return net


def _train(net: Network, words: Words, labels: np.ndarray, ratios: list[tuple]) -> None:
    """``ratios`` are what texts of label 0 and of label 1 see."""
    doc, start, size = windows_of(words.offsets)
    codes = words.codes[np.minimum(start[:, None] + np.arange(LENGTH), len(words.codes) - 1)]
    inputs = inputs_of(words.vocabulary)
    grams_in = np.diff(np.append(inputs.begins, len(inputs.gram)))
    rng = np.random.default_rng(5)
    first = np.flatnonzero(np.diff(doc, prepend=-1))
    many = np.diff(np.append(first, len(doc)))
    small = {k: v for k, v in net.weights.items() if k not in ("words", "grams")}
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in small.items()}
    squares = {k: np.full(BUCKETS, 1e-4, FLOAT) for k in ("words", "grams")}
    step = 0
    for epoch in range(EPOCHS):
        rank = np.empty(len(doc), FLOAT)
        for label in (0, 1):
            own = labels[doc] == label
            table = net.vectors(inputs, ratios[label])
            if epoch:
                rank[own] = net.margins(table, codes[own], size[own])
            else:  # before anything is learned, the ratios tell the worst window
                rank[own] = np.maximum(table[:, -2], table[:, -1])[codes[own]].max(axis=1)
        order = np.lexsort((-rank, doc))
        worst = order[first]
        other = first + (rng.random(len(first)) * many).astype(np.int64)
        other = other[labels[doc[first]] == 0]
        chosen = rng.permutation(np.concatenate([worst, other]))
        for k in range(0, len(chosen), BATCH):
            pick = chosen[k : k + BATCH]
            # Vectors of the batch's words, from the weights as they are now.
            used, where = np.unique(codes[pick], return_inverse=True)
            reps = grams_in[used]
            at = np.repeat(inputs.begins[used] - np.cumsum(reps) + reps, reps)
            gram = inputs.gram[at + np.arange(reps.sum())]
            part = Inputs(inputs.word[used], gram, np.cumsum(reps) - reps)
            where = where.reshape(len(pick), LENGTH)
            y = labels[doc[pick]]
            seen = [net.vectors(part, ratios[label])[where] for label in (0, 1)]
            x = np.where((y == 1)[:, None, None], seen[1], seen[0])
            slopes, by_x = gradients(net, x, size[pick], y)
            step += 1
            for name, g in slopes.items():
                m, v = moments[name]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                rate = RATE * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                net.weights[name] -= (rate * m / (np.sqrt(v) + 1e-8)).astype(FLOAT)
            by_word = np.zeros((len(used), x.shape[2]), FLOAT)
            np.add.at(by_word, where.ravel(), by_x.reshape(-1, x.shape[2]))
            shared = by_word[:, WIDTH : 2 * WIDTH] / reps[:, None]
            for name, bucket, g in (
                ("words", part.word, by_word[:, :WIDTH]),
                ("grams", gram, np.repeat(shared, reps, axis=0)),
            ):
                np.add.at(squares[name], bucket, (g * g).mean(axis=1))
                scaled = RATE * g / np.sqrt(squares[name][bucket])[:, None]
                np.add.at(net.weights[name], bucket, -scaled.astype(FLOAT))


def training_texts(
    documents: DataFrame, labels: DataFrame, use: Column, sample: int
) -> tuple[pa.Table, dict[int, int]]:
    """(label, text) of at most ``sample`` rows of each class, and the sizes of the classes."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & use)
    once = known.groupBy("doc_id").agg(F.min("toxic").cast("int").alias("label"))
    once = once.select("doc_id", "label", F.xxhash64("doc_id").alias("order"))
    shares = {r[0]: r[1] for r in once.groupBy("label").count().collect()}
    parts = [once.where(F.col("label") == k).orderBy("order", "doc_id").limit(sample) for k in (0, 1)]
    chosen = durable(parts[0].union(parts[1]))  # at most two samples of ids
    found = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    # Texts are bounded each before they meet.
    found = annotate(found, "excerpt string", lambda t: [excerpts(t)], ["label", "order"])
    order = ["order", F.xxhash64("excerpt"), "label"]
    table = found.orderBy(*order).limit(2 * sample).toArrow().select(["label", "excerpt"])
    return table, {k: shares.get(k, 0) for k in (0, 1)}


def excerpts(texts: pa.Array) -> pa.Array:
    """Texts of up to ``TEXT_WORDS`` words as they are, of others runs of words from all over."""
    words = words_of(texts)
    out = texts.to_pylist()
    for d in np.flatnonzero(np.diff(words.offsets) > TEXT_WORDS).tolist():
        a, b = int(words.offsets[d]), int(words.offsets[d + 1])
        first = np.arange(a, b, RUN)
        rank = mixed(np.arange(1, len(first) + 1, dtype=np.uint64) * np.uint64(b - a))
        keep = np.sort(np.argsort(rank, kind="stable")[: TEXT_WORDS // RUN])
        runs = [(words.starts[f], words.ends[min(f + RUN, b) - 1]) for f in first[keep]]
        out[d] = b"\n".join(words.data[x:y].tobytes() for x, y in runs).decode()
    return pa.array(out, pa.string())


FOLDS, HELD_OUT = 4, 2


def train(
    documents: DataFrame, labels: DataFrame, use: Column, sample: int = SAMPLE
) -> Network:
    table, shares = training_texts(documents, labels, use, sample)
    texts = table["excerpt"].combine_chunks()
    texts = texts.chunk(0) if isinstance(texts, pa.ChunkedArray) else texts
    return fit(texts, table["label"].to_numpy(), shares)


def toxicity_scores(
    documents: DataFrame, labels: DataFrame, keep: list[str] | None = None
) -> DataFrame:
    """``documents`` with ``held_out``, ``score`` and ``predicted``."""
    net = train(documents, labels, fold("doc_id", FOLDS) != HELD_OUT)
    shared = documents.sparkSession.sparkContext.broadcast(net)
    scored = annotate(
        documents,
        "score double",
        lambda texts: [pa.array(shared.value.scores(texts), pa.float64())],
        keep,
    )
    return scored.withColumns(
        {
            "held_out": F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)),
            "predicted": (F.col("score") >= 0.3).cast("int"),
        }
    )
