"""Near-duplicates by banded MinHash, with odd sketches to choose what is compared in full.

A document is the set of its distinct five-word shingles. Documents with the same set form a
class, and one of each class goes on. MinHash samples, four to a band, put classes into buckets;
sets with a similarity of 0.8 share none of 24 bands with probability 3e-6, of 0.85 with 2e-8. Buckets
with the same members are one.

In a bucket the pairs are not written out, and each pair is looked at in one of the buckets it
shares. A thousand MinHash samples of each set are folded into
a parity bitmap, the odd sketch; the population count of the XOR of two estimates their
similarity, with a deviation of 0.012 at 0.85. Pairs estimated below the limit less five
deviations are let go. Of the rest, the first round proposes the three nearest of each set. What
links is decided on the full sets of shingles, and the linked become components. Later rounds
propose pairs of different components only, the likeliest of each two components first, more
from round to round where a bucket has more, until none is left. So a group of thousands of
copies costs a few pairs each, and no likely link is dropped. Buckets over ``BLOCK`` members are
compared in blocks, each two of which are a task of their own.

Defined results: null and empty texts have the empty set and are linked with nothing; a text of
fewer than five words is one shingle; exact copies link. Rows with the same doc_id count as one
document in ``component_id`` and ``kept``, with whatever their texts link to. A null doc_id is
never smallest; a component of nothing else has a null ``component_id``, and its rows are kept.
Other columns are kept, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from stayline.llm.graph import components
from stayline.llm.words import BLANKS, annotate, mixed, window_hashes, words_of
from stayline.session import durable

SHINGLE = 5
ROWS, BANDS = 4, 24
SAMPLES, BITS = 1024, 2048
MARGIN = 0.06
BLOCK = 2048
NEAREST = 3
FOLDED = 256  # rows of samples folded at once: 4 MB of counts
LEAST_PERCENT = 80  # what the bands are made for
ROUNDS = 16, 64  # pairs of two components in the first later round, and growth from there

_SEEDS = np.random.default_rng(20240229).integers(0, 1 << 32, (SAMPLES, 2), dtype=np.uint32)
_FACTORS, _SHIFTS = _SEEDS[:, 0] | np.uint32(1), _SEEDS[:, 1]


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> list[np.ndarray]:
    """The distinct shingles of each text, as sorted 64-bit hashes."""
    words = words_of(texts, BLANKS, lower=True)
    hashes = words.hashes()
    shingles = window_hashes(hashes, size)
    out = []
    for a, b in zip(words.offsets[:-1].tolist(), words.offsets[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(shingles[a : b - size + 1]))
        else:
            own = hashes[a:b]
            out.append(window_hashes(own, b - a) + np.uint64(b - a) if b > a else own)
    return out


def min_hashes(sets: list[np.ndarray], n: int) -> np.ndarray:
    """The first ``n`` MinHash samples of each non-empty set."""
    sizes = [len(s) for s in sets]
    flat = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    at = np.cumsum([0, *sizes[:-1]])
    out = np.empty((len(sets), n), np.uint32)
    step = 1 << 16  # shingles that stay in the processor's cache; whole sets at a time
    cuts = [0]
    for d in range(1, len(sets)):
        if at[d] - at[cuts[-1]] >= step:
            cuts.append(d)
    for a, b in zip(cuts, [*cuts[1:], len(sets)], strict=True):
        part = flat[at[a] : at[b] if b < len(sets) else len(flat)]
        begin = at[a:b] - at[a]
        for k in range(n):
            out[a:b, k] = np.minimum.reduceat(part * _FACTORS[k] + _SHIFTS[k], begin)
    return out


def band_keys(samples: np.ndarray) -> np.ndarray:
    rows = samples.reshape(len(samples), -1, ROWS).astype(np.uint64)
    key = np.arange(1, rows.shape[1] + 1, dtype=np.uint64)[None, :].repeat(len(samples), axis=0)
    for k in range(ROWS):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, :, k])
    return key.view(np.int64)


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """A row of ``BITS`` parities for each row of samples, as bytes; ``FOLDED`` rows at a time."""
    n, k = samples.shape
    salt = np.arange(1, k + 1, dtype=np.uint64) << np.uint64(32)
    out = np.empty((n, BITS // 8), np.uint8)
    for a in range(0, n, FOLDED):
        place = mixed(samples[a : a + FOLDED].astype(np.uint64) | salt) % np.uint64(BITS)
        m = len(place)
        key = place.astype(np.int64) + BITS * np.arange(m)[:, None]
        odd = np.bincount(key.ravel(), minlength=m * BITS).reshape(m, BITS) & 1
        out[a : a + m] = np.packbits(odd.astype(bool), axis=1)
    return out


def estimates(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated similarities of all rows of ``a`` and ``b``, both sketches as 64-bit words."""
    out = np.empty((len(a), len(b)), np.float32)
    rows = max(1, (1 << 21) // max(1, b.size))
    for k in range(0, len(a), rows):
        differ = np.bitwise_count(a[k : k + rows, None, :] ^ b[None, :, :]).sum(-1, dtype=np.int32)
        rest = np.maximum(1 - 2 * differ / BITS, 1e-9)
        out[k : k + rows] = 1 + BITS / (4 * SAMPLES) * np.log(rest)
    return out


def _digests(sets: list[np.ndarray]) -> pa.Array:
    found = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
    return pa.array(found, pa.binary())


def _classes(texts: pa.Array) -> list[pa.Array]:
    sets = shingle_sets(texts)
    full = [s for s in sets if len(s)]
    keys = iter(band_keys(min_hashes(full, ROWS * BANDS)).tolist() if full else [])
    bands = [next(keys) if len(s) else None for s in sets]
    return [
        pa.array([len(s) for s in sets], pa.int64()),
        _digests(sets),
        pa.array(bands, pa.list_(pa.int64())),
    ]


def _sketches(texts: pa.Array) -> list[pa.Array]:
    sets = shingle_sets(texts)
    full = [s for s in sets if len(s)]
    rows = iter(odd_sketches(min_hashes(full, SAMPLES)) if full else [])
    return [
        _digests(sets),
        pa.array([next(rows).tobytes() if len(s) else None for s in sets], pa.binary()),
    ]


def _compare(table: pa.Table, limit: float, ranks: tuple[int, int] | None) -> pa.Table:
    """Pairs of a bucket (or of two blocks of one) to compare in full, with their rank."""
    rep, size, label, block = (
        table[c].to_numpy() for c in ("rep", "n_shingles", "label", "block")
    )
    sketch = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint64)
    sketch = sketch.reshape(len(rep), -1)
    low, high = table["i"][0].as_py(), table["j"][0].as_py()
    a, b = np.flatnonzero(block == low), np.flatnonzero(block == high)
    like = estimates(sketch[a], sketch[b])
    small = np.minimum(size[a][:, None], size[b][None, :])
    large = np.maximum(size[a][:, None], size[b][None, :])
    fit = (like >= limit - MARGIN) & (small >= limit * large - 1e-6)
    fit &= label[a][:, None] != label[b][None, :]
    if low == high:
        fit = np.triu(fit, 1)
    x, y = np.nonzero(fit)
    here = _owned(table, a[x], b[y])
    x, y = x[here], y[here]
    score = like[x, y]
    u, v = np.minimum(rep[a[x]], rep[b[y]]), np.maximum(rep[a[x]], rep[b[y]])
    if ranks is None:
        ends = np.concatenate([x, y if low == high else y + len(a)])
        near = _rank(ends, np.tile(score, 2), np.tile(u, 2), np.tile(v, 2)) < NEAREST
        stay = near[: len(x)] | near[len(x) :]
        rank = np.zeros(len(x), np.int64)
    else:
        of_u, of_v = label[a[x]], label[b[y]]
        pair = np.stack([np.minimum(of_u, of_v), np.maximum(of_u, of_v)], axis=1)
        _, group = np.unique(pair, axis=0, return_inverse=True)
        rank = _rank(group.ravel(), score, u, v)
        stay = (rank >= ranks[0]) & (rank < ranks[1])
    n = int(stay.sum())
    return pa.table(
        {
            "bucket": pa.array([table["bucket"][0].as_py()] * n, pa.int64()),
            "u": pa.array(u[stay], pa.int64()),
            "v": pa.array(v[stay], pa.int64()),
            "rank": pa.array(rank[stay], pa.int64()),
        }
    )


def _owned(table: pa.Table, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Whether this bucket is the first that both members of a pair are in."""
    bands = table["bands"].combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
    used = table["used"].to_numpy()[:, None] >> np.arange(BANDS) & 1
    bucket = table["bucket"][0].as_py()
    out = np.empty(len(u), bool)
    for k in range(0, len(u), 1 << 16):
        i, j = u[k : k + (1 << 16)], v[k : k + (1 << 16)]
        common = (bands[i] == bands[j]) & (used[i] == 1)
        out[k : k + len(i)] = bands[i, common.argmax(axis=1)] == bucket
    return out


def _rank(group: np.ndarray, score: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The place of each pair in its group, the highest score first."""
    order = np.lexsort((v, u, -score, group))
    ordered = group[order]
    first = np.searchsorted(ordered, ordered, side="left")
    out = np.empty(len(group), np.int64)
    out[order] = np.arange(len(group)) - first
    return out


def _proposals(
    members: DataFrame, sets: DataFrame, limit: float, ranks: tuple[int, int] | None
) -> DataFrame:
    """``members`` are (bucket, n, rep, label)."""
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    dealt = members.withColumn("block", F.pmod(F.xxhash64("rep"), blocks).cast("long"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), (blocks - 1).cast("long")))
    dealt = dealt.withColumn("other", other)
    of_set = sets.select("rep", "n_shingles", "sketch", "bands", "used")
    dealt = dealt.join(of_set, "rep").select(
        "bucket",
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
        "rep",
        "n_shingles",
        "label",
        "block",
        "sketch",
        "bands",
        "used",
    )
    return dealt.groupBy("bucket", "i", "j").applyInArrow(
        lambda table: _compare(table, limit, ranks), "bucket long, u long, v long, rank long"
    )


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs whose full sets are similar enough."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (shingle_sets(batch.column(c)) for c in ("text", "other"))
            good = []
            for a, b in zip(left, right, strict=True):
                common = len(np.intersect1d(a, b, assume_unique=True))
                good.append(100 * common >= percent * (len(a) + len(b) - common))
            yield batch.select(["u", "v"]).filter(pa.array(good, pa.bool_()))

    texts = sets.select("rep", "text")
    joined = pairs.join(texts.withColumnRenamed("rep", "u"), "u").join(
        texts.select(F.col("rep").alias("v"), F.col("text").alias("other")), "v"
    )
    return joined.select("u", "v", "text", "other").mapInArrow(confirm, "u long, v long")


def near_duplicates(
    df: DataFrame,
    keep: list[str] | None = None,
    percent: int = LEAST_PERCENT,
    column: str = "text",
) -> DataFrame:
    """``df`` with ``n_shingles``, ``component_id`` and ``kept``.

    ``keep`` names the columns to go on with, all of them if not given. Sets with ``percent`` of
    their union in common are linked. ``column`` may be a field of a kept struct.
    """
    if percent < LEAST_PERCENT:
        raise ValueError(f"{BANDS} bands of {ROWS} samples are made for {LEAST_PERCENT} % or more")
    kept = list(dict.fromkeys([*(df.columns if keep is None else keep), "doc_id"]))
    inner = F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row")
    fields = "n_shingles long, digest binary, bands array<long>"
    if column.split(".")[0] in kept:  # then the text is sent once, within its row
        rows, at = df.select(inner), f"row.{column}"
    else:
        rows, at = df.select(inner, F.col(column).alias("text")), "text"
    rows = durable(annotate(rows, fields, _classes, ["row"], at))
    classes = (
        rows.where("digest is not null")
        .groupBy("digest")
        .agg(
            F.min("row.doc_id").alias("doc"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("bands").alias("bands"),
        )
    )
    classes = durable(classes.select(F.monotonically_increasing_id().alias("rep"), "*"))
    linked = _link_classes(df, classes, percent)
    of_class = (
        classes.select("rep", "digest", "doc")
        .join(linked, classes["rep"] == linked["node"], "left")
        .select(F.coalesce("root", "rep").alias("root"), "digest", "doc")
    )
    least = of_class.groupBy("root").agg(F.min("doc").alias("component"))
    named = of_class.join(least, "root").select("digest", F.col("component").alias("_component"))
    out = rows.join(named, "digest", "left").select(
        "row",
        "n_shingles",
        F.when(F.col("digest").isNull(), F.col("row.doc_id"))
        .otherwise(F.col("_component"))
        .alias("component_id"),
    )
    new = {"n_shingles", "component_id", "kept"}
    return out.select(
        *[F.col(f"row.`{c}`") for c in kept if c not in new],
        "n_shingles",
        "component_id",
        F.col("row.doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def _link_classes(df: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Components (node, root) of classes that are linked with another one."""
    held = classes.select("rep", F.posexplode("bands").alias("band", "bucket"))
    mark = [F.bit_xor(F.xxhash64("rep", F.lit(k))).alias(f"mark{k}") for k in range(2)]
    buckets = held.groupBy("bucket").agg(F.count("*").alias("n"), *mark).where("n > 1")
    buckets = buckets.groupBy("n", "mark0", "mark1").agg(F.min("bucket").alias("bucket"))
    members = durable(held.join(buckets.select("bucket", "n"), "bucket"))
    wanted = classes.join(members.select("rep").distinct(), "rep").select("rep", "digest", "doc")
    source = df.select(F.col("doc_id").alias("_doc"), "text")
    found = source.join(wanted, source["_doc"].eqNullSafe(wanted["doc"]))
    found = found.select("rep", F.col("digest").alias("wanted"), "text")
    sets = annotate(found, "digest binary, sketch binary", _sketches)
    sets = sets.where("digest = wanted").dropDuplicates(["rep"])
    # Which of its bands have a bucket that counts: a pair is looked at in the first it shares.
    used = members.groupBy("rep").agg(F.bit_or(F.expr("shiftleft(1L, band)")).alias("used"))
    sets = sets.join(classes.select("rep", "n_shingles", "bands"), "rep").join(used, "rep")
    sets = durable(sets.drop("digest", "wanted"))

    limit = percent / 100
    alone = members.withColumn("label", F.col("rep"))
    proposed = _proposals(alone, sets, limit, None).select("u", "v").distinct()
    links = durable(_links(proposed, sets, percent))
    linked = durable(components(links))
    ranks, open_ = (0, ROUNDS[0]), members.where(F.col("n") > NEAREST + 1)
    while True:
        labelled = open_.join(
            linked.select(F.col("node").alias("rep"), "root"), "rep", "left"
        ).withColumn("label", F.coalesce("root", "rep"))
        mixed_ = labelled.groupBy("bucket").agg(
            F.min("label").alias("a"), F.max("label").alias("b")
        )
        labelled = labelled.join(mixed_.where("a <> b").select("bucket"), "bucket")
        labelled = labelled.select("bucket", "n", "rep", "label")
        proposed = durable(_proposals(labelled, sets, limit, ranks))
        if proposed.isEmpty():
            return linked
        more = durable(_links(proposed.select("u", "v").distinct(), sets, percent))
        if not more.isEmpty():
            links = links.union(more)
            linked = durable(components(links))
        # Where two components have more pairs than this round took, the next one goes on.
        full = proposed.where(F.col("rank") == ranks[1] - 1).select("bucket").distinct()
        open_ = durable(open_.join(full, "bucket"))
        if open_.isEmpty():
            return linked
        ranks = ranks[1], ranks[1] * ROUNDS[1]
