"""Suffix families, variable-length grams and the threshold algorithm against brute force."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stayline.llm import centroids, suffixes, variants
from stayline.llm.queries import QUERIES
from tests.llm import data


def seen_before(rows: list[tuple], length: int) -> list[tuple]:
    """doc_id, bytes, removed bytes, spans and digest of what is left."""
    first: dict[bytes, int] = {}
    for doc, text in rows:
        raw = (text or "").encode()
        for k in range(len(raw) - length + 1 if doc is not None else 0):
            part = raw[k : k + length]
            first[part] = min(doc, first.get(part, doc))
    out = []
    for doc, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - length + 1 if doc is not None else 0):
            if first[raw[k : k + length]] < doc:
                gone[k : k + length] = b"\1" * length
        spans = len(re.findall(b"\1+", bytes(gone)))
        left = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        out.append((doc, len(raw), sum(gone), spans, data.sha(left)))
    return sorted(out, key=repr)


def removed(df, **options) -> list[tuple]:
    found = suffixes.remove_seen(df, **options).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256)
    )
    return sorted((tuple(r) for r in found.collect()), key=repr)


def test_suffix_family_on_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{data.SF}/documents.parquet").select("doc_id", "text").collect()]
    found = [tuple(r) for r in QUERIES["op11_suffix_family"](spark, data.SF).collect()]
    assert sorted(found, key=repr) == seen_before(rows, 50)


@pytest.mark.parametrize("options", [{}, {"shard_bytes": 2000, "part_bytes": 500}, {"length": 20}])
def test_suffix_family_on_awkward_rows(spark, options):
    docs = data.awkward(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = suffixes.remove_seen(docs)
    assert set(docs.columns) <= set(found.columns) and found.count() == len(rows)
    assert removed(docs, **options) == seen_before(rows, options.get("length", 50))
    assert removed(data.no_rows(spark)) == []


def test_suffix_family_levels():
    """Levels hold powers of two of batches, and each suffix its least doc_id."""
    rng = np.random.default_rng(3)
    family, first = suffixes.Family(), {}
    for batch in range(11):
        words = np.array([b"%03d" % x for x in rng.integers(0, 400, 100)], "S3")
        docs = np.sort(rng.integers(10 * batch, 10 * batch + 10, 100))
        for w, d in zip(words.tolist(), docs.tolist(), strict=True):
            first[w] = min(d, first.get(w, d))
        found = family.add(words, docs)
        assert found.tolist() == [first[w] < d for w, d in zip(words.tolist(), docs.tolist(), strict=True)]
        held = [n for n, _, _ in family.levels]
        assert sum(held) == batch + 1 and held == sorted(set(held), reverse=True)
        assert all(n & (n - 1) == 0 for n in held)


def test_anchors_are_the_same_everywhere():
    """Each string of 50 bytes has one anchor, at the same place wherever the string is."""
    rng = np.random.default_rng(5)
    x = rng.integers(0, 50, 4000).astype(np.uint64)
    found = suffixes.sliding_argmin(x, 35)
    assert found.tolist() == [k + int(x[k : k + 35].argmin()) for k in range(len(x) - 34)]
    assert suffixes.gram_hashes(np.arange(10, dtype=np.uint8), 16).size == 0


def borrowed(length: int) -> list[tuple]:
    """Random documents with strings of others, of ``length`` bytes or one less, at both ends, too."""
    rng = np.random.default_rng(11)
    texts = []
    for k in range(60):
        parts = ["".join(rng.choice(list("abcdefgh"), int(rng.integers(0, 90))))]
        for n in rng.choice([length, length, length - 1, 2 * length], int(rng.integers(0, 5))):
            old = texts[rng.integers(len(texts))] if texts else ""
            at = int(rng.integers(0, max(1, len(old) - n)))
            parts += [old[at : at + n], "".join(rng.choice(list("abcdefgh"), int(rng.integers(0, 40))))]
        texts.append("".join(parts))
    texts += [texts[7], texts[9] + "x", "ab" * length, "ab" * length + "a", "a" * (3 * length)]
    order = rng.permutation(len(texts))
    return [(int(i), texts[i]) for i in order]


def through_parts(rows, length, n_shards, blocks, parts, **options) -> tuple[list[tuple], pa.Table]:
    """What ``remove_seen`` does, without Spark: the result, and what shards sent to parts."""

    def group(tables, by):
        table = pa.concat_tables(tables)
        names = table[by].to_numpy()
        return {k: table.filter(pa.array(names == k)) for k in np.unique(names).tolist()}

    dealt = [sorted(rows[k::n_shards]) for k in range(n_shards)]
    shards = [
        suffixes.Anchors(pa.array([t for _, t in own]), np.ma.masked_array([d for d, _ in own]), length)
        for own in dealt
    ]
    halves = [suffixes._sent_halves(k, a.halves(blocks)) for k, a in enumerate(shards)]
    known = group([suffixes._shared_halves(t) for t in group(halves, "block").values()], "shard")
    entries = [
        a.entries(dict(zip(known[k]["block"].to_pylist(), known[k]["bits"].to_pylist())), blocks, parts)
        for k, a in enumerate(shards)
    ]
    sent = [e.table(k) for k, e in enumerate(entries)]
    marked = [suffixes.mark(t, length, **options) for t in group(sent, "part").values()]
    marks = group(marked, "shard") if marked else {}
    out = []
    for k, (own, e) in enumerate(zip(dealt, entries, strict=True)):
        bits = marks.get(k, pa.table({"part": [], "marks": []}))
        covered = e.covered(dict(zip(bits["part"].to_pylist(), bits["marks"].to_pylist())))
        made = suffixes._left(pa.array([t for _, t in own]), e.anchors, covered)
        out += [(d, *r[:3], data.sha(r[3])) for (d, _), *r in zip(own, *map(pa.Array.to_pylist, made))]
    return sorted(out, key=repr), pa.concat_tables(sent)


@pytest.mark.parametrize("length", [1, 5, 8, 16, 17, 20, 33, 50, 300])
def test_suffix_family_of_borrowed_strings(length):
    """Strings are found wherever their anchor is, in several families and batches."""
    rows = borrowed(length)
    for options in ({}, {"batch": 64, "family": 200}):
        assert through_parts(rows, length, 7, 3, 5, **options)[0] == seen_before(rows, length)


def test_suffix_family_in_spark_of_borrowed_strings(spark):
    rows = borrowed(50)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for options in ({}, {"shard_bytes": 300, "part_bytes": 500}):
        assert removed(docs, **options) == seen_before(rows, 50)


def test_grams_in_common_alone_send_nothing():
    """Phrases of a few words are in many documents of a large corpus; no string of them is."""
    rng = np.random.default_rng(2)
    phrases = ["".join(rng.choice(list("abcdefgh"), 24)) for _ in range(5)]
    rows = []
    for k in range(200):
        between = ["".join(rng.choice(list("ijklmnop"), 40)) for _ in range(20)]
        rows.append((k, "".join(x + phrases[j % 5] for j, x in enumerate(between))))
    found, sent = through_parts(rows, 50, 4, 2, 2)
    assert found == seen_before(rows, 50) and len(sent) == 0


def test_whole_contexts_enter_no_family(monkeypatch):
    """Copies are marked by their contexts, which have no other to meet."""
    rng = np.random.default_rng(4)
    text = "".join(rng.choice(list("abcdefgh"), 5000))
    rows = [(k, text) for k in range(9)]

    def add(self, strings, docs):
        raise AssertionError(f"{len(strings)} strings in a family")

    monkeypatch.setattr(suffixes.Family, "add", add)
    found, sent = through_parts(rows, 50, 3, 2, 2)
    assert found == seen_before(rows, 50) and len(sent) > 0


def test_contexts_are_sent_compressed():
    """What neighbours share isn't stored for each: a text sent whole takes less than its contexts."""
    rng = np.random.default_rng(8)
    text = "".join(rng.choice(list("abcdefgh"), 200_000))
    found, sent = through_parts([(0, text), (1, text)], 50, 2, 1, 1)
    assert found == seen_before([(0, text), (1, text)], 50)
    strings = sum(sum(map(int, b)) for b in sent["strings"].to_pylist())
    assert strings > 1.9 * len(text)
    assert sum(map(len, sent["contexts"].to_pylist())) < 0.5 * 66 / 17 * strings


def test_scans_of_a_family_follow_its_batches(monkeypatch):
    """What scans and merges go over grows with a logarithm of the family, not with its square."""
    rng = np.random.default_rng(6)
    over, merge_order = [], suffixes._merge_order

    def counted(a, b):
        over.append(len(a) + len(b))
        return merge_order(a, b)

    monkeypatch.setattr(suffixes, "_merge_order", counted)
    words = np.array([b"%06d" % x for x in rng.integers(0, 200_000, 256 * 100)], "S6")
    docs, family, first = np.arange(len(words)) // 10, suffixes.Family(), {}
    for at in range(0, len(words), 100):
        own, of = words[at : at + 100], docs[at : at + 100]
        for w, d in zip(own.tolist(), of.tolist(), strict=True):
            first.setdefault(w, d)
        found = family.add(own, of).tolist()
        assert found == [first[w] < d for w, d in zip(own.tolist(), of.tolist(), strict=True)]
    assert sum(over) < 30 * len(words)


def spelled(rows: list[tuple]) -> list[tuple]:
    """word, form, root, n, near words and n of the form, by all pairs."""
    total: Counter = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = data.lower(run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if h % 31 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            total[word] += 1
    n = {w: c for w, c in total.items() if len(w) >= 7 and c >= 2}
    near = {a: [b for b in n if apart(a, b)] for a in n}
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda x: (-n[x], x))
            if n[best] >= 10 * n[w]:
                form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        f = form.get(w)
        out.append((w, f, root, n[w], len(near[w]), n.get(f)))
    return sorted(out, key=repr)


def apart(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) - len(a) == 1 and any(a == b[:k] + b[k + 1 :] for k in range(len(b)))


def variant_rows(spark) -> list[tuple]:
    rng = np.random.default_rng(8)
    base = ["".join(rng.choice(list("abcdeé"), 9)) for _ in range(40)]
    text = []
    for w in base:
        text += [w] * 220 + [w[:4] + "x" + w[4:]] * 21 + [w[:4] + "xy" + w[4:]] * 2
        text += [w[1:], w[:3] + "z" + w[4:], w[:-1] + "ÿ"] * 2 + [w.upper()]
    text += ["a" * 60, "a" * 61, "a" * 61, "a" * 60, "abababab", "babababa", "abababa", "ababababa"] * 3
    return [(1, " ".join(text)), (None, " ".join(text[:500])), (1, None), (2, ""), (1, "x y")]


@pytest.mark.parametrize("share", [variants.SHARE, 0.05])
def test_spelling_variants(spark, share):
    rows = variant_rows(spark)
    docs = spark.createDataFrame([(*r, "n", 3) for r in rows], "doc_id long, text string, word string, n long")
    found = variants.spelling_variants(docs, share)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == spelled(rows)
    assert any(r[1] != r[2] and r[1] for r in spelled(rows))  # a form of a form
    assert variants.spelling_variants(docs.limit(0)).count() == 0


def test_spelling_variants_of_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{data.SF}/documents.parquet").select("doc_id", "text").collect()]
    found = QUERIES["op12_spelling_variants"](spark, data.SF)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == spelled(rows)


def test_affected_grams_bound_every_edit():
    """No edit takes more grams from a word than its bound says."""
    rng = np.random.default_rng(2)
    letters = "abc"
    words = ["".join(rng.choice(list(letters), rng.integers(7, 11))) for _ in range(60)]
    places = Counter(w[k : k + q] for w in words for q in (2, 3) for k in range(len(w) - q + 1))
    kept = {g: n for g, n in places.items() if len(g) == 2 or hash(g[:2]) % 2}
    grams = variants.Grams(kept)

    def bag(word: str) -> Counter:
        return Counter(word[p:e] for p, e in grams.spans(word))

    for w in words:
        bound = grams.affected(w, grams.spans(w))
        edits = {w[:k] + w[k + 1 :] for k in range(len(w))}
        edits |= {w[:k] + c + w[k:] for k in range(len(w) + 1) for c in letters}
        edits |= {w[:k] + c + w[k + 1 :] for k in range(len(w)) for c in letters}
        for e in edits:
            assert sum((bag(w) - bag(e)).values()) <= bound
    # Words that could be near meet in a list, in the same block of it.
    names = {w: {n for n, _, _ in grams.keys(w)} for w in words}
    for a in words:
        for b in words:
            if apart(a, b):
                assert names[a] & names[b]


def test_threshold_algorithm():
    rng = np.random.default_rng(1)
    for k, d, spread in ((7, 5, 4), (40, 64, 100), (1, 3, 2), (12, 64, 1)):
        c, x = rng.integers(-spread, spread + 1, (k, d)), rng.integers(-spread, spread + 1, (300, d))
        number, distance = centroids.Walk(c).nearest(x)
        full = ((x[:, None] - c[None]) ** 2).sum(-1)
        assert (number == full.argmin(1)).all() and (distance == full.min(1)).all()


def test_centroids_of_awkward_rows(spark):
    ok = [0.25, -0.1]
    rows = [
        (1, ok), (1, ok), (2, [0.5, 0.5]), (None, [1.0, 2.0]), (3, None), (4, [0.1]),
        (5, [0.1, None]), (6, [float("nan"), 0.0]), (7, [float("inf"), 0.0]), (8, [1e30, 0.0]), (9, []),
    ]
    df = spark.createDataFrame([(*r, "c") for r in rows], "vec_id long, embedding array<double>, cluster string")
    found = centroids.cluster(df, dimensions=2, number=2, rounds=3)
    got = found.collect()
    assert sorted((r.vec_id is None, r.vec_id or 0) for r in got) == [(False, 1), (False, 1), (False, 2), (True, 0)]
    assert {r.inertia for r in got} == {sum(r.distance for r in got)}
    alone = centroids.cluster(df, dimensions=2, number=40).collect()
    assert {r.distance for r in alone} == {0}
    assert centroids.cluster(df.limit(0), dimensions=2).count() == 0
    assert centroids.cluster(df, dimensions=5).count() == 0
