"""Awkward rows: each operator and stage has a defined result for them."""

from __future__ import annotations

import itertools

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from stayline.llm import (
    bytepairs,
    contamination,
    divergence,
    gru,
    licences,
    nbsvm,
    oddsketch,
    passages,
    replies,
    tokenfile,
)
from stayline.llm.queries import LIBRARY_TOKENIZER, RANKS
from stayline.llm.words import places_of
from tests.llm import data


@pytest.fixture(scope="module")
def docs(spark):
    return data.awkward(spark).cache()


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, i % 2, 1 - i % 2) for i in range(8)] + [(None, 1, 1), (3, None, None), (4, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def pairs(df, *columns):
    """Rows as (text, columns), in order."""
    return sorted((tuple(r) for r in df.select("text", *columns).collect()), key=repr)


def test_divergence(spark, docs):
    found = divergence.quality_rules(docs)
    assert found.count() == docs.count()
    rows = found.where("doc_id is not null and doc_id not in (3, 7)").collect()
    for r in rows:
        text = data.texts()[r.doc_id]
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert got == data.counts(text)
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
    assert divergence.quality_rules(data.no_rows(spark)).count() == 0


def test_distances():
    p = np.array([[0.5, 0.5, 0], [0, 0, 1]])
    found = divergence.js_distance(p, p)
    assert np.allclose(found, [[0, 1], [1, 0]])


@pytest.mark.parametrize("scores", [nbsvm.quality_scores, gru.toxicity_scores])
def test_classifiers(spark, docs, labels, scores):
    found = scores(docs, labels)
    rows = found.collect()
    assert len(rows) == docs.count() and set(docs.columns) <= set(found.columns)
    by_text = {}
    for r in rows:
        assert 0 <= r.score <= 1
        assert by_text.setdefault(r.text, r.score) == r.score
    assert by_text[None] == by_text[""]
    assert scores(data.no_rows(spark), labels).count() == 0
    unlabelled = scores(docs, labels.limit(0)).select("score").distinct().collect()
    assert [round(r.score, 6) for r in unlabelled] == [0.5]


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates(spark, docs, percent):
    found = oddsketch.near_duplicates(docs, percent=percent)
    assert found.count() == docs.count()
    rows = docs.select("doc_id", "text").collect()
    tops = data.linked([data.shingles(r.text) for r in rows], percent)
    least = {}
    for r, top in zip(rows, tops, strict=True):
        ids = [x for x in (least.get(top), r.doc_id) if x is not None]
        least[top] = min(ids) if ids else None
    wanted = sorted(
        ((r.text, r.doc_id, least[t], r.doc_id == least[t]) for r, t in zip(rows, tops, strict=True)),
        key=repr,
    )
    assert pairs(found, "doc_id", "component_id", "kept") == wanted
    assert oddsketch.near_duplicates(data.no_rows(spark)).count() == 0
    with pytest.raises(ValueError):
        oddsketch.near_duplicates(docs, percent=79)


def test_sketches_of_many_short_texts():
    """Memory for each row is bounded: rows are folded a few at a time, pieces have few rows."""
    import tracemalloc

    import pyarrow as pa

    from stayline.llm import words

    rows = pa.array([f"a b c d e{i}" for i in range(10_000)])
    batch = pa.RecordBatch.from_arrays([rows], ["text"])
    tracemalloc.start()
    found = [oddsketch._sketches(p.column("text"))[1] for p in words.pieces(batch, "text")]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(map(len, found)) == 10_000 and max(map(len, found)) <= words.BATCH_ROWS
    assert peak < 64 << 20


def test_batches_of_the_pipeline_are_bounded(spark, docs, labels, tmp_path):
    """No stage has Spark hand over more at once than about a piece; a setting of one's own stays."""
    from stayline.llm import words

    rows, size = (
        f"spark.sql.execution.arrow.{name}" for name in ("maxRecordsPerBatch", "maxBytesPerBatch")
    )

    def batches(n, length):
        """Rows and bytes of text of the batches of one partition."""

        def measure(found):
            for b in found:
                text = b.column("text").cast(pa.large_binary())
                n_bytes = sum(len(t) for t in text.to_pylist())
                out = [pa.array([v], pa.int64()) for v in (b.num_rows, n_bytes)]
                yield pa.RecordBatch.from_arrays(out, ["n", "size"])

        table = spark.range(n).select(F.expr(f"repeat('x', {length})").alias("text")).coalesce(1)
        return [tuple(r) for r in table.mapInArrow(measure, "n long, size long").collect()]

    labels.write.parquet(f"{tmp_path}/labels.parquet")
    items = spark.createDataFrame([("a", "one two three")], "item_id string, text string")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = {k: spark.conf.getAll[k] for k in (rows, size) if k in spark.conf.getAll}
    try:
        for _, stage in corpus_pipeline.STAGES:
            for k in (rows, size):
                spark.conf.unset(k)
            stage(spark, docs, str(tmp_path))
            short, long = batches(10_000, 1), batches(100, 500_000)
            assert sum(n for n, _ in short) == 10_000 and sum(n for n, _ in long) == 100
            assert max(n for n, _ in short) <= words.BATCH_ROWS
            assert max(size for _, size in long) <= words.BATCH_BYTES + 500_000
        spark.conf.set(rows, "300")
        corpus_pipeline.tokens(spark, docs, str(tmp_path))
        assert spark.conf.get(rows) == "300"
        assert max(n for n, _ in batches(10_000, 1)) == 300
    finally:
        for k in (rows, size):
            spark.conf.unset(k)
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_pieces_of_token_ids(spark, monkeypatch):
    """Texts are encoded in pieces that bound what arrays of their pre-tokens take."""
    import tracemalloc

    from stayline.llm import words

    given = {}

    def record(df, fields, f, keep=None, column="text", size=words.BATCH_BYTES):
        given.update(f=f, size=size)

    monkeypatch.setattr(bytepairs, "annotate", record)
    bytepairs.encode(data.no_rows(spark), RANKS)
    text = " ".join(f"w{i % 997} and" for i in range(600))
    batch = pa.RecordBatch.from_arrays([pa.array([text] * 1_700)], ["text"])
    assert batch.nbytes > 8 << 20
    given["f"](batch.column("text").slice(0, 1))  # what is made once
    tracemalloc.start()
    found = [given["f"](p.column("text"))[0] for p in words.pieces(batch, "text", given["size"])]
    peak = tracemalloc.get_traced_memory()[1] - sum(f.nbytes for f in found)
    tracemalloc.stop()
    assert {f[0] for f in found} == {found[0][0]} and sum(map(len, found)) == 1_700
    assert peak < 40 << 20


def test_chain_of_near_copies_in_blocks(spark, monkeypatch):
    """A chain links end to end, whatever the blocks and the number of pairs in a round."""
    monkeypatch.setattr(oddsketch, "BLOCK", 4)
    monkeypatch.setattr(oddsketch, "NEAREST", 1)
    monkeypatch.setattr(oddsketch, "ROUNDS", (1, 2))
    rng = np.random.default_rng(3)
    rows, words = [], [f"w{i}" for i in rng.integers(0, 900, 120)]
    for i in range(40):
        rows.append((i, " ".join(words)))
        words = list(words)
        words[int(rng.integers(0, 120))] = f"new{i}"
    df = spark.createDataFrame(rows, "doc_id long, text string")
    tops = data.linked([data.shingles(t) for _, t in rows])
    linked = oddsketch.near_duplicates(df, percent=85)
    found = {r.doc_id: r.component_id for r in linked.collect()}
    assert found == dict(enumerate(tops))


def test_one_huge_text_does_not_empty_the_sample(spark):
    """Labelled texts that are very long add what a text may add; the model still learns."""
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(rng.choice(words, 60)) + " bad" * (i % 2), i % 2) for i in range(1, 240)]
    rows.append((0, " ".join(rng.choice(words, 400_000)), 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, y int")
    labels = docs.selectExpr("doc_id", "y AS quality", "y AS toxic")
    for scores in (nbsvm.quality_scores, gru.toxicity_scores):
        found = scores(docs, labels, ["doc_id", "y"]).collect()
        right = sum((r.score >= 0.5) == (r.y == 1) for r in found)
        assert right >= 0.9 * len(found), scores
    table, _ = gru.training_texts(docs, labels, F.lit(True), 300)
    assert max(len(t.split()) for t in table["excerpt"].to_pylist()) <= gru.TEXT_WORDS


def test_held_back_has_each_class():
    y = np.array([0] * 20 + [1, 1])
    out = nbsvm.held_back(y, 5)
    assert set(y[out]) == set(y[~out]) == {0, 1}


def test_descent_closes_the_duality_gap():
    """The primal objective of the fitted weights is near that of the best ones."""
    rng = np.random.default_rng(6)
    rows = [np.unique(rng.integers(0, 50, 12)) for _ in range(80)]
    values = [np.full(len(r), 1 / np.sqrt(len(r)), np.float32) for r in rows]
    labels = rng.integers(0, 2, 80)
    sign = np.where(labels == 1, 1.0, -1.0)

    def primal(weights, bias):
        loss = [max(0.0, 1 - s * (weights[r] @ v + bias)) for r, v, s in zip(rows, values, sign, strict=True)]
        return 0.5 * (weights @ weights + bias * bias) + nbsvm.COST * sum(loss)

    few, many = (primal(*nbsvm.descend(rows, values, labels, n, nbsvm.COST)) for n in (nbsvm.EPOCHS, 400))
    assert many <= few <= 1.02 * many


def test_network_gradients():
    """Slopes of the loss by backpropagation are those by differences."""
    rng = np.random.default_rng(9)
    zero = np.zeros(gru.BUCKETS, gru.FLOAT)
    net = gru.new_network(zero, zero)
    net.weights = {k: v if k in ("words", "grams") else v.astype(float) for k, v in net.weights.items()}
    x = rng.normal(size=(3, gru.LENGTH, 2 * gru.WIDTH + 2))
    size, y = np.array([gru.LENGTH, 5, 1]), np.array([1, 0, 1])
    slopes, by_x = gru.gradients(net, x, size, y)

    def loss():
        return losses(net, x, size, y)

    def losses(net, x, size, y):
        table = x.reshape(-1, x.shape[2])
        codes = np.arange(len(table)).reshape(len(x), -1)
        m = net.margins(table, codes, size).astype(float)
        return float(np.mean(np.logaddexp(0, np.where(y == 1, -m, m))))

    step = 1e-2
    for name, g in slopes.items():
        flat = net.weights[name].reshape(-1)
        for k in rng.choice(flat.size, min(4, flat.size), replace=False):
            flat[k] += step
            up = loss()
            flat[k] -= 2 * step
            down = loss()
            flat[k] += step
            assert abs((up - down) / (2 * step) - np.asarray(g).reshape(-1)[k]) < 5e-3, name


def test_odd_sketch_estimates():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 400).astype(np.uint64)
    for changed in (10, 40, 100):
        other = base.copy()
        other[:changed] = rng.integers(0, 1 << 63, changed)
        true = (400 - changed) / (400 + changed)
        sketch = oddsketch.odd_sketches(
            oddsketch.min_hashes([np.unique(base), np.unique(other)], oddsketch.SAMPLES)
        ).view(np.uint64)
        found = oddsketch.estimates(sketch[:1], sketch[1:])[0, 0]
        assert abs(found - true) < oddsketch.MARGIN


def test_repeated_passages(spark, docs):
    rows = docs.select("text").collect()
    texts = [r.text for r in rows]
    wanted = sorted(
        (
            (t, n, gone, None if t is None else left)
            for t, (n, gone, left) in zip(texts, data.without_repeats(texts), strict=True)
        ),
        key=repr,
    )
    found = passages.remove_repeats(docs)
    assert pairs(found, "n_words", "n_removed", "kept_text") == wanted
    assert passages.remove_repeats(data.no_rows(spark)).count() == 0


def test_passages_are_confirmed_by_words(monkeypatch):
    """With one hash for all windows, and with owners of single windows, all is as before."""
    rng = np.random.default_rng(5)
    passage = [f"w{k}" for k in rng.integers(0, 300, 90)]
    texts = []
    for k in range(12):
        own = [f"v{i}" for i in rng.integers(0, 300, 60)]
        texts.append(" ".join(own[:30] + passage[k : 90 - 3 * k] + own[30:]))
    texts += [" ".join(["a"] * 700), " ".join(["a", "b"] * 40), "", texts[0]]
    wanted = [gone for _, gone, _ in data.without_repeats(texts)]

    def removed(busy: bool) -> list[int]:
        halves = [texts[::2], texts[1::2]]
        shards = [passages.Shard(pa.array(half, pa.string()), 35) for half in halves]
        every = np.unique(np.concatenate([s.windows() for s in shards]))
        keys = np.unique(np.concatenate([s.minimizers() for s in shards]))
        owners = {}
        for k, shard in enumerate(shards):
            sent = passages.candidates(shard, every, keys if busy else keys[:0], 5)
            for block, own in zip(
                sent["block"].to_pylist(), passages._unpacked(sent), strict=True
            ):
                owners.setdefault(block, []).append((k, own))
        back = [set(), set()]
        for rows in owners.values():
            numbers, pieces = zip(*rows, strict=True)
            for k, found in passages.confirmed(numbers, pieces, 35).items():
                back[k] |= found
        out = [None] * len(texts)
        for k, shard in enumerate(shards):
            covered = passages.occurrences(shard.words, passages.passages(shard.words, back[k]))
            for d, (a, b) in enumerate(itertools.pairwise(shard.words.offsets)):
                out[2 * d + k] = int(covered[a:b].sum())
        return out

    assert removed(False) == wanted
    assert removed(True) == wanted
    monkeypatch.setattr(
        passages, "window_hashes", lambda h, w: np.zeros(max(0, len(h) - w + 1), np.uint64)
    )
    assert removed(False) == wanted


def test_small_automata(docs, monkeypatch):
    wanted = pairs(passages.remove_repeats(docs), "n_removed")
    monkeypatch.setattr(passages.occurrences, "__defaults__", (50,))
    assert pairs(passages.remove_repeats(docs, shard_bytes=1000), "n_removed") == wanted


def test_automata_read_few_characters(monkeypatch):
    """Frequent words, and all those that no passage has, are one character each."""
    rng = np.random.default_rng(7)
    rare = [f"r{k}" for k in range(5000)]
    copied = [f"c{k}" for k in np.minimum(rng.geometric(0.1, 400) - 1, 99)]
    texts = [" ".join(rare[:2500] + copied), " ".join(copied + rare[2500:]), "", " ".join(copied)]
    read = []

    class Automaton:
        def __init__(self, store):
            self.held = ahocorasick_automaton(store)
            self.add_word, self.make_automaton = self.held.add_word, self.held.make_automaton

        def iter(self, text):
            read.append(len(text))
            return self.held.iter(text)

    ahocorasick_automaton = passages.ahocorasick.Automaton
    monkeypatch.setattr(passages.ahocorasick, "Automaton", Automaton)
    shard = passages.Shard(pa.array(texts, pa.string()), 35)
    found = passages.passages(shard.words, [" ".join(copied).encode()])
    covered = passages.occurrences(shard.words, found)
    wanted = [w.startswith("c") for text in texts for w in text.split()]
    assert covered.tolist() == wanted
    assert sum(read) < 1.1 * len(wanted)  # it was three times as many
    monkeypatch.setattr(passages, "BASE", 2)
    assert passages.occurrences(shard.words, found).tolist() == wanted


def test_word_hashes():
    """Equal for equal words only, wherever they are; of lengths around eight bytes, too."""
    words = ["a" * n for n in range(1, 40)] + ["a" * n + "\0" for n in range(40)]
    words += ["a" * n + "b" + "a" * (20 - n) for n in range(21)] + ["\xe9", "\u4e2d" * 9]
    texts = pa.array([" ".join(words), None, "", "\n".join(reversed(words)), words[0]])
    hashes = places_of(texts).hashes()
    n = len(words)
    assert len(set(hashes[:n].tolist())) == n == len(set(words))
    assert hashes[n : 2 * n].tolist() == hashes[:n][::-1].tolist()
    assert hashes[2 * n :].tolist() == hashes[:1].tolist()
    assert len(places_of(pa.array([], pa.string())).hashes()) == 0


def test_token_file(spark, docs):
    found = tokenfile.round_trip(docs, LIBRARY_TOKENIZER).orderBy("start").collect()
    assert len(found) == docs.count()
    ids = [r.doc_id for r in found]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    assert [r.start for r in found] == [
        sum(r.n_tokens for r in found[:k]) for k in range(len(found))
    ]
    assert min(r.n_tokens for r in found) == 1
    assert tokenfile.round_trip(data.no_rows(spark), LIBRARY_TOKENIZER).count() == 0


def test_packed_numbers():
    rng = np.random.default_rng(0)
    for n in (0, 1, 3, 4, 5, 1000):
        x = rng.integers(0, 1 << 32, n, dtype=np.uint32) >> rng.integers(0, 32, n).astype(np.uint32)
        assert (tokenfile.unpack(*tokenfile.pack(x), n) == x).all()


def test_byte_pairs(spark, docs):
    library = tiktoken.Encoding(
        "own",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=bytepairs.read_ranks(RANKS),
        special_tokens={},
    )
    found = bytepairs.decode(bytepairs.encode(docs, RANKS), RANKS)
    for r in found.collect():
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode_ordinary(r.text or "")
        assert bytes(r.decoded).decode() == (r.text or "")
    assert bytepairs.token_digests(data.no_rows(spark), RANKS).count() == 0


def test_perfect_hash():
    keys = [f"key{i}".encode() for i in range(5000)]
    table = bytepairs.PerfectHash(keys)
    assert sorted(table.key_at.tolist()) == list(range(5000))
    assert table.find(keys).tolist() == list(range(5000))


def test_contamination(spark, docs):
    texts = data.texts()
    items = [(1, texts[7]), (2, "one"), (3, None), (4, ""), (None, texts[12]), (5, texts[7])]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = [r.text for r in docs.select("text").collect()]
    wanted = sorted(data.contaminated(rows, items))
    for size in (1 << 20, 10):  # one block of items, and one for each
        found = contamination.contamination(docs, benchmark, ["doc_id"], block_bytes=size)
        got = contamination.summary(found).drop("doc_id", "contaminated").collect()
        assert sorted(tuple(r) for r in got) == wanted
    # Many items with one window that occurs often: spans and items stay apart.
    shared = " ".join(f"q{i}" for i in range(10))
    many = spark.createDataFrame([(i, shared) for i in range(500)], "item_id long, text string")
    often = spark.createDataFrame([(1, f"{shared} x " * 200, 1)], "doc_id long, text string, `a.b` int")
    row = contamination.contamination(often, many, ["doc_id"]).first()
    assert len(row.spans) == 200 and len(row.items) == 500
    assert contamination.decontaminate(often, many.limit(0)).columns == ["doc_id", "text", "a.b"]
    clean = contamination.decontaminate(docs, benchmark)
    assert clean.columns == docs.columns
    assert clean.count() == sum(row[1] == 0 for row in wanted)
    none = contamination.contamination(docs, benchmark.limit(0), ["doc_id"])
    assert none.where("n_words > 0").count() > 0 and none.where("size(spans) > 0").count() == 0
    assert contamination.decontaminate(data.no_rows(spark), benchmark).count() == 0


def test_licences(spark, docs):
    found = {r.doc_id: r for r in licences.licence_scan(docs).collect() if r.doc_id}
    assert found[18].licences == "mit,proprietary" and found[18].n_sentences == 3
    assert found[1].licences == "" and found[1].n_sentences == 0
    mit = ". ".join(licences.SENTENCES[k] for k in (4, 5, 6, 7))
    wrapped = mit.replace("copyright notice", "copyright\nnotice")
    broken = mit.replace("The above", "Not so. The above")
    df = spark.createDataFrame([(0, mit), (1, wrapped), (2, broken), (3, None)], "doc_id long, text string")
    rows = {r.doc_id: r.licences for r in licences.licence_scan(df).collect()}
    assert rows == {0: "mit", 1: "mit", 2: "", 3: ""}
    assert licences.licence_scan(data.no_rows(spark)).count() == 0


def test_reply_trees(spark):
    rows = [
        # tree, id, parent, role, text, score
        (1, 1, None, "user", "q", 0.0),
        (1, 2, 1, "assistant", "<|im_end|> \\| <\\|x", 1.0),
        (1, 3, 1, "assistant", "good", 2.0),
        (1, 4, 3, "user", None, 0.0),
        (1, 5, 2, "user", "thanks", 0.5),
        (2, 7, 99, "us%er\n", "its parent is gone", 0.0),
        (3, 1, 2, "user", "on a cycle", 0.0),
        (3, 2, 1, "user", "on a cycle", 0.0),
        (None, 1, None, None, "no tree", 0.0),
    ]
    messages = spark.createDataFrame(
        rows, "tree long, id long, parent long, role string, text string, score double"
    )
    best = replies.best_branches(messages).orderBy("tree", "depth").collect()
    assert [(r.tree, r.leaf, r.text) for r in best] == [
        (None, 1, "no tree"),
        (1, 4, "q"),
        (1, 4, "good"),
        (1, 4, None),
        (2, 7, "its parent is gone"),
    ]
    every = replies.best_branches(messages, None)
    ranks = {(r.leaf, r.rank) for r in every.where("tree = 1").collect()}
    assert ranks == {(4, 1), (5, 2)}
    chats = replies.formatted(every)
    for r in chats.withColumn("turns", replies.parsed(F.col("chat"))).collect():
        said = [(m.role or "", m.text or "") for m in sorted(
            every.where(F.col("tree").eqNullSafe(F.lit(r.tree)) & (F.col("leaf") == r.leaf)).collect(),
            key=lambda m: m.depth,
        )]
        assert [(t.role, t.text) for t in r.turns] == said
    assert replies.best_branches(messages.limit(0)).count() == 0


def test_long_thread(spark):
    rows = [(1, i, i - 1 if i else None, "user", str(i), 1.0) for i in range(300)]
    messages = spark.createDataFrame(
        rows, "tree long, id long, parent long, role string, text string, score double"
    )
    found = replies.best_branches(messages).orderBy("depth").collect()
    assert [r.text for r in found] == [str(i) for i in range(300)]


def test_conversations(spark):
    rows = [(1, 2, "b", "y"), (1, 1, "a", "x"), (1, 2, "b", "y"), (None, 0, None, None)]
    said = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {r.conv_id: r for r in replies.round_trip(said).collect()}
    assert found[1].n_turns == 3 and found[None].n_turns == 1
    assert found[1].turns_sha256 == data.sha("a\nx\nb\ny\nb\ny\n")
    assert replies.round_trip(said.limit(0)).count() == 0


def test_stages(spark, docs, tmp_path):
    """Each stage keeps the columns and is right about the input it gets."""
    texts = data.texts()
    spark.createDataFrame(
        [(i, 1, 0) for i in range(19)], "doc_id long, quality int, toxic int"
    ).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, texts[17])], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet"
    )
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == [
        "quality", "near_duplicates", "repeated_passages", "decontamination", "tokens"
    ]
    at = str(tmp_path)
    kept = stages["quality"](spark, docs, at)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    once = stages["near_duplicates"](spark, docs, at)
    dedup = oddsketch.near_duplicates(docs).where("kept")
    assert once.columns == docs.columns and once.count() == dedup.count()
    assert pairs(once, "source") == sorted(((r.text, "src") for r in dedup.collect()), key=repr)
    cut = stages["repeated_passages"](spark, docs, at)
    assert cut.columns == docs.columns
    wanted = [
        t if not gone else left
        for t, (_, gone, left) in zip(
            [r.text for r in docs.collect()],
            data.without_repeats([r.text for r in docs.collect()]),
            strict=True,
        )
    ]
    assert sorted((r.text for r in cut.collect()), key=repr) == sorted(wanted, key=repr)
    clean = stages["decontamination"](spark, docs, at)
    assert clean.columns == docs.columns and clean.count() == docs.count() - 1
    ids = stages["tokens"](spark, docs, at)
    assert ids.count() == docs.count() and ids.where("n_tokens * 4 <> length(ids)").count() == 0
    for stage in stages.values():
        assert stage(spark, data.no_rows(spark), at).count() == 0
