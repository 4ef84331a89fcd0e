"""Every registered query over whole small tables, against brute force or its SQL."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from stayline.llm import bytepairs
from stayline.llm.queries import QUERIES, SQL
from tests.compare import duck, duck_rows, spark_rows
from tests.llm import data


@pytest.fixture(scope="module")
def documents(spark):
    rows = spark.read.parquet(f"{data.SF}/documents.parquet").orderBy("doc_id").collect()
    return {r.doc_id: r.text for r in rows}


def by_doc(df, *columns):
    return {r.doc_id: tuple(r[c] for c in columns) for r in df.collect()}


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, name):
    found = spark_rows(QUERIES[name](spark, data.SF))
    assert found == duck_rows(duck(data.SF), SQL[name])


def test_divergence_counts(spark, documents):
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    found = QUERIES["op1_distribution_divergence"](spark, data.SF)
    rows = by_doc(found, *columns, "base_failed", "kept")
    for doc, text in documents.items():
        n = data.counts(text)
        failed = n[0] < 20 or 100 * n[4] > 30 * n[0]
        assert rows[doc][:6] == (*n, failed)
        assert not (failed and rows[doc][6])


def test_near_duplicates(spark, documents):
    ids = list(documents)
    sets = [data.shingles(documents[i]) for i in ids]
    wanted = {
        i: (len(s), ids[top], ids[top] == i)
        for i, s, top in zip(ids, sets, data.linked(sets), strict=True)
    }
    found = QUERIES["op3_odd_sketches"](spark, data.SF)
    assert by_doc(found, "n_shingles", "component_id", "kept") == wanted


def test_repeated_passages(spark, documents):
    wanted = {
        i: (n, gone, data.sha(left))
        for i, (n, gone, left) in zip(
            documents, data.without_repeats(list(documents.values())), strict=True
        )
    }
    found = QUERIES["op4_repeated_passages"](spark, data.SF)
    assert by_doc(found, "n_words", "n_removed", "kept_sha256") == wanted


def test_token_file(spark, documents):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    wanted, start = {}, 0
    for i, text in documents.items():
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        wanted[i] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    found = QUERIES["op6_token_file"](spark, data.SF)
    assert by_doc(found, "start", "n_tokens", "ids_crc32") == wanted


def test_byte_level_bpe(spark, documents):
    ranks = bytepairs.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    wanted = {}
    for i, text in documents.items():
        ids = library.encode_ordinary(text or "")
        raw = np.array(ids, "<u4").tobytes()
        wanted[i] = (len(ids), data.sha(raw), data.sha(text or ""))
    found = QUERIES["op8_byte_level_bpe"](spark, data.SF)
    assert by_doc(found, "n_tokens", "ids_sha256", "decoded_sha256") == wanted


def test_decontamination(spark, documents):
    items = [tuple(r) for r in spark.read.parquet(f"{data.SF}/benchmark.parquet").collect()]
    wanted = {
        i: (*row, row[1] > 0)
        for i, row in zip(
            documents, data.contaminated(list(documents.values()), items), strict=True
        )
    }
    found = QUERIES["op10_decontamination"](spark, data.SF)
    columns = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert by_doc(found, *columns) == wanted


@pytest.mark.parametrize(
    ("name", "sf", "label", "fold", "least"),
    [
        ("op2_nb_support_vectors", "sf0.01", "quality", 1, 0.93),
        ("op5_gated_network", "sf0.1", "toxic", 2, 0.9),  # sf0.01 has 37 toxic texts to learn from
    ],
)
def test_held_out_ranking(spark, name, sf, label, fold, least):
    """Scores rank held-out labels."""
    sf = f"/root/testdata/{sf}"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", label)
    rows = QUERIES[name](spark, sf).join(labels, "doc_id", "left").collect()
    folds = {1: 3, 2: 4}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds[fold] == fold)
        assert 0 <= r.score <= 1
        assert r.predicted == int(r.score >= (0.5 if label == "quality" else 0.3))
    held = [(r.score, r[label]) for r in rows if r.held_out and r[label] is not None]
    good = [s for s, y in held if y == 1]
    bad = [s for s, y in held if y == 0]
    wins = sum((a > b) + 0.5 * (a == b) for a in good for b in bad)
    assert wins >= least * len(good) * len(bad)
