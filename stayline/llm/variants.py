"""Spelling variants: words one edit apart, by an index of variable-length grams.

Words are maximal runs of letters, counted over all texts. The dictionary holds all grams of
``SHORT`` letters, and longer ones, up to ``LONG``, where the gram without its last letter is too
frequent (more than ``SHARE`` of all gram places). A word is decomposed into the longest dictionary
gram at each place, without those that an earlier one covers.

An edit changes the grams that hold its place, and those next to it only where the dictionary has
a gram that could reach across. The most that one edit can change is the word's affected-gram
bound. So two words one edit apart have at least as many grams in common as either word has grams
less its bound: their *least* overlap. With grams ordered by rarity, lists of words are merged on
combinations of up to three grams, taken from no more of a word's rarest grams than its bound asks
for. Words whose least overlap is 3 or more meet on three grams; two words with at most 2 on two
as well, at most 1 on one, and 0 on the word less one letter, which needs no common gram.

The words of a list are compared if their lengths and the places of a common gram differ by at
most one, and all candidates are verified letter by letter. No list is longer than the places of its
rarest gram; where those are more than ``BLOCK``, the list is cut into blocks that each two meet in
a list of their own, so no task holds more.

What goes through the driver is the dictionary with its frequencies: letters have 90 values, so it
has at most 90^2 + 90^3 grams, whatever the corpus.

Defined results: a null or empty text has no words; a null doc_id counts as an empty string where
letters are deleted by the hash; repeated rows count again. Other columns are ignored, whatever
their names. An empty table gives no words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import ceil, log2, log10

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from stayline.llm.words import map_texts, ship_package
from stayline.session import durable

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LEAST_LENGTH, LEAST_COUNT = 7, 2
DELETE = 31  # a hash that this divides deletes a letter of a run
FORM_RATIO = 10
SHORT, LONG = 2, 3
SHARE = 0.0003
SHARED = 3  # grams that a list is merged on, at most
BLOCK = 1 << 14
WIDE = 48  # letters that are compared as a matrix; longer words one by one
ROWS = 1 << 16  # of lists that are looked at together

_LOWER = {i: i + 32 for i in range(ord("A"), ord("Z") + 1)}


def doc_words(doc_id: object, text: str, least_length: int = LEAST_LENGTH) -> Counter:
    """Words of a text, with letters deleted where the hash of doc_id and run says so."""
    seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    found: Counter = Counter()
    for run, n in Counter(RUN.findall(text)).items():
        if len(run) < least_length:
            continue
        word = run.translate(_LOWER)
        h = zlib.crc32(word.encode(), seed)
        if h % DELETE == 0:
            k = h % len(word)
            word = word[:k] + word[k + 1 :]
        if len(word) >= least_length:
            found[word] += n
    return found


def word_counts(df: DataFrame, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word`` and ``n``, how often it occurs in all texts."""

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        total: Counter = Counter()
        ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
        for doc_id, text in zip(ids, texts, strict=True):
            total.update(doc_words(doc_id, text or ""))
        return pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())],
            ["word", "n"],
        )

    counted = map_texts(df.select("doc_id", "text"), "word string, n long", count)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


@dataclass
class Grams:
    """The dictionary: how many places each gram has, and what could grow into a gram."""

    places: dict[str, int]

    def __post_init__(self) -> None:
        self.begins = {g[:k] for g in self.places for k in range(1, len(g))}
        self.ends = {g[k:] for g in self.places for k in range(1, len(g))}

    def spans(self, word: str) -> list[tuple[int, int]]:
        """Begin and end of each gram of a word."""
        out, end, n = [], 0, len(word)
        for p in range(n - SHORT + 1):
            size = SHORT
            for q in range(min(LONG, n - p), SHORT, -1):
                if word[p : p + q] in self.places:
                    size = q
                    break
            if p + size > end:
                end = p + size
                out.append((p, end))
        return out

    def affected(self, word: str, spans: list[tuple[int, int]]) -> int:
        """The most grams that one edit can change.

        An edit leaves ``word[:i]`` and ``word[j:]``, with j = i (insertion) or i + 1.
        """
        n = len(word)
        left, right = list(range(n + 1)), list(range(n + 1))
        for i in range(n + 1):
            # From left[i] on, a gram could begin before the edit and reach into it.
            for p in range(max(0, i - LONG + 1), i):
                if word[p:i] in self.begins:
                    left[i] = p
                    break
            for e in range(min(n, i + LONG - 1), i, -1):
                if word[i:e] in self.ends:
                    right[i] = e
                    break
        most = 0
        for i in range(n + 1):
            for j in (i, i + 1) if i < n else (i,):
                changed = 0
                for p, e in spans:
                    if e <= i:
                        changed += p >= left[i]
                    elif p >= j:
                        changed += e <= right[j]
                    else:
                        changed += 1
                most = max(most, changed)
        return most

    def keys(self, word: str) -> Iterator[tuple[str, int, int]]:
        """Lists that a word is in: key, place of its first gram, and a bound on their length.

        The place is -1 where the word has the gram more than once.
        """
        spans = self.spans(word)
        m = len(spans)
        least = m - self.affected(word, spans)
        grams = [word[p:e] for p, e in spans]
        often = Counter(grams)
        seen: Counter = Counter()
        tokens = []
        for g, (p, _) in zip(grams, spans, strict=True):
            tokens.append((self.places.get(g, 0), g, seen[g], p if often[g] == 1 else -1))
            seen[g] += 1
        tokens.sort()
        for shared in range(SHARED, 0, -1):
            if shared < SHARED and least > shared:
                break
            prefix = tokens[: m - max(least, 0) + shared]
            for group in combinations(prefix, shared):
                name = "|".join([f"{g}{k}" for _, g, k, _ in group])
                yield name, group[0][3], group[0][0]
        if least <= 0:
            # At most a word for each letter and place meets on a variant.
            for variant in {word, *(word[:k] + word[k + 1 :] for k in range(len(word)))}:
                yield f"={variant}", -1, 1


def dictionary(words: DataFrame, share: float = SHARE) -> Grams:
    """Frequent grams grow; the others stay short."""
    counted = None
    for q in range(SHORT, LONG + 1):
        grams = F.expr(f"transform(sequence(1, length(word) - {q - 1}), p -> substr(word, p, {q}))")
        own = words.where(F.length("word") >= q).select(F.explode(grams).alias("gram"))
        counted = own if counted is None else counted.union(own)
    rows = counted.groupBy("gram").agg(F.count("*").alias("n")).toArrow()
    found = dict(zip(rows["gram"].to_pylist(), rows["n"].to_pylist(), strict=True))
    enough = share * sum(n for g, n in found.items() if len(g) == SHORT)
    kept = {
        g: n
        for g, n in found.items()
        if all(found[g[:q]] > enough for q in range(SHORT, len(g)))
    }
    return Grams(kept)


LISTED = "key long, side byte, length int, place int, word string"


def listed(words: DataFrame, grams: Grams) -> DataFrame:
    """A row for each list, or two blocks of a list, that a word is in.

    ``side`` is -1 where all words of the list are compared, otherwise 0 or 1 for the block.
    """
    shared = words.sparkSession.sparkContext.broadcast(grams)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = xxhash.xxh3_64_intdigest
        for batch in batches:
            keys, sides, lengths, places, out = [], [], [], [], []

            def put(name: str, side: int, word: str, place: int) -> None:
                keys.append(of(name))
                sides.append(side)
                lengths.append(len(word))
                places.append(place)
                out.append(word)

            for word in batch.column("word").to_pylist():
                for name, place, most in shared.value.keys(word):
                    n = -(-most // BLOCK)
                    if n <= 1:
                        put(name, -1, word, place)
                        continue
                    own = of(word) % n
                    for other in range(n):
                        i, j = min(own, other), max(own, other)
                        put(f"{name}:{i}:{j}", -1 if i == j else int(own == j), word, place)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.array(keys, np.uint64).view(np.int64)),
                    pa.array(sides, pa.int8()),
                    pa.array(lengths, pa.int32()),
                    pa.array(places, pa.int32()),
                    pa.array(out, pa.string()),
                ],
                ["key", "side", "length", "place", "word"],
            )

    ship_package(words.sparkSession)
    return words.select("word").mapInArrow(rows, LISTED)


def one_edit(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced letter makes ``b`` of ``a``."""
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[k + (len(a) == len(b)) :] == b[k + 1 :]


def _verified(words: np.ndarray, length: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether words x and y (as long, or one letter longer) are one edit apart."""
    size = words.dtype.itemsize
    a = words[x].view(np.uint8).reshape(len(x), size)
    b = words[y].view(np.uint8).reshape(len(y), size)
    same = a == b
    equal = length[x] == length[y]
    shifted = a[:, :-1] == b[:, 1:]
    first = np.where(same.all(axis=1), size, same.argmin(axis=1))
    rest = shifted | (np.arange(size - 1)[None, :] < first[:, None])
    return np.where(equal, (~same).sum(axis=1) == 1, rest.all(axis=1))


def _near(table: pa.Table) -> pa.RecordBatch:
    """Near words of whole lists, whose rows are in order of list and length."""
    text = table["word"].combine_chunks()
    key, side, length, place = (table[c].to_numpy() for c in ("key", "side", "length", "place"))
    of_list = np.cumsum(np.append(False, key[1:] != key[:-1]))
    letters = [w.encode("latin-1") for w in text.to_pylist()]
    words = np.array([w[:WIDE] for w in letters], f"S{WIDE + 1}")
    left, right = [], []
    x, step = np.arange(len(length)), 0
    while len(x):
        step += 1
        x = x[x + step < len(length)]
        y = x + step
        x = x[(of_list[x] == of_list[y]) & (length[y] - length[x] <= 1)]
        y = x + step
        fit = (place[x] < 0) | (place[y] < 0) | (np.abs(place[x] - place[y]) <= 1)
        fit &= (side[x] < 0) | (side[x] != side[y])
        for k in range(0, len(x), ROWS):
            p, q = x[k : k + ROWS][fit[k : k + ROWS]], y[k : k + ROWS][fit[k : k + ROWS]]
            good = _verified(words, length, p, q)
            for r in np.flatnonzero(length[q] > WIDE):
                a, b = (letters[z[r]].decode("latin-1") for z in (p, q))
                good[r] = one_edit(a, b)
            left.append(p[good])
            right.append(q[good])
    a, b = (np.concatenate([np.zeros(0, np.int64), *z]) for z in (left, right))
    return pa.RecordBatch.from_arrays([text.take(pa.array(a)), text.take(pa.array(b))], ["u", "v"])


def near_words(words: DataFrame, grams: Grams) -> DataFrame:
    """``word`` and ``near``, both ways, of all words one edit apart."""
    ordered = listed(words, grams).repartition("key").sortWithinPartitions("key", "length")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) < ROWS:
                continue
            table = pa.Table.from_batches(held)
            key = table["key"].to_numpy()
            cut = int(np.argmax(key == key[-1]))  # the last list may go on
            if cut:
                yield _near(table.slice(0, cut))
            held = table.slice(cut).combine_chunks().to_batches()
        if held:
            yield _near(pa.Table.from_batches(held))

    pairs = ordered.mapInArrow(merge, "u string, v string")
    pairs = pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    both = F.explode(
        F.array(
            F.struct(F.col("u").alias("word"), F.col("v").alias("near")),
            F.struct(F.col("v").alias("word"), F.col("u").alias("near")),
        )
    )
    return pairs.select(both.alias("e")).select("e.*")


def spelling_variants(df: DataFrame, share: float = SHARE) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` of all words of ``df``.

    The form of a word is its near word of largest n (the smallest of several), if that is at
    least ``FORM_RATIO`` times its own n; the root is the last of its forms.
    """
    words = durable(word_counts(df))
    near = near_words(words, dictionary(words, share))
    counts = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = near.join(counts, "near").groupBy("word").agg(
        F.count("*").alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"),
    )
    enough = -F.col("best.less") >= FORM_RATIO * F.col("n")
    found = durable(
        words.join(best, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(enough, F.col("best.near")).alias("form"),
            F.when(enough, -F.col("best.less")).alias("form_n"),
        )
    )
    # Each form is ten times as frequent, so few steps lead to a root; each round doubles them.
    most = found.agg(F.max("n")).first()[0] or 1
    steps = found.where("form is not null").select("word", "form")
    for _ in range(ceil(log2(max(2, log10(most) + 1)))):
        onward = steps.select(F.col("word").alias("form"), F.col("form").alias("next"))
        steps = steps.join(onward, "form", "left").select(
            "word", F.coalesce("next", "form").alias("form")
        )
    roots = steps.select("word", F.col("form").alias("root"))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
