"""A Bloom filter of ids, so that rows of other ids need no shuffle before an exact join.

The filter is a table of 64-bit words, sized by the number of ids: an id sets four bits of the one
word that its hash picks, and a row is tested with one broadcast join. Some 2 % of the rows of other
ids pass it and are dropped by the join after it.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, functions as F

BITS_PER_ID = 16
HASHES = 4
# The words sent to every executor: a row of two longs each, some 50 MB at most.
MAX_WORDS = 1 << 20
# With fewer bits for an id than this, most rows would pass and the filter is left out.
LEAST_BITS_PER_ID = 4


def filter_words(n_ids: int) -> int:
    """How many words a filter of so many ids has; 0 where the ids are too many for one."""
    if n_ids * LEAST_BITS_PER_ID > MAX_WORDS * 64:
        return 0
    return min(MAX_WORDS, max(1, ceil(n_ids * BITS_PER_ID / 64)))


def _place(key: str, words: int) -> dict[str, Column]:
    """The word of an id, and its bits there."""
    one, picks = F.lit(1).cast("long"), F.xxhash64(F.col(key), F.lit(1))
    mask = F.lit(0).cast("long")
    for i in range(HASHES):
        bit = F.shiftrightunsigned(picks, 6 * i).bitwiseAND(F.lit(63).cast("long")).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", one, bit))
    return {"_word": F.pmod(F.xxhash64(F.col(key)), F.lit(words)), "_mask": mask}


def marked_rows(rows: DataFrame, ids: DataFrame, key: str, words: int) -> DataFrame:
    """``rows`` with ``_may_match``: false for sure where no id equals the row's, or it has none."""
    filled = ids.where(F.col(key).isNotNull()).select(*[c.alias(n) for n, c in _place(key, words).items()])
    table = filled.groupBy("_word").agg(F.bit_or("_mask").alias("_bits"))
    placed = rows.withColumns(_place(key, words)).join(F.broadcast(table), "_word", "left")
    held = F.coalesce(F.col("_bits").bitwiseAND(F.col("_mask")) == F.col("_mask"), F.lit(False))
    return placed.select(*rows.columns, (held & F.col(key).isNotNull()).alias("_may_match"))


def join_prefiltered(
    rows: DataFrame, lookup: DataFrame, key: str, how: str, n_ids: int
) -> DataFrame | None:
    """``rows`` joined with ``lookup``, of which only rows that may match are shuffled.

    ``lookup`` has at most one row per key, ``n_ids`` in all (a count that is off makes the filter
    less sharp, not the result wrong). For ``left`` and ``left_anti`` the rows that cannot match
    stay where they are. None where the ids are too many for a filter.
    """
    words = filter_words(n_ids)
    if not words:
        return None
    marked = marked_rows(rows, lookup.select(key), key, words)
    near = marked.where("_may_match").drop("_may_match").join(lookup, key, how)
    if how in ("inner", "left_semi"):
        return near
    far = marked.where("NOT _may_match").drop("_may_match")
    return near.unionByName(far, allowMissingColumns=True)
