"""Joining log rows with a table that has one row per key, whatever the key distribution.

A lookup table whose size in bytes was checked is broadcast. Otherwise it is one shuffle join:
AQE splits the partitions that heavy keys fill, and rows without a key, which match nothing, are
spread over the tasks in the same pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from stayline.operators.prefilter import join_prefiltered

BROADCAST_BYTES = 64 << 20
NULL_SALTS = 256
_FIXED_WIDTH = 16  # bytes a number or date takes in a row, with its share of the header


def row_bytes(df: DataFrame):
    """About how many bytes a row takes in memory."""
    total = F.lit(0).cast("long")
    for f in df.schema:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0))
        total = total + F.lit(_FIXED_WIDTH)
    return total


def is_small(stored: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether a stored table has few enough bytes to be sent to every executor.

    Runs a job over it; a table that is not stored would be computed for that.
    """
    return (stored.agg(F.sum(row_bytes(stored))).first()[0] or 0) <= max_bytes


def join_lookup(
    rows: DataFrame,
    lookup: DataFrame,
    key: str | Sequence[str],
    how: str = "inner",
    small: bool = False,
    n_ids: int | None = None,
) -> DataFrame:
    """``rows`` joined with ``lookup``, which must have at most one row per key.

    ``small`` says that the size of ``lookup`` was checked (:func:`is_small`): it is broadcast.
    ``n_ids`` says that it has only so many of the keys in ``rows``: a Bloom filter of them then
    spares the shuffle of all other rows, if they are few enough for one.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if small:
        return rows.join(F.broadcast(lookup), keys, how)
    if n_ids is not None and len(keys) == 1:
        joined = join_prefiltered(rows, lookup, keys[0], how, n_ids)
        if joined is not None:
            return joined
    if how in ("inner", "left_semi"):
        return rows.join(lookup, keys, how)
    keyless = F.lit(False)
    for k in keys:
        keyless = keyless | F.col(k).isNull()
    spread = F.pmod(F.xxhash64(*rows.columns), F.lit(NULL_SALTS)) + 1
    salt = F.when(keyless, spread).otherwise(0).cast("long")
    salted = rows.withColumn("_salt", salt)
    unsalted = lookup.withColumn("_salt", F.lit(0).cast("long"))
    return salted.join(unsalted, [*keys, "_salt"], how).drop("_salt")
