"""Writing result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: str | None = None,
    mode: str = "overwrite",
) -> None:
    """Write ``df``; with ``partition_by`` as one folder per value.

    ``mode="replace"`` replaces the folders that ``df`` has rows for and leaves the others, so the
    same day can be written again.

    The rebalance hint brings the rows of a folder together, so that not every
    task writes a file into every folder, and lets AQE split folders that are
    large and merge small ones.
    """
    if mode == "replace":
        if partition_by is None:
            raise ValueError("only folders of a partitioned table can be replaced")
        rows = df.hint("rebalance", partition_by).write.mode("overwrite").format(fmt)
        rows.option("partitionOverwriteMode", "dynamic").partitionBy(partition_by).save(path)
    elif partition_by is None:
        df.write.mode(mode).format(fmt).save(path)
    else:
        df.hint("rebalance", partition_by).write.mode(mode).format(fmt).partitionBy(
            partition_by
        ).save(path)
