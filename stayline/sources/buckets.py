"""A log stored in buckets by user, so that facts and joins by user shuffle nothing of it.

A bucket is read by one task, so no user may fill one. Users with more than an eighth of the rows
that a bucket has on average are spread over pieces of that size: their rows carry a number, a hash
of the whole row, beside the user id, and both together are the key of the buckets. There are at
most eight times as many such users as buckets.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from math import ceil

from pyspark.sql import DataFrame, SparkSession, functions as F

from stayline.session import durable, scratch_path

BUCKET_BYTES = 256 * 1024**2
PIECES = 8  # of an average bucket


def bucket_count(spark: SparkSession, input_bytes: int) -> int:
    """Buckets for a table of so many stored bytes; at least as many as shuffles have partitions,
    as Spark would deal fewer ones anew."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), ceil(input_bytes / BUCKET_BYTES))


@dataclass
class BucketedLog:
    """The log's table, the users whose rows are spread, and the number of buckets."""

    spark: SparkSession
    table: str
    heavy: DataFrame
    buckets: int

    #: The column that spreads a heavy user's rows; 0 for all other users.
    SPREAD = "_spread"

    @classmethod
    def store(cls, log: DataFrame, buckets: int) -> BucketedLog:
        """Write a log into buckets; rows without a user id are spread by their hash, too."""
        counts = durable(log.groupBy("userId").agg(F.count("*").alias("n")))
        total = counts.agg(F.sum("n")).first()[0] or 0
        share = max(1, ceil(total / buckets / PIECES))
        heavy = counts.where(F.col("n") > share).select(
            F.col("userId").alias("_user"), F.ceil(F.col("n") / share).cast("int").alias("_places")
        )
        heavy = durable(heavy)  # at most PIECES rows for each bucket
        known = log.join(F.broadcast(heavy), F.col("userId").eqNullSafe(F.col("_user")), "left")
        place = F.pmod(F.xxhash64(*log.columns), F.coalesce("_places", F.lit(1))).cast("int")
        spread = known.select(*log.columns, place.alias(cls.SPREAD))
        return cls(log.sparkSession, _write(spread, buckets), heavy, buckets)

    def log(self) -> DataFrame:
        """The rows, dealt by ``userId`` and ``_spread`` as they are read."""
        return self.spark.table(self.table)

    def attach(self, facts: DataFrame) -> DataFrame:
        """Log rows inner joined with facts of their user, bucket by bucket.

        The facts are written into buckets of their own, a heavy user's once for each place.
        """
        places = facts.join(F.broadcast(self.heavy), F.col("userId") == F.col("_user"), "left")
        last = F.coalesce("_places", F.lit(1)) - 1
        place = F.explode(F.sequence(F.lit(0), last)).alias(self.SPREAD)
        beside = self.spark.table(_write(places.select(*facts.columns, place), self.buckets))
        return self.log().join(beside, ["userId", self.SPREAD]).drop(self.SPREAD)

    def drop(self) -> None:
        """Take the table out of the catalog; its files stay as other stored tables do."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def _write(rows: DataFrame, buckets: int) -> str:
    """The name of a new table of these rows; dealt first, so that a bucket is one file."""
    spark, name = rows.sparkSession, f"stayline_{uuid.uuid4().hex}"
    keys = ["userId", BucketedLog.SPREAD]
    writer = rows.repartition(buckets, *keys).write.format("parquet").bucketBy(buckets, *keys)
    writer.option("path", scratch_path(spark, "buckets")).saveAsTable(name)
    return name
