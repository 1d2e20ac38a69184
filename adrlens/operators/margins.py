"""Totals next to cells, without a join, a cross join or a one-task window."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

BUCKETS_PER_PARTITION = 4


def attach_totals(df: DataFrame, totals: Mapping[str, tuple[Sequence[str], Column]],
                  is_total: Column, spread_on: str) -> DataFrame:
    """Copy total rows into every hash bucket of ``spread_on`` and window inside buckets.

    ``totals`` maps a new column to (grouping columns, value on the total row, null on all
    others).  ``df`` is an aggregate with few total rows, ``is_total`` marks them, and all
    windows share one shuffle on the bucket.  The number of buckets follows the number of
    shuffle partitions.
    """
    buckets = BUCKETS_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bucket = F.when(is_total, F.sequence(F.lit(0), F.lit(buckets - 1))).otherwise(
        F.array(F.pmod(F.hash(spread_on), F.lit(buckets)).cast("int")))
    spread = df.withColumn("_bucket", F.explode(bucket)).repartition("_bucket")
    return spread.select(
        "*", *[F.max(value).over(Window.partitionBy("_bucket", *by)).alias(name)
               for name, (by, value) in totals.items()]
    ).drop("_bucket")
