"""Skew-safe ordinal within a key.

``row_number() OVER (PARTITION BY key ORDER BY o)`` sends every row of a key to
one task; with a key holding a third of the rows that task holds a third of the
data.  Here rows are range-partitioned on (key, order) instead, so a hot key is
spread over many tasks; each task numbers its own rows, and a small table of
per-(task, key) counts supplies the offset of each task's run of a key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.joins import broadcast_if_small
from tidemark.session import checkpoint_root


def ordinal_within(df: DataFrame, key: str | Sequence[str], order: Sequence[str], out: str = "ordinal") -> DataFrame:
    """1-based position of each row among the rows of its key, by ``order`` (ties
    broken by the range partitioning and then row order: give a unique order)."""
    keys = [key] if isinstance(key, str) else list(key)
    order = list(order)
    # Materialised once in the shared checkpoint folder: both branches below must
    # see the same task id per row, and the lineage is cut (no cache left pinned).
    checkpoint_root(df.sparkSession)
    ranged = (df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
              .withColumn("_pid", F.spark_partition_id())
              .checkpoint(eager=True))
    # groups (task, key) are bounded by one range partition each
    local = ranged.withColumn("_local", F.row_number().over(Window.partitionBy("_pid", *keys).orderBy(*order)))
    runs = ranged.groupBy(*keys, "_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    numbered = local.join(broadcast_if_small(offsets), [*keys, "_pid"], "inner")
    return numbered.withColumn(out, F.col("_local") + F.col("_offset")).drop("_pid", "_local", "_offset")
