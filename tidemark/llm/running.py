"""Running sums that no key, however many rows it holds, brings together in one task.

Rows of a key are cut into blocks by a column whose order goes with the rows' order; sums of blocks
are a small aggregate (partial sums before the shuffle), their running sums an even smaller window,
and inside a block a window adds what stands before a row.  The rows are shuffled once, by
``(keys, block)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialize

#: Rows of a block, about, where there are many.
BLOCK_ROWS = 20000


def parts_for(spark: SparkSession, rows: int) -> int:
    """Into how many blocks to cut so many rows: some for every task, and none of over about `BLOCK_ROWS`."""
    return max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), rows // BLOCK_ROWS + 1)


def running_sums(rows: DataFrame, keys: Sequence[str], block: str, order: Sequence[str | Column],
                 sums: dict[str, str], before: DataFrame | None = None, totals: dict[str, str] | None = None) -> DataFrame:
    """``rows`` with a column for each ``{new: summed}``: the sum over the rows of its keys that stand
    before it by ``(block, order)``, and one for each of ``totals``: the sum over all rows of its keys.

    ``rows`` are read twice: give a table that was written.  Keys and block are not null; ``block`` never
    falls as ``order`` rises, and rows that are equal in both are put in any order.  ``before`` are columns
    by ``(keys, block)`` to add on the way.
    """
    totals = totals or {}
    blocks = rows.groupBy(*keys, block).agg(*[F.sum(c).alias(f"_all_{new}") for new, c in (sums | totals).items()])
    whole = Window.partitionBy(*keys)
    earlier = whole.orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(*keys, block, *[F.coalesce(F.sum(f"_all_{new}").over(earlier), F.lit(0)).alias(f"_base_{new}") for new in sums],
                           *[F.sum(f"_all_{new}").over(whole).alias(new) for new in totals])
    inside = Window.partitionBy(*keys, block).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = rows.join(blocks, [*keys, block])
    if before is not None:
        joined = joined.join(before, [*keys])
    made = {new: F.col(f"_base_{new}") + F.coalesce(F.sum(c).over(inside), F.lit(0)) for new, c in sums.items()}
    return joined.withColumns(made).drop(*[f"_base_{new}" for new in sums])


def running_totals(rows: DataFrame, order: Sequence[str], sums: dict[str, str], purpose: str) -> DataFrame:
    """``rows`` with the sums over all rows before each by ``order`` (no keys): ranges of the order are the
    blocks, so the rows are range-partitioned and written once.  Rows that are equal in ``order`` stand in
    any order."""
    spark = rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialize(rows.repartitionByRange(n, *order).withColumn("_range", F.spark_partition_id()), purpose)
    return running_sums(ranged, [], "_range", list(order), sums).drop("_range")
