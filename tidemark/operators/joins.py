"""Joins the jobs need, with explicit strategy rules.

* Config tables (feeds, releases, series, charts) are literal lists, bounded by
  construction: they are the only sides broadcast unconditionally.
* Every other broadcast goes through :func:`broadcast_if_small`, which checks
  the optimizer's size estimate of the side first; beyond the threshold the
  join is left to Spark (sort-merge, with AQE turning it into a broadcast or
  splitting skewed partitions at runtime).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_THRESHOLD = 32 * 1024 * 1024


def plan_size_bytes(df: DataFrame) -> int | None:
    """Optimizer size estimate of a plan (no job runs); None when unknown."""
    try:
        stats = df._jdf.queryExecution().optimizedPlan().stats()
        return int(str(stats.sizeInBytes()))
    except Exception:  # pragma: no cover - estimate unavailable
        return None


def broadcast_if_small(df: DataFrame, threshold: int = DEFAULT_THRESHOLD) -> DataFrame:
    size = plan_size_bytes(df)
    return F.broadcast(df) if size is not None and size <= threshold else df


def config_join(df: DataFrame, config: DataFrame, on: str | Sequence[str], how: str = "inner") -> DataFrame:
    """Enrich with a literal config table (bounded by construction -> broadcast)."""
    return df.join(F.broadcast(config), on, how)


def select_new(frame: DataFrame, existing: DataFrame, identity: Sequence[str], *,
               existing_empty: bool | None = None) -> DataFrame:
    """Rows of ``frame`` whose identity is not stored yet (left anti, column-wise,
    so no key-text collisions).  When nothing is stored the frame passes whole;
    otherwise rows with a null identity part are dropped too (a null key never
    compares as new).  ``existing_empty`` may be given by a caller that knows it;
    else one ``limit(1)`` probe decides."""
    keys = list(identity)
    if existing_empty is None:
        existing_empty = existing.isEmpty()
    if existing_empty:
        return frame
    not_null = F.lit(True)
    for k in keys:
        not_null = not_null & F.col(k).isNotNull()
    stored = existing.select(*keys).filter(not_null)
    return frame.filter(not_null).join(stored, keys, "left_anti")


def anti_by_hash(frame: DataFrame, stored_hashes: DataFrame, col: str = "content_hash") -> DataFrame:
    """Only rows whose content hash is not stored yet (projected one-column read)."""
    return frame.join(stored_hashes.select(col), col, "left_anti")


def dedupe_last(df: DataFrame, key: str | Sequence[str], value: str, position: str) -> DataFrame:
    """One row per key, the value at the greatest position wins (dict overwrite)."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.max_by(F.col(value), F.col(position)).alias(value))


def ratio_join(part: DataFrame, total: DataFrame, key: str, part_col: str, total_col: str,
               out: str = "pct", scale: float = 100.0) -> DataFrame:
    """Inner equi-join on an exact key, keep ``total > 0``, ``out = part / total * scale``."""
    joined = part.join(total, key, "inner").filter(F.col(total_col) > 0)
    return joined.select(key, (F.col(part_col) / F.col(total_col) * F.lit(scale)).alias(out))


def full_assembly(parts: Sequence[DataFrame], key: str | Sequence[str]) -> DataFrame:
    """Full outer join of per-source rows on ``key``: any source may be missing; all
    missing = no row (the key only exists where some source has it)."""
    keys = [key] if isinstance(key, str) else list(key)
    out = parts[0]
    for p in parts[1:]:
        out = out.join(p, keys, "full_outer")
    return out


def fallback_join(requested: DataFrame, history: DataFrame, key: str, snapshot: dict[str, Column],
                  stamp_col: str, history_stamp: Column, snapshot_stamp: Column) -> DataFrame:
    """Left join requested keys to history; a miss takes the snapshot values.  The
    stamp tells which one was used."""
    joined = requested.join(history.withColumn("_hit", F.lit(True)), key, "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    cols = [F.col(key)]
    for name, snap in snapshot.items():
        cols.append(F.when(hit, F.col(name)).otherwise(snap).alias(name))
    cols.append(F.when(hit, history_stamp).otherwise(snapshot_stamp).alias(stamp_col))
    return joined.select(*cols)
