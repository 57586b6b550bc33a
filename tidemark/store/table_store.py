"""Keyed tables as folders of plain Parquet writes that Spark lists itself.

Layout of a table's folder::

    data/write=<number>-<id>/<derived column>=<value>/.../part-*.parquet    one DataFrame write each
    members/write=<number>-<id>/part-*.parquet                              membership filter of a write, if asked for
    _table.json                                                             what counts

``_table.json`` names the layout, the writes that count, and for each partition that was written anew
the first write that counts for it.  A write puts its rows into a folder of its own and then replaces
this small file by one rename, so a reader sees a table before or after a write, never half of it, and
a writer that dies leaves a folder that nothing names (`vacuum` removes it).  No list of files is kept:
reads are partition-discovered scans whose filters on ``write`` and on the derived columns Spark prunes.

Upsert is copy-on-write by partition: one join of the batch with the stored rows it can match gives the
counts and the partitions that hold changed rows; these are written anew, with the new rows, by one
write.  A batch of new rows alone is a pure addition.  Spark picks the join by the measured size of the
persisted batch.  Only partitions that the batch touches are read, if the identity determines the
partition; else a row may have moved, and all are.

One writer a table: a writer that finds that another has committed since it began fails whole
(`ConcurrentWrite`); an append goes on top.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable, Sequence
from functools import reduce
from operator import and_, or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import session as sess
from tidemark.operators.aggregates import observed
from tidemark.operators.bloom import key_bits, maybe_members, merged_bits
from tidemark.operators.conform import conform
from tidemark.spec import PartitionField, TableSpec, partition_matches, sort_matches
from tidemark.tables import ALL_SPECS, resolve

DATA, MEMBERS, POINTER, WRITE = "data", "members", "_table.json", "write"


class ConcurrentWrite(RuntimeError):
    """Another writer has committed since this one began; this one changed nothing and may be run again."""


class WriteResult(NamedTuple):
    """Rows put in, rows given other values, and how long it took."""

    rows_inserted: int = 0
    rows_updated: int = 0
    seconds: float = 0.0

    @property
    def rows_affected(self) -> int:
        return sum(self[:2])


class Pointer(NamedTuple):
    """A table at one moment: its layout (None: there is no table), its writes in order, and of partitions
    that were written anew the values (as text) with the first write that counts."""

    layout: dict | None = None
    writes: tuple[str, ...] = ()
    since: tuple[tuple[tuple[str | None, ...], str], ...] = ()

    def added(self, layout: dict, write: str, anew: Iterable[Sequence[str | None]] = ()) -> Pointer:
        """With one more write, which holds these partitions whole."""
        anew = {tuple(p) for p in anew}
        kept = [s for s in self.since if s[0] not in anew]
        return Pointer(layout, (*self.writes, write), tuple(sorted([*kept, *((p, write) for p in anew)], key=repr)))


def with_partition_columns(df: DataFrame, spec: TableSpec) -> DataFrame:
    return df.withColumns({p.name: p.expr() for p in spec.partition}) if spec.partition else df


def sorted_for_write(df: DataFrame, spec: TableSpec, *, cluster: bool = True, seen: Observation | None = None) -> DataFrame:
    """Cluster rows for the writer: partition columns first, then the sort order (ASC NULLS FIRST).

    ``REBALANCE`` on the partition columns lets AQE size the write tasks from the actual shuffle
    statistics: a partition value usually lands in one task (one file per directory), a hot value
    holding a third of the rows is split across tasks, and small tasks are coalesced - without a
    sampling pass over the input.  Then a per-task sort lays rows out in table order inside each
    file.  ``seen`` counts the rows as they are written, in the tasks that write them."""
    order = [F.asc_nulls_first(c) for c in spec.partition_columns] + [s.expr() for s in spec.sort]
    if cluster:
        df = df.hint("rebalance", *spec.partition_columns) if spec.partition else df.hint("rebalance")
    if seen is not None:
        df = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    return df.sortWithinPartitions(*order) if order else df


def among(columns: Sequence[str], values: Iterable[Sequence[str | None]]) -> Column:
    """Whether the columns, as text, hold one of these tuples (nulls are equal)."""
    same = lambda held: reduce(and_, (F.col(c).cast("string").eqNullSafe(F.lit(v)) for c, v in zip(columns, held, strict=True)))
    return reduce(or_, map(same, values), F.lit(False))


class TableStore:
    """``create_all / read / read_window / append / upsert`` over tables named ``namespace.name``."""

    def __init__(self, spark: SparkSession, root: str, specs: dict[str, TableSpec] | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.specs = dict(ALL_SPECS if specs is None else specs)

    # ---- names and the pointer ---------------------------------------------
    def spec(self, table: str) -> TableSpec:
        return resolve(table, self.specs)

    def path(self, table: str) -> str:
        spec = self.spec(table)
        return f"{self.root}/{spec.namespace}/{spec.name}"

    def pointer(self, table: str) -> Pointer:
        text = sess.read_text(self.spark, f"{self.path(table)}/{POINTER}")
        if text is None:
            return Pointer()
        held = json.loads(text)
        return Pointer(held["layout"], tuple(held["writes"]), tuple((tuple(values), write) for values, write in held["since"]))

    def _point(self, table: str, began: Pointer, to: Pointer) -> None:
        if self.pointer(table) != began:
            raise ConcurrentWrite(f"{table} was written by another writer meanwhile")
        sess.replace_text(self.spark, f"{self.path(table)}/{POINTER}", json.dumps(to._asdict()))

    def stored_layout(self, table: str) -> dict | None:
        return self.pointer(table).layout

    def has_data(self, table: str) -> bool:
        return bool(self.pointer(table).writes)

    def layout_drift(self, table: str) -> tuple[bool, bool]:
        """(partition layout matches, sort order matches) against the stored copy."""
        stored, spec = self.stored_layout(table), self.spec(table)
        return partition_matches(stored, spec), sort_matches(stored, spec)

    def create_all(self) -> None:
        """Create missing tables (without rows); reconcile the layout of existing ones."""
        for table in sorted(self.specs):
            now = self.pointer(table)
            if now.layout is None:
                self._point(table, now, Pointer(self.spec(table).layout()))
            elif not all(self.layout_drift(table)):
                self.relayout(table)

    def vacuum(self, table: str) -> int:
        """Remove the folders of writes that do not count; for when no writer and no reader of an older
        state is about.  Returns how many went."""
        keep = {f"{WRITE}={w}" for w in self.pointer(table).writes}
        folders = [f"{self.path(table)}/{kind}" for kind in (MEMBERS, DATA)]
        gone = {f: [name for name in sess.file_names(self.spark, f) if name not in keep] for f in folders}
        for folder, names in gone.items():
            for name in names:
                sess.remove(self.spark, f"{folder}/{name}")
        return len(gone[folders[-1]])

    # ---- read ------------------------------------------------------------
    def scan(self, table: str, now: Pointer | None = None, writes: Sequence[str] | None = None) -> DataFrame:
        """All rows that count (of some writes only, if named), with the derived columns they are stored
        by; schemas are declared, never inferred.  Filters on the derived columns become partition filters
        of the scan."""
        spec, now = self.spec(table), self.pointer(table) if now is None else now
        stored = [PartitionField(source, transform) for source, transform, _ in (now.layout or spec.layout())["partition"]]
        schema = T.StructType([*spec.schema.fields, T.StructField(WRITE, T.StringType()), *(T.StructField(p.name, p.data_type(spec.schema)) for p in stored)])
        names = [p.name for p in stored]
        asked = now.writes if writes is None else [w for w in now.writes if w in set(writes)]
        if not asked:
            return self.spark.createDataFrame([], schema).drop(WRITE)
        folder = f"{self.path(table)}/{DATA}"
        rows = self.spark.read.schema(schema).option("basePath", folder).parquet(*(f"{folder}/{WRITE}={w}" for w in asked))
        for values, first in now.since:      # writes are numbered, so their names are in order
            rows = rows.where((F.col(WRITE) >= F.lit(first)) | ~among(names, [values]))
        return rows.drop(WRITE)

    def _columns(self, table: str, columns: Sequence[str] | None) -> list[str]:
        spec = self.spec(table)
        unknown = [c for c in columns or () if c not in spec.columns]
        if unknown:
            raise KeyError(f"columns {unknown} not in {table}")
        return list(columns or spec.columns)

    def read_storage(self, table: str) -> DataFrame:
        """All rows plus the derived partition columns of the declared layout."""
        spec, now = self.spec(table), self.pointer(table)
        rows = self.scan(table, now)
        if partition_matches(now.layout, spec):
            return rows.select(*spec.columns, *spec.partition_columns)
        return with_partition_columns(rows.select(*spec.columns), spec)

    def read(self, table: str, *, columns: Sequence[str] | None = None) -> DataFrame:
        """Projected scan of the table; a missing table is an empty frame with the declared (projected)
        schema."""
        return self.scan(table).select(*self._columns(table, columns))

    def read_window(self, table: str, column: str, low=None, high=None, *, include_high: bool = True,
                    columns: Sequence[str] | None = None) -> DataFrame:
        """Rows with ``low <= column <= high`` (``< high`` without ``include_high``; None: open); a null
        is in no window.

        The bounds go through every partition transform of the column, all of which are monotone, and so
        become partition filters: only folders that can hold rows of the window are listed as input."""
        (named,) = self._columns(table, [column])
        now = self.pointer(table)
        rows = self.scan(table, now)
        for source, transform, _ in (now.layout or {"partition": []})["partition"]:
            if source == named and (low is not None or high is not None):
                rows = rows.where(PartitionField(source, transform).bounds(low, high))
        value = F.col(named)
        if low is not None:
            rows = rows.where(value >= F.lit(low))
        if high is not None:
            rows = rows.where(value <= F.lit(high) if include_high else value < F.lit(high))
        return rows.select(*self._columns(table, columns))

    def _reached(self, table: str, now: Pointer, parts: Sequence[Sequence[str | None]] | None) -> DataFrame:
        """Stored rows of these partitions; all if ``parts`` is None or the table is laid out otherwise."""
        spec, rows = self.spec(table), self.scan(table, now)
        if parts is None or not spec.partition or not partition_matches(now.layout, spec):
            return rows
        return rows.where(among(spec.partition_columns, parts))

    def read_keys(self, table: str, batch: DataFrame) -> DataFrame:
        """Stored identities that can match ``batch``: one partial aggregate over the batch names the
        partitions to read, where the identity determines them."""
        spec, now = self.spec(table), self.pointer(table)
        parts = None
        if spec.partition and spec.identity_determines_partition and now.writes:
            parts = self._values(batch.agg(F.collect_set(self._part(spec)).alias("parts")).first()["parts"])
        return self._reached(table, now, parts).select(*spec.identity)

    def unseen(self, table: str, frame: DataFrame) -> DataFrame:
        """Rows of ``frame`` whose value of the table's member column is not stored; a null counts as unseen.

        The filters of all writes, merged, are asked first, then, for the values that pass, those of each
        write; the stored values are read only of the writes that may hold one, and settle it.  ``frame``
        is read several times: give a persisted or written one."""
        spec, now = self.spec(table), self.pointer(table)
        if not spec.member:
            raise ValueError(f"{table} keeps no membership filter")
        if not now.writes:
            return frame
        folder = f"{self.path(table)}/{MEMBERS}"
        bits = self.spark.read.schema(f"bucket long, bits binary, {WRITE} string").option("basePath", folder).parquet(
            *(f"{folder}/{WRITE}={w}" for w in now.writes))
        any_write = maybe_members(frame, spec.member, merged_bits(bits.select("bucket", "bits")))
        reached = maybe_members(any_write, spec.member, bits, by=(WRITE,)).select(WRITE).distinct().collect()   # writes at most
        stored = self.scan(table, now, [r[WRITE] for r in reached]).select(spec.member)
        return frame.join(stored, spec.member, "left_anti").select(*frame.columns) if reached else frame

    @staticmethod
    def _part(spec: TableSpec) -> Column:
        """The derived values of a row, as text."""
        return F.struct(*[p.expr().cast("string").alias(p.name) for p in spec.partition])

    @staticmethod
    def _values(parts) -> list[tuple[str | None, ...]]:
        return [tuple(p) for p in parts or ()]

    # ---- writes ----------------------------------------------------------
    def _write(self, table: str, rows: DataFrame, spec: TableSpec, now: Pointer) -> tuple[str, int]:
        """Write ``rows`` into a folder of their own; returns its name and the rows in it."""
        number = 1 + int(now.writes[-1].partition("-")[0]) if now.writes else 0
        name, seen = f"{number:09d}-{uuid.uuid4().hex[:12]}", Observation()
        laid = sorted_for_write(with_partition_columns(rows.select(*spec.columns), spec), spec, seen=seen)
        writer = laid.write.mode("errorifexists")
        if spec.partition:
            writer = writer.partitionBy(*spec.partition_columns)
        folder = f"{self.path(table)}/{DATA}/{WRITE}={name}"
        writer.parquet(folder)
        n = observed(seen, "rows")
        if spec.member and n:
            held = self.spark.read.schema(T.StructType([spec.schema[spec.member]])).parquet(folder)
            key_bits(held, spec.member).write.mode("errorifexists").parquet(f"{self.path(table)}/{MEMBERS}/{WRITE}={name}")
        return name, n

    def append(self, table: str, frame: DataFrame) -> WriteResult:
        """Append rows; they are counted by the tasks that write them.  An append that another writer
        outruns is put on top."""
        started = time.perf_counter()
        spec = self.spec(table)
        rows, name, n = conform(frame, spec.schema), "", 1
        while n:
            now = self.pointer(table)
            if now.writes and not partition_matches(now.layout, spec):
                raise ValueError(f"{table} is laid out otherwise than declared: run create_all or relayout first")
            if not name or now.writes and name <= now.writes[-1]:     # outrun: the write has to come after
                name, n = self._write(table, rows, spec, now)
                continue
            try:
                self._point(table, now, now.added(spec.layout(), name))
                break
            except ConcurrentWrite:
                continue
        return WriteResult(n, 0, round(time.perf_counter() - started, 3))

    def batch_stats(self, frame: DataFrame, spec: TableSpec, *, identity_proven: bool = False) -> dict:
        """One job: batch rows, duplicate identity keys, null identity keys, touched partitions.

        With ``identity_proven`` (a passed report already showed the identity is not null and unique)
        only rows and partitions are needed: a global aggregate with map-side partials, no shuffle of
        the keys."""
        parts = [F.collect_set(self._part(spec)).alias("parts")] if spec.partition else [F.lit(None).alias("parts")]
        if identity_proven:
            row = frame.agg(F.count(F.lit(1)).alias("n"), *parts).first()
            return {"rows": row["n"], "max_per_key": min(row["n"], 1), "null_keys": 0, "parts": self._values(row["parts"])}
        keys = list(spec.identity)
        null_key = F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False))
        of_key = [F.collect_set(self._part(spec)).alias("p")] if spec.partition else []
        row = frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *of_key).agg(
            F.sum("n").alias("rows"), F.max("n").alias("max_per_key"), F.count_if(null_key).alias("null_keys"),
            (F.array_distinct(F.flatten(F.collect_set("p"))) if of_key else F.lit(None)).alias("parts")).first()
        return {"rows": row["rows"] or 0, "max_per_key": row["max_per_key"] or 0, "null_keys": row["null_keys"], "parts": self._values(row["parts"])}

    def upsert(self, table: str, frame: DataFrame, *, identity_proven: bool = False,
               before_commit: Callable[[], None] | None = None) -> WriteResult:
        """Keyed upsert, as a MERGE: a stored row whose key is in the batch takes the batch's values
        (nulls too), a batch row whose key is not stored is put in.  If a key is stored several times,
        each of these rows takes the values.  ``rows_updated`` counts stored rows that change; partitions
        whose rows stay equal are not written, and a batch that changes nothing writes nothing.

        ``identity_proven``: the caller's passed quality report already showed the batch identity is
        not null and unique (skips that shuffle).  ``before_commit`` is called once the data is written.
        """
        started = time.perf_counter()
        spec = self.spec(table)
        if not spec.identity:
            raise ValueError(f"{table} has no identity columns; use append")
        now = self.pointer(table)
        src = conform(frame, spec.schema).persist()
        matched = None
        try:
            stats = self.batch_stats(src, spec, identity_proven=identity_proven)
            if not stats["rows"]:
                return WriteResult()
            if stats["null_keys"]:
                raise ValueError(f"upsert into {table}: {stats['null_keys']} batch rows have a null identity")
            if stats["max_per_key"] > 1:
                raise ValueError(f"upsert into {table}: duplicate identity keys in the batch")
            keys = list(spec.identity)
            others = [c for c in spec.columns if c not in keys]
            by_partition = bool(spec.partition) and partition_matches(now.layout, spec)
            reached = self._reached(table, now, stats["parts"] if spec.partition and spec.identity_determines_partition else None)

            place = F.struct(*[F.col(p).cast("string").alias(p) for p in spec.partition_columns]) if by_partition else F.lit(None)
            stored = reached.select(*keys, F.struct(F.lit(True).alias("here"), *others).alias("_old"), place.alias("_place"))
            differs = ~F.struct(F.lit(True).alias("here"), *others).eqNullSafe(F.col("_old"))
            matched = src.join(stored, keys, "left").select(
                *spec.columns, F.col("_old").isNull().alias("_new"), (F.col("_old").isNotNull() & differs).alias("_changed"), "_place").persist()
            counts = matched.agg(F.count_if("_new").alias("inserted"), F.count_if("_changed").alias("updated"),
                                 F.collect_set(F.when(F.col("_changed"), F.col("_place"))).alias("anew")).first()
            if not counts["inserted"] and not counts["updated"]:
                return WriteResult(0, 0, round(time.perf_counter() - started, 3))

            rows, to = matched.where("_new").select(*spec.columns), now
            anew = self._values(counts["anew"]) if by_partition else []
            if counts["updated"]:
                given = src.select(*keys, F.struct(*others).alias("_given"), F.lit(True).alias("_hit"))
                kept = self._reached(table, now, anew if by_partition else None).join(given, keys, "left")
                rows = rows.unionByName(kept.select(*keys, *[
                    F.when(F.col("_hit"), F.col(f"_given.{c}")).otherwise(F.col(c)).alias(c) for c in others]).select(*spec.columns))
                if not by_partition:
                    to = Pointer(now.layout)         # the write holds the whole table
            name, _ = self._write(table, rows, spec, now)
            if before_commit:
                before_commit()
            self._point(table, now, to.added(spec.layout(), name, anew))
            return WriteResult(counts["inserted"], counts["updated"], round(time.perf_counter() - started, 3))
        finally:
            src.unpersist()
            if matched is not None:
                matched.unpersist()

    def relayout(self, table: str, partition: Sequence[str] | None = None,
                 sort: Sequence[str] | None = None) -> int:
        """Rewrite a table under a new partition/sort layout by one write; data and layout change together.
        Returns rows written."""
        spec, now = self.spec(table), self.pointer(table)
        if partition is not None or sort is not None:
            spec = spec.with_layout(
                tuple(partition) if partition is not None else tuple(f"{p.transform}({p.source})" for p in spec.partition),
                tuple(sort) if sort is not None else tuple(s.column for s in spec.sort))
        name, n = self._write(table, self.scan(table, now), spec, now) if now.writes else ("", 0)
        self._point(table, now, Pointer(spec.layout(), (name,) if n else ()))
        self.specs[spec.identifier] = spec
        return n
