"""WARC archives of pages, and a Merkle fixity audit of their replicas.

`write_warc` / `read_warc` keep records in gzipped WARC files.  The reader takes any such files (one
gzip member or one for each record, versions 1.0 and 1.1): it cuts records by their Content-Length
and gives the file and the offsets, in the unpacked file, of each.  A record of this writer names its
place (a run of at most ``ARCHIVE_RECORDS`` places is an archive), one of another writer is placed by
a hash of its id, so that both replicas place it alike.  `manifest` hashes the records.  `audit` hashes
ordered ranges of records, with the offsets they span, level by level into one tree per replica,
compares the roots, and goes down only where nodes differ, to the records that were changed, are
missing, or are in the replica alone; `audit_folders` does so for replicas in two folders.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import map_batches, materialize

#: Bits of a place that the nodes of a level leave out: 64 records, an archive, then 256 nodes each time.
LEVELS = (6, 12, 20, 28, 36, 44, 52, 60)
ARCHIVE_RECORDS = 1 << LEVELS[1]
BREAK = "\r\n"
START = f"WARC/1.0{BREAK}"
#: Files are read in pieces that end with this, of which bodies may hold any number.
VERSION, BLANK = b"WARC/1.", b"\r\n\r\n"
#: The tables have no time of capture; a fixed one lets reruns agree.
CAPTURED = "1970-01-01T00:00:00Z"

_HEAD = re.compile(rb"[0-9]\r\n[!-9;-~]+:")
_FIELD = re.compile(rb"^(WARC-Record-ID|WARC-Target-URI|WARC-Date|WARC-Type|Content-Length):[ \t]*([^\r\n]*?)[ \t]*\r?$", re.I | re.M)


def _records(pages: DataFrame, captured: str) -> DataFrame:
    body = F.coalesce(F.col("html").cast("string"), F.lit(""))
    head = F.concat(F.lit(f"WARC-Type: response{BREAK}WARC-Record-ID: <urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("none")),
                    F.lit(":"), F.col("place").cast("string"), F.lit(f">{BREAK}WARC-Date: {captured}{BREAK}WARC-Target-URI: "),
                    F.regexp_replace(F.coalesce(F.col("url").cast("string"), F.lit("")), r"[\r\n]", " "),
                    F.lit(f"{BREAK}Content-Type: text/html; charset=utf-8{BREAK}Content-Length: "), F.octet_length(body).cast("string"), F.lit(BREAK * 2), body)
    return pages.select("page_id", "url", "html").withColumn("place", F.monotonically_increasing_id()).select("page_id", "place", head.alias("record"))


def warc_records(pages: DataFrame, captured: str = CAPTURED) -> DataFrame:
    """``(place, record)``: a response record of every page, in the order of the scan.

    ``place`` counts records within a task, above the task's number, so it needs no shuffle.  A null
    url or html is empty; the page's id (null: none) is in the record's id; all have the date ``captured``.
    """
    return _records(pages, captured).select("place", "record")


def write_warc(records: DataFrame, path: str) -> None:
    """One gzipped WARC file for each task."""
    records.select(F.concat(F.lit(START), "record", F.lit(BREAK)).alias("value")).write.option("compression", "gzip") \
        .option("zlib.compress.level", "BEST_SPEED").option("lineSep", BREAK).text(path)


def _needed(start: bytes) -> int | None:
    """Bytes up to the end of the body of a record, by its header; None if that does not say."""
    end = start.find(BLANK)
    length = next((v for k, v in _FIELD.findall(start[:max(end, 0)]) if k.lower() == b"content-length"), b"")
    return end + len(BLANK) + int(length) if length.isdigit() else None


def cut_records(pieces: Iterator[bytes]) -> Iterator[tuple[int, int, bytes, bool]]:
    """``(first, end, record, complete)`` of the records of one file, which comes as what stands between
    its ``VERSION`` marks.  A mark within a header or a body belongs to it.  A record whose length
    does not lead to the next one is incomplete and ends where a header follows a blank line; one
    record is held at a time, or what a wrong length spans."""
    first = len(next(pieces, b""))                     # before the first mark there is no record
    ahead: deque[bytes] = deque()
    while True:
        taken = [ahead.popleft() if ahead else next(pieces, None)]
        if taken[0] is None:
            return
        size, needed, blank = len(taken[0]), None, BLANK in taken[0]
        while True:                                    # the header, then what it says
            if blank and needed is None:
                needed = _needed(VERSION.join(taken))
                if needed is None:
                    break
            if blank and size >= needed:
                break
            piece = ahead.popleft() if ahead else next(pieces, None)
            if piece is None:
                break
            taken.append(piece)
            size += len(VERSION) + len(piece)
            blank = blank or BLANK in piece
        whole = VERSION.join(taken)
        behind = None if needed is None or size < needed else whole[needed:]
        if behind in (b"", b"\r\n") and not ahead and (piece := next(pieces, None)) is not None:
            ahead.append(piece)
        complete = behind == BLANK or (behind in (b"", b"\r\n") and not ahead)         # the file's last may end at once
        if not complete:
            used = 1
            while used < len(taken) and not (taken[used - 1].endswith(BLANK) and _HEAD.match(taken[used])):
                used += 1
            ahead.extendleft(reversed(taken[used:]))
            whole = VERSION.join(taken[:used])
            needed = len(whole) - len(BLANK) * whole.endswith(BLANK)
        end = first + len(VERSION) + len(whole)
        yield first, end, whole[3:needed], complete    # behind the version's last digit and its line break
        first = end


RECORDS = ("file string, first long, end long, record_id string, url string, date string, type string, complete boolean, "
           "digest string, record binary")


def read_records(spark: SparkSession, path: str, bodies: bool = True) -> DataFrame:
    """A row for each record of the gzipped files in a folder (`RECORDS`): its file's name, offsets, header
    fields (empty if missing), SHA-256, and itself without version line (null without ``bodies``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib
        schema = pa.schema([("file", pa.string()), *((n, pa.int64()) for n in ("first", "end")), *((n, pa.string()) for n in ("record_id", "url", "date", "type")),
                            ("complete", pa.bool_()), ("digest", pa.string()), ("record", pa.binary())])
        pieces = ((f.as_py(), v.as_py()) for batch in batches for f, v in zip(*batch.columns))
        rows, held = [], 0
        for file, its in groupby(pieces, key=lambda p: p[0]):
            for first, end, record, complete in cut_records(v for _, v in its):
                said = {k.lower(): v.decode("utf-8", "replace") for k, v in reversed(_FIELD.findall(record.partition(BLANK)[0]))}
                rows.append((file, first, end, *(said.get(k, "") for k in (b"warc-record-id", b"warc-target-uri", b"warc-date", b"warc-type")),
                             complete, hashlib.sha256(record).hexdigest(), record if bodies else None))
                held += len(record) if bodies else 200
                if held > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    lines = spark.read.option("lineSep", VERSION.decode()).option("pathGlobFilter", "*.gz").text(path)
    return map_batches(lines.select(F.col("_metadata.file_name").alias("file"), F.col("value").cast("binary").alias("value")), run, RECORDS)


def placed(records: DataFrame) -> DataFrame:
    """``records`` with ``place`` and ``page_id``: those that this writer put into the id, else a hash of the
    id (of file and offset, if there is none) below 2^62 and null."""
    ours = F.regexp_extract("record_id", r"^<urn:page:[^:>]*:([0-9]{1,18})>$", 1).try_cast("long")
    other = F.shiftrightunsigned(F.when(F.col("record_id") != "", F.xxhash64("record_id")).otherwise(F.xxhash64("file", "first")), 2)
    return records.withColumn("place", F.coalesce(ours, other)) \
        .withColumn("page_id", F.regexp_extract("record_id", r"^<urn:page:([^:>]*):", 1).try_cast("long"))


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """``(place, page_id, url, record, complete)`` of every record, then its ``file``, ``first``, ``end`` and
    ``record_id``; ``complete`` tells whether the body has the length that its header gives."""
    return placed(read_records(spark, path)).select("place", "page_id", "url", F.col("record").cast("string").alias("record"), "complete",
                                                    "file", "first", "end", "record_id")


def manifest(records: DataFrame) -> DataFrame:
    """``(place, archive, first, end, digest)`` of each record: its archive, the bytes it takes there and
    the SHA-256 of its own.  Offsets are summed within an archive, which has a bounded number of records."""
    size = F.octet_length("record").cast("long") + len(START) + len(BREAK * 2)
    sized = records.select("place", F.shiftright("place", LEVELS[1]).alias("archive"), size.alias("size"), F.sha2("record", 256).alias("digest"))
    end = F.sum("size").over(Window.partitionBy("archive").orderBy("place", "digest").rowsBetween(Window.unboundedPreceding, 0))
    return sized.withColumn("end", end).select("place", "archive", (F.col("end") - F.col("size")).alias("first"), "end", "digest")


def _above(nodes: DataFrame, bits: int) -> DataFrame:
    """The nodes of the next level: hashes of what is below, in order, with the bytes that each part
    spans (so a lost record changes the nodes above it, not those that start further back for it)."""
    said = F.concat_ws(":", F.col("node").cast("string"), F.col("bytes").cast("string"), "digest")
    return nodes.groupBy("replica", F.shiftright("node", bits).alias("node")).agg(
        F.sha2(F.concat_ws(",", F.array_sort(F.collect_list(F.struct("node", said.alias("said"))))["said"]), 256).alias("digest"),
        F.sum("bytes").alias("bytes"))


def trees(left: DataFrame, right: DataFrame) -> list[DataFrame]:
    """The levels of both replicas' trees, ``(replica, node, bytes, digest)``, leaves first, up to the one
    with a single node each.  Every node spans an ordered range of offsets and has at most 256 children.
    Records of one place, however many, are one leaf: their number and the sum of their hashes."""
    columns = ("replica", F.col("place").alias("node"), (F.col("end") - F.col("first")).alias("bytes"), "digest")
    both = left.withColumn("replica", F.lit(0)).select(*columns).unionByName(right.withColumn("replica", F.lit(1)).select(*columns))
    many = F.sha2(F.concat_ws(":", F.count("*").cast("string"), F.sum(F.xxhash64("digest", "bytes").cast("decimal(38,0)")).cast("string")), 256)
    leaves = both.groupBy("replica", "node").agg(F.when(F.count("*") == 1, F.min("digest")).otherwise(many).alias("digest"), F.sum("bytes").alias("bytes"))
    levels, done = [materialize(leaves, "warc-leaves")], 0
    for bits in LEVELS:
        levels.append(materialize(_above(levels[-1], bits - done), "warc-level"))
        done = bits
        if levels[-1].select("node").distinct().limit(2).count() <= 1:
            break
    return levels


def audit(left: DataFrame, right: DataFrame) -> DataFrame:
    """The differing records of two manifests: ``(place, status)`` with status ``changed``, ``missing`` (in
    the left one alone) or ``extra``.  Nothing below equal nodes is compared; an empty replica misses
    everything."""
    levels = trees(left, right)
    wanted, below = None, 0
    steps = [0, *LEVELS][:len(levels)]
    for depth in range(len(levels) - 1, -1, -1):
        nodes = levels[depth]
        if wanted is not None:
            nodes = nodes.join(wanted.withColumnRenamed("node", "parent"), F.shiftright("node", below - steps[depth]) == F.col("parent"), "left_semi")
        said = lambda r: F.max(F.when(F.col("replica") == r, F.concat_ws(":", "digest", F.col("bytes").cast("string"))))
        compared = nodes.groupBy("node").agg(said(0).alias("ours"), said(1).alias("theirs")).where("not ours <=> theirs")
        if depth == 0:
            status = F.when(F.col("theirs").isNull(), "missing").when(F.col("ours").isNull(), "extra").otherwise("changed")
            return compared.select(F.col("node").alias("place"), status.alias("status"))
        wanted, below = materialize(compared.select("node"), "warc-differing"), steps[depth]
        if wanted.isEmpty():
            return wanted.select(F.col("node").alias("place"), F.lit("ok").alias("status"))
    raise AssertionError("the leaves end the descent")


def damaged(records: DataFrame, one_in: int = 400) -> DataFrame:
    """A replica with known damage, for audits of the audit: by a hash of a record's id, one in so many is
    changed in one character, and as many are lost."""
    luck = F.pmod(F.xxhash64("page_id", F.lit("damage")), F.lit(one_in))
    flipped = F.concat(F.expr("left(record, length(record) - 1)"), F.when(F.expr("right(record, 1) = 'x'"), "y").otherwise("x"))
    return records.where(luck != 1).withColumn("record", F.when(luck == 0, flipped).otherwise(F.col("record")))


def folder_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The manifest of the files in a folder, read once: places, files, offsets in them, ids and digests."""
    return materialize(placed(read_records(spark, path, bodies=False)).drop("record"), "warc-manifest")


def audit_folders(spark: SparkSession, left: str, right: str) -> DataFrame:
    """`audit` of the archives in two folders, whatever wrote them and however their records are dealt to
    files.  Records of one place (equal ids) are compared together: changed if one of them is, or is missing."""
    return audit(folder_manifest(spark, left), folder_manifest(spark, right))


def fixity_report(pages: DataFrame, path: str) -> DataFrame:
    """Archive the pages (a stored table, scanned alike each time) at ``path`` and a damaged replica beside
    it, read both from their files, audit them: a row for each record, with its file and offsets there."""
    spark = pages.sparkSession
    records = _records(pages, CAPTURED)
    write_warc(records, path)
    write_warc(damaged(records), f"{path}-replica")
    left = folder_manifest(spark, path)
    found = audit(left, folder_manifest(spark, f"{path}-replica"))
    return left.join(materialize(found, "warc-findings"), "place", "left").select(
        "page_id", "place", F.shiftright("place", LEVELS[1]).alias("archive"), "file", "first", "end", "digest", "complete",
        F.coalesce("status", F.lit("ok")).alias("status"))
