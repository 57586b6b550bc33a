"""Line deduplication by a segment-partition edit join.

Lines count as the same if they are equal or one edit apart (a character put in, left out or changed)
after normalising: lower case, runs of white space as one space, digits as zeros.  Two such lines of
lengths ``n`` and ``n`` or ``n + 1``, cut into threshold-plus-one = 2 segments by the shorter one's
length, agree on a segment; each line's own segments are the index, and the substrings that a line of
length ``n + 1`` can have in their place are the probes.

The part that may differ is then cut again, into eight, and lines must agree on all but one of the
pieces; a group of lines that share a key is compared pair by pair only once it is small.  A large
group goes on being cut, down to one character: then its members are one edit apart by what they
share, and links to the earliest of them are enough.  So no key, however common, makes pairs of all its lines.
Candidates are verified by banded bit-parallel edit distance.

Lines are known by 64-bit hashes (with their lengths); a line is a repeat if an equal line, or one
that is one edit apart, stands earlier: in a document with a smaller doc_id, or above it in its own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, materialize, small_or_shuffled

THRESHOLD = 1
#: Shorter lines (normalised) have no lines one edit apart: one edit is much of them.  Their equal lines count
#: from ``min_exact`` characters on: as long as that by default, every line that is not blank in the query and the pipeline.
MIN_CHARS = 20
ANY_LINE = 1
#: Lines of a key that are compared pair by pair, pieces a part is cut into, rows of a broadcast.
PAIRED, PIECES, BROADCAST_ROWS = 24, 8, 200_000
#: Columns that stand beside those of the documents for a while.
_ROW, _REPEATS = "__line_row", "__line_repeats"

_DIGITS = re.compile(r"[1-9]")


def normalised(line: str) -> str:
    line = " ".join(line.lower().split())
    return _DIGITS.sub("0", line) if _DIGITS.search(line) else line


def line_hash(line: str) -> int:
    return _signed(xxhash.xxh3_64_intdigest(line.encode("utf-8", "surrogatepass")) ^ len(line))


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def part_key(line: str, length: int, lo: int, hi: int) -> int:
    """Key of what a line has beside ``[lo, hi)``, the place of the edit, as a line of ``length``
    counts it (the line itself may have one character more)."""
    longer = len(line) - length
    rest = f"{length}:{lo}:{hi}:{line[:lo]}\0{line[hi + longer:]}"
    return _signed(xxhash.xxh3_64_intdigest(rest.encode("utf-8", "surrogatepass")))


def pieces_of(lo: int, hi: int, n: int = PIECES) -> list[tuple[int, int]]:
    """``[lo, hi)`` in at most ``n`` pieces of nearly equal lengths."""
    n = max(1, min(n, hi - lo))
    cuts = [lo + (hi - lo) * k // n for k in range(n + 1)]
    return list(zip(cuts[:-1], cuts[1:]))


def edits_within(a: str, b: str, k: int) -> bool:
    """Whether at most ``k`` edits turn ``a`` into ``b``: bit-parallel, in a band about the diagonal.

    What both have in front and behind is left out first.  Bit ``i`` of the vectors is row
    ``j - k + i`` of column ``j``, so they hold the band only and move down a row with each column.
    """
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > k:
        return False
    front = 0
    for x, y in zip(a, b):
        if x != y:
            break
        front += 1
    a, b = a[front:], b[front:]
    behind = 0
    while behind < len(a) and a[-1 - behind] == b[-1 - behind]:
        behind += 1
    a, b = a[:len(a) - behind], b[:len(b) - behind]
    if not a:
        return len(b) <= k
    rows, width = len(a), 2 * k + 1
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << (i + k)      # shifted by k: bit 0 of the first band is row 1 - k
    full = (1 << width) - 1
    # vertical differences down the band: rises below the first row, falls above it (there are no rows there)
    rise, fall = full & ~((1 << k) - 1), 0
    bottom = min(k, rows)                              # distance on the band's lowest diagonal, or in the last row
    last = width - 1
    for j, c in enumerate(b):
        same = (where.get(c, 0) >> j) & full
        carry = (((same & rise) + rise) ^ rise) | same | fall
        level = carry & full                           # cells no worse than their upper left neighbour
        across_up = (fall | ~(level | rise)) & full
        across_down = level & rise
        if j + k + 1 <= rows:
            bottom += not level >> last & 1
            if bottom > 2 * k + len(b) - rows:
                return False
        else:                                          # past the last row: along it, a bit higher each time
            at = last - (j + k + 1 - rows)
            bottom += (across_up >> at & 1) - (across_down >> at & 1)
        moved = level >> 1
        rise = (across_down | ~(moved | across_up)) & full
        fall = moved & across_up
    return bottom <= k


OCCURRENCES = "rid long, doc_id long, line_no int, line long, n int, keys array<long>"


def occurrences(docs: DataFrame, min_chars: int, min_exact: int) -> DataFrame:
    """Every line of ``min_exact`` or more: its document and place, hash, length, and from ``min_chars`` on four keys:
    its two segments, then what it has in the place of those of a line one character shorter."""
    least = max(1, min(min_chars, min_exact))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(k, 1000) for whole in batches for k in range(0, len(whole), 1000)):
            out: tuple[list, ...] = ([], [], [], [], [], [])
            for rid, doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                for number, line in enumerate((text.as_py() or "").split("\n")):
                    if len(line) < least or len(line := normalised(line)) < least:
                        continue
                    n = len(line)
                    half, shorter = n // 2, (n - 1) // 2
                    keys = None if n < min_chars else [
                        part_key(line, n, half, n), part_key(line, n, 0, half),
                        part_key(line, n - 1, shorter, n - 1), part_key(line, n - 1, 0, shorter)]
                    for column, value in zip(out, (rid, doc, number, line_hash(line), n, keys)):
                        column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names=["rid", "doc_id", "line_no", "line", "n", "keys"])

    return map_batches(docs.select("rid", "doc_id", "text"), run, OCCURRENCES)


def _texts(docs: DataFrame, wanted: DataFrame, min_chars: int) -> DataFrame:
    """``(line, body)`` of the wanted ``(line, rid)``: a line's hash and the row of one of its documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(k, 1000) for whole in batches for k in range(0, len(whole), 1000)):
            found = {}
            for text in batch.column(0):
                for line in (text.as_py() or "").split("\n"):
                    if len(line) >= min_chars and len(line := normalised(line)) >= min_chars:
                        found[line_hash(line)] = line
            yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.int64()), pa.array(found.values(), pa.string())], names=["line", "body"])

    theirs = docs.join(small_or_shuffled(wanted.select("rid").distinct(), BROADCAST_ROWS), "rid", "left_semi").select("text")
    rows = map_batches(theirs, run, "line long, body string")
    return rows.join(small_or_shuffled(wanted.select("line"), BROADCAST_ROWS), "line", "left_semi").groupBy("line").agg(F.min("body").alias("body"))


PARTS = "key long, line long, length int, lo int, hi int, longer boolean"


def _cut(parts: DataFrame, bodies: DataFrame) -> DataFrame:
    """The rows ``(line, length, lo, hi)`` with their open part cut into pieces.  A part of one
    character becomes leaves: the line's rest alone (``hi = lo``: same length, one character apart)
    and its rest with each character it has there (``hi < lo``: against a longer line)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [], [])

            def add(*row) -> None:
                for column, value in zip(out, row):
                    column.append(value)

            for line, body, length, lo, hi in zip(*(batch.column(k).to_pylist() for k in range(5))):
                longer = len(body) > length
                if hi - lo > 1:
                    for a, b in pieces_of(lo, hi):
                        add(part_key(body, length, a, b), line, length, a, b, longer)
                elif hi - lo == 1:
                    rest = part_key(body, length, lo, hi)
                    if not longer:
                        add(rest, line, length, lo, lo, longer)
                    for c in set(body[lo:hi + longer]):
                        add(_signed(xxhash.xxh3_64_intdigest(f"{rest}:{c}".encode("utf-8", "surrogatepass"))), line, length, lo, lo - 1, longer)
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names=["key", "line", "length", "lo", "hi", "longer"])

    rows = parts.join(bodies, "line").select("line", "body", "length", "lo", "hi")
    return map_batches(rows, run, PARTS)


def _verified(pairs: DataFrame, bodies: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` of lines that are one edit apart."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.select(["a", "b"]).filter(pa.array(
                [edits_within(x, y, THRESHOLD) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())], pa.bool_()))

    both = (pairs.join(bodies.select(F.col("line").alias("a"), F.col("body").alias("x")), "a")
            .join(bodies.select(F.col("line").alias("b"), F.col("body").alias("y")), "b").select("a", "b", "x", "y"))
    return map_batches(both, run, "a long, b long")


def line_links(docs: DataFrame, lines: DataFrame, min_chars: int) -> DataFrame:
    """Links ``(a, b)`` between hashes of lines that are one edit apart.  Within a large group whose
    lines are all alike but for one character, each is linked with the earliest only."""
    half = lambda n: F.floor(n / 2).cast("int")
    n, m = F.col("n"), F.col("n") - 1
    part = lambda k, length, lo, hi: F.struct(F.col("keys")[k].alias("key"), length.cast("int").alias("length"),
                                              lo.cast("int").alias("lo"), hi.cast("int").alias("hi"))
    start = lines.where(n >= min_chars).select("line", F.inline(F.array(part(0, n, half(n), n), part(1, n, F.lit(0), half(n)),
                                                  part(2, m, half(m), m), part(3, m, F.lit(0), half(m)))))
    shared = start.groupBy("key").agg(F.min("line").alias("low"), F.max("line").alias("high")).where("low < high").select("key")
    parts = materialize(start.join(shared, "key").select("line", "length", "lo", "hi"), "lines-parts")
    wanted = materialize(lines.select("line", "rid").join(parts.select("line").distinct(), "line"), "lines-wanted")
    bodies = materialize(_texts(docs, wanted, min_chars), "lines-bodies")

    pairs, links = [], []
    while True:
        cut = materialize(_cut(parts, bodies), "lines-cut")
        groups = cut.groupBy("key").agg(F.min("line").alias("low"), F.max("line").alias("high"), F.count("*").alias("members"),
                                        F.min(F.when(~F.col("longer"), F.col("line"))).alias("centre")).where("low < high")
        held = materialize(cut.join(groups.select("key", "members", "centre"), "key"), "lines-groups")
        # leaves: one edit apart by what they share
        alike = held.where("hi = lo").join(lines.select("line", "place"), "line")
        earliest = alike.groupBy("key").agg(F.min_by("line", "place").alias("earliest"))
        links.append(alike.join(earliest, "key").where("line <> earliest").select(F.col("earliest").alias("a"), F.col("line").alias("b")))
        links.append(held.where("hi < lo and centre is not null and line <> centre").select(F.col("centre").alias("a"), F.col("line").alias("b")))
        small = held.where((F.col("hi") > F.col("lo")) & (F.col("members") <= PAIRED)).select("key", "line")
        pairs.append(small.alias("s").join(small.alias("t"), "key").where("s.line < t.line").select(F.col("s.line").alias("a"), F.col("t.line").alias("b")))
        large = held.where((F.col("hi") > F.col("lo")) & (F.col("members") > PAIRED)).select("line", "length", "lo", "hi").distinct()
        parts = materialize(large, "lines-parts")
        if parts.isEmpty():
            break
    found = _verified(_union(pairs).distinct(), bodies)
    return found.unionByName(_union(links)).distinct()


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def repeated_lines(documents: DataFrame, min_chars: int = MIN_CHARS, out: str = "repeats", min_exact: int | None = None) -> DataFrame:
    """``documents`` plus ``repeats`` (or as ``out`` names it): the numbers (from 0, by \\n) of the lines that stand earlier.

    Equal lines count from ``min_exact`` characters on (``min_chars`` if None; blank lines never do),
    lines one edit apart if both have ``min_chars`` or more.
    Rows of one doc_id count as one document and are ordered by line only; rows without a doc_id come
    after all others, as one document.  A null text has no lines; other columns go through, a column
    of that name is replaced.
    """
    base = documents.drop(out)
    docs = base.withColumn(_ROW, F.xxhash64(F.col("doc_id").cast("long"), F.col("text")))
    plain = docs.select(F.col(_ROW).alias("rid"), F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("doc_id"), F.col("text").cast("string").alias("text"))
    seen = materialize(occurrences(plain, min_chars, min_chars if min_exact is None else min_exact), "lines-seen")
    place = (F.col("doc_id").cast("decimal(28,0)") * F.lit(1 << 31).cast("decimal(10,0)") + F.col("line_no")).cast("decimal(38,0)")
    lines = materialize(seen.groupBy("line").agg(F.min(place).alias("place"), F.min_by("rid", place).alias("rid"), F.count("*").alias("times"),
                                                 F.max("n").alias("n"), *(F.max(F.col("keys")[k]).alias(f"k{k}") for k in range(4)))
                        .select("line", "place", "rid", "times", "n", F.array("k0", "k1", "k2", "k3").alias("keys")), "lines-distinct")
    links = materialize(line_links(plain, lines, min_chars), "lines-links")
    near = (links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
            .join(lines.select(F.col("line").alias("b"), F.col("place").alias("theirs")), "b").groupBy("a").agg(F.min("theirs").alias("theirs")))
    first = (lines.join(near.withColumnRenamed("a", "line"), "line", "left").where("times > 1 or theirs < place")
             .select("line", F.least("place", "theirs").alias("first")))
    again = materialize(seen.select("rid", "line", "line_no", place.alias("place")).join(first, "line").where("place > first")
                        .groupBy("rid").agg(F.array_sort(F.collect_set("line_no")).alias("repeats")), "lines-repeats")
    named = again.select(F.col("rid").alias(_ROW), F.col("repeats").alias(out))
    found = docs.join(named.hint("merge"), _ROW, "left")        # the same join at every size
    return found.select(*base.columns, F.coalesce(out, F.array().cast("array<int>")).alias(out))


def _kept_lines(text: str | None, repeats: list[int]) -> str | None:
    """The text without the lines of these numbers."""
    if not repeats:
        return text
    gone = set(repeats)
    return "\n".join([line for k, line in enumerate(text.split("\n")) if k not in gone])


def _without(found: DataFrame, repeats: str, text: str = "text") -> DataFrame:
    """``found`` with each text freed of its repeats, in time that grows with its lines alone."""
    names = found.columns
    at, which = names.index(text), names.index(repeats)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            if pc.any(pc.greater(pc.list_value_length(columns[which]), 0)).as_py():
                kept = [t.as_py() if not len(r) else _kept_lines(t.as_py(), r.as_py()) for t, r in zip(columns[at], columns[which], strict=True)]
                columns[at] = pa.array(kept, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return map_batches(found, run, found.schema)


def deduplicated_lines(documents: DataFrame, min_chars: int = MIN_CHARS, min_exact: int | None = None) -> DataFrame:
    """``documents`` without the lines that stand earlier; a document that has nothing but white space
    left, and had repeats, goes."""
    found = _without(repeated_lines(documents, min_chars, _REPEATS, min_exact), _REPEATS)
    return found.where((F.size(_REPEATS) == 0) | (F.length(F.trim(F.regexp_replace("text", r"\s+", " "))) > 0)).select(*documents.columns)


def line_report(documents: DataFrame, min_exact: int | None = None) -> DataFrame:
    """Per document the number of lines, of repeats, and its text without them."""
    found = repeated_lines(documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), min_exact=min_exact)
    counted = found.withColumn("n_lines", F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n"))).cast("long"))
    return _without(counted, "repeats").select("doc_id", "n_lines", F.size("repeats").cast("long").alias("n_repeats"), "repeats", "text")
