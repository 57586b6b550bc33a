"""Benchmark decontamination.

The benchmark's windows of consecutive words are hashed into a set that every task holds; tasks scan
the windows of their own texts, look their hashes up, compare the words of each hit, and report,
cut out or drop what is contaminated.  The set is broadcast in blocks of a stated size, measured
before it is built: a larger benchmark takes more scans of the corpus, never a larger broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.bytewords import ALNUM, windows, words
from tidemark.llm.common import map_batches, materialize

WINDOW = 10
#: Benchmark bytes in one broadcast block.
BLOCK_BYTES = 16 << 20

#: Columns that a scan adds: number of words, hit runs of words (ends exclusive), the same in
#: characters, and the items met.
SCAN = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
    T.StructField("hit_words", T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("end", T.LongType())]))),
    T.StructField("hit_bytes", T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("end", T.LongType())]))),
    T.StructField("items", T.ArrayType(T.LongType())),
])
_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))


class Grams:
    """Windows of benchmark items: hash -> the windows' words and the items that have them."""

    def __init__(self, items: list[tuple[int | None, str]], width: int = WINDOW) -> None:
        self.by_width: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.found: dict[tuple[int, int], list[tuple[bytes, set[int]]]] = {}
        if not items:
            return
        column = pa.array([t for _, t in items], pa.large_string())
        hashes: dict[int, list[int]] = {}
        for part in words(column, ALNUM):
            for k in range(len(part.bounds) - 1):
                lo, hi = int(part.bounds[k]), int(part.bounds[k + 1])
                if lo == hi:
                    continue
                size = min(width, hi - lo)
                item = {items[part.first + k][0]} - {None}
                for at, h in enumerate(windows(part.hash[lo:hi], size).tolist()):
                    text = joined(part, lo + at, size)
                    same = self.found.setdefault((size, h), [])
                    for known, ids in same:
                        if known == text:
                            ids |= item
                            break
                    else:
                        same.append((text, {*item}))
                        hashes.setdefault(size, []).append(h)
        for size, hs in hashes.items():
            values = np.unique(np.array(hs, np.uint64))
            bitmap = np.zeros(1 << 20, bool)
            bitmap[(values >> np.uint64(44)).astype(np.int64)] = True
            self.by_width[size] = (values, bitmap)

    def hits(self, h: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """For each width, the places whose window hash is in the set."""
        for size, (values, bitmap) in self.by_width.items():
            w = windows(h, size)
            maybe = np.flatnonzero(bitmap[(w >> np.uint64(44)).astype(np.int64)])
            at = np.searchsorted(values, w[maybe])
            sure = maybe[values[np.minimum(at, len(values) - 1)] == w[maybe]]
            if len(sure):
                yield size, np.stack([sure, w[sure].view(np.int64)])


def joined(part, first: int, size: int) -> bytes:
    """The words from ``first`` on, with one space between them."""
    return b" ".join(part.data[part.start[k]:part.end[k]].tobytes() for k in range(first, first + size))


def _runs(places: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of half-open runs."""
    out: list[tuple[int, int]] = []
    for first, end in sorted(places):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((first, end))
    return out


def benchmark_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[int | None, str]]]:
    """The benchmark's ``(item_id, text)`` in blocks of about ``block_bytes``, each collected alone.

    Null and empty texts have no window.  The text of a row without an item_id counts as any other.  An item is dealt to a block by the hash of its text, so
    equal texts meet in one block.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")) \
        .where("text is not null").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    for b in range(blocks):
        yield [tuple(r) for r in items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == b).collect()]


def scan(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` plus the columns of ``SCAN`` (which replace columns of the same names).

    A null text has no words.  An item of fewer than ``width`` words, but not none, is one window.
    Items with equal text are all met; one without an item_id counts for ``n_hit`` and adds no id.  With an empty benchmark nothing is hit.
    """
    spark = docs.sparkSession
    base = docs.drop(*SCAN.fieldNames())
    schema = T.StructType([*base.schema.fields, *SCAN.fields])
    names = base.columns
    at = names.index("text")
    out = base
    held = None
    for number, block in enumerate(benchmark_blocks(benchmark, block_bytes)):
        if held is not None:        # end the lineage: one block is held at a time, and one pass over the texts is run
            out = materialize(out, "benchmark-block")
            held.unpersist()
        held = spark.sparkContext.broadcast(Grams(block, width))

        def run(batches: Iterator[pa.RecordBatch], held=held, number=number) -> Iterator[pa.RecordBatch]:
            grams = held.value
            for batch in batches:
                old = batch.select(SCAN.fieldNames()).to_pylist() if number else None
                found = _scan_batch(batch.column(at), grams, old)
                columns = [*(batch.column(k) for k in range(len(names))), *found]
                yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

        out = map_batches(out, run, schema)
    return out


def _scan_batch(column: pa.Array, grams: Grams, old: list[dict] | None) -> list[pa.Array]:
    n_words, n_hit, hit_words, hit_bytes, items = [], [], [], [], []
    for part in words(column, ALNUM):
        hits: dict[int, tuple[list, set]] = {}
        for size, (places, hashes) in grams.hits(part.hash):
            owners = np.searchsorted(part.bounds, places, "right") - 1
            inside = places + size <= part.bounds[owners + 1]
            for place, h, owner in zip(places[inside].tolist(), hashes[inside].view(np.uint64).tolist(), owners[inside].tolist()):
                text = joined(part, place, size)
                for known, ids in grams.found[(size, h)]:
                    if known == text:
                        runs, met = hits.setdefault(owner, ([], set()))
                        runs.append((place, place + size))
                        met.update(ids)
        spans, counts = part.bounds, np.diff(part.bounds)
        # the texts' first bytes, to give places within the text
        for k, count in enumerate(counts.tolist()):
            runs, met = hits.get(k, ((), ()))
            base = int(spans[k])
            local = [(a - base, b - base) for a, b in runs]
            if old:
                before = old[part.first + k]
                local += [(r["first"], r["end"]) for r in before["hit_words"]]
                met = {*met, *before["items"]}
            local = _runs(local)
            n_words.append(count)
            n_hit.append(sum(b - a for a, b in local))
            hit_words.append([{"first": a, "end": b} for a, b in local])
            hit_bytes.append([{"first": int(part.start[base + a]), "end": int(part.end[base + b - 1])} for a, b in local])
            items.append(sorted(met))
        _relative(hit_bytes, part, column)
    return [pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(hit_words, _SPANS),
            pa.array(hit_bytes, _SPANS), pa.array(items, pa.list_(pa.int64()))]


def _relative(hit_bytes: list[list[dict]], part, column: pa.Array) -> None:
    """Byte places of the chunk's last texts, counted from each text's own start."""
    from tidemark.llm.bytewords import texts_of
    count = len(part.bounds) - 1
    if not any(hit_bytes[-count:]):
        return
    offsets = texts_of(column)[0]
    for k in range(count):
        shift = int(offsets[part.first + k] - offsets[part.first])
        for span in hit_bytes[len(hit_bytes) - count + k]:
            span["first"] -= shift
            span["end"] -= shift


def decontaminate(docs: DataFrame, benchmark: DataFrame, action: str = "documents", width: int = WINDOW,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without contaminated documents, or (``action="spans"``) without the passages hit.

    A cut passage takes its words and what stands between them; the text around it stays as it is.
    """
    aside = {c: f"__own_{c}" for c in docs.columns if c in SCAN.fieldNames()}     # the documents' own columns stay
    back = {own: c for c, own in aside.items()}
    docs = docs.withColumnsRenamed(aside)
    found = scan(docs, benchmark, width, block_bytes)
    if action == "documents":
        return found.where("n_hit = 0").select(*docs.columns).withColumnsRenamed(back)
    if action != "spans":
        raise ValueError("action is 'documents' or 'spans'")
    names = docs.columns
    at = names.index("text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for k, spans in enumerate(batch.column(len(names)).to_pylist()):
                if spans:
                    raw, out, last = texts[k].encode(), [], 0
                    for span in spans:
                        out.append(raw[last:span["first"]])
                        last = span["end"]
                    texts[k] = (b"".join(out) + raw[last:]).decode()
            columns = [batch.column(k) for k in range(len(names))]
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return map_batches(found.select(*names, "hit_bytes"), cut, docs.schema).withColumnsRenamed(back)


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Digest of a scan per document."""
    ids = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return scan(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), benchmark).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
