"""N-gram Jaccard join by prefix filtering under several global token orders.

A document's set is its distinct word n-grams (hashed to 64 bits).  Two sets whose Jaccard
similarity reaches the threshold must share one of their first ``s - ceil(t * s) + 1`` tokens under
*every* global order of tokens.  The first order puts tokens that are rare in the corpus first (by
counts in a sketch over all documents), so a prefix seldom holds a common token; pairs
that share a prefix token there, at places that leave enough tokens for the overlap, must also share
a prefix token under the other orders and pass a parity bitmap before their sets are compared.  The second order
breaks ties among equally rare tokens otherwise, the third is a hash of the token whatever its count: a pair that
shares rare tokens by chance seldom shares a prefix there.

Equal sets are one class from the start.  A token's classes are first linked to one pivot, the class
that has the token earliest; only classes that this leaves outside the pivot's component are joined
with the token's other classes, so a group of near copies costs links in proportion to its members
and no link between components is lost.

Token hashes have 64 bits; equal hashes of different n-grams are taken as equal.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bytewords import NOT_SPACE, mix, windows, words
from tidemark.llm.common import components, map_batches, materialize, small_or_shuffled

#: The sketch has a counter for every so many tokens of the corpus, 2 ** 16 to 2 ** 26 of them (one byte
#: each in a task); it is summed in parts of 2 ** 16.
TOKENS_A_COUNTER, SKETCH_BITS, PART_BITS = 8, (16, 26), 16
#: Ratio between the sizes that begin a size class.
SIZE_STEP = 1.1
#: Rows of a side that is broadcast (each one or two longs).
BROADCAST_ROWS = 200_000
#: Classes that one task compares with one class.
STAR_SPLIT = 2000
PARITY_WORDS = 8


def needed(n_sum: int | np.ndarray, percent: int) -> int | np.ndarray:
    """Least overlap of two sets with ``n_sum`` tokens together: 100 * overlap >= percent * union."""
    return -(-percent * n_sum // (100 + percent))


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _sets(column: pa.Array, n_gram: int) -> Iterator[tuple[int, np.ndarray]]:
    """``(place in the batch, sorted distinct token hashes)`` of each text."""
    for part in words(column, NOT_SPACE):
        grams = windows(part.hash, n_gram)
        for k, (lo, hi) in enumerate(zip(part.bounds[:-1].tolist(), part.bounds[1:].tolist())):
            if hi - lo >= n_gram:
                yield part.first + k, np.unique(grams[lo:hi - n_gram + 1])
            else:
                yield part.first + k, windows(part.hash[lo:hi], hi - lo) if hi > lo else grams[:0]


def _key(tokens: np.ndarray) -> int:
    """A 64-bit key of a set."""
    h = mix(np.array([mix(tokens).sum(), mix(tokens ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(), len(tokens)], np.uint64))
    return int(mix(h[:1] * np.uint64(3) + h[1:2] * np.uint64(5) + h[2:]).view(np.int64)[0])


SIZES = "doc_id long, n_shingles long, k long, part int, counts binary"


def sketch_bits(docs: DataFrame) -> int:
    """Counters (as a power of two) by the size of the corpus, a token being six bytes or so."""
    tokens = (docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / 6
    return min(max(int(np.ceil(np.log2(max(tokens / TOKENS_A_COUNTER, 1)))), SKETCH_BITS[0]), SKETCH_BITS[1])


def set_sizes(docs: DataFrame, n_gram: int, bits: int) -> DataFrame:
    """Per document the size and key of its set (null key: empty), and at the end of each task the
    parts of its count sketch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << bits, np.uint8)
        for batch in batches:
            n, keys, waiting, held = [], [], [], 0
            for _, tokens in _sets(batch.column(1), n_gram):
                n.append(len(tokens))
                keys.append(_key(tokens) if len(tokens) else None)
                waiting.append(tokens)
                held += len(tokens)
                if held >= 1 << 19:
                    _count(counts, waiting)
                    waiting, held = [], 0
            _count(counts, waiting)
            yield _batch([batch.column(0), pa.array(n, pa.int64()), pa.array(keys, pa.int64()),
                          pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary())], SIZES)
        for part in range(1 << bits - PART_BITS):
            own = counts[part << PART_BITS:part + 1 << PART_BITS]
            if own.any():
                yield _batch([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([part], pa.int32()),
                              pa.array([zlib.compress(own.tobytes(), 1)], pa.binary())], SIZES)

    return map_batches(docs, run, SIZES)


def _count(counts: np.ndarray, waiting: list[np.ndarray]) -> None:
    """Add tokens to a task's counters, which stay at 255 once there."""
    if waiting:
        slots, times = np.unique(_slot(np.concatenate(waiting), counts), return_counts=True)
        counts[slots] = np.minimum(counts[slots] + times, 255)


def _slot(tokens: np.ndarray, counters: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(65 - len(counters).bit_length())).astype(np.int64)


def _batch(columns: list, schema: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in schema.split(", ")])


def commonness(sizes: DataFrame, bits: int) -> np.ndarray:
    """How common the tokens of each counter are: the bit length of the counter's sum over all tasks.

    The parts are summed as they stream by, one array for each part; the result has a fixed size.
    """
    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = np.frombuffer(zlib.decompress(counts), np.uint8)
                sums[part] = sums[part] + own if part in sums else own.astype(np.int64)
        for part, own in sums.items():
            length = np.ceil(np.log2(own + 1)).astype(np.uint8)
            yield _batch([pa.array([part], pa.int32()), pa.array([length.tobytes()], pa.binary())], "part int, bits binary")

    parts = sizes.where("part is not null").select("part", "counts").repartition("part")
    levels = np.zeros(1 << bits, np.uint8)
    for row in map_batches(parts, total, "part int, bits binary").collect():
        levels[row[0] << PART_BITS:row[0] + 1 << PART_BITS] = np.frombuffer(bytes(row[1]), np.uint8)
    return levels


def _ordered(tokens: np.ndarray, levels: np.ndarray, order: int) -> np.ndarray:
    """Sorted ranks of the tokens under a global order: rare ones first, then by a hash of the order; from the
    third order on by a hash alone, which has nothing in common with the first two."""
    level = levels[_slot(tokens, levels)].astype(np.uint64)
    tie = tokens if order == 0 else mix(tokens ^ np.uint64(order * 0x5851F42D4C957F2D & 0xFFFFFFFFFFFFFFFF))
    if order > 1:
        return np.sort(tie)
    return np.sort(level << np.uint64(58) | tie >> np.uint64(6))


PREFIXES = "doc_id long, k long, n int, first array<long>, parity array<long>, others array<array<int>>"


def prefixes(docs: DataFrame, levels, n_gram: int, percent: int, orders: int) -> DataFrame:
    """The prefixes and the parity bitmap of each document whose set can have a link to another set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = levels.value
        for batch in batches:
            ids = batch.column(0).to_pylist()
            out: tuple[list, ...] = ([], [], [], [], [], [])
            for at, tokens in _sets(batch.column(1), n_gram):
                n = len(tokens)
                if needed(2 * n + 1, percent) > n and needed(2 * n - 1, percent) > n - 1:
                    continue  # empty, or only an equal set could reach the threshold
                p = prefix_length(n, percent)
                parity = np.bincount((tokens & np.uint64(64 * PARITY_WORDS - 1)).astype(np.int64), minlength=64 * PARITY_WORDS) & 1
                row = (ids[at], _key(tokens), n, _ordered(tokens, common, 0)[:p].view(np.int64),
                       np.packbits(parity.astype(np.uint8)).view(np.int64),
                       [(_ordered(tokens, common, r)[:p] >> np.uint64(16)).astype(np.uint32).view(np.int32) for r in range(1, orders)])
                for column, value in zip(out, row):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.list_(pa.int32())))
            yield _batch([pa.array(c, t) for c, t in zip(out, kinds)], PREFIXES)

    return map_batches(docs, run, PREFIXES)


def _needed(n_sum, percent: int):
    return F.ceil(n_sum * F.lit(percent) / F.lit(100 + percent))


def _reachable(a: str, b: str, percent: int):
    """Whether the sizes and the places of a shared token leave enough tokens for the overlap."""
    left = F.least(F.col(f"{a}.n") - F.col(f"{a}.pos"), F.col(f"{b}.n") - F.col(f"{b}.pos"))
    return left >= _needed(F.col(f"{a}.n") + F.col(f"{b}.n"), percent)


def _plausible(pairs: DataFrame, sets: DataFrame, percent: int, orders: int) -> DataFrame:
    """The pairs ``(a, b)`` that pass sizes, the parity bitmap and the other orders' prefixes."""
    info = sets.select("k", "n", "parity", "others")
    a, b = (info.select(*(F.col(c).alias(f"{c}_{s}") for c in info.columns)) for s in "ab")
    both = pairs.join(a, F.col("a") == F.col("k_a")).join(b, F.col("b") == F.col("k_b"))  # one row for each class: no key is hot
    n_sum = F.col("n_a") + F.col("n_b")
    overlap = _needed(n_sum, percent)
    differing = sum((F.bit_count(F.col("parity_a")[i].bitwiseXOR(F.col("parity_b")[i])) for i in range(PARITY_WORDS)), F.lit(0))
    keep = (F.least("n_a", "n_b") >= overlap) & (differing <= n_sum - 2 * overlap)
    for r in range(orders - 1):
        keep = keep & F.arrays_overlap(F.col("others_a")[r], F.col("others_b")[r])
    return both.where(keep).select("a", "b").distinct()


def _verified(pairs: DataFrame, docs: DataFrame, sets: DataFrame, n_gram: int, percent: int, purpose: str) -> DataFrame:
    """The pairs whose sets reach the threshold.

    Sets are made anew for the documents in question only.  Each pair's second set travels to the
    first one's task, which holds one set at a time; the partners of a class with many of them are
    split over several tasks, the class's own set going to each.
    """
    spark = docs.sparkSession
    ends = pairs.select(F.col("a").alias("k")).union(pairs.select(F.col("b").alias("k"))).distinct()
    wanted = materialize(sets.select("k", "doc_id").join(ends, "k").groupBy("k").agg(F.min("doc_id").alias("doc_id")), f"{purpose}-wanted")
    asked = small_or_shuffled(wanted.select("doc_id").distinct(), BROADCAST_ROWS)

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [(_key(t), t.tobytes()) for _, t in _sets(batch.column(1), n_gram) if len(t)]
            yield _batch([pa.array([k for k, _ in made], pa.int64()), pa.array([t for _, t in made], pa.binary())], "k long, tokens binary")

    theirs = docs.join(asked.withColumnRenamed("doc_id", "asked"), F.col("doc_id").eqNullSafe(F.col("asked")), "left_semi")
    full = materialize(map_batches(theirs, tokens, "k long, tokens binary").join(ends, "k", "left_semi"), f"{purpose}-sets")
    salted = pairs.groupBy("a").agg(F.ceil(F.count("*") / STAR_SPLIT).cast("int").alias("salts"))
    heads = (salted.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
             .join(full, F.col("a") == F.col("k")).select("a", "salt", F.lit(None).cast("long").alias("b"), "tokens"))
    others = (pairs.join(salted, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int"))
              .join(full, F.col("b") == F.col("k")).select("a", "salt", "b", "tokens"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, own = None, None
        for batch in batches:
            links: list[tuple[int, int]] = []
            for a, b, raw in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3)):
                t = np.frombuffer(raw.as_buffer(), np.uint64)
                if b is None:
                    head, own = a, t.copy()
                elif a == head:
                    shared = len(own) + len(t) - len(np.union1d(own, t))
                    if 100 * shared >= percent * (len(own) + len(t) - shared):
                        links.append((a, b))
            yield _batch([pa.array([a for a, _ in links], pa.int64()), pa.array([b for _, b in links], pa.int64())], "u long, v long")

    rows = heads.union(others).repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    return materialize(map_batches(rows, compare, "u long, v long").distinct(), f"{purpose}-links")


def jaccard_components(documents: DataFrame, n_gram: int = 3, percent: int = 90, orders: int = 3) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` of every document.

    Words are maximal runs of all but ASCII white space, A-Z lower-cased.  A document of fewer words
    than ``n_gram`` has its whole sequence as its only token; one without words (or a null text) has
    none and links with nothing.  ``component_id`` is the smallest doc_id among the documents that
    links reach (a null doc_id counts only where there is no other).  Rows with one doc_id and
    different texts are linked by their texts only, and each has a row in the result.
    """
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    bits = sketch_bits(docs)
    sizes = materialize(set_sizes(docs, n_gram, bits), "jaccard-sizes")
    levels = spark.sparkContext.broadcast(commonness(sizes, bits))
    rows = sizes.where("part is null").select("doc_id", "n_shingles", "k")
    first = rows.where("k is not null").groupBy("k").agg(F.min("doc_id").alias("low"), F.count("*").alias("n"))

    # one document of each class of equal sets goes on: documents that stand for no class are not read again, and
    # of those that stand for some (rows of one doc_id may have different texts) the other classes are left out after
    spare = materialize(rows.join(first.where("n > 1"), "k").where("doc_id > low").select("doc_id", "k").distinct(), "jaccard-spare")
    theirs = rows.where("k is not null").join(small_or_shuffled(spare.select("doc_id").distinct(), BROADCAST_ROWS), "doc_id", "left_semi")
    mixed = small_or_shuffled(materialize(theirs.join(spare, ["doc_id", "k"], "left_anti").select("doc_id").distinct(), "jaccard-mixed"), BROADCAST_ROWS)
    doubles = materialize(spare.select("doc_id").distinct().join(mixed, "doc_id", "left_anti"), "jaccard-doubles")
    single = docs.join(small_or_shuffled(doubles, BROADCAST_ROWS), "doc_id", "left_anti")
    others = small_or_shuffled(materialize(spare.join(mixed, "doc_id", "left_semi"), "jaccard-others"), BROADCAST_ROWS)
    sets = materialize(prefixes(single, levels, n_gram, percent, orders).join(others, ["doc_id", "k"], "left_anti"), "jaccard-prefixes")

    # pivots: of the classes that share a token, the one that has it earliest
    at = sets.select("k", "n", F.posexplode("first").alias("pos", "token"))
    slim = at.select("token", "k", (F.shiftleft(F.col("pos").cast("long"), 40).bitwiseOR(F.col("k").bitwiseAND(F.lit((1 << 40) - 1)))).alias("place"))
    shared = slim.groupBy("token").agg(F.min_by("k", "place").alias("pivot"), F.min("k").alias("low"), F.max("k").alias("high")) \
        .where("low < high").select("token", "pivot")
    held = materialize(at.join(shared, "token").select("token", "k", "n", "pos", "pivot"), "jaccard-shared")

    stars = held.where("k <> pivot").select(F.least("k", "pivot").alias("a"), F.greatest("k", "pivot").alias("b")).distinct()
    stars = materialize(_plausible(stars, sets, percent, orders), "jaccard-stars")
    links = _verified(stars, docs, sets, n_gram, percent, "jaccard-star")
    comps = materialize(components(links, "jaccard-components"), "jaccard-first")

    # what the pivots leave: classes outside the pivot's component, with all other classes of the token
    named = (held.join(comps.withColumnsRenamed({"node": "k", "component": "own"}), "k", "left")
             .join(comps.withColumnsRenamed({"node": "pivot", "component": "centre"}), "pivot", "left")
             .select("token", "k", "n", "pos", F.coalesce("own", "k").alias("own"), F.coalesce("centre", "pivot").alias("centre")))
    named = materialize(named, "jaccard-named")
    size_class = lambda n: F.floor(F.log(n.cast("double")) / F.log(F.lit(SIZE_STEP))).cast("int")
    # the most tokens that a partner can have beside those that stand before the shared one
    most = F.least(F.floor(F.col("n") * 100 / percent),
                   F.floor((F.col("n") - F.col("pos")) * (100 + percent) / percent) - F.col("n"))
    ask = (named.where("own <> centre").withColumn("most", most).where(F.col("most") >= F.ceil(F.col("n") * percent / 100))
           .withColumn("size", F.explode(F.sequence(size_class(F.ceil(F.col("n") * percent / 100)), size_class(F.col("most"))))))
    rest = (ask.alias("x").join(named.withColumn("size", size_class(F.col("n"))).alias("y"), ["token", "size"])
            .where((F.col("x.own") != F.col("y.own")) & _reachable("x", "y", percent))
            .select(F.least("x.k", "y.k").alias("a"), F.greatest("x.k", "y.k").alias("b")).distinct())
    rest = materialize(_plausible(materialize(rest, "jaccard-rest"), sets, percent, orders), "jaccard-other")
    more = _verified(rest, docs, sets, n_gram, percent, "jaccard-other")
    comps = components(links.unionByName(more), "jaccard-components")

    classes = first.select("k", "low").join(comps.withColumnRenamed("node", "k"), "k", "left") \
        .withColumn("component", F.coalesce("component", "k"))
    classes = materialize(classes, "jaccard-classes")
    lowest = classes.groupBy("component").agg(F.min("low").alias("component_id"))
    found = classes.join(lowest, "component").select("k", "component_id")
    linked = rows.where("k is not null").join(found, "k").select("doc_id", "n_shingles", "component_id")
    alone = rows.where("k is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)


def one_of_each(documents: DataFrame, n_gram: int = 3, percent: int = 90, orders: int = 2) -> DataFrame:
    """``documents`` with one document of each component: that with its smallest doc_id.

    Rows that share a doc_id stay or go together, and stay if any of them would; so do rows without
    one, which stay if a component has no other.  A document without words stays, linked with nothing.
    """
    named = materialize(jaccard_components(documents, n_gram, percent, orders).select("doc_id", F.expr("doc_id <=> component_id").alias("stays")),
                        "jaccard-named")
    gone = materialize(named.groupBy(F.col("doc_id").alias("__gone")).agg(F.max("stays").alias("stays")).where("not stays").select("__gone"), "jaccard-gone")
    gone = small_or_shuffled(gone, BROADCAST_ROWS)
    return documents.join(gone, documents["doc_id"].cast("long").eqNullSafe(gone["__gone"]), "left_anti")
