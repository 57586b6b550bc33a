"""Quality rules judged by an isolation forest.

`rule_statistics` counts, per document, what the rules look at: symbols, capitals, marks, doubled words,
the length of words, repeated lines and runs of words.  `allowances` reads off the labelled good rows how far
their ratios go; `IsolationForest` is grown on a bounded sample of what goes further, and
`calibrated_threshold` reads the score beyond which a document is anomalous off the labelled rows: the lowest
one at which at most a stated share of the labelled good documents is lost.  Two fixed rules (too short, too repetitive) stand beside the forest's verdict.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import map_batches, materialize

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30

#: Counts per document.
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_marked", "n_stutter")
#: Rule statistics that the forest sees, none of which depends on a document's length as such: the count, the
#: count that it is divided by, and its sign (-1: low values are the odd ones).
RATIOS = {"symbols_per_word": ("n_symbols", "n_words", 1), "upper_share": ("n_upper", "n_letters", 1), "marked_share": ("n_marked", "n_words", 1),
          "stutter_share": ("n_stutter", "n_words", 1), "long_words": ("word_chars", "n_words", 1), "short_words": ("word_chars", "n_words", -1),
          "dup_line_share": ("n_dup_lines", "n_lines", 1), "repeat_share": ("n_repeat_words", "n_words", 1)}
#: What a ratio may reach whatever the labelled good documents show (a single mark is no sign of junk), and
#: how far beyond theirs it may go, as a part of the way from their median to their upper end.
AT_LEAST = {"symbols_per_word": 0.1, "upper_share": 0.3, "marked_share": 0.1, "stutter_share": 0.1}
SLACK = 0.5

_CAPITALS, _SMALL = bytes(range(0x41, 0x5B)), bytes([*range(0x61, 0x7B), *range(0x80, 0x100)])
_MARKED = [bytes([mark, space]) for mark in b"#*$%&|<>!" for space in b" \n"]

#: Trees, documents a tree is grown on, and documents in the pool the trees draw from.
TREES, SUBSAMPLE, POOL = 100, 128, 8192
#: Labelled documents that the threshold is read off, at most, and the good ones it may lose.
LABELLED, GOOD_LOSS = 20000, 0.002


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that stand in a run of ``window`` words found twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(window):
        total = total * np.uint64(0x9E3779B97F4A7C15) + h[k:k + n]
    total ^= total >> np.uint64(29)
    order = np.argsort(total, kind="stable")
    same = total[order[1:]] == total[order[:-1]]
    if not same.any():
        return 0
    suspects = np.unique(np.concatenate([order[1:][same], order[:-1][same]])).tolist()
    first: dict[tuple, int] = {}
    inside = np.zeros(len(words) + 1, np.int64)
    repeated: set[int] = set()
    for at in suspects:
        run = tuple(words[at:at + window])
        if run in first:
            repeated.update((first[run], at))
        else:
            first[run] = at
    for at in repeated:
        inside[at] += 1
        inside[at + window] -= 1
    return int((np.cumsum(inside) > 0).sum())


def text_counts(text: str | None) -> tuple[int, ...]:
    """``COUNTS`` of a text; a null or empty text has none of anything but for one empty line."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()   # bytes split on ASCII white space only
    lines = text.split("\n")
    dup, seen = 0, set()
    for line in lines:
        if line in seen:
            dup += 1
        elif line.strip(" \t\n\x0b\x0c\r"):
            seen.add(line)
    blank = sum(map(text.count, " \t\n\x0b\x0c\r"))
    without = raw.translate(None, _CAPITALS)
    return (len(words), len(text) - blank, sum(map(text.count, SYMBOLS)), dup, repeated_words(words), len(lines),
            len(raw) - len(without), len(raw) - len(without.translate(None, _SMALL)), sum(map(raw.count, _MARKED)),
            sum(map(eq, words, words[1:])))


STATS = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS])


def rule_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``COUNTS`` of every document (whole texts)."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), *STATS.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [text_counts(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([c[k] for c in counts], pa.int64()) for k in range(len(COUNTS)))],
                                             names=schema.fieldNames())

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), run, schema)


def ratios(counts: np.ndarray) -> np.ndarray:
    """``RATIOS`` from rows of ``COUNTS``."""
    c = dict(zip(COUNTS, np.asarray(counts, float).reshape(-1, len(COUNTS)).T))
    return np.stack([sign * c[a] / np.maximum(c[b], 1) for a, b, sign in RATIOS.values()], 1)


def allowances(good: np.ndarray, loss: float = GOOD_LOSS) -> np.ndarray:
    """How far each ratio may go, read off labelled good documents: the value that ``loss`` of them, shared
    among the ratios, go beyond, and ``SLACK``.  Without any, everything is allowed."""
    if not len(good):
        return np.full(len(RATIOS), np.inf)
    upper = np.quantile(good, 1 - loss / len(RATIOS), axis=0, method="higher")
    return np.maximum(upper + SLACK * (upper - np.median(good, 0)), [AT_LEAST.get(name, -np.inf) for name in RATIOS])


class IsolationForest:
    """Random axis-parallel splits; a point's score is high where few splits isolate it."""

    def __init__(self, points: np.ndarray, trees: int = TREES, subsample: int = SUBSAMPLE, seed: int = 17) -> None:
        rng = np.random.default_rng(seed)
        self.size = min(subsample, len(points))
        self.depth = max(1, int(np.ceil(np.log2(max(self.size, 2)))))
        self.trees = [self._grow(points[rng.choice(len(points), self.size, replace=False)], rng) for _ in range(trees)] if len(points) else []

    @staticmethod
    def expected(n: np.ndarray) -> np.ndarray:
        """Mean path length of an unsuccessful search among ``n`` points."""
        n = np.asarray(n, float)
        return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))

    def _grow(self, points: np.ndarray, rng: np.random.Generator) -> np.ndarray:
        """Nodes as rows: feature (-1: leaf), split, left child, right child, path length there."""
        nodes: list[list[float]] = []

        def add(rows: np.ndarray, depth: int) -> int:
            at = len(nodes)
            nodes.append([-1, 0, at, at, depth + float(self.expected(len(rows)))])
            spread = np.flatnonzero(rows.max(0) > rows.min(0)) if len(rows) > 1 else []
            if depth < self.depth and len(spread):
                f = int(rng.choice(spread))
                split = rng.uniform(rows[:, f].min(), rows[:, f].max())
                left = rows[:, f] < split
                if left.any() and not left.all():
                    nodes[at][:2] = f, split
                    nodes[at][2] = add(rows[left], depth + 1)
                    nodes[at][3] = add(rows[~left], depth + 1)
            return at

        add(points, 0)
        return np.array(nodes)

    def score(self, points: np.ndarray) -> np.ndarray:
        """0 to 1; a half is what a point among uniform ones gets."""
        if not self.trees or not len(points):
            return np.zeros(len(points))
        total = np.zeros(len(points))
        rows = np.arange(len(points))
        for nodes in self.trees:
            feature, left, right = (nodes[:, k].astype(np.int64) for k in (0, 2, 3))
            at = np.zeros(len(points), np.int64)
            for _ in range(self.depth):
                f = feature[at]
                at = np.where(f < 0, at, np.where(points[rows, np.maximum(f, 0)] < nodes[at, 1], left[at], right[at]))
            total += nodes[at, 4]
        return 2.0 ** (-total / len(self.trees) / max(float(self.expected(self.size)), 1e-9))


def bounded_sample(rows: DataFrame, key: str, bound: int) -> DataFrame:
    """About ``bound`` rows, at most, chosen by a hash of ``key``: the same ones at every run."""
    n = rows.count()
    share = min(1.0, bound / max(n, 1))
    return rows.where(F.pmod(F.xxhash64(F.col(key), F.lit("sample")), F.lit(1 << 30)) < int(share * (1 << 30))).orderBy(F.xxhash64(key), key).limit(bound)


def calibrated_threshold(good: np.ndarray, bad: np.ndarray, loss: float = GOOD_LOSS) -> float:
    """The lowest score that at most ``loss`` of the good rows go beyond.

    Bad rows only decide whether there is any use in it: without labelled rows of both kinds, or if
    the bad ones do not go beyond it more often, nothing is anomalous.
    """
    if not len(good) or not len(bad):
        return 1.0
    threshold = float(np.sort(good)[::-1][min(len(good) - 1, int(loss * len(good)))])
    return threshold if (bad > threshold).mean() > max(loss, (good > threshold).mean()) else 1.0


class Rules(NamedTuple):
    """The fixed rules, how far ratios may go, the forest of what goes further, and the score beyond which a
    document is anomalous."""
    allowed: np.ndarray
    forest: IsolationForest
    threshold: float

    def verdicts(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(base_failed, score, kept)`` of rows of ``COUNTS``."""
        words, repeats = (counts[:, COUNTS.index(c)] for c in ("n_words", "n_repeat_words"))
        failed = (words < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * words)
        score = self.forest.score(np.maximum(ratios(counts) - self.allowed, 0))
        return failed, score, ~failed & (score <= self.threshold)


def fitted_rules(stats: DataFrame, labels: DataFrame) -> Rules:
    """Rules fitted to the statistics of all documents: the forest on a sample of at most ``POOL`` of those
    that the fixed rules pass, the threshold on at most ``LABELLED`` of their labelled rows.

    ``labels`` has ``doc_id`` and ``quality`` (1 good, 0 bad; nulls are not used, of contradicting rows
    the bad one counts).
    """
    seen = stats.where((F.col("n_words") >= MIN_WORDS) & (100 * F.col("n_repeat_words") <= MAX_REPEAT_PERCENT * F.col("n_words")))
    matrix = lambda rows: ratios(np.array([[r[c] for c in COUNTS] for r in rows], float).reshape(-1, len(COUNTS)))
    marks = labels.where("quality is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")) \
        .agg(F.min("quality").alias("quality"))
    known = bounded_sample(marks, "doc_id", LABELLED)
    marked = seen.join(F.broadcast(known), "doc_id").dropDuplicates(["doc_id"]).collect()  # LABELLED rows at most
    quality, shown = np.array([r["quality"] for r in marked], int), matrix(marked)
    allowed = allowances(shown[quality == 1])
    forest = IsolationForest(np.maximum(matrix(bounded_sample(seen, "doc_id", POOL).collect()) - allowed, 0))
    scores = forest.score(np.maximum(shown - allowed, 0))
    return Rules(allowed, forest, calibrated_threshold(scores[quality == 1], scores[quality == 0]))


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``COUNTS``, ``base_failed``, ``score`` and ``kept`` of every document.

    A null text has no words and fails.  Repeated and null doc_ids are judged row by row.  With empty
    tables or no labels the fixed rules alone decide.
    """
    stats = materialize(rule_statistics(docs), "quality-statistics")
    held = docs.sparkSession.sparkContext.broadcast(fitted_rules(stats, labels))
    schema = T.StructType([*stats.schema.fields, T.StructField("base_failed", T.BooleanType()), T.StructField("score", T.DoubleType()),
                           T.StructField("kept", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = held.value
        for batch in batches:
            counts = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[1:]], 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, rules.verdicts(counts))], names=schema.fieldNames())

    return map_batches(stats, run, schema)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows that the rules reject; texts are counted again where they are, so no row
    is moved and no text written for it."""
    stats = materialize(rule_statistics(docs), "quality-statistics")
    held = docs.sparkSession.sparkContext.broadcast(fitted_rules(stats, labels))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = held.value
        for batch in batches:
            counts = np.array([text_counts(t.as_py()) for t in batch.column(at)], np.int64).reshape(-1, len(COUNTS))
            yield batch.filter(pa.array(rules.verdicts(counts)[2]))

    return map_batches(docs, run, docs.schema)
