"""Best-fit packing of tokenised documents into training sequences.

Two passes.  `token_pieces` turns every document into its token ids, an end mark, and pieces of at
most ``max_tokens`` ids; `pack_pieces` puts the pieces into sequences with bounded-space best fit:
a fixed number of open bins, held in one integer used as a bitset keyed by free space, so that the
tightest bin that still takes a piece is the lowest set bit at or above the piece's length; when all
bins are open, the fullest closes first.

Each task packs its own share of the pieces (dealt evenly, longest first), with bounded state, so
the operator scales with the number of tasks and a lost task is simply packed again.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches

MAX_TOKENS = 4096
END_ID = 1
OPEN_BINS = 8192
#: Words that a worker keeps with their ids (twice as many at most), and the longest word that is kept.
CACHE_WORDS, CACHE_CHARS = 300_000, 48
#: Marks that may end a word.
MARKS = ".,;:!?#$%&*|"

PIECES = "doc_id long, piece int, start long, length long, ids binary"
PACKED = ("doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")

_LOADED: dict[str, "WordTokenizer"] = {}


class WordIds(dict):
    """Ids of words as they are met; the words not met for longest go first when it is full."""

    def __init__(self, inner) -> None:
        from tokenizers.pre_tokenizers import ByteLevel
        super().__init__({"": b""})
        self.inner, self.older, self.merged = inner, {}, inner.model.tokenize
        as_bytes = ByteLevel(add_prefix_space=False, use_regex=False)
        self.byte_chars = {c: as_bytes.pre_tokenize_str(chr(c))[0][0] for c in range(0x80, 0x250)}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self._made(word)
        if len(word) <= CACHE_CHARS:
            if len(self) >= CACHE_WORDS:
                self.older = self.copy()
                self.clear()
                self[""] = b""
            self[word] = ids
        return ids

    def _made(self, word: str) -> bytes:
        if "<" not in word and len(word) <= CACHE_CHARS and max(word) < "\u0250" and "\u0130" not in word:
            # in these scripts lower-casing is a map of single characters, and nothing composes
            low = word.lower()
            if low != word:
                return self[low]
            if word.isalpha():  # one word to the merges, so nothing before them changes it
                return array("I", [t.id for t in self.merged(word.translate(self.byte_chars))]).tobytes()
            core = word.rstrip(MARKS)
            if core != word and core.isalpha():  # letters and marks are never in one token
                return self[core] + self[word[len(core):]]
        return np.array(self.inner.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()


class WordTokenizer:
    """Ids of whole texts, by way of the ids of their words.

    A tokenizer that lower-cases, drops white space and never merges across it or from letters to
    marks gives a text the ids of its space-separated words in order, so a distinct word is
    tokenised once for as long as a worker keeps it.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer
        self.known = WordIds(Tokenizer.from_file(path))

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        return b"".join(map(self.known.__getitem__, text.replace("\n", " ").replace("\t", " ").split(" ")))


def _tokenizer(path: str) -> WordTokenizer:
    if path not in _LOADED:
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _LOADED[path] = WordTokenizer(path)
    return _LOADED[path]


def token_pieces(docs: DataFrame, tokenizer_path: str, max_tokens: int = MAX_TOKENS, end_id: int = END_ID) -> DataFrame:
    """``(doc_id, piece, start, length, ids)`` of every document; ``ids`` little-endian uint32.

    A null text counts as empty: one piece that holds the end mark.  Only a document of more than
    ``max_tokens`` ids (end mark included) is cut, into pieces of ``max_tokens``; its last piece may
    be shorter.  Null or repeated doc_ids keep a row for each of their pieces; other columns of
    ``docs`` are not read.
    """
    end = np.array([end_id], dtype="<u4").tobytes()
    width = 4 * max_tokens

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizer(tokenizer_path)
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            held = 0
            for doc, text in zip(batch.column(0), batch.column(1)):
                ids = tok.ids(text.as_py() or "") + end
                doc = doc.as_py()
                for k, at in enumerate(range(0, len(ids), width)):
                    part = ids[at:at + width]
                    for column, value in zip(out, (doc, k, at // 4, len(part) // 4, part)):
                        column.append(value)
                held += len(ids)
                if held > 16 << 20:
                    yield _pieces_batch(out)
                    out, held = ([], [], [], [], []), 0
            yield _pieces_batch(out)

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), run, PIECES)


def _pieces_batch(out: tuple[list, ...]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)],
                                      names=["doc_id", "piece", "start", "length", "ids"])


class BestFit:
    """Bounded-space best fit: at most ``open_bins`` bins are open at a time."""

    def __init__(self, capacity: int, open_bins: int = OPEN_BINS) -> None:
        self.capacity, self.open_bins = capacity, open_bins
        self.mask = 0                       # bit f: some open bin has f ids of free space
        self.by_free: dict[int, list[int]] = {}
        self.n_open = self.made = 0

    def _pop(self, free: int) -> int:
        bins = self.by_free[free]
        number = bins.pop()
        if not bins:
            self.mask &= ~(1 << free)
        self.n_open -= 1
        return number

    def put(self, length: int) -> tuple[int, int]:
        """``(bin, offset)`` of a piece of ``length`` ids."""
        fitting = self.mask >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            number = self._pop(free)
        else:
            if self.n_open >= self.open_bins:
                self._pop((self.mask & -self.mask).bit_length() - 1)  # the fullest closes
            free, number = self.capacity, self.made
            self.made += 1
        left = free - length
        if left:
            self.by_free.setdefault(left, []).append(number)
            self.mask |= 1 << left
            self.n_open += 1
        return number, self.capacity - free


def pack_pieces(pieces: DataFrame, max_tokens: int = MAX_TOKENS, open_bins: int = OPEN_BINS) -> DataFrame:
    """``pieces`` (any columns, with ``length`` of 1 to ``max_tokens``) plus ``sequence_id`` and ``offset``.

    The pieces are dealt evenly without a key (so copies or a hot document cannot gather in one
    task), sorted by falling length within a task, and packed there.  A task leaves few sequences
    unfilled, whatever its share.
    """
    schema = pieces.schema
    kept = [f.name for f in schema.fields]
    out_schema = type(schema)(list(schema.fields)).add("sequence_id", "long").add("offset", "long")
    at = kept.index("length")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        bins = BestFit(max_tokens, open_bins)
        for batch in batches:
            placed = [bins.put(n) for n in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([(task << 40) + b for b, _ in placed], pa.int64()),
                 pa.array([o for _, o in placed], pa.int64())], names=[*kept, "sequence_id", "offset"])

    dealt = pieces.hint("rebalance").sortWithinPartitions(F.col("length").desc())
    return map_batches(dealt, run, out_schema)


def packed_documents(docs: DataFrame, tokenizer_path: str, max_tokens: int = MAX_TOKENS, end_id: int = END_ID) -> DataFrame:
    """Every piece with its place; ids are given by their CRC-32 only, so they are not shuffled."""
    pieces = token_pieces(docs, tokenizer_path, max_tokens, end_id).select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return pack_pieces(pieces, max_tokens)
