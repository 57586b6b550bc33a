"""Fill-in-middle transformation of whole texts.

A text is cut into units (lines, or code points); two cuts between units, drawn from a hash of the
document's id, part it into prefix, middle and suffix, which are put in another order behind
sentinels.  The cuts are found without a walk over the text: the UTF-8 bytes of many documents are
viewed as 64-bit words, the bytes that end a unit are marked in all eight lanes by a few arithmetic
operations, marks are counted word by word, the word that holds the k-th mark is found by a search
in the running counts, and its place in the word by one multiplication.

Results for odd input: a null text is an empty one; an empty text, and one that holds a sentinel,
stays as it is (form ``plain``, no prefix or middle); a null doc_id counts as an empty decimal;
repeated rows give equal rows; an empty table gives an empty result; further columns, whatever their
names, are not looked at; a text of any length is cut whole, its bytes are held once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches

#: What stands before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Text that is worked on at a time, in bytes; a longer text is worked on alone.
CHUNK = 8 << 20

_ONES = np.uint64(0x0101010101010101)
_HIGH, _LOW7 = _ONES * np.uint64(0x80), _ONES * np.uint64(0x7F)

SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def newline_marks(words: np.ndarray) -> np.ndarray:
    """The high bit of every byte that is a line feed."""
    x = words ^ (_ONES * np.uint64(0x0A))
    return ~(((x & _LOW7) + _LOW7) | x | _LOW7)


def character_marks(words: np.ndarray) -> np.ndarray:
    """The high bit of every byte that begins a code point (any but 10xxxxxx)."""
    return ~(words & ~(words << np.uint64(1))) & _HIGH


class Marks:
    """Marked bytes of a buffer: how many stand before a byte (`rank`), and where the k-th is (`select`)."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.upto = np.cumsum(np.bitwise_count(words), dtype=np.int64)
        self.before = self.upto - np.bitwise_count(words)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Marks in the bytes before ``at``."""
        word, lane = at >> 3, (at & 7).astype(np.uint64)
        inside = self.words[word] & ((np.uint64(1) << (lane << np.uint64(3))) - np.uint64(1))
        return self.before[word] + np.bitwise_count(inside)

    def select(self, k: np.ndarray) -> np.ndarray:
        """The byte of the k-th mark, from 1; the mark has to be there."""
        word = np.searchsorted(self.upto, k, side="left")
        rest = (k - self.before[word]).astype(np.uint64)
        counts = (self.words[word] >> np.uint64(7)) * _ONES      # each byte: marks up to and with it
        reached = ((counts | _HIGH) - rest * _ONES) & _HIGH
        return (word << 3) + 8 - np.bitwise_count(reached)


class Cuts(NamedTuple):
    """Per document: units, and the bytes at which the prefix and the middle end."""

    units: np.ndarray
    first: np.ndarray
    second: np.ndarray


class Texts:
    """Many texts in one buffer that is viewed as words; ``ends[i]`` is where text i ends."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        padded = np.zeros((len(data) + 16) // 8 * 8, np.uint8)
        padded[:len(data)] = data
        self.data, self.start, self.end = padded, bounds[:-1], bounds[1:]
        words = padded.view("<u8")
        self.newlines, self.characters = Marks(newline_marks(words)), Marks(character_marks(words))

    def units(self, unit: str) -> np.ndarray:
        """Units of each text; a line feed ends a line, and so does the end of a text that has more."""
        if unit == "char":
            return self.characters.rank(self.end) - self.characters.rank(self.start)
        feeds = self.newlines.rank(self.end) - self.newlines.rank(self.start)
        return feeds + ((self.end > self.start) & (self.data[np.maximum(self.end - 1, 0)] != 0x0A))

    def unit_end(self, unit: str, k: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The byte behind unit ``k`` (0: the start) of each text with ``n`` units."""
        marks = self.characters if unit == "char" else self.newlines
        out = np.where(k == 0, self.start, self.end)
        inner = np.flatnonzero((k > 0) & (k < n))
        if len(inner):
            before = marks.rank(self.start[inner])
            # a code point ends where the next one begins; a line ends behind its line feed
            out[inner] = marks.select(before + k[inner] + 1) if unit == "char" else marks.select(before + k[inner]) + 1
        return out

    def characters_between(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self.characters.rank(b) - self.characters.rank(a)


def draws(doc_ids: list, seed: int) -> np.ndarray:
    """Four numbers under 2^32 for each document."""
    said = (hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).digest()[:16] for d in doc_ids)
    return np.frombuffer(b"".join(said), ">u4").reshape(-1, 4).astype(np.int64)


def transformed(batch: pa.RecordBatch, unit: str, seed: int, rate: int, spm: int) -> pa.RecordBatch:
    """One batch ``(doc_id, text)``; texts are not null."""
    text = batch.column(1).cast(pa.large_binary())
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
    data = np.frombuffer(text.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    texts = Texts(data, offsets - offsets[0])
    n, h = texts.units(unit), draws(batch.column(0).to_pylist(), seed)
    cut = h[:, :2] % (n + 1)[:, None]
    first, second = (texts.unit_end(unit, k, n) for k in (cut.min(axis=1), cut.max(axis=1)))
    held = [pc.match_substring(batch.column(1), s).to_numpy(zero_copy_only=False) for s in (PREFIX, SUFFIX, MIDDLE)]
    plain = (n == 0) | held[0] | held[1] | held[2] | (h[:, 2] % 100 >= rate)
    form = np.where(plain, "plain", np.where(h[:, 3] % 100 < spm, "spm", "psm"))

    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    whole, out = texts.data.tobytes(), []
    for kind, a, b, c, d in zip(form.tolist(), texts.start.tolist(), first.tolist(), second.tolist(), texts.end.tolist(), strict=True):
        if kind == "plain":
            out.append(whole[a:d])
        elif kind == "psm":
            out.append(b"".join((p, whole[a:b], s, whole[c:d], m, whole[b:c])))
        else:
            out.append(b"".join((s, whole[c:d], p, whole[a:b], m, whole[b:c])))
    counts = [pa.array(texts.characters_between(*ends), pa.int64(), mask=plain) for ends in ((texts.start, first), (first, second))]
    return pa.RecordBatch.from_arrays(
        [batch.column(0), pa.array(n, pa.int64()), pa.array(form.tolist(), pa.string()), *counts, pa.array(out, pa.binary()).cast(pa.string())],
        names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def _portions(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``CHUNK`` bytes of text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHUNK, side="right")))
        yield batch.slice(at, to - at)
        at = to


def fill_in_middle(docs: DataFrame, *, unit: str = "line", seed: int = 7, rate: int = 100, spm: int = 50) -> DataFrame:
    """Every document with its text transformed: ``(doc_id, n, form, prefix_chars, middle_chars, output)``.

    ``unit`` is ``line`` or ``char``; ``rate`` percent of the documents are transformed, ``spm`` percent
    of these with the suffix first (``spm``), the others with the prefix first (``psm``).  No shuffle;
    a lost task is run again from its rows alone.
    """
    if unit not in ("line", "char"):
        raise ValueError(f"unit {unit!r} is neither line nor char")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _portions(batch):
                yield transformed(part, unit, seed, rate, spm)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return map_batches(rows, run, SCHEMA)


def restored_text(output: Column | str = "output", form: Column | str = "form") -> Column:
    """The text that an output was made of.  Each sentinel stands in it once, as no text that holds one
    is transformed and no two sentinels, or a sentinel and a text, can overlap."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    between = lambda left, right: F.substring_index(F.substring_index(output, left, -1), right, 1)
    middle = F.substring_index(output, MIDDLE, -1)
    return (F.when(form == "psm", F.concat(between(PREFIX, SUFFIX), middle, between(SUFFIX, MIDDLE)))
            .when(form == "spm", F.concat(between(PREFIX, MIDDLE), middle, between(SUFFIX, PREFIX)))
            .otherwise(output))


def fill_in_middle_report(docs: DataFrame, **how) -> DataFrame:
    """`fill_in_middle` with digests of the output and of the text rebuilt from it in place of the output."""
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return fill_in_middle(docs, **how).select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                                              digest(F.col("output")).alias("output_sha256"), digest(restored_text()).alias("restored_sha256"))


#: The report in DuckDB SQL.
SQL = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
         sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
drawn AS (
  SELECT *, len(u) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
         CAST('0x' || h[25:32] AS BIGINT) AS h4
  FROM units),
cuts AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain'
              WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn),
parts AS (
  SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s FROM cuts)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(p || m || s) AS restored_sha256
FROM parts
"""
