"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads a segment (a run of letters, lower-cased, at most ``MAX_SEGMENT`` bytes) in both
directions and labels every byte position with language probabilities; a document's probabilities
pool those of all its positions.  It is trained in numpy by backpropagation through time on the
segments of a bounded sample of labelled documents.

State does not pass from one segment to the next, so a segment that comes again gets what it got
before: a worker keeps the sums of segments it has met, and every position of every text counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches

MAX_SEGMENT = 64
#: Documents of the training sample over all languages, characters read of each, and languages (more than have a code).
SAMPLE_DOCS, SAMPLE_CHARS, MAX_LANGUAGES = 1200, 2000, 8192
HIDDEN, STEPS, BATCH, RATE = 16, 500, 256, 0.01
CACHE_SEGMENTS = 400_000

#: ASCII bytes that are no letters become spaces; the rest stays.
_SPACED = bytes(b if chr(b).isalpha() or b >= 0x80 else 0x20 for b in range(256))


def segments(text: str) -> list[bytes]:
    """The runs of letters of a text, cut into pieces of at most ``MAX_SEGMENT`` bytes between characters."""
    found = text.lower().encode("utf-8", "replace").translate(_SPACED).split()
    if any(len(s) > MAX_SEGMENT for s in found):
        found = [piece for s in found for piece in _pieces(s)]
    return found


def _pieces(run: bytes) -> Iterator[bytes]:
    first = 0
    while first < len(run):
        last = min(first + MAX_SEGMENT, len(run))
        while last < len(run) and run[last] & 0xC0 == 0x80:     # inside a character
            last -= 1
        yield run[first:last]
        first = last


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


class ByteTagger:
    """Two gated recurrent networks, one for each direction, and a softmax over their joint states.

    Weights by direction: ``x`` (256, 3 H) holds what a byte adds to the update gate, the reset gate
    and the candidate; ``u`` (H, 3 H) what the state adds.
    """

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        self.languages, self.h = languages, hidden
        self.w = {}
        for way in "fb":
            self.w[f"x{way}"] = rng.normal(0, 0.3, (256, 3 * hidden)).astype(np.float32)
            self.w[f"u{way}"] = (rng.normal(0, 1, (hidden, 3 * hidden)) / np.sqrt(hidden)).astype(np.float32)
        self.w["v"] = rng.normal(0, 0.3, (2 * hidden, len(languages))).astype(np.float32)
        self.w["c"] = np.zeros(len(languages), np.float32)

    def _read(self, way: str, bytes_: np.ndarray, mask: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
        """States after each step, time first; ``mask`` (T, B) stops rows past their end."""
        x, u, h = self.w[f"x{way}"], self.w[f"u{way}"], self.h
        state = np.zeros((bytes_.shape[1], h), np.float32)
        out, tape = np.empty((len(bytes_), bytes_.shape[1], h), np.float32), []
        for t, b in enumerate(bytes_):
            gx, gu = x[b], state @ u
            zr = _sigmoid(gx[:, :2 * h] + gu[:, :2 * h])
            z, r = zr[:, :h], zr[:, h:]
            n = np.tanh(gx[:, 2 * h:] + r * gu[:, 2 * h:])
            new = n + z * (state - n)
            if mask is not None:
                new = np.where(mask[t][:, None], new, state)
            if keep:
                tape.append((b, state, z, r, n, gu[:, 2 * h:]))
            state = out[t] = new
        return out, tape

    def _back(self, way: str, d_out: np.ndarray, tape: list, mask: np.ndarray, grad: dict) -> None:
        """Backpropagation through time of one direction."""
        u, h = self.w[f"u{way}"], self.h
        d_state = np.zeros_like(d_out[0])
        for t in range(len(tape) - 1, -1, -1):
            b, state, z, r, n, un = tape[t]
            d_new = d_out[t] + d_state
            live = mask[t][:, None]
            d = np.where(live, d_new, 0)
            d_n = d * (1 - z) * (1 - n * n)
            d_z = d * (state - n) * z * (1 - z)
            d_r = d_n * un * r * (1 - r)
            d_gu = np.concatenate([d_z, d_r, d_n * r], 1)
            grad[f"u{way}"] += state.T @ d_gu
            np.add.at(grad[f"x{way}"], b, np.concatenate([d_z, d_r, d_n], 1))
            d_state = np.where(live, d * z, d_new) + d_gu @ u.T

    def train_step(self, bytes_: np.ndarray, mask: np.ndarray, label: np.ndarray) -> tuple[float, dict]:
        """Mean loss per position and its gradient; ``bytes_`` and ``mask`` (T, B), ``label`` (B,)."""
        n = len(bytes_)
        fwd, tape_f = self._read("f", bytes_, mask, True)
        # the other direction: rows are turned round within their own length
        length = mask.sum(0)
        turn = np.where(mask, length[None] - 1 - np.arange(n)[:, None], np.arange(n)[:, None])
        cols = np.arange(bytes_.shape[1])
        bwd_r, tape_b = self._read("b", bytes_[turn, cols], mask, True)
        both = np.concatenate([fwd, bwd_r[turn, cols]], 2)
        logit = both @ self.w["v"] + self.w["c"]
        logit -= logit.max(2, keepdims=True)
        p = np.exp(logit)
        p /= p.sum(2, keepdims=True)
        total = mask.sum()
        loss = -float((np.log(np.maximum(p[:, cols, label], 1e-9)) * mask).sum() / total)
        p[:, cols, label] -= 1
        d = (p * mask[:, :, None] / total).astype(np.float32)
        grad = {k: np.zeros_like(w) for k, w in self.w.items()}
        grad["v"] = np.einsum("tbh,tbk->hk", both, d)
        grad["c"] = d.sum((0, 1))
        d_both = d @ self.w["v"].T
        self._back("f", d_both[:, :, :self.h], tape_f, mask, grad)
        self._back("b", d_both[:, :, self.h:][turn, cols], tape_b, mask, grad)
        return loss, grad

    def fit(self, texts: list[tuple[str, int]], steps: int = STEPS, batch: int = BATCH, rate: float = RATE, seed: int = 5) -> list[float]:
        """Adam over random segments, each language as often as the others; returns the losses."""
        rng = np.random.default_rng(seed)
        pools: dict[int, list[bytes]] = {}
        for text, label in texts:
            pools.setdefault(label, []).extend(segments(text))
        labels = [k for k, pool in sorted(pools.items()) if pool]
        losses: list[float] = []
        if not labels:
            return losses
        m = {k: np.zeros_like(w) for k, w in self.w.items()}
        s = {k: np.zeros_like(w) for k, w in self.w.items()}
        for step in range(1, steps + 1):
            picks = rng.integers(0, len(labels), batch)
            drawn = [pools[labels[k]][rng.integers(len(pools[labels[k]]))] for k in picks]
            bytes_, mask = _padded(drawn)
            loss, grad = self.train_step(bytes_, mask, np.array(labels)[picks])
            losses.append(loss)
            pace = rate * min(1.0, 2 * (1 - step / (steps + 1)))
            for k, g in grad.items():
                np.clip(g, -1, 1, out=g)
                m[k] = 0.9 * m[k] + 0.1 * g
                s[k] = 0.99 * s[k] + 0.01 * g * g
                self.w[k] -= (pace * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(s[k] / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
        return losses

    def evidence(self, found: list[bytes]) -> np.ndarray:
        """For each segment the sums over its positions of log probabilities, and its number of positions."""
        out = np.zeros((len(found), len(self.languages) + 1), np.float32)
        by_length: dict[int, list[int]] = {}
        for k, segment in enumerate(found):
            by_length.setdefault(len(segment), []).append(k)
        for length, members in by_length.items():
            for at in range(0, len(members), 4096):
                rows = members[at:at + 4096]
                bytes_ = np.frombuffer(b"".join(found[k] for k in rows), np.uint8).reshape(len(rows), length).T
                fwd = self._read("f", bytes_, None, False)[0]
                bwd = self._read("b", bytes_[::-1], None, False)[0][::-1]
                logit = fwd @ self.w["v"][:self.h] + bwd @ self.w["v"][self.h:] + self.w["c"]
                top = logit.max(2, keepdims=True)
                logit -= top + np.log(np.exp(logit - top).sum(2, keepdims=True))
                out[rows, :-1] = logit.sum(0)
                out[rows, -1] = length
        return out


def _padded(found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    length = np.array([len(s) for s in found])
    longest = int(length.max())
    bytes_ = np.frombuffer(b"".join(s.ljust(longest, b"\0") for s in found), np.uint8).reshape(len(found), longest).T
    return bytes_.astype(np.int64), np.arange(longest)[:, None] < length[None]


def held_out(doc_id) -> object:
    """Whether a document is never learned from (so also if it has no doc_id)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def training_sample(docs: DataFrame, docs_bound: int = SAMPLE_DOCS, chars: int = SAMPLE_CHARS) -> list[tuple[str, str]]:
    """``(lang, text)`` of at most ``docs_bound`` documents or so, as many of each language.

    One document is taken for each language and hash bucket, that with the least hash: two sums
    before any shuffle, and the same sample at every run.
    """
    rows = docs.where("lang is not null and text is not null").where(~held_out(F.col("doc_id"))) \
        .select("lang", "text", F.xxhash64("doc_id", F.lit("language sample")).alias("h"))
    languages = [r[0] for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES).collect()]
    if not languages:
        return []
    buckets = max(1, docs_bound // len(languages))
    chosen = rows.where(F.col("lang").isin(languages)).groupBy("lang", F.pmod("h", F.lit(buckets)).alias("bucket")).agg(F.min("h").alias("h"))
    picked = rows.join(F.broadcast(chosen.select("lang", "h")), ["lang", "h"])  # docs_bound + MAX_LANGUAGES rows at most
    found = picked.select("lang", "h", F.substring("text", 1, chars).alias("text")).dropDuplicates(["lang", "h"]).collect()
    return sorted((r["lang"], r["text"]) for r in found)


def trained_tagger(docs: DataFrame) -> ByteTagger | None:
    """A tagger for the languages of ``docs``; None if there is nothing to learn from."""
    sample = training_sample(docs)
    languages = sorted({lang for lang, _ in sample})
    if not languages:
        return None
    tagger = ByteTagger(languages)
    tagger.fit([(text, languages.index(lang)) for lang, text in sample])
    return tagger


class _Known(dict):
    """Row numbers of segments; new ones wait for the network."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, segment: bytes) -> int:
        row = self[segment] = len(self)
        self.new.append(segment)
        return row


def predicted_languages(docs: DataFrame, tagger: ByteTagger | None) -> DataFrame:
    """``(doc_id, lang_pred, score)`` of every document, from its whole text alone.

    ``und`` with score 0 for a null text, a text without a letter, or without a tagger.
    """
    held = docs.sparkSession.sparkContext.broadcast(tagger)
    schema = "doc_id long, lang_pred string, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        known, table = _Known(), np.zeros((0, 1), np.float32)
        for batch in batches:
            names, scores = [], []
            texts = batch.column(1)
            for first in range(0, len(texts), 512):
                part = [segments(t.as_py() or "") if model else [] for t in texts[first:first + 512]]
                rows = [np.fromiter(map(known.__getitem__, p), np.int64, len(p)) for p in part]
                if known.new:
                    made = model.evidence(known.new)
                    made[[not any(map(str.isalpha, s.decode("utf-8", "ignore"))) for s in known.new]] = 0
                    table, known.new = np.concatenate([table.reshape(-1, made.shape[1]), made]), []
                for r in rows:
                    total = table[r].sum(0, dtype=np.float64) if len(r) else None
                    if total is None or total[-1] == 0:
                        names.append("und")
                        scores.append(0.0)
                        continue
                    mean = total[:-1] / total[-1]
                    best = int(mean.argmax())
                    names.append(model.languages[best])
                    scores.append(float(1 / np.exp(mean - mean[best]).sum()))
                if len(known) > CACHE_SEGMENTS:
                    known, table = _Known(), table[:0]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                             names=["doc_id", "lang_pred", "score"])

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), run, schema)


def identified_languages(docs: DataFrame) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)``: learn from the documents that are not held out,
    predict for all."""
    found = predicted_languages(docs, trained_tagger(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
