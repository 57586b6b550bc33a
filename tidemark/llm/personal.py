"""Personal data: regular expressions propose spans, validators confirm them, words nearby raise or
lower a span's score.

Base kinds (email, ip, card, phone) follow fixed patterns; every span that passes its validator stays.
Further kinds (iban, ssn, secret, and numbers that only their context tells to be phones) stay if
their score reaches the threshold.  Spans are counted in code points, ends exclusive.  All patterns
run in time linear in the text.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import map_batches

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn", "secret", "local_phone")
THRESHOLD = 0.5

# Fixed patterns of the base kinds; possessive repeats where the repeated class cannot begin what follows.
_EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_EMAIL_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_DIGIT = re.compile(r"[0-9]")
# A country code and check digits, then groups of letters and digits.
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}([- ])[0-9]{2}\1[0-9]{4}(?![0-9-])")
_SECRET = re.compile(r"(?i)\b(?:token|secret|password|passwd|api[_-]?key|access[_-]?key)[\"']?\x20{0,4}[=:]\x20{0,4}[\"']?([A-Za-z0-9+/_.-]{8,}+)")
_LOCAL_PHONE = re.compile(r"(?<![0-9+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])")

#: Score of a confirmed span before its context is looked at.
PRIOR = {"email": 0.95, "ip": 0.7, "card": 0.85, "phone": 0.8, "iban": 0.9, "ssn": 0.35, "secret": 0.4, "local_phone": 0.35}
#: Words near a span that raise its score, and words that lower it.
CONTEXT = {
    "email": (("mail", "contact", "write"), ()),
    "ip": (("ip", "address", "host", "server", "adresse"), ("version", "release", "section", "chapter")),
    "card": (("card", "visa", "mastercard", "credit", "karte", "carte", "tarjeta"), ("isbn", "serial", "order")),
    "phone": (("phone", "tel", "call", "mobile", "fax", "telefon", "téléphone", "teléfono"), ("isbn", "version")),
    "iban": (("iban", "account", "bank", "konto", "compte", "cuenta"), ("serial",)),
    "ssn": (("ssn", "social", "security", "taxpayer"), ("part", "serial", "order", "isbn")),
    "secret": (("token", "secret", "password", "passwd", "key"), ("example", "placeholder")),
    "local_phone": (("phone", "tel", "call", "mobile", "fax", "telefon", "téléphone", "teléfono"), ("isbn", "serial", "order")),
}
CONTEXT_CHARS, RAISE, LOWER = 40, 0.25, 0.3
_NEARBY = re.compile(r"[^\W\d_]+")


def luhn(digits: str) -> bool:
    total = 0
    for place, d in enumerate(reversed(digits)):
        value = int(d) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """Whether an account number's check digits hold (letters count from 10)."""
    if not 15 <= len(iban) <= 34:
        return False
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, sign = 0, text.find("@")
    while sign >= 0:
        first = sign
        while first > done and text[first - 1] in _EMAIL_LOCAL:
            first -= 1
        domain = _EMAIL_DOMAIN.match(text, sign + 1) if first < sign else None
        if domain:
            done = domain.end()
            yield first, done
        else:
            done = max(done, sign + 1)
        sign = text.find("@", max(done, sign + 1))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` of the base kinds, by start, then kind as listed."""
    found = [(a, b, "email") for a, b in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p[-3:] if len(p) > 3 else p) <= 255 for p in m.group().split(".")):
                found.append((m.start(), m.end(), "ip"))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = m.group().replace(" ", "").replace("-", "")
                if 12 <= len(digits) <= 19 and luhn(digits):
                    found.append((m.start(), m.end(), "card"))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum(map(str.isdigit, m.group())) <= 15:
                    found.append((m.start(), m.end(), "phone"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def further_spans(text: str) -> list[tuple[int, int, str]]:
    """Proposed and validated spans of the kinds beyond the base ones."""
    found = []
    if _DIGIT.search(text):
        found += [(m.start(), m.end(), "iban") for m in _IBAN.finditer(text) if mod97(m.group().replace(" ", ""))]
        for m in _SSN.finditer(text):
            area, group, serial = m.group()[:3], m.group()[4:6], m.group()[7:]
            if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
                found.append((m.start(), m.end(), "ssn"))
        found += [(m.start(), m.end(), "local_phone") for m in _LOCAL_PHONE.finditer(text)]
    if "=" in text or ":" in text:
        found += [(m.start(1), m.end(1), "secret") for m in _SECRET.finditer(text) if len(set(m.group(1))) >= 5]
    return found


def context_score(text: str, start: int, end: int, kind: str) -> float:
    """The kind's prior, raised or lowered by the words around the span."""
    near = {w.lower() for w in _NEARBY.findall(text[max(0, start - CONTEXT_CHARS):start])}
    near |= {w.lower() for w in _NEARBY.findall(text[end:end + CONTEXT_CHARS])}
    for_it, against = CONTEXT[kind]
    return round(min(1.0, max(0.0, PRIOR[kind] + RAISE * (not near.isdisjoint(for_it)) - LOWER * (not near.isdisjoint(against)))), 4)


def joined_spans(spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Spans in order with overlapping ones made one, of the first one's kind."""
    out: list[tuple[int, int, str]] = []
    for a, b, kind in spans:
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]), out[-1][2])
        else:
            out.append((a, b, kind))
    return out


def all_spans(text: str | None, threshold: float = THRESHOLD) -> list[dict]:
    """Every span that stays: the base ones, and further ones with a score of ``threshold`` or more
    that no base span overlaps."""
    if not text:
        return []
    base = base_spans(text)
    out = [(a, b, kind, context_score(text, a, b, kind)) for a, b, kind in base]
    taken = joined_spans(base)
    starts = [a for a, _, _ in taken]
    for a, b, kind in further_spans(text):
        score = context_score(text, a, b, kind)
        if score < threshold:
            continue
        before = bisect_left(starts, b) - 1         # the last taken stretch that begins before the span's end
        if kind != "local_phone" or before < 0 or taken[before][1] <= a:
            out.append((a, b, kind, score))
    out.sort(key=lambda s: (s[0], KINDS.index(s[2])))
    return [{"kind": kind, "first": a, "end": b, "score": score} for a, b, kind, score in out]


_SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("first", T.LongType()),
                      T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType())])
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("first", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))


def find_personal_data(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` plus ``spans`` (kind, first, end, score), found in whole texts.

    A null or empty text has no spans.  A column ``spans`` of ``docs`` is replaced; other columns,
    repeated and null doc_ids go through as they are.
    """
    base = docs.drop("spans")
    names = base.columns
    at = names.index("text")
    schema = T.StructType([*base.schema.fields, T.StructField("spans", T.ArrayType(_SPAN))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [all_spans(t.as_py(), threshold) for t in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(spans, _ARROW)], names=[*names, "spans"])

    return map_batches(base, run, schema)


def redact(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with every span's text replaced by its kind in angle brackets; spans that overlap go as one,
    from the first one's start to the last one's end, by the first one's kind."""
    names = docs.columns
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for t in batch.column(at).to_pylist():
                done, parts = 0, []
                for a, b, kind in joined_spans([(s["first"], s["end"], s["kind"]) for s in all_spans(t, threshold)]):
                    parts += [t[done:a], f"<{kind}>"]
                    done = b
                texts.append(t if t is None else "".join(parts) + t[done:])
            columns = list(batch.columns)
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return map_batches(docs, run, docs.schema)


def personal_data_report(docs: DataFrame) -> DataFrame:
    """Counts and digests of the spans of each document."""
    found = find_personal_data(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))).drop("text")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    written = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["first"].cast("string"), s["end"].cast("string"))), ",")

    def count_of(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count_of(k) for k in BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"),
                        F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0)).alias("score"))
