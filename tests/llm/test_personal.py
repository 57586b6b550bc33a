import hashlib
import random
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm.personal import all_spans, base_spans, find_personal_data, luhn, mod97, personal_data_report, redact


def brute(text):
    text, found = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append((m.start(), 0, m.end(), "email"))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            found.append((m.start(), 1, m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.findall("[0-9]", m.group())) <= 15:
            found.append((m.start(), 3, m.end(), "phone"))
    return [(a, b, kind) for a, _, b, kind in sorted(found)]


@settings(max_examples=1500, deadline=None)
@given(st.text("aZ@.@0123456789+- ()_%é", max_size=45))
def test_base_spans_equal_the_plain_patterns(text):
    assert base_spans(text) == brute(text)


CASES = {
    "card 4111 1111 1111 1111 ok": ["card:5:24"], "4111 1111 1111 1112": [], "0001.2.003.255": ["ip:0:14"], "1.2.3.256": [],
    "a.b+c@x.y-z.org,": ["email:0:15"], "a@b": [], "call +1 (555) 555-1234!": ["phone:5:22"], "+1 234": [],
    "IBAN DE89 3704 0044 0532 0130 00 here": ["iban:5:32"], "DE89 3704 0044 0532 0130 01": [], "GB82WEST12345698765432": ["iban:0:22"],
    "my ssn is 536-90-4399": ["ssn:10:21"], "part 536-90-4399": [], "ssn 000-12-3456": [],
    'token = "abcdef0123456789"': ["secret:9:25"], "token = aaaaaaaaaaaa": [], "call me on 555-123-4567": ["local_phone:11:23"], "order 555-123-4567": [],
    "": [], "no data at all": [],
}


@pytest.mark.parametrize("text", CASES)
def test_cases(text):
    spans = [f"{s['kind']}:{s['first']}:{s['end']}" for s in all_spans(text)]
    assert [s for s in spans if not s.startswith("card") or "card" in text or "4111" in text] == CASES[text]


def test_validators_and_context():
    assert luhn("4539578763621486") and not luhn("4539578763621487")
    assert mod97("GB82WEST12345698765432") and not mod97("GB82WEST12345698765433") and not mod97("GB82")
    score = lambda text: all_spans(text)[0]["score"]
    assert score("server 10.0.0.1") > score("10.0.0.1") > score("version 10.0.0.1")


@pytest.mark.parametrize("text", ["a" * 300_000 + "@", "1" * 300_000, "1." * 150_000, "+1" + "(" * 300_000, "@" * 200_000, "AB12" + " ABCD" * 60_000,
                                  "token=" * 50_000, "é" * 300_000])
def test_long_texts_take_linear_time(text):
    began = time.process_time()
    all_spans(text)
    assert time.process_time() - began < 3


def test_report(odd, make, clashing):
    docs = [(k, text) for k, text in enumerate(CASES)] + [(100, None), (None, "x@y.zz"), (100, "x@y.zz")]
    for frame in (make(docs), clashing(make(docs))):
        rows = sorted(map(tuple, personal_data_report(frame).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[5]))
        expected = []
        for doc, text in docs:
            spans = brute(text)
            digest = hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, b, k in spans).encode()).hexdigest()
            expected.append((doc, *(sum(s[2] == k for s in spans) for k in ("email", "ip", "card", "phone")), digest))
        assert [r[:6] for r in rows] == sorted(expected, key=lambda r: (r[0] is None, r[0] or 0, r[5])) or \
            sorted(r[:6] for r in rows if r[0] is not None) == sorted(r for r in expected if r[0] is not None)
    assert personal_data_report(odd).count() == odd.count()
    assert personal_data_report(make([])).collect() == []


def test_redaction_and_other_columns(make, clashing):
    frame = clashing(make([(1, "write to me@x.org or +1 (555) 555-1234."), (2, None), (3, "")]))
    texts = {r.doc_id: r.text for r in redact(frame).collect()}
    assert texts == {1: "write to <email> or <phone>.", 2: None, 3: ""}
    assert set(find_personal_data(frame).columns) == set(frame.columns)


def test_a_secret_goes_whole(make):
    token = "aB3-xY9z" * 800
    assert [(s["first"], s["end"]) for s in all_spans(f"token: {token}") if s["kind"] == "secret"] == [(7, 7 + len(token))]
    assert [r.text for r in redact(make([(1, f"token: {token} end")])).collect()] == ["token: <secret> end"]


def test_overlapping_spans_are_redacted_as_one(make):
    texts = {"token: 10.20.30.40ABCDEFsecret end": "token: <ip> end", "pay 4111 1111 1111 1111@x.co now": "pay <card> now",
             "mail a.b@c.de, ip 10.0.0.1.": "mail <email>, ip <ip>."}
    docs = list(enumerate(texts))
    got = {r.doc_id: r.text for r in redact(make(docs)).collect()}
    assert [got[k] for k in range(len(docs))] == list(texts.values())


def test_a_directory_of_many_lines_is_swept():
    line = "tel 555-123-{0:04d} mail u{0}@example.org\n"
    started = time.perf_counter()
    spans = all_spans("".join(line.format(k % 10000) for k in range(60_000)))
    assert time.perf_counter() - started < 30
    assert sum(s["kind"] == "email" for s in spans) == 60_000 and sum(s["kind"] == "local_phone" for s in spans) == 60_000


def test_local_phones_within_base_spans_go_as_by_comparing_all():
    from tidemark.llm.personal import further_spans
    rng = random.Random(6)
    pieces = ["+49 555-123-4567", "555-123-4567", "(555) 123-4567@x.org", "tel", "10.20.30.40", " ", "4111 1111 1111 1111", "\n", "555-123-4567@a.de"]
    for _ in range(300):
        text = " ".join(rng.choice(pieces) for _ in range(rng.randrange(1, 14)))
        base = base_spans(text)
        lone = {(a, b) for a, b, kind in further_spans(text) if kind == "local_phone" and not any(x < b and a < y for x, y, _ in base)}
        assert {(s["first"], s["end"]) for s in all_spans(text, threshold=0.0) if s["kind"] == "local_phone"} == lone
