import hashlib
import random
import re

import numpy as np

from tidemark.llm.middle import SQL, Marks, Texts, character_marks, fill_in_middle, fill_in_middle_report, newline_marks, restored_text

UNITS = {"line": re.compile(r"[^\n]*\n|[^\n]+"), "char": re.compile(r"(?s).")}
ODD = ["", "\n", "\n\n", "a", "a\n", "\na", "é\n\U0001F600\n\x00z", "x" * 9, "\n" * 17, "0123456\n8", "01234567\n", "has <S> in\nit", "<\nP>", "<P\n>", "a<\n\n<"]


def brute(doc_id, text, unit="line", seed=7, rate=100, spm=50):
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[k:k + 8], 16) for k in (0, 8, 16, 24))
    u = UNITS[unit].findall(text)
    n = len(u)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return (doc_id, n, "plain", None, None, text)
    if h4 % 100 < spm:
        return (doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}")
    return (doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def random_texts(n, seed):
    rng = random.Random(seed)
    alphabet = "ab\n\n é漢\U0001F600<PSM>\x7f\x80߿"
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(70))) for _ in range(n)]


def key(row):
    return repr(tuple(row))


def test_marks_ranks_and_selects_equal_a_walk_over_the_bytes():
    rng = np.random.default_rng(5)
    for size in (8, 16, 64, 256):
        data = rng.choice(np.array([0x0A, 0x0B, 0x8A, 0x00, 0x80, 0xBF, 0xC3, 0xFF, 0x7F, 0x09], np.uint8), size)
        for marks, test in ((newline_marks, lambda b: b == 0x0A), (character_marks, lambda b: b & 0xC0 != 0x80)):
            held, places = Marks(marks(data.view("<u8"))), [k for k, b in enumerate(data.tolist()) if test(b)]
            assert held.rank(np.arange(size)).tolist() == [sum(p < k for p in places) for k in range(size)]
            assert held.select(np.arange(1, len(places) + 1)).tolist() == places


def test_units_of_texts_that_do_not_begin_on_words():
    texts = ODD + random_texts(200, 3)
    data = [t.encode() for t in texts]
    bounds = np.cumsum([0, *map(len, data)])
    held = Texts(np.frombuffer(b"".join(data), np.uint8), bounds)
    for unit, pattern in UNITS.items():
        found = [pattern.findall(t) for t in texts]
        n = held.units(unit)
        assert n.tolist() == [len(u) for u in found]
        for k in range(max(map(len, found)) + 1):
            at = held.unit_end(unit, np.minimum(k, n), n) - bounds[:-1]
            assert at.tolist() == [len("".join(u[:k]).encode()) for u in found]


def test_transformation_equals_brute_force(spark, make):
    rows = list(enumerate(ODD + random_texts(300, 1))) + [(None, "no\nid\n"), (5000, None), (7, "a\n"), (7, "a\n"), (-9, "below\nzero\nhere")]
    for how in ({}, {"unit": "char"}, {"rate": 40, "spm": 80, "seed": 11}):
        got = fill_in_middle(make(rows), **how).collect()
        assert sorted(map(key, got)) == sorted(key(brute(d, t, **how)) for d, t in rows)


def test_round_trip_and_forms(spark, make):
    docs = make(list(enumerate(random_texts(400, 8))))
    made = fill_in_middle(docs).withColumn("back", restored_text())
    both = made.join(docs.select("doc_id", "text"), "doc_id")
    assert both.where("back <> text").count() == 0
    assert {r.form for r in made.select("form").distinct().collect()} == {"plain", "psm", "spm"}


def test_report_equals_sql(spark, make):
    import duckdb
    rows = list(enumerate(ODD + random_texts(300, 2))) + [(None, "no\nid"), (5000, None)]
    documents = make(rows).toArrow()   # noqa: F841 - read by the SQL
    want = duckdb.sql(SQL).fetchall()
    got = fill_in_middle_report(make(rows)).collect()
    assert sorted(map(key, got)) == sorted(map(key, want))


def test_odd_input(spark, make, odd, clashing):
    got = {key(r) for r in fill_in_middle(odd).collect()}
    assert got == {key(brute(r.doc_id, r.text)) for r in odd.collect()}
    assert {key(r) for r in fill_in_middle(clashing(odd)).collect()} == got
    assert fill_in_middle_report(make([])).count() == 0
    long = "\n".join(f"line {k} é" for k in range(400_000))
    [row] = fill_in_middle(make([(3, long)])).collect()
    assert tuple(row) == brute(3, long)
