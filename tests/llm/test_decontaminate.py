import hashlib
import re

from tests.llm.conftest import words
from tidemark.llm.decontaminate import benchmark_blocks, contamination_report, decontaminate

W = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def tokens(text):
    return W.findall(re.sub("[A-Z]+", lambda m: m.group().lower(), text or ""))


def brute(docs, bench):
    grams = {}
    for item, text in bench:
        w = tokens(text)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            grams.setdefault(tuple(w[k:k + n]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, items = tokens(text), set(), set()
        for gram, ids in grams.items():
            for k in range(len(w) - len(gram) + 1):
                if w[k] == gram[0] and tuple(w[k:k + len(gram)]) == gram:
                    hit.update(range(k, k + len(gram)))
                    items |= ids
        digest = hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(items), digest, bool(hit)))
    return out


def fixture():
    items = [(k, " ".join(words(25, 900 + k))) for k in range(8)] + [(20, "short item, four Words"), (21, ""), (22, None), (23, "..."), (100, "short ITEM four words")]
    passage = items[3][1].split()
    docs = [(1, " ".join(words(30, 1) + passage[4:14] + words(10, 2))), (2, " ".join(words(30, 1) + passage[4:13] + ["x"] + passage[16:])),
            (3, "Here: SHORT-item; four\nwords! é" + " ".join(passage).upper()), (4, None), (5, ""), (6, items[0][1]), (6, items[0][1]),
            (7, " ".join(items[1][1].split()[:10])), (8, " ".join(items[1][1].split()[1:10])), (None, "short item four words short item four words"),
            (9, items[2][1].replace(" ", "é "))]
    return docs, items


def passage_start(items):
    return items[3][1].split()[0].upper()


def rows(df):
    return sorted(map(tuple, df.collect()), key=lambda r: (r[0] is None, r[0] or 0))


def test_report_equals_brute_force(spark, make, clashing):
    docs, items = fixture()
    bench = spark.createDataFrame(items, "item_id long, text string")
    expected = sorted(brute(docs, items), key=lambda r: (r[0] is None, r[0] or 0))
    assert rows(contamination_report(make(docs), bench)) == expected
    assert rows(contamination_report(clashing(make(docs)), bench)) == expected


def test_several_blocks_give_the_same(spark, make, monkeypatch):
    import tidemark.llm.decontaminate as d
    docs, items = fixture()
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert len(list(benchmark_blocks(bench, 300))) > 3
    got = d.scan(make(docs).select("doc_id", "text"), bench, block_bytes=300).select("doc_id", "n_words", "n_hit", "items")
    expected = sorted(brute(docs, items), key=lambda r: (r[0] is None, r[0] or 0))
    assert [(a, b, c, len(i)) for a, b, c, i in rows(got)] == [r[:4] for r in expected]


def test_odd_documents_and_empty_tables(spark, odd, make):
    bench = spark.createDataFrame([(1, " ".join(words(120, 1)[20:40]))], "item_id long, text string")
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    expected = sorted(brute(docs, [(1, " ".join(words(120, 1)[20:40]))]), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    assert sorted(map(tuple, contamination_report(odd, bench).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1])) == expected
    assert all(not r.contaminated for r in contamination_report(odd, bench.limit(0)).collect())
    assert contamination_report(make([]), bench).collect() == []


def test_actions(spark, make):
    docs, items = fixture()
    bench = spark.createDataFrame(items, "item_id long, text string")
    frame = make(docs)
    clean = {r[0] for r in brute(docs, items) if not r[5]}
    assert {r.doc_id for r in decontaminate(frame, bench).collect()} == clean
    cut = decontaminate(frame, bench, action="spans")
    assert cut.columns == frame.columns
    texts = {r.doc_id: r.text for r in cut.collect()}
    assert texts[1] == " ".join(words(30, 1)) + "  " + " ".join(words(10, 2))
    assert texts[3] == "Here: ! é" + passage_start(items) + " "
    assert texts[4] is None and texts[2] == docs[1][1]
    assert all(not hit for _, _, hit, *_ in brute([(k, t) for k, t in texts.items() if k == 1], items))


def test_items_without_an_id_are_windows_too(spark, make):
    docs, items = fixture()
    items = [(None if k in (0, 20) else k, text) for k, text in items] + [(None, None)]
    every = brute(docs, items)
    none = hashlib.sha256(b"").hexdigest()
    named = {doc: (n_items, digest) for doc, _, _, n_items, digest, _ in brute(docs, [(k, t) for k, t in items if k is not None])}
    expected = [(doc, n, hit, *named[doc], found) for doc, n, hit, _, _, found in every]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = rows(contamination_report(make(docs), bench))
    assert got == sorted(expected, key=lambda r: (r[0] is None, r[0] or 0))
    assert [r for r in got if r[0] == 6] == [(6, 25, 25, 0, none, True)] * 2
    assert not {6} & {r.doc_id for r in decontaminate(make(docs), bench).collect()}


def test_blocks_are_not_stacked_in_one_plan(spark, make):
    import tidemark.llm.decontaminate as d
    docs, items = fixture()
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert len(list(benchmark_blocks(bench, 150))) > 5
    plan = d.scan(make(docs).select("doc_id", "text"), bench, block_bytes=150)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
