import random
import re

import numpy as np
from pyspark.sql import functions as F

from tests.llm.conftest import words
from tidemark.llm.quality import (COUNTS, IsolationForest, allowances, bounded_sample, calibrated_threshold, judged, keep_good, ratios, text_counts)

W = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w, seen, dup = W.findall(text), set(), 0
    for line in text.split("\n"):
        if W.search(line):
            dup += line in seen
            seen.add(line)
    runs, repeated = {}, set()
    for k in range(len(w) - 7):
        runs.setdefault(tuple(w[k:k + 8]), []).append(k)
    for places in runs.values():
        if len(places) > 1:
            for k in places:
                repeated.update(range(k, k + 8))
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeated))


def corpus(n=240):
    """Prose, and junk of four kinds; labels for most of them."""
    rng = random.Random(4)
    docs, labels = [], []
    for k in range(n):
        w = words(rng.randint(25, 90), 1000 + k, 2000)
        kind = k % 12
        if kind == 3:
            w = [x + rng.choice(["###", "$$$", "***"]) for x in w]
        elif kind == 5:
            w = [re.sub(r"\d", "Q", x).upper() + "!!" for x in w]
        elif kind == 7:
            w = [y for x in w for y in (x, "|")]
        docs.append((k, " ".join(w)))
        if k % 5:
            labels.append((k, 0 if kind in (3, 5, 7) else 1, 0))
    return docs, labels


def test_counts_equal_brute_force(odd):
    rng = random.Random(2)
    texts = [r.text for r in odd.collect()] + ["a\na\n\na \n a", "x y " * 40, " a b\x1cc \x0b\x0c\r\n", "# * $%&|<>"]
    texts += [" ".join(rng.choice("ab c\n") for _ in range(300)) for _ in range(30)]
    for text in texts:
        assert text_counts(text)[:5] == brute(text)


def test_junk_goes_and_prose_stays(spark, make):
    docs, labels = corpus()
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    kept = {r.doc_id: r.kept for r in judged(make(docs), marks).collect()}
    junk = [k for k in kept if k % 12 in (3, 5, 7)]
    assert sum(kept[k] for k in junk) == 0
    assert all(kept[k] for k in kept if k not in junk)
    frame = make(docs)
    stay = keep_good(frame, marks)
    assert stay.columns == frame.columns
    assert {r.doc_id for r in stay.collect()} == {k for k in kept if kept[k]}


def test_other_kinds_of_junk_go_on_held_out_rows(spark, make):
    """Junk in word length and repeated lines alone; the labels cover every second document."""
    rng, docs = random.Random(6), []
    for k in range(400):
        w = words(rng.randint(40, 90), 5000 + k, 2000)
        if k % 8 == 3:
            w = ["".join(rng.choice("ABCDabcdefgh0123") for _ in range(40)).lower() for _ in w]
        elif k % 8 == 5:
            w = [x[0] for x in w]
        text = " ".join(w)
        docs.append((k, "\n".join(" ".join(w[i:i + 6]) for i in range(0, len(w), 6)) + "\nread more" * 30 if k % 8 == 7 else text))
    marks = spark.createDataFrame([(k, 0 if k % 8 in (3, 5, 7) else 1, 0) for k, _ in docs if k // 8 % 2], "doc_id long, quality int, toxic int")
    kept = {r.doc_id: r.kept for r in judged(make(docs), marks).collect()}
    held = [k for k in kept if not k // 8 % 2]
    assert not any(kept[k] for k in held if k % 8 in (3, 5, 7))
    assert all(kept[k] for k in held if k % 8 not in (3, 5, 7))


def test_allowances():
    shown = ratios(np.array([text_counts(" ".join(words(60, k))) for k in range(300)]))
    allowed = allowances(shown)
    assert (shown <= allowed).all() and allowed[0] == 0.1 and allowed[4] > shown[:, 4].max()
    assert np.isinf(allowances(shown[:0])).all()


def test_without_labels_the_fixed_rules_decide(spark, make, odd, clashing):
    docs, _ = corpus(60)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert all(r.kept for r in judged(make(docs), none).collect())
    for frame in (odd, clashing(odd)):
        for r in judged(frame, none).collect():
            assert r.kept == (not r.base_failed) and r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        taken = frame.withColumn("counts", F.lit(1)).withColumn("Counts_", F.lit("x"))
        assert sorted(keep_good(taken, none).collect(), key=str) == sorted((r for r in taken.collect() if len(W.findall(r.text or "")) >= 20 and r.doc_id != 8), key=str)
    assert judged(make([]), none).collect() == [] == keep_good(make([]), none).collect()


def test_forest_finds_the_outlier_and_is_the_same_each_time():
    points = np.concatenate([np.random.default_rng(0).normal(0, 1, (500, 3)), [[9, 9, 9]]])
    score = IsolationForest(points).score(points)
    assert score.argmax() == 500
    assert np.array_equal(score, IsolationForest(points).score(points))
    assert len(IsolationForest(np.zeros((0, 3))).score(points)) == len(points)
    assert IsolationForest(np.zeros((1, 3))).score(points).shape == (501,)


def test_threshold():
    good, bad = np.linspace(0, 0.5, 1000), np.linspace(0.4, 1, 100)
    t = calibrated_threshold(good, bad)
    assert (good > t).mean() <= 0.002 and (bad > t).mean() > 0.8
    assert calibrated_threshold(good, bad[:0]) == calibrated_threshold(good[:0], bad) == 1.0
    assert calibrated_threshold(good, good) == 1.0


def test_sample_is_bounded_and_repeatable(spark):
    rows = spark.range(2000).withColumnRenamed("id", "doc_id")
    a = [r.doc_id for r in bounded_sample(rows, "doc_id", 100).collect()]
    assert 50 < len(a) <= 100 and a == [r.doc_id for r in bounded_sample(rows.repartition(7), "doc_id", 100).collect()]
    assert len(COUNTS) == len(text_counts("a"))
