import random
import zlib

import numpy as np
import pytest

from tidemark.llm.language import ByteTagger, _padded, identified_languages, predicted_languages, segments, trained_tagger

SYLLABLES = {"xx": ["ka", "to", "mi", "ru", "ne"], "yy": ["sch", "ung", "ein", "ber", "ö"], "zz": ["ção", "lho", "ment", "qua", "ê"]}


def corpus(n=240, seed=3):
    rng = random.Random(seed)
    docs = []
    for k in range(n):
        lang = sorted(SYLLABLES)[k % 3]
        docs.append((k, " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(5, 40))) + ".", lang))
    return docs


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), "doc_id long, text string, lang string").repartition(3)


def test_gradient_equals_differences():
    tagger = ByteTagger(["a", "b", "c"], hidden=3)
    tagger.w = {k: w.astype(np.float64) for k, w in tagger.w.items()}
    bytes_, mask = _padded([b"abca", b"b", b"cab"])
    label = np.array([0, 2, 1])
    _, grad = tagger.train_step(bytes_, mask, label)
    rng = np.random.default_rng(1)
    for name, w in tagger.w.items():
        touched = np.argwhere(np.abs(grad[name]) > 1e-4)
        for at in touched[rng.permutation(len(touched))[:6]]:
            at, old = tuple(at), w[tuple(at)]
            w[at] = old + 2e-3
            up = tagger.train_step(bytes_, mask, label)[0]
            w[at] = old - 2e-3
            down = tagger.train_step(bytes_, mask, label)[0]
            w[at] = old
            assert abs((up - down) / 4e-3 - grad[name][at]) < 2e-3 + 0.03 * abs(grad[name][at]), (name, at)


def test_evidence_is_that_of_every_position():
    tagger = ByteTagger(["a", "b"], hidden=4)
    found = [b"abc", b"de", b"abc", "éa".encode()]
    out = tagger.evidence(found)
    assert out[:, -1].tolist() == [3, 2, 3, 3] and np.allclose(out[0], out[2]) and (out[:, :2] < 0).all()
    assert np.allclose(tagger.evidence([b"de"])[0], out[1], atol=1e-5)


def test_held_out_accuracy(docs):
    rows = identified_languages(docs).collect()
    truth = {k: lang for k, _, lang in corpus()}
    unseen = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert len(unseen) > 20 and np.mean([r.lang_pred == truth[r.doc_id] for r in unseen]) >= 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_documents(spark, docs, odd, make, clashing):
    tagger = trained_tagger(docs)
    known = {r.doc_id: r for r in predicted_languages(clashing(odd), tagger).collect()}
    assert [known[k].lang_pred for k in (3, 4, 5)] == ["und"] * 3
    digits = predicted_languages(make([(1, "123 ... \U0001F600 —"), (2, "kato" * 500)]), tagger).collect()
    assert {r.doc_id: r.lang_pred for r in digits} == {1: "und", 2: "xx"}
    assert predicted_languages(odd, tagger).count() == odd.count()
    none = spark.createDataFrame([(1, "kato", None), (None, None, None)], "doc_id long, text string, lang string")
    assert {(r.doc_id, r.held_out, r.lang_pred) for r in identified_languages(none).collect()} == {(1, zlib.crc32(b"1") % 5 == 0, "und"), (None, True, "und")}
    assert identified_languages(docs.limit(0)).collect() == []


def test_held_out_rows_are_never_learned_from(spark, docs):
    from pyspark.sql import functions as F

    from tidemark.llm.language import held_out, training_sample
    other = docs.withColumn("text", F.when(held_out(F.col("doc_id")), F.lit("changed")).otherwise(F.col("text")))
    assert training_sample(docs) == training_sample(other) and training_sample(docs)


def test_segments():
    assert segments("Ab, c1d É!") == [b"ab", b"c", b"d", "é".encode()]
    assert [len(s) for s in segments("x" * 130)] == [64, 64, 2]


def test_runs_are_cut_between_characters():
    from tidemark.llm.language import MAX_SEGMENT, segments
    for text in ("漢" * 100, "a" + "é" * 90, "x" * 200, "\U0001F600a" * 40):
        pieces = segments(text)
        assert "".join(p.decode() for p in pieces) == text and all(len(p) <= MAX_SEGMENT for p in pieces)
