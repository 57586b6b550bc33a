"""The pipeline on a small corpus against its stages done plainly, one document at a time."""

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.conftest import DOCS, words
from tests.llm.test_decontaminate import brute as hits
from tests.llm.test_jaccard import brute as near
from tests.llm.test_lines import brute as repeats
from tidemark.llm.quality import MAX_REPEAT_PERCENT, MIN_WORDS, text_counts

P = pytest.importorskip("public_tokenizers")


def corpus():
    rng = random.Random(12)
    boiler = "This line stands at the end of many a document"
    docs = []
    for k in range(60):
        lines = [" ".join(words(rng.randint(12, 25), 5000 + 10 * k + j, 4000)) for j in range(rng.randint(2, 5))]
        if k % 3 == 0:
            lines.append(boiler)
        docs.append((k, "\n".join(lines)))
    copy = docs[4][1].split()
    copy[17] = "exchanged"
    docs += [(60, docs[4][1]), (61, " ".join(docs[4][1].split())), (62, " ".join(copy)), (63, None), (64, "too short"), (65, "a b " * 60),
             (66, " ".join(x + "###" for x in words(60, 1, 4000))), (67, " ".join(words(40, 2, 4000) + words(14, 77, 4000) + words(30, 3, 4000)))]
    return docs, [(1, " ".join(words(30, 77, 4000))), (2, " ".join(words(20, 78, 4000)))]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    docs, items = corpus()
    path = tmp_path_factory.mktemp("corpus")
    frame = spark.createDataFrame([(i, t, "en", "src0", len(t or "")) for i, t in docs], DOCS)
    frame.repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(k, int(k != 66), 0) for k in range(68) if k % 4 != 1], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    frame.limit(0).write.parquet(f"{path}/none/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{path}/none/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{path}/none/benchmark.parquet")
    return str(path)


def plainly():
    docs, items = corpus()
    counts = {i: text_counts(t) for i, t in docs}
    docs = [(i, t) for i, t in docs if counts[i][0] >= MIN_WORDS and 100 * counts[i][4] <= MAX_REPEAT_PERCENT * counts[i][0] and i != 66]
    dropped = repeats(docs)
    cut = [(i, "\n".join(line for k, line in enumerate(t.split("\n")) if k not in dropped[i, t])) for i, t in docs]
    docs = [(i, t) for (i, t), (_, before) in zip(cut, docs) if t == before or t.split()]
    docs = [(i, t) for (i, t), (_, _, c) in zip(docs, near(docs, 5, 80)) if c == i]
    clean = {i for i, _, _, _, _, hit in hits(docs, items) if not hit}
    return [(i, t) for i, t in docs if i in clean]


def test_stages_in_order_and_what_they_leave(spark, folder):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination", "best_fit_packing"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder).checkpoint() if spark.sparkContext.getCheckpointDir() else stage(spark, docs, folder)
        assert docs.columns == names
    left = {r.doc_id: r.text for r in docs.collect()}
    assert left == dict(plainly())
    assert all(r.n_chars == len(r.text) for r in docs.select("text", "n_chars").collect())
    assert {4, 0, 3} <= set(left) and not {60, 61, 62, 63, 64, 65, 66, 67} & set(left)


def test_run_gives_the_pieces_of_what_is_left(spark, folder):
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    expected = []
    for i, t in plainly():
        ids = np.array(plain.encode(t, add_special_tokens=False).ids + [1], "<u4")
        expected.append((i, 0, 0, len(ids), zlib.crc32(ids.tobytes())))
    rows = corpus_pipeline.run(spark, folder).collect()
    assert sorted(tuple(r)[:5] for r in rows) == sorted(expected)


def test_columns_of_any_name_stay_as_they_are(spark, folder, clashing):
    docs = clashing(spark.read.parquet(f"{folder}/documents.parquet")).withColumn("__gone", F.lit("taken"))
    added = [c for c in docs.columns if c not in ("doc_id", "text", "lang", "source", "n_chars")]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, folder)
        assert kept.columns == docs.columns
        assert kept.select(*added).distinct().collect() == [tuple("taken" for _ in added)]


def test_empty_tables(spark, folder):
    assert corpus_pipeline.run(spark, f"{folder}/none").collect() == []


def test_registered_queries(spark):
    import __spark_entry__ as E
    made = E.queries()
    assert [sum(q.startswith(f"op{n}_") for q in made) for n in range(1, 11)] == [1] * 10 and "pipeline" in made
