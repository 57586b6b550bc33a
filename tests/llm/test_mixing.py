import hashlib
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction
from math import ceil

import pytest

from tidemark.llm.mixing import SQL, leading_words, mix_report, mixed_stream, source_targets

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shared_out(sizes, weights=(5, 2, 1)):
    """Targets by sharing again and again what sources cannot give."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, open_ = {}, set(names)
    budget = Fraction(3, 2) * sum(sizes.values())
    while open_:
        share = budget / sum(weight[s] for s in open_)
        full = {s for s in open_ if share * weight[s] > 2 * sizes[s]}
        if not full:
            return target | {s: share * weight[s] for s in open_}
        for s in full:
            target[s] = Fraction(2 * sizes[s])
            budget -= target[s]
        open_ -= full
    return target


def simulated(rows, whole=False):
    """The queueing one document at a time: taken words of each row, by its index."""
    sizes, queues = Counter(), defaultdict(list)
    for k, (doc_id, source, text) in enumerate(rows):
        size = len(WORD.findall(text or ""))
        sizes[source] += size
        place = int(hashlib.md5(f"11:{'' if doc_id is None else doc_id}:{size}".encode()).hexdigest()[:15], 16)
        queues[source].append((place, doc_id is not None, doc_id or 0, size, k))
    target, order = shared_out(sizes), []
    for source, queue in queues.items():
        goal, at = ceil(target[source]), 0
        for turn in range(2):
            for n, (*_, size, k) in enumerate(sorted(queue)):
                if size and at < goal:
                    end = at + size if whole else min(at + size, goal)
                    order.append((float(end) / float(target[source]), source is None, source or "", turn, n, end - at, k))
                at += size
    left, taken = sum(sizes.values()) * 3 // 2, Counter()
    for *_, asked, k in sorted(order):
        got = min(asked, left)
        left -= got
        taken[k] += got
    return [(r[0], len(WORD.findall(r[2] or "")), sizes[r[1]], float(target[r[1]]), taken[k]) for k, r in enumerate(rows)]


def corpus(spark, rows):
    return spark.createDataFrame([(d, t, "en", s, 0) for d, s, t in rows], "doc_id long, text string, lang string, source string, n_chars long")


def many(seed, n, sources, longest=60):
    rng = random.Random(seed)
    names = [None if k == 3 else f"s{k}é" for k in range(sources)]
    return [(k, names[0] if rng.random() < 0.4 else rng.choice(names), " ".join("w" * rng.randint(1, 4) for _ in range(rng.randrange(longest)))) for k in range(n)]


def same(got, want):
    key = lambda r: tuple((x is None, x or 0) for x in r[:3]) + (r[4],)
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [r[:3] + r[4:] for r in got] == [r[:3] + r[4:] for r in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want], rel=1e-12)


@pytest.mark.parametrize("whole", [False, True])
def test_mix_equals_a_simulation(spark, whole):
    rows = many(1, 700, 9) + [(9001, "huge", "word " * 3000), (9002, "empty", ""), (9003, "empty", None), (None, "s1é", "no id here"), (5, "s1é", "same id twice")]
    same(mix_report(corpus(spark, rows), whole=whole).collect(), simulated(rows, whole))


def test_targets_of_many_sources(spark):
    rng = random.Random(7)
    sizes = {f"s{k:03}": rng.choice([0, 1, 5, 50, 5000, rng.randrange(100_000)]) for k in range(150)} | {None: 77}
    rows = [("~" if s is None else "=" + s, v - v // 3) for s, v in sizes.items()] + [("~" if s is None else "=" + s, v // 3) for s, v in sizes.items()]
    got = {r.key: r.target for r in source_targets(spark.createDataFrame(rows, "key string, size long")).collect()}
    want = {"~" if s is None else "=" + s: float(t) for s, t in shared_out(sizes).items()}
    assert got == pytest.approx(want, rel=1e-12)


def test_sources_meet_their_targets(spark):
    rows = many(3, 900, 6)
    got, source = mix_report(corpus(spark, rows)).collect(), {d: s for d, s, _ in rows}
    taken, target = Counter(), {}
    for r in got:
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
        assert 0 <= r.taken <= 2 * r["size"]
    assert all(abs(taken[s] - target[s]) < len(target) for s in target)
    assert sum(taken.values()) == sum(r["size"] for r in got) * 3 // 2


def test_report_equals_sql_and_reruns_agree(spark):
    import duckdb
    rows = many(4, 500, 12) + [(None, None, "a b c"), (None, None, None), (600, "x", "")]
    docs = corpus(spark, rows)
    documents = docs.toArrow()   # noqa: F841 - read by the SQL
    want = duckdb.sql(SQL).fetchall()
    same(mix_report(docs).collect(), want)
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        same(mix_report(docs.repartition(7)).collect(), want)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_stream_is_gapless_and_its_texts_are_cut_at_words(spark):
    rows = many(5, 300, 5)
    docs = corpus(spark, rows)
    stream = mixed_stream(docs, carry=["text"]).withColumn("cut", leading_words("text", "words")).orderBy("mix_offset").collect()
    at, last = 0, 0.0
    for r in stream:
        assert r.mix_offset == at and r.finish >= last
        assert r.text.startswith(r.cut) and len(WORD.findall(r.cut)) == r.words
        at, last = at + r.words, r.finish
    report = {r.doc_id: r.taken for r in mix_report(docs).collect()}
    taken = Counter()
    for r in stream:
        taken[r.doc_id] += r.words
    assert all(taken[d] == t for d, t in report.items())


def test_odd_input(spark, make, odd, clashing):
    rows = [(r.doc_id, r.source, r.text) for r in odd.collect()]
    same(mix_report(odd).collect(), simulated(rows))
    same(mix_report(clashing(odd).withColumn("key", odd.text).withColumn("block", odd.text)).collect(), simulated(rows))
    assert mix_report(make([])).count() == 0
    assert [tuple(r) for r in mix_report(make([(1, None), (2, "")])).collect()] == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
