import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm.trie import SQL, _digests, centroid_sums, conversation_trie, end_digests, prefix_trie, turn_items

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    """All columns of the trie by walking every rebuilt conversation."""
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            turns.setdefault(conv, []).append((turn is not None, turn or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest(), role, text))
    turns = {c: [(r, t) for *_, r, t in sorted(ts)] for c, ts in turns.items()}
    built = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(turns.get(c - int(math.fmod(c, 20)), [])[:h] + own[h:])     # SQL's remainder
    nodes = {}
    for c, seq in sorted(built.items()):
        for d in range(len(seq) + 1):
            nodes.setdefault(seq[:d], []).append(c)
    children, leaves, saved = {}, {}, {}
    for seq in sorted(nodes, key=len, reverse=True):
        own = (len(nodes[seq]) - 1) * len(WORD.findall(seq[-1][1])) if seq else 0
        leaves[seq] = leaves.get(seq, 0) or 1
        saved[seq] = saved.get(seq, 0) + own
        if seq:
            up = seq[:-1]
            children[up] = children.get(up, 0) + 1
            leaves[up] = leaves.get(up, 0) + leaves[seq]
            saved[up] = saved.get(up, 0) + saved[seq]
    return sorted(((m[0], len(seq), nodes[seq[:-1]][0] if seq else None, len(m), children.get(seq, 0), leaves[seq], saved[seq],
                    hashlib.sha256(",".join(str(c) for c in m if built[c] == seq).encode()).hexdigest()) for seq, m in nodes.items()), key=repr)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def talk(seed, convs, longest=7, vocabulary=4, long=()):
    """Conversations with few distinct turns, so that prefixes are shared, copies, and some long ones."""
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        if rng.random() < 0.1:
            continue
        n = dict(long).get(c, rng.randint(0, longest) + 1)
        same = rng.random() < 0.3
        for t in range(n):
            text = "hello there you" if same or t == 0 and rng.random() < 0.5 else " ".join(rng.choice(["a", "bb", "ccc"]) for _ in range(rng.randrange(vocabulary)))
            rows.append((c, t, ("user", "assistant")[t % 2], text))
    return rows


@pytest.mark.parametrize("local_nodes", [None, 6])
def test_trie_equals_brute_force(spark, local_nodes):
    rows = talk(1, 70, long=[(5, 150), (40, 60)])
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert rows_of(conversation_trie(df, local_nodes)) == brute(rows)


def test_trie_equals_sql(spark):
    import duckdb
    rows = talk(2, 90) + [(-21, 0, "user", "below zero"), (-20, 1, None, None), (10**15, 0, "user", "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    conversations = df.toArrow()   # noqa: F841 - read by the SQL
    assert sorted(duckdb.sql(SQL).fetchall(), key=repr) == rows_of(conversation_trie(df)) == brute(rows)


def test_odd_input(spark, clashing):
    rows = [(1, None, "user", "null first"), (1, 0, None, "x y"), (1, 0, "user", None), (1, 0, "user", None), (None, 3, "user", "nobody's"),
            (20, 0, "user", ""), (21, 5, "a", "b"), (21, 5, "a", "b"), (22, 1, "a b", ""), (22, 1, "a", " b"), (40, 2, "u", "word " * 30000)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows)
    assert rows_of(conversation_trie(clashing(df).withColumn("position", F.lit("p")).withColumn("ends", F.lit(1)))) == want
    assert rows_of(conversation_trie(df.limit(0))) == []
    nobody = spark.createDataFrame([(None, 1, "u", "t")], SCHEMA)
    assert rows_of(conversation_trie(nobody)) == []


def test_sums_by_centroids_equal_sums_from_below():
    rng = random.Random(3)
    for n, parent in ((1, lambda k: 0), (400, lambda k: k - 1), (400, lambda k: 0), (300, lambda k: rng.randrange(k)), (300, lambda k: max(0, k - rng.randint(1, 3)))):
        parents = [0] + [parent(k) for k in range(1, n)]
        values = [(rng.randrange(9), rng.randrange(5)) for _ in range(n)]
        want, weights = [list(v) for v in values], [rng.randint(1, 4) for _ in range(n)]
        for k in range(n - 1, 0, -1):
            weights[parents[k]] += weights[k]
            want[parents[k]] = [a + b for a, b in zip(want[parents[k]], want[k], strict=True)]
        assert centroid_sums(parents, weights, values) == want


def test_own_prefixes_without_a_shared_head(spark):
    df = spark.createDataFrame([(1, 0, "u", "a b"), (1, 1, "u", "c"), (2, 0, "u", "a b"), (3, 0, "u", "z")], SCHEMA)
    turns = turn_items(df)
    got = {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens) for r in prefix_trie(turns, turns.select("conv_id").distinct()).collect()}
    assert got == {(1, 0): (None, 3, 2, 2, 2), (1, 1): (1, 2, 1, 1, 2), (1, 2): (1, 1, 0, 1, 0), (3, 1): (1, 1, 0, 1, 0)}


def test_digests_of_many_ids_go_through_chunks(spark):
    places = spark.range(0, 30000, 3).select(F.col("id").alias("conv_id"), F.lit(2).cast("long").alias("depth"), F.lit(0).cast("long").alias("node_conv"), F.lit(True).alias("ends"))
    [row] = end_digests(places).collect()
    assert row.ends_sha256 == hashlib.sha256(",".join(map(str, range(0, 30000, 3))).encode()).hexdigest()
    assert list(_digests(iter([]))) == []
