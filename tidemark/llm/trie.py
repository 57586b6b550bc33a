"""Prefix trie of conversations, rolled up by centroid decomposition.

A node is a distinct sequence of first turns; it is named by its smallest member and its depth, which
no other node shares.  Prefixes are told apart by 128 bits that are sums over ``(position, turn)``, so
the prefixes of a conversation of any length are running sums over blocks of it.

Sums over subtrees: the parent edges are one component at first.  Each component is cut at a centroid:
of the nodes whose subtree holds half of the component's weight or more, which form a path from the top
downwards, the last.  The total of the centroid's subtree is added to every node of that path; what
hangs below the centroid comes apart into one component for each child; the rest goes on without the
subtree.  A node's weight is the number of its members, so the weight of a subtree is a sum over members
that the grouping into nodes yields anyway, and what a cut takes away from it is subtracted on the path
alone.  Weights of components at least halve each time, so the rounds are at most the logarithm of the
number of turns, however deep (one conversation of all turns) or broad (all under one first turn) the
trie is.  A component of few nodes is finished by one task in the same way.

Which node of a conversation stands at a depth is a table of one row per turn; so a node is below the
centroid if its conversation's node at the centroid's depth is the centroid.  No group is gathered: hot
prefixes, components and conversations go through partial aggregates and joins that Spark splits.  Each
round's rows are written to the shared folder, so a lost executor costs one round.

The digest of the members that end at a node needs their ids in order: ids are joined into bounded
chunks by many tasks; only the chunks of a node meet, and are hashed as a stream.

Results for odd input: a null turn comes first, turns that are equal are ordered by a digest of role
and text; null role and text are empty; repeated rows are turns of their own; rows without a conv_id
belong to no conversation; an empty table has no root; further columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, materialize, ship_package, small_or_shuffled
from tidemark.llm.running import running_sums
from tidemark.operators.ranking import ordinal_within

#: Fixed value: a word.
WORD = r"[^\x20\x09-\x0D]+"
#: Turns of a conversation in one block, ids in one chunk.
TURNS, IDS = 4096, 4096
#: Nodes of a component that one task finishes, at most.
LOCAL_NODES = 20_000
#: Rows of a table by component that are broadcast at most.
BROADCAST_ROWS = 50_000

KEY = ["k1", "k2", "k3", "k4"]
NODE, TOP = ["conv_id", "depth"], ["top_conv", "top_depth"]


def turn_items(conversations: DataFrame) -> DataFrame:
    """``(conv_id, position, item, words)``: turns in order from 1, a digest of role and text, the text's words."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    said = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.md5(said.cast("binary")).alias("item"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"), F.monotonically_increasing_id().alias("tie"))
    placed = ordinal_within(turns, "conv_id", ["turn", "item", "tie"], out="position")
    return placed.select("conv_id", F.col("position").cast("long").alias("position"), "item", "words")


def with_shared_heads(turns: DataFrame, group: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt on the first turns of their group's first: the first h turns of conversation
    ``c - c % group`` (none if it is absent), then c's own after its first h; h is CRC-32 of c modulo
    ``heads``.  Returns the turns and all conversations ``(conv_id)``, the turnless too."""
    turns = materialize(turns, "trie-turns")
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    donor = F.col("conv_id") - F.col("conv_id") % group
    convs = materialize(turns.select("conv_id").distinct(), "trie-conversations")
    first = turns.where((F.col("conv_id") % group == 0) & (F.col("position") < heads)).withColumnRenamed("conv_id", "donor")
    given = convs.withColumns({"h": h, "donor": donor}).join(first, "donor").where("position <= h").select("conv_id", "position", "item", "words")
    lengths = small_or_shuffled(materialize(first.groupBy("donor").agg(F.count("*").alias("there")), "trie-heads"), BROADCAST_ROWS)
    own = turns.withColumns({"h": h, "donor": donor}).where("position > h").join(lengths, "donor", "left")
    shift = F.col("h") - F.least("h", F.coalesce("there", F.lit(0)))
    own = own.select("conv_id", (F.col("position") - shift).alias("position"), "item", "words")
    return own.unionByName(given), convs


def prefixes(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """A row for each conversation and each of its prefixes, the empty one too: ``(conv_id, depth, k1..k4,
    words, length)``, the key being the same for equal prefixes."""
    low = lambda c: c.bitwiseAND(F.lit((1 << 32) - 1))
    made = {}
    for k, salt in enumerate(("a", "b")):
        hashed = F.xxhash64(F.lit(salt), F.col("position"), F.col("item"))
        made |= {f"p{2 * k + 1}": low(hashed), f"p{2 * k + 2}": F.shiftrightunsigned(hashed, 32)}
    parts = materialize(turns.select("conv_id", "position", "words", *[c.alias(n) for n, c in made.items()],
                                     F.floor(F.col("position") / TURNS).alias("block"), F.lit(1).cast("long").alias("one")), "trie-parts")
    summed = running_sums(parts, ["conv_id"], "block", ["position"], {f"k{n}": f"p{n}" for n in range(1, 5)}, totals={"length": "one"})
    rows = summed.select("conv_id", F.col("position").alias("depth"), *[(F.col(f"k{n}") + F.col(f"p{n}")).alias(f"k{n}") for n in range(1, 5)], "words", "length")
    lengths = parts.groupBy("conv_id").agg(F.count("*").alias("length"))
    zero = F.lit(0).cast("long")
    roots = convs.join(lengths, "conv_id", "left").select("conv_id", zero.alias("depth"), *[zero.alias(k) for k in KEY], zero.alias("words"),
                                                          F.coalesce("length", zero).alias("length"))
    return materialize(rows.unionByName(roots), "trie-prefixes")


def trie(turns: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``nodes``: (conv_id, depth, parent_conv_id, n_convs, n_children, saved, weight), not yet rolled up;
    ``places``: for each conversation and depth the node there (node_conv), the one above (above), and
    whether the conversation ends there."""
    rows = prefixes(turns, convs)
    named = materialize(rows.groupBy("depth", *KEY).agg(
        F.min("conv_id").alias("node_conv"), F.count("*").alias("n_convs"), F.max("words").alias("words"),
        F.sum(F.col("length") - F.col("depth") + 1).alias("weight")), "trie-named")
    at = materialize(rows.join(named.select("depth", *KEY, "node_conv"), ["depth", *KEY]).select(
        "conv_id", "depth", "node_conv", (F.col("depth") == F.col("length")).alias("ends")), "trie-at")
    above = at.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("node_conv").alias("above"))
    places = materialize(at.join(above, NODE, "left"), "trie-places")
    nodes = named.select(F.col("node_conv").alias("conv_id"), "depth", "n_convs", ((F.col("n_convs") - 1) * F.col("words")).alias("saved"), "weight") \
        .join(places.select(*NODE, F.col("above").alias("parent_conv_id")), NODE)
    children = nodes.where("parent_conv_id IS NOT NULL").groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")) \
        .agg(F.count("*").alias("n_children"))
    return materialize(nodes.join(children, NODE, "left").fillna(0, ["n_children"]), "trie-nodes"), places


def centroid_sums(parents: list[int], weights: list[int], values: list[tuple[int, ...]]) -> list[list[int]]:
    """Sums of ``values`` over the subtrees of one tree: node 0 is the top, every other stands behind its
    parent; ``weights`` are of whole subtrees and are spent."""
    sums = [[0] * len(v) for v in values]
    part = [0] * len(parents)
    pieces, made = [list(range(len(parents)))], 0
    while pieces:
        piece = pieces.pop()
        half = weights[piece[0]]
        path = [v for v in piece if 2 * weights[v] >= half]
        centre = path[-1]
        cut: dict[int, list[int]] = {}
        here, total = part[centre], list(values[centre])
        for v in piece:
            if v == centre:
                part[v] = -1
            elif v != piece[0] and part[parents[v]] != here:     # its parent is the centre or went below it
                if parents[v] == centre:
                    made += 1
                    part[v] = made
                else:
                    part[v] = part[parents[v]]
                total = [a + b for a, b in zip(total, values[v], strict=True)]
                cut.setdefault(part[v], []).append(v)
            else:
                cut.setdefault(here, []).append(v)
        spent = weights[centre]
        for v in path:
            sums[v] = [a + b for a, b in zip(sums[v], total, strict=True)]
            weights[v] -= spent
        pieces.extend(cut.values())
    return sums


def _finished(piece: pa.Table) -> pa.Table:
    """The sums of one component of few nodes."""
    piece = piece.sort_by([("depth", "ascending")])
    conv, depth, parent, weight, leaves, saved = (piece.column(c).to_pylist() for c in ("conv_id", "depth", "parent_conv_id", "weight", "leaves", "saved"))
    place = {n: k for k, n in enumerate(zip(conv, depth, strict=True))}
    parents = [0 if not k else place[p, d - 1] for k, (p, d) in enumerate(zip(parent, depth, strict=True))]
    sums = centroid_sums(parents, weight, list(zip(leaves, saved, strict=True)))
    return pa.table([piece.column("conv_id"), piece.column("depth"), pa.array([s[0] for s in sums], pa.int64()), pa.array([s[1] for s in sums], pa.int64())],
                    names=["conv_id", "depth", "leaves", "saved"])


def subtree_sums(nodes: DataFrame, places: DataFrame, local_nodes: int | None = None) -> DataFrame:
    """``(conv_id, depth, leaves, saved)``: sums of the nodes' ``leaves`` and ``saved`` over their subtrees."""
    spark = nodes.sparkSession
    if local_nodes is None:
        share = 2 * nodes.count() // int(spark.conf.get("spark.sql.shuffle.partitions"))
        local_nodes = min(LOCAL_NODES, max(64, share))
    fields = [*NODE, "parent_conv_id", "weight", "leaves", "saved"]
    root = nodes.where("depth = 0").select(F.col("conv_id").alias("top_conv"), F.col("depth").alias("top_depth"))
    state = nodes.crossJoin(F.broadcast(root)).select(*TOP, *fields)        # one row at most: all begin with nothing
    below_of = places.select("conv_id", F.col("depth").alias("child_depth"), F.col("node_conv").alias("child_conv"), "above")
    done, added = [], []
    while True:
        large = materialize(state.groupBy(*TOP).agg(F.count("*").alias("n"), F.max("weight").alias("total")).where(F.col("n") > local_nodes), "trie-large")
        if large.isEmpty():
            done.append(state)
            break
        large = small_or_shuffled(large, BROADCAST_ROWS)
        done.append(state.join(large, TOP, "left_anti"))
        path = state.join(large, TOP).where("2 * weight >= total")
        cuts = materialize(path.groupBy(*TOP).agg(F.max("total").alias("total"), F.min_by(F.struct("conv_id", "depth", "weight"), "weight").alias("centre"))
                           .select(*TOP, "total", F.col("centre.conv_id").alias("c_conv"), F.col("centre.depth").alias("c_depth"),
                                   F.col("centre.weight").alias("c_weight")), "trie-cuts")
        cut = state.join(small_or_shuffled(cuts, BROADCAST_ROWS), TOP).withColumn("child_depth", F.col("c_depth") + 1)
        cut = cut.join(below_of, ["conv_id", "child_depth"], "left")
        below = (F.col("depth") > F.col("c_depth")) & F.coalesce(F.col("above") == F.col("c_conv"), F.lit(False))
        cut = materialize(cut.select(*TOP, *fields, "c_conv", "c_depth", "c_weight", "child_conv", "child_depth",
                                     (2 * F.col("weight") >= F.col("total")).alias("on_path"), below.alias("below")), "trie-round")
        centre = (F.col("conv_id") == F.col("c_conv")) & (F.col("depth") == F.col("c_depth"))
        totals = cut.where(centre | F.col("below")).groupBy(*TOP).agg(F.sum("leaves").alias("t_leaves"), F.sum("saved").alias("t_saved"))
        added.append(cut.where("on_path").select(*TOP, *NODE).join(totals, TOP).select(*NODE, F.col("t_leaves").alias("leaves"), F.col("t_saved").alias("saved")))
        state = cut.where(~centre).select(
            F.when(F.col("below"), F.col("child_conv")).otherwise(F.col("top_conv")).alias("top_conv"),
            F.when(F.col("below"), F.col("child_depth")).otherwise(F.col("top_depth")).alias("top_depth"), *NODE, "parent_conv_id",
            (F.col("weight") - F.when(F.col("on_path"), F.col("c_weight")).otherwise(F.lit(0))).alias("weight"), "leaves", "saved")
    ship_package(spark)
    rest = done[0]
    for part in done[1:]:
        rest = rest.unionByName(part)
    sums = rest.groupBy(*TOP).applyInArrow(_finished, "conv_id long, depth long, leaves long, saved long")
    for part in added:
        sums = sums.unionByName(part)
    return sums.groupBy(*NODE).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of chunks in order, a chunk at a time: a node's state lives on from batch to batch."""
    now, digest = None, None
    names = ["conv_id", "depth", "ends_sha256"]

    def closed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                                           pa.array([r[2] for r in rows], pa.string())], names=names)
    for batch in batches:
        out = []
        for conv, depth, ids in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            if (conv, depth) == now:
                digest.update(b",")
            else:
                if now is not None:
                    out.append((*now, digest.hexdigest()))
                now, digest = (conv, depth), hashlib.sha256()
            digest.update(ids.encode())
        if out:
            yield closed(out)
    if now is not None:
        yield closed([(*now, digest.hexdigest())])


def end_digests(places: DataFrame) -> DataFrame:
    """``(conv_id, depth, ends_sha256)`` of the nodes at which members end."""
    chunks = places.where("ends").groupBy(F.col("node_conv").alias("node"), "depth", F.floor(F.col("conv_id") / IDS).alias("chunk")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("ids"))
    laid = chunks.repartition("node", "depth").sortWithinPartitions("node", "depth", "chunk").select("node", "depth", "ids")
    return map_batches(laid, _digests, "conv_id long, depth long, ends_sha256 string")


def prefix_trie(turns: DataFrame, convs: DataFrame, local_nodes: int | None = None) -> DataFrame:
    """One row per distinct prefix of ``turns`` ``(conv_id, position, item, words)``, positions from 1 without
    gaps, and of the empty prefix that all ``convs`` share."""
    nodes, places = trie(turns, convs)
    valued = nodes.withColumn("leaves", (F.col("n_children") == 0).cast("long"))
    sums = subtree_sums(valued, places, local_nodes)
    joined = nodes.drop("saved", "weight").join(sums, NODE).join(end_digests(places), NODE, "left")
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return joined.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
                         F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", none).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame, local_nodes: int | None = None) -> DataFrame:
    """The trie of conversations rebuilt on shared heads."""
    return prefix_trie(*with_shared_heads(turn_items(conversations)), local_nodes=local_nodes)


#: The trie in DuckDB SQL (sums over all ancestors of each node; for small tables).
SQL = r"""
WITH RECURSIVE items AS (
  SELECT conv_id, turn, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS item,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS words
  FROM conversations WHERE conv_id IS NOT NULL),
turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, item) AS position, item, words FROM items),
crc AS (
  SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS said, 0 AS step, CAST(4294967295 AS BIGINT) AS crc FROM turns
  UNION ALL
  SELECT conv_id, said, step + 1,
         CASE WHEN c % 2 = 1 THEN xor(c // 2, CAST(3988292384 AS BIGINT)) ELSE c // 2 END
  FROM (SELECT conv_id, said, step, CASE WHEN step % 8 = 0 THEN xor(crc, CAST(ascii(said[step // 8 + 1:step // 8 + 1]) AS BIGINT)) ELSE crc END AS c
        FROM crc WHERE step < 8 * length(said))),
convs AS (
  SELECT conv_id, conv_id - conv_id % 20 AS donor, xor(crc, CAST(4294967295 AS BIGINT)) % 4 AS h FROM crc WHERE step = 8 * length(said)),
lengths AS (SELECT conv_id AS donor, count(*) AS there FROM turns GROUP BY conv_id),
rebuilt AS (
  SELECT c.conv_id, t.position - c.h + least(c.h, coalesce(l.there, 0)) AS position, t.item, t.words
  FROM turns t JOIN convs c USING (conv_id) LEFT JOIN lengths l USING (donor) WHERE t.position > c.h
  UNION ALL
  SELECT c.conv_id, t.position, t.item, t.words FROM convs c JOIN turns t ON t.conv_id = c.donor AND t.position <= c.h),
prefixes AS (
  SELECT conv_id, position AS depth, string_agg(item, ',') OVER w AS key, words,
         position = max(position) OVER (PARTITION BY conv_id) AS ends
  FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY position)
  UNION ALL
  SELECT conv_id, 0, '', 0, NOT EXISTS (SELECT 1 FROM rebuilt r WHERE r.conv_id = c.conv_id) FROM convs c),
nodes AS (
  SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(words) AS saved,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM prefixes GROUP BY key, depth),
parents AS (
  SELECT n.key, n.depth, p.key AS parent_key FROM nodes n JOIN prefixes p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1),
children AS (SELECT parent_key AS key, depth - 1 AS depth, count(*) AS n_children FROM parents GROUP BY ALL),
rolled AS (
  SELECT p.key, p.depth, sum(n.saved) AS saved_tokens, count(*) FILTER (c.n_children IS NULL) AS n_leaves
  FROM nodes n LEFT JOIN children c USING (key, depth) JOIN prefixes p ON p.conv_id = n.conv_id AND p.depth <= n.depth
  GROUP BY ALL)
SELECT n.conv_id, n.depth, q.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children, r.n_leaves,
       CAST(r.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN rolled r USING (key, depth) LEFT JOIN children c USING (key, depth) LEFT JOIN parents p USING (key, depth)
LEFT JOIN nodes q ON q.key = p.parent_key AND q.depth = n.depth - 1
"""
