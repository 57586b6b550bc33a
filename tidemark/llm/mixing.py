"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in shuffled order, as often as the mix may repeat it.  A
document's virtual finish time is the number of its source's words up to its end, divided by the
source's target, so all sources move at the pace of their targets; all documents are put in one
global order by virtual finish time and the order is cut where the budget is spent.

Targets: sources by code point (null last) weigh 5, 2, 1, 5, 2, 1 and so on and share the budget (1.5
times all words); none is to give more than twice what it has, and what it cannot give goes to the
others by weight.  With sources in the order of cap by weight, a source is capped if the caps so far
and its level for all that come after stay within the budget, so no rounds of sharing are needed.

Words are counted in the scan; from there on rows are narrow.  Running sums go through blocks
(`running_sums`), so a source with any share of the rows is many tasks' work.  Only DataFrame
functions are used.

The document that is being served when a source reaches its target is cut there (``whole=True``: it
stays whole and the budget alone cuts), so a source misses its target by less than a word, but that
the words by which rounding up exceeds the budget are cut off the end of the order.

Results for odd input: a null or empty text has no words and is taken zero times; so is every document
of a source without words, of which the target is 0; null sources are one source; null and repeated
doc_ids and repeated rows are documents of their own (equal rows get equal shares in sum, which of them
is cut is not told apart); an empty table gives an empty result; further columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, small_or_shuffled
from tidemark.llm.running import parts_for, running_sums, running_totals

#: A word; weights of the sources, in turn; most repeats; budget in halves of all words.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
REPEATS = 2
BUDGET_PERCENT = 150
#: A shuffle's numbers are under 16 to this power.
HASH_DIGITS = 15
#: Sources that are broadcast at most.
BROADCAST_ROWS = 100_000


def shuffled_place(seed: int, doc_id: Column, size: Column) -> Column:
    """A number by which the documents of a source are shuffled, from id and size alone: reruns agree."""
    said = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), size.cast("string"))
    return F.conv(F.substring(F.md5(said.cast("binary")), 1, HASH_DIGITS), 16, 10).cast("long")


def source_key(source: Column) -> Column:
    """Sources as text that is never null and sorts by code point, null last."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit("~"))


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, repeats: int = REPEATS,
                   budget_percent: int = BUDGET_PERCENT) -> DataFrame:
    """``(key, source_size, weight, target)`` for ``(key, size)`` rows: weights in turn by key, the budget
    shared by weight with no target above ``repeats`` times the source's size.  All in whole numbers but
    for the last division."""
    sources = sizes.groupBy("key").agg(F.sum("size").alias("source_size"), F.lit(1).alias("one"))
    ranked = running_totals(sources, ["key"], {"place": "one"}, "mix-sources")
    turn = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    weighed = ranked.select("key", "source_size", turn.alias("weight"), (F.col("source_size") * repeats).alias("cap"))
    weighed = weighed.withColumn("level", F.col("cap") / F.col("weight"))
    totals = weighed.agg(F.sum("source_size").alias("all_words"), F.sum("weight").alias("all_weights"))
    levelled = running_totals(weighed, ["level", "key"], {"caps": "cap", "weights": "weight"}, "mix-levels").crossJoin(F.broadcast(totals))
    left = F.col("all_weights") - F.col("weights") - F.col("weight")        # of the sources behind this one
    held = F.col("weight") * (F.col("caps") + F.col("cap")) + F.col("cap") * left
    levelled = levelled.withColumn("capped", held * 100 <= F.col("weight") * F.col("all_words") * budget_percent)
    levelled = materialize(levelled, "mix-capped")
    rest = levelled.agg(F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))), F.lit(0)).alias("given"),
                        F.sum(F.when(~F.col("capped"), F.col("weight"))).alias("sharing"))
    budget = F.col("all_words") * budget_percent / 100
    share = F.col("weight") * ((budget - F.col("given")) / F.col("sharing"))
    return levelled.crossJoin(F.broadcast(rest)).select(
        "key", "source_size", "weight", F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(share).alias("target"))


def queued(docs: DataFrame, seed: int, carry: Sequence[str], repeats: int, weights: Sequence[int],
           budget_percent: int) -> tuple[DataFrame, int, int]:
    """All documents with their place in their source's queue, the number of rows, and the budget."""
    spark = docs.sparkSession
    size = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long")
    rows = docs.select("doc_id", F.col("source").alias("source"), source_key(F.col("source").cast("string")).alias("key"), size.alias("size"),
                       *[F.col(c).alias(f"carry_{c}") for c in carry])
    rows = materialize(rows.withColumn("place", shuffled_place(seed, F.col("doc_id"), F.col("size"))), "mix-sizes")
    n, words = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    bits = (parts_for(spark, n) - 1).bit_length()
    blocked = rows.withColumn("block", F.shiftright("place", 4 * HASH_DIGITS - bits).cast("long")).withColumn("one", F.lit(1))
    targets = small_or_shuffled(materialize(source_targets(rows, weights, repeats, budget_percent), "mix-targets"), BROADCAST_ROWS)
    placed = running_sums(blocked, ["key"], "block", ["place", F.asc_nulls_first("doc_id"), "size"], {"start": "size", "turn": "one"}, targets)
    return materialize(placed.drop("one", "block", "place"), "mix-queue"), n, words * budget_percent // 100


def served(queue: DataFrame, n: int, budget: int, repeats: int, whole: bool) -> DataFrame:
    """The documents of the queue that the mix reaches, a row for each time, with ``round`` (from 0),
    ``finish`` (virtual), ``words`` taken and ``mix_offset`` (words of the mix before it)."""
    spark = queue.sparkSession
    rounds = queue.where("size > 0").withColumn("round", F.explode(F.array(*[F.lit(k) for k in range(repeats)])))
    begin = F.col("round") * F.col("source_size") + F.col("start")
    goal = F.ceil("target")
    rounds = rounds.where(begin < goal)
    end = begin + F.col("size") if whole else F.least(begin + F.col("size"), goal)
    rounds = rounds.withColumn("asked", end - begin).withColumn("finish", end / F.col("target"))
    # the mix gives words at an even pace of virtual time, so equal spans of it are equal shares of the order
    spans = parts_for(spark, n * repeats)
    rounds = rounds.withColumn("span", F.floor(F.col("finish") * spans))
    ordered = running_sums(rounds, [], "span", ["finish", "key", "round", "turn"], {"mix_offset": "asked"})
    taken = F.least("asked", F.lit(budget) - F.col("mix_offset"))
    return ordered.withColumn("words", taken).where("words > 0").drop("asked", "span")


def mixed_stream(docs: DataFrame, *, weights: Sequence[int] = WEIGHTS, repeats: int = REPEATS, budget_percent: int = BUDGET_PERCENT,
                 seed: int = 11, whole: bool = False, carry: Sequence[str] = ()) -> DataFrame:
    """The mix: ``(mix_offset, doc_id, source, round, words, finish)`` and the columns of ``docs`` named in
    ``carry``.  Sorted by ``mix_offset`` it is the order in which a trainer reads; ``words`` below the
    document's size means that the document is cut there (`leading_words`)."""
    queue, n, budget = queued(docs, seed, carry, repeats, weights, budget_percent)
    stream = served(queue, n, budget, repeats, whole)
    return stream.select("mix_offset", "doc_id", "source", "round", "words", "finish", *[F.col(f"carry_{c}").alias(c) for c in carry])


def leading_words(text: Column | str, n: Column | str) -> Column:
    """A text up to the end of its n-th word, white space as it is."""
    pieces = F.split(text, r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    return F.array_join(F.slice(pieces, F.lit(1), (F.col(n) if isinstance(n, str) else n).cast("int")), "")


def mix_report(docs: DataFrame, *, weights: Sequence[int] = WEIGHTS, repeats: int = REPEATS, budget_percent: int = BUDGET_PERCENT,
               seed: int = 11, whole: bool = False) -> DataFrame:
    """One row per document: ``(doc_id, size, source_size, target, taken)``."""
    queue, n, budget = queued(docs, seed, (), repeats, weights, budget_percent)
    shown = ["doc_id", "size", "source_size", "target"]
    # every document once with nothing taken, and what the mix takes of it each time
    taken = queue.select("key", "turn", *shown, F.lit(0).cast("long").alias("words")).unionByName(
        served(queue, n, budget, repeats, whole).select("key", "turn", *shown, "words"))
    return taken.groupBy("key", "turn", *shown).agg(F.sum("words").alias("taken")).select(*shown, "taken")


#: The report in DuckDB SQL.
SQL = r"""
WITH sized AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '~' ELSE '=' || source END AS key,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
placed AS (
  SELECT *, CAST('0x' || md5('11:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || size)[1:15] AS BIGINT) AS place FROM sized),
sources AS (
  SELECT key, CAST(sum(size) AS BIGINT) AS source_size, CASE (row_number() OVER (ORDER BY key) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM placed GROUP BY key),
levels AS (
  SELECT *, 2 * source_size AS cap, CAST(sum(source_size) OVER () AS BIGINT) AS all_words,
         CAST(sum(2 * source_size) OVER w AS HUGEINT) AS caps, CAST(sum(weight) OVER () - sum(weight) OVER w AS HUGEINT) AS behind
  FROM sources WINDOW w AS (ORDER BY 2 * source_size / weight, key ROWS UNBOUNDED PRECEDING)),
capped AS (
  SELECT *, 2 * (weight * caps + cap * behind) <= 3 * CAST(weight AS HUGEINT) * all_words AS capped FROM levels),
targets AS (
  SELECT key, source_size, all_words, CASE WHEN capped THEN CAST(cap AS DOUBLE)
         ELSE weight * ((all_words * 150 / 100 - coalesce(sum(cap) FILTER (capped) OVER (), 0)) / sum(weight) FILTER (NOT capped) OVER ()) END AS target
  FROM capped),
queue AS (
  SELECT p.*, t.source_size, t.target, t.all_words, row_number() OVER q AS turn,
         coalesce(sum(size) OVER (q ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM placed p JOIN targets t USING (key) WINDOW q AS (PARTITION BY key ORDER BY place, doc_id NULLS FIRST, size)),
rounds AS (
  SELECT *, round * source_size + start AS begins, least(round * source_size + start + size, ceil(target)) AS ends
  FROM queue, (VALUES (0), (1)) AS r(round) WHERE size > 0 AND round * source_size + start < ceil(target)),
ordered AS (
  SELECT key, turn, ends - begins AS asked, (all_words * 150) // 100 - coalesce(sum(ends - begins) OVER (
           ORDER BY ends / target, key, round, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_over
  FROM rounds),
taken AS (
  SELECT key, turn, sum(greatest(0, least(asked, left_over))) AS taken FROM ordered GROUP BY key, turn)
SELECT doc_id, size, source_size, target, CAST(coalesce(t.taken, 0) AS BIGINT) AS taken
FROM queue q LEFT JOIN taken t ON q.key = t.key AND q.turn = t.turn
"""
