"""Chains of pages that name their successor by a token or cursor.

A page has the token it was asked for with (null: the first) and the token of the next page (null: the
last).  Pages land in any order; `ranked_pages` finds each page's place by pointer doubling, in rounds
that are the logarithm of the longest chain, and `chain_problems` names what keeps a set of pages from
being one whole chain: a strict source aborts on the first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import checkpoint_root

#: What can be wrong with a chain (fixed names).
GAP, FORK, HEADS, CYCLE = "gap", "fork", "heads", "cycle"


class BrokenChain(ValueError):
    """Pages that do not make whole chains."""


def chain_problems(pages: DataFrame, chain: Sequence[str] = ("chain",), token: str = "token", following: str = "next_token") -> DataFrame:
    """``(chain, problem, token)``: no page or several for a token that a page names (gap, fork), none or
    several first pages (heads), and pages that no walk from a first page reaches although each has a
    predecessor (cycle).  Empty for whole chains."""
    keys = list(chain)
    named = pages.where(F.col(following).isNotNull()).groupBy(*keys, F.col(following).alias("token")).agg(F.count("*").alias("named"))
    held = pages.where(F.col(token).isNotNull()).groupBy(*keys, F.col(token).alias("token")).agg(F.count("*").alias("held"))
    both = named.join(held, [*keys, "token"], "full_outer").fillna(0, ["named", "held"])
    lone = both.where("named = 0 OR held = 0").select(*keys, F.lit(GAP).alias("problem"), "token")
    forks = both.where("named > 1 OR held > 1").select(*keys, F.lit(FORK).alias("problem"), "token")
    heads = pages.groupBy(*keys).agg(F.count_if(F.col(token).isNull()).alias("n")).where("n <> 1").select(*keys, F.lit(HEADS).alias("problem"), F.lit(None).cast("string").alias("token"))
    return lone.unionByName(forks).unionByName(heads)


def ranked_pages(pages: DataFrame, chain: Sequence[str] = ("chain",), token: str = "token", following: str = "next_token") -> DataFrame:
    """``pages`` with ``position``, from 0 at the first page of each chain; raises `BrokenChain` if they are
    not whole chains.

    Every page points to the page before it; in each round a page takes over its pointer's pointer and
    adds the distance, so distances double.  Tokens are unique when the rounds begin, so the joins have
    no hot key; a pointer that has not ended after so many rounds as whole chains can need runs in a
    circle."""
    spark, keys = pages.sparkSession, list(chain)
    checkpoint_root(spark)
    whole = pages.checkpoint(eager=True)
    wrong = chain_problems(whole, keys, token, following).orderBy(*keys, "problem", "token").limit(5).collect()
    if wrong:
        raise BrokenChain("; ".join(f"{'/'.join(str(r[k]) for k in keys)}: {r['problem']} at {r['token']}" for r in wrong))
    # the page before: the one that names this page's token
    steps = whole.select(*keys, F.col(token).alias("_page")).join(
        whole.where(F.col(following).isNotNull()).select(*keys, F.col(following).alias("_page"), F.col(token).alias("_before"), F.lit(True).alias("_named")), [*keys, "_page"], "left")
    steps = steps.select(*keys, "_page", F.col("_before").alias("_to"), F.coalesce("_named", F.lit(False)).cast("long").alias("_far"))
    steps = steps.checkpoint(eager=True)
    longest = whole.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    for _ in range(max(0, longest - 1).bit_length()):
        ahead = steps.select(*keys, F.col("_page").alias("_to"), F.col("_to").alias("_then"), F.col("_far").alias("_more"))
        steps = steps.join(ahead, [*keys, "_to"], "left").select(
            *keys, "_page", F.col("_then").alias("_to"), (F.col("_far") + F.coalesce("_more", F.lit(0))).alias("_far")).checkpoint(eager=True)
    running = steps.where(F.col("_to").isNotNull()).limit(1).collect()
    if running:
        raise BrokenChain(f"{'/'.join(str(running[0][k]) for k in keys)}: {CYCLE} at {running[0]['_page']}")
    same = [F.col(f"p.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys] + [F.col(f"p.{token}").eqNullSafe(F.col("s._page"))]
    return whole.alias("p").join(steps.alias("s"), same).select("p.*", F.col("s._far").alias("position"))
