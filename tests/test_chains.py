"""Page chains by token."""

import random

import pytest

from tidemark.sources.chains import BrokenChain, chain_problems, ranked_pages

SCHEMA = "chain string, token string, next_token string, body string"


def _chain(name, n):
    t = [None, *(f"{name}{k}" for k in range(1, n))]
    return [(name, t[k], t[k + 1] if k + 1 < n else None, f"{name}:{k}") for k in range(n)]


@pytest.mark.parametrize("lengths", [{"a": 1}, {"a": 2, "b": 37, "c": 8}])
def test_pages_are_ranked_whatever_their_order(spark, lengths):
    rows = [r for name, n in lengths.items() for r in _chain(name, n)]
    random.Random(1).shuffle(rows)
    got = ranked_pages(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    assert len(got) == len(rows) and all(r.body == f"{r.chain}:{r.position}" for r in got)


def test_nothing_landed(spark):
    assert ranked_pages(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("break_, problem", [
    (lambda rows: rows[:3] + rows[4:], "gap"),                                   # a page is lost
    (lambda rows: rows[:-1], "gap"),                                             # the last is lost
    (lambda rows: rows[1:], "gap"),                                              # the first is lost
    (lambda rows: rows + [("a", "a3", None, "again")], "fork"),                  # two pages of a token
    (lambda rows: rows + [("a", "z", "a3", "other")], "fork"),                   # two pages name one token
    (lambda rows: rows + [("a", None, None, "second first page")], "heads"),
    (lambda rows: rows + [("a", "x", "y", ""), ("a", "y", "x", "")], "cycle"),
    (lambda rows: rows + [("b", "x", "x", "only a circle")], "heads"),
])
def test_broken_chains_abort(spark, break_, problem):
    pages = spark.createDataFrame(break_(_chain("a", 6)), SCHEMA)
    with pytest.raises(BrokenChain, match=problem):
        ranked_pages(pages)
    if problem != "cycle":
        assert problem in {r.problem for r in chain_problems(pages).collect()}
