"""Licence scans by diagonal voting.

Every run of ``GRAM`` words of a text votes: a Spark join matches its hash (and its words) with the
places of the licence templates' runs.  Votes of one alignment lie on one diagonal, text place minus
template place; votes are counted by diagonal, neighbouring diagonals (a word more or less) are
merged, and a merged span is verified by the share of the template that it covers and its length.
A template that must stand word for word needs all of its runs on one diagonal.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.bytewords import ALNUM, windows, words
from tidemark.llm.common import map_batches
from tidemark.llm.decontaminate import joined

GRAM = 3
#: Diagonals this far apart are one alignment; share of a template's runs that a span must cover, and
#: how much longer than the template it may be.
NEAR, COVER, STRETCH = 4, 0.6, 1.5


class Template(NamedTuple):
    label: str
    words: str
    base: bool = False      # a base phrase: counted wherever it stands
    exact: bool = True      # word for word


#: Fixed phrases of the base labels, then short and long forms of common licences.
TEMPLATES = (
    Template("mit", "under the mit license", base=True),
    Template("apache-2", "apache license version 2", base=True),
    Template("cc-by-nc", "cc by nc", base=True),
    Template("gpl-3", "gnu general public license version 3"),
    Template("gpl-2", "gnu general public license version 2"),
    Template("gpl-3", "gnu general public license v3"),
    Template("lgpl", "gnu lesser general public license"),
    Template("agpl", "gnu affero general public license"),
    Template("mpl-2", "mozilla public license version 2"),
    Template("cc-by-sa", "cc by sa"),
    Template("cc-by-nd", "cc by nd"),
    Template("cc-by-sa", "creative commons attribution sharealike"),
    Template("cc-by-nc", "creative commons attribution noncommercial"),
    Template("cc0", "cc0 1 0 universal"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
             "associated documentation files the software to deal in the software without restriction", exact=False),
    Template("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at "
             "http www apache org licenses license 2 0", exact=False),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
             "the following conditions are met", exact=False),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
             "public license as published by the free software foundation", exact=False),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
             "granted", exact=False),
    Template("unlicense", "this is free and unencumbered software released into the public domain", exact=False),
)


def _runs(text: str) -> list[tuple[int, int, str]]:
    """``(place, hash, words)`` of every run of a template."""
    part = next(iter(words(pa.array([text]), ALNUM)))
    return [(k, h, joined(part, k, GRAM).decode()) for k, h in enumerate(windows(part.hash, GRAM).view(np.int64).tolist())]


def template_runs(spark: SparkSession, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """The templates' runs as rows; a template has at most 62 of them (its runs are bits of a long)."""
    rows = []
    for number, t in enumerate(templates):
        runs = _runs(t.words)
        if not 1 <= len(runs) <= 62:
            raise ValueError(f"template {t.words!r} has {len(runs)} runs")
        rows += [(number, t.label, t.base, t.exact or t.base, len(runs), place, h, w) for place, h, w in runs]
    return spark.createDataFrame(rows, "template int, label string, base boolean, exact boolean, runs int, place int, hash long, words string")


GRAMS = "row long, doc_id long, n_words long, grams array<struct<at: long, hash: long, words: string>>"
_GRAMS = pa.list_(pa.struct([("at", pa.int64()), ("hash", pa.int64()), ("words", pa.string())]))


def _voting_runs(docs: DataFrame, hashes: np.ndarray) -> DataFrame:
    """For each document the runs whose hash may be one of ``hashes``: others cannot join.

    ``row`` tells rows apart whatever their doc_id: the task and the place in it, the same if the task
    runs again.
    """
    bitmap = np.zeros(1 << 16, bool)
    bitmap[hashes.view(np.uint64) >> np.uint64(48)] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            n_words, grams = [], []
            for part in words(batch.column(1), ALNUM):
                counts = np.diff(part.bounds)
                runs = windows(part.hash, GRAM)
                at = np.flatnonzero(bitmap[(runs >> np.uint64(48)).astype(np.int64)])
                owner = np.searchsorted(part.bounds, at, "right") - 1
                inside = at + GRAM <= part.bounds[owner + 1]
                found: dict[int, list] = {}
                for k, place, h in zip(owner[inside].tolist(), at[inside].tolist(), runs[at[inside]].view(np.int64).tolist()):
                    found.setdefault(k, []).append({"at": place - int(part.bounds[k]), "hash": h, "words": joined(part, place, GRAM).decode("utf-8", "replace")})
                n_words += counts.tolist()
                grams += [found.get(k, []) for k in range(len(counts))]
            rows = pa.array(range(row, row + len(batch)), pa.int64())
            row += len(batch)
            yield pa.RecordBatch.from_arrays([rows, batch.column(0), pa.array(n_words, pa.int64()), pa.array(grams, _GRAMS)],
                                             names=["row", "doc_id", "n_words", "grams"])

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), run, GRAMS)


def licence_spans(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """Verified spans: ``row, doc_id, n_words, label, base, first, end, score``; a document without
    one has a single row whose label is null.  A null text has no words."""
    spark = docs.sparkSession
    runs = template_runs(spark, templates)
    hashes = np.array([r[0] for r in runs.select("hash").distinct().collect()], np.int64)  # of the constants above
    key = ["row", "doc_id", "n_words"]
    votes = (_voting_runs(docs, hashes).select(*key, F.explode_outer("grams").alias("gram")).select(*key, "gram.*")
             .join(F.broadcast(runs), ["hash", "words"], "left")
             .select(*key, "template", "label", "base", "exact", "runs", "at", "place", (F.col("at") - F.col("place")).alias("diagonal")))
    kind = ["template", "label", "base", "exact", "runs"]
    diagonals = votes.groupBy(*key, *kind, "diagonal").agg(
        F.expr("bit_or(shiftleft(1L, place))").alias("voted"), F.min("at").alias("first"), (F.max("at") + GRAM).alias("end"))
    along = Window.partitionBy("row", "template").orderBy("diagonal")
    apart = F.col("exact") | F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > NEAR, F.lit(True))
    merged = (diagonals.withColumn("apart", apart.cast("int")).withColumn("group", F.sum("apart").over(along))
              .groupBy(*key, *kind, "group").agg(F.expr("bit_or(voted)").alias("voted"), F.min("first").alias("first"), F.max("end").alias("end")))
    score = F.bit_count("voted") / F.col("runs")
    length = F.col("end") - F.col("first")
    verified = F.when(F.col("exact"), score == 1).otherwise((score >= COVER) & (length <= STRETCH * (F.col("runs") + GRAM - 1)))
    holds = F.coalesce(verified, F.lit(False))
    return merged.select(*key, *(F.when(holds, c).alias(n) for n, c in (
        ("label", F.col("label")), ("base", F.col("base")), ("first", F.col("first")), ("end", F.col("end")), ("score", score))))


def licence_report(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """Counts, places and labels per document."""
    spans = licence_spans(docs, templates)
    listed = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    place = F.when(F.col("base"), F.col("first"))
    return spans.groupBy("row", "doc_id", "n_words").agg(
        F.count(place).alias("n_base"), F.min(place).alias("first_word"), F.max(place).alias("last_word"),
        listed(F.when(F.col("base"), F.col("label"))).alias("base_labels"), listed(F.col("label")).alias("labels"),
        F.coalesce(F.max("score"), F.lit(0.0)).alias("score")).drop("row")
