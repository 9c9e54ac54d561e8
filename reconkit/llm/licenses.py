"""License notices by diagonal voting of word k-grams.

All rolling k-gram hashes of all texts are joined to the positions of the templates'
k-grams.  Hits of one text and template are counted by offset diagonal (word in the text
minus word in the template), neighbouring diagonals are merged, so that inserted or
missing words do not part a notice, and a span is verified by the share of template
words that its hits cover against the words it spans.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from reconkit.llm.common import (
    hash_of_words, id_and_text, joined_bytes, lower_ascii, shingle_hashes, slices, word_hashes, words_of,
)
from reconkit.llm.decontaminate import words
from reconkit.session import local_rows

GRAM = 3  # words
DRIFT = 4  # diagonals this far apart belong together
ACCEPTED = 0.6  # least share of covered words
# fixed values: base phrases and their labels
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
# fixed values: common license notices
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)

_IS_WORD = np.zeros(256, bool)
_IS_WORD[48:58] = _IS_WORD[97:123] = True
_IS_WORD[128:] = True


def hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and where each text's words start (one more at the end)."""
    data, starts = joined_bytes(texts)
    data = lower_ascii(data)
    a, b = words_of(data, _IS_WORD)
    return word_hashes(data, a, b), np.searchsorted(a, starts)


def grams(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """``doc_id, word, gram``: the hash of the k words from each word on, of every text."""

    def run(batches):
        for part in slices(batches):
            hashes, first = hashed_words(part["text"])
            found = shingle_hashes(hashes, GRAM)
            row = np.repeat(np.arange(part.num_rows), np.diff(first))[: len(found)]
            at = np.arange(len(found))
            inside = at + GRAM <= first[row + 1]
            row, at = row[inside], at[inside]
            ids = part["doc_id"].take(pa.array(row))
            yield pa.RecordBatch.from_arrays([ids, pa.array(at - first[row]), pa.array(found[inside].view(np.int64))], ["doc_id", "word", "gram"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, word long, gram long")


def template_positions(spark, templates: Sequence[tuple[str, str]]) -> DataFrame:
    """``gram, template, label, size, place``: one row per k-gram of each template; the caller's list bounds it."""
    rows = []
    for number, (label, text) in enumerate(templates):
        own = words(text)
        for place in range(len(own) - GRAM + 1):
            gram = hash_of_words(own[place : place + GRAM])
            rows.append((int(np.array(gram).view(np.int64)), number, label, len(own), place))
    return local_rows(spark, rows, "gram long, template int, label string, size int, place int")


def notices(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, id_col="doc_id", text_col="text") -> DataFrame:
    """``doc_id, label, template, first_word, last_word, score``: verified spans of templates.

    Rows with one id (or a null id) count as one text.  Texts shorter than a k-gram have no span.
    """
    positions = template_positions(docs.sparkSession, templates)
    hits = grams(docs, id_col, text_col).join(F.broadcast(positions), "gram")
    diagonal = (F.col("word") - F.col("place")).alias("diagonal")
    votes = hits.groupBy("doc_id", "template", "label", "size", diagonal).agg(
        F.collect_set("place").alias("places"), F.min("word").alias("low"), F.max("word").alias("high")
    )
    line = Window.partitionBy("doc_id", "template").orderBy("diagonal")
    gap = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(line) > DRIFT, F.lit(True))
    merged = (
        votes.withColumn("new", gap.cast("int"))
        .withColumn("run", F.sum("new").over(line))
        .groupBy("doc_id", "template", "label", "size", "run")
        .agg(F.flatten(F.collect_list("places")).alias("places"), F.min("low").alias("low"), F.max("high").alias("high"))
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p, p + GRAM - 1)))))
    spanned = F.col("high") - F.col("low") + GRAM
    score = covered / F.greatest(F.col("size"), spanned)
    return merged.withColumn("score", score).filter(F.col("score") >= ACCEPTED).selectExpr(
        "doc_id", "label", "template", "low as first_word", f"high + {GRAM - 1} as last_word", "score"
    )


def phrase_places(docs: DataFrame, phrases: Sequence[tuple[str, str]] = PHRASES, id_col="doc_id", text_col="text") -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels`` of every row: where a phrase's words stand."""

    def run(batches):
        wanted = [(label, [hash_of_words([w]) for w in phrase.split()]) for phrase, label in phrases]
        for part in slices(batches):
            hashes, first = hashed_words(part["text"])
            single = shingle_hashes(hashes, 1)
            n = part.num_rows
            row = np.repeat(np.arange(n), np.diff(first))
            count, low, high = np.zeros(n, np.int64), np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
            labels = [set() for _ in range(n)]
            for label, parts in wanted:
                at = np.flatnonzero(single[: max(0, len(single) - len(parts) + 1)] == parts[0])
                for k, h in enumerate(parts[1:], 1):
                    at = at[(single[at + k] == h) & (row[at + k] == row[at])]
                np.add.at(count, row[at], 1)
                np.minimum.at(low, row[at], at - first[row[at]])
                np.maximum.at(high, row[at], at - first[row[at]])
                for r in np.unique(row[at]):
                    labels[r].add(label)
            none = count == 0
            yield pa.RecordBatch.from_arrays(
                [
                    part["doc_id"], pa.array(np.diff(first)), pa.array(count), pa.array(low, mask=none), pa.array(high, mask=none),
                    pa.array([sorted(x) for x in labels], pa.list_(pa.string())),
                ],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"],
            )

    kinds = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels array<string>"
    return id_and_text(docs, id_col, text_col).mapInArrow(run, kinds)


def scan(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES, id_col="doc_id", text_col="text") -> DataFrame:
    """One row per document: the phrase columns, ``labels`` (phrases and notices) and ``score``.

    The score is 1 where a phrase stands, else that of the best notice, else 0.
    """
    base = phrase_places(docs, phrases, id_col, text_col)
    found = notices(docs, templates, id_col, text_col).groupBy(F.col("doc_id").alias("notice_id")).agg(
        F.collect_set("label").alias("more"), F.max("score").alias("best")
    )
    both = base.join(found, F.col("doc_id").eqNullSafe(F.col("notice_id")), "left")
    labels = F.array_sort(F.array_union("base_labels", F.coalesce("more", F.array().cast("array<string>"))))
    score = F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0)))
    return both.withColumns({"labels": labels, "score": score}).drop("more", "best", "notice_id")
