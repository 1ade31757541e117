"""License scan by diagonal voting.

All rolling word k-grams of the documents are joined with the k-gram positions
of license templates.  A hit at document word p and template word t votes for
the diagonal p - t; votes are counted per document, template and diagonal, and
neighbouring diagonals (a word added or left out) are merged into one span,
unless the template begins anew: that is a further mention.  A vote means that
the words at its places are the template's, so a span is verified by how many of
the template's words the votes cover, by whether they cover all of its deciding
words (NonCommercial, Lesser, ...) and by how long it is.  Where verified spans
of several licenses overlap, the one that covers most of its template stands.

Besides, fixed phrases are counted wherever their words stand consecutively.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from estatelens.llm import common, words

K = 3
#: Diagonals this close belong to one span.
DRIFT = 4
#: Share of the template's words that votes cover, and longest span for a template, as a multiple of its words.
MIN_COVER = 0.7
MAX_STRETCH = 1.6

# Phrases with their labels.
PHRASES = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)

# Wordings of public licenses with their labels.
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
               "http://www.apache.org/licenses/LICENSE-2.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
            "option) any later version"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0"),
    ("cc-by-nd", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License"),
    ("cc-by-nc-sa", "Licensed under CC BY-NC-SA 4.0"),
    ("cc-by-nc-sa", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
    ("cc-by-nc-nd", "Licensed under CC BY-NC-ND 4.0"),
    ("cc-by-nc-nd", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
             "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your "
             "option) any later version"),
    ("agpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
             "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
             "option) any later version"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("epl", "This program and the accompanying materials are made available under the terms of the Eclipse Public License"),
)
# Words that tell related licenses apart; a span must hold those of its template.
DECIDING = ("affero", "lesser", "nc", "nd", "noncommercial", "noderivatives", "sa", "sharealike")


def deciding_places(text: str) -> list[int]:
    """Places of the deciding words among the words of a template."""
    return [i for i, w in enumerate(re.findall(r"[0-9a-z]+", text.lower())) if w in DECIDING]


def _hashed(text: str) -> np.ndarray:
    buf = words.LOWER[np.frombuffer(text.encode(), np.uint8)]
    starts, ends, _ = words.word_bounds(buf, np.array([0, len(buf)]), words.ALNUM)
    return words.span_hashes(buf, starts, ends)


def template_table(spark, templates=TEMPLATES, k: int = K) -> tuple[DataFrame, list[int]]:
    """(gram, template, at) for every k-gram of the templates, and the templates' words.

    The list is a fixed parameter of some hundred rows.  Template -1 stands for
    the rows that carry a document's counts (gram 0)."""
    rows, sizes = [(0, -1, 0)], []
    for n, (_, text) in enumerate(templates):
        h = _hashed(text)
        at, grams = words.gram_hashes(h, np.array([0, len(h)]), k)
        sizes.append(len(h))
        rows += [(int(g), n, int(a)) for a, g in zip(at, grams.view(np.int64))]
    return spark.createDataFrame(rows, "gram long, template int, at int"), sizes


def _grams(k: int, phrases, kept: list[str]):
    """Per document all its k-grams, then one row with its counts."""
    phrase_hashes = [(_hashed(p), label) for p, label in phrases]

    def run(batches):
        for part in common.slices(batches):
            buf, off = common.text_buffer(common.column_of(part, "text"))
            buf = words.LOWER[buf]
            starts, ends, first = words.word_bounds(buf, off, words.ALNUM)
            h = words.span_hashes(buf, starts, ends)
            at, grams = words.gram_hashes(h, first, k)
            doc = np.searchsorted(first, at, "right") - 1
            names = [common.column_of(part, c) for c in kept]
            for lo in range(0, len(at), 1 << 18):
                some = doc[lo:lo + (1 << 18)]
                index = pa.array(some)
                yield pa.RecordBatch.from_arrays(
                    [*(x.take(index) for x in names), pa.array(grams[lo:lo + (1 << 18)].view(np.int64)),
                     pa.array((at[lo:lo + (1 << 18)] - first[some]).astype(np.int64)), pa.nulls(len(some), _COUNTS)],
                    names=[*kept, "gram", "word", "counts"])
            places = [[] for _ in range(part.num_rows)]
            for hashes, label in phrase_hashes:
                n = len(h) - len(hashes) + 1
                same = np.ones(max(0, n), bool)
                for j, x in enumerate(hashes):
                    same &= h[j:j + len(same)] == x
                hit = np.flatnonzero(same)
                owner = np.searchsorted(first, hit, "right") - 1
                inside = hit + len(hashes) <= first[owner + 1]
                for d, p in zip(owner[inside].tolist(), hit[inside].tolist()):
                    places[d].append((p - int(first[d]), label))
            counts = [{"n_words": int(n), "n_base": len(x), "first_word": min(x)[0] if x else None,
                       "last_word": max(x)[0] if x else None, "base_labels": sorted({y for _, y in x})}
                      for n, x in zip(np.diff(first), places)]
            yield pa.RecordBatch.from_arrays([*names, pa.array(np.zeros(part.num_rows, np.int64)),
                                              pa.array(np.zeros(part.num_rows, np.int64)), pa.array(counts, _COUNTS)],
                                             names=[*kept, "gram", "word", "counts"])

    return run


_COUNTS = pa.struct([("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
                     ("base_labels", pa.list_(pa.string()))])


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text", templates=TEMPLATES, phrases=PHRASES, k: int = K,
         drift: int = DRIFT, min_cover: float = MIN_COVER, max_stretch: float = MAX_STRETCH) -> tuple[DataFrame, DataFrame]:
    """(counts per row, verified spans: id, mark, template, label, first word, words, cover).

    ``mark`` tells different texts of one id apart; rows that repeat one another
    have the same spans, each once.  Null and empty text have no words and no
    spans.  Mentions that follow one another are spans of their own; of licenses
    that cover as much at one place the one with most k-grams stands, then the longer span, then the later label."""
    spark = docs.sparkSession
    common.ship_package(spark)
    table, sizes = template_table(spark, templates, k)
    kept = ["id", "mark"]
    source = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("mark"), F.col(text).alias("text"))
    counts = "struct<n_words:long,n_base:long,first_word:long,last_word:long,base_labels:array<string>>"
    schema = source.select("id", "mark", F.lit(0).cast("long").alias("gram"), F.lit(0).cast("long").alias("word"),
                           F.lit(None).cast(counts).alias("counts")).schema
    grams = source.mapInArrow(_grams(k, phrases, kept), schema)
    # the templates are a fixed list: a few hundred k-grams
    votes = common.written(grams.join(F.broadcast(table), "gram").drop("gram"), "license-votes")
    counts = votes.where("template = -1").select("id", "mark", "counts.*")
    diagonals = (votes.where("template >= 0").withColumn("diagonal", F.col("word") - F.col("at"))
                 .groupBy("id", "mark", "template", "diagonal")
                 .agg(F.min("word").alias("a"), (F.max("word") + k).alias("b"), F.collect_set("at").alias("at"),
                      F.min("at").alias("low"), F.max("at").alias("high")))
    line = Window.partitionBy("id", "mark", "template").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(line) > drift, F.lit(True))
    near = diagonals.withColumn("apart", apart.cast("int")).withColumn("near", F.sum("apart").over(line))
    along = Window.partitionBy("id", "mark", "template", "near").orderBy("a", "diagonal")
    anew = (F.col("a") >= F.lag("b").over(along)) & (F.col("low") <= F.lag("high").over(along))
    merged = (near.withColumn("anew", F.coalesce(anew, F.lit(False)).cast("int")).withColumn("mention", F.sum("anew").over(along))
              .groupBy("id", "mark", "template", "near", "mention")
              .agg(F.min("a").alias("first_word"), F.max("b").alias("end"), F.flatten(F.collect_list("at")).alias("at")))
    facts = spark.createDataFrame([(n, label, size, deciding_places(wording))
                                   for n, ((label, wording), size) in enumerate(zip(templates, sizes))],
                                  "template int, label string, size int, deciding array<int>")
    places = F.array_distinct(F.flatten(F.transform("at", lambda t: F.sequence(t, t + (k - 1)))))
    verified = (merged.join(F.broadcast(facts), "template").withColumn("n", F.col("end") - F.col("first_word"))
                .withColumn("places", places).withColumn("cover", F.size("places") / F.col("size"))
                .withColumn("grams", F.size(F.array_distinct("at")) / F.col("size"))
                .where((F.col("cover") >= min_cover) & (F.col("n") <= max_stretch * F.col("size"))
                       & (F.size(F.array_except("deciding", "places")) == 0)))
    # spans that overlap are one place; its label is that of its best span
    row = Window.partitionBy("id", "mark").orderBy("first_word", "end", "template")
    reach = F.max("end").over(row.rowsBetween(Window.unboundedPreceding, -1))
    placed = verified.withColumn("new", F.coalesce(F.col("first_word") >= reach, F.lit(True)).cast("int")) \
        .withColumn("place", F.sum("new").over(row))
    best = F.max(F.struct("cover", "grams", "n", "label")).over(Window.partitionBy("id", "mark", "place"))
    spans = placed.withColumn("best", best).where(F.col("label") == F.col("best.label"))
    return counts, spans.select("id", "mark", "template", "label", "first_word", F.col("n").alias("words"), "cover")


def license_table(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, n_words, n_base, first_word, last_word, base_labels, labels, score (best cover; 1 for a phrase), n_found (spans).

    Null and empty texts have no words, labels '' and score 0; rows that repeat an id or a text keep a row
    each; an empty table gives no rows."""
    counts, spans = scan(docs, id_col, text)
    found = spans.groupBy("id", "mark").agg(F.collect_set("label").alias("found"), F.max("cover").alias("cover"),
                                            F.count("*").alias("n_found")).select(
        F.col("id").alias("__id"), F.col("mark").alias("__mark"), "found", "cover", "n_found")
    joined = counts.join(found, F.col("id").eqNullSafe(F.col("__id")) & (F.col("mark") == F.col("__mark")), "left")
    every = F.array_sort(F.array_union("base_labels", F.coalesce("found", F.array().cast("array<string>"))))
    score = F.when(F.col("n_base") > 0, 1.0).otherwise(F.least(F.coalesce("cover", F.lit(0.0)), F.lit(1.0)))
    return joined.select(F.col("id").alias(id_col), "n_words", "n_base", "first_word", "last_word",
                         F.array_join("base_labels", ",").alias("base_labels"), F.array_join(every, ",").alias("labels"),
                         score.alias("score"), F.coalesce("n_found", F.lit(0)).cast("long").alias("n_found"))


def op2(spark, sf_dir):
    return license_table(spark.read.parquet(f"{sf_dir}/documents.parquet"))
