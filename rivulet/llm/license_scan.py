"""License scan by diagonal voting, in DataFrame operations only.

Every text becomes its rolling word k-grams; their hashes join the (broadcast,
fixed-size) table of template positions, with the words compared as well, so a
hash collision casts no vote.  A vote lies on the diagonal
(text position - template position).  Votes are counted per diagonal,
neighbouring diagonals are merged (a word more or less shifts the rest), and a
merged span is accepted when it covers enough of the template within a bounded
length.  A phrase stands at every diagonal that has all of its grams.

Texts are never shuffled: only votes and one row per document are.  Documents
are told apart by id and text hash, so repeated rows fall together in the
aggregates and each gets the result again.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.batches import col, save_and_reread

# The base phrases and their labels.
PHRASES = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))

# The usual notices of public licenses and their labels.
NOTICES = (
    ("This work is licensed under the GNU General Public License, version 3", "gpl-3.0"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
     "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
     "version", "gpl-3.0"),
    ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
     "Public License as published by the Free Software Foundation", "lgpl"),
    ("Licensed under the Apache License, Version 2.0", "apache-2.0"),
    ("you may not use this file except in compliance with the License. You may obtain a copy of the License at "
     "http://www.apache.org/licenses/LICENSE-2.0", "apache-2.0"),
    ("Released under the MIT License", "mit"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files, to deal in the Software without restriction", "mit"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
     "following conditions are met", "bsd"),
    ("Licensed under CC BY-NC 4.0", "cc-by-nc-4.0"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License", "cc-by-4.0"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "mpl-2.0"),
    ("has waived all copyright and related or neighboring rights to this work", "cc0"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
     "granted", "isc"),
    ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
     "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later "
     "version", "gpl-2.0"),
    ("This work is licensed under the GNU General Public License, version 2", "gpl-2.0"),
    ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
     "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) "
     "any later version", "lgpl-2.1"),
    ("you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the "
     "Free Software Foundation, either version 3 of the License, or (at your option) any later version", "lgpl-3.0"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
     "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
     "later version", "agpl-3.0"),
    ("TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions. \"License\" shall mean the terms and "
     "conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this document", "apache-2.0"),
    ("The above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
     "Software", "mit"),
    ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
     "derived from this software without specific prior written permission", "bsd-3-clause"),
    ("Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
     "disclaimer in the documentation and/or other materials provided with the distribution", "bsd"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", "cc-by-sa-4.0"),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", "cc-by-nc-4.0"),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License",
     "cc-by-nc-sa-4.0"),
    ("This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License", "cc-by-nd-4.0"),
    ("Licensed under CC BY-SA 4.0", "cc-by-sa-4.0"),
    ("This is free and unencumbered software released into the public domain", "unlicense"),
    ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
     "epl-2.0"),
    ("Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
     "accompanying documentation covered by this license", "bsl-1.0"),
    ("Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter "
     "it and redistribute it freely", "zlib"),
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """A-Z lower-cased, then runs outside ASCII space, signs and controls; null has none."""
    return F.array_remove(F.split(F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER), BETWEEN_WORDS), "")


def template_grams(spark, templates, kind: str, k: int, first_id: int) -> list[tuple]:
    """One row per gram; the template's first (last) word stands beside the gram that follows (precedes) it."""
    rows = []
    for i, (text, label) in enumerate(templates, first_id):
        w = [x for x in re.split(BETWEEN_WORDS, text.translate(str.maketrans(UPPER, LOWER))) if x]
        if len(w) < k:
            raise ValueError(f"template of fewer than {k} words: {text!r}")
        rows += [(i, kind, label, len(w), t, w[0] if t == 1 else None, w[-1] if t == len(w) - k - 1 else None, *w[t:t + k])
                 for t in range(len(w) - k + 1)]
    return rows


def votes(docs: DataFrame, text_col: str, id_col: str, phrases, notices, k: int) -> DataFrame:
    """(id, hash, template, diagonal, the template positions that vote for it, first, last).

    first: the template's first word stands one word before the gram that
    follows it (a word was put between, so no gram holds it); last likewise.
    """
    spark = docs.sparkSession
    names = [f"w{j}" for j in range(k)]
    rows = template_grams(spark, phrases, "phrase", k, 0) + template_grams(spark, notices, "notice", k, len(phrases))
    templates = spark.createDataFrame(rows, "template int, kind string, label string, n int, at int, "
                                      "t_before string, t_after string, "
                                      + ", ".join(f"t_{x} string" for x in names))
    templates = templates.withColumn("t_gram", F.xxhash64(*[f"t_{x}" for x in names]))
    text = docs.select(col(id_col).alias("id"), F.xxhash64(col(text_col)).alias("h"), words(col(text_col)).alias("w"))
    n_grams = F.greatest(F.size("w") - (k - 1), F.lit(0))
    shifted = [F.slice("w", j + 1, n_grams).alias(x) for j, x in enumerate(names)]
    none = F.array(F.lit(None).cast("string"))
    shifted += [F.slice(F.concat(none, none, "w"), 1, n_grams).alias("before"), F.slice("w", k + 2, n_grams).alias("after")]
    names_all = [*names, "before", "after"]
    grams = (text.select("id", "h", F.posexplode(F.arrays_zip(*shifted)).alias("pos", "g"))
             .select("id", "h", "pos", *[F.col("g")[x].alias(x) for x in names_all]).withColumn("gram", F.xxhash64(*names)))
    same = F.col("gram") == F.col("t_gram")
    for x in names:
        same = same & (F.col(x) == F.col(f"t_{x}"))
    return (grams.join(F.broadcast(templates), same)
            .groupBy("id", "h", "template", "kind", "label", "n", (F.col("pos") - F.col("at")).alias("diagonal"))
            .agg(F.collect_set("at").alias("at"),  # a template's positions at most
                 F.coalesce(F.max(F.col("before") == F.col("t_before")), F.lit(False)).alias("first"),
                 F.coalesce(F.max(F.col("after") == F.col("t_after")), F.lit(False)).alias("last")))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases=PHRASES, notices=NOTICES, gram_words: int = 2,
         band: int = 2, min_coverage: float = 0.7, whole_below: int = 14, min_votes: int = 2) -> DataFrame:
    """One row per document: id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    A merged span is accepted when it covers ``min_coverage`` of the template's
    words (all of them for templates of fewer than ``whole_below`` words) in at
    most one and a half times its length; of overlapping accepted spans the
    best covered stay.  Diagonals within ``band`` of the next are one span,
    whatever their votes; spans of fewer than ``min_votes`` votes stay out.
    One word put after a template's first word or before its last (which
    then lie in no gram) is passed over too.
    score: the largest accepted coverage, 1 at a phrase, else 0.  Null and
    empty texts have no words; a null id is an id like others; repeated rows
    give a row each; an empty table gives no rows; other columns are not read.
    """
    k = gram_words
    # the votes are few against the texts: written once, so the texts are gone through for votes once
    diagonals = save_and_reread(votes(docs, text_col, id_col, phrases, notices, k), "license-votes")
    base = (diagonals.filter((F.col("kind") == "phrase") & (F.size("at") == F.col("n") - (k - 1)))
            .select("id", "h", "label", F.col("diagonal").alias("place"), F.lit(1.0).alias("coverage"), F.lit(True).alias("base")))

    def spans_of(df: DataFrame, keys: list[str], name: str) -> DataFrame:
        along = Window.partitionBy(*keys).orderBy("diagonal")
        apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > band, F.lit(True)).cast("int")
        return df.withColumn("apart", apart).withColumn(name, F.sum("apart").over(along))

    # each span of neighbours stands whole, and in parts without its diagonals of few votes (strays may make it too long)
    whole = (spans_of(diagonals.filter(F.col("kind") == "notice"), ["id", "h", "template"], "span")
             .withColumn("few", F.size("at") < min_votes)
             .withColumn("strong", F.explode(F.when(F.col("few"), F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True))))))
    merged = (spans_of(whole, ["id", "h", "template", "span", "strong"], "part")
              .groupBy("id", "h", "template", "span", "strong", "part", "label", "n")
              .agg(F.array_distinct(F.flatten(F.collect_list("at"))).alias("at"), F.sum(F.size("at")).alias("n_votes"),
                   F.max("first").alias("first"), F.max("last").alias("last"),
                   F.min(F.col("diagonal") + F.least(F.array_min("at"), F.when(F.col("first"), -1))).alias("place"),
                   F.max(F.col("diagonal") + F.greatest(F.array_max("at") + k, F.when(F.col("last"), F.col("n") + 1))).alias("end"))
              .filter(F.col("n_votes") >= min_votes))
    gram_words_at = F.flatten(F.transform("at", lambda t: F.sequence(t, t + (k - 1))))
    lone = F.filter(F.array(F.when(F.col("first"), 0), F.when(F.col("last"), F.col("n") - 1)), lambda t: t.isNotNull())
    covered = F.size(F.array_distinct(F.concat(gram_words_at, lone))) / F.col("n")
    accepted = (merged.withColumn("coverage", covered)
                .filter((F.col("coverage") >= F.when(F.col("n") < whole_below, 1.0).otherwise(min_coverage))
                        & (F.col("end") - F.col("place") <= 1.5 * F.col("n"))))
    # a whole span must cover more than its parts, else they stand for it
    parts = F.coalesce(F.max(F.when(F.col("strong"), F.col("coverage"))).over(Window.partitionBy("id", "h", "template", "span")), F.lit(0.0))
    accepted = accepted.withColumn("parts", parts).filter(F.col("strong") | (F.col("coverage") > F.col("parts")))
    # where accepted spans of a document overlap (one license quoting another's wording), the best covered stay
    ahead = Window.partitionBy("id", "h").orderBy("place", "end").rowsBetween(Window.unboundedPreceding, -1)
    running = Window.partitionBy("id", "h").orderBy("place", "end").rowsBetween(Window.unboundedPreceding, 0)
    spans = (accepted.withColumn("fresh", F.coalesce(F.col("place") >= F.max("end").over(ahead), F.lit(True)).cast("int"))
             .withColumn("heap", F.sum("fresh").over(running))
             .withColumn("best", F.max("coverage").over(Window.partitionBy("id", "h", "heap"))).filter("coverage = best")
             .select("id", "h", "label", F.col("place").cast("int").alias("place"), "coverage", F.lit(False).alias("base")))

    at_base = F.when(F.col("base"), F.col("place"))
    joined = lambda c: F.concat_ws(",", F.array_sort(F.collect_set(c)))
    per_doc = base.union(spans).groupBy(F.col("id").alias("i"), F.col("h").alias("hh")).agg(
        F.count(at_base).alias("n_base"), F.min(at_base).alias("first_word"), F.max(at_base).alias("last_word"),
        joined(F.when(F.col("base"), F.col("label"))).alias("base_labels"), joined("label").alias("labels"),
        F.max("coverage").alias("score"))
    every = docs.select(col(id_col).alias("id"), F.xxhash64(col(text_col)).alias("h"),
                        F.size(words(col(text_col))).cast("bigint").alias("n_words"))
    return (every.join(per_doc, F.col("id").eqNullSafe(F.col("i")) & (F.col("h") == F.col("hh")), "left")
            .select(F.col("id").alias(id_col), "n_words", F.coalesce("n_base", F.lit(0)).cast("bigint").alias("n_base"),
                    F.col("first_word").cast("bigint").alias("first_word"), F.col("last_word").cast("bigint").alias("last_word"),
                    F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
                    F.coalesce("score", F.lit(0.0)).alias("score")))
