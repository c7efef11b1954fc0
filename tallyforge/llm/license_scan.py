r"""Licence notices by diagonal voting.

Every rolling k-gram of a text's words is hashed and joined to the positions that it has in the templates. A hit
at word p of the text and word t of a template votes for the diagonal p - t; votes are counted per diagonal, diagonals
a few words apart (an inserted or lost word) merge into one span, and a span stands if its words, compared as words,
cover enough of the template. Plain phrases are templates that must be covered whole.

Words are runs of digits, lower-case letters (A-Z are lowered first) and characters beyond ASCII. Edge cases: null and
empty texts have no words and no spans; repeated rows are scanned one by one, null ids too; texts shorter than k words
have no k-grams; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyforge.llm.common import UID, ship, slices, with_uid

#: Phrases that name a licence, and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Notices as their licences word them.
NOTICES = (
    ("all-rights-reserved", "All rights reserved"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
     compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
     required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
     BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
     governing permissions and limitations under the License."""),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-3.0", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
     Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
     version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
     warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."""),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("mit", "Released under the MIT License"),
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
     documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
     to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
     whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this
     permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS",
     WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS
     FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
     following conditions are met: Redistributions of source code must retain the above copyright notice, this list of
     conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this
     list of conditions and the following disclaimer in the documentation and/or other materials provided with the
     distribution."""),
    ("mpl-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
     not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
)

#: Words of a k-gram: two for phrases and notices of three words, four for the rest.
SHORT, LONG = 2, 4
#: Least share of a notice's words in a span, and words that may be lost or inserted between two diagonals.
LEAST_COVER = 0.7
LARGEST_SHIFT = 3
#: A hash that stands for "this is a document", so that documents without any hit reach the result in the same join.
DOCUMENT = -1

_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[bytes, ...]
    phrase: bool = False

    @property
    def k(self) -> int:
        return SHORT if self.phrase or len(self.words) <= LONG else LONG

    @property
    def shift(self) -> int:
        return 0 if self.phrase else min(LARGEST_SHIFT, len(self.words) // 4)


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_FOLD).split()


def templates() -> list[Template]:
    return [*[Template(label, tuple(words_of(phrase)), True) for phrase, label in PHRASES.items()],
            *[Template(label, tuple(words_of(text))) for label, text in NOTICES]]


def gram_hashes(codes: np.ndarray, k: int) -> np.ndarray:
    """Rolling hashes of k codes (unsigned 64-bit); never ``DOCUMENT``."""
    n = len(codes) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        value = np.full(n, k, np.uint64)
        for at in range(k):
            value = (value ^ (value >> np.uint64(29))) * _FACTOR + codes[at:at + n]
        value = (value ^ (value >> np.uint64(32))) * _FACTOR
    return (value >> np.uint64(1)).astype(np.int64)


def codes_of(words) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.uint64, len(words))


def template_grams(spark: SparkSession, known: list[Template]) -> DataFrame:
    """Every k-gram of every template with its position: as many rows as the templates have words."""
    rows = [(DOCUMENT, -1, 0, 0, None)]
    for number, template in enumerate(known):
        for at, value in enumerate(gram_hashes(codes_of(template.words), template.k).tolist()):
            rows.append((value, number, at, template.k, b" ".join(template.words[at:at + template.k]).decode()))
    return spark.createDataFrame(rows, "gram long, template int, t_at int, k int, gram_words string")


def rolled(docs: DataFrame, known: list[Template]) -> DataFrame:
    """Per document: the hashes of all its long, then short k-grams, and ``DOCUMENT``; and the words of those that a template has, too."""
    ship(docs.sparkSession)
    id_type = dict(docs.dtypes)["doc_id"]
    wanted = np.unique(np.concatenate([gram_hashes(codes_of(template.words), template.k) for template in known]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = [words_of(text or "") for text in batch.column("text").to_pylist()]
            grams, spelt = [], []
            for one in words:
                codes = codes_of(one)
                for k in (LONG, SHORT):
                    grams.append(gram_hashes(codes, k))
                    own = [None] * len(grams[-1])
                    for at in np.flatnonzero(np.isin(grams[-1], wanted)).tolist():
                        own[at] = b" ".join(one[at:at + k])
                    spelt += own
                grams.append(np.array([DOCUMENT], np.int64))
                spelt.append(None)
            sizes = np.array([sum(map(len, grams[at:at + 3])) for at in range(0, len(grams), 3)], np.int64)
            bounds = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
            yield pa.RecordBatch.from_pydict({
                UID: batch.column(UID),
                "doc_id": batch.column("doc_id"),
                "n_words": pa.array([len(one) for one in words], pa.int64()),
                "grams": pa.ListArray.from_arrays(bounds, pa.array(np.concatenate(grams), pa.int64())),
                "spelt": pa.ListArray.from_arrays(bounds, pa.array(spelt, pa.string())),
            })

    schema = f"{UID} long, doc_id {id_type}, n_words long, grams array<long>, spelt array<string>"
    return docs.select(UID, "doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def hits(docs: DataFrame, known: list[Template]) -> DataFrame:
    """Rows (document, template, word of the text, word of the template) whose k words are the same words."""
    grams = rolled(docs, known).select(UID, "doc_id", "n_words", F.posexplode(F.arrays_zip("grams", "spelt")).alias("at", "one")).select(
        UID, "doc_id", "n_words", "at", F.col("one.grams").alias("gram"), "one.spelt")
    met = grams.join(F.broadcast(template_grams(docs.sparkSession, known)), "gram")  # the templates are fixed
    n_long = F.greatest(F.col("n_words") - (LONG - 1), F.lit(0))
    place = F.when(F.col("k") == LONG, F.col("at")).otherwise(F.col("at") - n_long).cast("int")
    found = met.withColumn("place", place)
    return found.where((F.col("template") < 0) | (F.col("spelt") == F.col("gram_words"))).select(UID, "doc_id", "n_words", "template", "place", "t_at", "k")


def spans(docs: DataFrame, known: list[Template] | None = None) -> DataFrame:
    """Verified spans, one row each: template, start and end in words, votes, cover; and one row per document
    with template -1."""
    known = known or templates()
    document = [UID, "doc_id", "n_words"]
    votes = hits(docs, known).withColumn("diagonal", F.col("place") - F.col("t_at"))
    diagonals = votes.groupBy(*document, "template", "diagonal", "k").agg(
        F.count(F.lit(1)).alias("votes"), F.min("place").alias("start"), F.max(F.col("place") + F.col("k")).alias("end"),
        F.collect_set("t_at").alias("t_places"))  # at most the template's words
    fact = lambda values, kind: F.get(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("template"))
    along = Window.partitionBy(*document, "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(along) > fact([t.shift for t in known], "int")
    merged = diagonals.withColumn("new", F.when(apart, 1).otherwise(0)).withColumn("island", F.sum("new").over(along))
    found = merged.groupBy(*document, "template", "island").agg(
        F.sum("votes").alias("votes"), F.min("start").alias("start"), F.max("end").alias("end"), F.max("k").alias("k"),
        F.flatten(F.collect_set("t_places")).alias("t_places"))
    length = fact([len(t.words) for t in known], "int")
    words = F.array_distinct(F.flatten(F.transform("t_places", lambda t: F.sequence(t, t + F.col("k") - 1))))
    found = found.withColumn("cover", F.when(F.col("template") >= 0, F.size(words) / length).otherwise(0.0))
    least = fact([1.0 if t.phrase else LEAST_COVER for t in known], "double")
    # a hit lies within the template's length of its diagonal, so a span is longer than the template by no more than
    # its diagonals are apart: as many words as were inserted
    return found.where((F.col("template") < 0) | (F.col("cover") >= least)).select(
        *document, "template", "start", "end", "votes", "cover")


def scan(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, ``found`` (array of label, start, end, cover), places and labels of plain
    phrases, all labels, and score, the best cover."""
    known = templates()
    rows = spans(with_uid(docs.select("doc_id", "text")), known)
    fact = lambda values: F.get(F.array(*[F.lit(v) for v in values]), F.col("template"))
    rows = rows.withColumns({"label": fact([t.label for t in known]), "phrase": F.coalesce(fact([t.phrase for t in known]), F.lit(False))})
    base, any_span = F.col("phrase"), F.col("template") >= 0
    join = lambda which: F.array_join(F.array_sort(F.collect_set(F.when(which, F.col("label")))), ",")
    return rows.groupBy(UID, "doc_id", "n_words").agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("start"))).cast("bigint").alias("first_word"),
        F.max(F.when(base, F.col("start"))).cast("bigint").alias("last_word"),
        join(base).alias("base_labels"),
        join(any_span).alias("labels"),
        F.max("cover").alias("score"),
        F.sort_array(F.collect_list(F.when(any_span, F.struct("start", "end", "label", "cover")))).alias("found"),
    ).drop(UID)
