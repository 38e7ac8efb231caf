"""Licence scan: TF-IDF cosine of headers and licence files to templates, then inheritance from ancestor directories.

Every line and every paragraph of a whole text is a possible header, and so is
every run of as many terms as a template has, wherever it begins, and every run
of adjacent lines of up to twice as many (a notice in running text, or wrapped
and followed by other lines); runs count from ``header_cosine`` on.  The whole
text is a possible licence file.  They are compared with licence templates as
sparse TF-IDF vectors; document frequencies of the templates' terms are counted
over all documents, and terms that no template has weigh like unseen ones.

A text is only taken apart if it can match: for each template, the rarest
terms are chosen until the others alone cannot reach the threshold, and a text
without any of the chosen terms is passed by.  Runs are first given an upper
bound of their cosine from running sums (as if no term occurred in them twice),
and compared from the highest bound down until no bound reaches the best cosine
found.  This loses nothing.

A file is a licence file if its name says so, or if the whole text reaches
``file_cosine``.  Directories take the licence of their best licence file, and
a file without a licence of its own takes that of the nearest directory above
it: directories are joined with those of their ancestors that have a licence,
and files with their directory.

Defined results: a null or empty text has no licence of its own; a null path
has no directory and inherits nothing; of equal cosines the licence first in
code-point order counts, of equal licence files of a directory the one with
the smallest path; repeated rows are treated each for itself; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from solospan.llm.common import as_bytes, checkpointed, map_batches

#: Licence names and wordings of their notices.
TEMPLATES = (
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0'),
    ("Apache-2.0", 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work. CC0 1.0 Universal."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version."),
    ("MIT", "Released under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction'),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Proprietary", "All rights reserved."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
TERM = re.compile(rb"[a-z0-9\x80-\xff]+(?:[.-][0-9a-z]+)*")
LICENCE_NAME = r"(?i)(?:^|/)(?:licen[cs]e|copying|notice|unlicense)(?:[.-][^/]*)?$"


def terms(text: bytes) -> list[bytes]:
    return TERM.findall(text.lower())


VOCABULARY = frozenset(t for _, text in TEMPLATES for t in terms(text.encode()))
SIZES = [len(terms(text.encode())) for _, text in TEMPLATES]
PLACE = {t: i for i, t in enumerate(sorted(VOCABULARY))}


def document_frequencies(docs: DataFrame) -> tuple[int, dict[bytes, int]]:
    """The number of documents, and in how many of them each template term is."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()
        for batch in batches:
            for text in as_bytes(batch.column(0)):
                found.update(VOCABULARY.intersection(terms(text)))
            found[b""] += batch.num_rows  # no term is empty
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], ["term", "n"])

    rows = docs.select("text").mapInArrow(count, "term binary, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()  # the vocabulary at most
    df = {bytes(r.term): r.n for r in rows}
    return df.pop(b"", 0), df


@dataclass
class Matcher:
    """Unit template vectors, term weights, the terms without which nothing reaches ``least``, and for each template those without which no run reaches ``header``."""

    weights: dict[bytes, float]
    unseen: float
    vectors: list[tuple[str, dict[bytes, float]]]
    telling: frozenset[bytes]
    header: float
    run_telling: list[frozenset[bytes]]
    dense: np.ndarray  # template vectors times the term weights, and a last column for other terms

    @classmethod
    def build(cls, n: int, df: dict[bytes, int], least: float, header: float) -> Matcher:
        idf = lambda t: float(np.log((n + 1) / (df.get(t, 0) + 1))) + 1.0
        weights = {t: idf(t) for t in VOCABULARY}
        matcher = cls(weights, float(np.log(n + 1)) + 1.0, [], frozenset(), header, [], np.zeros((len(TEMPLATES), len(PLACE) + 1)))
        telling: frozenset[bytes] = frozenset()
        for row, (name, text) in zip(matcher.dense, TEMPLATES, strict=True):
            vector = matcher.vector(terms(text.encode()))
            matcher.vectors.append((name, vector))
            telling |= cls.needed(vector, least)
            matcher.run_telling.append(cls.needed(vector, header))
            for t, w in vector.items():
                row[PLACE[t]] = w * weights[t]
        matcher.telling = telling
        return matcher

    @staticmethod
    def needed(vector: dict[bytes, float], least: float) -> frozenset[bytes]:
        rest, needed = 1.0, set()
        for t, w in sorted(vector.items(), key=lambda x: (-x[1], x[0])):
            if rest < least * least - 1e-9:  # by Cauchy-Schwarz the cosine over the other terms is below sqrt(rest)
                break
            needed.add(t)
            rest -= w * w
        return frozenset(needed)

    def vector(self, found: list[bytes]) -> dict[bytes, float]:
        raw = {t: n * self.weights.get(t, self.unseen) for t, n in Counter(found).items()}
        norm = float(np.sqrt(sum(w * w for w in raw.values()))) or 1.0
        return {t: w / norm for t, w in raw.items()}

    def best(self, found: list[bytes]) -> tuple[float, str]:
        """The highest cosine and its licence; of equal ones the first in order."""
        vector = self.vector(found)
        top, name = 0.0, ""
        for licence, template in self.vectors:
            cosine = sum(w * vector[t] for t, w in template.items() if t in vector)
            if cosine > top + 1e-12:
                top, name = cosine, licence
        return top, name

    def best_run(self, whole: list[bytes], ends: list[int], head: tuple[float, str]) -> tuple[float, str]:
        """The best of ``head`` and the runs of ``whole``, in which lines end at ``ends``."""
        present = set(whole)
        chosen = [k for k, telling in enumerate(self.run_telling) if not telling.isdisjoint(present)]
        if not chosen:
            return head
        place = np.array([PLACE.get(t, len(PLACE)) for t in whole])
        weights = np.array([*(self.weights[t] for t in PLACE), self.unseen])[place]
        squares = np.r_[0.0, np.cumsum(weights**2)]
        edges = np.unique([0, *ends])
        done: set[tuple[bytes, ...]] = set()
        for k in chosen:
            products = np.r_[0.0, np.cumsum(self.dense[k][place])]

            def reach(start: np.ndarray, stop: np.ndarray, products: np.ndarray = products) -> tuple[np.ndarray, ...]:
                bound = (products[stop] - products[start]) / np.sqrt(squares[stop] - squares[start])
                found = np.flatnonzero(bound >= max(self.header, head[0]) - 1e-6)
                return bound[found], start[found], stop[found]

            start = np.arange(max(len(whole) - SIZES[k], 0) + 1)
            runs = [reach(start, np.minimum(start + SIZES[k], len(whole)))]
            for n in range(2, len(edges)):
                short = np.flatnonzero(edges[n:] - edges[:-n] <= 2 * SIZES[k])
                if not len(short):
                    break
                runs.append(reach(edges[short], edges[short + n]))
            bound, start, stop = map(np.concatenate, zip(*runs, strict=True))
            for i in np.argsort(-bound, kind="stable"):
                if bound[i] < head[0] - 1e-6:
                    break
                found = tuple(whole[start[i] : stop[i]])
                if found not in done:
                    done.add(found)
                    got = self.best(list(found))
                    if got[0] >= self.header:
                        head = self.better(head, got)
        return head

    @staticmethod
    def better(a: tuple[float, str], b: tuple[float, str]) -> tuple[float, str]:
        return max(a, b, key=lambda x: (round(x[0], 12), [-c for c in x[1].encode()]))

    def scan(self, text: bytes) -> tuple[float, str, float, str]:
        """Best header cosine and licence; whole-text cosine and licence."""
        whole = terms(text)
        if self.telling.isdisjoint(whole):
            return 0.0, "", 0.0, ""
        head = (0.0, "")
        lines = text.splitlines()
        for part in {*lines, *re.split(rb"\n\s*\n", text)}:
            found = terms(part)
            if not self.telling.isdisjoint(found):
                head = self.better(head, self.best(found))
        ends = np.cumsum([len(terms(line)) for line in lines]).tolist()
        return *self.best_run(whole, ends, head), *self.best(whole)


def own_licences(files: DataFrame, header_cosine: float, file_cosine: float) -> DataFrame:
    """doc_id, path and own_licence, own_score, is_file of every file (doc_id, path, text)."""
    matcher = Matcher.build(*document_frequencies(files), min(header_cosine, file_cosine), header_cosine)

    def scan(batch: pa.RecordBatch) -> pa.RecordBatch:
        got = list(zip(*map(matcher.scan, as_bytes(batch.column(2))), strict=True))
        columns = [batch.column(0), batch.column(1), *(pa.array(g) for g in got)]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "path", "hs", "hl", "fs", "fl"])

    rows = map_batches(files.select("doc_id", "path", "text"), scan, "doc_id long, path string, hs double, hl string, fs double, fl string")
    whole = (F.col("fs") >= file_cosine) | (F.col("path").rlike(LICENCE_NAME) & (F.col("fs") > 0) & (F.greatest("fs", "hs") >= file_cosine))
    is_file = F.coalesce(whole, F.lit(False))
    header = F.col("hs") >= header_cosine
    by_whole = is_file & ((F.col("fs") >= F.col("hs")) | ~header)
    return rows.select(
        "doc_id",
        "path",
        F.when(by_whole, F.col("fl")).when(header, F.col("hl")).alias("own_licence"),
        F.when(by_whole, F.col("fs")).when(header, F.col("hs")).alias("own_score"),
        is_file.alias("is_file"),
    )


def directory(path: Column) -> Column:
    """The path without its last part; the empty string for a file at the top."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def scan_licences(files: DataFrame, header_cosine: float = 0.6, file_cosine: float = 0.3) -> DataFrame:
    """doc_id, path, own_licence, own_score, is_file, inherited_licence, inherited_from and licence of every file (doc_id, path, text)."""
    own = checkpointed(own_licences(files, header_cosine, file_cosine)).withColumn("dir", directory(F.col("path")))
    best = F.min(F.struct((-F.col("own_score")).alias("score"), "path", "own_licence")).alias("best")
    licensed = own.where("is_file and dir is not null").groupBy("dir").agg(best).select(F.col("dir").alias("above"), F.col("best.own_licence").alias("inherited_licence"))
    parts = F.split("dir", "/")
    # the directory itself and all above it, the empty path last
    depths = F.sequence(F.lit(0), F.when(F.col("dir") == "", 0).otherwise(F.size(parts)))
    above = F.when(F.col("depth") == 0, "").otherwise(F.array_join(F.slice(parts, F.lit(1), F.col("depth")), "/"))
    dirs = own.where("dir is not null").select("dir").distinct().select("dir", F.explode(depths).alias("depth")).withColumn("above", above)
    nearest = dirs.join(licensed, "above").groupBy("dir").agg(F.max(F.struct("depth", F.col("above").alias("inherited_from"), "inherited_licence")).alias("n"))
    nearest = checkpointed(nearest.select("dir", "n.inherited_from", "n.inherited_licence"))
    licence = F.coalesce("own_licence", "inherited_licence").alias("licence")
    joined = own.join(nearest, "dir", "left")
    return joined.select("doc_id", "path", "own_licence", "own_score", "is_file", "inherited_licence", "inherited_from", licence)


def document_paths(docs: DataFrame, fan: int = 1000) -> DataFrame:
    """doc_id, path and text of ``documents``: source/lang/block/doc_id."""
    block = F.floor(F.col("doc_id") / fan).cast("string")
    path = F.when(F.col("doc_id").isNotNull(), F.concat_ws("/", F.coalesce("source", F.lit("_")), F.coalesce("lang", F.lit("_")), block, F.col("doc_id").cast("string")))
    return docs.select("doc_id", path.alias("path"), "text")
