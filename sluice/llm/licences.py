"""Licence scans: sparse TF-IDF cosine to templates, then inheritance along paths.

Every line, paragraph and whole text is compared with the templates; whole texts
that are a licence make their file a licence file. Files without a licence of
their own take that of the nearest directory above them that holds a licence
file, found by joining directories with their ancestors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.divergence import bare_words
from sluice.llm.vectors import Texts, Words, slices, split_words, texts
from sluice.session import materialize

# Notices by SPDX identifier, as their licences ask for them.
TEMPLATES: list[tuple[str, str]] = [
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with"
        " the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by"
        " applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS,"
        " WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language"
        " governing permissions and limitations under the License.",
    ),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
        " following conditions are met: Redistributions of source code must retain the above copyright notice, this list of"
        " conditions and the following disclaimer. Neither the name of the copyright holder nor the names of its contributors"
        " may be used to endorse or promote products derived from this software without specific prior written permission.",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright. CC0 1.0 Universal public domain dedication."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"
        " License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later"
        " version.",
    ),
    ("ISC", "Released under the ISC License."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the"
        " rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not"
        " distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]
LICENCE_NAME = r"(?i)^(un)?licen[cs]e([._-].*)?$|^copying([._-].*)?$"


@dataclass(frozen=True)
class Vocabulary:
    """The templates' terms and how many texts hold each of them."""

    keys: np.ndarray
    #: (templates, terms), how often
    counts: np.ndarray
    names: list[str]

    def weights(self, found: np.ndarray, total: int) -> tuple[np.ndarray, float, np.ndarray]:
        """Weight of each term, of a term in no template, and unit vectors of the templates."""
        idf = np.log((1 + total) / (1 + found)) + 1
        rare = float(np.log(1 + total) + 1)
        made = self.counts * idf
        return idf, rare, made / np.maximum(np.linalg.norm(made, axis=1, keepdims=True), 1e-12)


def vocabulary(templates: list[tuple[str, str]] = TEMPLATES) -> Vocabulary:
    t = texts(pa.array([text for _, text in templates], pa.string()))
    w = split_words(t)
    hashes = bare_words(t, w)
    keys, place = np.unique(hashes, return_inverse=True)
    counts = np.zeros((len(templates), len(keys)))
    np.add.at(counts, (w.doc, place), 1)
    return Vocabulary(keys, counts, [name for name, _ in templates])


def _terms(t: Texts, v: Vocabulary) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words, their hashes, and the place of each in the vocabulary (-1: none)."""
    w = split_words(t)
    hashes = bare_words(t, w)
    at = np.minimum(np.searchsorted(v.keys, hashes), len(v.keys) - 1)
    return w, hashes, np.where(v.keys[at] == hashes, at, -1)


def term_frequencies(df: DataFrame, v: Vocabulary) -> tuple[np.ndarray, int]:
    """In how many of all texts each template term occurs, and how many texts there are."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, total = np.zeros(len(v.keys), np.int64), 0
        for whole in batches:
            for part in slices(whole):
                w, _, at = _terms(texts(part.column("text")), v)
                pairs = np.unique((w.doc * len(v.keys) + at)[at >= 0])
                found += np.bincount(pairs % len(v.keys), minlength=len(v.keys))
                total += part.num_rows
        terms = pa.array(np.arange(-1, len(found)), pa.int32())
        yield pa.RecordBatch.from_arrays([terms, pa.array(np.append(total, found), pa.int64())], ["term", "n"])

    rows = df.select(F.col("text").cast("string")).mapInArrow(gather, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(len(v.keys) + 1, np.int64)
    for r in rows:
        counts[r["term"] + 1] = r["n"]
    return counts[1:], int(counts[0])


def cosines(unit: np.ndarray, hashes: np.ndarray, at: np.ndarray, units: int, idf: np.ndarray, rare: float, shapes: np.ndarray) -> np.ndarray:
    """(units, templates) cosines; words belong to units in ascending order."""
    order = np.lexsort((hashes, unit))
    u, h, a = unit[order], hashes[order], at[order]
    new = np.flatnonzero(np.concatenate([[True], (u[1:] != u[:-1]) | (h[1:] != h[:-1])])) if len(u) else np.zeros(0, np.int64)
    tf = np.diff(np.append(new, len(u)))
    u, a = u[new], a[new]
    weight = tf * np.where(a >= 0, idf[a], rare)
    norm = np.sqrt(np.bincount(u, weight**2, minlength=units))
    inside = a >= 0
    dots = np.zeros((units, len(shapes)))
    for k in range(len(shapes)):
        mine = inside & (shapes[k][a] > 0)
        dots[:, k] = np.bincount(u[mine], weight[mine] * shapes[k][a[mine]], minlength=units)
    return dots / np.maximum(norm, 1e-12)[:, None]


def _units(t: Texts, w: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of the unit of each word, for lines, paragraphs and whole texts; the text of each unit."""
    doc = w.doc
    if len(doc) == 0:
        return
    lines = np.concatenate([[0], np.cumsum(t.data == 10)])
    gap = np.concatenate([[0], lines[w.start[1:]] - lines[w.end[:-1]]])
    fresh = np.concatenate([[True], doc[1:] != doc[:-1]])
    for least in (1, 2, None):
        new = fresh | (gap >= least) if least else fresh
        unit = np.cumsum(new) - 1
        yield unit, doc[new]


def scan(
    df: DataFrame, key: str = "doc_id", path: str = "path", templates: list[tuple[str, str]] = TEMPLATES, least: float = 0.6, file_least: float = 0.85
) -> DataFrame:
    """The licence of every file of ``key, path, text``.

    Returns key, path, licence, score, basis and licence_path. ``basis`` is ``file``
    for licence files (by name, or a whole text at least ``file_least`` like a
    template), ``header`` for a line or paragraph at least ``least`` like one,
    ``inherited`` for files below a licence file's directory, else null as is the
    licence. The best template counts, of equal ones the first by name; a
    directory with several licence files gives its best, then first by path.
    Null texts have no licence of their own, files without a path inherit
    nothing, equal rows get equal results and an empty table gives an empty
    result. Other columns of the input are left out.
    """
    v = vocabulary(templates)
    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("_key"), F.col(path).cast("string").alias("path"), F.col("text").cast("string").alias("text"))
    idf, rare, shapes = v.weights(*term_frequencies(rows, v))
    order = np.argsort(np.array(v.names), kind="stable")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in slices(whole):
                t = texts(part.column("text"))
                w, hashes, at = _terms(t, v)
                best, which = np.zeros(len(t)), np.full(len(t), -1)
                whole_text = np.zeros(len(t))
                for unit, owner in _units(t, w):
                    # a unit without a term of the templates has no cosine
                    some = np.zeros(len(owner), bool)
                    some[unit[at >= 0]] = True
                    keep = some[unit]
                    place = np.cumsum(some) - 1
                    found = cosines(place[unit[keep]], hashes[keep], at[keep], int(some.sum()), idf, rare, shapes)[:, order]
                    owner = owner[some]
                    if not len(owner):
                        continue
                    top = found.argmax(axis=1)
                    value = found[np.arange(len(found)), top]
                    # the best unit of each text, of equal ones the first template
                    rank = np.lexsort((top, -np.round(value, 9), owner))
                    lead = rank[np.concatenate([[True], owner[rank][1:] != owner[rank][:-1]])]
                    whole_text[owner[lead]] = value[lead]
                    better = value[lead] > best[owner[lead]] + 1e-9
                    best[owner[lead][better]] = value[lead][better]
                    which[owner[lead][better]] = order[top[lead][better]]
                names = [v.names[k] if k >= 0 and b >= least else None for k, b in zip(which, best, strict=True)]
                arrays = [part.column("_key"), part.column("path"), pa.array(names, pa.string())]
                arrays += [pa.array(np.round(best, 6)), pa.array(np.round(whole_text, 6))]
                yield pa.RecordBatch.from_arrays(arrays, ["_key", "path", "licence", "score", "whole"])

    own = rows.mapInArrow(score, f"_key {kind}, path string, licence string, score double, whole double")
    folder = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    file = F.coalesce(F.col("licence").isNotNull() & ((F.col("whole") >= file_least) | name.rlike(LICENCE_NAME)), F.lit(False))
    known = materialize(own.withColumn("folder", folder).withColumn("file", file).drop("whole"), "licences")
    return inherit(known).select(F.col("_key").alias(key), "path", "licence", "score", "basis", "licence_path")


def inherit(known: DataFrame) -> DataFrame:
    """Give files without a licence that of the nearest licence file above them."""
    place = Window.partitionBy("folder").orderBy(F.desc("score"), "path", "licence")
    given = (
        known.filter("file AND path IS NOT NULL")
        .select("folder", F.struct("score", "path", "licence").alias("given"))
        .withColumns({"score": F.col("given.score"), "path": F.col("given.path"), "licence": F.col("given.licence")})
        .withColumn("_place", F.row_number().over(place))
        .filter("_place = 1")
        .select(F.col("folder").alias("above"), "given")
    )
    folders = known.filter("licence IS NULL AND path IS NOT NULL").select("folder").distinct()
    parts = F.split("folder", "/")
    depths = F.sequence(F.lit(0), F.size(parts))
    above = folders.select("folder", F.explode(depths).alias("depth"), parts.alias("parts")).select(
        "folder", "depth", F.when(F.col("depth") == 0, F.lit("")).otherwise(F.array_join(F.slice("parts", 1, F.greatest("depth", F.lit(1))), "/")).alias("above")
    )
    nearest = above.join(given, "above").groupBy("folder").agg(F.max_by("given", "depth").alias("given"))
    nearest = nearest.select(F.col("folder").alias("_folder"), "given")
    joined = known.join(nearest, F.col("licence").isNull() & F.col("path").isNotNull() & (F.col("folder") == F.col("_folder")), "left")
    own = F.col("licence").isNotNull()
    return joined.select(
        "_key",
        "path",
        F.coalesce("licence", "given.licence").alias("licence"),
        F.when(own, F.col("score")).otherwise(F.col("given.score")).alias("score"),
        F.when(own & F.col("file"), "file").when(own, "header").when(F.col("given").isNotNull(), "inherited").alias("basis"),
        F.when(own & F.col("file"), F.col("path")).when(~own, F.col("given.path")).alias("licence_path"),
    )
