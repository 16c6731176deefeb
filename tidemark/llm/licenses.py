"""Operator 9: licence scans by sparse TF-IDF cosine to templates, with directory inheritance.

A text is cut into units, lines and sentences. Windows of units, each about as long as some template,
are compared with all templates: the cosine of the sets of their words, weighed by inverse document
frequencies over all texts. A word outside the templates weighs as much as the rarest word inside,
so prose around a notice lowers its cosine. This finds notices broken over lines, headers and
licence texts alike, wherever they stand.

Nothing is filtered by a list of words. A window can only reach the threshold with a template if it
has words that carry threshold ** 2 of the template's weight (Cauchy-Schwarz). So each template has
a smallest set of its rarest words one of which every such window holds; only around those words
are windows formed, and the weight that a window covers is bounded by prefix sums before its cosine
is worked out, over the words that it has.

A declared identifier (SPDX-License-Identifier, an expression with AND, OR, WITH, -only, -or-later)
counts before any wording. Wordings of different versions are templates of their own. A wording
that is part of another one is told from it by the rest: two BSD clauses are BSD-2-Clause, unless
the third stands in the text too.

A text is a licence file if its name says so, or if the wording of a licence, not a notice that
refers to one, makes up half of its words. A text without a licence of its own inherits that of the
nearest directory above it with a licence file, by joins on the directories that occur, at any
depth; but a text that names a licence which is not known here inherits none.

Defined cases: null text is empty; a null path has no directory and inherits nothing; repeated rows
are scanned as rows of their own; equal scores go to the longer template, then the lesser name; of
several licence files in a directory the one with the best score counts, then the least path, then
the least id; an empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import _bytes
from tidemark.llm._tables import materialise

#: Notices that refer to a licence, by SPDX identifier.
NOTICES: list[tuple[str, str]] = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause Simplified License"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal"),
    ("EPL-2.0", "This program is made available under the terms of the Eclipse Public License 2.0"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3"),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3"),
    ("GPL-2.0-only", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation"),
    ("GPL-2.0-or-later", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version"),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("AGPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("LGPL-2.1-or-later", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version"),
    ("LGPL-3.0-or-later", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version"),
    ("ISC", "Released under the ISC License"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Licensed under the MIT License"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/"),
]
#: Wordings of licences themselves, by SPDX identifier.
TEXTS: list[tuple[str, str]] = [
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 Copyright (C) 2007 Free Software Foundation, Inc. https://fsf.org/ Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed"),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSD-2-Clause", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSL-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the Software) to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software"),
    ("CC0-1.0", "The person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law, including all related and neighboring rights, to the extent allowed by law"),
    ("EPL-2.0", "Eclipse Public License - v 2.0 THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE (AGREEMENT). ANY USE, REPRODUCTION OR DISTRIBUTION OF THE PROGRAM CONSTITUTES RECIPIENT'S ACCEPTANCE OF THIS AGREEMENT"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc. Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. https://fsf.org/ Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999 Copyright (C) 1991, 1999 Free Software Foundation, Inc. Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. https://fsf.org/ Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions"),
]
#: Wordings that make another licence of one whose wording stands in the text too.
CLAUSES: list[tuple[str, str, str]] = [
    ("BSD-2-Clause", "BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
]
#: SPDX identifiers that files may declare, those that -only and -or-later go with, and exceptions.
IDENTIFIERS = [
    "0BSD", "Apache-1.1", "Apache-2.0", "Artistic-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause", "BSL-1.0", "CC-BY-3.0", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-3.0", "CC-BY-SA-4.0", "CC0-1.0", "CDDL-1.0", "ECL-2.0",
    "EPL-1.0", "EPL-2.0", "EUPL-1.2", "ISC", "MIT", "MIT-0", "MPL-1.1", "MPL-2.0", "MS-PL", "NCSA", "OFL-1.1", "PostgreSQL", "PSF-2.0", "Python-2.0", "Unlicense", "UPL-1.0", "WTFPL", "X11", "Zlib",
]
VERSIONED = ["AGPL-3.0", "GFDL-1.3", "GPL-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0"]
EXCEPTIONS = ["Autoconf-exception-3.0", "Bison-exception-2.2", "Classpath-exception-2.0", "Font-exception-2.0", "GCC-exception-3.1", "Linux-syscall-note", "LLVM-exception", "OpenSSL-exception"]
_ID = r"\(*[A-Za-z0-9][A-Za-z0-9.+-]*\)*"
#: An identifier, or several with operators between; what follows without one is no part of it.
DECLARED = rf"SPDX-License-Identifier:[ \t]*({_ID}(?:[ \t]+(?i:AND|OR|WITH)[ \t]+{_ID})*)"
#: Words by which a text names a licence, known here or not.
NAMES_ONE = r"(?i)SPDX-License-Identifier:|\b(licen[cs]ed|distributed|released|made available) under\b.{0,80}\blicen[cs]e"
#: File names of licence texts.
FILE_NAME = r"(?i)(^|/)(licen[cs]e|copying|unlicense)([.-][^/]*)?$"

# letters and digits as they are (A-Z lower-cased), other ASCII to spaces
_TEXT = _bytes.LOWER.copy()
_TEXT[:0x80] = np.where(np.isin(_TEXT[:0x80], [*range(0x30, 0x3A), *range(0x61, 0x7B)]), _TEXT[:0x80], 0x20)


def identifier(declared: Column) -> Column:
    """A declared expression in its usual spelling, null if it has an identifier that is not known."""
    known = {x.lower(): x for x in [*IDENTIFIERS, *VERSIONED, *EXCEPTIONS, *(f"{v}{end}" for v in VERSIONED for end in ("-only", "-or-later"))]}
    known |= {f"{v.lower()}+": f"{v}-or-later" for v in VERSIONED} | {x: x.upper() for x in ("and", "or", "with", "(", ")")}
    listed = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    parts = F.filter(F.split(F.lower(F.regexp_replace(declared, r"([()])", " $1 ")), r"\s+"), lambda x: x != "")
    spelt = F.transform(parts, lambda x: F.try_element_at(listed, x))
    whole = F.replace(F.replace(F.array_join(spelt, " "), F.lit("( "), F.lit("(")), F.lit(" )"), F.lit(")"))
    return F.when((F.size(parts) > 0) & ~F.exists(spelt, lambda x: x.isNull()), whole)


@dataclass
class Templates:
    names: list[str]
    kinds: list[str]  # notice, text or clause
    vocabulary: np.ndarray  # sorted hashes of the templates' words
    has: np.ndarray  # template x word
    words: np.ndarray  # how long each template is
    lengths: np.ndarray  # of windows, in words


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    low = _bytes.Chunk(0, _TEXT[data], offsets)
    starts, ends, rows = _bytes.word_bounds(low)
    return _bytes.span_hashes(low.data, starts, ends), starts, rows


def templates(notices: list[tuple[str, str]] = NOTICES, texts: list[tuple[str, str]] = TEXTS) -> Templates:
    listed = [(n, "notice", t) for n, t in notices] + [(n, "text", t) for n, t in texts] + [(f"{a}>{b}", "clause", t) for a, b, t in CLAUSES]
    chunk = next(_bytes.chunks(pa.array([t for _, _, t in listed], pa.large_string())))
    hashes, _, rows = _words(chunk.data, chunk.offsets)
    vocabulary, at = np.unique(hashes, return_inverse=True)
    has = np.zeros((len(listed), len(vocabulary)), dtype=bool)
    has[rows, at] = True
    words = np.bincount(rows, minlength=len(listed))
    steps = np.unique(np.geomspace(words.min(), words.max(), 14).round().astype(np.int64))
    return Templates([n for n, _, _ in listed], [k for _, k, _ in listed], vocabulary, has, words, steps)


def _place(known: Templates, hashes: np.ndarray) -> np.ndarray:
    """Index of each word among the templates' words, -1 for others."""
    at = np.minimum(np.searchsorted(known.vocabulary, hashes), len(known.vocabulary) - 1)
    return np.where(known.vocabulary[at] == hashes, at, -1)


def _frequencies(known: Templates):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(known.vocabulary), dtype=np.int64)
        for batch in batches:
            for chunk in _bytes.chunks(batch.column(0)):
                hashes, _, rows = _words(chunk.data, chunk.offsets)
                at = _place(known, hashes)
                pairs = np.unique(rows[at >= 0] * len(known.vocabulary) + at[at >= 0])
                total += np.bincount(pairs % len(known.vocabulary), minlength=len(known.vocabulary))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["word", "n"])

    return run


class Weights:
    """Squared weights of the templates' words, and what follows from them for a threshold."""

    def __init__(self, known: Templates, idf: np.ndarray, threshold: float):
        self.known, self.threshold = known, threshold
        self.square = idf**2
        self.outside = float(self.square.max())
        self.shares = known.has * self.square  # template x word
        self.whole = self.shares.sum(axis=1)
        self.telling = np.zeros(len(idf), dtype=bool)
        for own, whole in zip(self.shares, self.whole, strict=True):
            rarest = np.argsort(-own, kind="stable")
            need = int(np.searchsorted(np.cumsum(own[rarest]), (1 - threshold**2) * whole, side="right")) + 1
            self.telling[rarest[:need]] = True

    def cosines(self, at: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Of a window's words with each template."""
        own = np.unique(at[at >= 0])
        others = len(np.unique(hashes[at < 0]))
        return self.shares[:, own].sum(axis=1) / np.sqrt((self.square[own].sum() + others * self.outside) * self.whole)


def _regions(marked: np.ndarray, rows: np.ndarray, reach: int) -> Iterator[tuple[int, int]]:
    """Stretches of words of one row within ``reach`` words of a marked one."""
    hits = np.flatnonzero(marked)
    if not len(hits):
        return
    first = np.searchsorted(rows, rows[hits], side="left")
    last = np.searchsorted(rows, rows[hits], side="right")
    low, high = np.maximum(hits - reach, first), np.minimum(hits + reach + 1, last)
    new = np.concatenate(([True], low[1:] >= np.maximum.accumulate(high)[:-1]))  # rows never share one
    edges = np.flatnonzero(new)
    for a, b in zip(edges, np.append(edges[1:], len(hits)), strict=True):
        yield int(low[a]), int(high[a:b].max())


def _windows(units: np.ndarray, low: int, high: int, lengths: np.ndarray) -> np.ndarray:
    """(start, end) of windows that begin with a unit in the region: of one unit, and of as many as
    make each length. units: where units begin, in words."""
    starts = np.unique(np.concatenate(([low], units[(units > low) & (units < high)])))
    ends = np.append(starts[1:], high)
    found = [np.stack((starts, ends), axis=1)]
    for n in lengths:
        found.append(np.stack((starts, ends[np.minimum(np.searchsorted(ends, starts + n), len(ends) - 1)]), axis=1))
    return np.unique(np.concatenate(found), axis=0)


def _found(weights: Weights, chunk: _bytes.Chunk) -> Iterator[tuple[int, int, float, int, int]]:
    """(row, template, cosine, words of the window, words of the row) of each window that reaches the
    threshold with some template: its best one, and every clause."""
    known = weights.known
    hashes, starts, rows = _words(chunk.data, chunk.offsets)
    if not len(rows):
        return
    in_row = np.bincount(rows, minlength=len(chunk))
    at = _place(known, hashes)
    data = chunk.data
    breaks = np.flatnonzero((data == 0x0A) | ((data == 0x20) & (np.concatenate(([0], data[:-1])) == 0x2E)))  # line ends, and spaces after full stops
    units = np.unique(np.concatenate((np.searchsorted(starts, breaks), np.searchsorted(rows, np.unique(rows)))))
    marked = np.zeros(len(at), dtype=bool)
    marked[at >= 0] = weights.telling[at[at >= 0]]
    order = sorted(range(len(known.names)), key=lambda t: (-known.words[t], known.names[t]))
    clauses = [t for t in order if known.kinds[t] == "clause"]
    for low, high in _regions(marked, rows, int(known.words.max() * 5 // 4)):
        own = at[low:high]
        gains = np.where((own >= 0)[:, None], weights.shares.T[own], 0.0)
        sums = np.concatenate((np.zeros((1, gains.shape[1])), np.cumsum(gains, axis=0)))
        windows = _windows(units, low, high, known.lengths)
        most = sums[windows[:, 1] - low] - sums[windows[:, 0] - low]  # at least the weight that a window covers
        likely = (most >= weights.threshold**2 * weights.whole).any(axis=1)
        for a, b in windows[likely]:
            cosines = weights.cosines(at[a:b], hashes[a:b])
            for t in clauses:
                if cosines[t] >= weights.threshold:
                    yield int(rows[a]), t, float(cosines[t]), int(b - a), int(in_row[rows[a]])
            t = max((t for t in order if known.kinds[t] != "clause"), key=lambda t: round(float(cosines[t]), 9))
            if cosines[t] >= weights.threshold:
                yield int(rows[a]), t, float(cosines[t]), int(b - a), int(in_row[rows[a]])


def _scanned(known: Templates, idf: np.ndarray, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = Weights(known, idf, threshold)
        for batch in batches:
            for chunk in _bytes.chunks(batch.column("text")):
                best: dict[int, tuple] = {}
                share, more = np.zeros(len(chunk)), [set() for _ in range(len(chunk))]
                for row, t, cosine, words, in_row in _found(weights, chunk):
                    name = known.names[t]
                    if known.kinds[t] == "clause":
                        more[row].add(name)
                        continue
                    if known.kinds[t] == "text":
                        share[row] = max(share[row], words / in_row)
                    rank = (-round(cosine, 9), -int(known.words[t]), name)
                    if row not in best or rank < best[row][0]:
                        best[row] = (rank, name, cosine)
                names, scores = [best[r][1] if r in best else None for r in range(len(chunk))], [best[r][2] if r in best else 0.0 for r in range(len(chunk))]
                for row, clauses in enumerate(more):
                    names[row] = next((c.split(">")[1] for c in sorted(clauses) if c.split(">")[0] == names[row]), names[row])
                kept = [batch.column(c).slice(chunk.first, len(chunk)) for c in ("doc_id", "path", "declared", "names_one")]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(share)], names=["doc_id", "path", "declared", "names_one", "license", "score", "share"])

    return run


def parent(path: Column) -> Column:
    """The directory of a path, '' at the top."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def scan(df: DataFrame, path: Column, key: str = "doc_id", text: str = "text", notices: list[tuple[str, str]] = NOTICES, texts: list[tuple[str, str]] = TEXTS, threshold: float = 0.75) -> DataFrame:
    """One row per text: doc_id, path, license, score, origin (own, inherited, none), from_doc_id."""
    known = templates(notices, texts)
    said = F.nullif(F.regexp_extract(df[text], DECLARED, 1), F.lit(""))
    files = df.select(df[key].alias("doc_id"), path.alias("path"), identifier(said).alias("declared"), F.coalesce(df[text].rlike(NAMES_ONE), F.lit(False)).alias("names_one"), df[text].alias("text"))
    counted = df.select(df[text]).mapInArrow(_frequencies(known), "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    frequency = np.zeros(len(known.vocabulary))
    for r in counted.collect():  # a row for each word of the templates
        frequency[r["word"]] = r["n"]
    n = df.count()
    idf = 1 + np.log((1 + n) / (1 + frequency))
    kind = files.schema["doc_id"].dataType.simpleString()
    found = materialise(files.mapInArrow(_scanned(known, idf, threshold), f"doc_id {kind}, path string, declared string, names_one boolean, license string, score double, share double"), "licences")
    # a declared identifier is what the file says; one that is not known here leaves the wording out too
    says = F.col("declared").isNotNull()
    own = found.select("doc_id", "path", "names_one", F.coalesce("declared", "license").alias("license"), F.when(says, 1.0).otherwise(F.col("score")).alias("score"), "share")

    files = own.filter("license IS NOT NULL AND path IS NOT NULL").filter(F.col("path").rlike(FILE_NAME) | (F.col("share") >= 0.5))
    best = F.min(F.struct((-F.col("score")).alias("s"), "path", "doc_id", "license", "score"))
    held = files.withColumn("dir", parent(F.col("path"))).groupBy("dir").agg(best.alias("best"))
    dirs = own.filter("path IS NOT NULL").select(parent(F.col("path")).alias("of")).distinct()
    parts = F.split("of", "/")
    depth = F.size(parts)
    above = F.transform(F.sequence(depth, F.lit(0)), lambda k: F.struct(F.array_join(F.slice(parts, 1, k), "/").alias("dir"), k.alias("depth")))
    nearest = dirs.select("of", F.inline(above)).distinct().join(held, "dir").groupBy("of").agg(F.max(F.struct("depth", "best")).alias("near")).select("of", F.col("near.best").alias("best"))
    joined = own.withColumn("of", F.when(F.col("license").isNull() & ~F.col("names_one"), parent(F.col("path")))).join(nearest, "of", "left")
    mine, theirs = F.col("license").isNotNull(), F.col("best").isNotNull()
    return joined.select(
        "doc_id",
        "path",
        F.coalesce("license", "best.license").alias("license"),
        F.when(mine, F.col("score")).when(theirs, F.col("best.score")).otherwise(0.0).alias("score"),
        F.when(mine, "own").when(theirs, "inherited").otherwise("none").alias("origin"),
        F.when(mine, F.col("doc_id")).when(theirs, F.col("best.doc_id")).alias("from_doc_id"),
    )
