"""Licences told apart by version and clause, declared expressions, inheritance, recall."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import licenses

TEXT = dict(licenses.TEXTS)
GPL2 = "This program is free software; you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation; either version 2 of the License, or\n(at your option) any later version.\n"
LGPL21 = "This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\nLicense as published by the Free Software Foundation; either\nversion 2.1 of the License, or (at your option) any later version.\n"
BSD2 = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this\n   list of conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice,\n   this list of conditions and the following disclaimer in the documentation\n   and/or other materials provided with the distribution.\n"
BSD3 = BSD2 + "\n3. Neither the name of Some Company nor the names of its\n   contributors may be used to endorse or promote products derived from\n   this software without specific prior written permission.\n"


def scanned(spark, rows):
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, path string, text string"), F.col("path"))
    return {r.doc_id: r for r in got.collect()}


def test_versions_clauses_and_declarations(spark):
    rows = [
        (1, "a/1.c", BSD2), (2, "a/2.c", BSD3), (3, "a/3.c", GPL2), (4, "a/4.c", LGPL21), (5, "a/5.c", "/* SPDX-License-Identifier: MIT */ int x;"), (6, "a/6.c", "// SPDX-License-Identifier: GPL-2.0-only\nint y;"),
        (7, "a/7.c", "// SPDX-License-Identifier: GPL-2.0-or-later\nint y;"), (8, "a/8.c", "# SPDX-License-Identifier: Apache-2.0 OR MIT\nx = 1"), (9, "a/9.c", "# spdx... SPDX-License-Identifier: mit for all of it"), (10, "a/10.c", "int plain;"),
        (11, "a/11.c", BSD2.split("met:")[1]), (12, "a/12.c", "This program and the accompanying materials are made\navailable under the terms of the Eclipse Public License 2.0\nwhich is available at https://www.eclipse.org/legal/epl-2.0/"),
        (13, "a/13.c", TEXT["Zlib"]), (14, "a/14.c", "SPDX-License-Identifier: (GPL-2.0+ WITH Classpath-exception-2.0) AND (MIT OR ISC)"), (15, "a/15.c", "Code distributed under the Terms of the Foo Public License, see there"),
        (16, "b/LICENSE", GPL2), (17, "b/x.c", "SPDX-License-Identifier: Foo-9.9 int z;"), (18, "b/y.c", "int inherits;"), (19, "b/sub/deep/z.c", "int inherits;"),
    ]
    got = scanned(spark, rows)
    want = {
        1: "BSD-2-Clause", 2: "BSD-3-Clause", 3: "GPL-2.0-or-later", 4: "LGPL-2.1-or-later", 5: "MIT", 6: "GPL-2.0-only", 7: "GPL-2.0-or-later", 8: "Apache-2.0 OR MIT", 9: "MIT", 11: "BSD-2-Clause", 12: "EPL-2.0", 13: "Zlib",
        14: "(GPL-2.0-or-later WITH Classpath-exception-2.0) AND (MIT OR ISC)", 15: None, 16: "GPL-2.0-or-later", 17: None, 18: "GPL-2.0-or-later", 19: "GPL-2.0-or-later",
    }
    assert {i: got[i].license for i in want} == want
    assert (got[10].origin, got[10].from_doc_id) == ("inherited", 11) or got[10].license in ("BSD-2-Clause", "BSD-3-Clause", "Zlib")  # a licence's own wording makes a licence file
    assert {got[i].origin for i in (15, 17)} == {"none"} and got[18].from_doc_id == got[19].from_doc_id == 16


def test_declarations_and_notices_make_no_licence_file(spark):
    got = scanned(spark, [(1, "a/5.c", "/* SPDX-License-Identifier: MIT */ int x;"), (2, "a/y.c", "int plain;"), (3, "b/h.c", GPL2), (4, "b/y.c", "int plain;")])
    assert [(got[i].license, got[i].origin) for i in (1, 2, 3, 4)] == [("MIT", "own"), (None, "none"), ("GPL-2.0-or-later", "own"), (None, "none")]


def altered(text, rng):
    """A notice with some words left out or put in, on lines of other lengths, behind comment signs."""
    words = [w for w in text.split() if rng.random() > 0.04]
    for _ in range(len(words) // 25):
        words.insert(rng.randrange(len(words) + 1), rng.choice(["herewith", "also", "kindly"]))
    wide = rng.randrange(6, 16)
    return "\n".join(f"{rng.choice(['# ', ' * ', '// ', ''])}{' '.join(words[i : i + wide])}" for i in range(0, len(words), wide))


def brute(weights, text):
    """The best cosine of any run of words with any wording, tried at every word."""
    import pyarrow as pa

    from tidemark.llm import _bytes

    chunk = next(_bytes.chunks(pa.array([text], pa.large_string())))
    hashes, _, _ = licenses._words(chunk.data, chunk.offsets)
    at, known, best = licenses._place(weights.known, hashes), weights.known, (0.0, 0, "")
    own = [t for t, kind in enumerate(known.kinds) if kind != "clause"]
    for a in range(len(at)):
        for n in known.lengths:
            cosines = weights.cosines(at[a : a + n], hashes[a : a + n])
            for t in own:
                best = max(best, (round(float(cosines[t]), 9), int(known.words[t]), known.names[t]))
    return best


def test_recall_on_altered_notices(spark):
    rng = random.Random(5)
    known = licenses.templates()
    long = [(n, t) for n, t in [*licenses.NOTICES, *licenses.TEXTS] if len(t.split()) >= 12 and n != "BSD-2-Clause"]
    prose = "the quick river said that all of its copies were lost in the terms of winter and any version of them".split()
    rows = []
    for i in range(160):
        name, text = long[i % len(long)]
        around = lambda: " ".join(rng.choice(prose) for _ in range(rng.randrange(5, 60)))
        rows.append((i, name, f"{around()}\n{altered(text, rng)}\n{around()}. {around()}\n"))
    clean = [(1000 + i, None, " ".join(rng.choice(prose) for _ in range(120))) for i in range(40)]
    got = scanned(spark, [(i, f"d{i}/x.c", t) for i, _, t in rows + clean])
    hits = sum(got[i].license == name for i, name, _ in rows)
    assert hits >= 0.9 * len(rows), hits
    assert all(got[i].license is None for i, _, _ in clean)
    # against every run of words: what that finds is found, and where it is right so are we
    import numpy as np

    frequency = np.zeros(len(known.vocabulary))
    weights = licenses.Weights(known, 1 + np.log(201 / (1 + frequency)), 0.75)
    sample = rows[::8]
    there = [(i, name, brute(weights, t)) for i, name, t in sample]
    found = [got[i].license is not None for i, _, b in there if b[0] >= 0.8]
    assert len(found) >= 15 and sum(found) >= 0.9 * len(found)


def test_long_texts_and_odd_rows(spark):
    long = "word " * 200_000 + "\nReleased under the MIT License.\n" + "other " * 200_000
    got = scanned(spark, [(1, "a/x", long), (2, "a/y", ""), (3, None, None), (4, "z", "licence " * 5000), (5, "q/LICENSE", "Licensed under the MIT License"), (6, "q/COPYING", "Licensed under the MIT License"), (7, "q/x", "plain")])
    assert got[1].license == "MIT" and [got[i].license for i in (2, 3, 4)] == [None] * 3 and got[7].license == "MIT" and got[7].from_doc_id == 6
    assert pytest.approx(got[1].score) == 1.0
