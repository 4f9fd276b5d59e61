import math
import re
from collections import Counter

from llm_data import SF, documents, llm, nothing, odd, odd_rows  # noqa: F401
from pyspark.sql import functions as F

from tillbook.llm import licences

MIT = "MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files."


def files(llm, rows):
    return llm.createDataFrame(rows, "id long, path string, text string")


def answers(df):
    return {r.id: (r.licence, r.origin, r.directory) for r in df.collect()}


def test_headers_files_and_inheritance(llm):
    rows = [
        (1, "a/LICENSE", MIT),
        (2, "a/b/c/code.py", "print(1)"),
        (3, "a/b/COPYING.txt", "This work is licensed under the GNU General Public License, version 3."),
        (4, "a/b/own.py", "# Licensed under the Apache License, Version 2.0.\nprint(2)"),
        (5, "z/code.py", "no word of it"),
        (6, "a/code.py", None),
        (7, None, "Released under the MIT License."),
        (8, None, "nothing"),
        (9, "a/d/e/f/code.py", "x"),
        (10, "root.py", "a licence to print, and the permission to whatever else comes to mind"),
        (11, "a/b/c/code.py", "print(1)"),
        (11, "a/b/c/code.py", "print(1)"),
    ]
    got = answers(licences.scan(files(llm, rows)))
    assert got == {
        1: ("MIT", "own", None),
        2: ("GPL-3.0", "inherited", "a/b"),
        3: ("GPL-3.0", "own", None),
        4: ("Apache-2.0", "own", None),
        5: (None, None, None),
        6: ("MIT", "inherited", "a"),
        7: ("MIT", "own", None),
        8: (None, None, None),
        9: ("MIT", "inherited", "a"),
        10: (None, None, None),
        11: ("GPL-3.0", "inherited", "a/b"),
    }
    assert licences.scan(files(llm, rows)).count() == len(rows)


def test_root_licence_and_ties(llm):
    rows = [(1, "LICENSE", "Released under the MIT License."), (2, "x/y.c", ""), (3, "t/NOTICE", "SPDX-License-Identifier: MIT"), (4, "t/COPYING", "SPDX-License-Identifier: ISC"), (5, "t/c.c", "")]
    got = answers(licences.scan(files(llm, rows)))
    assert got[2] == ("MIT", "inherited", "")
    assert got[5] == ("ISC", "inherited", "t")  # as many words: the first by name


def terms(text):
    return [t for t in re.split(r"[^\w.]+|_|\.+(?!\d)", text.lower()) if t]


def test_cosine_equals_plain_arithmetic(llm):
    notices = ["Licensed under the Apache License, Version 2.0.", "licensed under the apache license version 2.0 or so", "The MIT License", "a license of another kind entirely"]
    fixed = [(k, s) for k, held in licences.TEMPLATES.items() for s in held]
    texts = notices + [s for _, s in fixed]
    df = Counter(t for x in texts for t in set(terms(x)))

    def vector(text):
        return {t: n * (math.log((1 + len(texts)) / (1 + df[t])) + 1) for t, n in Counter(terms(text)).items()}

    def cosine(a, b):
        return sum(a[t] * b[t] for t in a if t in b) / math.sqrt(sum(v * v for v in a.values()) * sum(v * v for v in b.values()))

    expected = {}
    for n in notices:
        best = max((round(cosine(vector(n), vector(s)), 6), [-ord(c) for c in k], k) for k, s in fixed)
        if best[0] >= 0.5:
            expected[n] = (best[2], best[0])
    got = licences.matched_notices(llm.createDataFrame([(n,) for n in notices], "text string"), 0.5).collect()
    assert {r.text: (r.licence, round(r.cosine, 6)) for r in got} == expected


def test_lines_of_the_documents_are_found(llm, documents):
    docs = llm.read.parquet(f"{SF}/documents.parquet").select(F.col("doc_id").alias("id"), F.lit(None).cast("string").alias("path"), "text")
    lines = {"Apache-2.0": "Licensed under the Apache License, Version 2.0.", "MIT": "Released under the MIT License.", "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.", "GPL-3.0": "This work is licensed under the GNU General Public License, version 3."}
    planted = {d: k for d, t in documents for k, line in lines.items() if line in t}
    got = {r.id: r.licence for r in licences.scan(docs).collect() if r.licence}
    assert planted and got == planted


def test_no_python_and_odd_rows(llm, odd, odd_rows, nothing):
    rows = odd.select(F.col("doc_id").alias("id"), F.lit("x/y").alias("path"), "text", "row", "n", "w")
    out = licences.scan(rows)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not [w for w in ("Python", "Pandas", "ArrowEval") if w in plan]
    assert out.count() == len(odd_rows)
    assert licences.scan(nothing.select(F.col("doc_id").alias("id"), F.col("lang").alias("path"), "text")).collect() == []


GPL = (
    "This program is free software{a} you can redistribute it and/or modify it under the terms of the GNU {kind}General Public License as published by the "
    "Free Software Foundation{b} either version {v} of the License, or (at your option) any later version."
)
BSD = [
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "",
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
    "and/or other materials provided with the distribution.",
]
THIRD = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the "
    "Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
    "and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be "
    "included in all copies or substantial portions of the Software."
)


def wrapped(text, mark, width=72):
    import textwrap

    lines = [part for line in text.split("\n") for part in (textwrap.wrap(line, width) or [""])]
    return "\n".join((mark + line).rstrip() for line in lines) + "\ncode();"


def test_wrapped_headers_and_whole_texts(llm):
    headers = {
        "GPL-3.0": GPL.format(a=":", kind="", b=",", v="3"),
        "GPL-2.0": GPL.format(a=";", kind="", b=";", v="2"),
        "LGPL-3.0": GPL.format(a=":", kind="Lesser ", b=",", v="3"),
        "AGPL-3.0": GPL.format(a=":", kind="Affero ", b=",", v="3"),
        "LGPL-2.1": GPL.format(a=";", kind="Lesser ", b=";", v="2.1").replace("program", "library"),
        "BSD-2-Clause": "\n".join(BSD),
        "BSD-3-Clause": "\n".join([*BSD, THIRD]),
        "MIT": GRANT,
        "Apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at',
        "Unlicense": "This is free and unencumbered software released into the public domain.",
        "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at",
    }
    names, rows = list(headers), []
    for i, name in enumerate(names):
        for j, mark in enumerate(["# ", "// ", " * ", ""]):
            rows.append((10 * i + j, f"d{10 * i + j}/f.c", wrapped(headers[name], mark)))
    got = {r.id: r.licence for r in licences.scan(files(llm, rows)).collect()}
    assert got == {10 * i + j: name for i, name in enumerate(names) for j in range(4)}


def test_near_names_and_denials(llm):
    texts = {
        "This work is licensed under the GNU General Public License, version 2.": "GPL-2.0",
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
        "This work is licensed under the GNU Lesser General Public License, version 3.": "LGPL-3.0",
        "This work is licensed under the GNU General Public License, version 4.": None,
        "Licensed under CC BY-SA 4.0.": "CC-BY-SA-4.0",
        "Licensed under CC BY-NC-ND 4.0.": None,
        "Licensed under the Apache License, Version 1.1.": None,
        "SPDX-License-Identifier: LGPL-2.1-only": "LGPL-2.1",
        "SPDX-License-Identifier: BSD-2-Clause": "BSD-2-Clause",
        "This file is not licensed under the MIT License.": None,
        "It was never released under the MIT License.": None,
        "Released under the MIT License.": "MIT",
    }
    rows = [(i, f"d{i}/f.c", t) for i, t in enumerate(texts)]
    got = {r.id: r.licence for r in licences.scan(files(llm, rows)).collect()}
    assert got == dict(enumerate(texts.values()))


def test_inheritance_equals_brute_force(llm):
    import random

    rng = random.Random(7)
    lines = {"MIT": "Released under the MIT License.", "ISC": "SPDX-License-Identifier: ISC", "GPL-2.0": "SPDX-License-Identifier: GPL-2.0-only"}
    rows = []
    for i in range(200):
        folder = "/".join(rng.choice("abc") for _ in range(rng.randrange(0, 5)))
        name, text = ("LICENSE", lines[rng.choice(list(lines))]) if rng.random() < 0.15 else (f"f{i}.c", "int main;")
        rows.append((i, f"{folder}/{name}".lstrip("/"), text))
    own = {i: next((k for k, line in lines.items() if line in t), None) for i, _, t in rows}
    words = lambda t: len(terms(t))
    weight = Counter()
    for i, path, t in rows:
        if own[i]:
            weight[path.rpartition("/")[0], own[i]] += words(t)
    expected = {}
    for i, path, _ in rows:
        parts = path.split("/")[:-1]
        above = ["/".join(parts[:n]) for n in range(len(parts), -1, -1)]
        found = next((max((n, [-ord(c) for c in k], k) for (d, k), n in weight.items() if d == a)[2] for a in above if any(d == a for d, _ in weight)), None)
        expected[i] = own[i] or found
    assert {r.id: r.licence for r in licences.scan(files(llm, rows)).collect()} == expected
