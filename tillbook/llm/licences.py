"""Licence scan: sparse TF-IDF cosine of notices to templates, then inheritance along directories.

DataFrame functions only. The notices of a file are its lines and sentences that speak of a licence, and the sentences of
its paragraphs once comment marks and line breaks inside them are gone, so a wrapped header reads as it was written. Equal
notices are one row before anything is joined. Notices and the sentences of the templates become TF-IDF vectors, the terms
of the templates (a fixed list, so small) are broadcast, and a notice has the licence of its closest template
sentence at `least_cosine` or more whose version numbers and qualifiers (lesser, affero, non-commercial ...) are the
notice's own. A notice that denies is none. A licence whose text extends another's (BSD-3-Clause that of
BSD-2-Clause) goes before it. A file is a licence file if its name says so or at least half of its words stand
in matched notices; the licence of a directory is that of its licence files (most words, then name). A file without its own licence inherits from the nearest directory above it that has one.

Directories are joined once per distinct directory, files only with the answer for their directory.

Defined cases: a null text is empty; a null path has no directory and inherits nothing; every row gives a row, repeated ones too;
ties take the licence that comes first in the alphabet; without files there is no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillbook.session import pin

_GPL_START = "This program is free software{} you can redistribute it and/or modify it under the terms of the GNU {}General Public License as published by the Free Software Foundation{} either version {} of the License, or (at your option) any later version."
_GPL_ONLY = "This work is licensed under the GNU {}General Public License, version {}."
_GPL_NAMED = "Licensed under the GNU {}General Public License v{}."

# Identifiers and the sentences that licence headers and files use for them.
TEMPLATES = {
    "AGPL-3.0": [
        _GPL_START.format(":", "Affero ", ",", "3"),
        _GPL_ONLY.format("Affero ", "3"),
        _GPL_NAMED.format("Affero ", "3.0"),
        "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
        "The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, specifically designed to ensure cooperation with the community in the case of network server software.",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Apache License Version 2.0, January 2004",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements.",
        "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, "
        "prepare Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "BSD-2-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Licensed under the BSD 2-Clause License.",
        "BSD 2-Clause License",
        "SPDX-License-Identifier: BSD-2-Clause",
    ],
    "BSD-3-Clause": [
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "Licensed under the BSD 3-Clause License.",
        "BSD 3-Clause License",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "BSL-1.0": [
        "Distributed under the Boost Software License, Version 1.0.",
        "Boost Software License - Version 1.0 - August 17th, 2003",
        "SPDX-License-Identifier: BSL-1.0",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ],
    "EPL-2.0": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0",
        "Eclipse Public License - v 2.0",
        "SPDX-License-Identifier: EPL-2.0",
    ],
    "GPL-2.0": [
        _GPL_START.format(";", "", ";", "2"),
        _GPL_ONLY.format("", "2"),
        _GPL_NAMED.format("", "2.0"),
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
        "SPDX-License-Identifier: GPL-2.0-or-later",
        "SPDX-License-Identifier: GPL-2.0-only",
    ],
    "GPL-3.0": [
        _GPL_START.format(":", "", ",", "3"),
        _GPL_ONLY.format("", "3"),
        _GPL_NAMED.format("", "3.0"),
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "SPDX-License-Identifier: GPL-3.0-only",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "SPDX-License-Identifier: ISC",
    ],
    "LGPL-2.1": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        _GPL_ONLY.format("Lesser ", "2.1"),
        _GPL_NAMED.format("Lesser ", "2.1"),
        "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ],
    "LGPL-3.0": [
        _GPL_START.format(":", "Lesser ", ",", "3"),
        _GPL_ONLY.format("Lesser ", "3"),
        _GPL_NAMED.format("Lesser ", "3.0"),
        "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
        "SPDX-License-Identifier: LGPL-3.0-only",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished "
        "to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "The MIT License (MIT)",
        "SPDX-License-Identifier: MIT",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Mozilla Public License Version 2.0",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
        "Released under the Unlicense.",
        "SPDX-License-Identifier: Unlicense",
    ],
    "Zlib": [
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
        "Licensed under the zlib License.",
        "SPDX-License-Identifier: Zlib",
    ],
}
# A licence whose text holds the other's.
EXTENDS = {"BSD-3-Clause": "BSD-2-Clause"}
# Words that a notice and its template must agree on, besides version numbers.
QUALIFIERS = ["affero", "lesser", "library", "agpl", "lgpl", "nc", "noncommercial", "nd", "noderivatives", "noderivs", "sa", "sharealike"]
VERSION = r"^v?([1-9](?:\.[0-9])?)(?:\.0)*$"
DENIES = r"(?i)(?:\bnot|n't|\bnever|\bno longer)\s+(?:\w+\s+){0,2}(?:licen[cs]ed|released|distributed|covered|available|subject)\b"
# Words without which a sentence is no notice.
SPEAKS = r"(?i)licen[cs]e|redistribut|permission|creative commons|neither the name|unencumbered|free to copy"
FILE_NAME = r"(?i)^(?:licen[cs]e|copying|notice|unlicense)(?:[._-][^/]*)?$"
SENTENCES = r"\n|(?<=[.!?;])[\x20\x09\x0B-\x0D]+(?=\S)"
# A line break with the comment marks and list numbers of the next line; an empty line ends a paragraph.
WRAP = r"[\x20\x09\x0D]*+\n[\x20\x09]*+(?:[#/*;%>|-]++[\x20\x09]*+)?(?=[^\s#/*;%>|-])"
PARAGRAPHS = r"\n|(?<=[.!?:])(?<!\bv\.)[\x20\x09\x0B-\x0D]+(?=\S)"


def _terms(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}.]+|\.+(?!\p{N})"), lambda t: t != "")


def _notices(text: Column) -> Column:
    """Distinct sentences that speak of a licence, trimmed of white space, comment marks and list numbers.

    Once as the lines have them, once from paragraphs with their lines joined.
    """
    found = F.concat(F.split(text, SENTENCES, -1), F.split(F.regexp_replace(text, WRAP, " "), PARAGRAPHS, -1))
    speaking = F.filter(found, lambda s: s.rlike(SPEAKS) & ~s.rlike(DENIES))
    return F.array_distinct(F.transform(speaking, lambda s: F.regexp_replace(s, r"^(?:[\s#/*;%>|-]++|(?:[0-9]{1,2}|[a-z])[.)]\s++)++|[\s*/]++$", "")))


def _marks(text: Column) -> Column:
    """Version numbers (3 and v3.0 are one) and qualifiers of a notice, sorted."""
    numbers = F.filter(F.transform(_terms(text), lambda t: F.regexp_extract(t, VERSION, 1)), lambda v: v != "")
    words = F.filter(_terms(text), lambda t: t.isin(QUALIFIERS))
    return F.array_join(F.array_sort(F.array_distinct(F.concat(numbers, words))), " ")


def _vectors(texts: DataFrame, key: list[str]) -> DataFrame:
    """Key and term frequency rows of column text."""
    return texts.select(*key, F.explode(_terms(F.col("text"))).alias("term")).groupBy(*key, "term").agg(F.count(F.lit(1)).alias("tf"))


def matched_notices(notices: DataFrame, least_cosine: float) -> DataFrame:
    """text, licence and cosine of the distinct texts in notices(text) that are close to a template."""
    spark = notices.sparkSession
    templates = spark.createDataFrame([(k, i, s) for k, held in TEMPLATES.items() for i, s in enumerate(held)], "licence string, sentence int, text string")
    own = pin(_vectors(notices, ["text"]), "notice-terms")
    fixed = _vectors(templates, ["licence", "sentence"])
    total = notices.count() + templates.count()
    df = own.select("term").unionAll(fixed.select("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = (F.col("tf") * (F.log((F.lit(1.0) + total) / (1 + F.col("df"))) + 1)).alias("weight")
    own = own.join(df, "term").select("text", "term", weight)
    norms = own.groupBy("text").agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("norm"))
    fixed = fixed.join(df, "term").select("licence", "sentence", "term", weight)
    sizes = fixed.groupBy("licence", "sentence").agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("size"))
    unit = fixed.join(sizes, ["licence", "sentence"]).select("licence", "sentence", "term", (F.col("weight") / F.col("size")).alias("share"))
    dots = (
        own.join(F.broadcast(unit), "term")  # as many rows as TEMPLATES has words
        .groupBy("text", "licence", "sentence")
        .agg(F.sum(F.col("weight") * F.col("share")).alias("dot"))
    )
    marked = templates.select("licence", "sentence", _marks(F.col("text")).alias("marks"))
    agreeing = dots.join(F.broadcast(marked), ["licence", "sentence"]).filter(F.col("marks") == _marks(F.col("text")))
    close = agreeing.join(norms, "text").select("text", "licence", F.round(F.col("dot") / F.col("norm"), 9).alias("cosine"))
    best = close.filter(F.col("cosine") >= least_cosine).groupBy("text", "licence").agg(F.max("cosine").alias("cosine"))
    return _strongest(best, "text", "cosine")


def _strongest(rows: DataFrame, key: str, strength: str) -> DataFrame:
    """Per key the licence of the greatest strength, of equal ones the first by name; combined before the shuffle."""
    kept = F.min(F.struct((-F.col(strength)).alias("less"), F.col("licence"))).alias("kept")
    return rows.groupBy(key).agg(kept).select(key, "kept.licence", (-F.col("kept.less")).alias(strength))


def scan(files: DataFrame, least_cosine: float = 0.8) -> DataFrame:
    """The id and path of every row of files(id, path, text), with licence, cosine, origin and directory.

    origin is own, inherited or null; directory is the one that the licence is inherited from.
    """
    text = F.coalesce("text", F.lit(""))
    rows = files.select("id", "path", text.alias("text"), F.monotonically_increasing_id().alias("row"))
    rows = rows.withColumn("notices", F.when(F.col("text").rlike(SPEAKS), _notices(F.col("text"))).otherwise(F.array().cast("array<string>")))
    rows = pin(
        rows.select(
            "row",
            "id",
            "path",
            F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("dir"),
            "notices",
            F.when(F.size("notices") > 0, F.size(_terms(F.col("text")))).otherwise(0).alias("words"),
        ),
        "licence-notices",
    )
    each = rows.select("row", "words", F.explode("notices").alias("text"))
    matched = pin(matched_notices(each.select("text").distinct(), least_cosine), "matched-notices")
    hits = each.join(matched, "text").withColumn("covered", F.size(_terms(F.col("text"))))
    covered = hits.groupBy("row").agg(F.sum("covered").alias("covered"))
    # what another licence of the file extends steps back; a row has at most as many licences as there are templates
    held = F.collect_set("licence").over(Window.partitionBy("row"))
    extended = F.lit(False)
    for more, less in EXTENDS.items():
        extended = extended | ((F.col("licence") == less) & F.array_contains("held", more))
    per_file = _strongest(hits.withColumn("held", held).filter(~extended), "row", "cosine")
    own = pin(per_file.join(covered, "row").join(rows.select("row", "dir", "path", "words"), "row"), "own-licences")

    # licence of a directory from its licence files
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    is_file = F.col("path").isNotNull() & (name.rlike(FILE_NAME) | (2 * F.col("covered") >= F.col("words")))
    held = own.filter(is_file).groupBy("dir", "licence").agg(F.sum("covered").alias("covered"))
    of_dir = _strongest(held, "dir", "covered").select(F.col("dir").alias("above"), F.col("licence").alias("from_dir"))

    # every distinct directory meets its ancestors: a/b/c, a/b, a and the root
    dirs = rows.filter("path is not null").select("dir").distinct()
    parts = F.split("dir", "/")
    depth = F.explode(F.sequence(F.lit(0), F.size(parts))).alias("depth")
    ancestors = dirs.select("dir", parts.alias("parts"), depth).select("dir", "depth", F.array_join(F.slice("parts", 1, F.col("depth")), "/").alias("above"))
    nearest = (
        ancestors.distinct()
        .join(of_dir, "above")
        .groupBy("dir")
        .agg(F.max(F.struct(F.col("depth"), F.col("above"), F.col("from_dir"))).alias("n"))
        .select(F.col("dir").alias("_dir"), F.col("n.above").alias("above"), F.col("n.from_dir").alias("from_dir"))
    )
    answered = (
        rows.select("row", "id", "path", F.when(F.col("path").isNotNull(), F.col("dir")).alias("dir"))
        .join(own.select("row", "licence", "cosine"), "row", "left")
        .join(nearest, F.col("dir") == F.col("_dir"), "left")
    )
    mine = F.col("licence").isNotNull()
    return answered.select(
        "id",
        "path",
        F.coalesce("licence", "from_dir").alias("licence"),
        "cosine",
        F.when(mine, "own").when(F.col("from_dir").isNotNull(), "inherited").alias("origin"),
        F.when(~mine, F.col("above")).alias("directory"),
    )
