"""Operator 6, license scans: MinHash bands over overlapping text windows
retrieve templates, exact shingle containment verifies the matches.

Only DataFrame functions are used.  Words are the runs of letters and digits in
lower case; shingles have five words (a shorter template: all its words).

* Templates with the same shingle length and count share a window: as many
  shingles as the template and half as many again, which is also the overlap's
  step, so every run of the template's length lies whole in some window.
* A window that holds three quarters of a template's shingles has a similarity
  to it of at least ``(3/4 m) / (w + m/4)``.  Bands are single minima; their
  number is set so that such a window misses all of them with a probability
  under ``MISS``.
* Windows without any shingle of any template have no similarity to find and
  are not made: an exact screen on each text's shingles, before the bands.
* Retrieved pairs are verified by the share of the template's shingles that
  the window holds, at least ``containment``.
* A notice that differs from others of its family in a few words only, as those
  of other versions do, names its licence where each of its telling phrases
  (``TELLING``) lies in a shingle that the window holds.  Other matches of the
  template stand for the same notice where their windows overlap, for nothing
  where they overlap a notice of the family that is named, and for the family's
  ``LicenseRef-...-unclear`` elsewhere.

Templates are a bounded table (``MAX_TEMPLATES``), sent to the tasks by value.
Texts are never shuffled.

Edge cases: null, empty and wordless texts match nothing; rows with null ids
are reported under the null id; the matches of rows with the same id count
together; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_and_text

SHINGLE = 5
CONTAINMENT = 0.75
MISS = 1e-6
MAX_TEMPLATES = 2000

# fixed values: notices by SPDX name
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                "option) any later version."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("LicenseRef-AllRightsReserved", "All rights reserved."),
]


_GNU = ("can redistribute it and/or modify it under the terms of the GNU {} Public License as published by the Free "
        "Software Foundation; either version {} of the License, or (at your option) any later version.")
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met")
_BSD_2 = (_BSD + ": 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
          "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of "
          "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.")
_PROVIDED = " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES"
_CC = "This work is licensed under a Creative Commons {} License."

# fixed values: what the scan looks for
NOTICES = [(name, text) for name, text in TEMPLATES if text != _BSD] + [
    ("LicenseRef-BSD-unclear", _BSD),
    ("BSD-2-Clause", _BSD_2 + _PROVIDED),
    ("BSD-3-Clause", _BSD_2 + " 3. Neither the name of the copyright holder nor the names of its contributors may be used to "
                     "endorse or promote products derived from this software without specific prior written permission."
                     + _PROVIDED),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you " + _GNU.format("General", "2")),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License version 2 as published by the Free Software Foundation."),
    ("LGPL-2.0", "This library is free software; you " + _GNU.format("Library General", "2")),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-2.1", "This library is free software; you " + _GNU.format("Lesser General", "2.1")),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-3.0", "This library is free software; you " + _GNU.format("Lesser General", "3")),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", "This program is free software: you " + _GNU.format("Affero General", "3")),
    ("MPL-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not "
                "use this file except in compliance with the License."),
    ("EPL-1.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
                "v1.0"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
                "2.0"),
    ("ISC", "Released under the ISC License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    *[(f"CC-{kind}-4.0", f"Licensed under CC {kind} 4.0.") for kind in ("BY-SA", "BY-ND", "BY-NC-SA", "BY-NC-ND")],
    *[(f"CC-{kind}-{version}", _CC.format(f"{name} {version} {scope}"))
      for version, scope in (("4.0", "International"), ("3.0", "Unported"))
      for kind, name in (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"),
                         ("BY-NC", "Attribution-NonCommercial"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
                         ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives")) if (kind, version) != ("BY", "4.0")],
    ("CC0-1.0", "Released under CC0 1.0 Universal."),
    ("CC0-1.0", "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring "
                "rights to this software to the public domain worldwide."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]

#: by licence: the name of its family's notices that can't be told apart, and the phrases that tell it from the others
#: (each for the templates that have it); None: its notices never name a licence
TELLING = {
    "GPL-2.0": ("LicenseRef-GNU-unclear", ["gnu general", "version 2"]),
    "GPL-3.0": ("LicenseRef-GNU-unclear", ["gnu general", "version 3"]),
    "LGPL-2.0": ("LicenseRef-GNU-unclear", ["library general", "version 2 of"]),
    "LGPL-2.1": ("LicenseRef-GNU-unclear", ["lesser general", "version 2 1"]),
    "LGPL-3.0": ("LicenseRef-GNU-unclear", ["lesser general", "version 3"]),
    "AGPL-3.0": ("LicenseRef-GNU-unclear", ["affero general", "version 3"]),
    "Apache-2.0": ("LicenseRef-Apache-unclear", ["version 2 0"]),
    "MPL-1.1": ("LicenseRef-MPL-unclear", ["version 1 1"]),
    "MPL-2.0": ("LicenseRef-MPL-unclear", ["v 2 0"]),
    "EPL-1.0": ("LicenseRef-EPL-unclear", ["v1 0"]),
    "EPL-2.0": ("LicenseRef-EPL-unclear", ["license 2 0"]),
    "BSD-2-Clause": ("LicenseRef-BSD-unclear", ["distribution this software", "bsd 2 clause"]),
    "BSD-3-Clause": ("LicenseRef-BSD-unclear", ["neither the name of", "bsd 3 clause"]),
    "LicenseRef-BSD-unclear": ("LicenseRef-BSD-unclear", None),
    **{f"CC-{kind}-{version}": ("LicenseRef-CC-unclear", [f"{last} {version[0]} 0"])
       for version in ("3.0", "4.0")
       for kind, last in (("BY", "attribution"), ("BY-SA", "sharealike"), ("BY-ND", "noderivatives"),
                          ("BY-NC", "attribution noncommercial"), ("BY-NC-SA", "noncommercial sharealike"),
                          ("BY-NC-ND", "noncommercial noderivatives"))},
}


def words_of(text: str) -> list[str]:
    return [w for w in re.split(r"[^a-z0-9]+", text.lower()) if w]


class Window:
    """The windows of the templates with shingles of ``n`` words, ``m`` of them."""

    def __init__(self, n: int, m: int):
        self.n, self.m = n, m
        self.step = math.ceil(m / 2)
        self.size = m + self.step
        self.floor = CONTAINMENT * m / (self.size + (1 - CONTAINMENT) * m)
        self.bands = math.ceil(math.log(MISS) / math.log(1 - self.floor))
        self.name = f"{n}x{m}"


def _shingles(n: int, words: str) -> str:
    """SQL: hashes of the runs of ``n`` words."""
    parts = ", ".join(f"{words}[i + {k}]" for k in range(n))
    return (f"if(size({words}) >= {n}, transform(sequence(0, size({words}) - {n}), i -> xxhash64({parts})), "
            "cast(array() as array<bigint>))")


def _telling(words: list[str], n: int, phrases: list[str]) -> list[list[int]]:
    """For each phrase that the words have, where the shingles begin that hold it."""
    found = []
    for phrase in phrases:
        p = phrase.split()
        starts = [i for i in range(len(words) - n + 1) if any(words[k:k + len(p)] == p for k in range(i, i + n - len(p) + 1))]
        if starts:
            found.append(starts)
    return found


def _places(items: Column, known: list[int]) -> Column:
    """Where the items that are known stand.

    The known ones lie in as many bins as there are of them, by remainder, so an
    item is compared with those of one bin, one in the mean, whatever their
    number.  The bins are a text in the plan, which the optimizer folds to one
    array for the task."""
    bins: list[list[int]] = [[] for _ in known]
    for s in known:
        bins[s % len(bins)].append(s)
    table = F.from_json(F.lit(json.dumps(bins)), "array<array<bigint>>")
    found = F.filter(F.transform(items, lambda s, i: F.when(
        F.array_contains(F.get(table, F.pmod(s, F.lit(len(bins))).cast("int")), s), i)), lambda i: i.isNotNull())
    return F.when(F.size(items) > 0, found).otherwise(F.expr("cast(array() as array<int>)"))


def _minima(bands: str, items: str) -> str:
    """SQL: the smallest hash under each of the hash functions."""
    return f"transform(sequence(1, {bands}), j -> array_min(transform({items}, x -> xxhash64(x, j))))"


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 templates: list[tuple[str, str]] = NOTICES, telling: dict = TELLING) -> DataFrame:
    """``id_col``, ``license``, ``containment`` (the largest of its windows),
    ``first_word`` (where its first matching window starts) and ``n_windows``."""
    spark = docs.sparkSession
    rows = []
    for number, (name, text) in enumerate(templates):
        words = words_of(text)
        if words:
            n = min(SHINGLE, len(words))
            rows.append((number, name, n, words))
    if not rows or len(rows) > MAX_TEMPLATES:
        raise ValueError(f"between 1 and {MAX_TEMPLATES} templates with words are needed")
    lengths = sorted({n for _, _, n, _ in rows})
    sized = {number: len({tuple(w[i:i + n]) for i in range(len(w) - n + 1)}) for number, _, n, w in rows}
    windows = {w.name: w for w in (Window(n, sized[number]) for number, _, n, _ in rows)}
    listed = []
    for number, name, n, words in rows:
        w = windows[f"{n}x{sized[number]}"]
        family, phrases = telling.get(name, (name, []))
        listed.append((number, name, w.name, n, words, w.bands, w.size, family, phrases is not None,
                       _telling(words, n, phrases or [])))
    table = spark.createDataFrame(listed, "number int, license string, window string, n int, words array<string>, bands int, "
                                          "size int, family string, names boolean, telling array<array<int>>")
    own = "case n " + " ".join(f"when {n} then {_shingles(n, 'words')}" for n in lengths) + " end"
    table = table.withColumn("all", F.expr(own)).withColumn("shingles", F.array_distinct("all")).withColumn(
        "telling", F.expr("transform(telling, t -> transform(t, i -> all[i]))"))
    table = table.withColumn("minima", F.expr(_minima("bands", "shingles")))
    held = table.select("number", "n", "shingles").collect()  # at most MAX_TEMPLATES rows
    known = {n: sorted({s for r in held if r["n"] == n for s in r["shingles"]}) for n in lengths}

    texts = id_and_text(docs, id_col, text_col).select(
        "id", F.monotonically_increasing_id().alias("row"), F.expr("filter(split(lower(text), '[^a-z0-9]+', -1), w -> w <> '')").alias("words"))
    for n in lengths:
        texts = texts.withColumn(f"s{n}", F.expr(_shingles(n, "words")))
        texts = texts.withColumn(f"at{n}", _places(F.col(f"s{n}"), known[n]))
    made = []
    for w in windows.values():
        # the windows that hold a place: numbers from (place - size) / step up to place / step
        numbers = (f"array_distinct(flatten(transform(at{w.n}, i -> sequence(cast(greatest(0, (i - {w.size}) div {w.step} + "
                   f"if(i >= {w.size}, 1, 0)) as int), cast(i div {w.step} as int)))))")
        made.append(f"transform({numbers}, k -> named_struct('window', '{w.name}', 'bands', {w.bands}, "
                    f"'first', k * {w.step}, 'items', slice(s{w.n}, k * {w.step} + 1, {w.size})))")
    found = (texts.select("id", "row", F.explode_outer(F.expr("concat(" + ", ".join(made) + ")")).alias("w"))
             .filter("w is not null").select("id", "row", "w.window", "w.first", "w.items", "w.bands"))
    marked = found.select("id", "row", "window", "first", "items",
                          F.posexplode_outer(F.expr(_minima("bands", "items"))).alias("band", "least"))
    marks = F.broadcast(table.select("number", "license", "shingles", "window", "size", "family", "names", "telling",
                                     F.posexplode("minima").alias("band", "least")))
    retrieved = (marked.join(marks, ["window", "band", "least"])
                 .withColumn("held", F.size(F.array_intersect("items", "shingles")) / F.size("shingles"))
                 .filter(F.col("held") >= CONTAINMENT))
    # the matches of a text in one family: as many as it has windows with such notices
    told = F.expr("names and forall(telling, t -> arrays_overlap(items, t))")
    matches = (retrieved.withColumn("told", told).groupBy("row", "id", "family")
               .agg(F.collect_set(F.struct("number", "license", "window", "first", "size", "held", "told")).alias("ms"))
               .withColumn("named", F.expr("filter(ms, x -> x.told)")))
    license = """case when m.told or exists(named, o -> o.number = m.number and abs(o.first - m.first) < m.size) then m.license
        when not exists(named, o -> o.first < m.first + m.size and m.first < o.first + o.size) then family end"""
    return (matches.select("id", "family", "named", F.explode("ms").alias("m"))
            .select("id", F.expr(license).alias("license"), "m.held", "m.first", "m.window").filter("license is not null")
            .groupBy("id", "license").agg(
                F.max("held").alias("containment"), F.min("first").cast("long").alias("first_word"),
                F.countDistinct("window", "first").alias("n_windows")).withColumnRenamed("id", id_col))


def oracle_sql(templates: list[tuple[str, str]] = NOTICES, telling: dict = TELLING) -> str:
    """The scan in DuckDB SQL, by comparing every window with every template,
    with the phrases that tell the licences of a family apart."""
    values, shingle_rows, telling_rows = [], [], []
    for number, (name, text) in enumerate(templates):
        words = words_of(text)
        n = min(SHINGLE, len(words))
        ordered = [" ".join(words[i:i + n]) for i in range(len(words) - n + 1)]
        family, phrases = telling.get(name, (name, []))
        told = _telling(words, n, phrases or [])
        w = Window(n, len(set(ordered)))
        # phrases to be found; -1: matches never name the licence
        values.append(f"({number}, '{name}', '{family}', {-1 if phrases is None else len(told)}, {n}, {w.m}, {w.step}, {w.size}, '{w.name}')")
        shingle_rows += [f"({number}, '{p}')" for p in sorted(set(ordered))]
        telling_rows += [f"({number}, {k}, '{p}')" for k, starts in enumerate(told) for p in sorted({ordered[i] for i in starts})]
    places = " UNION ALL ".join(
        f"SELECT doc_id, {n} AS n, unnest(list_transform(range(0, greatest(0, len(ws) - {n - 1})), lambda i: "
        f"{{'i': i, 's': array_to_string(ws[i + 1:i + {n}], ' ')}})) AS x FROM d"
        for n in sorted({min(SHINGLE, len(words_of(text))) for _, text in templates}))
    return f"""
WITH t(number, license, family, phrases, n, m, step, size, win) AS (VALUES {', '.join(values)}),
s(number, shingle) AS (VALUES {', '.join(shingle_rows)}),
y(number, phrase, shingle) AS (VALUES {', '.join(telling_rows or ["(-1, 0, '')"])}),
d AS (SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^a-z0-9]+'), lambda x: x <> '') AS ws
      FROM documents),
p AS ({places}),
h AS (SELECT p.doc_id, t.*, p.x.i AS i, s.shingle
      FROM p JOIN s ON s.shingle = p.x.s JOIN t ON t.number = s.number AND t.n = p.n),
k AS (SELECT *, unnest(range(greatest(0, CASE WHEN i >= size THEN (i - size) // step + 1 ELSE 0 END), i // step + 1)) AS w FROM h),
c AS (SELECT doc_id, number, license, family, phrases, win, size, w * step AS first, count(DISTINCT shingle) / m AS held
      FROM k GROUP BY doc_id, number, license, family, phrases, win, size, w, step, m
      HAVING count(DISTINCT shingle) / m >= {CONTAINMENT}),
z AS (SELECT k.doc_id, k.number, k.w * k.step AS first, count(DISTINCT y.phrase) AS phrases
      FROM k JOIN y ON y.number = k.number AND y.shingle = k.shingle GROUP BY k.doc_id, k.number, k.w * k.step),
m AS (SELECT c.*, c.phrases = coalesce(z.phrases, 0) AS told
      FROM c LEFT JOIN z ON z.doc_id = c.doc_id AND z.number = c.number AND z.first = c.first),
r AS (SELECT m.*, coalesce(bool_or(o.number = m.number AND abs(o.first - m.first) < m.size), false) AS beside,
             coalesce(bool_or(o.first < m.first + m.size AND m.first < o.first + o.size), false) AS taken
      FROM m LEFT JOIN m AS o ON o.told AND o.doc_id = m.doc_id AND o.family = m.family
      GROUP BY ALL)
SELECT doc_id, CASE WHEN told OR beside THEN license ELSE family END AS license, max(held) AS containment,
       min(first) AS first_word, count(DISTINCT (win, first)) AS n_windows
FROM r WHERE told OR beside OR NOT taken GROUP BY ALL
"""
