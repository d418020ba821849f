"""License scan: MinHash bands over overlapping windows find candidate templates, exact containment decides.

Words are lower-cased runs of letters and digits, shingles five words in a row. Notices of up to 11 words are looked up
by windows of one shingle: its MinHash is the shingle itself, so every shared shingle collides. Longer templates are cut
into pieces of 8 shingles every 4, texts into windows of 16 shingles every 8; a window that holds three quarters of a piece
has a similarity of 6/18 at least, and with 17 bands of one row each misses it with a probability of (2/3)^17 = 0.001.
A template of s shingles has (s - 8) / 4 + 1 pieces or so, and a window for each of them, to be missed by all of which is rarer still.

A document has a template where a window of 2s shingles (one every s) holds at least three quarters of its s distinct
shingles. All steps are expressions of one row: the scan has no shuffle, no join and no Python, and what a task holds
is one document.
"""

from __future__ import annotations

import random
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDTH = 5
PIECE, BLOCK, BANDS = 8, 8, 17

# Notices and passages of public licenses.
TEMPLATES = {
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "mit-notice": "Released under the MIT License.",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"
    ),
    "apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'
    ),
    "bsd-clauses": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer."
    ),
    "gpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "gpl-2.0-header": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."
    ),
    "lgpl-2.1-header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
        "License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."
    ),
    "agpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "mpl-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "isc-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "bsd-3-names": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission."
    ),
    "mit-warranty": (
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means."
    ),
    "cc-by-sa-4.0-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc0-1.0-notice": "This work is dedicated to the public domain under the CC0 1.0 Universal Public Domain Dedication.",
}


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where the body refers to it inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles_of(words: Column) -> Column:
    """The hashes of five words in a row; empty for fewer words."""
    hashed = lambda h: F.when(
        F.size(h) >= WIDTH,
        F.transform(F.sequence(F.lit(0), F.size(h) - WIDTH), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(WIDTH)])),
    ).otherwise(F.array().cast("array<bigint>"))
    return _let(F.transform(words, lambda w: F.xxhash64(w)), hashed)


def _minima(hashes: Column, masks: Column) -> Column:
    """One minimum for each band: of the hashes, put in another order by the band's mask."""
    return F.transform(masks, lambda mask: F.array_min(F.transform(hashes, lambda x: x.bitwiseXOR(mask))))


def _masks() -> Column:
    order = random.Random(2)
    return F.array(*[F.lit(order.getrandbits(64) - (1 << 63)) for _ in range(BANDS)])


def _window_keys(shingles: Column, masks: Column) -> Column:
    """The band keys of windows of two blocks, of which the second begins the next window."""
    blocks = F.sequence(F.lit(0), F.floor((F.size(shingles) - 1) / BLOCK).cast("int"))
    signed = lambda s: F.transform(blocks, lambda b: _minima(F.slice(s, b * BLOCK + 1, BLOCK), masks))
    joined = lambda g: F.flatten(
        F.transform(
            F.sequence(F.lit(0), F.size(g) - 1),
            lambda b: F.zip_with(F.get(g, b), F.coalesce(F.get(g, b + 1), F.get(g, b)), lambda x, y: F.least(x, y)),
        )
    )
    return F.when(F.size(shingles) > 0, _let(signed(shingles), joined)).otherwise(F.array().cast("array<bigint>"))


def _templates(df: DataFrame, templates: dict[str, str]) -> list:
    """(id, distinct shingles, keys of one-shingle windows, keys of long windows) by the same expressions as the texts."""
    rows = df.sparkSession.createDataFrame([(k, v) for k, v in sorted(templates.items())], "id string, text string")
    shingles = rows.select("id", shingles_of(words_of(F.col("text"))).alias("s"))
    pieces = F.transform(
        F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil((F.size("s") - PIECE) / (PIECE // 2)).cast("int"))),
        lambda p: F.slice(F.col("s"), p * (PIECE // 2) + 1, PIECE),
    )
    keyed = shingles.select("id", F.array_distinct("s").alias("s"), F.flatten(F.transform(pieces, lambda p: _minima(p, _masks()))).alias("keys"))
    return [(r.id, list(r.s), list(r["keys"])) for r in keyed.orderBy("id").collect()]


def license_scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """(doc_id, license_id, n_shingles, matched, containment, window_start) for every template a document holds.

    ``matched`` is the largest number of the template's distinct shingles in one window, ``window_start`` the first word
    of the first such window. A null or empty text, and one of fewer than five words, holds nothing; a template of fewer
    than five words is refused, as it has no shingle. Repeated rows give repeated results; other columns are ignored.
    """
    known = _templates(docs, templates)
    if short := [name for name, s, _ in known if not s]:
        raise ValueError(f"templates of fewer than {WIDTH} words: {', '.join(short)}.")
    longs = lambda values: F.array(*[F.lit(v) for v in values]).cast("array<bigint>")
    small = [k for k in known if len(k[1]) < PIECE]
    large = [k for k in known if len(k[1]) >= PIECE]
    table = F.array(
        *[
            F.struct(F.lit(name).alias("id"), longs(s).alias("shingles"), longs(s if len(s) < PIECE else keys).alias("keys"), F.lit(len(s)).alias("n"))
            for name, s, keys in known
        ]
    )
    probe_small = longs(sorted({x for _, s, _ in small for x in s}))
    probe_large = longs(sorted({x for _, _, keys in large for x in keys}))

    def hits(s: Column) -> Column:
        found = F.array_intersect(s, probe_small)
        return F.concat(found, F.array_intersect(_window_keys(s, _masks()), probe_large)) if large else found

    def verified(s: Column, t: Column) -> Column:
        last = F.greatest(F.lit(0), F.floor((F.size(s) - 1) / t["n"]).cast("int"))
        counts = F.transform(F.sequence(F.lit(0), last), lambda k: F.size(F.array_intersect(F.slice(s, k * t["n"] + 1, t["n"] * 2), t["shingles"])))
        best = lambda c: F.struct(
            t["id"].alias("license_id"), t["n"].alias("n_shingles"), F.array_max(c).alias("matched"),
            ((F.array_position(c, F.array_max(c)) - 1) * t["n"]).cast("int").alias("window_start"),
        )
        return _let(counts, best)

    def matches(s: Column) -> Column:
        of = lambda found: F.when(
            F.size(found) > 0,
            F.filter(
                F.transform(F.filter(table, lambda t: F.arrays_overlap(t["keys"], found)), lambda t: verified(s, t)),
                lambda m: m["matched"] * 4 >= m["n_shingles"] * 3,
            ),
        )
        return _let(hits(s), of)

    # An outer explode, as an inner one would have the optimizer compute the array a second time in a filter.
    rows = docs.select("doc_id", F.explode_outer(_let(shingles_of(words_of(F.col("text"))), matches)).alias("m"))
    return rows.where(F.col("m").isNotNull()).select(
        "doc_id", "m.license_id", "m.n_shingles", "m.matched", (F.col("m.matched") / F.col("m.n_shingles")).alias("containment"), "m.window_start"
    )
