"""License scans with built-in functions: MinHash bands over overlapping windows, then exact containment.

Texts are lower-cased words (letters and digits); shingles are five of them.  Templates fall into classes by their
number of shingles n, a class holding those with ``size / 4 < n <= size / 2``.  A class has windows of ``size``
shingles that overlap by half, so every passage as long as a template lies in a whole window, and the Jaccard
similarity of the two is at least 1/4 for a verbatim passage, 0.19 at the least containment of 0.8.  With ``BANDS``
bands of one row, such a window shares a band with probability 1 - (1 - 0.19)^48 > 0.9999; a window without any
shingle of a template shares none.  What is retrieved is verified: the share of the template's shingles in the window.

Versions and variants of a license differ in a word or two, which containment forgives.  So a template names phrases
that tell it apart, and they must all stand in the passage: from the first to the last of its shingles found, and as
many words on both sides as the template has there.  A passage inside that of a longer template is not reported.

Only windows near a key word are signed.  The key words are in so many shingles of each template that no window without
any can hold the least containment.

Short identifiers (``CC BY-NC 4.0``, ``CC0 1.0``, ``SPDX-License-Identifier: MIT``) have too few words for shingles.
They are found by their pattern, exactly, with containment 1.  Templates need five words; a shorter one is an error.

Null texts, and those of fewer than five words but for identifiers, hold nothing.  A document has a row per license
found, ties and repeats included once; equal rows give equal rows.  Of ``docs`` only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SHINGLE = 5
BANDS = 48
CONTAINMENT = 0.8


class Template(NamedTuple):
    license: str
    notice: str
    needs: tuple[str, ...] = ()  # phrases, as plain words


def _gnu(name: str, kind: str, versions: tuple[str, ...]) -> list[Template]:
    """The header of a program and the short notice of a work, with and without a version."""
    title = f"GNU {kind}General Public License"
    phrase = title.lower()
    header = f"This program is free software: you can redistribute it and/or modify it under the terms of the {title} as published by the Free Software Foundation"
    later = "either version {} of the License, or (at your option) any later version"
    out = [Template(name, header, (phrase,)), Template(name, f"This work is licensed under the {title}", (phrase,))]
    for v in versions:
        words, code = v.replace(".", " "), f"{name}-{v if '.' in v else v + '.0'}"
        out.append(Template(code, f"This work is licensed under the {title}, version {v}", (phrase, f"version {words}")))
        out.append(Template(code, f"{header}, {later.format(v)}", (phrase, f"version {words} of")))
    return out


def _creative_commons() -> list[Template]:
    out = []
    for parts in ("", "NonCommercial", "ShareAlike", "NoDerivatives", "NonCommercial-ShareAlike", "NonCommercial-NoDerivatives"):
        code = "-".join(["CC-BY", *(SHORT[p] for p in parts.split("-") if p)])
        name = " ".join(["Attribution", *parts.split("-")]).strip()
        needs = ("attribution", *(p.lower() for p in parts.split("-") if p))
        out.append(Template(code, f"This work is licensed under a Creative Commons {name}", needs))
        for version in ("3.0", "4.0"):
            place = "International" if version == "4.0" else "Unported"
            notice = f"This work is licensed under a Creative Commons {name} {version} {place} License"
            out.append(Template(f"{code}-{version}", notice, (*needs, " ".join([name.lower(), *version.split(".")]))))
    return out


# fixed values: the parts of a Creative Commons license and their codes
SHORT = {"NonCommercial": "NC", "ShareAlike": "SA", "NoDerivatives": "ND"}

# fixed values: notices as their licenses give them; a license may have several
TEMPLATES = [
    Template("Apache-2.0", "Licensed under the Apache License, Version 2.0", ("apache", "2 0")),
    Template(
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at",
        ("apache", "2 0"),
    ),
    Template("MIT", "Released under the MIT License", ("mit",)),
    Template("MIT", "This project is licensed under the MIT License", ("mit",)),
    Template(
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so",
    ),
    *_gnu("GPL", "", ("2", "3")),
    *_gnu("LGPL", "Lesser ", ("2.1", "3")),
    *_gnu("AGPL", "Affero ", ("3",)),
    Template(
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
    ),
    Template(
        "BSD-3-Clause",
        "may be used to endorse or promote products derived from this software without specific prior written permission",
        ("endorse or promote",),
    ),
    Template(
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    ),
    Template(
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        ("mozilla", "2 0"),
    ),
    Template(
        "EPL-2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
        ("eclipse", "2 0"),
    ),
    Template(
        "EPL-1.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0",
        ("eclipse", "v1 0"),
    ),
    Template("Unlicense", "This is free and unencumbered software released into the public domain", ("unencumbered",)),
    Template(
        "Zlib",
        "This software is provided as-is, without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software",
        ("authors be held",),
    ),
    Template(
        "BSL-1.0",
        "Distributed under the Boost Software License, Version 1.0",
        ("boost",),
    ),
    Template(
        "CC0-1.0",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
        ("waived all",),
    ),
    *_creative_commons(),
]

# fixed values: patterns of short identifiers, and what their text must hold at least (lower case)
SPDX = r"spdx-license-identifier:\s*([a-z0-9][a-z0-9.+-]*[a-z0-9+])"
CC_BY = r"\b(cc[ -]by(?:-(?:nc|sa|nd))*[ -][1-4]\.[0-9])\b"
CC_ZERO = r"\b(cc0(?:[ -]1\.0)?)\b"
HINTS = ("spdx-license-identifier:", "cc by", "cc-by", "cc0")
# fixed values: identifiers whose letters are not all upper case
SPELLED = {"apache-2.0": "Apache-2.0", "bsd-2-clause": "BSD-2-Clause", "bsd-3-clause": "BSD-3-Clause", "unlicense": "Unlicense", "zlib": "Zlib"}


def plain_words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def key_words(notices: list[str], containment: float, size: int = SHINGLE, long: int = 6) -> list[str]:
    """Words, chosen greedily, that are in so many shingles of each template that a passage with a share of
    ``containment`` of them has one; short words only where nothing else does."""
    split = {k: plain_words(t) for k, t in enumerate(notices)}
    open_ = {k: {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} for k, w in split.items()}
    enough = {k: containment * len(s) for k, s in open_.items()}
    chosen: list[str] = []
    while lacking := [s for k, s in open_.items() if s and len(s) >= enough[k]]:
        counts = Counter(w for s in lacking for shingle in s for w in set(shingle))
        best = max(counts, key=lambda w: (len(w) >= long, counts[w] * len(w), w))
        chosen.append(best)
        open_ = {k: {shingle for shingle in s if best not in shingle} for k, s in open_.items()}
    return chosen


def class_size(shingles: int) -> int:
    size = 2
    while shingles * 2 > size:
        size *= 2
    return size


def shingle_count(text: str) -> int:
    w = plain_words(text)
    return len({tuple(w[i : i + SHINGLE]) for i in range(len(w) - SHINGLE + 1)})


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))


def shingle_hashes(words_: str, size: int = SHINGLE) -> Column:
    """Of each five words in a row; empty for fewer."""
    last = F.size(words_) - size
    five = lambda i: F.xxhash64(*(F.element_at(words_, (i + k).cast("int")) for k in range(size)))
    each = F.transform(F.sequence(F.lit(1), last + 1), five)
    return F.when(last >= 0, each).otherwise(F.array().cast("array<long>"))


def bands(shingles: str, n: int = BANDS) -> Column:
    """The smallest value of the set under each of ``n`` seeded hashes."""

    def least(i: int) -> Column:
        return F.array_min(F.transform(shingles, lambda h: F.xxhash64(h, F.lit(i))))

    return F.array(*[least(i) for i in range(n)])


def template_table(spark: SparkSession, templates: list[Template], n: int = BANDS) -> DataFrame:
    """``(license, shingles, length, needs, size, band, value)``: few rows, by the number of templates."""
    rows = [
        (t.license, t.notice, len(plain_words(t.notice)), list(t.needs), class_size(shingle_count(t.notice)))
        for t in sorted(templates)
    ]
    rows = spark.createDataFrame(rows, "license string, notice string, length int, needs array<string>, size int")
    rows = rows.withColumn("words", words(F.col("notice"))).withColumn("shingles", F.array_distinct(shingle_hashes("words")))
    return rows.select("license", "shingles", "length", "needs", "size", F.posexplode(bands("shingles", n)).alias("band", "value"))


def passages(
    docs: DataFrame, templates: list[Template] | None = None, containment: float = CONTAINMENT, n_bands: int = BANDS
) -> DataFrame:
    """``doc_id, license, containment, first_word, last_word``: every passage that a template and its phrases allow."""
    templates = TEMPLATES if templates is None else templates
    if short := [t.notice for t in templates if len(plain_words(t.notice)) < SHINGLE]:
        raise ValueError(f"templates need {SHINGLE} words: {short}")
    keys = key_words([t.notice for t in templates], containment)
    table = template_table(docs.sparkSession, templates, n_bands)
    classes = sorted({class_size(shingle_count(t.notice)) for t in templates})
    longest = max((len(plain_words(t.notice)) for t in templates), default=0)

    stems = [k for k in keys if not any(k != other and other in k for other in keys)]
    near = docs.where(reduce(or_, (F.contains(F.lower("text"), F.lit(k)) for k in stems), F.lit(False)))
    near = near.select("doc_id", words(F.col("text")).alias("words"))
    hits = F.filter(F.transform("words", lambda w, i: F.when(w.isin(keys), i)), lambda i: i.isNotNull())
    near = near.withColumn("hits", hits).withColumn("hashes", shingle_hashes("words"))

    def windows(size: int) -> Column:
        """Starts of the class's windows with a shingle that has a key word."""
        step = size // 2

        def around(hit: Column) -> Column:
            first = F.greatest(F.lit(0), F.floor((hit - (SHINGLE - 1) - size) / step) + 1)
            return F.sequence(first.cast("int"), F.floor(hit / step).cast("int"))

        def own(j: Column) -> Column:
            slice_ = F.slice("hashes", (j * step + 1).cast("int"), size)
            before = F.least(j * step, F.lit(longest))
            around_ = F.slice("words", (j * step - before + 1).cast("int"), before.cast("int") + size + SHINGLE + longest)
            return F.struct(
                (j * step).alias("start"), F.lit(size).alias("size"), slice_.alias("own"), around_.alias("around"), before.alias("before")
            )

        numbers = F.filter(F.array_distinct(F.flatten(F.transform("hits", around))), lambda j: j * step < F.size("hashes"))
        return F.transform(numbers, own)

    # slices are cut before rows are made of them: a row must not carry its whole text
    every = F.concat(*[windows(size) for size in classes]) if classes else F.lit(None)
    window = near.select("doc_id", F.explode(every).alias("w")).select("doc_id", "w.*")
    signed = window.select("*", F.posexplode(bands("own", n_bands)).alias("band", "value"))
    found = signed.join(F.broadcast(table), ["size", "band", "value"])  # as many rows as templates times bands
    share = F.size(F.array_intersect(F.array_distinct("own"), "shingles")) / F.size("shingles")
    found = found.withColumn("containment", share).where(F.col("containment") >= containment)
    at = F.filter(
        F.transform("own", lambda h, i: F.when(F.array_contains("shingles", h), i)), lambda i: i.isNotNull()
    )
    found = found.withColumn("first", F.array_min(at)).withColumn("last", F.array_max(at) + SHINGLE - 1)
    # the passage with as many words more as the template may have outside the shingles found
    more = F.greatest(F.lit(0), F.col("length") - (F.col("last") - F.col("first") + 1))
    begin = F.greatest(F.lit(0), F.col("before") + F.col("first") - more)
    passage = F.slice("around", (begin + 1).cast("int"), (F.col("before") + F.col("last") + more + 1 - begin).cast("int"))
    text = F.concat(F.lit(" "), F.array_join(passage, " "), F.lit(" "))
    told = F.forall("needs", lambda n: F.contains(text, F.concat(F.lit(" "), n, F.lit(" "))))
    found = found.where(told)
    return found.select(
        "doc_id",
        "license",
        "containment",
        (F.col("start") + F.col("first")).cast("long").alias("first_word"),
        (F.col("start") + F.col("last")).cast("long").alias("last_word"),
    ).distinct()


def identifiers(docs: DataFrame) -> DataFrame:
    """The same columns for the short identifiers in the texts, each at its first place."""
    low = F.lower("text")
    near = docs.where(reduce(or_, (F.contains(low, F.lit(h)) for h in HINTS))).select("doc_id", low.alias("low"))

    def named(code: Column) -> Column:
        spelled = F.create_map(*[F.lit(x) for pair in SPELLED.items() for x in pair])
        return F.coalesce(spelled[code], F.replace(F.replace(F.upper(code), F.lit("-OR-LATER"), F.lit("-or-later")), F.lit("-ONLY"), F.lit("-only")))

    def all_of(pattern: str, code) -> Column:
        found = F.array_distinct(F.regexp_extract_all("low", F.lit(pattern), F.lit(1)))
        return F.transform(found, lambda m: F.struct(m.alias("match"), named(code(m)).alias("license")))

    every = F.concat(
        all_of(SPDX, lambda m: m),
        all_of(CC_BY, lambda m: F.regexp_replace(m, " ", "-")),
        all_of(CC_ZERO, lambda m: F.lit("cc0-1.0")),
    )
    found = near.select("doc_id", "low", F.explode(every).alias("m"))
    before = F.size(words(F.substring("low", F.lit(1), F.instr("low", F.col("m.match")) - 1)))
    return found.select(
        "doc_id",
        "m.license",
        F.lit(1.0).alias("containment"),
        before.cast("long").alias("first_word"),
        (before + F.size(words(F.col("m.match"))) - 1).cast("long").alias("last_word"),
    )


def scan(
    docs: DataFrame, templates: list[Template] | None = None, containment: float = CONTAINMENT, n_bands: int = BANDS
) -> DataFrame:
    """``doc_id, license, containment, first_word``: the best passage of each license that a document holds."""
    found = passages(docs, templates, containment, n_bands).unionByName(identifiers(docs))
    # longest first among those that begin together: what ends before an earlier one's end lies inside it
    order = ["first_word", F.desc("last_word"), F.desc("containment"), "license"]
    earlier = Window.partitionBy("doc_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    reach = F.max("last_word").over(earlier)
    found = found.withColumn("reach", reach).where(F.col("reach").isNull() | (F.col("reach") < F.col("last_word")))
    best = F.max(F.struct("containment", (-F.col("first_word")).alias("before"))).alias("best")
    out = found.groupBy("doc_id", "license").agg(best)
    return out.select("doc_id", "license", "best.containment", (-F.col("best.before")).cast("long").alias("first_word"))
