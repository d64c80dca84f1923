import random
import re

import pytest
from pyspark.sql import functions as F

from ebbline.llm import licenses
from ebbline.llm.queries import QUERIES

from .conftest import SF


def _shingles(words):
    return [tuple(words[i : i + 5]) for i in range(len(words) - 4)]


IDENTIFIERS = [(licenses.SPDX, None), (licenses.CC_BY, None), (licenses.CC_ZERO, "CC0-1.0")]


def brute_force(rows, templates=licenses.TEMPLATES, containment=0.8):
    """All windows of all templates, their passages, and what longer passages leave of them."""
    out = set()
    for doc_id, text in rows:
        words = licenses.plain_words(text or "")
        every, found = _shingles(words), set()
        for name, notice, needs in templates:
            own_words = licenses.plain_words(notice)
            wanted = set(_shingles(own_words))
            size = licenses.class_size(len(wanted))
            for start in range(0, len(every), size // 2):
                own = every[start : start + size]
                share = len(wanted & set(own)) / len(wanted)
                if share < containment:
                    continue
                at = [start + i for i, s in enumerate(own) if s in wanted]
                first, last = at[0], at[-1] + 4
                more = max(0, len(own_words) - (last - first + 1))
                passage = " ".join(["", *words[max(0, first - more) : last + more + 1], ""])
                if all(f" {n} " in passage for n in needs):
                    found.add((first, last, name, share))
        low = (text or "").lower()
        for pattern, fixed in IDENTIFIERS:
            for match in set(re.findall(pattern, low)):
                first = len(licenses.plain_words(low[: low.index(match)]))
                name = fixed or licenses.SPELLED.get(match.replace(" ", "-"), match.replace(" ", "-").upper())
                found.add((first, first + len(licenses.plain_words(match)) - 1, name, 1.0))
        reach, best = -1, {}
        for first, last, name, share in sorted(found, key=lambda f: (f[0], -f[1], -f[3], f[2])):
            if last > reach:
                best[name] = max(best.get(name, (0, 0)), (share, -first))
            reach = max(reach, last)
        out |= {(doc_id, name, round(share, 9), -first) for name, (share, first) in best.items()}
    return out


def _got(df):
    return {(r.doc_id, r.license, round(r.containment, 9), r.first_word) for r in df.collect()}


def test_query(spark, texts):
    df = QUERIES["op5_licenses"](spark, SF)
    assert _got(df) == brute_force(texts.items()) != set()
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(3)
    filler = "the a of under license software work free copy public and version terms permission word other".split()
    rows = []
    for i in range(150):
        notice = licenses.plain_words(rng.choice(licenses.TEMPLATES).notice)
        if rng.random() < 0.5:
            notice[rng.randrange(len(notice))] = "xx"
        before, after = ([rng.choice(filler) for _ in range(rng.randrange(120))] for _ in "ab")
        rows.append((i, " ".join(before) + " " + ", ".join(notice).upper() + "\n" + " ".join(after)))
    return rows


def test_planted_passages(documents, planted):
    found = brute_force(planted)
    assert len(found) > 60 and _got(licenses.scan(documents(planted))) == found


def test_odd_rows(documents):
    mit = "Released under the MIT License"
    rows = [(0, None), (1, ""), (2, "mit license"), (3, mit), (4, (mit + ". ") * 5000), (5, "w " * 40000 + mit), (6, mit), (6, mit), (None, mit), (7, "é " + mit + " ñ")]
    rows += [(8, "spdx-license-identifier: mit CC BY 4.0, cc0 x cc-by-nc-4.0 CC BY-ND 9.9 cc by 4.0")]
    docs = documents(rows).withColumns({c: F.lit("clash") for c in ("words", "hits", "hashes", "license", "start", "size", "low", "m")})
    assert _got(licenses.scan(docs)) == brute_force(rows)
    assert licenses.scan(documents([])).count() == 0


NAMED = {
    "This work is licensed under the GNU General Public License, version 2": {"GPL-2.0"},
    "This work is licensed under the GNU General Public License, version 3": {"GPL-3.0"},
    "This work is licensed under the GNU General Public License": {"GPL"},
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
    "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
    "any later version.": {"AGPL-3.0"},
    "This library is licensed under the GNU Lesser General Public License, version 2.1 by its authors": {"LGPL-2.1"},
    "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License": {"CC-BY-NC-4.0"},
    "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License": {"CC-BY-SA-3.0"},
    "This work is licensed under a Creative Commons Attribution 4.0 International License": {"CC-BY-4.0"},
    "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives": {"CC-BY-NC-ND"},
    "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0": {"EPL-2.0"},
    "This is free and unencumbered software released into the public domain.": {"Unlicense"},
    "photo: CC BY 4.0": {"CC-BY-4.0"},
    "photo: CC BY-NC-ND 4.0": {"CC-BY-NC-ND-4.0"},
    "Licensed under CC BY-NC 4.0": {"CC-BY-NC-4.0"},
    "// SPDX-License-Identifier: Apache-2.0": {"Apache-2.0"},
    "// SPDX-License-Identifier: GPL-2.0-or-later": {"GPL-2.0-or-later"},
    "Released under the MIT License": {"MIT"},
    "Licensed under the Apache License, Version 2.0": {"Apache-2.0"},
    "Licensed under the Apache License, Version 1.1": set(),
    "Released under the BSD License": set(),
}


def test_versions_and_variants_are_told_apart(documents):
    texts = list(NAMED)
    rows = [(i, f"some words before it. {t}\nand some after it") for i, t in enumerate(texts)]
    found = {}
    for r in licenses.scan(documents(rows)).collect():
        found.setdefault(texts[r.doc_id], set()).add(r.license)
    assert {t: found.get(t, set()) for t in texts} == NAMED


def test_short_templates_are_an_error(documents):
    with pytest.raises(ValueError, match="five|5 words"):
        licenses.scan(documents([]), [licenses.Template("X", "too short")])


def test_own_templates(documents):
    own = [licenses.Template("House", "All texts of this house may be read aloud", ("house",))]
    rows = [(1, "all texts of this house may be read aloud!"), (2, "all texts of this town may be read aloud"), (3, "CC BY 4.0")]
    assert _got(licenses.scan(documents(rows), own)) == brute_force(rows, own) == {(1, "House", 1.0, 0), (3, "CC-BY-4.0", 1.0, 1 - 1)}


def test_no_window_without_key_words_can_match():
    notices = [t.notice for t in licenses.TEMPLATES]
    keys = set(licenses.key_words(notices, 0.8))
    for notice in notices:
        every = set(_shingles(licenses.plain_words(notice)))
        assert sum(not keys & set(s) for s in every) < 0.8 * len(every)


def test_bands_collide_as_promised():
    for n in range(1, 200):
        size = licenses.class_size(n)
        assert size / 4 < n <= size / 2 or n == 1
    least = 0.8 * (1 / 4) / (1 + 0.2 * (1 / 4))
    assert 1 - (1 - least) ** licenses.BANDS > 0.9999
