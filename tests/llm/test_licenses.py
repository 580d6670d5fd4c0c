import re

import pytest

from quernstone.llm import licenses, queries
from quernstone.llm.common import table
from quernstone.llm.license_rules import BASE, RULES


def words_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split("[\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered) if w]


def brute(text):
    """All rules without gates; suppression by comparing every pair."""
    words = words_of(text)
    joined = " ".join(words).encode()
    places = [(i, label) for p, label in BASE.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    found = set()
    for r in RULES:
        for m in r.pattern.finditer(joined):
            if not r.base:
                first = joined[: m.start()].count(b" ")
                found.add((r.label, r.priority, first, first + m.group().count(b" ")))
    stay = [d for d in found if not any(e != d and e[2] <= d[2] and e[3] >= d[3] and (e[1] > d[1] or e[1] == d[1] and (e[3] - e[2] > d[3] - d[2] or e[2:] == d[2:] and e[0] < d[0])) for e in found)]
    labels = sorted({d[0] for d in stay} | {x for _, x in places})
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places})), ",".join(labels)


TEXTS = [None, "", "!!", "CC-BY", "cc by cc by 4.0 CC BY-NC-SA 4.0", "All\nRights reserved, all rights: reserved. Some rights reserved", "GNU General Public License v2.0 or the general public license", "Licensed under the Apache License, Version 2.0. http://www.apache.org/licenses/LICENSE-2.0", "SPDX-License-Identifier: GPL-3.0-or-later", "Tous droits réservés — domaine public", "Permission is hereby granted, free of charge, to any person obtaining a copy of this " + "software x " * 40 + 'THE SOFTWARE IS PROVIDED "AS IS"', "word " * 40_000 + "MIT license", "rccby cc byte reserved all rights", "Copyright (c) 2019 Foo. Unauthorized copying of this is strictly prohibited."]


@pytest.mark.parametrize("text", TEXTS)
def test_against_brute_force(text):
    n, found = licenses.detections(None if text is None else text.encode())
    kept = licenses.resolve(found)
    base = [d for d in kept if d.base]
    got = n, len(base), min((d.first for d in base), default=None), max((d.first for d in base), default=None), ",".join(sorted({d.label for d in base})), ",".join(sorted({d.label for d in kept}))
    assert got == brute(text)


def test_gates_never_hide_a_detection():
    assert len(RULES) > 250
    sample = " ".join(re.sub(r"\(\?:([^|()]*)[^()]*\)\??", r"\1", r.pattern.pattern.decode().removeprefix("(?<![^ ])(?:").removesuffix(")(?![^ ])")).split("|")[0].replace("?", "") for r in RULES)
    assert sum(1 for r in RULES if r.pattern.search(" ".join(words_of(sample)).encode())) > 150
    for r in RULES:
        for m in r.pattern.finditer(" ".join(words_of(sample)).encode()):
            assert r.gate in m.group().split(), r


def test_query(spark, sf_dir):
    rows = {r.doc_id: r for r in queries.op4_licenses(spark, sf_dir).collect()}
    texts = {r.doc_id: r.text for r in table(spark, sf_dir, "documents").collect()}
    assert rows.keys() == texts.keys() and any(r.n_base for r in rows.values())
    for d, t in texts.items():
        r = rows[d]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels) == brute(t)
        assert 0 <= r.score <= 1 and (r.score > 0) == (r.labels != "")


def test_scan_keeps_rows_and_replaces_columns(spark):
    df = spark.createDataFrame([(1, TEXTS[6], 9), (1, TEXTS[6], 9), (None, None, 8)], "doc_id long, text string, score int")
    rows = licenses.scan(df).collect()
    assert len(rows) == 3 and rows[0] == rows[1] and rows[0].n_base == 2 and rows[2].n_words == 0
    assert [(d.label, d.first, d.last) for d in rows[0].detections][0] == ("gpl-2.0", 0, 5)
    assert licenses.scan(df.limit(0)).collect() == []
