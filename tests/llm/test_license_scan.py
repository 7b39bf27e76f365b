import random
import re

from riskmart.llm import license_scan as L


def brute(text):
    """All matches of all rules, suppression by comparing every two of them."""
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)
    normal = "".join(f" {w} " for w in words)
    found = []
    for r in L.RULES:
        if r.keyword in words:
            for m in re.finditer(r.pattern, normal):
                first = normal.count(" ", 0, m.start()) // 2
                found.append((first, first + normal.count(" ", m.start(), m.end()) // 2 - 1, r))
    def over(o, s):
        if not (o[0] <= s[0] and o[1] >= s[1]) or o is s:
            return False
        return (o[2].priority, o[1] - o[0], -o[2].at) > (s[2].priority, s[1] - s[0], -s[2].at)

    kept = [s for s in found if s[2].priority == L.BASE or not any(over(o, s) for o in found)]
    base = [s for s in kept if s[2].priority == L.BASE]
    starts = [s[0] for s in base] or [None]
    names = lambda spans: ",".join(sorted({s[2].label for s in spans}))
    spans = sorted((s[0], s[1], s[2].at) for s in kept)
    return (len(words), len(base), min(starts), max(starts), names(base), names(kept), max([s[2].weight for s in kept], default=0.0), len(kept)), spans


def texts():
    draw = random.Random(13)
    parts = [
        "Licensed under the MIT License", "apache license, version 2.0", "CC BY-NC 4.0", "cc by nc sa 4 0", "under the terms of the GNU General Public License v3 or any later version",
        "SPDX-License-Identifier: GPL-2.0-or-later", "gnu lesser general public licence 2.1", "http://creativecommons.org/licenses/by-nc-nd/4.0/", "All rights reserved",
        "mit der", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "public domain", "in the public domain",
        "distributed under the apache license", "the", "é", "license", "under", "bsd 3-clause license", "boost software license version 1.0", "ruby license", "sharealike",
        "Creative Commons Attribution-NonCommercial-ShareAlike 3.0 Unported License", "\n\n", "x\x00y", "MIT", "version 2",
    ]
    fixed = [None, "", " .,\n", "under the mit license " * 40, "under the mit license under the mit", "CC BY-NC", "cc-by-nc-cc-by-nc", "ÀPACHE LICENSE VERSION 2", "mit license"]
    return fixed + [" ".join(draw.choices(parts, k=draw.randrange(1, 25))) for _ in range(60)]


def test_equals_brute_force(spark):
    data = list(enumerate(texts()))
    df = spark.createDataFrame([(i, t, "x", 7) for i, t in data + data[:4]] + [(None, "mit license", "y", 1)], "doc_id long, text string, labels string, n_words int")
    got = L.scan(df).collect()
    assert len(got) == len(data) + 5
    for r in got:
        want = brute("mit license" if r.doc_id is None else dict(data)[r.doc_id])[0]
        assert tuple(r)[1:] == want, dict(data).get(r.doc_id)
    for r in L.detections(df.where("doc_id is not null")).collect():
        assert sorted((s["first"], s["last"], s["at"]) for s in r.spans) == brute(dict(data)[r.doc_id])[1]


def test_rules_are_many_and_each_finds_itself():
    assert len(L.RULES) > 300 and len({r.at for r in L.RULES}) == len(L.RULES)
    for r in L.RULES:
        assert r.keyword in re.findall("[a-z0-9]+", r.pattern) and "'" not in r.pattern and "\\" not in r.pattern
    assert brute("This work is licensed under the GNU General Public License, version 3.")[0][5] == "gpl-3"
    assert brute("released under the MIT License")[0][4:6] == ("mit", "mit")
    assert brute("licenced under the mit licence")[0][4:6] == ("", "mit")
    assert brute("spricht mit der license")[0][5] == ""


def test_long_text_and_empty_table(spark):
    df = spark.createDataFrame([(1, "Under the MIT License. " * 3000 + "plain words only " * 20_000)], "doc_id long, text string")
    r = L.scan(df).first()
    assert (r.n_words, r.n_base, r.first_word, r.last_word, r.labels) == (72_000, 3000, 0, 11_996, "mit")
    assert L.scan(df.where("false")).count() == 0


def test_plan_is_native(spark):
    plan = L.scan(spark.createDataFrame([(1, "a")], "doc_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
