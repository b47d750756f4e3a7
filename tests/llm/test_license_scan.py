"""The licence scan against a word-by-word search in plain Python."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tarifold.llm import license_scan as L

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(text, base, templates, slack):
    words = WORD.findall((text or "").translate(LOWER))
    rules = L.rules_of(base, templates)
    places = {(n, s) for n, p in enumerate(rules.phrases) for s in range(len(words)) if tuple(words[s:s + len(p.words)]) == p.words}
    labels, base_labels, score = set(), set(), 0.0
    for t, label in enumerate(rules.labels):
        own = [(n, p) for n, p in enumerate(rules.phrases) if p.template == t]
        cells = [{(s - p.at) // slack for m, s in places if m == n} for n, p in own]
        if any(all(any(abs(c - d) <= 1 for d in other) for other in cells) for c in cells[0]):
            labels.add(label)
            if rules.base[t]:
                base_labels.add(label)
        score = max(score, sum(len(p.words) for (n, p), c in zip(own, cells) if c) / sum(len(p.words) for _, p in own))
    starts = [s for n, s in places if rules.base[rules.phrases[n].template]]
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None), sorted(base_labels), sorted(labels), score, sorted(places))


def scanned(df, **more):
    rows = L.scan_licenses(df, **more).collect()
    out = []
    for r in rows:
        x = r["licenses"]
        out.append((r["n"], (*[x[c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")],
                             sorted(tuple(p) for p in x["places"]))))
    return sorted(out)


def check(spark, texts, base=L.BASE, templates=L.TEMPLATES, slack=L.SLACK):
    df = spark.createDataFrame(list(enumerate(texts)), "n long, text string")
    want = [(n, expected(t, base, templates, slack)) for n, t in enumerate(texts)]
    assert scanned(df, base=base, templates=templates, slack=slack) == want
    return want


def test_notices(spark):
    far = " word" * 200
    texts = [
        "Licensed under the Apache License, Version 2.0 (the \"License\")", "under the MIT license. under the  mit-License!", "Licensed under CC BY-NC 4.0.",
        "This work is licensed under the GNU General Public License, version 3.", "ALL RIGHTS RESERVED", "under themit license", "Under the MİT license",
        "Permission is hereby granted, free of charge, to any person to deal in the Software without restriction",
        f"Permission is hereby granted, free of charge, {far} to deal in the Software without restriction",
        "to deal in the software without restriction. Permission is hereby granted free of charge",
        "license 2 version apache", "mit license the under the mit license under", *[t.text for t in L.TEMPLATES],
    ]
    want = check(spark, texts)
    assert want[0][1][4:7] == (["apache-2"], ["apache-2"], 1.0) and want[1][1][1:4] == (2, 0, 4)
    assert want[3][1][5] == ["gpl-3"] and want[4][1][5] == ["all-rights-reserved"]
    assert want[7][1][5] == ["mit"] and not want[8][1][5] and want[8][1][6] == 1.0
    assert all(t.label in x[5] for t, (_, x) in zip(L.TEMPLATES, want[12:]))


def test_awkward_rows(spark):
    texts = [None, "", " \n\t", "mit", "under the mit license", "under the mit license", "é under the mit license É", "under the mit license " * 60_000 + "end"]
    df = spark.createDataFrame(list(enumerate(texts)), "n long, text string").withColumns({c: F.lit(1) for c in ("licenses", "n_words", "labels", "word", "score")})
    out = L.scan_licenses(df)
    assert out.columns[:-1] == df.columns and out.columns[-1] != "licenses"
    rows = {r["n"]: r[out.columns[-1]] for r in out.collect()}
    for n, text in enumerate(texts[:-1]):
        assert (rows[n]["n_words"], rows[n]["labels"], rows[n]["score"]) == tuple(expected(text, L.BASE, L.TEMPLATES, L.SLACK)[i] for i in (0, 5, 6))
    assert rows[7]["n_base"] == 60_000 and rows[7]["last_word"] == 4 * 59_999
    assert L.scan_licenses(df.where("false")).count() == 0


def test_any_rules(spark):
    rng = random.Random(4)
    base = {"a b a": "x", "c": "y", "b b": "x"}
    templates = (L.Template("t", "a b c d e f", ("a b", "e f")), L.Template("y", "d d d", ("d d",)), L.Template("u", "f e d c b a", ("f e", "d c", "b a")))
    texts = [" ".join(rng.choices("abcdefg", k=rng.randint(0, 60))) for _ in range(150)]
    check(spark, texts, base, templates, 5)
    with pytest.raises(ValueError):
        L.rules_of({}, (L.Template("t", "a b", ("b a",)),))
