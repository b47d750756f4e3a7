"""Licence scan: a positional index of the templates' rarest words, met by each file's own, and exact key phrases."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, let, lower_ascii

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words that may be added or missing between two key phrases of a template.
SLACK = 40
#: More than a text can have words.
PLACES = 1 << 31

# Phrases that by themselves give a label.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


@dataclass(frozen=True)
class Template:
    """A notice: its label, its words, and the phrases of it that a file must hold."""

    label: str
    text: str
    mandatory: tuple[str, ...]


# Words of public licence notices, and what can't be missing of them.
TEMPLATES = (
    Template("agpl-3", "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the "
             "free software foundation either version 3 of the license", ("terms of the gnu affero general public license", "version 3 of the license")),
    Template("all-rights-reserved", "all rights reserved", ("all rights reserved",)),
    Template("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
             ("licensed under the apache license version 2 0", "in compliance with the license")),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following "
             "conditions are met", ("redistribution and use in source and binary forms", "provided that the following conditions are met")),
    Template("cc-by", "licensed under a creative commons attribution 4 0 international license", ("creative commons attribution 4 0 international",)),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("licensed under cc by nc",)),
    Template("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license", ("creative commons attribution noncommercial",)),
    Template("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license", ("creative commons attribution sharealike",)),
    Template("cc0", "has waived all copyright and related or neighboring rights to this work", ("waived all copyright and related or neighboring rights",)),
    Template("gpl-2", "it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license",
             ("terms of the gnu general public license", "version 2 of the license")),
    Template("gpl-2", "licensed under the gnu general public license version 2", ("gnu general public license version 2",)),
    Template("gpl-3", "it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license",
             ("terms of the gnu general public license", "version 3 of the license")),
    Template("gpl-3", "licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
             ("permission to use copy modify and or distribute this software", "with or without fee is hereby granted")),
    Template("lgpl", "under the terms of the gnu lesser general public license", ("gnu lesser general public license",)),
    Template("mit", "released under the mit license", ("released under the mit license",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
             "the software to deal in the software without restriction",
             ("permission is hereby granted free of charge", "to deal in the software without restriction")),
    Template("mpl-2", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license v 2 0",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain",
             ("free and unencumbered software released into the public domain",)),
)


@dataclass(frozen=True)
class Phrase:
    """``words`` stand at word ``at`` of template number ``template`` (a base phrase is a template by itself)."""

    template: int
    at: int
    words: tuple[str, ...]


@dataclass(frozen=True)
class Rules:
    labels: tuple[str, ...]
    base: tuple[bool, ...]
    phrases: tuple[Phrase, ...]


def rules_of(base: dict[str, str], templates: tuple[Template, ...]) -> Rules:
    labels, kinds, phrases = [], [], []
    for text, label in base.items():
        phrases.append(Phrase(len(labels), 0, tuple(text.split())))
        labels.append(label)
        kinds.append(True)
    for t in templates:
        words = t.text.split()
        for text in t.mandatory:
            part = text.split()
            at = next((i for i in range(len(words) - len(part) + 1) if words[i:i + len(part)] == part), None)
            if at is None or not part:
                raise ValueError(f"{text!r} isn't part of the template {t.label}")
            phrases.append(Phrase(len(labels), at, tuple(part)))
        labels.append(t.label)
        kinds.append(False)
    return Rules(tuple(labels), tuple(kinds), tuple(phrases))


def file_words(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def word_counts(docs: DataFrame, vocabulary: list[str], text_col: str) -> dict[str, int]:
    """Documents that hold each word of the rules: at most one row a word comes back."""
    held = F.array_distinct(F.filter(file_words(F.col(text_col)), lambda w: w.isin(vocabulary)))
    rows = docs.select(F.explode(held).alias("word")).groupBy("word").agg(F.count("*").alias("n")).collect()
    return {r["word"]: r["n"] for r in rows}


def _index(rules: Rules, counts: dict[str, int], nth: int) -> dict[str, list[tuple[int, int]]]:
    """Word -> (phrase, place in it), for the ``nth`` rarest word of each phrase (its only one where it has no more)."""
    index: dict[str, list[tuple[int, int]]] = {}
    for number, phrase in enumerate(rules.phrases):
        rare = sorted(dict.fromkeys(phrase.words), key=lambda w: (counts.get(w, 0), w))
        word = rare[min(nth, len(rare) - 1)]
        index.setdefault(word, []).append((number, phrase.words.index(word)))
    return index


def _literal(index: dict[str, list[tuple[int, int]]]) -> Column:
    """The postings as a constant map, as many entries as there are phrases."""
    pairs = []
    for word, entries in index.items():
        pairs += [F.lit(word), F.array(*[F.struct(F.lit(p).alias("phrase"), F.lit(at).alias("at")) for p, at in entries])]
    return F.create_map(*pairs)


def _starts(hits: Column, index: dict[str, list[tuple[int, int]]]) -> Column:
    """Where phrases would start by the words of one index, as one number for (phrase, start): sets of numbers are hashed."""
    postings = _literal(index)
    own = F.filter(hits, lambda h: h["word"].isin(list(index)))
    starts = F.flatten(F.transform(own, lambda h: F.transform(
        F.try_element_at(postings, h["word"]), lambda e: F.when(h["pos"] >= e["at"], e["phrase"] * F.lit(PLACES) + h["pos"] - e["at"]))))
    return F.array_compact(starts)


def _places(words: Column, rules: Rules, counts: dict[str, int]) -> Column:
    """Every place of every phrase as ``array<struct<phrase, start>>``."""
    first, second = (_index(rules, counts, n) for n in (0, 1))
    looked_up = sorted({*first, *second})
    hits = F.filter(F.transform(words, lambda w, i: F.struct(w.alias("word"), i.alias("pos"))), lambda h: h["word"].isin(looked_up))
    phrases = F.array(*[F.array(*[F.lit(w) for w in p.words]) for p in rules.phrases])

    def exact(x: Column) -> Column:
        return let(F.get(phrases, x["phrase"]), lambda phrase: F.slice(words, x["start"] + 1, F.size(phrase)) == phrase)

    def verified(met: Column) -> Column:
        places = F.transform(met, lambda m: F.struct(
            F.floor(m / PLACES).cast("int").alias("phrase"), F.pmod(m, F.lit(PLACES)).cast("int").alias("start")))
        return F.filter(places, exact)

    return let(hits, lambda hs: verified(F.array_intersect(_starts(hs, first), _starts(hs, second))))


def _cells(places: Column, phrase: int, at: int, slack: int) -> Column:
    """Cells of ``slack`` words in which the template would start by one phrase."""
    own = F.filter(places, lambda p: p["phrase"] == phrase)
    return F.array_distinct(F.transform(own, lambda p: F.floor((p["start"] - at) / slack).cast("int")))


def _complete(places: Column, rules: Rules, template: int, slack: int) -> Column:
    """Do all key phrases of a template stand in their relative positions?"""
    cells = [_cells(places, n, p.at, slack) for n, p in enumerate(rules.phrases) if p.template == template]
    common = cells[0]
    for other in cells[1:]:
        near = F.flatten(F.transform(other, lambda c: F.array(c - 1, c, c + 1)))
        common = F.array_intersect(common, near)
    return F.size(common) > 0


def _share(places: Column, rules: Rules, template: int) -> Column:
    """Share of a template's key words that stand in phrases found anywhere."""
    own = [(n, len(p.words)) for n, p in enumerate(rules.phrases) if p.template == template]
    whole = sum(size for _, size in own)
    numbers = F.transform(places, lambda p: p["phrase"])
    found = [F.when(F.array_contains(numbers, n), F.lit(size)).otherwise(F.lit(0)) for n, size in own]
    total = found[0]
    for f in found[1:]:
        total = total + f
    return total / F.lit(float(whole))


def scan_licenses(docs: DataFrame, base: dict[str, str] = BASE, templates: tuple[Template, ...] = TEMPLATES, slack: int = SLACK,
                  text_col: str = "text") -> DataFrame:
    """``docs`` with a column ``licenses`` (under a free name where that is taken): a struct of

    ``n_words``; ``n_base``, the places of base phrases; ``first_word`` and ``last_word``, their smallest and largest
    start (NULL without any); ``base_labels`` and ``labels``, sorted arrays of the base phrases' labels and of all;
    ``score``, the largest share of a template's key words that stand in whole key phrases (1 with any label, 0 with
    no phrase at all); ``places``, every phrase found with its start.

    Each phrase is indexed by its two rarest words, after their document counts over all of ``docs``. A file looks its
    own words up in both indexes, so every file meets the phrases whose rarest words it holds and no others; starts
    on which both words agree are left, and these are compared word for word. That loses nothing, as a phrase can't
    stand where its rarest words don't. A template's label needs all its key phrases, their starts as far apart as in the
    template, give or take about ``slack`` words (starts lie in the same or a neighbouring cell of ``slack`` words).

    Everything but the counts happens in the row; nothing is shuffled. A NULL text is empty: no words, no
    labels, score 0. A text of any length is read whole. Equal rows get equal results, an empty table gives an empty table,
    other columns stay as they are. The rules are parameters and travel with the plan.
    """
    rules = rules_of(base, templates)
    vocabulary = sorted({w for p in rules.phrases for w in p.words})
    counts = word_counts(docs, vocabulary, text_col)
    bases = [n for n, p in enumerate(rules.phrases) if rules.base[p.template]]

    def complete(places: Column) -> Column:
        marks = [F.when(_complete(places, rules, n, slack), F.struct(F.lit(label).alias("label"), F.lit(kind).alias("base")))
                 for n, (label, kind) in enumerate(zip(rules.labels, rules.base, strict=True))]
        return F.array_compact(F.array(*marks))

    def names(marks: Column) -> Column:
        return F.array_sort(F.array_distinct(F.transform(marks, lambda m: m["label"])))

    def found(words: Column, places: Column, marks: Column) -> Column:
        own = F.transform(F.filter(places, lambda p: p["phrase"].isin(bases)), lambda p: p["start"])
        score = F.greatest(*[_share(places, rules, n) for n in range(len(rules.labels))], F.lit(0.0))
        return F.struct(
            F.size(words).cast("long").alias("n_words"), F.size(own).cast("long").alias("n_base"),
            F.array_min(own).cast("long").alias("first_word"), F.array_max(own).cast("long").alias("last_word"),
            names(F.filter(marks, lambda m: m["base"])).alias("base_labels"), names(marks).alias("labels"),
            F.when(F.size(places) > 0, score).otherwise(0.0).alias("score"), places.alias("places"))

    nothing = F.array().cast("array<struct<label:string,base:boolean>>")

    def read(words: Column, places: Column) -> Column:
        return let(F.when(F.size(places) > 0, complete(places)).otherwise(nothing), lambda marks: found(words, places, marks))

    out = let(file_words(F.col(text_col)), lambda ws: let(_places(ws, rules, counts), lambda ps: read(ws, ps)))
    return docs.withColumn(free_name(docs, "licenses"), out)
