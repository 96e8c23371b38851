"""License scan over a positional index of rare template words, in built-in functions only.

The index lists, for the rarest words of each template's mandatory phrase, their postings: template,
relative position, and rank by inverse document frequency. A file looks up only the
highest-IDF words that it needs: those of templates all of whose mandatory words it holds. A word at ``i``
with a posting at ``k`` speaks for a template that starts at ``i - k``; the starts that its words
speak for are intersected, rank by rank. What is left is verified word by word: the mandatory
phrase without a gap, and enough of the template's weight.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rootwise.llm.common import words

# The base phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Sentences of well-known licenses: label, sentence, mandatory phrase.
SENTENCES = [
    ("gpl-3", "this work is licensed under the gnu general public license version 3",
     "gnu general public license version 3"),
    ("gpl-text", "this program is free software you can redistribute it and or modify it under the terms of "
     "the gnu general public license", "gnu general public license"),
    ("lgpl", "under the terms of the gnu lesser general public license", "gnu lesser general public license"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("mit-notice", "released under the mit license", "mit license"),
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software",
     "permission is hereby granted free of charge"),
    ("bsd-text", "redistribution and use in source and binary forms with or without modification are permitted",
     "redistribution and use in source and binary forms"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0",
     "mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     "unencumbered software"),
    ("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
     "associated documentation files the software to deal in the software without restriction including without "
     "limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the "
     "software and to permit persons to whom the software is furnished to do so subject to the following conditions",
     "to deal in the software without restriction"),
    ("isc-text", "permission to use copy modify and or distribute this software for any purpose with or without fee "
     "is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
     "with or without fee is hereby granted"),
    ("apache-notice", "licensed under the apache license version 2 0 the license you may not use this file except in "
     "compliance with the license you may obtain a copy of the license at",
     "you may not use this file except in compliance with the license"),
    ("gpl-warranty", "this program is distributed in the hope that it will be useful but without any warranty without "
     "even the implied warranty of merchantability or fitness for a particular purpose",
     "implied warranty of merchantability or fitness for a particular purpose"),
]

RARE = 3  # words of a template in the index, or all of a shorter mandatory phrase
ENOUGH = 0.7  # share of a template's weight that must stand in its place


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    key: range  # relative positions of the mandatory phrase
    base: bool


def templates() -> list[Template]:
    found = [Template(label, tuple(p.split()), range(len(p.split())), True) for p, label in BASE.items()]
    for label, sentence, phrase in SENTENCES:
        all_words, key = tuple(sentence.split()), tuple(phrase.split())
        at = next(i for i in range(len(all_words)) if all_words[i : i + len(key)] == key)
        found.append(Template(label, all_words, range(at, at + len(key)), False))
    return found


def _quoted(items) -> str:
    return ", ".join(f"'{item}'" for item in items)


def word_rarity(split: DataFrame, vocabulary: list[str]) -> dict[str, float]:
    """Inverse document frequency of the template words, over all rows of ``split``.

    Only counts of the templates' own words reach the driver.
    """
    held = F.expr(f"array_distinct(filter(w, x -> x in ({_quoted(vocabulary)})))")
    counts = split.select(F.explode(F.array_append(held, F.lit("")))).groupBy("col").count()
    df = {row["col"]: row["count"] for row in counts.collect()}
    everything = df.get("", 0)
    return {word: math.log((1 + everything) / (1 + df.get(word, 0))) + 1 for word in vocabulary}


@dataclass(frozen=True)
class Index:
    """The templates and the postings of their rarest mandatory words, as literals.

    Its size is that of the templates, whatever the number of files. ``postings`` maps a word to
    structs ``(template, position, rank)``; the other arrays have an entry a template.
    """

    count: int
    postings: Column
    rarest: Column  # the words in the index
    phrase: Column  # words of the mandatory phrase
    phrase_at: Column  # where it begins
    body: Column  # structs (word, weight)
    base: Column
    label: Column


def license_index(known: list[Template], rarity: dict[str, float]) -> Index:
    """Index the templates' ``RARE`` highest-IDF mandatory words; equal ones by their position.

    A phrase of fewer words has its last one in the remaining ranks as well, so that all templates have all ranks.
    """
    postings: dict[str, list[Column]] = {}
    rarest, bodies = [], []
    for number, template in enumerate(known):
        order = sorted(template.key, key=lambda k: (-rarity[template.words[k]], k))[:RARE]
        for rank in range(RARE):
            k = order[min(rank, len(order) - 1)]
            posting = F.struct(F.lit(number).alias("template"), F.lit(k).alias("position"), F.lit(rank).alias("rank"))
            postings.setdefault(template.words[k], []).append(posting)
        rarest.append(F.lit(sorted({template.words[k] for k in order})))
        total = sum(rarity[word] for word in template.words)
        bodies.append(
            F.array(*(F.struct(F.lit(w).alias("word"), F.lit(rarity[w] / total).alias("weight")) for w in template.words))
        )
    return Index(
        len(known),
        F.create_map(*(c for word, found in sorted(postings.items()) for c in (F.lit(word), F.array(*found)))),
        F.array(*rarest),
        F.array(*(F.lit([t.words[k] for k in t.key]) for t in known)),
        F.lit([t.key.start for t in known]),
        F.array(*bodies),
        F.lit([t.base for t in known]),
        F.lit([t.label for t in known]),
    )


def _possible(index: Index) -> Column:
    """Templates all of whose mandatory words are ``held``; named twice, so that the planner keeps it as a column."""
    every = F.lit(list(range(index.count)))
    fit = F.filter(every, lambda t: F.size(F.array_except(F.get(index.phrase, t), F.col("held"))) == 0)
    return F.when(F.size("held") > 0, fit).otherwise(F.array().cast("array<int>"))


def _hits() -> Column:
    """Where in ``w`` the words looked up stand; a file that looks up none is not gone through."""
    at = F.transform("w", lambda word, i: F.when(F.array_contains("looked_up", word), i).otherwise(-1))
    return F.when(F.size("looked_up") > 0, F.filter(at, lambda i: i >= 0)).otherwise(F.array().cast("array<int>"))


def _spoken_for(index: Index) -> Column:
    """``(rank, start)`` per hit and posting; ``start`` has the template in it, as a whole number."""

    def of_hit(i: Column) -> Column:
        found = F.element_at(index.postings, F.get("w", i))
        return F.transform(
            F.filter(found, lambda p: F.array_contains("possible", p["template"])),
            lambda p: F.struct(
                p["rank"].alias("rank"),
                ((i - p["position"]).cast("long") * index.count + p["template"]).alias("start"),
            ),
        )

    return F.flatten(F.transform("hits", of_hit))


def _agreed(rank: int) -> Column:
    return F.transform(F.filter("entries", lambda e: e["rank"] == rank), lambda e: e["start"])


def _verified(index: Index) -> Column:
    """``(start, label, base, share)`` of the ``starts`` where the template does stand."""

    def place(coded: Column) -> Column:
        template, start = (coded % index.count).cast("int"), F.floor(coded / index.count).cast("int")
        phrase = F.get(index.phrase, template)
        stands = F.slice("w", start + F.get(index.phrase_at, template) + 1, F.size(phrase)) == phrase
        weights = F.transform(
            F.get(index.body, template),
            lambda x, k: F.when(F.get("w", start + k).eqNullSafe(x["word"]), x["weight"]).otherwise(0.0),
        )
        return F.struct(
            start.cast("long").alias("start"),
            F.get(index.label, template).alias("label"),
            F.get(index.base, template).alias("base"),
            stands.alias("stands"),
            F.least(F.lit(1.0), F.aggregate(weights, F.lit(0.0), lambda sum_, x: sum_ + x)).alias("share"),
        )

    tried = F.transform(F.filter("starts", lambda coded: coded >= 0), place)
    return F.filter(tried, lambda p: p["stands"] & (p["base"] | (p["share"] >= ENOUGH)))


def license_scan(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score)`` per row.

    ``n_base`` counts every place where a base phrase's words stand consecutively;
    ``first_word`` and ``last_word`` are the smallest and largest start. ``labels`` adds those
    of the license texts found, ``score`` is the largest share of a template's weight
    that stands in its place (0 if none). NULL and empty texts have no words; repeated rows each get
    their row; an empty table gives no rows; further columns are ignored.

    A template that holds its mandatory phrase holds all words of it, so whatever words of the phrase are
    in the index, no place is missed.

    Two scans, no shuffle but that of the template words' counts. The index is a literal as large as the
    templates; a file's postings are intersected in its own row, so neither a frequent word nor
    repeated files make a hot key.
    """
    split = docs.select("doc_id", words(F.col("text")).alias("w"))
    known = templates()
    vocabulary = sorted({word for t in known for word in t.words})
    index = license_index(known, word_rarity(split, vocabulary))
    mandatory = F.lit(sorted({t.words[k] for t in known for k in t.key}))
    looked_up = F.array_distinct(F.flatten(F.transform("possible", lambda t: F.get(index.rarest, t))))
    places = (
        split.withColumn("held", F.array_intersect("w", mandatory))
        .withColumn("possible", _possible(index))
        .withColumn("looked_up", looked_up)
        .withColumn("hits", _hits())
        .withColumn("entries", _spoken_for(index))
        .withColumn("starts", reduce(F.array_intersect, map(_agreed, range(RARE))))
        .withColumn("places", _verified(index))
    )
    base = F.filter("places", lambda p: p["base"])

    def labels(of: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(of, lambda p: p["label"]))), ",")

    return places.select(
        "doc_id",
        F.size("w").cast("long").alias("n_words"),
        F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda p: p["start"])).alias("first_word"),
        F.array_max(F.transform(base, lambda p: p["start"])).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("places")).alias("labels"),
        F.round(F.coalesce(F.array_max(F.transform("places", lambda p: p["share"])), F.lit(0.0)), 6).alias("score"),
    )
