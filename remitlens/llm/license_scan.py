"""License scans by a positional index of rare words.

Every licence notice (template) is a list of words. Document frequencies of all template words are counted over all
documents; each template is then indexed under its highest-IDF words, with their positions. A document looks up its own
words in that index; postings of one template that agree on the relative position (place in the text minus place in the
template) propose an alignment, which must show the template's mandatory key phrases at their places and enough of its
words by IDF weight.

All of it is expressions on arrays: no shuffle besides the word counts, which are one row for each template word.

Defined cases: null texts are empty; texts without licence words have no labels, null places and score 0; rows are
judged on their own, so repeated rows give repeated results; alignments that tie all count; long texts are scanned whole, and
their work grows with n log n; columns of the input under the names that are added are replaced; an empty table gives an empty one.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlens.llm.common import let, without

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words of a template that the index holds, and the share of IDF weight that an alignment must show.
RARE, LEAST_SCORE = 6, 0.6
ADDED = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")

# The phrases and labels of the contract, and wordings of common public licence notices.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))


@dataclass(frozen=True)
class Template:
    """``keys`` are the phrases that must stand at their places in ``text``."""

    label: str
    text: str
    keys: tuple[str, ...]


TEMPLATES = (
    *(Template(label, phrase, (phrase,)) for phrase, label in BASE),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ("hereby granted free of charge", "this software and associated documentation files")),
    Template("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at", ("you may not use this file except in compliance with the license",)),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", ("free software", "gnu general public license")),
    Template("lgpl", "under the terms of the gnu lesser general public license", ("gnu lesser general public license",)),
    Template("agpl", "under the terms of the gnu affero general public license", ("gnu affero general public license",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms", "following conditions are met")),
    Template("bsd", "bsd license", ("bsd license",)),
    Template("mpl", "subject to the terms of the mozilla public license", ("mozilla public license",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("permission to use copy modify", "with or without fee is hereby granted")),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
    Template("cc-by", "licensed under cc by 4 0", ("cc by 4",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc-by-nd", "licensed under cc by nd 4 0", ("cc by nd",)),
    Template("cc-by", "licensed under a creative commons attribution 4 0 international license", ("creative commons attribution 4",)),
    Template("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license", ("creative commons attribution sharealike",)),
    Template("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license", ("creative commons attribution noncommercial",)),
)


def text_words() -> Column:
    """Words of the contract for comparison with ASCII words.

    Of all other characters only the Kelvin sign becomes an ASCII letter by ``lower``; it is exchanged before.
    """
    return F.regexp_extract_all(F.lower(F.replace(F.coalesce(F.col("text"), F.lit("")), F.lit("K"), F.lit("µ"))), F.lit(WORD), F.lit(0))


def document_frequencies(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> tuple[dict[str, int], int]:
    """Documents with each template word, and documents. The result has one row for each template word at most."""
    vocabulary = F.lit(sorted({w for t in templates for w in t.text.split()}))
    have = docs.select(F.explode_outer(F.array_intersect(text_words(), vocabulary)).alias("word"))
    counts = {r.word: r.n for r in have.groupBy("word").agg(F.count("*").alias("n")).collect()}
    return counts, docs.count()


def _key_places(template: Template) -> list[int]:
    words, places = template.text.split(), set()
    for key in template.keys:
        parts = key.split()
        at = next(i for i in range(len(words)) if words[i : i + len(parts)] == parts)
        places |= set(range(at, at + len(parts)))
    return sorted(places)


class Index:
    """Postings of the rare words, as literals of the plan."""

    def __init__(self, frequencies: dict[str, int], total: int, templates: tuple[Template, ...] = TEMPLATES):
        def idf(word: str) -> float:
            return math.log((total + 1) / (frequencies.get(word, 0) + 1)) + 1

        postings: dict[str, list[tuple[int, int]]] = {}
        entries = []
        for number, template in enumerate(templates):
            words = template.text.split()
            rare = sorted(dict.fromkeys(words), key=lambda w: (-idf(w), w))[:RARE]
            places = [i for i, w in enumerate(words) if w in rare]
            for i in places:
                postings.setdefault(words[i], []).append((number, i))
            weights = [idf(w) for w in words]
            need = max(1, math.ceil(LEAST_SCORE * len(places)))
            entries.append((template.label, words, weights, sum(weights), _key_places(template), need))
        self.words = F.lit(sorted(postings))
        self.postings = F.create_map(*[x for w, found in postings.items() for x in (F.lit(w), F.array(*[F.struct(F.lit(t).alias("t"), F.lit(p).alias("p")) for t, p in found]))])
        self.templates = F.array(
            *[
                F.struct(F.lit(label).alias("label"), F.lit(words).alias("words"), F.lit(weights).alias("weights"), F.lit(total).alias("total"), F.lit(keys).alias("keys"), F.lit(need).alias("need"))
                for label, words, weights, total, keys, need in entries
            ]
        )

    def aligned(self, words: Column) -> Column:
        """Accepted alignments: array of (label, score)."""

        def proposals(offsets: Column) -> Column:
            """Alignments that as many rare words agree on as their template asks: equal ones stand together."""

            def same(x: Column, i: Column) -> Column:
                return F.get(offsets, i)["o"].eqNullSafe(x["o"]) & F.get(offsets, i)["t"].eqNullSafe(x["t"])

            return F.filter(offsets, lambda x, i: same(x, i + x["need"] - 1) & ~same(x, i - 1))

        def score(x: Column) -> Column:
            entry = F.get(self.templates, x["t"])

            def shows(entry: Column) -> Column:
                here = F.transform(entry["words"], lambda w, i: F.when(F.get(words, x["o"] + i) == w, F.get(entry["weights"], i)).otherwise(0.0))
                total = F.aggregate(here, F.lit(0.0), lambda a, b: a + b) / entry["total"]
                keys = F.forall(entry["keys"], lambda k: F.get(words, x["o"] + k).eqNullSafe(F.get(entry["words"], k)))
                return F.struct(entry["label"].alias("label"), F.when(keys, F.least(total, F.lit(1.0))).otherwise(0.0).alias("score"))

            return let(entry, shows)

        def expanded(places: Column) -> Column:
            each = F.transform(
                places,
                lambda h: F.transform(F.element_at(self.postings, h["w"]), lambda p: F.struct(p["t"].alias("t"), (h["i"] - p["p"]).alias("o"), F.get(self.templates, p["t"])["need"].alias("need"))),
            )
            return F.sort_array(F.flatten(each))

        known = F.filter(F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda h: F.array_contains(self.words, h["w"]))
        found = F.transform(let(let(known, expanded), proposals), score)
        return F.filter(found, lambda a: a["score"] >= LEAST_SCORE)


def base_places(words: Column) -> Column:
    """Array of (place, label) of the contract's phrases."""

    def at(w: Column, i: Column) -> Column:
        found = None
        for phrase, label in BASE:
            parts = phrase.split()
            hit = w == parts[-1]
            for back, part in enumerate(reversed(parts[:-1]), 1):
                hit = hit & F.get(words, i - back).eqNullSafe(F.lit(part))
            value = F.struct((i - (len(parts) - 1)).cast("long").alias("at"), F.lit(label).alias("label"))
            found = F.when(hit, value) if found is None else found.when(hit, value)
        return found

    return F.filter(F.transform(words, at), lambda p: p.isNotNull())


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """``docs`` with n_words, the contract's phrase places, labels and score; columns of these names are replaced."""
    index = Index(*document_frequencies(docs, templates), templates)
    rows = without(docs, *ADDED, "_words", "_found").withColumn("_words", text_words())

    def found(words: Column) -> Column:
        return F.struct(base_places(words).alias("base"), index.aligned(words).alias("aligned"))

    # A document without any indexed word has no postings at all.
    rows = rows.withColumns({"n_words": F.size("_words").cast("long"), "_found": F.when(F.arrays_overlap("_words", index.words), let(F.col("_words"), found))}).drop("_words")
    base, aligned = F.col("_found")["base"], F.col("_found")["aligned"]
    base_labels = F.coalesce(F.transform(base, lambda p: p["label"]), F.array().cast("array<string>"))
    labels = F.concat(base_labels, F.coalesce(F.transform(aligned, lambda a: a["label"]), F.array().cast("array<string>")))
    return rows.withColumns(
        {
            "n_base": F.coalesce(F.size(base), F.lit(0)).cast("long"),
            "first_word": F.array_min(F.transform(base, lambda p: p["at"])),
            "last_word": F.array_max(F.transform(base, lambda p: p["at"])),
            "base_labels": F.array_join(F.array_sort(F.array_distinct(base_labels)), ","),
            "labels": F.array_join(F.array_sort(F.array_distinct(labels)), ","),
            "score": F.coalesce(F.array_max(F.transform(aligned, lambda a: a["score"])), F.lit(0.0)),
        }
    ).drop("_found")
