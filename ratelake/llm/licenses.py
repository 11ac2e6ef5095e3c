"""License scan by a positional index of rare tokens.

The index holds, for every licence word, the templates and positions it stands at. How
rare the words are is counted over the corpus. A template of which enough words are in
place cannot lack all of its rarest ones: with ``n`` words, of which ``m`` must be there,
one of the rarest ``n - m + 1`` is. So only these are indexed, and no notice is missed,
however common its words are. Every such word of a file gives the places where the template
may begin; it becomes a label if its mandatory phrases stand there word for word and enough
of its words are in place.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


@dataclass(frozen=True)
class Template:
    """Words of a licence notice, and phrases of it that must stand in the file."""

    label: str
    text: str
    phrases: tuple[str, ...] = ()


@dataclass(frozen=True)
class Settings:
    """``slack``: how many words may be put in or left out before a word that is in place;
    ``enough``: share of words in place."""

    slack: int = 3
    enough: float = 0.8


# Phrases whose every place counts, by label.
BASE_PHRASES = (("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license"))

# Wording of public licence notices.
TEMPLATES = (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", ("permission is hereby granted free of charge", "deal in the software without restriction")),
    Template("mit", "released under the mit license", ("the mit license",)),
    Template("apache", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    Template("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", ("you may not use this file except in compliance with the license",)),
    Template("gpl", "gnu general public license version 3", ("gnu general public license",)),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", ("under the terms of the gnu general public license",)),
    Template("lgpl", "gnu lesser general public license", ("lesser general public license",)),
    Template("agpl", "gnu affero general public license", ("affero general public license",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms", "provided that the following conditions are met")),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("for any purpose with or without fee is hereby granted",)),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    Template("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license", ("eclipse public license",)),
    Template("boost", "distributed under the boost software license version 1 0", ("boost software license",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
    Template("cc-by", "licensed under cc by 4 0", ("cc by 4 0",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc-by-nd", "licensed under cc by nd 4 0", ("cc by nd",)),
    Template("cc-by", "licensed under a creative commons attribution 4 0 international license", ("creative commons attribution 4 0",)),
    Template("cc-by-sa", "creative commons attribution sharealike 4 0 international license", ("creative commons attribution sharealike",)),
    Template("cc-by-nc", "creative commons attribution noncommercial 4 0 international license", ("creative commons attribution noncommercial",)),
    Template("cc0", "cc0 1 0 universal public domain dedication", ("cc0 1 0",)),
    Template("bsd", "licensed under the bsd license", ("the bsd license",)),
    Template("bsd", "licensed under the bsd 2 clause license", ("bsd 2 clause",)),
    Template("bsd", "licensed under the bsd 3 clause license", ("bsd 3 clause",)),
    Template("gpl", "gnu gplv2", ("gnu gplv2",)),
    Template("gpl", "gnu gplv3", ("gnu gplv3",)),
    Template("gpl", "gnu gpl v2", ("gnu gpl v2",)),
    Template("gpl", "gnu gpl v3", ("gnu gpl v3",)),
    Template("lgpl", "gnu library general public license", ("library general public license",)),
)
# Licence identifiers as words, by label.
IDENTIFIERS = (
    ("mit", "mit"), ("apache", "apache 2 0"), ("gpl", "gpl 2 0"), ("gpl", "gpl 3 0"), ("lgpl", "lgpl 2 1"), ("lgpl", "lgpl 3 0"),
    ("agpl", "agpl 3 0"), ("bsd", "bsd 2 clause"), ("bsd", "bsd 3 clause"), ("isc", "isc"), ("mpl", "mpl 2 0"), ("epl", "epl 2 0"),
    ("boost", "bsl 1 0"), ("unlicense", "unlicense"), ("cc0", "cc0 1 0"), ("cc-by", "cc by 4 0"), ("cc-by-sa", "cc by sa 4 0"),
)
TEMPLATES += tuple(Template(label, f"spdx license identifier {name}", (f"license identifier {name}",)) for label, name in IDENTIFIERS)


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(LOWER))


@dataclass
class Index:
    """Rare words of all templates with their places, built from the words' rarity in the corpus."""

    idf: dict[str, float]
    settings: Settings = field(default_factory=Settings)
    templates: tuple[Template, ...] = TEMPLATES

    def __post_init__(self) -> None:
        self.words = [t.text.split() for t in self.templates]
        self.phrases = [[p.split() for p in t.phrases] for t in self.templates]
        self.postings: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for number, words in enumerate(self.words):
            rarest = sorted(range(len(words)), key=lambda i: (-self.idf.get(words[i], math.inf), words[i], i))
            for place in rarest[: len(words) - self.needed(number) + 1]:
                self.postings[words[place]].append((number, place))
        # A base phrase is a template of its own, looked up by its rarest word and found only whole.
        self.base: dict[str, list[tuple[str, int, list[str]]]] = defaultdict(list)
        for label, phrase in BASE_PHRASES:
            words = phrase.split()
            place = min(range(len(words)), key=lambda i: (-self.idf.get(words[i], math.inf), i))
            self.base[words[place]].append((label, place, words))
        self.lookup = frozenset(self.postings) | frozenset(self.base)

    def needed(self, number: int) -> int:
        """How many of the template's words must be in place."""
        return max(1, math.ceil(self.settings.enough * len(self.words[number]) - 1e-9))

    def candidates(self, hits: list[tuple[int, str]], words: list[str]) -> dict[int, set[int]]:
        """The places where a template may begin, of the templates whose phrases the file holds."""
        begins: dict[int, set[int]] = defaultdict(set)
        for place, word in hits:
            for number, at in self.postings.get(word, ()):
                begins[number].add(place - at)
        if not begins:
            return begins
        whole, slack = f" {' '.join(words)} ", self.settings.slack
        return {
            number: {b + d for b in at for d in range(-slack, slack + 1)}
            for number, at in begins.items()
            if all(f" {' '.join(p)} " in whole for p in self.phrases[number])
        }

    def in_place(self, number: int, begin: int, words: list[str]) -> float:
        """Share of the template's words found near their places; 0 unless all mandatory phrases stand there."""
        template, slack = self.words[number], self.settings.slack
        low = max(0, begin - slack)
        near = words[low : max(0, begin + len(template) + 2 * slack)]
        for phrase in self.phrases[number]:
            if not any(near[i : i + len(phrase)] == phrase for i in range(len(near) - len(phrase) + 1)):
                return 0.0
        hit = 0
        for place, word in enumerate(template):
            at = begin + place - low
            hit += word in near[max(0, at - slack) : at + slack + 1]
        return hit / len(template)

    def best(self, number: int, begins: set[int], words: list[str]) -> Iterator[tuple[int, float]]:
        """``(begin, share)`` of the places where the template stands; of overlapping ones the best, then the first."""
        found: tuple[int, float] | None = None
        for begin in sorted(begins):
            share = self.in_place(number, begin, words)
            if share * len(self.words[number]) < self.needed(number) - 1e-9:
                continue
            if found is not None and begin >= found[0] + len(self.words[number]):
                yield found
                found = None
            if found is None or share > found[1]:
                found = (begin, share)
        if found is not None:
            yield found

    def scan(self, text: str | None) -> dict:
        words = words_of(text)
        hits = [(place, word) for place, word in enumerate(words) if word in self.lookup]
        places, base = [], set()
        for place, word in hits:
            for label, at, phrase in self.base.get(word, ()):
                begin = place - at
                if begin >= 0 and words[begin : begin + len(phrase)] == phrase:
                    places.append(begin)
                    base.add(label)
        labels, score, spans = set(base), 0.0, []
        for number, begins in sorted(self.candidates(hits, words).items()):
            for begin, share in self.best(number, begins, words):
                labels.add(self.templates[number].label)
                score = max(score, share)
                spans.append((self.templates[number].label, max(0, begin), len(self.words[number]), share))
        return {
            "n_words": len(words),
            "n_base": len(places),
            "first_word": min(places) if places else None,
            "last_word": max(places) if places else None,
            "base_labels": ",".join(sorted(base)),
            "labels": ",".join(sorted(labels)),
            # A base phrase stands whole where it is found.
            "score": 1.0 if base else score,
            "spans": [{"label": a, "word": b, "length": c, "share": d} for a, b, c, d in spans],
        }


SCAN = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<label:string,word:long,length:long,share:double>>"
SPANS = pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64()), ("length", pa.int64()), ("share", pa.float64())]))
TYPES = {"n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(), "base_labels": pa.string(), "labels": pa.string(), "score": pa.float64(), "spans": SPANS}


def rarity(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> dict[str, float]:
    """Inverse document frequency, over all of ``docs``, of the words of the templates.

    Tasks send one row for each licence word they met; the result has as many entries as
    the templates have words, whatever the size of the corpus.
    """
    known = frozenset(w for t in templates for w in t.text.split()) | frozenset(w for _, p in BASE_PHRASES for w in p.split())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, int] = defaultdict(int)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                seen[""] += 1
                for word in known.intersection(words_of(text)):
                    seen[word] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "files"])

    counted = docs.select("text").mapInArrow(count, "word string, files long").groupBy("word").agg(F.sum("files").alias("files"))
    files = {r["word"]: r["files"] for r in counted.collect()}
    total = files.pop("", 0)
    return {w: math.log((total + 1) / (files.get(w, 0) + 1)) for w in known}


def scan_licenses(docs: DataFrame, settings: Settings = Settings(), templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """Labels of every row of ``docs`` (``doc_id``, ``text``) and the spans they rest on.

    A NULL or empty text has no words, no labels and score 0. Rows that repeat, or lack a
    doc_id, are scanned each; other columns play no part.
    """
    idf = rarity(docs, templates)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(idf, settings, templates)
        for batch in batches:
            found = [index.scan(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array([f[n] for f in found], kind) for n, kind in TYPES.items())], names=["doc_id", *TYPES]
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scan, SCAN)
