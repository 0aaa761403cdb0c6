"""License scans with a positional index of rare words."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderweir.llm.common import utf8
from orderweir.llm.words import LETTERS, Lookup, groups, hash_of, scan

# Phrases that decide a label by themselves.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: Words that a key phrase may be off its place in most templates.
SLACK = 8

# Passages of each licence or of its notice, the key phrases that must stand in them, and by how many
# words a phrase may be off its place, for words put in or left out (list marks, names, other editions).
TEMPLATES = {
    "agpl-3": [
        (
            "gnu affero general public license version 3",
            ["affero general public license", "version 3"],
            SLACK,
        ),
        (
            "under the terms of the gnu affero general public license as published by the free software "
            "foundation either version 3 of the license or at your option any later version",
            ["affero general public license as published by the free software foundation", "version 3"],
            SLACK,
        ),
    ],
    "apache-2": [
        (
            "licensed under the apache license version 2 0 the license you may not use this file except in "
            "compliance with the license",
            ["apache license version 2"],
            SLACK,
        ),
    ],
    "bsd-3-clause": [
        (
            "redistribution and use in source and binary forms with or without modification are permitted "
            "provided that the following conditions are met neither the name of the copyright holder nor the "
            "names of its contributors may be used to endorse or promote products derived from this software",
            ["redistribution and use in source and binary forms", "endorse or promote products"],
            SLACK,
        ),
        (
            "redistribution and use in source and binary forms with or without modification are permitted "
            "provided that the following conditions are met 1 redistributions of source code must retain the "
            "above copyright notice this list of conditions and the following disclaimer 2 redistributions in "
            "binary form must reproduce the above copyright notice this list of conditions and the following "
            "disclaimer in the documentation and or other materials provided with the distribution 3 neither the "
            "name of the copyright holder nor the names of its contributors may be used to endorse or promote "
            "products derived from this software without specific prior written permission",
            ["redistribution and use in source and binary forms", "redistributions of source code must retain", "endorse or promote products"],
            24,
        ),
    ],
    "bsd-2-clause": [
        (
            "redistribution and use in source and binary forms with or without modification are permitted "
            "provided that the following conditions are met redistributions of source code must retain the above "
            "copyright notice this list of conditions and the following disclaimer",
            ["redistribution and use in source and binary forms", "redistributions of source code must retain"],
            SLACK,
        ),
    ],
    "cc-by-4": [
        (
            "licensed under a creative commons attribution 4 0 international license",
            ["creative commons attribution 4 0"],
            SLACK,
        ),
    ],
    "cc-by-nc": [
        (
            "licensed under a creative commons attribution noncommercial 4 0 international license",
            ["creative commons attribution noncommercial"],
            SLACK,
        ),
    ],
    "cc-by-sa": [
        (
            "licensed under a creative commons attribution sharealike 4 0 international license",
            ["creative commons attribution sharealike"],
            SLACK,
        ),
    ],
    "cc0": [
        (
            "cc0 1 0 universal public domain dedication",
            ["cc0 1 0"],
            SLACK,
        ),
    ],
    "gpl-2": [
        (
            "licensed under the gnu general public license version 2",
            ["gnu general public license version 2"],
            SLACK,
        ),
        (
            "under the terms of the gnu general public license as published by the free software foundation "
            "either version 2 of the license or at your option any later version",
            ["gnu general public license as published by the free software foundation", "version 2"],
            SLACK,
        ),
    ],
    "gpl-3": [
        (
            "licensed under the gnu general public license version 3",
            ["gnu general public license version 3"],
            SLACK,
        ),
        (
            "under the terms of the gnu general public license as published by the free software foundation "
            "either version 3 of the license or at your option any later version",
            ["gnu general public license as published by the free software foundation", "version 3"],
            SLACK,
        ),
    ],
    "isc": [
        (
            "permission to use copy modify and or distribute this software for any purpose with or without fee is "
            "hereby granted",
            ["permission to use copy modify and or distribute this software"],
            SLACK,
        ),
    ],
    "lgpl-3": [
        (
            "gnu lesser general public license version 3",
            ["lesser general public license", "version 3"],
            SLACK,
        ),
        (
            "under the terms of the gnu lesser general public license as published by the free software "
            "foundation either version 3 of the license or at your option any later version",
            ["lesser general public license as published by the free software foundation", "version 3"],
            SLACK,
        ),
    ],
    "mit": [
        (
            "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files the software to deal in the software without restriction",
            ["permission is hereby granted free of charge", "deal in the software without restriction"],
            SLACK,
        ),
    ],
    "mpl-2": [
        (
            "this source code form is subject to the terms of the mozilla public license v 2 0",
            ["mozilla public license v 2 0"],
            SLACK,
        ),
    ],
    "unlicense": [
        (
            "this is free and unencumbered software released into the public domain",
            ["free and unencumbered software released into the public domain"],
            SLACK,
        ),
    ],
}
#: A passage of the first kind that overlaps one of the second is a part of it.
PARTS = {"bsd-2-clause": "bsd-3-clause"}

#: Highest-IDF words by which a template is looked up, and how many of them must agree on a place.
ANCHORS, LEAST_VOTES = 6, 3

FOUND = (
    "doc_id long, n_words long, base array<struct<label: string, start: long>>, "
    "found array<struct<label: string, start: long, score: double>>"
)
SPANS = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64())]))
SCORES = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("score", pa.float64())]))


def overlaps(passages: list[tuple[int, int, float]], start: int, size: int) -> bool:
    """Whether a passage overlaps one of a sorted list of disjoint ones (place, words, score)."""
    at = bisect_left(passages, (start,))
    after = at < len(passages) and passages[at][0] < start + size
    return after or (at > 0 and passages[at - 1][0] + passages[at - 1][1] > start)


@dataclass
class Template:
    label: str
    words: list[int]
    phrases: list[tuple[int, list[int]]]
    anchors: list[tuple[int, int]]
    slack: int


class Index:
    """Licence words by number, phrases as numbers, and postings (word, template, place) of the anchors."""

    def __init__(self, idf: dict[str, float], templates: dict = TEMPLATES, base: dict = BASE):
        words = licence_words(templates, base)
        number = {word: i for i, word in enumerate(words)}
        self.lookup = Lookup(np.array([hash_of(w.encode()) for w in words], np.uint64))
        self.idf = np.array([idf.get(w, 0.0) for w in words])
        self.base = [(label, [number[w] for w in phrase.split()]) for phrase, label in base.items()]
        self.templates, postings = [], []
        for label, text, phrases, slack in ((label, *one) for label, own in templates.items() for one in own):
            body = [number[w] for w in text.split()]
            keys = [[number[w] for w in phrase.split()] for phrase in phrases]
            places = [next(i for i in range(len(body)) if body[i : i + len(k)] == k) for k in keys]
            rare = sorted(set(body), key=lambda w: (-self.idf[w], w))[:ANCHORS]
            anchors = [(w, i) for i, w in enumerate(body) if w in rare]
            postings += [(w, len(self.templates), i) for w, i in anchors]
            self.templates.append(Template(label, body, list(zip(places, keys)), anchors, slack))
        postings.sort()
        self.postings = np.array(postings, np.int64).reshape(-1, 3)
        self.first = np.searchsorted(self.postings[:, 0], np.arange(len(words) + 1))

    def phrase(self, numbers: np.ndarray, text: np.ndarray, phrase: list[int]) -> np.ndarray:
        """Places where the phrase stands within one text."""
        at = np.flatnonzero(numbers[: max(len(numbers) - len(phrase) + 1, 0)] == phrase[0])
        for i, word in enumerate(phrase[1:], 1):
            at = at[(numbers[at + i] == word) & (text[at + i] == text[at])]
        return at

    def candidates(self, numbers: np.ndarray, text: np.ndarray) -> Iterator[tuple[int, int]]:
        """(template, place of its first word) on which enough anchors agree."""
        at = np.flatnonzero(numbers >= 0)
        own = numbers[at]
        counts = self.first[own + 1] - self.first[own]
        at, own, counts = at[counts > 0], own[counts > 0], counts[counts > 0]
        if not len(at):
            return
        row = np.repeat(self.first[own], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        template, start = self.postings[row, 1], np.repeat(at, counts) - self.postings[row, 2]
        # A vote belongs to the text of its word: two texts never vote together.
        votes, n = np.unique(np.stack((template, start, np.repeat(text[at], counts))), axis=1, return_counts=True)
        for (t, s, _), k in zip(votes.T.tolist(), n.tolist()):
            if k >= min(LEAST_VOTES, len(self.templates[t].anchors)):
                yield t, s

    def passages(self, numbers: np.ndarray, text: np.ndarray) -> Iterator[tuple[int, str, int, float]]:
        """(text, label, place, score): the best of the verified passages of a label that overlap, without PARTS of others."""
        kept: dict[tuple[int, str], list[tuple[int, int, float]]] = {}
        for i, label, start, size, share in sorted(self.verified(numbers, text), key=lambda x: (-x[4], x[2], -x[3])):
            own = kept.setdefault((i, label), [])
            if not overlaps(own, start, size):
                insort(own, (start, size, share))
        for (i, label), own in kept.items():
            wholes = kept.get((i, PARTS.get(label, "")), [])
            for start, size, share in own:
                if not overlaps(wholes, start, size):
                    yield i, label, start, share

    def verified(self, numbers: np.ndarray, text: np.ndarray) -> Iterator[tuple[int, str, int, int, float]]:
        """(text, label, place, words, score): templates whose key phrases all stand near their places."""
        for t, start in self.candidates(numbers, text):
            template = self.templates[t]
            owner = None
            for place, phrase in template.phrases:
                low = max(start + place - template.slack, 0)
                near = slice(low, start + place + template.slack + len(phrase))
                spots = self.phrase(numbers[near], text[near], phrase)
                owners = set(text[near][spots].tolist())
                owner = owners if owner is None else owner & owners
            for i in sorted(owner or ()):
                spots = np.arange(start, start + len(template.words))
                good = (spots >= 0) & (spots < len(numbers))
                body, spots = np.array(template.words)[good], spots[good]
                same = (numbers[spots] == body) & (text[spots] == i)
                weight = self.idf[template.words].sum()
                share = float(self.idf[body[same]].sum() / weight) if weight > 0 else 1.0
                yield i, template.label, start, len(template.words), share


def licence_words(templates: dict = TEMPLATES, base: dict = BASE) -> list[str]:
    texts = [t for own in templates.values() for text, phrases, _ in own for t in (text, *phrases)] + list(base)
    return sorted({w for text in texts for w in text.split()})


def word_idf(docs: DataFrame) -> dict[str, float]:
    """Inverse document frequency of each licence word over all documents; one number per word reaches the driver."""
    words = licence_words()
    hashes = np.array([hash_of(w.encode()) for w in words], np.uint64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup, seen = Lookup(hashes), np.zeros(len(words) + 1, np.int64)
        for batch in batches:
            for _, texts in groups(batch, 0):
                found = scan(texts, LETTERS)
                numbers = lookup(found.hashes())
                text = np.repeat(np.arange(len(texts)), np.diff(found.bounds))
                pairs = np.unique(text[numbers >= 0] * len(words) + numbers[numbers >= 0])
                seen[:-1] += np.bincount(pairs % len(words), minlength=len(words))
                seen[-1] += len(texts)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(words) + 1)), pa.array(seen)], names=["word", "n"])

    rows = docs.select(utf8().alias("text")).mapInArrow(count, "word long, n long")
    counts = {r["word"]: r["n"] for r in rows.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    total = counts.get(len(words), 0)
    return {w: float(np.log((total + 1) / (counts.get(i, 0) + 1))) for i, w in enumerate(words)}


def find_licences(docs: DataFrame) -> DataFrame:
    """One row per document: n_words, `base` (all places of decisive phrases) and `found` (licence passages).

    Words are runs of letters, digits and non-ASCII bytes of the whole text in ASCII lower case.
    A first pass counts in how many documents each licence word occurs. Every template is indexed by
    its ANCHORS words of highest IDF with their places; each such word of a file votes for the
    places at which templates would start, and where enough votes agree the template's key
    phrases must all stand at their places, give or take the template's slack. Of overlapping passages of a
    label the best one counts, and a passage of PARTS inside its whole does not. The score is the share of the
    template's IDF that stands in place.

    * null id: a row of its own; null or empty text: no words, nothing found; very long texts: whole;
      repeated rows: one result each; ties: found passages are sorted by label and place.
    * empty table: empty result. Other columns are not read.
    """
    index = Index(word_idf(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in groups(batch):
                words = scan(texts, LETTERS)
                sizes = np.diff(words.bounds)
                text = np.repeat(np.arange(len(texts)), sizes)
                numbers = index.lookup(words.hashes())
                base: list[list] = [[] for _ in texts]
                found: list[list] = [[] for _ in texts]
                for label, phrase in index.base:
                    for at in index.phrase(numbers, text, phrase).tolist():
                        base[text[at]].append({"label": label, "start": at - words.bounds[text[at]]})
                for i, label, start, share in index.passages(numbers, text):
                    place = max(start - int(words.bounds[i]), 0)
                    found[i].append({"label": label, "start": place, "score": share})
                for spans in (*base, *found):
                    spans.sort(key=lambda x: (x["label"], x["start"]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), pa.array(sizes), pa.array(base, SPANS), pa.array(found, SCORES)],
                    names=["doc_id", "n_words", "base", "found"],
                )

    return docs.select(F.col("doc_id").cast("long"), utf8().alias("text")).mapInArrow(run, FOUND)
