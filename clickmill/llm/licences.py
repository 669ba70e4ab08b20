"""Licence scan: a trained paragraph classifier, confirmed against templates.

Lines are the paragraphs of a text; long ones are looked at in overlapping windows of 8, 16 and
32 words, so that a notice of any length fills much of one of them. A sparse softmax regression
over hashed one- and two-word n-grams gives every window a probability for each licence family
and for the unknown class. It is trained here on variants of the templates, alone and with
ordinary words before and behind, and, as the unknown class, on windows drawn from the corpus; a
temperature fitted on set-aside variants calibrates it. A window predicted as a family counts
only if it also holds enough of the two-word sequences of a template of that family, and not
more of another family's.

At most ``MAX_UNKNOWN`` documents give windows for the unknown class (drawn by a hash of the
document id), each from a stretch of ``STRETCH`` words at a place of the whole text that a hash
chooses. Scoring covers every window of every text.

Defined results: null and empty texts have no paragraphs and no licence; without documents to
draw from, the unknown class is learned from scrambled templates alone; several families in
a text are all reported, the most probable first, equally probable ones in the order of
``FAMILIES``; texts of any length are read whole; repeated rows are reported each; further
columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmill.llm.text import Texts, chunks

# The opening words of public licence notices, by family.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the "
        "License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND",
    ],
    "mit": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the Software), to deal in the Software "
        "without restriction",
    ],
    "bsd": [
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
    ],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
    ],
    "lgpl": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU Lesser General Public License as published by the Free Software Foundation",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ],
    "cc-by-nc-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
        "International License.",
    ],
    "cc-by-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc0": [
        "To the extent possible under law, the author has waived all copyright and related or "
        "neighboring rights to this work.",
        "Released under CC0 1.0.",
    ],
    "reserved": [
        "All rights reserved.",
        "Copyright by the authors. All rights reserved.",
    ],
}
FAMILIES = tuple(TEMPLATES)
UNKNOWN = len(FAMILIES)

BUCKETS = 1 << 11
# Words of windows; they overlap by half.
WINDOWS = (8, 16, 32)
WINDOW = max(WINDOWS)
MIN_PROBABILITY = 0.5
# Share of a template's two-word sequences in a window, or of the window's in the template.
MIN_SHARED = 0.6
# Sequences that a window of fewer words is held to have.
FEWEST_PAIRS = 3
MAX_UNKNOWN = 2_000
STRETCH = sum(WINDOWS)
_PREFIXES = ("", "Note:", "This file is", "* ", "// ", "Code and text here:", "© 2020 A. Author.")
_WORD = re.compile(r"[a-z0-9][a-z0-9.\-]*")


def _pairs(text: str) -> set[tuple[str, str]]:
    return set(pairwise(w.strip(".-") for w in _WORD.findall(text.lower())))


_TEMPLATE_PAIRS = [[_pairs(t) for t in TEMPLATES[f]] for f in FAMILIES]


def template_share(text: str, family: int) -> float:
    """Best agreement of a window with a template of the family, 0 to 1."""
    own = _pairs(text)
    most = max(len(own), FEWEST_PAIRS)
    return max(len(own & t) / min(most, len(t)) for t in _TEMPLATE_PAIRS[family])


def confirmed(text: str, family: int) -> bool:
    """Whether a window holds a template of the family, and none of another better."""
    share = template_share(text, family)
    return share >= MIN_SHARED and all(template_share(text, k) <= share for k in range(UNKNOWN))


class Windows:
    """Windows of lines with their hashed n-grams, for a few texts.

    A line that fits into a window is one; longer windows of it would be the same.
    """

    def __init__(self, texts: Texts, sizes: tuple[int, ...] = WINDOWS):
        self.texts = texts
        lowered = Texts(texts.data, texts.offsets, lower=True)
        starts, ends, _ = texts.lines()
        first = np.searchsorted(texts.starts, starts)
        last = np.searchsorted(texts.starts, ends)
        firsts, lasts = [], []
        for size in sizes:
            stride = size // 2
            count = np.maximum(-(-(last - first - size) // stride), 0) + 1
            line = np.repeat(np.arange(len(first)), count)
            turn = np.arange(len(line)) - np.repeat(np.cumsum(count) - count, count)
            firsts.append(first[line] + turn * stride)
            lasts.append(np.minimum(firsts[-1] + size, last[line]))
            longer = last - first > size
            first, last = first[longer], last[longer]
        self.first, self.last = np.concatenate(firsts), np.concatenate(lasts)
        self.text = np.searchsorted(texts.first_word, self.first, side="right") - 1
        self.ones = (lowered.words % np.uint64(BUCKETS)).astype(np.int32)
        # A pair that crosses a border is in no window: windows end one word before it.
        self.twos = (lowered.windows(2)[0] % np.uint64(BUCKETS)).astype(np.int32)

    def __len__(self) -> int:
        return len(self.first)

    def read(self, i: int) -> str:
        begin, end = self.texts.starts[self.first[i]], self.texts.ends[self.last[i] - 1]
        return self.texts.data[begin:end].tobytes().decode("utf-8", "replace")

    def dense(self) -> np.ndarray:
        """Shares of the buckets in each window, for training."""
        x = np.zeros((len(self), BUCKETS), dtype=np.float32)
        for i in range(len(self)):
            for grams, last in ((self.ones, self.last[i]), (self.twos, self.last[i] - 1)):
                own = grams[self.first[i] : last]
                np.add.at(x[i], own, 1 / max(len(own), 1))
        return x

    def margins(self, weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
        total = np.tile(bias, (len(self), 1)).astype(np.float64)
        for grams, last in ((self.ones, self.last), (self.twos, self.last - 1)):
            upto = np.zeros((len(grams) + 1, len(bias)))
            np.cumsum(weights[grams], axis=0, out=upto[1:])
            n = np.maximum(last - self.first, 1)[:, None]
            total += (upto[np.maximum(last, self.first)] - upto[self.first]) / n
        return total


@dataclass(frozen=True)
class LicenceModel:
    """Weights by bucket and family, and the temperature."""

    weights: np.ndarray
    bias: np.ndarray
    temperature: float

    def probabilities(self, windows: Windows) -> np.ndarray:
        return _softmax(windows.margins(self.weights, self.bias) / self.temperature)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _windows_of(texts: list[str]) -> Windows:
    """Every text, none longer than a window, as one."""
    return Windows(next(iter(chunks(pa.array(texts), 1 << 40)))[1], (WINDOW,))


def _in_prose(template: list[str], ordinary: list[str], rng: np.random.Generator) -> list[str]:
    """Windows of each length that hold what they can of a template among ordinary words."""
    made = []
    for size in WINDOWS:
        for _ in range(8):
            words = template
            if len(words) > size - 2:
                at = int(rng.integers(0, len(words) - size // 2))
                words = words[at : at + size]
            room = max(size - len(words), 0)
            before = int(rng.integers(0, room + 1))
            at = int(rng.integers(0, max(len(ordinary) - 2 * size, 1)))
            around = ordinary[at : at + room]
            made.append(" ".join([*around[:before], *words, *around[before:]][:size]))
    return made


def _variants(ordinary: list[str]) -> tuple[list[str], list[int]]:
    """Templates alone and in prose, words left out, other case, and scrambled as unknown."""
    rng = np.random.default_rng(11)
    texts, labels = [], []
    for k, family in enumerate(FAMILIES):
        for template in TEMPLATES[family]:
            words = template.split()
            made = [f"{p} {template}".strip() for p in _PREFIXES]
            made += [template.upper(), template.lower()]
            for _ in range(6):
                keep = rng.random(len(words)) > 0.1
                made.append(" ".join(w for w, ok in zip(words, keep, strict=True) if ok))
            made = [" ".join(text.split()[:WINDOW]) for text in made]
            made += _in_prose(words, ordinary, rng)
            texts += made
            labels += [k] * len(made)
    every = [w for ts in TEMPLATES.values() for t in ts for w in t.split()]
    for _ in range(200):
        texts.append(" ".join(rng.choice(every, int(rng.integers(3, 20)))))
        labels.append(UNKNOWN)
    return texts, labels


def fit_licences(docs: DataFrame, max_unknown: int = MAX_UNKNOWN) -> LicenceModel:
    """Train on template variants and windows of a bounded draw of ``docs``."""
    total = docs.count()
    share = min(1.0, max_unknown / max(total, 1))
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 20)) < int(share * (1 << 20))
    # A stretch of a drawn document is enough to learn what ordinary text looks like.
    words = F.filter(
        F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda x: x != ""
    )
    place = F.pmod(F.xxhash64("doc_id"), F.greatest(F.size("words") - STRETCH, F.lit(0)) + 1) + 1
    picked = (
        docs.filter(drawn)
        .select("doc_id", words.alias("words"))
        .filter(F.size("words") > 0)
        .select(F.slice("words", place.cast("int"), STRETCH).alias("words"))
        .collect()
    )
    stretches = sorted(r["words"] for r in picked)
    ordinary, upto = [], np.cumsum([0, *WINDOWS]).tolist()
    for stretch in stretches:
        ordinary += [" ".join(stretch[a:b]) for a, b in pairwise(upto) if len(stretch) > a]
    # Windows that hold a licence notice themselves must not teach the unknown class.
    ordinary = [
        t for t in ordinary if max(template_share(t, k) for k in range(UNKNOWN)) < MIN_SHARED / 2
    ]
    texts, labels = _variants([w for t in ordinary for w in t.split()])
    texts += ordinary
    windows = _windows_of(texts)
    y = np.array(labels + [UNKNOWN] * len(ordinary))[windows.text]
    x = windows.dense()
    aside = np.arange(len(x)) % 4 == 3
    weights, bias = _train(x[~aside], y[~aside])
    margins = x[aside] @ weights + bias
    temperature = _temperature(margins, y[aside])
    return LicenceModel(weights, bias, temperature)


def _train(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Softmax regression by accelerated gradient descent, classes weighed alike."""
    target = np.eye(UNKNOWN + 1, dtype=np.float32)[y]
    weight = (1 / np.maximum(target.sum(axis=0), 1))[y][:, None].astype(np.float32)
    weight /= weight.sum()
    w = np.zeros((BUCKETS + 1, UNKNOWN + 1), dtype=np.float32)
    x = np.column_stack([x, np.ones(len(x), dtype=np.float32)])
    speed = np.zeros_like(w)
    for _ in range(300):
        ahead = w + 0.9 * speed
        gradient = x.T @ (weight * (_softmax(x @ ahead) - target)) + 1e-5 * ahead
        speed = 0.9 * speed - 4.0 * gradient
        w = w + speed
    return w[:-1], w[-1]


def _temperature(margins: np.ndarray, y: np.ndarray) -> float:
    """Temperature that makes the set-aside labels most likely."""
    choices = np.geomspace(0.2, 5, 60)
    likelihood = [
        np.log(_softmax(margins / t)[np.arange(len(y)), y] + 1e-12).sum() for t in choices
    ]
    return float(choices[int(np.argmax(likelihood))])


def _scan(texts: Texts, model: LicenceModel) -> tuple[np.ndarray, list[list[tuple[float, int]]]]:
    """Windows per text, and (probability, family) of the confirmed ones by text."""
    windows = Windows(texts)
    hits: list[list[tuple[float, int]]] = [[] for _ in range(texts.n)]
    if len(windows):
        p = model.probabilities(windows)
        family = p.argmax(axis=1)
        likely = np.flatnonzero((family != UNKNOWN) & (p.max(axis=1) >= MIN_PROBABILITY))
        for i in likely.tolist():
            if confirmed(windows.read(i), int(family[i])):
                hits[windows.text[i]].append((float(p[i, family[i]]), int(family[i])))
    return np.bincount(windows.text, minlength=texts.n), hits


def scan_licences(docs: DataFrame, model: LicenceModel) -> DataFrame:
    """``doc_id``, ``n_windows``, ``n_hits``, ``family``, ``probability``, ``families``.

    ``family`` is the most probable confirmed family, ``none`` without one.
    """

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in chunks(batch.column(1)):
                n_windows, hits = _scan(texts, model)
                best, probability, families = [], [], []
                for own in hits:
                    ranked: dict[int, float] = {}
                    for p, k in sorted(own, key=lambda h: (-h[0], h[1])):
                        ranked.setdefault(k, p)
                    names = [FAMILIES[k] for k in ranked]
                    best.append(names[0] if names else "none")
                    probability.append(next(iter(ranked.values()), 0.0))
                    families.append(names)
                columns = [
                    batch.column(0)[rows],
                    pa.array(n_windows.astype(np.int64)),
                    pa.array([len(h) for h in hits], pa.int64()),
                    pa.array(best, pa.string()),
                    pa.array(probability, pa.float64()),
                    pa.array(families, pa.list_(pa.string())),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=COLUMNS)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        compute,
        f"doc_id {kind}, n_windows long, n_hits long, family string, probability double, "
        "families array<string>",
    )


COLUMNS = ["doc_id", "n_windows", "n_hits", "family", "probability", "families"]
