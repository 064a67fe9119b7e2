"""License scans: lines and runs of lines classified by licence family, confirmed by templates.

A softmax regression over the words and word pairs of the templates tells families apart; what no
template has, and how much of a paragraph that is, speaks for the class unknown, which is learned
from paragraphs of the corpus. A family is reported only if a template of it confirms it.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulgrid.llm.common import table

UNKNOWN = "unknown"
#: Paragraphs of the corpus that the class unknown is learned from, at most about.
SAMPLE = 4000
#: Documents that these are taken from, at most about.
SAMPLE_DOCS = 2000
VARIANTS = 60
PROBABILITY = 0.5
#: Share of a template's words and word pairs that a paragraph must have.
CONFIRMED = 0.6
#: So many of them at least, or all of a shorter template's, as a few common words confirm nothing.
LEAST_GRAMS = 5

#: The usual notices of licence families, as projects state them.
TEMPLATES = {
    "AGPL-3.0": [
        "GNU Affero General Public License",
        "Licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "Apache-2.0": [
        "Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Released under the Apache License 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "BSD": [
        "Released under the BSD License.",
        "Licensed under the 3-Clause BSD License.",
        "Licensed under the 2-Clause BSD License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "CC-BY": [
        "CC BY 4.0",
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-NC": [
        "CC BY-NC 4.0",
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-SA": [
        "CC BY-SA 4.0",
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "CC0 1.0 Universal",
        "Released under CC0 1.0 Universal.",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 2.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "GNU General Public License",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "LGPL": [
        "GNU Lesser General Public License",
        "Licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
    ],
    "MIT": [
        "The MIT License (MIT)",
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "SPDX-License-Identifier: MIT",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Mozilla Public License, version 2.0",
        "Licensed under the Mozilla Public License, version 2.0.",
    ],
    "Proprietary": [
        "All rights reserved.",
        "All rights reserved. No part of this publication may be reproduced or distributed without prior written permission.",
    ],
    "Unlicense": [
        "Released under the Unlicense.",
        "This is free and unencumbered software released into the public domain.",
    ],
}

_WORD = re.compile(r"[^\W_]+")


def grams(words: list[str]) -> set:
    """The words and the pairs of neighbouring words."""
    return {*words, *zip(words, words[1:])}


def words_of(paragraph: str) -> list[str]:
    return _WORD.findall(paragraph.lower())


def paragraphs(text: str | None) -> list[str]:
    """The lines of a whole text that have something in them."""
    return [line for line in (text or "").split("\n") if line.strip()]


def blocks(text: str | None) -> list[list[tuple[int, str, list[str]]]]:
    """The lines of a text as (place, line, words), in runs that lines without words separate.

    The place counts the lines that have something in them.
    """
    found, place, ended = [], 0, True
    for line in (text or "").split("\n"):
        words = words_of(line)
        if words:
            if ended:
                found.append([])
            found[-1].append((place, line, words))
        ended = not words
        place += bool(line.strip())
    return found


class Licenses:
    """Softmax regression over the templates' grams, with a temperature, and the templates."""

    def __init__(self, templates: dict[str, list[str]]):
        self.families = [UNKNOWN, *sorted(templates)]
        self.templates = {
            family: [grams(words_of(text)) for text in texts] for family, texts in templates.items()
        }
        every = set().union(*[found for texts in self.templates.values() for found in texts])
        self.number = {gram: at for at, gram in enumerate(sorted(every, key=str))}
        #: Words of the longest notice: how far a notice may reach over line breaks.
        self.reach = max((len(words_of(text)) for texts in templates.values() for text in texts), default=0)
        # Besides the grams: the share of a paragraph's grams that no template has, and a constant.
        self.weights = np.zeros((len(self.number) + 2, len(self.families)))
        self.temperature = 1.0

    def _entries(self, found: set) -> tuple[list[int], float]:
        known = found & self.number.keys()
        return [self.number[gram] for gram in known], 1 - len(known) / max(len(found), 1)

    def _scores(self, known: list[int], strange: float) -> np.ndarray:
        return self.weights[known].sum(axis=0) + strange * self.weights[-2] + self.weights[-1]

    def fit(self, examples: list[set], labels: list[int], steps: int = 150, ridge: float = 1e-3) -> None:
        """Gradient steps on three quarters of the examples, the temperature on the last quarter."""
        entries = [self._entries(found) for found in examples]
        matrix = np.zeros((len(entries), len(self.weights)), "f4")
        for row, (known, strange) in enumerate(entries):
            matrix[row, known] = 1
            matrix[row, -2:] = strange, 1
        target = np.eye(len(self.families), dtype="f4")[labels]
        held = np.arange(len(entries)) % 4 == 3
        x, y = matrix[~held], target[~held]
        # Each family weighs the same, or the many unknown paragraphs would drown the rest.
        weight = (1 / np.maximum(y.sum(axis=0), 1))[y.argmax(axis=1)]
        weight = (weight / weight.sum())[:, None]
        scale = (x * weight * x.sum(axis=1, keepdims=True)).sum(axis=0)[:, None] / 2 + ridge
        for _ in range(steps):
            errors = (_softmax(x @ self.weights) - y) * weight
            self.weights -= (x.T @ errors + ridge * self.weights) / scale
        scores = matrix[held] @ self.weights
        losses = {
            t: -np.log(np.maximum((_softmax(scores / t) * target[held]).sum(axis=1), 1e-9)).mean()
            for t in (0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0)
        }
        self.temperature = min(losses, key=losses.get) if held.any() else 1.0

    def classify(self, paragraph: str) -> tuple[str, float]:
        """(family, probability); unknown unless a template of the family confirms it."""
        return self._classified(grams(words_of(paragraph)))

    def _classified(self, found: set) -> tuple[str, float]:
        known, strange = self._entries(found)
        if not known:
            return UNKNOWN, 0.0
        shares = _softmax(self._scores(known, strange)[None] / self.temperature)[0]
        best = int(shares[1:].argmax()) + 1
        if shares[best] < PROBABILITY or not self.confirms(self.families[best], found):
            return UNKNOWN, 0.0
        return self.families[best], float(shares[best])

    def confirms(self, family: str, found: set) -> bool:
        """Whether most of some template is in the paragraph."""
        return any(
            len(found & template) >= max(CONFIRMED * len(template), min(LEAST_GRAMS, len(template)))
            for template in self.templates[family]
        )

    def scan(self, text: str | None) -> list[tuple[int, str, float, str]]:
        """(place, family, probability, paragraph) of each line that is a notice, and of each run of
        lines over which one is wrapped; a run has no line that is a notice by itself."""
        out = []
        for block in blocks(text):
            rest: list = []
            for line in block:
                family, probability = self._classified(grams(line[2]))
                if family != UNKNOWN:
                    out.append((line[0], family, probability, line[1]))
                    out += self._wrapped(rest)
                    rest = []
                else:
                    rest.append(line)
            out += self._wrapped(rest)
        return sorted(out)

    def _wrapped(self, lines: list) -> list[tuple[int, str, float, str]]:
        """The runs of two lines or more that are notices, closest to a template first, none twice."""
        # What confirms a template has a pair of its words; where no line begins one, none is near.
        pairs = [
            any(pair in self.number for pair in zip(words, [*words[1:], *(lines[at + 1][2][:1] if at + 1 < len(lines) else [])]))
            for at, (_, _, words) in enumerate(lines)
        ]
        runs = []
        for first in range(len(lines) - 1):
            if not pairs[first]:
                continue
            # Of the first and last line only what is near the break can belong to the notice.
            words = lines[first][2][-self.reach:]
            for last in range(first + 1, len(lines)):
                found = grams([*words, *lines[last][2][:self.reach]])
                family, probability = self._classified(found)
                if family != UNKNOWN:
                    close = max(len(found & t) / len(found | t) for t in self.templates[family])
                    runs.append((-close, first, last, family, probability))
                words = [*words, *lines[last][2]]
                if len(words) - len(lines[first][2][-self.reach:]) >= self.reach:
                    break
        out, taken = [], set()
        for _, first, last, family, probability in sorted(runs):
            if taken.isdisjoint(range(first, last + 1)):
                taken.update(range(first, last + 1))
                paragraph = "\n".join(line for _, line, _ in lines[first:last + 1])
                out.append((lines[first][0], family, probability, paragraph))
        return out


def _softmax(scores: np.ndarray) -> np.ndarray:
    power = np.exp(scores - scores.max(axis=1, keepdims=True))
    return power / power.sum(axis=1, keepdims=True)


def variants(templates: dict[str, list[str]], filler: list[str], seed: int = 3):
    """Templates as they occur: whole, with words lost or changed, within other words."""
    random = np.random.default_rng(seed)
    filler = np.array(filler)
    for family in sorted(templates):
        for text in templates[family]:
            words = words_of(text)
            for number in range(VARIANTS):
                loss = 0.0 if number % 3 == 0 else random.uniform(0, 0.25)
                kept = [word for word in words if random.random() >= loss] or words
                if len(filler) and number % 2:
                    extra = random.choice(filler, random.integers(1, 12)).tolist()
                    at = random.integers(len(extra) + 1)
                    kept = [*extra[:at], *kept, *extra[at:]]
                yield family, kept


def fit_licenses(docs: DataFrame, templates: dict[str, list[str]] | None = None) -> Licenses:
    """Fit on variants of the templates and on paragraphs of the documents (text).

    The paragraphs come from a draw of documents by hash and are drawn by hash themselves, at most
    about ``SAMPLE``; those that a template confirms are no examples of unknown.
    """
    templates = TEMPLATES if templates is None else templates
    model = Licenses(templates)
    texts = docs.select(F.col("text").cast("string").alias("text")).where("text is not null")
    share = min(1.0, SAMPLE_DOCS / max(texts.count(), 1))
    drawn = texts.where(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < int(share * 1_000_000))
    lines = drawn.select(F.explode(F.split("text", "\n")).alias("line")).where("trim(line) <> ''").distinct()
    lines = lines.withColumn("h", F.xxhash64("line")).orderBy("h", "line").limit(SAMPLE).select("line")
    others = [words_of(row["line"]) for row in lines.collect()]
    examples, labels = [], []
    filler = sorted({word for words in others for word in words})
    for family, words in variants(templates, filler):
        examples.append(grams(words))
        labels.append(model.families.index(family))
    for words in others:
        found = grams(words)
        if words and not any(model.confirms(family, found) for family in templates):
            examples.append(found)
            labels.append(0)
    order = np.random.default_rng(4).permutation(len(examples))
    model.fit([examples[i] for i in order], [labels[i] for i in order])
    return model


def license_scan(docs: DataFrame, templates: dict[str, list[str]] | None = None) -> DataFrame:
    """Add n_paragraphs, licenses and families to each row of ``docs`` (text).

    n_paragraphs counts the lines that are not blank. licenses lists what was found in the whole
    text: place of the line, family, probability and the line; of a notice wrapped over a run of
    lines the first one's place and all of them. families has the different families, sorted. A NULL or empty text has no paragraph. Repeated rows come out alike. Other columns pass
    through, but for those of the three names, which are replaced.
    """
    model = fit_licenses(docs, templates)

    @F.pandas_udf(
        "n_paragraphs int, licenses array<struct<place:int,family:string,probability:double,paragraph:string>>,"
        " families array<string>"
    )
    def scanned(texts: pd.Series) -> pd.DataFrame:
        out = []
        for text in texts:
            found = [dict(zip(("place", "family", "probability", "paragraph"), row)) for row in model.scan(text)]
            out.append((len(paragraphs(text)), found, sorted({row["family"] for row in found})))
        return pd.DataFrame(out, columns=["n_paragraphs", "licenses", "families"])

    mine = [name for name in docs.columns if name not in ("n_paragraphs", "licenses", "families")]
    free = "_".join(["_", *mine])
    return docs.select(*mine).withColumn(free, scanned(F.col("text").cast("string"))).select(*mine, f"{free}.*")


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence families found in every document."""
    found = license_scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", F.col("n_paragraphs").cast("long").alias("n_paragraphs"),
        F.size("licenses").cast("long").alias("n_licensed"),
        F.array_join("families", ",").alias("families"),
        F.array_max("licenses.probability").alias("score"),
    )
