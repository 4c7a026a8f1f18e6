"""Licence scan: a trained paragraph classifier, confirmed by comparison with templates.

A paragraph is a line with a word, and `n_paragraphs` counts the lines that are not blank. A notice wrapped over
several lines is found in the run of neighbouring lines with words (comment marks aside): where
a stretch of at most `STRETCH` times a template's words holds enough of it, the stretch is
scored like a paragraph, and its span is the lines that it touches. Features are the words, pairs and triples of words that
the templates hold (a sparse vector; others weigh nothing). A multinomial logistic
regression over licence families and an unknown class is fitted on the templates with
words left out, cut ends and words around them, against lines of a bounded sample of the corpus
(at most `FIT_LINES` lines, evenly from all lines of `FIT_DOCS` documents with the lowest hashes of their ids, of any length, long ones by
excerpts spread over the whole text; of an id with several texts the one with the lowest hash) and sentences that only talk about licences. Its temperature is
calibrated on a part of the data that the fit has not seen.

A prediction counts if it is a family with probability `LEAST` or more, and the paragraph
holds at least `CONTAINED` of the word triples of one of that family's templates (pairs or words,
for shorter ones). Every paragraph that holds so much of any template is scored; no other could be confirmed.

Cases: a null or empty text has no paragraphs and no licence; rows may repeat; null keys
stay; an empty table gives an empty result (and the model is fitted on templates alone);
only the named columns are read, so extra columns cannot clash; whole texts of any length
are scanned.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict, deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bourseline.llm.byte_bpe import sliced
from bourseline.llm.quality_cnn import sampled

FIT_DOCS, FIT_LINES = 300, 1500
LEAST, CONTAINED = 0.5, 0.6
STRETCH = 2  # words of a wrapped notice over those of its template, at most
COPIES, STEPS, RATE, SEED = 40, 300, 0.5, 5
UNKNOWN = "unknown"

FSF = "you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
# Short notices in common use, by family.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.", "Licensed under the MIT License.", "This project is licensed under the terms of the MIT license.", "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Released under the Apache 2.0 license.", "SPDX-License-Identifier: Apache-2.0",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.", "Licensed under the GPLv3.", "Released under the GNU GPL v3 or later.", "SPDX-License-Identifier: GPL-3.0-or-later",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2.", "Licensed under the GPLv2.", "SPDX-License-Identifier: GPL-2.0-only", FSF.format("General Public License", "2")],
    "LGPL": ["Licensed under the GNU Lesser General Public License, version 2.1.", "Licensed under the GNU Lesser General Public License, version 3.", "SPDX-License-Identifier: LGPL-2.1-or-later", FSF.format("Lesser General Public License", "2.1"), FSF.format("Lesser General Public License", "3")],
    "AGPL-3.0": ["Licensed under the GNU Affero General Public License, version 3.", "SPDX-License-Identifier: AGPL-3.0-only", FSF.format("Affero General Public License", "3")],
    "BSD": [
        "Released under the BSD License.", "Licensed under the 3-clause BSD license.", "Licensed under the 2-clause BSD license.", "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License 2.0.", "SPDX-License-Identifier: MPL-2.0"],
    "CC-BY": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "SPDX-License-Identifier: CC-BY-4.0"],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC0": ["Released under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related rights to this work.", "Dedicated to the public domain under CC0."],
    "Proprietary": ["All rights reserved.", "Copyright 2020 Example Company. All rights reserved.", "This material may not be published, broadcast, rewritten or redistributed without permission."],
}
# Short names; each is granted by each of the verbs.
NAMES = {
    "MIT": ["MIT"], "Apache-2.0": ["Apache 2.0", "the Apache License 2.0"], "GPL-3.0": ["GPLv3", "the GNU GPLv3", "GPL-3.0"], "GPL-2.0": ["GPLv2", "the GNU GPLv2", "GPL-2.0"],
    "LGPL": ["LGPLv2.1", "LGPLv3"], "AGPL-3.0": ["AGPLv3", "the GNU AGPLv3"], "BSD": ["BSD-3-Clause", "BSD-2-Clause"], "MPL-2.0": ["MPL 2.0"], "CC-BY": ["CC BY 4.0"], "CC-BY-SA": ["CC BY-SA 4.0"],
    "CC-BY-NC": ["CC BY-NC 4.0"], "CC0": ["CC0"],
}
for _family, _names in NAMES.items():
    _more = [f"{verb} under {name}." for name in _names for verb in ("Released", "Licensed", "Distributed", "Available")]
    TEMPLATES[_family] += [t for t in _more if t not in TEMPLATES[_family]]
# Sentences that talk about licences without granting one.
OTHERS = [
    "She renewed her driving license last week.", "The licensing board met on Monday to discuss the new rules.", "A license is a permission to do something.", "Copyright law differs from country to country.",
    "He asked for permission to leave the room.", "The public library opened its doors.", "The general public was not admitted.", "The warranty covers parts and labour for two years.",
    "Which license should I choose for my project?", "The software was redistributed to all offices.", "We compared the MIT License with the Apache License.", "Version 2.0 of the manual was published in May.",
    "The commons were used for grazing.", "The license fee rose by two per cent.", "Reserved seats can be collected at the door.", "Fishing without a licence is not permitted here.",
]
# Lines with one of these do not serve the fit as examples of the unknown class.
CUES = ["licen", "copyright", "rights reserved", "redistribut", "permission", "public domain", "spdx", "cc0", "source code form"]
MARK = re.compile(r"^\s*(?:dnl|rem|c)\s+(?=\S)", re.IGNORECASE)  # comment marks that are words; others are none
WORD = re.compile(r"[^\W_]+(?:[.'+][^\W_]+)*")


def words(line: str) -> list[str]:
    return WORD.findall(line.lower())


def grams(own: list[str], most: int = 3) -> set[tuple[str, ...]]:
    return {tuple(own[i : i + n]) for n in range(1, most + 1) for i in range(len(own) - n + 1)}


@dataclass
class Model:
    places: dict[tuple[str, ...], int]
    known: set[str]
    weights: np.ndarray  # features and a bias, by class
    families: list[str]  # the last is the unknown class
    temperature: float
    templates: dict[str, list[set[tuple[str, ...]]]]

    def __post_init__(self) -> None:
        every = [t for own in self.templates.values() for t in own]
        self.sizes = [len(t) for t in every]
        self.lengths = [len(t) + len(next(iter(t))) - 1 for t in every]
        self.holders: dict[tuple[str, ...], list[int]] = defaultdict(list)
        for i, t in enumerate(every):
            for g in t:
                self.holders[g].append(i)
        self.holders = dict(self.holders)
        self.widths = sorted({len(g) for g in self.holders})

    def met(self, own: list[str]) -> list[tuple[int, tuple[str, ...]]]:
        """(place, n-gram) of the words' n-grams that templates are compared by, in order of places for each length."""
        return [(i, g) for n in self.widths for i, g in enumerate(zip(*(own[k:] for k in range(n)))) if g in self.holders]

    def holds(self, found: set[tuple[str, ...]]) -> bool:
        """Whether these n-grams are `CONTAINED` of any template."""
        counts: dict[int, int] = defaultdict(int)
        for g in found:
            for t in self.holders[g]:
                counts[t] += 1
        return any(n / self.sizes[t] >= CONTAINED for t, n in counts.items())

    def logits(self, own: list[str]) -> np.ndarray:
        out = self.weights[-1].copy()
        found = {self.places[g] for g in grams(own) if g in self.places} if not self.known.isdisjoint(own) else ()
        for i in found:
            out += self.weights[i]
        return out

    def classify(self, line: str) -> tuple[str, float, float] | None:
        """(family, probability, share of a template held) of a paragraph whose prediction is confirmed."""
        return self.classify_words(words(line))

    def classify_words(self, own: list[str]) -> tuple[str, float, float] | None:
        if not self.holds({g for _, g in self.met(own)}):
            return None
        z = self.logits(own) / self.temperature
        p = np.exp(z - z.max())
        p /= p.sum()
        best = int(p.argmax())
        if self.families[best] == UNKNOWN or p[best] < LEAST:
            return None
        have = {n: grams_of(own, n) for n in (1, 2, 3)}
        share = max(len(t & have[len(next(iter(t)))]) / len(t) for t in self.templates[self.families[best]])
        return (self.families[best], float(p[best]), share) if share >= CONTAINED else None


    def stretches(self, found: list[tuple[int, tuple[str, ...]]]) -> list[tuple[int, int]]:
        """First and last word of the stretches that hold enough of a template, from what `met` gives."""
        own: dict[int, list[tuple[int, tuple[str, ...]]]] = defaultdict(list)
        for i, g in found:
            for t in self.holders[g]:
                own[t].append((i, g))
        out = set()
        for t, places in own.items():
            if len({g for _, g in places}) / self.sizes[t] < CONTAINED:
                continue
            most, inside, have = STRETCH * self.lengths[t], deque(), Counter()
            for i, g in [*places, (None, None)]:
                far = i is None or inside and i + len(g) - inside[0][0] > most
                if len(have) / self.sizes[t] >= CONTAINED and (far or g in have):
                    out.add((inside[0][0], inside[-1][0] + len(inside[-1][1]) - 1))
                    inside.clear()
                    have.clear()
                if i is None:
                    break
                inside.append((i, g))
                have[g] += 1
                while i + len(g) - inside[0][0] > most or have[inside[0][1]] > 1:
                    first = inside.popleft()[1]
                    have[first] -= 1
                    if not have[first]:
                        del have[first]
        return sorted(out)

    def wrapped(self, run: list[tuple[int, int, list[str]]]) -> list[tuple[int, int, tuple[str, float, float]]]:
        """Start, end and prediction of the notices that go over several of the neighbouring lines (start, end, words)."""
        own = [w for _, _, line in run for w in line]
        line_of = [n for n, (_, _, line) in enumerate(run) for _ in line]
        out = []
        for first, last in self.stretches(self.met(own)):
            a, b = line_of[first], line_of[last]
            best = self.classify_words(own[first : last + 1]) if a < b else None
            if best:
                out.append((run[a][0], run[b][1], best))
        return out

    def spans(self, text: str) -> tuple[int, list[dict]]:
        """How many lines are not blank, and the confirmed notices in order; those of a family that overlap are one."""
        at, n, run, found = 0, 0, [], []
        for line in [*text.split("\n"), ""]:
            n += bool(line) and not line.isspace()
            own = words(line)
            if own:
                best = self.classify_words(own)
                found += [(at, at + len(line), best)] if best else []
                mark = MARK.match(line)
                run.append((at, at + len(line), words(line[mark.end() :]) if mark else own))
            else:
                found += self.wrapped(run) if len(run) > 1 else []
                run = []
            at += len(line) + 1
        out: list[dict] = []
        last: dict[str, dict] = {}
        for start, end, (family, p, share) in sorted(found):
            if family in last and start < last[family]["end"]:
                same = last[family]
                same.update(end=max(end, same["end"]), probability=max(p, same["probability"]), contained=max(share, same["contained"]))
            else:
                last[family] = {"start": start, "end": end, "family": family, "probability": p, "contained": share}
                out.append(last[family])
        return n, out


def grams_of(own: list[str], n: int) -> set[tuple[str, ...]]:
    return {tuple(own[i : i + n]) for i in range(len(own) - n + 1)}


def fit(corpus_lines: list[str]) -> Model:
    rng = np.random.default_rng(SEED)
    families = [*TEMPLATES, UNKNOWN]
    vocabulary = sorted(set().union(*(grams(words(t)) for own in TEMPLATES.values() for t in own)))
    places = {g: i for i, g in enumerate(vocabulary)}
    templates = {f: [grams_of(own, min(3, len(own))) for own in map(words, TEMPLATES[f])] for f in TEMPLATES}
    gate = Model(places, set(), np.zeros((0, 0)), families, 1.0, templates)
    plain = [words(x) for x in corpus_lines if not any(c in x.lower() for c in CUES)]
    plain = [own for own in plain if not gate.holds({g for _, g in gate.met(own)})]
    filler = [w for x in plain[:200] for w in x] or ["and"]
    rows: list[tuple[list[str], int]] = []
    for k, family in enumerate(TEMPLATES):
        for template in TEMPLATES[family]:
            own = words(template)
            rows += [(own, k)] * 4
            for _ in range(COPIES):
                some = [w for w in own if rng.random() > 0.08]
                if len(some) > 12:
                    some = some[int(rng.integers(0, len(some) // 3)) :][: int(rng.integers(len(some) // 2, len(some) + 1))]
                around = [filler[int(i)] for i in rng.integers(0, len(filler), int(rng.integers(0, 8)))]
                cut = int(rng.integers(0, len(around) + 1))
                rows.append((around[:cut] + some + around[cut:], k))
    unknown = len(families) - 1
    rows += [(x, unknown) for x in plain[:: max(1, -(-len(plain) // FIT_LINES))]] + [(words(x), unknown) for x in OTHERS for _ in range(COPIES)]
    x = np.zeros((len(rows), len(vocabulary) + 1), dtype=np.float32)
    x[:, -1] = 1
    for i, (own, _) in enumerate(rows):
        x[i, [places[g] for g in grams(own) if g in places]] = 1
    y = np.array([k for _, k in rows])
    seen = rng.random(len(rows)) < 0.8
    # Every family weighs the same.
    share = 1 / np.bincount(y[seen], minlength=len(families))[y[seen]]
    share /= share.sum()
    w = np.zeros((x.shape[1], len(families)), dtype=np.float32)
    goal = np.eye(len(families), dtype=np.float32)[y[seen]]
    speed = np.zeros_like(w)
    fitted = x[seen]
    for _ in range(STEPS):
        z = fitted @ w
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        speed = 0.9 * speed - RATE * (fitted.T @ ((p - goal) * share[:, None]) + 1e-4 * w)
        w += speed
    z = x[~seen] @ w

    def loss(t: float) -> float:
        s = z / t
        s = s - s.max(1, keepdims=True)
        return float(-(s[np.arange(len(s)), y[~seen]] - np.log(np.exp(s).sum(1))).mean())

    temperature = min((0.1, 0.2, 0.3, 0.5, 0.7, 1.0, 1.5, 2.0), key=loss)
    known = {w for g in vocabulary for w in g}
    return Model(places, known, w.astype(np.float64), families, temperature, templates)


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", most: int = FIT_DOCS) -> Model:
    """Fit with lines of at most `most` documents, those with the lowest hashes of their keys."""
    ids = docs.where(F.col(key).isNotNull()).select(key).distinct().orderBy(F.xxhash64(key), key).limit(most)  # ids first: other texts stay where they are
    few = sampled(docs, ids.withColumn("_one", F.lit(1)), key, text, "_one").orderBy("h", "t").collect()  # at most `most`, of bounded size
    return fit([line for r in few for line in bytes(r["t"]).decode("utf-8", "ignore").split("\n") if words(line)])


def scan(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key`, `n_paragraphs` and `licences` (start and end in code points, family, probability, contained), one row per row."""
    span = "struct<start:bigint,`end`:bigint,family:string,probability:double,contained:double>"
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("family", pa.string()), ("probability", pa.float64()), ("contained", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, 1):
                counts, spans = [], []
                for t in part.column(1).to_pylist():
                    n, own = model.spans(t or "")
                    counts.append(n)
                    spans.append(own)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counts, pa.int64()), pa.array(spans, kind)], names=[key, "n_paragraphs", "licences"])

    own = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {own}, n_paragraphs long, licences array<{span}>")
