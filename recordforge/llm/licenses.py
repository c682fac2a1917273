"""License scans: a sparse n-gram logistic regression over paragraphs, confirmed by templates.

Native: DataFrame functions only, all in the scan's own stage; no shuffle.

A paragraph is a line of a text, joined with the lines that it is wrapped over: a line break after
a long line that does not end a sentence is a space, and so are comment marks at its beginning. Paragraphs with a
word that licences use are scored by a multinomial logistic regression over word 1- and 2-grams, fitted on the driver to
TRAIN_LINES lines that a seeded generator makes of the sentences below and of lines about other things. Its
temperature is calibrated on lines held out. The best family counts if its probability reaches SURE and the
paragraph holds at least CONFIRM of the word pairs, in order, of one of the family's sentences; a paragraph
that is a notice with probability SURE, but no family's, is ``unknown``.
"""

from __future__ import annotations

import json
import re

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

# Texts and notices of public licence families.
TEMPLATES = {
    "agpl": [
        "This program is licensed under the GNU Affero General Public License, version 3.", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation.",
    ],
    "apache": [
        "Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "See the License for the specific language governing permissions and limitations under the License.", "SPDX-License-Identifier: Apache-2.0", "Apache License Version 2.0, January 2004.",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
        "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES.",
        "Copyright (c) 1991 The Regents of the University of California. All rights reserved.", "SPDX-License-Identifier: BSD-2-Clause", "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "cc0": [
        "This work is dedicated to the public domain under CC0 1.0 Universal.", "To the extent possible under law, the author has waived all copyright under CC0.",
        "To the extent possible under law, the person who associated CC0 with this work has waived all copyright and related or neighboring rights to this work.",
    ],
    "cc-by": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "SPDX-License-Identifier: CC-BY-4.0"],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.", "This program is free software under the terms of the GNU GPL version 2 or later.",
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991.", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
        "You should have received a copy of the GNU General Public License along with this program.", "SPDX-License-Identifier: GPL-3.0-only", "SPDX-License-Identifier: GPL-2.0-or-later",
    ],
    "isc": [
        "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.", "SPDX-License-Identifier: ISC",
    ],
    "lgpl": [
        "Licensed under the GNU Lesser General Public License, version 2.1.", "This library is licensed under the LGPL.", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999.", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
    ],
    "mit": [
        "Released under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE.", "SPDX-License-Identifier: MIT",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the MPL 2.0.", "Mozilla Public License Version 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0.",
    ],
    "proprietary": ["All rights reserved.", "Copyright 2020 Example Inc. All rights reserved.", "Proprietary and confidential. Unauthorized copying is prohibited.", "Unauthorized copying of this file, via any medium, is strictly prohibited."],
}
# Short names of families, and how notices in several languages use them.
NAMES = {
    "agpl": ["AGPL", "AGPLv3", "GNU AGPL"], "apache": ["Apache", "Apache 2.0"], "bsd": ["BSD", "BSD 3-Clause", "BSD 2-Clause"], "cc0": ["CC0"], "cc-by": ["CC BY", "CC-BY"], "cc-by-nc": ["CC BY-NC"], "cc-by-sa": ["CC BY-SA"],
    "gpl": ["GPL", "GPLv3", "GPLv2", "GNU GPL"], "isc": ["ISC"], "lgpl": ["LGPL", "GNU LGPL"], "mit": ["MIT"], "mpl": ["MPL", "MPL 2.0"],
}
USES = [
    "Released under the {} License.", "Licensed under the {} licence.", "Licensed under {}.", "License: {}", "under the terms of the {} license", "steht unter der {}-Lizenz", "Lizenziert unter der {} Lizenz", "Veröffentlicht unter {} Lizenz",
    "sous licence {}", "publié sous la licence {}", "distribué sous licence {}", "Distributed under the {} license.", "bajo la licencia {}", "publicado con licencia {}", "con licenza {}",
]
# Notices of no family above, and lines with words of licences that are no notices.
OTHER = [
    "Licensed under the Example Community License, version 1.", "Released under the terms of the {w} public licence.", "This file is distributed under the {w} License.", "Distribué sous licence {w} {w}.", "Steht unter der {w}-Lizenz.",
    "Use is governed by the {w} license agreement.", "Licensed to {w} under one or more contributor agreements.", "Distributed under the {w} software licence, see {w}.", "Licensed under the {w} License.", "Bajo la licencia {w} {w}.",
]
NONE = [
    "He lost his driving license in {w}.", "The license plate of the {w} was {w}.", "A fishing licence costs {n} euros.", "She studied at MIT and {w}.", "An apache helicopter flew over {w}.",
    "The {w} has permission to {w} the house.", "The warranty of the {w} ended in {n}.", "Civil rights were reserved for {w}.", "The public was free to copy the {w}.", "The {w} of the general public is {w}.",
    "Copyright law was discussed in the {w}.", "The bar lost its licence to sell {w}.", "Poetic license is allowed in {w}.", "The seats are reserved for all {w}.", "He was licensed to teach in {n}.",
    "{w} mit {w} {w}.", "Mit {w} und {w}.", "{w} der {w} mit dem {w}, {w}.", "The {w} software is free of {w} errors.", "Without {w} the damages were {n} euros, or other claims of {w}.", "They distribute {w} and modify the {w}.",
    "The author is liable for {w}.", "The source of the {w} river is in {w}.", "Conditions in the {w} were bad; {w}.", "La licencia de {w} cuesta {n}.", "Der Führerschein ist keine Lizenz zum {w}.", "Il a une licence de {w} depuis {n}.",
    "The university of {w} has {n} students.", "Version {n} of the {w} was published by {w}.", "{w} {w} {w} {w} {w}.", "See the notice on the {w}; permission was denied in {n}.", "The GNU is an animal of {w}.",
]
#: Words that a notice has: others are not looked at.
ANCHOR = (
    r"\bMIT\b|(?i:li[cz]en[scz]|copyright|copyleft|\bgpl|\blgpl|\bagpl|\bgnu\b|apache|creative commons|\bcc[ -]?(?:by|0)|public domain|rights reserved|permission|redistribut|proprietary|\bmpl\b|\bspdx"
    r"|warrant(?:y|ies)|\bliable\b|noninfringement|merchantability|unauthorized copying|contributors may)"
)
#: One of these stands, in lower case, wherever ANCHOR matches (``MIT`` as it is): a search that needs no regular expression.
HINTS = (
    "licen", "lizen", "copyright", "copyleft", "gpl", "gnu", "apache", "creative commons", "cc by", "cc-by", "ccby", "cc 0", "cc-0", "cc0", "public domain", "rights reserved", "permission", "redistribut", "proprietary", "mpl",
    "spdx", "warrant", "liable", "noninfringement", "merchantability", "unauthorized copying", "contributors may",
)
#: A line break that only wraps a paragraph, with what it is made up of: blanks and comment marks.
WRAP = r"\n(?<=[^\n]{40}\n)(?<![.!?:;]\n)(?<![.!?:;]\r\n)(?<![.!?:;] \n)[ \t]*(?:[*#/;%-]+[ \t]+)?(?=[^\s*#/;%-])"
WORD = r"[a-z0-9][a-z0-9.+-]*[a-z0-9+]|[a-z0-9]"
TRAIN_LINES, STEPS, L2 = 6000, 250, 1e-4
SURE, CONFIRM = 0.7, 0.6
UNKNOWN = "unknown"


def words(text: str) -> list[str]:
    return re.findall(WORD, text.lower(), re.ASCII)


def ngrams(text: str) -> list[str]:
    """Distinct word 1- and 2-grams."""
    w = words(text)
    return list(dict.fromkeys([*w, *map(" ".join, zip(w, w[1:]))]))


def pairs(text: str) -> list[str]:
    """Distinct word 2-grams: what confirms, as it keeps the order of words."""
    w = words(text)
    return list(dict.fromkeys(map(" ".join, zip(w, w[1:]))))


def sentences() -> dict[str, list[str]]:
    """What confirms a family: its texts, the sentences of long ones, and the uses of its names."""
    out = {}
    for family, texts in TEMPLATES.items():
        parts = [p for t in texts for p in [t, *re.split(r"[.;:] |, (?=EITHER|either|INCLUDING|BUT|without)", t)] if p == t or len(words(p)) >= 6]
        out[family] = list(dict.fromkeys([*parts, *[u.format(n) for n in NAMES.get(family, []) for u in USES]]))
    return out


def unwrapped(text: str) -> list[str]:
    """The paragraphs of a text."""
    return re.sub(WRAP, " ", text, flags=re.ASCII).split("\n")


def training_lines(seed: int = 4, n: int = TRAIN_LINES) -> list[tuple[str, str]]:
    rng = np.random.default_rng(seed)
    pick = lambda xs: xs[rng.integers(len(xs))]
    word = lambda: "".join(pick("abcdefghijklmnoprstuvwy") for _ in range(rng.integers(2, 9)))
    fill = lambda t: re.sub(r"\{w\}", lambda _: word(), t).replace("{n}", str(rng.integers(1900, 2100)))
    lead = ["", "", "This project is ", "The code is ", "© 2021 {w}. ", "Copyright (c) 2019 {w} {w}. ", "{w} {w}. "]
    known, out = sentences(), []
    for _ in range(n):
        kind = rng.random()
        if kind < 0.6:
            family = pick(sorted(TEMPLATES))
            # texts, their sentences, and uses of a family's names
            line, use = pick(known[family]), rng.random()
            if use < 0.4:
                line = pick(TEMPLATES[family])
            elif use < 0.8 and family in NAMES:
                line = pick(USES).format(pick(NAMES[family]))
            if rng.random() < 0.3:  # an edit: other digits, or a word left out
                line = re.sub(r"\d", lambda _: str(rng.integers(1, 5)), line)
            if rng.random() < 0.3 and len(line.split()) > 6:
                parts = line.split()
                del parts[rng.integers(len(parts))]
                line = " ".join(parts)
        else:
            family, line = (UNKNOWN, pick(OTHER)) if kind < 0.72 else ("none", pick(NONE))
        around = [pick(lead) if family != "none" else "", line, pick(["", "", " {w} {w}.", " See {w} for details."])]
        out.append((family, fill("".join(around))))
    return out


class Regression:
    """Multinomial logistic regression over n-grams seen at least twice, with a calibrated temperature."""

    def __init__(self, lines: list[tuple[str, str]]) -> None:
        self.classes = sorted({k for k, _ in lines})
        grams = [ngrams(t) for _, t in lines]
        names, counts = np.unique(np.concatenate(grams), return_counts=True)
        self.vocab = {g: i for i, g in enumerate(names[counts >= 4].tolist())}
        x = np.zeros((len(lines), len(self.vocab)), np.float32)
        for r, g in enumerate(grams):
            x[r, [self.vocab[k] for k in g if k in self.vocab]] = 1
        y = np.eye(len(self.classes), dtype=np.float32)[[self.classes.index(k) for k, _ in lines]]
        fit = np.arange(len(lines)) % 4 > 0
        xf, yf = x[fit], y[fit]
        self.w, self.b = np.zeros((x.shape[1], len(self.classes)), np.float32), np.zeros(len(self.classes), np.float32)
        for step in range(STEPS):
            d = (self._soft(xf @ self.w + self.b) - yf) / np.float32(fit.sum())
            rate = np.float32(20 / (1 + step / 100))
            self.w -= rate * (xf.T @ d + np.float32(L2) * self.w)
            self.b -= rate * d.sum(axis=0)
        logits = x[~fit] @ self.w + self.b
        loss = lambda t: -np.log((self._soft(logits * t) * y[~fit]).sum(axis=1) + 1e-12).mean()
        t = min(np.geomspace(0.2, 5, 41), key=loss)
        self.w, self.b = np.float64(self.w) * t, np.float64(self.b) * t

    @staticmethod
    def _soft(z: np.ndarray) -> np.ndarray:
        e = np.exp(z - z.max(axis=-1, keepdims=True))
        return e / e.sum(axis=-1, keepdims=True)

    def predict(self, text: str) -> dict[str, float]:
        at = [self.vocab[g] for g in ngrams(text) if g in self.vocab]
        return dict(zip(self.classes, self._soft(self.w[at].sum(axis=0) + self.b)))


_fitted: list[Regression] = []


def model() -> Regression:
    """The regression, fitted once a process; always the same."""
    if not _fitted:
        _fitted.append(Regression(training_lines()))
    return _fitted[0]


def template_share(text: str, family: str) -> float:
    """The largest share of the word pairs of one of a family's sentences that a text has."""
    have = set(pairs(text))
    return max(len(have & (t := set(pairs(x)))) / len(t) for x in sentences()[family])


def _constant(value: dict, kind: str):
    """A map as one literal: parsed once when the plan is made."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def scan(docs: DataFrame, sure: float = SURE, confirm: float = CONFIRM) -> DataFrame:
    """Licence notices in ``docs (doc_id, text)``: doc_id, paragraph, license, probability, template_share, notice.

    A row for each paragraph (counted from 0) that holds a notice: license is a family of TEMPLATES or
    ``unknown``, probability that of the best class. Whole texts are scanned, null and empty ones have no notices. Repeated
    rows give repeated notices; an empty table gives none; other columns are not read.
    """
    m, known = model(), sentences()

    def hinted(low: Column) -> Column:
        out = F.lit(False)
        for x in HINTS:
            out = out | low.contains(x)
        return out

    # the lower-cased text is made once: a lambda's variable is not expanded
    hint = F.contains("text", F.lit("MIT")) | F.exists(F.array(F.lower("text")), hinted)
    anchored = docs.select("doc_id", "text").where(hint).where(F.col("text").rlike(ANCHOR))
    parts = F.split(F.regexp_replace("text", WRAP, " "), "\n")
    lines = anchored.select("doc_id", F.posexplode(parts).alias("paragraph", "notice")).where(F.col("notice").rlike(ANCHOR))
    low = F.translate("notice", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    lines = lines.withColumn("w", F.regexp_extract_all(low, F.lit(WORD), F.lit(0)))
    two = F.zip_with(F.slice("w", F.lit(1), F.greatest(F.size("w") - 1, F.lit(0))), F.slice("w", F.lit(2), F.greatest(F.size("w") - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))
    lines = lines.withColumn("two", F.array_distinct(two))
    # only what is known is looked up: an intersection hashes, a map is searched from its beginning
    among = lambda c, names: F.array_intersect(c, F.from_json(F.lit(json.dumps(list(names))), "array<string>"))
    weights = _constant({g: m.w[i].tolist() for g, i in m.vocab.items()}, "map<string,array<double>>")
    lines = lines.withColumn("g", among(F.concat("w", "two"), m.vocab))
    found = F.transform("g", lambda g: F.try_element_at(weights, g))
    logits = F.aggregate(found, F.array(*map(F.lit, m.b.tolist())), lambda acc, x: F.zip_with(acc, x, lambda a, b: a + b))
    lines = lines.withColumn("z", logits).withColumn("top", F.array_max("z"))
    lines = lines.withColumn("e", F.transform("z", lambda v: F.exp(v - F.col("top"))))
    lines = lines.withColumn("probability", 1.0 / F.aggregate("e", F.lit(0.0), lambda a, b: a + b))
    lines = lines.withColumn("none", F.get("e", F.lit(m.classes.index("none"))) * F.col("probability"))
    best = F.get(F.array(*map(F.lit, m.classes)), (F.array_position("z", F.col("top")) - 1).cast("int"))
    lines = lines.withColumn("best", best).where((F.col("best") != "none") & (F.col("none") <= 1 - sure))

    # sentences by number; which of them have a word pair, and how many pairs they and their families have
    of_family, size, having = {}, [], {}
    for family, texts in known.items():
        of_family[family] = list(range(len(size), len(size) + len(texts)))
        for t in texts:
            own = pairs(t)
            for g in own:
                having.setdefault(g, []).append(len(size))
            size.append(len(own))
    holds = _constant(having, "map<string,array<int>>")
    hits = F.flatten(F.transform(among(F.col("two"), having), lambda g: F.try_element_at(holds, g)))
    lines = lines.withColumn("hits", hits).withColumn("mine", F.try_element_at(_constant(of_family, "map<string,array<int>>"), F.col("best")))
    sizes = F.from_json(F.lit(json.dumps(size)), "array<int>")
    shares = F.transform(F.array_intersect("mine", "hits"), lambda t: F.size(F.filter("hits", lambda h: h == t)) / F.get(sizes, t))
    lines = lines.withColumn("template_share", F.coalesce(F.array_max(shares), F.lit(0.0)))
    sure_ = (F.col("probability") >= sure) & (F.col("template_share") >= confirm)
    return lines.select("doc_id", "paragraph", F.when(sure_, F.col("best")).otherwise(UNKNOWN).alias("license"), "probability", "template_share", "notice")


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in all documents."""
    return scan(common.table(spark, sf_dir, "documents", "doc_id", "text"))
