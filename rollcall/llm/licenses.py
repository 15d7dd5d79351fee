"""Licence scan (op 2): a trained paragraph classifier; DataFrame functions only on the data path.

Every line of a text is looked at, and every paragraph of several lines: lines up to a blank one, put together, so that a
wrapped notice is judged whole. Their distinct words and word pairs are weighed by a multinomial logistic regression over the
licence families, "unknown" (licence wording of no listed family) and "none" (other text). The logits are divided by a
temperature fitted on templates kept out of training, so the shares are calibrated. What is a licence with a share
of `least_licence` or more gets a row; its family is the likeliest class if that has `least_share`, else "unknown". A family
is confirmed if a template of it and the paragraph share at least `least_similarity` of the words and pairs of the shorter.

Most text is told to be none from a bound alone. For an n-gram, the gain is the most that any class has over "none"
in weight. The sum of a paragraph's gains, rounded up to steps of GAIN_STEP, and the largest difference of intercepts is
at least what any class has over "none"; where it is too small for the share asked for, the model would say "none". So the bound
drops nothing that the model would keep. The rest is judged by the whole model within its row: nothing is shuffled or
written, so a notice that a third of all documents carry is as many small rows.

The regression is fitted on TEMPLATES and NOTICES, with words dropped and other words around them, against the sentences in
OTHERS and bags of their words. Weights that tell little are 0 (`sparsity` is the price of their size), and n-grams without
weights are left out. It sees no table, so its size is fixed: about a thousand n-grams, constants of the plan.

Null text: no paragraphs. Paragraphs are never cut. Null ids and repeated rows each get rows. Shares that tie go to the class listed first.
Empty table: no rows. Other columns of the table are not read.
"""

from __future__ import annotations

import functools
import random
import zlib
from collections.abc import Callable

import numpy as np
import regex
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import let

#: Notices of each licence family.
TEMPLATES = {
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "This project is licensed under the terms of the Apache License 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
        "Apache-2.0",
        "Distributed under the Apache 2.0 licence.",
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
        "Veröffentlicht unter der Apache-Lizenz, Version 2.0.",
        "Sous licence Apache, version 2.0.",
        "Bajo la licencia Apache, versión 2.0.",
    ],
    "mit": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        "SPDX-License-Identifier: MIT",
        "Released under the MIT terms",
        "MIT licensed",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "Veröffentlicht unter der MIT-Lizenz.",
        "Publié sous licence MIT.",
        "Publicado bajo la licencia MIT.",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "Distributed under the GNU GPL v2 or later.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "Distributed under GPLv3.",
        "Licensed under GPLv2 or GPL v3",
        "GPL v3 or later",
        "GPL-2.0",
        "GNU GPL",
        "Veröffentlicht unter der GNU General Public License.",
        "Sous licence publique générale GNU.",
        "Bajo la licencia pública general de GNU.",
    ],
    "lgpl": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "Distributed under LGPLv3.",
        "GNU LGPL",
        "LGPL v2.1 or later",
    ],
    "bsd": [
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "BSD-3-Clause",
        "BSD-2-Clause",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "Veröffentlicht unter der BSD-Lizenz.",
        "Sous licence BSD.",
        "Bajo la licencia BSD.",
    ],
    "mpl": [
        "Licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "SPDX-License-Identifier: MPL-2.0",
        "MPL-2.0",
        "MPL 2.0",
        "Distributed under the Mozilla Public License.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Available under the CC BY-NC-SA 4.0 licence, for noncommercial use only.",
        "CC-BY-NC 4.0",
        "CC BY-NC-ND 4.0",
        "Creative Commons Namensnennung - Nicht kommerziell 4.0",
        "Creative Commons Attribution - Pas d'utilisation commerciale 4.0",
        "Creative Commons Reconocimiento-NoComercial 4.0",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
        "CC-BY-SA 4.0",
        "CC BY-SA 3.0",
        "Creative Commons Namensnennung - Weitergabe unter gleichen Bedingungen 4.0",
        "Creative Commons Attribution - Partage dans les mêmes conditions 4.0",
        "Creative Commons Reconocimiento-CompartirIgual 4.0",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Except where otherwise noted, content on this site is licensed under a Creative Commons Attribution 4.0 licence.",
        "CC-BY 4.0",
        "CC BY 3.0",
        "Creative Commons Namensnennung 4.0",
        "Sous licence Creative Commons Attribution 4.0",
        "Bajo licencia Creative Commons Atribución 4.0",
    ],
    "public-domain": [
        "This work is dedicated to the public domain under CC0 1.0.",
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "CC0 1.0 Universal",
        "Public domain",
        "Gemeinfrei",
        "Domaine public",
        "Dominio público",
    ],
    "proprietary": [
        "All rights reserved.",
        "Copyright 2024 the authors. All rights reserved.",
        "No part of this publication may be reproduced, distributed, or transmitted in any form or by any means without the prior written permission of the copyright owner.",
        "This software is proprietary and confidential. Unauthorized copying of this file is strictly prohibited.",
        "Unauthorized copying of this file is strictly prohibited",
        "Alle Rechte vorbehalten.",
        "Tous droits réservés.",
        "Todos los derechos reservados.",
        "Confidential and proprietary.",
    ],
}
#: Sentences with the same words that are no licence.
OTHERS = [
    "He lost his driving licence after the accident.",
    "The city will license street vendors from next year.",
    "She gave them permission to enter the building.",
    "The warranty covers parts and labour for two years.",
    "The Apache are a group of peoples of the southwest.",
    "An apache helicopter landed on the field version by version.",
    "The museum holds a copy of the document in the public library.",
    "Copyright law protects authors in most countries.",
    "Students at MIT published a paper on this work.",
    "The general public was not allowed to distribute leaflets.",
    "The court discussed copyright and the public domain at length.",
    "Mozilla released a new version of its browser.",
    "The gnu is a large antelope.",
    "All seats are reserved for members.",
    "Please ask for permission before you take photographs.",
    "The licensed trade opposed the bill on public houses.",
    "A table was reserved under the name of the author.",
    "The fishing license costs twenty dollars and expires in March.",
    "The creative team met the commons committee.",
    "Attribution of the painting to the master is disputed.",
    "The score was 4.0 in the first test and 3.0 in the second.",
    "An earthquake of magnitude 2.0 was felt at 1.0 in the morning; another of 2.1 came after it.",
    "Er kam mit dem Hund, mit der Mutter und mit den Kindern, aber nicht mit ihm.",
    "Mit einem Mal war es still; mit uns sprach man nicht, mit sich war er zufrieden.",
    "Was mit mir ist, hat mit dir und mit ihr zu tun.",
    "The general sold his library to the free city.",
    "You can use this road to get to the public beach.",
    "The software was written in a year and the file is in the archive.",
    "The material that is used in the work is not known in most cases.",
    "Version two of the plan is available in the office.",
    "The conditions of the road were reported by the police.",
    "It is one of the best known sources of water in the region.",
    "She may have been the first to obtain a copy of the letter.",
    "The international terms of trade were set in this form.",
    "The owner of the house had no right to sell any part of it.",
    "In the past, all of the people who lived by the sea and in the hills had to work for the good of the town.",
    "Most of the content on this site is about food and travel.",
    "He and the others were there at the time, but it was not for them to say what would be done with it.",
    "They had been in the country for as long as she could remember, and so this was their home.",
    "If you have a question, call us or write to the address on the page.",
    "Er hat seinen Führerschein und die Lizenz als Trainer im letzten Jahr verloren.",
    "Die Stadt hat das Recht, den Platz unter der Brücke neu zu gestalten, und die Bürger sind nicht dagegen.",
    "Das Urheberrecht ist ein Thema, das in der Schule und auf der Arbeit mit den anderen besprochen wird.",
    "Es war ein schöner Tag, und wir sind mit dem Zug an die See gefahren, weil es dort eine gute Luft gibt.",
    "Sie haben sich für den Namen des Kindes noch nicht entschieden.",
    "Il a perdu son permis et sa licence de pêche dans les eaux du lac.",
    "La ville a le droit de vendre le terrain sous les conditions fixées par la loi, et les habitants sont pour.",
    "Le domaine est ouvert au public dans la même semaine que le musée, mais pas le lundi.",
    "Elle est une des personnes qui ont travaillé avec nous pour que ce soit un bon jour.",
    "On ne peut pas dire que tous les droits soient les mêmes pour les uns et les autres.",
    "El equipo perdió la licencia bajo la presión de los vecinos y de la prensa.",
    "La ciudad tiene derecho a vender el terreno, y los habitantes no están en contra de que se haga.",
    "El dominio del público sobre el escenario es lo que más le gusta a la actriz.",
    "Todos los que estaban en la casa salieron a la calle con las llaves en la mano por el ruido.",
    "Es una de las personas que han trabajado con nosotros para que este sea un buen día.",
]
#: Licence wording of families that are not listed; NAME stands for a name.
NOTICES = [
    "Licensed under the NAME License.",
    "Licensed under the NAME Public License, version 2.0.",
    "Released under the NAME licence.",
    "This project is licensed under the terms of the NAME license.",
    "Distributed under the NAME Software License, Version 1.0.",
    "Published under the NAME Public License 2.0",
    "This work is available under the NAME Free Documentation License.",
    "This font software is licensed under the NAME Open Font License, Version 1.1.",
    "SPDX-License-Identifier: NAME",
    "See the LICENSE file for the terms of use.",
    "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted.",
    "Use of this data set is subject to the NAME license agreement.",
    "Veröffentlicht unter der NAME-Lizenz.",
    "Publié sous licence NAME.",
    "Publicado bajo la licencia NAME.",
]
#: Pieces of a paragraph that are words: letters, digits and inner points.
TOKEN = r"[\p{L}\p{N}]+(?:\.[0-9]+)*"
UNKNOWN, NONE = "unknown", "none"
#: Gains of n-grams are rounded up to a multiple of this in the bound.
GAIN_STEP = 0.125
#: Weights are looked up in so many maps, by CRC-32 of the n-gram.
MAPS = 256
_BLANK = " \t\r\f\v"


def grams(paragraph: str) -> set[str]:
    words = regex.findall(TOKEN, paragraph.lower())
    return {*words, *(f"{a} {b}" for a, b in zip(words, words[1:], strict=False))}


def _made_up(rng: random.Random) -> str:
    return "".join(rng.choices("abcdefghijklmnoprstuvwz", k=rng.randint(2, 9)))


class Model:
    """Weights by n-gram and class, the classes' intercepts and the temperature."""

    def __init__(self, variants: int = 16, seed: int = 7, folds: int = 4, none_share: float = 0.8, bags: int = 400, sparsity: float = 2e-4):
        self.classes, self.none_share, self.sparsity = [*TEMPLATES, UNKNOWN, NONE], none_share, sparsity
        known = [(t, k) for k, ts in enumerate(TEMPLATES.values()) for t in ts]
        known += [(t, len(self.classes) - 2) for t in NOTICES] + [(t, len(self.classes) - 1) for t in OTHERS]
        names = sorted({g for t, _ in known for g in grams(t.replace("NAME", " "))})
        self.index = {g: i for i, g in enumerate(names)}
        made = [self._variants(t, k, variants, random.Random(f"{seed} {i}")) for i, (t, k) in enumerate(known)]
        made += [self._bag(random.Random(f"{seed} bag {i}")) for i in range(bags)]

        def rows(of: list[int]) -> tuple[np.ndarray, np.ndarray]:
            own = [r for i in of for r in made[i]]
            x = np.zeros((len(own), len(names)), np.float32)
            for r, (text, _) in enumerate(own):
                x[r, [self.index[g] for g in grams(text) if g in self.index]] = 1
            return x, np.array([k for _, k in own])

        # the temperature fits templates that the weights have not seen
        logits, truth = [], []
        for fold in range(folds):
            w, b = self._softmax(*rows([i for i in range(len(made)) if i % folds != fold]))
            x, y = rows([i for i in range(len(made)) if i % folds == fold])
            logits.append(x @ w + b)
            truth.append(y)
        z, y = np.concatenate(logits), np.concatenate(truth)
        losses = [(self._loss(z / t, y, self._row_share(y)), t) for t in np.linspace(0.3, 3.0, 28).tolist()]
        self.temperature = round(min(losses)[1], 3)
        w, b = self._softmax(*rows(list(range(len(made)))))
        told = np.flatnonzero(np.abs(w).max(axis=1) >= 1e-6)
        self.index = {names[i]: k for k, i in enumerate(told.tolist())}
        self.weights, self.bias = np.round(w[told], 6), np.round(b, 6)

    def _variants(self, text: str, k: int, variants: int, rng: random.Random) -> list[tuple[str, int]]:
        """The text, and copies of it with words dropped, words of OTHERS around them and made-up names, and lines of it."""
        filler = [w for s in OTHERS for w in s.split()]
        name = lambda: _made_up(rng)
        none = k == len(self.classes) - 1
        out = [(text.replace("NAME", name()), k)] * 2
        for _ in range(variants * max(1, len(text.split()) // 10)):
            words = text.replace("NAME", f"{name()} {name()}" if rng.random() < 0.3 else name()).split()
            if not none and len(words) > 16 and rng.random() < 0.6:  # some lines of a wrapped notice
                at = rng.randrange(len(words) - 8)
                out.append((" ".join(words[at : at + rng.randint(8, 24)]), k))
                continue
            own = [w for w in words if rng.random() > (0.3 if none else 0.12)] or words
            if none:
                own = own + rng.choices(filler, k=rng.randint(0, 25)) + [name() for _ in range(rng.randint(0, 12))]
                rng.shuffle(own)
            elif rng.random() < 0.5:
                own = rng.choices(filler, k=rng.randint(2, 12)) + own + rng.choices(filler, k=rng.randint(0, 8))
            out.append((" ".join(own), k))
        return out

    def _bag(self, rng: random.Random) -> list[tuple[str, int]]:
        """Made-up words with a few of OTHERS among them, in any order: no licence."""
        filler = [w for s in OTHERS for w in s.split()]
        words = [_made_up(rng) for _ in range(rng.randint(1, 20))] + rng.choices(filler, k=rng.randint(0, 10))
        rng.shuffle(words)
        return [(" ".join(words), len(self.classes) - 1)]

    def gains(self, least_licence: float) -> tuple[dict[str, float], float]:
        """The gain of every n-gram, rounded up, and the sum of gains that a paragraph must reach to be more than "none"."""
        over = self.weights[:, :-1] - self.weights[:, -1:]
        gain = np.ceil(over.max(axis=1) / GAIN_STEP) * GAIN_STEP
        odds = np.log(least_licence / (1 - least_licence)) - np.log(len(self.classes) - 1)
        need = self.temperature * odds - float((self.bias[:-1] - self.bias[-1]).max())
        # a little less, as sums are rounded to six digits before shares are taken
        return {g: float(gain[i]) for g, i in self.index.items() if gain[i]}, need - 1e-4

    def _softmax(self, x: np.ndarray, y: np.ndarray, steps: int = 300) -> tuple[np.ndarray, np.ndarray]:
        """Sparse multinomial logistic regression by accelerated proximal steps; `none_share` for "none", the others alike."""
        n, k = len(y), len(self.classes)
        target = np.eye(k)[y]
        share = self._row_share(y)
        a = np.column_stack([x, np.ones(n)])
        w = v = np.zeros((a.shape[1], k))
        rate = 4.0 / np.mean((a * a).sum(axis=1))
        for step in range(1, steps + 1):
            z = a @ v
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            new = v - rate * (a.T @ (share[:, None] * (p - target)))
            new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - rate * self.sparsity, 0)
            v = new + (step - 1) / (step + 2) * (new - w)
            w = new
        return w[:-1], w[-1]

    def _row_share(self, y: np.ndarray) -> np.ndarray:
        """Weights of rows: `none_share` goes to "none", the rest alike to the other classes."""
        k = len(self.classes)
        class_share = np.append(np.full(k - 1, (1 - self.none_share) / (k - 1)), self.none_share)
        share = (class_share / np.maximum(np.bincount(y, minlength=k), 1))[y]
        return share / share.sum()

    @staticmethod
    def _loss(z: np.ndarray, y: np.ndarray, share: np.ndarray) -> float:
        z = z - z.max(axis=1, keepdims=True)
        return float((share * (np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(y)), y])).sum())


@functools.cache
def model() -> Model:
    return Model()


def _pairs(words: Column, pair: Callable[[Column, Column], Column]) -> Column:
    """`pair` of every two words that follow each other (null for the last word), where it is not null."""
    return F.filter(F.zip_with(words, F.slice(words, F.lit(2), F.size(words)), pair), lambda g: g.isNotNull())


def _all_grams(words: Column) -> Column:
    return F.array_distinct(F.concat(words, _pairs(words, lambda a, b: F.when(b.isNotNull(), F.concat_ws(" ", a, b)))))


def _listed_pair(a: Column, b: Column) -> Column:
    """The pair of two words, or null where it has no weights."""
    listed = [g for g in model().index if " " in g]
    heads, tails = (sorted({g.split(" ")[i] for g in listed}) for i in (0, 1))
    # only words that listed pairs begin and end with are put together
    return let(F.when(a.isin(heads) & b.isin(tails), F.concat(a, F.lit(" "), b)), lambda g: F.when(g.isin(listed), g))


def _known(words: Column) -> Column:
    """The n-grams of a line that have weights."""
    single = [g for g in model().index if " " not in g]
    return F.array_distinct(F.concat(F.filter(words, lambda w: w.isin(single)), _pairs(words, _listed_pair)))


def _shares(known: Column, least_licence: float) -> Column:
    """The share of every class, given the n-grams that have weights; null where the bound tells that it is none."""
    m = model()
    gains, need = m.gains(least_licence)
    # the gain and the weights; a map is searched entry by entry, so they are dealt over small ones
    numbers = {g: [gains.get(g, 0.0), *m.weights[i].tolist()] for g, i in m.index.items()}
    dealt = [[g for g in numbers if zlib.crc32(g.encode()) % MAPS == n] for n in range(MAPS)]
    maps = F.array(*(F.create_map(*(x for g in gs for x in (F.lit(g), F.lit(numbers[g])))) if gs else F.lit(None) for gs in dealt))
    of = lambda g: F.element_at(F.get(maps, F.pmod(F.crc32(g.cast("binary")), F.lit(MAPS)).cast("int")), g)
    most = F.aggregate(known, F.lit(0.0), lambda s, g: s + F.element_at(of(g), 1))
    sums = F.aggregate(known, F.lit([0.0] * (len(m.classes) + 1)), lambda s, g: F.zip_with(s, of(g), lambda x, y: x + y))
    logits = F.zip_with(F.slice(sums, 2, len(m.classes)), F.lit(m.bias.tolist()), lambda x, b: (F.round(x, 6) + b) / m.temperature)
    powers = let(logits, lambda z: let(F.array_max(z), lambda top: F.transform(z, lambda x: F.exp(x - top))))
    shares = let(powers, lambda p: let(F.aggregate(p, F.lit(0.0), lambda s, x: s + x), lambda total: F.transform(p, lambda x: x / total)))
    return F.when(most >= need, shares)


def licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_licence: float = 0.5) -> DataFrame:
    """(doc_id, paragraph, n_lines, shares, grams) of lines and paragraphs that are licences, in lower case.

    Units are every line that is not blank, and all lines between blank ones where they are several; `paragraph` is the number of
    the first line, from 0. A line's words are cut and looked up once: its paragraph adds only pairs across lines.
    """
    lines = F.split(F.col(text_col).cast("string"), "\n", -1)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), lines.alias("lines")).filter("lines IS NOT NULL")

    def line(x: Column) -> Column:
        full = F.btrim(x, F.lit(_BLANK)) != ""
        words = F.regexp_extract_all(F.lower(x), F.lit(f"({TOKEN})"), 1)
        return let(words, lambda w: F.struct(full.alias("full"), w.alias("words"), _known(w).alias("known")))

    def found(cut: Column) -> Column:
        has = lambda i: F.coalesce(F.get(cut, i)["full"], F.lit(False))
        of = lambda unit: F.slice(cut, unit["paragraph"] + 1, unit["n_lines"])
        each = F.sequence(F.lit(0), F.size(cut) - 1)
        single = F.transform(F.filter(each, has), lambda i: F.struct(i.alias("paragraph"), F.lit(1).alias("n_lines")))
        ends = F.arrays_zip(F.filter(each, lambda i: has(i) & ~has(i - 1)).alias("first"), F.filter(each, lambda i: has(i) & ~has(i + 1)).alias("last"))
        blocks = F.transform(ends, lambda b: F.struct(b["first"].alias("paragraph"), (b["last"] - b["first"] + 1).alias("n_lines")))

        def known(own: Column) -> Column:
            across = _pairs(F.filter(own, lambda x: F.size(x["words"]) > 0), lambda a, b: _listed_pair(F.element_at(a["words"], -1), F.get(b["words"], 0)))
            return F.array_distinct(F.concat(F.flatten(F.transform(own, lambda x: x["known"])), across))

        def judged(unit: Column) -> Column:
            own = F.when(unit["n_lines"] == 1, F.get(cut, unit["paragraph"])["known"]).otherwise(let(of(unit), known))
            return F.struct(unit["paragraph"].alias("paragraph"), unit["n_lines"].alias("n_lines"), let(own, lambda k: _shares(k, least_licence)).alias("shares"))

        units = F.concat(single, F.filter(blocks, lambda b: b["n_lines"] > 1))
        kept = F.filter(F.transform(units, judged), lambda u: 1 - F.element_at(u["shares"], -1) >= least_licence)
        words = lambda u: F.flatten(F.transform(of(u), lambda x: x["words"]))
        return F.transform(kept, lambda u: F.struct(u["paragraph"].alias("paragraph"), u["n_lines"].alias("n_lines"), u["shares"].alias("shares"), let(words(u), _all_grams).alias("grams")))

    return rows.select("doc_id", F.explode(let(F.transform("lines", line), found)).alias("unit")).select("doc_id", "unit.*")


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_licence: float = 0.5, least_similarity: float = 0.6, least_share: float = 0.5
) -> DataFrame:
    """doc_id, paragraph, n_lines, family, probability, similarity, confirmed of every line or paragraph that is a licence."""
    classes = model().classes[:-1]
    found = licences(docs, id_col, text_col, least_licence).withColumn("shares", F.slice("shares", 1, len(classes)))
    found = found.withColumn("probability", F.round(F.array_max("shares"), 6))
    named = F.element_at(F.lit(classes), F.array_position("shares", F.array_max("shares")).cast("int"))
    found = found.withColumn("family", F.when(F.col("probability") >= least_share, named).otherwise(UNKNOWN))
    alike = F.lit(0.0)
    for family, texts in TEMPLATES.items():
        its = F.array(*(F.lit(sorted(grams(t))) for t in texts))
        overlap = lambda t: F.size(F.array_intersect("grams", t)) / F.least(F.size("grams"), F.size(t))
        alike = F.when((F.col("family") == family) & (F.size("grams") > 0), F.array_max(F.transform(its, overlap))).otherwise(alike)
    found = found.withColumn("similarity", F.round(alike, 6))
    confirmed = (F.col("family") != UNKNOWN) & (F.col("similarity") >= least_similarity)
    return found.select("doc_id", "paragraph", "n_lines", "family", "probability", "similarity", confirmed.alias("confirmed"))
