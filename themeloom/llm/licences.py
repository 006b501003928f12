"""Licence scans: a paragraph classifier over hashed word n-grams, an unknown class, and template comparison."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from themeloom.llm.kernel import ALNUM, LOWER, U64, byte_values, mix, prefix, separated, slices, small_batches, span_hash, spans

#: Sentences of each licence family, from the public licence texts and their notices.
TEMPLATES = {
    "agpl": [
        "licensed under the GNU Affero General Public License version 3",
        "under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
        "You should have received a copy of the GNU Affero General Public License along with this program",
    ],
    "apache": [
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS",
        "See the License for the specific language governing permissions and limitations under the License",
    ],
    "boost": [
        "Distributed under the Boost Software License, Version 1.0",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation",
    ],
    "bsd": [
        "licensed under the BSD 3-Clause License",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES",
        "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES",
    ],
    "cc-by": ["Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "cc-by-nc-nd": ["Licensed under CC BY-NC-ND 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"],
    "cc-by-nc-sa": ["Licensed under CC BY-NC-SA 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"],
    "cc-by-nd": ["Licensed under CC BY-ND 4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License"],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "cc0": [
        "Licensed under CC0 1.0 Universal",
        "To the extent possible under law, the person who associated CC0 with this work has waived all copyright and related or neighboring rights",
    ],
    "epl": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
        "All rights reserved. This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY",
        "You should have received a copy of the GNU General Public License along with this program",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        "THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE",
    ],
    "lgpl": [
        "licensed under the GNU Lesser General Public License, version 3",
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; version 2.1 of the License",
        "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY",
        "You should have received a copy of the GNU Lesser General Public License along with this library",
    ],
    "mit": [
        "Released under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
        "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY",
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "If a copy of the MPL was not distributed with this file, You can obtain one",
    ],
    "unlicense": [
        "This is free and unencumbered software released into the public domain",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary",
    ],
    "zlib": [
        "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages",
        "The origin of this software must not be misrepresented; you must not claim that you wrote the original software",
    ],
}
#: Short names and identifiers of each family, from the public list of licence identifiers.
NAMES = {
    "agpl": ["AGPL-3.0", "AGPLv3", "GNU AGPL", "GNU Affero General Public License"],
    "apache": ["Apache-2.0", "Apache License 2.0", "Apache 2", "Apache"],
    "boost": ["BSL-1.0", "Boost Software License"],
    "bsd": ["BSD-3-Clause", "BSD-2-Clause", "BSD", "New BSD", "Simplified BSD", "2-clause BSD"],
    "cc-by": ["CC-BY-4.0", "CC BY 3.0", "Creative Commons Attribution"],
    "cc-by-nc": ["CC-BY-NC-4.0", "CC BY-NC 3.0", "Creative Commons Attribution-NonCommercial"],
    "cc-by-nc-nd": ["CC-BY-NC-ND-4.0", "CC BY-NC-ND 3.0", "Creative Commons Attribution-NonCommercial-NoDerivatives"],
    "cc-by-nc-sa": ["CC-BY-NC-SA-4.0", "CC BY-NC-SA 3.0", "Creative Commons Attribution-NonCommercial-ShareAlike"],
    "cc-by-nd": ["CC-BY-ND-4.0", "CC BY-ND 3.0", "Creative Commons Attribution-NoDerivatives"],
    "cc-by-sa": ["CC-BY-SA-4.0", "CC BY-SA 3.0", "Creative Commons Attribution-ShareAlike"],
    "cc0": ["CC0-1.0", "CC0"],
    "epl": ["EPL-2.0", "Eclipse Public License"],
    "gpl": ["GPL-3.0-or-later", "GPL-2.0", "GPLv3", "GPLv2", "GPL v2", "GPL version 3", "GNU GPL", "GNU General Public License"],
    "isc": ["ISC"],
    "lgpl": ["LGPL-2.1", "LGPL-3.0-or-later", "LGPLv3", "LGPL v2.1", "GNU LGPL", "GNU Lesser General Public License"],
    "mit": ["MIT", "MIT/X11", "Expat"],
    "mpl": ["MPL-2.0", "MPL 2.0", "Mozilla Public License"],
    "unlicense": ["Unlicense"],
    "zlib": ["zlib", "zlib/libpng"],
}
#: Wordings around a name; the last of every four, and its families' names in it, are held out for the calibration.
WORDINGS = [
    "SPDX-License-Identifier: {}",
    "License: {}",
    "licensed under the {} license",
    "this file is under {}",
    "licensed under {}",
    "released under {}",
    "{} licensed",
    "distributed under the terms of the {} license",
    "license {} only",
    "available under the {} licence",
    "this code is {} licensed",
    "the {} license applies",
]
#: Licence-like phrases of no family above, the seeds of the unknown class.
UNKNOWN_SEEDS = [
    "licensed under the terms of the enclosed agreement",
    "released under a custom license, see the license file",
    "all rights reserved, use is subject to license terms",
    "permission is granted to use this material under the house license",
    "distributed under the terms of the community license agreement, version 1",
    "this content may be used under the vendor license only",
    "subject to the following license conditions and warranty terms",
    "SPDX-License-Identifier: LicenseRef-Proprietary",
    "copying of this file is permitted under the terms of the in-house licence",
    "you may use this software only under the end user license agreement",
]
#: Ordinary sentences with words that licences have.
ORDINARY_SEEDS = [
    "he lost his driving licence on the way home",
    "a fishing license costs ten dollars a year",
    "the licence fee for television rose again",
    "her licence plate was from Texas",
    "doctors need a license to practise in this state",
    "the warranty of the car ends in May",
    "we had permission to leave early",
    "students at MIT built a small robot",
    "Apache helicopters flew over the valley",
    "the general public was free to enter",
    "terms of the contract were agreed in writing",
    "the software version of the radio is old",
    "creative people share common ideas",
    "the bar lost its liquor license",
    "conditions on the road were poor without any warning",
    "the copyright office opens at nine",
    "the studio has to license the music from its owner",
    "news was released under embargo until noon",
    "leaflets were distributed under the door",
    "the film was released under another title",
    "goods are distributed under seal by the customs",
    "a song that the band had to license before the tour",
    "the MIT professor spoke about free trade",
    "an eclipse was seen by the public in May",
    "the boost to the economy was small",
    "files are available under the desk",
]
NONE, UNKNOWN = "none", "unknown"
CLASSES = [NONE, UNKNOWN, *sorted(TEMPLATES)]
BUCKETS = 1 << 16
#: Lines without a licence word that the classifier is fitted on, at most, and code points of one (a bounded sample).
ORDINARY, LONGEST = 3000, 5000
#: Words of a window of a paragraph; windows overlap by half.
WINDOW = 40
#: A family is named from this calibrated probability, and when so much of a template's word pairs stand in the window; from
#: NEAR on a template alone decides between the families.
SURE, MATCH, NEAR = 0.5, 0.6, 0.85

_VALUES = byte_values(9)


def _features(data: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """Windows of the paragraphs of texts, and n-gram buckets with the window that they stand in.

    A paragraph is a run of lines with a word, between lines without. start, end: bytes of each window in the texts
    joined by line feeds; text, paragraph (its number in the text) of each window; owner, bucket: one for each n-gram.
    """
    data, at = separated(LOWER[data], off)
    start, end = spans(ALNUM[data])
    word = span_hash(prefix(_VALUES[data]), start, end)
    line = np.searchsorted(np.flatnonzero(data == 10), start)
    text = np.searchsorted(at, start, "right") - 1
    new = np.ones(len(word), bool)
    new[1:] = (line[1:] > line[:-1] + 1) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(word)))
    half = WINDOW // 2
    windows = np.maximum(1, -(-size // half) - 1)
    base = np.cumsum(windows) - windows
    block = np.cumsum(new) - 1
    place = np.arange(len(word)) - first[block] if len(word) else np.zeros(0, np.int64)
    step, last = place // half, windows[block] - 1 if len(word) else np.zeros(0, np.int64)
    pair = mix(word[:-1] * U64(3) + word[1:])
    both = ~new[1:]
    owner, bucket = [], []
    for back in (0, 1):  # a word stands in the window that begins with its step and in the one before
        own = step - back
        inside = (own >= 0) & (own <= last)
        owner.append((base[block] + own)[inside])
        bucket.append(word[inside])
        near = inside[:-1] & both & (step[1:] <= own[:-1] + 1)
        owner.append((base[block] + own)[:-1][near])
        bucket.append(pair[near])
    of = np.repeat(np.arange(len(first)), windows)
    begin = first[of] + (np.arange(len(of)) - base[of]) * half
    stop = np.minimum(begin + WINDOW, first[of] + size[of]) - 1
    head = np.searchsorted(text[first], np.arange(len(off))) if len(first) else np.zeros(len(off), np.int64)
    return {
        "data": data, "start": start[begin], "end": end[stop], "text": text[begin], "paragraph": of - head[text[begin]], "many": np.bincount(text[first], minlength=len(off) - 1),
        "owner": np.concatenate(owner), "bucket": (np.concatenate(bucket) & U64(BUCKETS - 1)).astype(np.int64),
    }


def _logits(weights: np.ndarray, owner: np.ndarray, bucket: np.ndarray, n: int) -> np.ndarray:
    """Class scores of lines: the mean feature weight, scaled by the square root of how many there are, and the bias."""
    order = np.argsort(owner, kind="stable")
    owner, bucket = owner[order], bucket[order]
    out = np.zeros((n, weights.shape[1]), np.float32)
    if len(owner):
        first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        many = np.diff(np.append(first, len(owner)))
        out[owner[first]] = np.add.reduceat(weights[bucket], first, axis=0) / np.sqrt(many)[:, None]
    return out + weights[-1]


def variants(ordinary: list[str], seed: int = 3) -> tuple[list[str], list[int], list[bool]]:
    """Training windows, their classes, and which ones calibrate: templates and names in wordings, whole, with words lost,
    amid words of the project's and of ordinary lines. Those that calibrate have wordings that no other one has."""
    rng = np.random.default_rng(seed)
    filler = ["project", "code", "version", "copyright", "2020", "authors", "see", "file", "data", "notice", "page", "text", "team"]
    around = [w for line in ordinary[:500] for w in line.split()[:60]] or filler
    seeds = [(1, t, k % 5 == 4) for k, t in enumerate(UNKNOWN_SEEDS)] + [(0, t, k % 5 == 4) for k, t in enumerate(ORDINARY_SEEDS)]
    for family, templates in TEMPLATES.items():
        label = CLASSES.index(family)
        seeds += [(label, t, len(templates) > 1 and k == len(templates) - 1) for k, t in enumerate(templates)]
        seeds += [(label, w.format(n), k % 4 == 3) for n in NAMES[family] for k, w in enumerate(WORDINGS)]
    texts, labels, held = [], [], []
    for label, text, out in seeds:
        for k in range(16 if label < 2 or text in TEMPLATES.get(CLASSES[label], ()) else 6):
            words = text.split()
            if k and len(words) > 6:
                words = [w for w in words if rng.random() > 0.06 * (k % 3)]
            if k % 4:
                room = max(0, WINDOW - len(words)) if k % 4 == 3 else 8
                some = around if k % 2 else filler
                before = int(rng.integers(0, room + 1))
                lead, after = (int(rng.integers(0, max(1, len(some) - n))) for n in (before, room - before))
                words = some[lead : lead + before] + words + some[after : after + room - before]
            texts.append(" ".join(words[:WINDOW]))
            labels.append(label)
            held.append(out)
    return texts, labels, held


def _least_lines(lines: DataFrame, sample: int) -> list[str]:
    """The `sample` distinct lines of least hash of lines(h, line), in that order; all, if there are no more.

    Only hashes under a bound that leaves about twice as many are shuffled; the bound rises until it is enough.
    """
    share = 2 * sample / max(1, lines.agg(F.approx_count_distinct("h")).first()[0])
    while True:
        some = lines if share >= 1 else lines.where(F.col("h") < int((share - 0.5) * 2**64))
        held = some.distinct().orderBy("h", "line").limit(sample).collect()
        if share >= 1 or len(held) == sample:
            return [r["line"] for r in held]
        share *= 4


def fit(docs: DataFrame, text_col: str = "text", sample: int = ORDINARY) -> dict:
    """Multinomial logistic regression, by gradient steps on the driver, on licence windows and ordinary lines.

    The ordinary ones are the `sample` distinct lines of docs of least hash, of those of LONGEST code points at most without a word
    of licences. What variants() and a fifth of those lines hold out sets the temperature. The same rows give the same
    model however they are laid out.
    """
    lines = docs.where(F.col(text_col).isNotNull()).select(F.explode(F.split(text_col, "\n")).alias("line"))
    odd = r"(?i)licen[sc]e|copyright|warrant|permi|redistribut|public domain|creative commons"
    plain = lines.where((F.length("line") <= LONGEST) & F.col("line").rlike(r"\w") & ~F.col("line").rlike(odd))
    ordinary = _least_lines(plain.select(F.xxhash64("line").alias("h"), "line"), sample)
    texts, labels, held = variants(ordinary)
    texts, labels, held = texts + ordinary, labels + [0] * len(ordinary), np.array(held + [k % 5 == 4 for k in range(len(ordinary))])
    raw = [t.replace("\n", " ").encode() for t in texts]
    got = _features(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    owner, bucket = got["owner"], got["bucket"]
    labels, held = np.array(labels)[got["text"]], held[got["text"]]
    n = len(labels)
    y = np.eye(len(CLASSES), dtype=np.float32)[labels]
    many = np.maximum(1, np.bincount(owner, minlength=n))
    scale = 1 / np.sqrt(many)
    weight = np.where(labels == 0, 1.0, max(1.0, (labels == 0).sum() / max(1, (labels > 0).sum()))).astype(np.float32)
    weight[held] = 0
    w, g2 = np.zeros((BUCKETS + 1, len(CLASSES)), np.float32), np.full((BUCKETS + 1, len(CLASSES)), 1e-6, np.float32)
    used, place = np.unique(bucket, return_inverse=True)
    by_owner, by_place = np.argsort(owner, kind="stable"), np.argsort(place, kind="stable")
    windows, first = np.unique(owner[by_owner], return_index=True)
    at, begin = bucket[by_owner], np.flatnonzero(np.diff(place[by_place], prepend=-1))
    sent = owner[by_place]
    for _ in range(120):  # full-batch steps of AdaGrad over the features that occur
        z = np.repeat(w[-1:], n, axis=0)
        z[windows] += np.add.reduceat(w[at], first, axis=0) * scale[windows, None].astype(np.float32)
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        d = (p - y) * weight[:, None] / weight.sum()
        grad = np.add.reduceat((d * scale[:, None]).astype(np.float32)[sent], begin, axis=0) if len(used) else np.zeros((0, len(CLASSES)), np.float32)
        grad += 1e-6 * w[used]
        g2[used] += grad**2
        w[used] -= 0.3 * grad / np.sqrt(g2[used])
        bias = d.sum(axis=0)
        g2[-1] += bias**2
        w[-1] -= 0.3 * bias / np.sqrt(g2[-1])
    z = _logits(w, owner, bucket, n)[held]
    loss = []
    temperatures = np.geomspace(0.2, 5, 40)
    for t in temperatures:
        s = z / t
        s = s - s.max(axis=1, keepdims=True)
        loss.append(float(-(s - np.log(np.exp(s).sum(axis=1, keepdims=True)))[np.arange(len(s)), labels[held]].mean()))
    return {"weights": (w / temperatures[int(np.argmin(loss))]).astype(np.float32)}


def _words(text: str) -> list[str]:
    return "".join(c if c.isalnum() else " " for c in text.lower()).split()


_TEMPLATE_WORDS = [(f, _words(t)) for f, ts in TEMPLATES.items() for t in [*ts, *(w.format(n) for n in NAMES[f] for w in WORDINGS)]]
_PAIRS = np.array([len(t) - 1 for _, t in _TEMPLATE_WORDS])
#: The templates that have each word pair, with how often.
_OF_PAIR: dict[tuple[str, str], dict[int, int]] = {}
for _k, (_, _t) in enumerate(_TEMPLATE_WORDS):
    for _p in zip(_t, _t[1:], strict=False):
        _OF_PAIR.setdefault(_p, {}).setdefault(_k, 0)
        _OF_PAIR[_p][_k] += 1


def template_matches(words: list[str]) -> dict[str, tuple[float, int]]:
    """Of each family the greatest share of a template's word pairs that stand in the paragraph, and how many pairs of its
    templates that are near whole there stand, of the longest."""
    seen = np.zeros(len(_PAIRS), np.int64)
    for pair in set(zip(words, words[1:], strict=False)):
        for k, n in _OF_PAIR.get(pair, {}).items():
            seen[k] += n
    out: dict[str, tuple[float, int]] = {}
    for k in np.flatnonzero(seen):
        share, family = seen[k] / _PAIRS[k], _TEMPLATE_WORDS[k][0]
        best, longest = out.get(family, (0.0, 0))
        out[family] = max(best, float(share)), max(longest, int(seen[k]) if share >= NEAR else 0)
    return out


def judge(p: np.ndarray, window: str) -> tuple[str, float, float]:
    """(class, probability, template match) of a window that may carry a licence.

    The likeliest family is confirmed by its templates, unless another family has a longer template near whole, as names and
    sentences of one licence stand in those of another. Failing that, the family of the longest template that is near whole
    is taken; failing that, a window that is no ordinary one is `unknown`.
    """
    held = template_matches(_words(window))
    top = int(p[2:].argmax()) + 2
    match, own = held.get(CLASSES[top], (0.0, 0))
    longest, _, name = max(((n, share, f) for f, (share, n) in held.items()), default=(0, 0.0, ""))
    if match >= MATCH and p[top] >= max(p[0], p[1]) * SURE and longest <= own:
        return CLASSES[top], float(p[top]), match
    if longest:
        return name, float(1 - p[0]), held[name][0]
    if match >= MATCH and p[top] >= max(p[0], p[1]) * SURE:
        return CLASSES[top], float(p[top]), match
    return UNKNOWN, float(1 - p[0]), match


def scan(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_paragraphs, licences, n_unknown, found) for each row of docs.

    A paragraph is a run of lines with a letter or digit; all of all texts are classified, in windows of WINDOW words that
    overlap by half. licences: the sorted distinct families; found: paragraph number, family or `unknown`, calibrated
    probability, template match, once for each paragraph and family, from its surest window; `unknown` only where a
    paragraph has no family. Null and empty texts have none. Repeated rows are scanned each; ids and other columns
    are not looked at.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("paragraph", pa.int32()), ("licence", pa.string()), ("probability", pa.float64()), ("template", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value["weights"]
        for batch in batches:
            many, found = [], []
            for i, j, data, off in slices(batch.column(1), 2 << 20):
                got = _features(data, off)
                z = _logits(weights, got["owner"], got["bucket"], len(got["text"]))
                z -= z.max(axis=1, keepdims=True)
                p = np.exp(z)
                p /= p.sum(axis=1, keepdims=True)
                many += got["many"].tolist()
                rows: list[dict] = [{} for _ in range(j - i)]
                for x in np.flatnonzero(p[:, 0] < SURE):
                    name, probability, match = judge(p[x], got["data"][got["start"][x] : got["end"][x]].tobytes().decode("utf-8", "replace"))
                    key, held = (int(got["paragraph"][x]), name), rows[int(got["text"][x])]
                    held[key] = max(held.get(key, (0.0, 0.0)), (probability, match))
                for held in rows:
                    named = {k for k, name in held if name != UNKNOWN}
                    ordered = sorted((k, v) for k, v in held.items() if k[1] != UNKNOWN or k[0] not in named)
                    found.append([{"paragraph": k, "licence": name, "probability": a, "template": b} for (k, name), (a, b) in ordered])
            names = [sorted({r["licence"] for r in x} - {UNKNOWN}) for x in found]
            unknown = [sum(r["licence"] == UNKNOWN for r in x) for x in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(many, pa.int64()), pa.array(names, pa.list_(pa.string())), pa.array(unknown, pa.int32()), pa.array(found, kind)],
                names=["doc_id", "n_paragraphs", "licences", "n_unknown", "found"],
            )

    out = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return out.mapInArrow(
        run,
        "doc_id bigint, n_paragraphs bigint, licences array<string>, n_unknown int, found array<struct<paragraph:int,licence:string,probability:double,template:double>>",
    )
