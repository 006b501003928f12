"""The licence scan on wordings that its training set lacks, wrapped and inline notices, and any layout of its rows."""

import numpy as np

from themeloom.llm import licences

UNSEEN = [
    (
        "lgpl",
        "This library is free software; you can redistribute it and/or\n"
        "modify it under the terms of the GNU Lesser General Public\n"
        "License as published by the Free Software Foundation; either\n"
        "version 2.1 of the License, or (at your option) any later version.",
    ),
    ("lgpl", "the bindings come under the GNU Lesser General Public License, 2.1 or later"),
    ("lgpl", "License of this library: LGPL v3"),
    ("lgpl", "This package is covered by the LGPL-2.1 license"),
    ("lgpl", "you may use it under LGPLv3 if you like"),
    ("cc-by-nc-nd", "CC BY-NC-ND 4.0"),
    ("cc-by-nc-nd", "The slides are shared under CC BY-NC-ND 4.0 by their authors"),
    ("cc-by-nc-nd", "Except where noted, content is under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 licence"),
    ("cc-by-nd", "Text: CC BY-ND 4.0"),
    ("cc-by-nc-sa", "This lesson is licensed under CC BY-NC-SA 4.0, please share it"),
    ("cc-by-nc", "Photos: licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "all images come under the Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by", "figures are available under a Creative Commons Attribution 4.0 International License"),
    ("cc-by", "The data set is licensed under CC-BY-4.0 by the institute"),
    ("cc-by-sa", "text on this page is offered under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-sa", "Maps are CC BY-SA 3.0 licensed, by the map makers"),
    ("cc0", "the author has put this under CC0 1.0 Universal"),
    ("cc0", "SPDX-License-Identifier: CC0-1.0"),
    ("mit", "License: MIT"),
    ("mit", "Licensed under MIT."),
    ("mit", "MIT licensed"),
    ("mit", "Copyright (c) 2019 the authors. The software here is offered to you under the MIT license, with no promise at all."),
    (
        "mit",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR\n"
        "IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,\n"
        "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    ),
    ("mit", "you will find that our helpers are MIT licensed as well"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy\n"
        "of this software and associated documentation files (the \"Software\"), to deal\n"
        "in the Software without restriction",
    ),
    ("mit", "This plugin is released under the MIT license (see the file LICENSE)"),
    ("isc", "ISC License"),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any\n"
        "purpose with or without fee is hereby granted, provided that the above\n"
        "copyright notice and this permission notice appear in all copies.",
    ),
    ("isc", "SPDX-License-Identifier: ISC"),
    (
        "zlib",
        "This software is provided 'as-is', without any express or implied\n"
        "warranty. In no event will the authors be held liable for any damages\n"
        "arising from the use of this software.",
    ),
    ("zlib", "licensed under the zlib license"),
    (
        "bsd",
        "Redistribution and use in source and binary forms,\n"
        "with or without modification, are permitted\n"
        "provided that the following conditions\n"
        "are met:",
    ),
    (
        "bsd",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND\n"
        "ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED\n"
        "WARRANTIES OF MERCHANTABILITY ARE DISCLAIMED",
    ),
    ("bsd", "Use of this source code is governed by a BSD-style license: BSD-3-Clause"),
    ("bsd", "the driver is covered by the 2-clause BSD license"),
    ("bsd", "License :: BSD-2-Clause"),
    (
        "bsd",
        "Neither the name of the copyright holder nor the names of its\n"
        "contributors may be used to endorse or promote products derived from\n"
        "this software without specific prior written permission.",
    ),
    ("apache", "SPDX-License-Identifier: Apache-2.0"),
    ("apache", "our tools are Apache-2.0 software"),
    ("apache", "you may get this module under the Apache License 2.0, as all our modules"),
    (
        "apache",
        "   Licensed under the Apache License, Version 2.0 (the \"License\");\n"
        "   you may not use this file except in compliance with the License.",
    ),
    (
        "apache",
        "Unless required by applicable law or agreed to in writing, software\n"
        "distributed under the License is distributed on an \"AS IS\" BASIS,\n"
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND",
    ),
    ("apache", "The project is licensed under Apache-2.0."),
    ("gpl", "This file is under GPLv3"),
    ("gpl", "GPL v2 only"),
    (
        "gpl",
        "/*\n"
        " * This program is free software: you can redistribute it and/or modify\n"
        " * it under the terms of the GNU General Public License as published by\n"
        " * the Free Software Foundation, either version 3 of the License, or\n"
        " * (at your option) any later version.\n"
        " */",
    ),
    ("gpl", "MODULE_LICENSE(\"GPL v2\");"),
    ("gpl", "the kernel part is available under GPL-2.0"),
    ("gpl", "You should have received a copy of the GNU General Public License\nalong with this program.  If not, see the web."),
    ("gpl", "The game is distributed under the GNU GPL, like the engine"),
    ("agpl", "the server is covered by the GNU Affero General Public License version 3"),
    ("agpl", "SPDX-License-Identifier: AGPL-3.0-or-later"),
    ("agpl", "our service code is AGPLv3 licensed"),
    ("mpl", "Files in this folder are covered by the Mozilla Public License, v. 2.0"),
    (
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public\n"
        "License, v. 2.0. If a copy of the MPL was not distributed with this\n"
        "file, You can obtain one at the site.",
    ),
    ("mpl", "License: MPL-2.0"),
    (
        "epl",
        "This program and the accompanying materials are made available under the\n"
        "terms of the Eclipse Public License 2.0 which is available on the web",
    ),
    ("epl", "SPDX-License-Identifier: EPL-2.0"),
    ("boost", "Distributed under the Boost Software License, Version 1.0. (See accompanying file)"),
    ("boost", "this header comes under the Boost Software License"),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("unlicense", "License: Unlicense"),
]
CLEAN = [
    "she renewed her driving licence in the spring",
    "the shop has a license for beer and wine",
    "MIT opened a new lab",
    "permission was given by the school",
    "under the old bridge the river is wide",
    "Press releases are distributed under embargo",
    "the radio station must license the song",
    "a free copy of the book is in the library",
    "the general said that the public was safe",
    "software is provided by the firm at a low price",
    "an Apache chief of long ago",
    "they are liable for the damages after the storm",
    "the name of the holder stands on the card",
    "a zebra crossing and a licensed taxi",
    "the law requires that notice be given",
    "no warranty was left on the old fridge",
    "he is a member of the public and of the foundation",
    "conditions apply, said the waiter",
    "creative writing is a common hobby",
    "the source of the river is in the hills",
]


def test_unseen_wordings_and_layouts(spark):
    lines = [f"ordinary words about thing {i} and nothing else, of the sort that people write" for i in range(300)]
    inside = " ".join(lines[:30]) + " Released under the MIT License. " + " ".join(lines[30:60])
    unseen = [*UNSEEN, *((f, "# " + t.replace("\n", "\n# ").upper()) for f, t in UNSEEN)]
    rows = [(i, t) for i, t in enumerate(lines)] + [(1000 + k, t) for k, (_, t) in enumerate(unseen)] + [(2000 + k, t) for k, t in enumerate(CLEAN)]
    rows += [(3000, inside), (3001, "x " * 200_000 + "\n\nLicensed under the Apache License, Version 2.0"), (None, None), (3002, "one\n\n\n  \ntwo\nthree"), (3002, "one\n\n\n  \ntwo\nthree")]
    docs = spark.createDataFrame([(i, t, 1, "y") for i, t in rows], "doc_id bigint, text string, found int, licences string")
    model = licences.fit(docs)
    assert np.array_equal(model["weights"], licences.fit(docs.repartition(5))["weights"])
    got = {r["doc_id"]: r for r in licences.scan(docs, model).collect()}
    assert len(got) == len(rows) - 1
    named = [(f, got[1000 + k]["licences"]) for k, (f, _) in enumerate(unseen)]
    right = sum(f in held for f, held in named)
    wrong = sum(len(set(held) - {f}) for f, held in named) + sum(len(got[2000 + k]["licences"]) for k in range(len(CLEAN))) + sum(len(got[i]["licences"]) for i in range(300))
    assert len(unseen) > 100 and right >= 0.9 * len(unseen), named
    assert wrong <= 0.1 * (right + wrong), named
    assert not any(f == "lgpl" and "gpl" in held for f, held in named)
    assert got[3000]["licences"] == ["mit"] and got[3001]["licences"] == ["apache"] and got[3001]["n_paragraphs"] == 2
    assert got[3002]["n_paragraphs"] == 2 and got[None]["found"] == [] and licences.scan(docs.where("false"), model).count() == 0


def test_windows_and_probabilities_by_hand():
    words = [f"w{i}" for i in range(95)]
    text = " ".join(words).encode()
    got = licences._features(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    held = [got["data"][a:b].tobytes().decode().split() for a, b in zip(got["start"], got["end"], strict=True)]
    assert held == [words[k : k + licences.WINDOW] for k in (0, 20, 40, 60)]
    assert np.bincount(got["owner"]).tolist() == [2 * len(w) - 1 for w in held]
    weights = np.random.default_rng(1).normal(size=(licences.BUCKETS + 1, 3)).astype(np.float32)
    for k in range(4):
        own = got["bucket"][got["owner"] == k]
        want = weights[own].sum(axis=0) / np.sqrt(len(own)) + weights[-1]
        assert np.allclose(licences._logits(weights, got["owner"], got["bucket"], 4)[k], want, atol=1e-4)
