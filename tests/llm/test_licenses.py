import math
import re

import pytest

from precinct.llm import licenses, notices
from precinct.llm.licenses import HINTS, fit, scan
from precinct.llm.notices import NOTICES, UNKNOWN
from tests.llm.conftest import EDGES


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(i, f"Plain line {i} of some text.\nAnother one about {i % 7} things.", "en", "a", 1) for i in range(400)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")


@pytest.fixture(scope="module")
def model(corpus):
    return fit(corpus)


def test_every_notice_passes_the_hints():
    pattern = re.compile(HINTS)
    assert all(pattern.search(n) for own in NOTICES.values() for n in own)


def test_notices_are_found_and_other_text_is_not(spark, model, make_docs):
    texts, want = [], {}
    for family, own in NOTICES.items():
        for notice in own:
            want[len(texts)] = family
            texts.append(f"Some text before.\n{notice.upper()}\nAnd after it the story goes on.")
    first_plain = len(texts)
    texts += list(notices.OTHERS) + [
        "He lost his license on the way to the public garden.",
        "The permission slip was signed by all of them.",
    ]
    docs = make_docs(texts)
    rows = scan(docs, model).filter("confirmed").collect()
    found = {r["doc_id"]: r["family"] for r in rows}
    assert found == want
    per_document = licenses.licenses(docs, scan(docs, model)).collect()
    assert len(per_document) == len(texts)
    for row in per_document:
        if row["doc_id"] < first_plain:
            assert (row["n_notices"], row["families"]) == (1, want[row["doc_id"]])
            assert 0.5 <= row["probability"] <= 1
        else:
            assert (row["n_notices"], row["families"], row["probability"]) == (0, "", 0.0)


def test_several_families_in_a_document(model, make_docs):
    docs = make_docs(["Released under the MIT License.\nx\nAll rights reserved.\nAll rights reserved."])
    row = licenses.licenses(docs, scan(docs, model)).first()
    assert (row["n_notices"], row["families"]) == (2, "mit,proprietary")


MIT = """MIT License

Copyright (c) 2020 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software.
"""
GPL = """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.
#
import os
"""
BSD = """ * Redistribution and use in source and binary forms, with or without
 * modification, are permitted provided that the following conditions
 * are met:
"""


def test_wrapped_notices(model, make_docs):
    long = "\n".join(f"line {i} of a story without end" for i in range(60))
    docs = make_docs([MIT, GPL, BSD, long + "\n" + GPL + long, long])
    rows = licenses.licenses(docs, scan(docs, model)).collect()
    found = {r["doc_id"]: (r["n_notices"], r["families"]) for r in rows}
    assert found == {0: (1, "mit"), 1: (1, "gpl"), 2: (1, "bsd"), 3: (1, "gpl"), 4: (0, "")}


def test_lines_without_hints(model, make_docs):
    texts = ["This work is available under CC BY-NC 4.0.", "Available under CC BY-SA 4.0."]
    docs = make_docs(texts)
    rows = scan(docs, model).filter("confirmed").collect()
    assert {r["doc_id"]: r["family"] for r in rows} == {0: "cc-by-nc", 1: "cc-by-sa"}


def test_what_is_left_out_could_not_pass(model, make_docs, monkeypatch):
    texts = [n for own in NOTICES.values() for n in own] + list(notices.OTHERS) + [MIT, GPL, BSD]
    texts += [" ".join(t.split()[i::3]) for t in texts[:] for i in range(3)]
    docs = make_docs(texts)
    some = {tuple(r) for r in scan(docs, model).collect()}
    monkeypatch.setattr(licenses, "needed", lambda model: "")
    assert {tuple(r)[:3] for r in scan(docs, model).collect()} == {r[:3] for r in some}


def test_edges(model, edges, nothing):
    rows = licenses.licenses(edges, scan(edges, model)).collect()
    assert len(rows) == len(EDGES) and all(r["n_notices"] == 0 for r in rows)
    clashing = edges.selectExpr("*", "1 AS line", "2 AS family", "3 AS terms")
    assert scan(clashing, model).count() == 0
    assert scan(nothing, model).count() == 0 and licenses.licenses(nothing, scan(nothing, model)).count() == 0
    assert fit(nothing).families[-1] == licenses.UNKNOWN


# Lines that the model has not seen, by family.
HELD_OUT = {
    "agpl": (
        "Foo is licensed under the terms of the GNU Affero General Public License v3.0.",
        "// SPDX-License-Identifier: AGPL-3.0",
        "The server is released under AGPLv3, that is the GNU AGPL version 3.",
    ),
    "apache": (
        "Licensed to the Apache Software Foundation (ASF) under one or more agreements.",
        "# SPDX-License-Identifier: Apache-2.0",
        "We publish all of our tools under the Apache License 2.0.",
        "Foo is Open Source software released under the Apache 2.0 license.",
        "you may not use this file except in compliance with the License, the Apache License.",
    ),
    "boost": (
        "Distributed under the Boost Software License, Version 1.0.",
        "SPDX-License-Identifier: BSL-1.0",
        "Use, modification and distribution are subject to the Boost Software License, version 1.0.",
    ),
    "bsd": (
        "SPDX-License-Identifier: BSD-2-Clause",
        "Released under the 3-clause BSD License.",
        "The parser is provided under the BSD License; see below.",
        "Redistribution and use of this software in source and binary forms, with or without "
        "modification, are permitted provided that the following conditions are met:",
    ),
    "cc-by": (
        "The text is available under CC BY 4.0.",
        "Except where noted, the content is licensed under a Creative Commons Attribution 4.0 "
        "International license.",
    ),
    "cc-by-nc": (
        "This work is available under CC BY-NC 4.0.",
        "Photos are licensed under a Creative Commons Attribution-NonCommercial 3.0 License.",
    ),
    "cc-by-sa": (
        "Available under CC BY-SA 4.0.",
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
    ),
    "eupl": (
        "Licensed under the EUPL, Version 1.2 only.",
        "SPDX-License-Identifier: EUPL-1.2",
        "The portal is published under the European Union Public Licence (EUPL) v1.2.",
    ),
    "gpl": (
        "SPDX-License-Identifier: GPL-2.0-only",
        "GNU GPL v2",
        "The kernel is under the terms of the GNU General Public License, version 2.",
        "You should have received a copy of the GNU General Public License along with Foo.",
        "This module is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
        "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    ),
    "isc": (
        "SPDX-License-Identifier: ISC",
        "Licensed under the ISC license.",
        "Permission to use, copy, modify, and distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies.",
    ),
    "lgpl": (
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "The library is licensed under the GNU Lesser General Public License, version 2.1.",
        "You should have received a copy of the GNU Lesser General Public License along with Foo.",
    ),
    "mit": (
        "/* SPDX-License-Identifier: MIT */",
        "Foo is released under the MIT License by its authors.",
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED.',
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, '
        "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY.",
        "Permission is granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files, to deal in the Software without restriction.",
    ),
    "mpl": (
        "This file is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
        "The browser is licensed under the Mozilla Public License 2.0.",
    ),
    "proprietary": (
        "Copyright 2021 Foo Ltd. All rights reserved.",
        "(c) Some One. All Rights Reserved.",
        "No part of this book may be reproduced or transmitted in any form without the prior "
        "written permission of the publisher.",
    ),
    "public-domain": (
        "The map is in the public domain.",
        "SPDX-License-Identifier: CC0-1.0",
        "Data are released under CC0 1.0.",
    ),
}
# Lines of no family that the model has not seen: other licences, and words of notices.
NO_NOTICE = (
    "All rights reserved seats are sold.",
    "All rights reserved for the heirs were sold at auction.",
    "The rights of the tenants were reserved in all later contracts.",
    "Licensed under the Sleepycat License.",
    "Released under the NetHack General License.",
    "SPDX-License-Identifier: Vim",
    "SPDX-License-Identifier: NCSA",
    "This file is distributed under the terms of the Ruby License.",
    "The public domain was the topic of the lecture on Monday.",
    "A licensed electrician came to see the wires under the floor.",
    "The general public was not let in without a license.",
    "His driving license, version 2, had a photo that was out of date.",
    "The foundation gave the software to schools, free of charge.",
    "Creative people share what they make in common rooms.",
    "The permission of the owner is needed to copy keys of the building.",
    "Mozilla moved its office to another part of the city.",
    "The Apache were known as riders, and their horses as fast.",
    "She went to MIT and to Berkeley, and wrote about compilers.",
    "The warranty of the car is limited to two years from the day it was sold.",
    "Conditions for the use of the hall are found in the file at the entrance.",
    "The redistribution of land took years, with or without modification of the law.",
    "He asked for a copy of the notice that hung above the door.",
    "The union of European states published a licence for fishing in open waters.",
    "A boost in sales of software was due to the new version.",
)


def plain_scores(model, line):
    """Family, probability and shared part of a line, worked out without Spark."""

    def terms(text):
        w = re.findall("[a-z0-9]+", text.lower())
        return {*w, *(f"{a} {b}" for a, b in zip(w, w[1:]))}

    own, weights = terms(line), dict(model.weights)
    sums = list(model.offsets)
    for term in own:
        for i, w in enumerate(weights.get(term, ())):
            sums[i] += w
    parts = [math.exp((m - max(sums)) / model.temperature) for m in sums]
    best = max(range(len(sums) - 1), key=lambda i: parts[i])
    family = model.families[best]
    wanted = [terms(n) for n in NOTICES[family]]
    return family, parts[best] / sum(parts), max(len(w & own) / len(w) for w in wanted)


def test_held_out_lines(model, make_docs):
    """Precision and recall on lines not learned, by family."""
    known = [(family, line) for family, own in HELD_OUT.items() for line in own]
    learned = {line for _, line, _ in notices.lessons()}
    known = [(f, x) for f, x in known if x not in learned]
    assert len(known) >= 40
    cases = known + [(UNKNOWN, line) for line in NO_NOTICE]
    docs = make_docs([line for _, line in cases])
    rows = scan(docs, model).filter("confirmed").collect()
    found = {r["doc_id"]: r["family"] for r in rows}
    right = sum(found.get(i) == family for i, (family, _) in enumerate(known))
    wrong = [(cases[i], f) for i, f in found.items() if cases[i][0] != f]
    missed = [c for i, c in enumerate(known) if found.get(i) != c[0]]
    assert right / len(known) >= 0.95, (missed, [plain_scores(model, x) for _, x in missed])
    assert right / (right + len(wrong)) >= 0.95, wrong


def test_scan_equals_a_plain_scorer(model, make_docs):
    """Single lines, with a blank one between: each is scored by itself."""
    lines = [x for own in HELD_OUT.values() for x in own] + list(NO_NOTICE)
    lines += [n for own in NOTICES.values() for n in own] + [x for _, x, _ in list(notices.lessons())[::7]]
    docs = make_docs(["\n\n".join(lines[i : i + 10]) for i in range(0, len(lines), 10)])
    want = set()
    for i, line in enumerate(lines):
        family, probability, shared = plain_scores(model, line)
        if probability >= model.bound:
            want.add((i // 10, line, family, round(probability, 6), round(shared, 6)))
    rows = scan(docs, model).collect()
    got = {(r[0], r[1], r[2], round(r["probability"], 6), round(r["shared"], 6)) for r in rows}
    assert got == want


def test_documents_without_an_id(spark, model):
    rows = [(None, "Released under the MIT License."), (None, "Nothing here."), (1, "Nothing.")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = licenses.licenses(docs, scan(docs, model)).collect()
    counts = sorted((r["doc_id"] or 0, r["n_notices"]) for r in got)
    assert counts == [(0, 1), (0, 1), (1, 0)]
