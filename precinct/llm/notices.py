"""What the licence classifier learns from: notices, and sentences that are none.

Sentences of licence texts stand here word for word. Lines that name a licence are built by
rule, from its names and versions and from the ways in which licences are named. The same ways
with names of other licences, and words of notices that go on in another sense, are unknown.
"""

from collections.abc import Iterator

UNKNOWN = "unknown"

# Sentences of licence texts and of the notices that their authors recommend.
TEXTS = {
    "agpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU Affero General Public License as published by the Free Software Foundation.",
    ),
    "apache": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this '
        "file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under "
        'the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY '
        "KIND, either express or implied.",
        "Licensed to the Apache Software Foundation (ASF) under one or more contributor license "
        "agreements.",
        "The ASF licenses this file to You under the Apache License, Version 2.0.",
    ),
    "boost": (
        "Distributed under the Boost Software License, Version 1.0. (See accompanying file "
        "LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a "
        "copy of the software and accompanying documentation covered by this license to use, "
        "reproduce, display, distribute, execute, and transmit the Software.",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials "
        "provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used "
        "to endorse or promote products derived from this software without specific prior "
        "written permission.",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY "
        "EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED.",
        "Use of this source code is governed by a BSD-style license that can be found in the "
        "LICENSE file.",
    ),
    "cc-by": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "cc-by-nc": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
        "International License.",
    ),
    "cc-by-sa": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
        "International License.",
    ),
    "eupl": (
        "Licensed under the EUPL, Version 1.2 or - as soon they will be approved by the European "
        "Commission - subsequent versions of the EUPL.",
        "You may not use this work except in compliance with the Licence.",
    ),
    "gpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        "PARTICULAR PURPOSE.",
        "You should have received a copy of the GNU General Public License along with this "
        "program.",
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with "
        "or without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies.",
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD "
        "TO THIS SOFTWARE.",
    ),
    "lgpl": (
        "This library is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU Lesser General Public License as published by the Free Software Foundation.",
        "You should have received a copy of the GNU Lesser General Public License along with "
        "this library.",
    ),
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction.",
        "The above copyright notice and this permission notice shall be included in all copies "
        "or substantial portions of the Software.",
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED',
        "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
        "PARTICULAR PURPOSE AND NONINFRINGEMENT.",
        "Use of this source code is governed by an MIT-style license that can be found in the "
        "LICENSE file.",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at "
        "http://mozilla.org/MPL/2.0/.",
    ),
    "proprietary": (
        "All rights reserved.",
        "Copyright by the author. All rights reserved.",
        "No part of this publication may be reproduced, distributed, or transmitted in any form "
        "without the prior written permission of the publisher.",
        "This document is confidential and proprietary and may not be copied or disclosed "
        "without the written consent of the owner.",
        "Unauthorized copying of this file, via any medium, is strictly prohibited.",
    ),
    "public-domain": (
        "This work is in the public domain.",
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has waived all copyright and related or "
        "neighboring rights to this work.",
    ),
}

# Names of licences by family, their versions, and their identifiers in lists of
# packages, without a version.
NAMES = {
    "agpl": (("GNU Affero General Public License", "GNU AGPL", "AGPL"), ("3", "3.0"), ("AGPL",)),
    "apache": (("Apache License", "Apache Software License"), ("2.0", "2"), ("Apache",)),
    "boost": (("Boost Software License",), ("1.0",), ("BSL",)),
    "bsd": (("BSD License", "BSD 2-Clause License", "BSD 3-Clause License"), (), ("BSD", "BSD-2-Clause", "BSD-3-Clause")),
    "cc-by": (("CC BY", "Creative Commons Attribution License"), ("4.0", "3.0"), ("CC-BY",)),
    "cc-by-nc": (
        ("CC BY-NC", "Creative Commons Attribution-NonCommercial License"),
        ("4.0", "3.0"),
        ("CC-BY-NC",),
    ),
    "cc-by-sa": (
        ("CC BY-SA", "Creative Commons Attribution-ShareAlike License"),
        ("4.0", "3.0"),
        ("CC-BY-SA",),
    ),
    "eupl": (("European Union Public Licence", "EUPL"), ("1.2", "1.1"), ("EUPL",)),
    "gpl": (("GNU General Public License", "GNU GPL", "GPL"), ("2", "3", "2.0", "3.0"), ("GPL",)),
    "isc": (("ISC License",), (), ("ISC",)),
    "lgpl": (
        ("GNU Lesser General Public License", "GNU LGPL", "LGPL"),
        ("2.1", "3", "3.0"),
        ("LGPL",),
    ),
    "mit": (("MIT License",), (), ("MIT",)),
    "mpl": (("Mozilla Public License", "MPL"), ("2.0", "1.1"), ("MPL",)),
    "public-domain": (("CC0", "CC0 Universal", "Unlicense"), ("1.0",), ("CC0",)),
}

# How works without a licence are marked.
OWNERS = ("Some One", "Acme Corporation", "Example Ltd", "the author", "2019 A. Writer", "2023 The Team")
RESERVED = (
    "Copyright {}. All rights reserved.",
    "Copyright (c) {}. All rights reserved.",
    "(c) {}. All rights reserved.",
    "{}. All rights reserved.",
    "All rights reserved by {}.",
    "All rights reserved. {}",
)
WORKS = ("work", "book", "image", "text", "code", "file", "song", "picture", "drawing", "program")
FREED = (
    "This {} is in the public domain.",
    "The {} is in the public domain.",
    "This {} has been released into the public domain.",
    "The author has dedicated the {} to the public domain.",
)

# Licences of no family here, with a version and an identifier.
STRANGERS = (
    ("Eclipse Public License", "2.0", "EPL"),
    ("zlib License", "1.2", "Zlib"),
    ("Artistic License", "2.0", "Artistic"),
    ("CeCILL Free Software License", "2.1", "CECILL"),
    ("SIL Open Font License", "1.1", "OFL"),
    ("Microsoft Public License", "1.0", "MS-PL"),
    ("Common Development and Distribution License", "1.0", "CDDL"),
    ("Academic Free License", "3.0", "AFL"),
    ("Open Software License", "3.0", "OSL"),
    ("PHP License", "3.01", "PHP"),
    ("Zope Public License", "2.1", "ZPL"),
    ("PostgreSQL License", "1.0", "PostgreSQL"),
    ("LaTeX Project Public License", "1.3", "LPPL"),
    ("Business Source License", "1.1", "BUSL"),
    ("Open Database License", "1.0", "ODbL"),
    ("Q Public License", "1.0", "QPL"),
)

# Ways in which a work names its licence; the first is the notice that a paragraph is held to.
WAYS = (
    "Licensed under the {}.",
    "Released under the {}.",
    "This work is licensed under the {}.",
    "This file is distributed under the terms of the {}.",
    "The code is available under {}.",
    "You can redistribute it under the terms of the {}.",
    "Published under the {}; see the file LICENSE.",
    "This project is covered by the {}",
)
IDENTIFIED = "SPDX-License-Identifier: {}"

# Beginnings that notices share with other sentences, and what makes them other sentences.
BEGINNINGS = (
    "All rights reserved",
    "The copyright",
    "The license",
    "Public domain",
    "The above notice",
    "Permission",
    "Free software",
    "Redistribution",
    "A BSD or MIT",
    "The Apache",
    "The Mozilla",
    "The ISC or the EUPL",
    "The GNU and the GPL",
    "Creative Commons",
    "The boost",
    "The warranty",
)
GOINGS_ON = (
    "seats are sold.",
    "tickets were returned to the office.",
    "was discussed by the board for years.",
    "is a topic of the book on page 3.",
    "of the city is not known to them.",
    "has a long history in the country.",
    "will be taught at the university.",
    "for members is 20 a year.",
    "and what it means for us.",
    "had nothing to do with it.",
    "of the trains in the north was asked for.",
    "or not, he went on and said so.",
)

# Sentences with words of notices that license nothing.
OTHERS = (
    "The driver had no license and the car was registered under another name.",
    "The version of the story that the public knows is reserved and free of color.",
    "All seats in the hall are reserved for the members of the foundation.",
    "You need permission of the owner to use the road in the following conditions.",
    "The copyright office is open to the public from ten to four.",
    "Civil rights are not for sale, and all rights matter.",
    "The warranty of the machine covers all parts for two years.",
    "The terms of the agreement were not published.",
    "Permission denied: the file could not be opened.",
    "A license to fish is sold in the general store.",
    "The software was released in version 3 and the source is distributed in two parts.",
    "The library lends copies of public documents free of charge.",
    "He studied at MIT and wrote on modified forms of distribution.",
    "The letter was sent to all of them, with a cc by mail to the office.",
)


def versioned(name: str, versions: tuple[str, ...]) -> list[str]:
    return [name, *(f"{name}{form}{v}" for v in versions for form in (", version ", " v", " "))]


def identifiers(stem: str, versions: tuple[str, ...]) -> list[str]:
    forms = [f"{stem}-{v}{end}" for v in versions for end in ("", "-only", "-or-later")]
    return [stem, *forms]


def templates() -> dict[str, tuple[str, ...]]:
    """The notices of each family that a paragraph is compared with."""
    out = {family: list(texts) for family, texts in TEXTS.items()}
    for family, (names, _, stems) in NAMES.items():
        out[family] += [WAYS[0].format(name) for name in names]
        out[family] += [IDENTIFIED.format(stem) for stem in stems]
        out[family] += [f"under {name}" for name in names if name.isupper()]
        # Two words such as GNU GPL are a notice by themselves.
        out[family] += [n for n in names if len(n.split()) == 2 and n.isupper()]
    return {family: tuple(own) for family, own in out.items()}


NOTICES = templates()


def spoken(names: tuple[str, ...], versions: tuple[str, ...], stems: tuple[str, ...]) -> list[str]:
    """Lines that name a licence, in all ways, versions and forms."""
    lines = []
    for name in names:
        for i, form in enumerate(versioned(name, versions)):
            lines += [way.format(form) for way in (WAYS if i < 2 else WAYS[i % 3 :: 3])]
            lines += [form, f"under {form}"] if name.isupper() else []
    return lines + [IDENTIFIED.format(i) for s in stems for i in identifiers(s, versions)]


def lessons() -> Iterator[tuple[str, str, int]]:
    """Family, line and part: 0 is learned, 1 is for calibration only.

    Notices are taken whole and without their first or last words. Of the licences of no
    family, those for calibration are others than those learned.
    """
    for family, own in TEXTS.items():
        for notice in own:
            words = notice.split()
            for cut in range(min(4, max(1, len(words) // 3))):
                yield family, " ".join(words[cut:]), cut % 2
                yield family, " ".join(words[: len(words) - cut]), cut % 2
    for family, named in NAMES.items():
        for i, line in enumerate(spoken(*named)):
            yield family, line, i % 5 // 4
    for ways, things, family in (RESERVED, OWNERS, "proprietary"), (FREED, WORKS, "public-domain"):
        for i, way in enumerate(ways):
            for k, thing in enumerate(things):
                yield family, way.format(thing), (i + k) % 4 // 3
    for i, (name, version, stem) in enumerate(STRANGERS):
        for line in spoken((name,), (version,), (stem,)):
            yield UNKNOWN, line, i % 3 // 2
    for i, begin in enumerate(BEGINNINGS):
        for k, end in enumerate(GOINGS_ON):
            yield UNKNOWN, f"{begin} {end}", (i + k) % 4 // 3
    for i, line in enumerate(OTHERS):
        yield UNKNOWN, line, i % 4 // 3
