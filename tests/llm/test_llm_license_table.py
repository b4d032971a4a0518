"""Every licence of the table is found by its whole text, tags and notices."""

import pytest
from llm_cases import frame

from claimsdq.llm.license_texts import TEXTS
from claimsdq.llm.licenses import KNOWN, scan_licenses

FULL = {"0BSD", "Apache-2.0", "Artistic-1.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC-BY-SA-4.0", "CC0-1.0", "GFDL-1.2",
        "GFDL-1.3", "GPL-1.0", "GPL-2.0", "GPL-3.0", "ISC", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-1.1", "MPL-2.0", "NCSA",
        "OFL-1.1", "Unicode-3.0", "Unlicense", "Zlib"}


@pytest.fixture(scope="module")
def scan(spark):
    def run(texts):
        rows = [(n, t, "en", "s", 0, *["c"] * 8) for n, t in enumerate(texts)]
        found = {r.doc_id: r for r in scan_licenses(frame(spark, rows)).collect()}
        return [found[n] for n in range(len(rows))]
    return run


def test_whole_texts(scan):
    assert {n for n, _ in TEXTS} >= FULL
    own = [f"Copyright (c) 2021 Some One\n\n{t}" for _, t in TEXTS]
    upper = [t.upper().replace("\n", "  \r\n") for _, t in TEXTS]
    for texts in ([t for _, t in TEXTS], own, upper):
        assert [r.text_license for r in scan(texts)] == [n for n, _ in TEXTS]


def test_each_form_has_one_license(spark):
    from claimsdq.llm.licenses import canonical
    df = spark.createDataFrame(list(KNOWN), "license string, t string")
    names = {}
    for r in canonical(df, "t", "form").collect():
        names.setdefault(r.form, set()).add(r.license)
    assert [sorted(x) for x in names.values() if len(x) > 1] == []


def test_tags_and_notices(scan):
    want = [("// SPDX-License-Identifier: Apache-2.0", "Apache-2.0"), ("# SPDX-License-Identifier: GPL-2.0-or-later", "GPL-2.0-or-later"),
            ("/* SPDX-License-Identifier: MIT */", "MIT"), ("SPDX-License-Identifier: GPL-3.0-only", "GPL-3.0"),
            ("GPL version 2 or later", "GPL-2.0-or-later"), ("Licensed under the GNU GPL v3 or any later version.", "GPL-3.0-or-later"),
            ("CC BY 4.0 International", "CC-BY-4.0"), ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "CC-BY-4.0"),
            ("License: MIT", "MIT"), ("This project is licensed under the BSD 3-Clause License.", "BSD-3-Clause"),
            ("Distributed under the Boost Software License, Version 1.0.", "BSL-1.0"), ("Released under the Apache License 2.0", "Apache-2.0"),
            ("Licensed under CC BY-NC-SA 3.0 Unported", "CC-BY-NC-SA-3.0"), ("MIT", None), ("Apache", None), ("the license", None)]
    got = scan([f"prose\n{t}\nmore prose" for t, _ in want])
    assert [r.licenses for r in got] == [n or "" for _, n in want]
    assert [r.text_license for r in got] == [None] * len(want)
