"""Canonical forms do not depend on where lines are broken."""

import textwrap

import pytest

from claimsdq.llm.licenses import KNOWN, canonical

FULL = [t for _, t in KNOWN if "\n" in t or len(t) > 200]


@pytest.fixture(scope="module")
def forms(spark):
    def run(texts):
        df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
        return [r.form for r in canonical(df, "t", "form").orderBy("i").collect()]
    return run


def wrapped(text, width):
    one = " ".join(text.split())
    return textwrap.fill(one, width, break_long_words=False, break_on_hyphens=False) if width else one


def test_known_texts_rewrapped(forms):
    widths = [0, 1, 20, 30, 40, 55, 66, 72, 80, 100, 120]
    plain, *others = [forms([wrapped(t, w) for t in FULL]) for w in widths]
    assert plain == forms(FULL) and all(o == plain for o in others)


def test_own_statement_before_rewrapped_texts(forms):
    mit = next(t for t in FULL if t.startswith("Permission is hereby granted, free of charge, to any person obtaining a copy of this"))
    want, *got = forms([mit] + [head + wrapped(mit, w) for w in (0, 33, 60, 79) for head in (
        "Copyright (c) 2020 Some One ", "Copyright 2001-2020 X Inc., All rights reserved. ", "© 2020 D.J. Ä. Über\n\n", "(C) 1999 x\n",
        "Copyright by Nobody\n", "Copyright Acme Corp.\r\nCopyright (c) 2001 B\r\n")])
    assert got == [want] * len(got)


def test_only_statements_go(forms):
    texts = {
        "Copyright 2020 X. Released under the MIT License.": "released under the mit license",
        "Copyright (c) 2020 Some One Licensed under CC BY 4.0.": "licensed under cc by 4 0",
        "copyright notice and this permission notice": "copyright notice and this permission notice",
        "COPYRIGHT HOLDERS BE LIABLE": "copyright holders be liable", "copyright owner, or": "copyright holder or",
        "(c) You must retain notices": "c you must retain notices", "Copyright 2020 Long Holder. More prose": "more prose",
        "Copyright law": "copyright law", "Copyright 2020 A\nsecond line": "second line"}
    assert forms(list(texts)) == list(texts.values())


def test_long_lines(forms):
    assert forms(["Copyright 2020 " + "word " * 50_000 + "end"])[0].endswith("word end")
    assert forms(["Copyright 2020 " + "x" * 200_000]) == [""]
