"""Canonical forms and digest lookup."""

from collections import Counter

from llm_cases import documents, empty, frame

from claimsdq.llm.licenses import KNOWN, canonical, known_digests, scan_licenses

MIT = next(t for n, t in KNOWN if n == "MIT" and len(t) > 500)


def forms(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.form for r in canonical(df, "t", "form").orderBy("i").collect()]


def test_equal_forms(spark):
    plain, *others = forms(spark, [
        MIT, MIT.upper(), "Copyright (c) 2020 Someone\n" + MIT, MIT.replace('"', "“"), MIT.replace("\n", "  \r\n"),
        "  (C) 1999 Ä. Über\n\n" + MIT.replace("sublicense", "sub-license") + "\n\nAll rights reserved.",
        MIT.replace("MIT License", "MIT Licence"), "© 2001, x\n" + MIT + "\ncopyright by nobody"])
    assert plain and all(o == plain for o in others)
    assert forms(spark, ["", "  \n ", "!!!", "Copyright 2020 A", "All rights reserved."]) == [""] * 5


def test_different_texts_keep_different_forms(spark):
    a, b, c = forms(spark, [MIT, MIT.replace("WITHOUT WARRANTY", "WITH WARRANTY"), "über"])
    assert a != b and c == "über"


def test_whole_texts_and_lines_are_found(spark):
    c = ["c"] * 8
    rows = [(1, "Copyright (c) 2021 Me\n\n" + MIT, "en", "s", 0, *c),
            (2, "prose\nreleased under the mit licence!\nmore\n Licensed under CC BY-NC 4.0\nend", "en", "s", 0, *c),
            (3, "I once released under the MIT License a thing", "en", "s", 0, *c),
            (4, "Released under the MIT License.", "en", "s", 0, *c), (5, None, "en", "s", 0, *c),
            (5, None, "en", "s", 0, *c), (None, "Released under the MIT License.", "en", "s", 0, *c)]
    got = {r.doc_id: (r.text_license, r.licenses, r.n_license_lines) for r in scan_licenses(frame(spark, rows)).collect()}
    assert got[1][0] == "MIT" and got[2] == (None, "CC-BY-NC-4.0,MIT", 2) and got[3] == (None, "", 0)
    assert got[4] == ("MIT", "MIT", 1) == got[None] and got[5] == (None, "", 0)
    assert scan_licenses(frame(spark, rows)).count() == 6


def test_matches_a_lookup_in_python(spark):
    rows = documents(20, n=40)
    lines = [t for _, t in KNOWN if "\n" not in t]
    rows = [(r[0], (r[1] or "") + ("\n" + lines[i % len(lines)] if i % 3 == 0 else ""), *r[2:]) for i, r in enumerate(rows)]
    known = dict(zip(forms(spark, [t for _, t in KNOWN]), [n for n, _ in KNOWN]))
    texts = [t for r in rows for t in [r[1], *r[1].split("\n")]]
    form = dict(zip(texts, forms(spark, texts)))
    want = Counter()
    for r in rows:
        hits = [known[form[x]] for x in r[1].split("\n") if form[x] in known]
        whole = known.get(form[r[1]])
        want[r[0], whole, ",".join(sorted({*hits, *([whole] if whole else [])})), len(hits)] += 1
    got = Counter((g.doc_id, g.text_license, g.licenses, g.n_license_lines) for g in scan_licenses(frame(spark, rows)).collect())
    assert got == want


def test_known_table_and_empty_input(spark):
    known = known_digests(spark).collect()
    assert len(known) == len({k.known_digest for k in known}) >= 12
    assert scan_licenses(empty(spark)).count() == 0
    own = scan_licenses(frame(spark, [(1, "My  terms", "en", "s", 0, *["c"] * 8)]), (("Own", "my TERMS."),)).first()
    assert own.text_license == "Own"
