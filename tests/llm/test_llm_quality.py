"""Figures against plain counting; verdicts do not depend on the order."""

import itertools
import re
from collections import Counter

from llm_cases import documents, empty, frame, prose

from claimsdq.llm.quality import (BASE, FIGURES, RULES, Measures, RuleCost, assess, first_rejection, keep_clean,
                                  measure_rules, order_rules)


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def plain(t):
    w = words(t)
    grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    n = Counter(grams)
    hit = {p for i, g in enumerate(grams) if n[g] > 1 for p in range(i, i + 5)}
    lines = [x for x in (t or "").split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(hit))


CASES = [None, "", " ", "a b c d e a b c d e", "x " * 50, "1 2 3 4 5 6 1 2 3 4 5 7 8 1 2 3 4 5",
         "a\nb\na\n\n \nb\na", "### a** b%% <c>", "\x1c \x85 　é", "a b c d e f"]


def test_figures(spark):
    for t in CASES + [r[1] for r in documents(11)]:
        m = Measures(t)
        assert tuple(getattr(m, f) for f in FIGURES) == plain(t), t


def test_assess_matches_plain_rules(spark):
    rows = documents(12) + [(1000 + i, t, "en", "s", 0, *["c"] * 8) for i, t in enumerate(CASES)]
    got = assess(frame(spark, rows))
    assert got.columns == ["doc_id", *FIGURES, "base_failed", "kept"]
    want = Counter()
    for r in rows:
        f = plain(r[1])
        failed = f[0] < 10 or 100 * f[4] > 20 * f[0]
        lines = len([x for x in (r[1] or "").split("\n") if words(x)])
        ok = not failed and 10 * f[2] <= 3 * f[0] and 2 * f[3] <= lines and f[1] <= 40 * f[0]
        want[(r[0], *f, failed, ok)] += 1
    assert Counter(map(tuple, got.collect())) == want


def test_verdict_is_the_same_in_every_order(spark):
    texts = CASES + [r[1] for r in documents(13)]
    want = [first_rejection(Measures(t), RULES) is None for t in texts]
    for order in itertools.permutations(RULES):
        assert [first_rejection(Measures(t), order) is None for t in texts] == want


def test_order_is_rejection_per_cost():
    costs = [RuleCost("few_words", 4.0, 0.4), RuleCost("repeated_words", 1.0, 0.2), RuleCost("symbols", 1.0, 0.0),
             RuleCost("repeated_lines", 0.1, 0.05), RuleCost("word_length", 1.0, 0.0)]
    assert [r.name for r in order_rules(costs)] == ["repeated_lines", "repeated_words", "few_words", "symbols", "word_length"]


def test_sample_is_measured_and_bounded(spark):
    docs = frame(spark, documents(14))
    costs = measure_rules(docs, sample_rows=30)
    assert [c.name for c in costs] == [r.name for r in RULES]
    assert all(c.seconds > 0 and 0 <= c.rejected <= 1 for c in costs)
    assert any(c.rejected > 0 for c in costs)
    assert [c.rejected for c in measure_rules(empty(spark))] == [0.0] * len(RULES)


def test_short_circuit_computes_no_more_than_it_needs():
    m = Measures("one two")
    assert first_rejection(m, BASE) == "few_words"
    assert "n_repeat_words" not in m.__dict__


def test_keep_clean_keeps_rows_and_columns(spark):
    rows = documents(15) + [(500, "*** ".join(prose_words), "en", "s", 0, *["c"] * 8) for prose_words in [["w"] * 30]]
    docs = frame(spark, rows)
    kept = keep_clean(docs)
    assert kept.columns == docs.columns and kept.schema == docs.schema
    want = Counter(r for r in rows if first_rejection(Measures(r[1]), RULES) is None)
    assert Counter(map(tuple, kept.collect())) == want
    assert 0 < sum(want.values()) < len(rows)
    assert keep_clean(empty(spark)).count() == 0 and assess(empty(spark)).count() == 0


def test_labelled_junk_goes_and_good_text_stays(spark):
    sf = "/root/testdata/sf0.01"
    got = assess(spark.read.parquet(f"{sf}/documents.parquet")).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    n = {(r.quality, r.kept): r["count"] for r in got.filter("n_words >= 10").groupBy("quality", "kept").count().collect()}
    assert n.get((1, False), 0) <= 0.02 * n[(1, True)]
    assert n.get((0, False), 0) >= 0.8 * (n.get((0, False), 0) + n.get((0, True), 0))
