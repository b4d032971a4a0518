"""Targets against plain water filling, quotas and draws against their laws."""

import math
import random
import re
import time
from collections import Counter, defaultdict

import pytest
from llm_cases import documents, empty, frame
from pyspark.sql import functions as F

from claimsdq.llm.mixing import first_words, hypergeometric, leaf_quotas, mix, plan_mix, source_targets

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def n_words(t):
    return len(WORD.findall(t or ""))


def plain_targets(sizes, weights=(1, 2, 3), repeat=3):
    """Share by weight; what is above a cap goes to the others until none is."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(repeat * sizes[s] for s in full)
        open_w = sum(w[s] for s in order if s not in full)
        t = {s: repeat * sizes[s] if s in full else left * w[s] / open_w for s in order}
        above = {s for s in order if s not in full and t[s] > repeat * sizes[s]}
        if not above:
            return t
        full |= above


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 1000, "b": 1, "c": 2, "d": 0, None: 50},
    {"x": 5}, {"a": 10, "b": 0, "é": 3, "Z": 700, "z": 2, None: 1}, {"a": 0, "b": 0}])
def test_targets_match_the_rounds(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in source_targets(df, [1, 2, 3], 3).collect()}
    want = plain_targets(sizes)
    assert got.keys() == want.keys()
    assert all(math.isclose(got[s], want[s], abs_tol=1e-9) for s in want)


@pytest.mark.parametrize("good,bad,draws", [(10, 5, 7), (900, 3000, 500), (3, 10 ** 6, 400_000), (10 ** 5, 10 ** 5, 10 ** 5)])
def test_hypergeometric_mean_and_variance(spark, good, bad, draws):
    n = 6000
    x = [r[0] for r in spark.range(n).select(hypergeometric(F.lit(good), F.lit(bad), F.lit(draws), F.col("id"))).collect()]
    mean = draws * good / (good + bad)
    var = mean * bad / (good + bad) * (good + bad - draws) / (good + bad - 1)
    assert all(max(0, draws - bad) <= v <= min(good, draws) for v in x)
    assert abs(sum(x) / n - mean) < 5 * math.sqrt(var / n)
    assert 0.9 < sum((v - mean) ** 2 for v in x) / n / var < 1.1


def test_hypergeometric_small_law_and_ends(spark):
    x = Counter(r[0] for r in spark.range(20_000).select(
        hypergeometric(F.lit(4), F.lit(3), F.lit(3), F.col("id"))).collect())
    for k in range(4):
        p = math.comb(4, k) * math.comb(3, 3 - k) / math.comb(7, 3)
        assert abs(x[k] / 20_000 - p) < 5 * math.sqrt(p * (1 - p) / 20_000)
    ends = [(5, 0, 3, 3), (0, 5, 3, 0), (5, 5, 0, 0), (5, 5, 10, 5), (0, 0, 0, 0)]
    df = spark.createDataFrame(ends, "g long, b long, d long, want long")
    assert all(r.got == r.want for r in df.withColumn("got", hypergeometric(F.col("g"), F.col("b"), F.col("d"), F.lit(1))).collect())


def check_quotas(spark, rows, depth, weights=(1, 2, 3)):
    """Quotas of given (source, leaf, words): exact in sum, within each leaf."""
    leaves = spark.createDataFrame(rows, "source string, leaf int, words long")
    sizes = leaves.groupBy("source").agg(F.sum("words").alias("source_size"))
    targets = source_targets(sizes, list(weights), 3)
    got = leaf_quotas(leaves, targets, depth, 7).collect()
    words = {(s, leaf): n for s, leaf, n in rows}
    assert sorted(map(str, words)) == sorted(str((q.source, q.leaf)) for q in got)   # each leaf with documents once
    total, whole = defaultdict(int), {}
    for q in got:
        assert 0 <= q.leaf_quota <= words[q.source, q.leaf]
        total[q.source] += q.leaf_quota
        whole[q.source] = q.epochs * q.source_size
    assert {s: n + whole[s] for s, n in total.items()} == {r.source: r.quota for r in targets.collect()}
    return got


def test_leaf_quotas_sum_and_fit(spark):
    r = random.Random(1)
    check_quotas(spark, [(s, leaf, r.randint(0, 500)) for s in ("a", None, "c") for leaf in range(16) if r.random() < 0.8], 4)


@pytest.mark.parametrize("depth", [0, 1, 7, 10, 14])
def test_quota_trees_of_any_depth(spark, depth):
    r = random.Random(depth)
    rows = [(s, leaf, r.randint(0, 3000)) for s in ("a", None, "c") for leaf in range(1 << depth) if r.random() < 0.9 or depth == 0]
    began = time.monotonic()
    got = check_quotas(spark, rows, depth)
    assert time.monotonic() - began < 60
    if depth >= 7:      # the draws follow the words: no part of the tree is favoured
        words = defaultdict(int)
        for s, leaf, n in rows:
            words[s, leaf * 4 >> depth] += n
        for s in ("a", None, "c"):
            own = [sum(q.leaf_quota for q in got if q.source == s and q.leaf * 4 >> depth == part) for part in range(4)]
            share = sum(own) / sum(words[s, part] for part in range(4))
            assert all(abs(n / words[s, part] - share) < 0.05 for part, n in enumerate(own))


def test_a_thousand_sources(spark):
    r = random.Random(3)
    rows = [(f"host{s}", leaf, r.randint(1, 90)) for s in range(1000) for leaf in range(32) if r.random() < 0.4]
    began = time.monotonic()
    check_quotas(spark, rows, 5)
    assert time.monotonic() - began < 60


def test_rows_that_share_an_identifier(spark):
    rows = [(None, f"word {i} " * 5, "en", "s", 0, *["c"] * 8) for i in range(300)]
    rows += [(7, f"other {i} " * 5, "en", "t", 0, *["c"] * 8) for i in range(300)]
    got = plan_mix(frame(spark, rows), leaf_docs=20, min_depth=3).collect()
    assert len({g.shard for g in got if g.doc_id is None}) > 8         # one id does not fill one leaf
    want = plain_targets({"s": 3000, "t": 3000})
    taken = Counter()
    for g in got:
        taken[g.source] += g.taken
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in want)
    a, b = (sorted((r.source, r.text) for r in mix(frame(spark, rows, n), leaf_docs=20, min_depth=3).collect()) for n in (2, 5))
    assert a == b


def test_plan_meets_every_target_exactly(spark):
    rows = documents(7, n=200)
    docs = frame(spark, rows)
    got = plan_mix(docs, leaf_docs=10).collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += n_words(r[1])
    want, taken = plain_targets(sizes), defaultdict(int)
    assert Counter((g.doc_id, g.size) for g in got) == Counter((r[0], n_words(r[1])) for r in rows)
    for g in got:
        assert g.source_size == sizes[g.source]
        assert math.isclose(g.target, want[g.source], abs_tol=1e-6)
        assert 0 <= g.taken <= 3 * g.size
        taken[g.source] += g.taken
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in want)
    again = plan_mix(frame(spark, rows, 7), leaf_docs=10).collect()
    assert Counter((g.doc_id, g.source, g.taken) for g in again) == Counter((g.doc_id, g.source, g.taken) for g in got)


def test_draws_are_spread_and_not_by_order(spark):
    rows = [(i, "w " * 10, "en", "big" if i < 400 else "small", 20, *["c"] * 8) for i in range(440)]
    got = plan_mix(frame(spark, rows), leaf_docs=50).collect()
    big = [g for g in got if g.source == "big"]
    share = sum(g.taken for g in big) / sum(g.size for g in big)
    low = sum(g.taken for g in big if g.doc_id < 200) / sum(g.size for g in big if g.doc_id < 200)
    assert 0 < share < 1.2 and abs(low - share) < 0.15


def test_first_words_keeps_separators(spark):
    cases = ["a b  c\nd", " lead a b", "one", "x\t\ty \n z  ", "\x1ca b"]
    df = spark.createDataFrame([(t, n) for t in cases for n in range(1, n_words(t) + 1)], "t string, n long")
    for r in df.withColumn("got", first_words(F.col("t"), F.col("n"))).collect():
        assert r.t.startswith(r.got) and n_words(r.got) == r.n


def test_mix_writes_what_the_plan_takes(spark):
    rows = documents(8, n=120)
    docs = frame(spark, rows)
    plan = defaultdict(int)
    for g in plan_mix(docs).collect():
        plan[g.doc_id, g.source] += g.taken
    mixed = mix(docs)
    assert mixed.columns == docs.columns
    got, texts = defaultdict(int), {(r[0], r[3]): r[1] for r in rows}
    for r in mixed.collect():
        got[r.doc_id, r.source] += n_words(r.text)
        assert texts[r.doc_id, r.source].startswith(r.text) and r.n_chars == len(r.text)
    assert got == {k: v for k, v in plan.items() if v}


def test_empty_wordless_and_repeated_rows(spark):
    assert plan_mix(empty(spark)).count() == 0 and mix(empty(spark)).count() == 0
    c = ["c"] * 8
    blank = [(i, None if i % 2 else " ", "en", "s", 0, *c) for i in range(6)]
    got = plan_mix(frame(spark, blank)).collect()
    assert len(got) == 6 and all(g.taken == 0 and g.target == 0 for g in got)
    assert mix(frame(spark, blank)).count() == 0
    same = [(1, "a b c", "en", "s", 5, *c)] * 4
    got = plan_mix(frame(spark, same)).collect()
    assert len(got) == 4 and sum(g.taken for g in got) == 12


def test_no_python_in_the_plan(spark):
    for df in (plan_mix(frame(spark, documents(1))), mix(frame(spark, documents(1)))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
