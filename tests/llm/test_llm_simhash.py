"""SimHash, pigeonring links and components against brute force."""

import random
from collections import Counter

import xxhash
import pytest
from llm_cases import documents, empty, frame
from pyspark.sql import functions as F

from claimsdq.llm.components import connected_components
from claimsdq.llm.simhash import deduplicate, fingerprint, fingerprints, links, near_duplicates, pigeonring


def plain_fingerprint(text, k=3):
    words, word = [], ""
    for c in text or "":
        if c in " \t\n\v\f\r":
            words.append(word)
            word = ""
        else:
            word += c.lower() if "A" <= c <= "Z" else c
    words = [w for w in [*words, word] if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def components(nodes, edges):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute(rows, d=2):
    fp = [plain_fingerprint(r[1]) for r in rows]
    roots = components(set(fp), [(a, b) for a in set(fp) for b in set(fp) if a < b and bin(a ^ b).count("1") <= d])
    low = {}
    for r, f in zip(rows, fp):
        if r[0] is not None:
            low[roots[f]] = min(r[0], low.get(roots[f], r[0]))
    return Counter((r[0], f"{f:016x}", low.get(roots[f])) for r, f in zip(rows, fp))


def test_fingerprint_matches_the_definition(spark):
    for row in documents(4):
        assert fingerprint(row[1]) == plain_fingerprint(row[1])
    assert fingerprint("\x1c\x85　a b") == plain_fingerprint("\x1c\x85　a b")


def test_fingerprint_equals_sparks_own_hash(spark):
    # one shingle: the fingerprint is the hash itself
    text = "naïve Words here"
    own = spark.range(1).select(F.xxhash64(F.lit("naïve words here"))).first()[0]
    assert fingerprint(text) == own % (1 << 64)


@pytest.mark.parametrize("bucket_limit", [64, 1])
def test_matches_brute_force(spark, bucket_limit):
    rows = documents(5, n=150)
    got = near_duplicates(frame(spark, rows), bucket_limit=bucket_limit)
    assert Counter(map(tuple, got.collect())) == brute(rows)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("distance,segments,limit", [(1, 3, 1), (1, 4, 64), (2, 4, 1), (2, 4, 64), (3, 5, 1), (3, 4, 64)])
def test_links_have_the_components_of_all_pairs(spark, distance, segments, limit):
    r = random.Random(distance * 10 + limit)
    values = {r.getrandbits(64) for _ in range(30)}
    for v in list(values):
        for _ in range(6):
            w = v
            for b in r.sample(range(64), r.randint(1, 3)):
                w ^= 1 << b
            values.add(w)
    nodes = [signed(v) for v in values]
    fps = spark.createDataFrame([(v,) for v in nodes], "fp long")
    got = [(a, b) for a, b in links(fps, distance, segments, limit).collect()]
    assert all(bin((a ^ b) % (1 << 64)).count("1") <= distance or limit == 1 for a, b in got)
    pairs = [(a, b) for a in nodes for b in nodes if a < b and bin((a ^ b) % (1 << 64)).count("1") <= distance]
    assert components(nodes, got) == components(nodes, pairs)


def test_pigeonring_passes_every_close_pair_and_prunes(spark):
    r = random.Random(3)
    close = []
    for n in range(400):
        x = 0
        for b in r.sample(range(64), n % 3):
            x |= 1 << b
        close.append((signed(x), True))
    far = [(signed(r.getrandbits(64)), False) for _ in range(400)]
    df = spark.createDataFrame(close + far, "x long, near boolean")
    out = df.groupBy("near").agg(F.sum(pigeonring(F.col("x"), 4, 2).cast("int")).alias("n")).collect()
    passed = {r.near: r.n for r in out}
    assert passed[True] == 400 and passed[False] < 20


def test_components_of_paths_stars_and_cycles(spark):
    r = random.Random(9)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(200, 201), (201, 202), (202, 200), (5, 5)]
    edges = [(a + 1000 * s, b + 1000 * s) for s in range(2) for a, b in edges]
    r.shuffle(edges)
    got = connected_components(spark.createDataFrame(edges, "a long, b long"))
    nodes = {x for e in edges for x in e}
    assert {x.node: x.root for x in got.collect()} == {n: c for n, c in components(nodes, edges).items()}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_deduplicate_keeps_the_first_of_each_component(spark):
    rows = documents(6, n=120)
    docs = frame(spark, rows)
    kept = deduplicate(docs)
    assert kept.columns == docs.columns
    want = {k[0] for k in brute(rows) if k[0] == k[2]}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)


def test_repeated_ids_and_empty_table(spark):
    c = ["c"] * 8
    rows = [(7, "some words that repeat here", "en", "s", 1, *c)] * 3 + [(8, "some words that repeat here", "en", "s", 1, *c)]
    assert [r.doc_id for r in deduplicate(frame(spark, rows)).collect()] == [7]
    assert near_duplicates(empty(spark)).count() == 0
    assert fingerprints(empty(spark)).count() == 0
