"""Column-wise BWT against sorting, repeats against a plain scan."""

import hashlib
import itertools
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from llm_cases import documents, empty, frame

from claimsdq.llm.suffix_dedup import collection_bwt, narrowed, remove_repeats, repeated_windows, segments, suffix_rows


def plain_arrays(strings):
    rows = sorted(([(1, c) for c in s[i:]] + [(0, n)], n, i) for n, s in enumerate(strings) for i in range(len(s) + 1))
    bwt = [strings[n][i - 1] if i else None for _, n, i in rows]
    lcp = [0]
    for (a, *_), (b, *_) in zip(rows, rows[1:]):
        lcp.append(next(k for k, (x, y) in enumerate(zip(a, b)) if x != y))
    return rows, bwt, lcp


@pytest.mark.parametrize("letters", [b"ab", b"abc", b"a", b"ab\xff\x00", bytes(range(256))])
def test_arrays_match_sorted_suffixes(tmp_path, letters):
    r = random.Random(len(letters))
    for _ in range(40):
        strings = [bytes(r.choice(letters) for _ in range(r.randint(1, 30))) for _ in range(r.randint(1, 8))]
        lens = np.array([len(s) for s in strings])
        flat = np.frombuffer(b"".join(strings), np.uint8)
        bwt, lcp = collection_bwt(flat, np.cumsum(lens) - lens, lens, str(tmp_path))
        rows, want, prefix = plain_arrays(strings)
        mark = 256 if flat.max() == 255 else 255
        assert [None if x == mark else int(x) for x in bwt] == want
        assert lcp.tolist() == prefix
        for row, n, at in zip(*suffix_rows(bwt, lens, 3)):
            assert rows[row][1:] == (n, at)


def test_repeated_windows(tmp_path):
    r = random.Random(8)
    for _ in range(30):
        strings = [bytes(r.choice(b"abc") for _ in range(r.randint(5, 40))) for _ in range(6)]
        doc, start = np.arange(6) % 3, np.arange(6) * 100
        places = sorted((int(d), int(s) + i, x[i:i + 5]) for d, s, x in zip(doc, start, strings) for i in range(len(x) - 4))
        seen, want = set(), set()
        for d, w, x in places:
            if x in seen:
                want.add((d, w))
            seen.add(x)
        flat, starts, lens = joined(strings)
        got = repeated_windows(flat, starts, lens, doc, start, 5, str(tmp_path))
        assert set(zip(*[c.tolist() for c in got])) == want


def joined(strings):
    lens = np.array([len(s) for s in strings])
    return np.frombuffer(b"".join(strings), np.uint8), np.cumsum(lens) - lens, lens


@pytest.mark.parametrize("seed", range(6))
def test_narrowing_loses_no_repeat_and_prunes(tmp_path, seed):
    r = random.Random(seed)
    vocab = [b"the ", b"on ", b"ing ", b"re ", b"\xc3\xa9 ", b"ab" * 40]
    base = b"".join(r.choice(vocab) + str(r.randint(0, 999)).encode() for _ in range(300))
    texts = [base]
    for _ in range(5):
        t = bytearray(base)
        for _ in range(12):
            t[r.randrange(len(t))] = r.randrange(97, 123)
        texts.append(bytes(t) + b"xy" * r.randint(0, 90))
    rows = {}
    for d, t in enumerate(texts):
        for a, g, s, n, _ in zip(*[c.tolist() for c in segments(t, 100)]):
            rows.setdefault((a, g), (a, d, s, t[s:s + n + 99]))
    a, d, s, strings = zip(*rows.values())
    anchor, doc, start = map(np.array, (a, d, s))
    flat, starts, lens = joined(strings)
    whole = repeated_windows(flat, starts, lens, doc, start, 100, str(tmp_path))
    lo, hi, d, s = narrowed(flat, starts, lens, anchor, doc, start, 100)
    left = repeated_windows(flat, lo, hi - lo, d, s, 100, str(tmp_path))
    got = set(zip(*[c.tolist() for c in left]))
    assert got == set(zip(*[c.tolist() for c in whole])) and got
    assert (hi - lo).sum() < 0.8 * lens.sum()


def test_segments_cover_every_window_once_and_follow_content():
    r = random.Random(2)
    data = bytes(r.choice(b"abcdefgh ") for _ in range(3000)) + b"xy" * 400 + b"z" * 300
    anchor, digest, start, size, twice = segments(data, 100)
    windows = [w for s, n in zip(start, size) for w in range(s, s + n)]
    assert windows == list(range(len(data) - 99))
    assert size.max() <= 69
    moved = segments(b"prefix" + data, 100)
    by_window = {w: a for a, s, n in zip(anchor, start, size) for w in range(s, s + n)}
    assert all(by_window[w - 6] == a for a, s, n in zip(moved[0], moved[2], moved[3]) for w in range(s, s + n) if w >= 6)
    periodic = ((start > 3100) & (start + size + 99 <= 3800)) | (start >= 3800)
    assert periodic.sum() > 5 and twice[periodic].all()
    assert not len(segments(b"short", 100)[0])


def tie(text):
    h = xxhash.xxh64_intdigest((text or "").encode(), 42)
    return h - (1 << 64) if h >> 63 else h


def brute(rows, k=100):
    """Rows that share doc_id and text are one document; of those that share the
    doc_id alone, the one with the smaller hash of its text comes first."""
    seen, out = set(), Counter()
    many = Counter((r[0], r[1] or "") for r in rows)
    for doc, text in sorted(many, key=lambda r: (r[0] is not None, r[0] or 0, tie(r[1]))):
        b = text.encode()
        gone = bytearray(len(b))
        for i in range(len(b) - k + 1):
            w = b[i:i + k]
            if w in seen:
                gone[i:i + k] = b"\1" * k
            seen.add(w)
        spans = sum(1 for g, _ in itertools.groupby(gone) if g)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out[doc, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()] += many[doc, text]
    return out


def passages(seed, n=120):
    r = random.Random(seed)
    vocab = ["the", "on", "héé", "ing", "re", "x", "boilerplate", "\n"]
    shared = [" ".join(r.choice(vocab) + str(r.randint(0, 99)) for _ in range(r.randint(5, 80))) for _ in range(10)]
    rows = documents(seed, n=20, long_words=500)
    for i in range(n):
        t = ""
        for _ in range(r.randint(0, 5)):
            c = r.random()
            if c < 0.5:
                p = r.choice(shared)
                a = r.randint(0, len(p) // 2)
                t += p[a:a + r.randint(50, 400)]
            elif c < 0.6:
                t += r.choice(["ab", "Annt ", "x", "0123456789" * 7]) * r.randint(1, 120)
            else:
                t += " ".join(r.choice(vocab) + str(r.randint(0, 9999)) for _ in range(r.randint(0, 60)))
        rows.append((1000 + i, t, "en", "s", 0, *["c"] * 8))
    return rows


@pytest.mark.parametrize("seed,crowd", [(1, 100_000), (2, 100_000), (3, 3), (4, 1)])
def test_matches_a_plain_scan(spark, seed, crowd):
    rows = passages(seed)
    got = remove_repeats(frame(spark, rows), crowd=crowd)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert Counter(map(tuple, got.collect())) == brute(rows)


@pytest.mark.parametrize("crowd", [100_000, 1])
def test_rows_that_share_an_identifier(spark, crowd):
    r = random.Random(12)
    rows = passages(7, n=60)
    c = ["c"] * 8
    unique = "".join(r.choice("abcdefghij ") for _ in range(300))
    rows += [(7, unique, "en", "s", 0, *c), (7, rows[3][1], "en", "s", 0, *c), (7, (rows[50][1] or "x") * 3, "en", "s", 0, *c)]
    for n in range(25):                                   # many rows without an identifier, two alike, some repeated
        rows.append((None, unique[n * 3:] + str(n) * 40 + (rows[n][1] or ""), "en", "s", 0, *c))
    rows += rows[-4:] + [(None, None, "en", "s", 0, *c), (1001, rows[22][1], "en", "s", 0, *c)] + rows[:2]
    r.shuffle(rows)
    assert Counter(map(tuple, remove_repeats(frame(spark, rows), crowd=crowd).collect())) == brute(rows)


def test_texts_are_exchanged_once(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for name in names:                                 # as with tables too large to broadcast
        spark.conf.set(name, "-1")
    try:
        out = remove_repeats(docs)
        out.collect()
    finally:
        for name in names:
            spark.conf.unset(name)
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in plan and plan.count("data#") and plan.count("documents.parquet") == 1


def test_other_length_and_test_table(spark):
    rows = passages(5, n=60)
    assert Counter(map(tuple, remove_repeats(frame(spark, rows), length=64).collect())) == brute(rows, 64)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert Counter(map(tuple, remove_repeats(docs).collect())) == want


def test_empty_table_and_bad_length(spark):
    assert remove_repeats(empty(spark)).count() == 0
    with pytest.raises(ValueError):
        remove_repeats(empty(spark), length=10)
