"""Base patterns against plain regexes, tagger gradients, held-out windows."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_cases import documents, empty, frame, prose

from claimsdq.llm.pii import (KINDS, WIDTH, base_spans, find_spans, generated_windows, labelled_windows, luhn, plausible,
                              reconcile, scan, settled, shown, stitched, train, train_on, window_starts)
from claimsdq.llm.tagger import Tagger, char_classes


def plain(t):
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(p) <= 255 for p in m[0].split("."))]
    digits = lambda s: re.sub("[^0-9]", "", s)
    out += [(2, *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t)
            if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    return out + [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(digits(m[0])) <= 15]


def test_base_spans_match_plain_patterns():
    r = random.Random(6)
    for _ in range(20_000):
        t = "".join(r.choice("a1@.-+ 20(é") for _ in range(r.randint(0, 40)))
        assert base_spans(t) == plain(t), t
    assert base_spans("4929 3483 8514 6306 a.b+c@d-e.co.uk 1.2.3.004 +1 (017) 555-7713 x 300.1.1.1") == \
        [(0, 20, 35), (1, 36, 45), (2, 0, 19), (3, 46, 63)]
    assert luhn("79927398713") and not luhn("79927398710")


def test_base_spans_are_linear():
    assert base_spans("a" * 200_000 + "@" + "9" * 200_000) == []
    assert len(base_spans("1." * 100_000)) == 25_000
    assert base_spans("0" * 5000 + "1.1.1.1") == [(1, 0, 5007)]


def test_gradients_match_differences():
    t = Tagger(5, embed=4, hidden=3, seed=1)
    t.p = {k: v.astype(np.float64) for k, v in t.p.items()}
    r = np.random.default_rng(0)
    ids, tags = r.integers(0, 90, (3, 6)), r.integers(0, 5, (3, 6))
    _, grad = t.step(ids, tags)
    for name, g in grad.items():
        for _ in range(4):
            at = tuple(r.integers(0, n) for n in g.shape) if name != "embed" else (ids[0, 0], r.integers(0, 4))
            old, eps = t.p[name][at], 1e-4
            t.p[name][at] = old + eps
            up, _ = t.step(ids, tags)
            t.p[name][at] = old - eps
            down, _ = t.step(ids, tags)
            t.p[name][at] = old
            assert abs((up - down) / (2 * eps) - g[at]) < 2e-3, name


def test_decoding_is_the_best_path():
    t = Tagger(3, embed=3, hidden=2, seed=4)
    ids = np.random.default_rng(1).integers(0, 90, (4, 5))
    e, _ = t.emissions(ids)
    tags, _ = t.decode(ids)
    import itertools
    for n in range(4):
        def total(p):
            return t.p["start"][p[0]] + sum(e[n, i, k] for i, k in enumerate(p)) + sum(t.p["move"][a, b] for a, b in zip(p, p[1:]))
        assert tuple(tags[n]) == max(itertools.product(range(3), repeat=5), key=total)


def test_reconcile_is_the_best_set():
    r = random.Random(3)
    for _ in range(200):
        found = {}
        for _ in range(r.randint(0, 8)):
            a = r.randint(0, 20)
            found[r.randint(0, 3), a, a + r.randint(1, 8)] = r.uniform(0.1, 5)
        spans = list(found)
        best = 0.0
        for mask in range(1 << len(spans)):
            some = sorted((s for i, s in enumerate(spans) if mask >> i & 1), key=lambda s: s[1])
            if all(a[2] <= b[1] for a, b in zip(some, some[1:])):
                best = max(best, sum(found[s] for s in some))
        assert abs(sum(found[s] for s in reconcile(found)) - best) < 1e-9


def test_windows_overlap_and_reach_every_trigger():
    r = random.Random(1)
    t = "".join(r.choice("abcdefgh    ") if r.random() < 0.99 else r.choice("0@") for _ in range(5000))
    starts = window_starts(t)
    assert starts == sorted(set(starts))
    for m in re.finditer("[0-9@]", t):
        # some window sees the trigger with half a window's context on either side
        assert any(s <= max(0, m.start() - WIDTH // 4) and m.start() + WIDTH // 4 <= s + WIDTH for s in starts)
    assert window_starts("no trigger here") == []


@pytest.fixture(scope="module")
def contexts():
    r = random.Random(2)
    return [re.sub(r"[0-9@]", "", prose(r, 30)) for _ in range(100)]


@pytest.fixture(scope="module")
def tagger(contexts):
    return train_on(generated_windows(contexts, 2000, seed=1, cuts=0.3, long=0.3), epochs=9)


def test_held_out_windows(tagger, contexts):
    held = generated_windows(contexts, 600, seed=77)
    gold, hit, told, base = Counter(), Counter(), 0, 0
    for (found, every), (text, spans) in zip(find_spans([t for t, _ in held], tagger), held):
        spans = {s for s in spans if s[2] <= len(text)}
        gold.update(s[0] for s in spans)
        hit.update(s[0] for s in spans & set(every))
        told, base = told + len(every), base + len(spans & set(found))
        assert set(found) <= set(every)
    assert all(hit[k] >= 0.9 * gold[k] for k in range(4)), (hit, gold)
    assert hit.total() > 0.95 * told and hit.total() > 1.5 * base


LONG = ["mary.ann.catherine (at) department.university (dot) edu", "jane_elisabeth_smith at research dot institute dot example dot org",
        "firstname-lastname[at]mail[dot]company[dot]subsidiary[dot]example[dot]com",
        "alexander.maximilian.richardson.thompson ( at ) engineering ( dot ) northwest ( dot ) example ( dot ) org",
        "somebody.with.a.longish.name.indeed AT department DOT faculty DOT university DOT country DOT college DOT example DOT org"]


@pytest.mark.parametrize("address", LONG)
def test_long_spans_are_found_at_every_offset(tagger, address):
    assert 50 <= len(address) <= 120
    texts = []
    for shift in range(WIDTH):
        lead = re.sub(r"[0-9]", "", prose(random.Random(shift), 80))
        texts.append((lead[:200] + " ")[-(WIDTH + shift):] + address + " " + lead)
    for text, (_, every) in zip(texts, find_spans(texts, tagger)):
        assert any(k == 0 and text[a:z].strip(" .") == address for k, a, z in every), text


def test_cut_parts_are_stitched():
    assert stitched([(0, 40, 48), (3, 48, 60), (0, 48, 96), (0, 90, 99), (0, 120, 130)]) == [(0, 40, 99), (0, 120, 130), (3, 48, 60)]


def test_settled_edges():
    t = "write to jane.doe (at) example (dot) org. Then at home. Done"
    at = t.index("jane")
    assert settled((0, at + 3, at + 20), t) == (0, at, at + len("jane.doe (at) example (dot) org"))
    assert settled((0, 0, len(t)), t) == (0, at, at + len("jane.doe (at) example (dot) org"))
    assert settled((3, 5, 9), t) == (3, 5, 9)
    assert settled((0, t.index("Then"), len(t)), t)[1:] == (t.index("Then"), len(t))        # no address there


def test_sample_is_spread_over_documents_and_rows(spark):
    long = " ".join(f"word{i}" for i in range(5000))
    rows = [(0, long, "en", "s", 0, *["c"] * 8)] + [(i, f"mail a{i}@b.org now", "en", "s", 0, *["c"] * 8) for i in range(1, 300)]
    one, two = (labelled_windows(frame(spark, some, parts), 60) for some, parts in ((rows, 1), (rows[::-1], 9)))
    assert one == two and len(one) == 60
    assert 10 < sum("@" in w for w, _ in one) < 50                   # neither the long document alone nor none of it
    assert all(any(k == 0 for k, _, _ in spans) for w, spans in one if "@" in w)


def test_clean_text_stays_clean(tagger):
    r = random.Random(9)
    texts = [re.sub(r"[0-9]", "", prose(r, 200)) + f" Version {i}.0 of 2024-01-{i:02d}." for i in range(1, 29)]
    assert sum(len(every) for _, every in find_spans(texts, tagger)) <= 2


def test_spans_deep_in_long_texts_are_found(tagger):
    r, found = random.Random(0), 0
    for words in range(300, 320):
        lead = re.sub(r"[0-9]", "", prose(r, words)) + " "
        s = "write to jane.doe (at) example.org today"
        end = len(lead) + s.index(" today")
        found += any(k == 0 and z == end for k, _, z in find_spans([lead + s + " " + lead], tagger)[0][1])
    assert found >= 15


def test_scan_matches_base_patterns(spark, tagger):
    r = random.Random(5)
    rows = documents(19) + [(900 + i, f"é {prose(r, 5)} a{i}@b.org 10.0.{i}.7 +49 30 1234567{i}", "en", "s", 0, *["c"] * 8)
                            for i in range(9)]
    got = scan(frame(spark, rows), tagger)
    assert got.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    want = Counter()
    for row in rows:
        b = plain(row[1] or "")
        want[row[0], *[sum(s[0] == k for s in b) for k in range(4)], hashlib.sha256(shown(b).encode()).hexdigest()] += 1
    assert Counter(tuple(g)[:-1] for g in got.collect()) == want
    for g in got.collect():
        text = next(row[1] or "" for row in rows if row[0] == g.doc_id)
        spans = [x.split(":") for x in g.spans.split(",") if x]
        assert {(KINDS.index(k), int(a), int(z)) for k, a, z in spans} >= set(plain(text))
        assert all(plausible(KINDS.index(k), text[int(a):int(z)]) or (KINDS.index(k), int(a), int(z)) in plain(text)
                   for k, a, z in spans)


def test_empty_table_and_training_without_rows(spark, tagger):
    assert scan(empty(spark), tagger).count() == 0
    assert train(empty(spark), sample_windows=8, epochs=1).n_tags == 9


def test_characters_have_classes():
    c = char_classes("a\t\n\x00é🙂~")
    assert c.tolist() == [65, 95, 96, 97, 98, 98, 94]
