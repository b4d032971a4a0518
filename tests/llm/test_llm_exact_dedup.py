"""Tree merge of digest runs against plain grouping."""

import hashlib
from collections import Counter, defaultdict

import pytest
from llm_cases import documents, empty, frame

from claimsdq.llm import common
from claimsdq.llm.exact_dedup import deduplicate, digests, duplicate_groups, merge_tree


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def brute(rows, pick=max):
    groups = defaultdict(list)
    for r in rows:
        groups[lower(r[1])].append(r[0])
    out = []
    for r in rows:
        ids = [i for i in groups[lower(r[1])] if i is not None]
        keep = pick(ids) if ids else None
        out.append((r[0], keep, len(groups[lower(r[1])]), r[0] == keep,
                    hashlib.sha256(lower(r[1]).encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("keep,pick", [("largest", max), ("smallest", min)])
def test_matches_plain_grouping(spark, keep, pick):
    rows = documents(1)
    got = duplicate_groups(frame(spark, rows), keep)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert Counter(map(tuple, got.collect())) == brute(rows, pick)


def test_hot_group_by_broadcast_and_by_shuffle(spark, monkeypatch):
    rows = [(i, "SAME text" if i % 3 else f"text {i}", "en", "s", 1, *["c"] * 8) for i in range(300)]
    want = brute(rows)
    for share in (1000, 2):          # all groups hot; none hot
        monkeypatch.setattr(common, "HOT_SHARE", share)
        assert Counter(map(tuple, duplicate_groups(frame(spark, rows)).collect())) == want


@pytest.mark.parametrize("leaf_bits,fan_bits", [(1, 1), (5, 2), (6, 3)])
def test_tree_shapes_agree(spark, leaf_bits, fan_bits):
    rows = digests(frame(spark, documents(2)))
    got = merge_tree(rows, leaf_bits, fan_bits)
    flat = rows.groupBy("digest").count()
    assert {(r.digest, r.group_size) for r in got.collect()} == {(r.digest, r["count"]) for r in flat.collect()}


def test_deduplicate_keeps_one_row_of_each_text_with_its_columns(spark):
    rows = documents(3)
    docs = frame(spark, rows)
    kept = deduplicate(docs)
    assert kept.columns == docs.columns
    got = [tuple(r) for r in kept.collect()]
    assert len({lower(r[1]) for r in got}) == len(got) == len({lower(r[1]) for r in rows})
    assert all(r in rows for r in got)
    best = {}
    for r in rows:
        if r[0] is not None:
            best[lower(r[1])] = max(r[0], best.get(lower(r[1]), -1))
    assert {(lower(r[1]), r[0]) for r in got if r[0] is not None} == {(t, i) for t, i in best.items()}


def test_repeated_rows_and_one_id_with_two_texts(spark):
    c = ["c"] * 8
    rows = [(1, "a", "en", "s", 1, *c)] * 3 + [(1, "b", "en", "s", 1, *c), (2, "B", "en", "s", 1, *c)]
    report = Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in duplicate_groups(frame(spark, rows)).collect())
    assert report == Counter({(1, 1, 3, True): 3, (1, 2, 2, False): 1, (2, 2, 2, True): 1})
    assert sorted((r.doc_id, r.text) for r in deduplicate(frame(spark, rows)).collect()) == [(1, "a"), (2, "B")]


def test_empty_table(spark):
    assert duplicate_groups(empty(spark)).count() == 0
    assert deduplicate(empty(spark)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = duplicate_groups(frame(spark, documents(1)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_unknown_choice_is_refused(spark):
    with pytest.raises(ValueError):
        duplicate_groups(empty(spark), "middle")
