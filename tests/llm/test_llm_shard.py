"""Rendezvous shards: stability, balance, weights and gapless slots."""

import zlib
from collections import Counter, defaultdict

import pytest
from llm_cases import documents, empty, frame
from pyspark.sql import functions as F

from claimsdq.llm.shard import rendezvous, shard_records


def test_rows_sizes_checksums_and_slots(spark):
    rows = documents(9, n=300)
    got = shard_records(frame(spark, rows), [1.0] * 7, slot_buckets=4).collect()
    text = {r[0]: (r[1] or "").encode() for r in rows}
    assert Counter(g.doc_id for g in got) == Counter(r[0] for r in rows)
    slots = defaultdict(list)
    for g in got:
        assert g["size"] == len(text[g.doc_id]) + 16 and g.text_crc32 == zlib.crc32(text[g.doc_id])
        assert g.law == "key" and 0 <= g.shard < 7
        slots[g.shard].append(g.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_one_more_shard_takes_rows_only_into_itself(spark):
    ids = spark.range(20_000)
    got = ids.select(rendezvous(F.col("id"), [1.0] * 40).alias("a"), rendezvous(F.col("id"), [1.0] * 41).alias("b")).collect()
    moved = [r for r in got if r.a != r.b]
    assert all(r.b == 40 for r in moved)
    assert abs(len(moved) / 20_000 - 1 / 41) < 0.006
    sizes = Counter(r.a for r in got)
    assert len(sizes) == 40 and max(sizes.values()) < 1.3 * 500 and min(sizes.values()) > 0.7 * 500


def test_grown_column_is_the_larger_law(spark):
    rows = documents(10)
    small = {r.doc_id: r.grown_shard for r in shard_records(frame(spark, rows), [1.0] * 5).collect()}
    large = {r.doc_id: r.shard for r in shard_records(frame(spark, rows, 2), [1.0] * 6).collect()}
    assert small == large
    assert all(r.grown_shard is None for r in shard_records(frame(spark, rows), [1.0] * 5, grown_weight=None).collect())


def test_weights_set_the_shares(spark):
    w = [1.0, 3.0, 0.0, 6.0]
    got = Counter(r[0] for r in spark.range(20_000).select(rendezvous(F.col("id"), w)).collect())
    assert 2 not in got
    assert all(abs(got[s] / 20_000 - w[s] / 10) < 0.02 for s in (0, 1, 3))
    with pytest.raises(ValueError):
        rendezvous(F.col("id"), [0.0])


def test_null_and_repeated_keys_and_empty_table(spark):
    c = ["c"] * 8
    rows = [(None, "a", "en", "s", 1, *c)] * 3 + [(5, "b", "en", "s", 1, *c)] * 4
    got = shard_records(frame(spark, rows), [1.0] * 3).collect()
    assert len({g.shard for g in got if g.doc_id is None}) == 1
    by = defaultdict(list)
    for g in got:
        by[g.shard].append(g.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert shard_records(empty(spark), [1.0, 1.0]).count() == 0


def test_no_python_in_the_plan(spark):
    plan = shard_records(frame(spark, documents(1)), [1.0] * 4)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
