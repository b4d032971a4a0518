"""The quality classifier: the identity, held-out accuracy, determinism, edges."""

import zlib

import numpy as np
import pytest
from llm_cases import empty, frame

from claimsdq.llm import quality_fm as Q
from claimsdq.llm.common import documents

SF = "/root/testdata/sf0.1"


def test_linear_time_score_equals_the_sum_over_pairs():
    m = Q.Machine()
    m.linear[:] = np.random.default_rng(1).standard_normal(Q.BUCKETS) * 0.1
    m.factors *= 20
    rows = [Q.features(t.encode(), n) for t, n in (("One two, two THREE ###\nléon 42", 30), ("", None), ("x " * 50, 7))]
    for (at, x), got in zip(rows, m.score(rows)):
        z = m.bias + float((m.linear[at] * x).sum())
        for i in range(len(at)):
            for j in range(i + 1, len(at)):
                z += float(m.factors[at[i]] @ m.factors[at[j]]) * float(x[i]) * float(x[j])
        assert got == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-5)


def test_training_follows_the_gradient_and_learns_an_interaction():
    # neither feature alone tells the label, their product does
    a, b = 5, 9
    def row(x, y):
        return np.array([a, b], np.int32), np.array([x, y], np.float32)
    rows = [row(x, y) for x in (-1, 1) for y in (-1, 1)] * 100
    labels = np.array([float(r[1][0] * r[1][1] > 0) for r in rows], np.float32)
    m = Q.Machine()
    m.fit(rows, labels, epochs=30)
    score = m.score(rows[:4])
    assert ((score > 0.7) == (labels[:4] == 1)).all() and ((score < 0.3) == (labels[:4] == 0)).all()


@pytest.fixture(scope="module")
def machine(spark):
    return Q.train(documents(spark, SF), spark.read.parquet(f"{SF}/labels.parquet"))


def test_held_out_accuracy(spark, machine):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    rows = Q.classify(documents(spark, SF), machine).join(labels, "doc_id").collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert {r.held_out for r in held} == {True} and len(held) > 500
    for label in (0, 1):
        mine = [r for r in held if r.quality == label]
        assert sum(r.predicted == label for r in mine) >= 0.95 * len(mine)
    ranked = sorted(held, key=lambda r: r.score)
    n1 = sum(r.quality for r in held)
    above = sum(n for n, r in enumerate(ranked, 1) if r.quality) - n1 * (n1 + 1) / 2
    assert above / (n1 * (len(held) - n1)) >= 0.99


def test_held_out_labels_lang_source_and_id_do_not_matter(spark):
    from pyspark.sql import functions as F
    docs = documents(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    changed = labels.withColumn("quality", F.when(Q.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = Q.train(docs, labels, sample_rows=150, epochs=2), Q.train(docs.repartition(7), changed, sample_rows=150, epochs=2)
    assert (a.factors == b.factors).all() and (a.linear == b.linear).all()
    other = docs.withColumns({"lang": F.lit("xx"), "source": F.lit(None).cast("string"), "doc_id": F.col("doc_id") + 7})
    one = {r.doc_id: r.score for r in Q.classify(docs, a).collect()}
    two = {r.doc_id - 7: r.score for r in Q.classify(other, a).collect()}
    assert one == two


def test_awkward_rows(spark, machine):
    rows = [(1, None), (2, ""), (3, "same text here."), (3, "same text here."), (None, "no id"), (4, "w" * 200_000 + " x" * 90_000)]
    rows = [(i, t, None, None, n, *["clash"] * 8) for n, (i, t) in enumerate(rows)]
    got = Q.classify(frame(spark, rows, 2), machine).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    assert Q.classify(empty(spark), machine).count() == 0
    blank = Q.train(frame(spark, rows), spark.createDataFrame([], "doc_id long, quality int"))
    assert {r.score for r in Q.classify(frame(spark, rows), blank).collect()} == {0.5}
    plain = frame(spark, rows).drop("n_chars", "lang", "source")
    assert Q.classify(plain, machine).count() == 6


def test_sample_is_bounded_and_one_label_wins(spark):
    rows = [(i, f"text {i}", "en", "a", 5, *["clash"] * 8) for i in (1, 1, 1, 2, 3, 4)]
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 0), (3, None), (None, 1), (9, 1)], "doc_id long, quality int")
    from pyspark.sql import functions as F
    got, y = Q.sample(frame(spark, rows), labels, "quality", F.lit(True), 100)
    assert sorted(y) == [0, 1, 1, 1]
    assert len(Q.sample(frame(spark, rows), labels, "quality", F.lit(True), 2)[0]) <= 2
