"""G1, J1, A1-A4 and the broadcast guard."""

import math

from pyspark.sql import functions as F

from claimsdq.operators.anomaly import amount_stats, detect_outliers, score_claims
from claimsdq.operators.tiers import classify, gold_tier, quarantine_tier, silver_tier, tier_counts
from claimsdq.operators.validate import with_issues
from claimsdq.plans.fixtures import P, load_claims
from conftest import SF_MID, SF_SMALL, claim, claims_df


def _group_rows():
    rows = [claim(claim_id="one", cpt_code="ONE", claim_amount=50.0)]
    rows += [claim(claim_id=f"k{i}", cpt_code="CONST", claim_amount=10.0) for i in range(12)]
    rows += [claim(claim_id=f"t{i}", cpt_code="TEN", claim_amount=10.0) for i in range(9)]
    rows += [claim(claim_id="t9", cpt_code="TEN", claim_amount=90000.0)]
    rows += [claim(claim_id=f"e{i}", cpt_code="ELEVEN", claim_amount=10.0) for i in range(10)]
    rows += [claim(claim_id="e10", cpt_code="ELEVEN", claim_amount=1000.0)]
    return rows


def test_group_edge_cases(spark):
    out = {r.claim_id: r for r in detect_outliers(claims_df(spark, _group_rows())).collect()}
    assert out["one"].z_score == 0.0 and out["one"].stddev_amount is None
    assert all(out[f"k{i}"].z_score == 0.0 for i in range(12))
    # 10 rows: |z| <= (n-1)/sqrt(n) < 3, never an outlier
    assert not out["t9"].is_statistical_outlier
    assert abs(out["t9"].z_score) <= 9 / math.sqrt(10) + 1e-12
    # 11 rows, 10 equal and one spike: z = 10/sqrt(11) = 3.015
    assert out["e10"].is_statistical_outlier
    assert abs(out["e10"].z_score - 10 / math.sqrt(11)) < 1e-9
    assert out["e10"]["count"] == 11


def test_fixture_tier_counts(spark):
    for sf, want in [(SF_SMALL, (877, 107, 16)), (SF_MID, (8698, 1135, 167))]:
        c = tier_counts(classify(load_claims(spark, sf), P)).first()
        assert (c.gold_records, c.failed_records, c.outlier_records) == want
        assert c.raw_records == sum(want)


def test_tiers_partition_input(spark):
    t = classify(load_claims(spark, SF_SMALL), P)
    g, s, q = gold_tier(t), silver_tier(t), quarantine_tier(t)
    ids = [r.claim_id for df in (g, s, q) for r in df.select("claim_id").collect()]
    assert len(ids) == len(set(ids)) == 1000
    assert set(g.columns) >= {"year", "month", "cpt_code", "source_file"}
    assert len(s.columns) == 8  # 9 minus ingestion_timestamp, absent in the view
    row = q.first()
    assert row.anomaly_type == "STATISTICAL_OUTLIER"
    assert row.anomaly_details.startswith("Z-score: ") and " | Avg: " in row.anomaly_details


def test_broadcast_guard_both_paths(spark):
    flagged = with_issues(load_claims(spark, SF_SMALL), P)
    small = score_claims(flagged, P)
    plan_small = small._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan_small
    big = score_claims(flagged, P.with_(broadcast_max_rows=0))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        plan_big = big._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan_big and "monotonically_increasing_id" in plan_big
        a = sorted((r.claim_id, r.tier) for r in small.select("claim_id", "tier").collect())
        b = sorted((r.claim_id, r.tier) for r in big.select("claim_id", "tier").collect())
        assert a == b
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_stats_are_partial_aggregates(spark):
    clean = with_issues(load_claims(spark, SF_SMALL), P).filter("dq_issues = ''")
    plan = amount_stats(clean)._jdf.queryExecution().executedPlan().toString()
    assert "partial_avg" in plan and "partial_stddev" in plan


def test_no_claim_shuffle_for_zscore(spark):
    """The claims side of the z-score join is never exchanged."""
    t = classify(load_claims(spark, SF_SMALL), P).select("claim_id", "tier")
    plan = t._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan


def test_per_file_scope(spark):
    rows = [claim(claim_id=f"a{i}", cpt_code="X", claim_amount=10.0) for i in range(10)]
    rows += [claim(claim_id="a10", cpt_code="X", claim_amount=1000.0)]
    a = claims_df(spark, rows, "claims/a.csv")
    b = claims_df(spark, [claim(claim_id=f"b{i}", cpt_code="X", claim_amount=1000.0) for i in range(30)],
                  "claims/b.csv")
    both = a.unionByName(b)
    per_file = P.with_(stats_keys=("source_file", "cpt_code"))
    t = score_claims(with_issues(both, P), per_file)
    q = {r.claim_id for r in t.filter(F.col("tier") == "quarantine").collect()}
    assert q == {"a10"}


def test_salted_fallback_spreads_hot_key(spark):
    """A code with a third of all rows: over the broadcast bound the join is
    salted, so the hot code's rows land in many partitions, and the tiers
    equal the broadcast plan's."""
    rows = [claim(claim_id=f"h{i}", cpt_code="HOT", claim_amount=float(i % 7)) for i in range(300)]
    rows += [claim(claim_id=f"c{i}", cpt_code=f"K{i % 60}", claim_amount=float(i % 5)) for i in range(600)]
    rows += [claim(claim_id="spike", cpt_code="HOT", claim_amount=500.0)]
    flagged = with_issues(claims_df(spark, rows), P)
    a = score_claims(flagged, P)
    b = score_claims(flagged, P.with_(broadcast_max_rows=0))
    ta = sorted((r.claim_id, r.tier, round(r.z_score, 9)) for r in a.collect())
    tb = sorted((r.claim_id, r.tier, round(r.z_score, 9)) for r in b.collect())
    assert ta == tb and ("spike", "quarantine") in {(x[0], x[1]) for x in tb}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = (b.filter(F.col("cpt_code") == "HOT").select(F.spark_partition_id().alias("p"))
                 .distinct().count())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert parts > 1


def test_semi_anti_salted(spark):
    from claimsdq.operators.remediation import quarantine_by_file, retain_by_file
    df = claims_df(spark, [claim(claim_id=f"a{i}") for i in range(20)], "claims/a.csv").unionByName(
        claims_df(spark, [claim(claim_id=f"b{i}") for i in range(5)], "claims/b.csv"))
    flagged = spark.createDataFrame([("claims/a.csv",)], "source_file string")
    for p in (P, P.with_(broadcast_max_rows=0)):
        assert quarantine_by_file(df, flagged, p).count() == 20
        assert retain_by_file(df, flagged, p).count() == 5


def test_anomaly_details_exact_form(spark):
    rows = [claim(claim_id=f"e{i}", cpt_code="ELEVEN", claim_amount=10.0) for i in range(10)]
    rows += [claim(claim_id="e10", cpt_code="ELEVEN", claim_amount=1000.0)]
    t = classify(claims_df(spark, rows), P)
    q = quarantine_tier(t).first()
    assert q.claim_id == "e10"
    assert q.anomaly_details == f"Z-score: {q.z_score!r} | Avg: 100.0 | StdDev: {q.stddev_amount!r}"
    r = quarantine_tier(t, details_digits=4).first()
    assert r.anomaly_details == "Z-score: 3.0151 | Avg: 100.0 | StdDev: 298.4962"


def test_byte_bound_also_stops_a_broadcast(spark):
    from claimsdq.operators.joins import guarded_join, materialize_small
    big = spark.range(100).selectExpr("cast(id as string) AS k")
    small = big.selectExpr("k", "repeat('x', 1000) AS v")
    _, n, size = materialize_small(small)
    assert n == 100 and size > 100_000
    for limit, hint in ((1 << 20, True), (10_000, False)):
        j = guarded_join(big, small, ["k"], "left", 1000, max_bytes=limit)
        plan = j._jdf.queryExecution().optimizedPlan().toString()
        assert ("broadcast" in plan) == hint
        assert j.count() == 100 and j.filter("v IS NULL").count() == 0


def test_salt_differs_for_equal_rows_and_follows_the_size(spark):
    from claimsdq.operators import joins
    big = spark.range(1).selectExpr("explode(sequence(1, 2000)) AS x", "'hot' AS k").select("k").repartition(4)
    small = spark.createDataFrame([("hot", 1)], "k string, v int")
    j = joins.guarded_join(big, small, ["k"], "inner", 0)
    assert j.count() == 2000
    off = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
           "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in off}
    for k, v in off.items():
        spark.conf.set(k, v)
    try:
        assert j.select(F.spark_partition_id().alias("p")).distinct().count() >= 4
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert joins.salt_buckets(spark.range(10)) == joins.MIN_SALTS
    assert joins.salt_buckets(spark.range(1 << 40)) == joins.MAX_SALTS


def test_run_context_removes_what_it_staged(spark):
    from claimsdq.session import RunContext, path_exists
    with RunContext(spark) as ctx:
        t = score_claims(with_issues(load_claims(spark, SF_SMALL), P), P, ctx)
        paths = list(ctx.paths)
        assert t.count() == 1000 and len(paths) == 1 and path_exists(spark, paths[0])
    assert not any(path_exists(spark, p) for p in paths)


def test_rules_refuse_a_missing_clock(spark):
    import pytest
    from claimsdq.params import DEFAULT
    with pytest.raises(ValueError, match="as_of"):
        with_issues(load_claims(spark, SF_SMALL), DEFAULT)
