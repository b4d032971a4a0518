"""Mergeable moments: G1 without another pass over claims that did not change.

A group's row count, mean and M2 (sum of squared distances from the mean) are
kept per file and code.  Any set of them merges into the figures of the whole:
with the counts' total N and the weighted mean m,

    M2 = sum(M2_i) + sum(n_i * (mean_i - m)^2)

which is the pairwise formula for all parts at once.  Distances are taken from
means, never from zero, so amounts with a large common part lose no digits.  The
merge is two aggregates over rows per (file, code); claims are not touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def file_moments(clean: DataFrame, keys: tuple[str, ...] = ("source_file", "cpt_code")) -> DataFrame:
    """Per group: ``n`` rows, and ``mean`` and ``m2`` of the amounts."""
    amount = F.col("claim_amount")
    return clean.groupBy(*keys).agg(F.count(amount).alias("n"), F.avg(amount).alias("mean"),
                                    (F.var_pop(amount) * F.count(amount)).alias("m2"))


def _with_group(moments: DataFrame, keys: tuple[str, ...], *aggs: Column) -> DataFrame:
    """Each row with aggregates of its group of ``keys`` (null keys are a group)."""
    group = moments.groupBy(*[F.col(k).alias(f"__g_{k}") for k in keys]).agg(*aggs)
    same = [F.col(k).eqNullSafe(F.col(f"__g_{k}")) for k in keys]
    return moments.join(group, same).drop(*[f"__g_{k}" for k in keys])


def merged_moments(moments: DataFrame, keys: tuple[str, ...] = ("cpt_code",)) -> DataFrame:
    """Moments of finer groups to those of ``keys``: n, mean, m2."""
    rows = moments.filter("n > 0").select(*keys, "n", "mean", "m2")
    # the weighted mean is taken around one of the means: a sum of small distances
    near = _with_group(rows, keys, F.min("mean").alias("base"))
    shift = F.sum(F.col("n") * (F.col("mean") - F.col("base"))) / F.sum("n")
    whole = near.groupBy(*keys).agg((F.min("base") + shift).alias("whole"))
    joined = rows.join(whole.select(*[F.col(k).alias(f"__g_{k}") for k in keys], "whole"),
                       [F.col(k).eqNullSafe(F.col(f"__g_{k}")) for k in keys])
    apart = F.col("n") * F.pow(F.col("mean") - F.col("whole"), F.lit(2))
    return joined.groupBy(*keys).agg(F.sum("n").alias("n"), F.min("whole").alias("mean"), F.sum(F.col("m2") + apart).alias("m2"))


def merged_stats(moments: DataFrame, keys: tuple[str, ...] = ("cpt_code",)) -> DataFrame:
    """G1 from moments: avg_amount, stddev_amount (sample) and count."""
    m = merged_moments(moments, keys)
    return m.select(*keys, F.col("mean").alias("avg_amount"),
                    F.when(F.col("n") > 1, F.sqrt(F.greatest(F.col("m2"), F.lit(0.0)) / (F.col("n") - 1))).alias("stddev_amount"),
                    F.col("n").alias("count"))
